"""Repeated passages against a table of all windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from rosterlake.llm import substring_dedup

WINDOW = substring_dedup.WINDOW


def plainly(docs):
    """Windows in order of doc_id and place, each kept in a set."""
    seen, found = set(), []
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for s in range(len(words) - WINDOW + 1):
            key = tuple(words[s:s + WINDOW])
            if key in seen:
                gone[s:s + WINDOW] = [True] * WINDOW
            seen.add(key)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        found.append((doc_id, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return found


def passages(seed):
    """Texts that share passages, with edits, repeats within a text and frequent phrases in unlike surroundings."""
    rng = random.Random(seed)
    prose = [f"w{rng.randrange(400)}" for _ in range(3000)]
    phrase = [f"p{i}" for i in range(14)]
    texts = []
    for _ in range(60):
        words = []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.randrange(5)
            at, size = rng.randrange(2900), rng.randrange(5, 90)
            if kind == 0:
                words += prose[at:at + size]
            elif kind == 1:
                words += [w if rng.random() < .95 else "edit" for w in prose[at:at + size]]
            elif kind == 2:
                words += [f"x{rng.randrange(9)}" for _ in range(4)] + phrase + [f"x{rng.randrange(9)}" for _ in range(4)]
            elif kind == 3:
                words += [rng.choice(["a", "b"]) for _ in range(size)]
            else:
                words += ["same"] * size
        texts.append(rng.choice([" ", "\n", " \t"]).join(words))
    return texts + texts[:5]


@pytest.mark.parametrize("seed, pack, cell", [(1, substring_dedup.PACK_WORDS, 256), (2, 300, 256), (3, 900, 7)])
def test_equal_to_a_table_of_all_windows(spark, monkeypatch, seed, pack, cell):
    monkeypatch.setattr(substring_dedup, "PACK_WORDS", pack)
    monkeypatch.setattr(substring_dedup, "CELL", cell)
    texts = [None, "", "  \t", "één två \x1c 三", *passages(seed)]
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "1 AS row", "2 AS pack", "3 AS kind", "4 AS start").repartition(5)
    found = substring_dedup.remove_repeated(frame).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == plainly(docs)
    assert sum(r["n_removed"] for r in found) > 1000


def test_repeated_ids_and_rows_without_id(spark):
    text = " ".join(f"w{i}" for i in range(30))
    big = 2 ** 62 + 1
    docs = spark.createDataFrame([(None, text), (big, text), (big, text), (5, text + " tail")], "doc_id long, text string")
    found = substring_dedup.remove_repeated(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"]) for r in found) == [
        (False, 5, 0), (False, big, 30), (False, big, 30), (True, 0, 30)]
    twice = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in substring_dedup.remove_repeated(twice).collect()) == [0, 30, 30]


def test_empty_table_and_very_long_text(spark):
    assert substring_dedup.remove_repeated(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    words = [f"w{i % 50_000}" for i in range(150_000)]
    docs = [(0, " ".join(words)), (1, "z" * 1_000_000 + " " + " ".join(["q"] * 100_000))]
    found = substring_dedup.remove_repeated(spark.createDataFrame(docs, "doc_id long, text string")).orderBy("doc_id")
    assert [(r["n_words"], r["n_removed"]) for r in found.collect()] == [(150_000, 100_000), (100_001, 99_999)]


def test_factors_and_boundaries_find_every_window():
    rng = np.random.default_rng(7)
    for turn in range(300):
        block = rng.integers(0, rng.choice([2, 4, 50]), 120).astype(">u8")
        at = rng.integers(0, 80)
        stretch = np.concatenate([block[at:at + 30], rng.integers(0, 3, rng.integers(0, 9)), block[:40]]).astype(">u8")
        before = None
        if turn % 2:
            stretch, before = block[20:110], 20
        found = substring_dedup.parse(substring_dedup.Reference(block.tobytes()), stretch.tobytes(), before, window=8)
        held = {}
        for s in range(len(block) - 7):
            held.setdefault(block[s:s + 8].tobytes(), s)
        expected = [s for s in range(len(stretch) - 7) if stretch[s:s + 8].tobytes() in held and (
            before is None or held[stretch[s:s + 8].tobytes()] < before + s)]
        assert found.tolist() == expected
