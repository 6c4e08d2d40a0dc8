"""Token alignment against tokens laid over bytes one by one."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import sparse, token_alignment

pytestmark = pytest.mark.skipif(not Path(token_alignment.FOLDER).is_dir(), reason="no tokenizers here")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plainly(docs):
    """Both tokenizers' own libraries, and spans compared token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    folder = Path(token_alignment.FOLDER)
    first = Tokenizer.from_file(str(folder / token_alignment.BYTE_LEVEL))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=str(folder / token_alignment.PIECES))
    letters = token_alignment.byte_letters()

    def spans(tokens):
        ends = np.cumsum([len(t) for t in tokens]).tolist()
        return list(zip([0, *ends], ends))

    found, counts = [], Counter()
    for doc_id, text in docs:
        a, b, links, groups = [], [], [], []
        if text:
            a = first.encode(" " + text, add_special_tokens=False).ids
            b = second.encode(text)
            bytes_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
            bytes_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i)
                       else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
                a, b = [], []
            else:
                over_a, over_b = spans(bytes_a), spans(bytes_b)
                links = [(a[x], b[y]) for x, (s, e) in enumerate(over_a) for y, (t, f) in enumerate(over_b)
                         if s < f and t < e]
                met = sorted({e for _, e in over_a} & {e for _, e in over_b})
                for start, end in zip([0, *met], met):
                    groups.append(tuple(",".join(str(i) for i, (s, e) in zip(ids, over) if start <= s and e <= end)
                                        for ids, over in ((a, over_a), (b, over_b))))
        counts.update(links)
        found.append((doc_id, len(a), len(b), groups, links))
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return sorted((doc_id, n_a, n_b, len(groups), len(links), sum(counts[p] == top[p[1]] for p in links),
                   sum(counts[p] for p in links),
                   hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest() if n_a else "")
                  for doc_id, n_a, n_b, groups, links in found)


def fixture():
    rng = random.Random(3)
    odd = [None, "", " ", "a", "  two  spaces ", "<|endoftext|> <s></s><unk> <0x41>", "tab\tline\r\nend\n", "naïve café — Größe",
           "Привет, мир", "日本語のテキスト", "👩‍👩‍👧 flags 🇩🇪", "▁ piece sign", "é ﬁ   　", "\x00\x07",
           "a" * 500, "don't we'll I'm", "x" * 40 + " " * 60 + "y"]
    prose = [" ".join(rng.choice(["the", "Haus", "river", "dvořák", "ing", "42", "x_y", "…"]) for _ in range(80))
             for _ in range(12)]
    texts = odd + prose + prose[:3]
    return [(i, t) for i, t in enumerate(texts)] + [(5, "same id"), (5, "same id"), (None, "no id")]


@pytest.mark.parametrize("block", [token_alignment.BLOCK_LINKS, 50])
def test_alignment_equals_spans_compared_token_by_token(spark, monkeypatch, block):
    monkeypatch.setattr(token_alignment, "BLOCK_LINKS", block)
    monkeypatch.setattr(token_alignment, "PIECE_BYTES", 300)
    docs = fixture()
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "1 AS block", "2 AS pairs", "3 AS n_a", "4 AS total").repartition(3)
    found = token_alignment.align(frame, token_alignment.read_files()).select(*COLUMNS).collect()
    key = repr
    assert sorted((tuple(r) for r in found), key=key) == sorted(plainly_with_null(docs), key=key)


def plainly_with_null(docs):
    return [(None if i == -1 else i, *rest) for i, *rest in plainly([(-1 if i is None else i, t) for i, t in docs])]


def test_links_as_rows(spark):
    docs = spark.createDataFrame([(0, "Größe naïve"), (1, None)], "doc_id long, text string")
    files = token_alignment.read_files()
    counts = token_alignment.align(docs, files).orderBy("doc_id").first()
    over = token_alignment.links(docs, files)
    assert over.count() == counts["n_links"]
    assert over.agg(F.sum("shared")).first()[0] == len(" Größe naïve".encode())
    assert token_alignment.links(docs, files, "group").count() == counts["n_shared"]


def test_very_long_texts(spark):
    texts = ["a" * 1_000_000, " " * 1_000_000, "語 " * 300_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = token_alignment.align(docs, token_alignment.read_files()).collect()
    assert all(r["n_a"] and r["n_links"] >= max(r["n_a"], r["n_b"]) for r in found)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.align(docs, token_alignment.read_files()).count() == 0


def test_product_equals_dense_product():
    rng = np.random.default_rng(5)
    dense_a, dense_b = rng.integers(0, 3, (9, 7)), rng.integers(0, 3, (7, 8))

    def csr(m):
        row, column = np.nonzero(m)
        return sparse.Csr(np.searchsorted(row, np.arange(len(m) + 1)), column, m[row, column], m.shape[1])

    for most in (1, 10, 1000):
        product = np.zeros((9, 8), dtype=int)
        for row, column, value in sparse.row_products(csr(dense_a), csr(dense_b), most):
            product[row, column] += value
        assert (product == dense_a @ dense_b).all()
    back = sparse.transpose(csr(dense_a))
    assert (back.rows.tolist(), back.indices.tolist()) == tuple(map(list, np.nonzero(dense_a.T)))
