"""Classes of near duplicates against all pairs compared, on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import near_duplicates
from tests.conftest import plan

DOCS = "doc_id bigint, text string"


def plain_classes(texts):
    """Least place of each text's class, by comparing all pairs."""
    tokens = [np.array([hash(w) & 0x7FFFFFFF for w in near_duplicates._WORD.findall((t or "").lower())], dtype=np.int32)
              for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(tokens[i]) and len(tokens[j]) and near_duplicates.similarity(tokens[i], tokens[j]) >= 0.8:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def changed(rng, text, share):
    return [f"n{rng.randrange(10 ** 6)}" if rng.random() < share else w for w in text]


@pytest.fixture(scope="module")
def texts():
    """Families of near copies, unlike texts that share one or two long passages, excerpts, repeated lines."""
    rng = random.Random(3)
    passage, other, long = words(rng, 120), words(rng, 100), words(rng, 900)
    made = []
    for _ in range(12):
        base = words(rng, 150)
        made += [base] + [changed(rng, base, 0.04) for _ in range(3)]
    for i in range(60):
        own = words(rng, 90)
        made.append(own[:40] + passage + own[40:] if i % 2 else other + own + passage)
        if i % 5 == 0:
            made.append(changed(rng, made[-1], 0.04))
    made += [long] + [long[i * 40:i * 40 + 200] for i in range(15)] + [["line", "again"] * n for n in (30, 33, 60, 90)]
    rng.shuffle(made)
    return [" ".join(m) for m in made] + ["", None, "one", "One", "two words"]


def test_classes_equal_those_of_all_pairs(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(4)
    rows = near_duplicates.near_duplicate_classes(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == dict(enumerate(plain_classes(texts)))


def test_rows_with_null_or_shared_ids_are_told_apart(spark):
    rng = random.Random(4)
    a, b, c = (" ".join(words(rng, 100)) for _ in range(3))
    docs = spark.createDataFrame([(1, a), (1, b), (None, a), (None, c), (None, c), (2, ""), (2, "")], DOCS)
    docs = docs.withColumns({"_row": F.lit(7), "row": F.lit("r"), "node": F.lit(1), "keys": F.lit(2), "hub": F.lit(3)})
    kept = near_duplicates.one_of_each(docs)
    assert kept.columns == docs.columns and kept.select("_row").distinct().count() == 1
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == sorted(
        [(1, a), (1, b), (0, c), (2, ""), (2, "")])
    assert near_duplicates.one_of_each(docs.limit(0)).isEmpty()


@pytest.mark.parametrize("share, least", [(0.05, 0.99), (0.1, 0.95), (0.15, 0.8)])
def test_recall_of_pairs_by_share_of_changed_words(share, least):
    """Words changed at random; with five-word k-mers the share of equal k-mers falls with its fifth power."""
    rng = random.Random(5)
    found = tried = 0
    while tried < 150:
        base = [rng.randrange(10 ** 6) for _ in range(200)]
        other = [rng.randrange(10 ** 6) if rng.random() < share else w for w in base]
        a, b = (np.array(t, dtype=np.int32) for t in (base, other))
        if near_duplicates.similarity(a, b) >= 0.8:
            tried += 1
            keys = [near_duplicates.sketch(near_duplicates._kmers(t.astype(np.uint64))) for t in (a, b)]
            found += bool((keys[0] == keys[1]).any())
    assert found / tried >= least


def test_rounds_shuffle_pairs_only(spark, no_broadcast, texts, monkeypatch):
    """However few or many the pairs are, the tokens of all rows stay where they lie."""
    plans, write = [], near_duplicates.stored
    monkeypatch.setattr(near_duplicates, "stored", lambda frame, *more: plans.append(plan(frame)) or write(frame, *more))
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(4)
    assert near_duplicates.near_duplicate_classes(docs).count() == len(texts)
    rounds = [p for p in plans if "_verified" in p]
    assert rounds and {p.count("Exchange hashpartitioning") for p in rounds} == {2}
    assert spark.catalog.listTables("default", "rosterlake_*") == []


def test_tasks_take_few_rows_at_once(spark, monkeypatch):
    most, whole = 512, near_duplicates._sketches

    def measured(batches):
        def small():
            for batch in batches:
                assert len(batch) <= most
                yield batch
        return whole(small())

    monkeypatch.setattr(near_duplicates, "_sketches", measured)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")).coalesce(1)
    assert near_duplicates.near_duplicate_classes(docs).count() == 3000
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
