"""The filter audit against filters applied document by document."""

import random
from itertools import permutations

import numpy as np

from rosterlake.llm import filter_audit

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"


def plainly(docs, labels):
    """Every order applied in turn to every document."""
    texts = {i: (t or "") for i, t, _ in docs}

    def failures(i, text):
        words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
        capitals = sum("A" <= c <= "Z" for c in text)
        return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * capitals > 2 * len(text), "D": any(c in "#$%&*|" for c in text),
                "E": any(j < i and t == text for j, t in texts.items())}

    rows = {}
    for part in {s or "" for _, _, s in docs}:
        own = {i: failures(i, t or "") for i, t, s in docs if (s or "") == part}
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            alive = set(own)
            for step, f in enumerate(order, 1):
                gone = {i for i in alive if own[i][f]}
                failing = {i for i in own if own[i][f]}
                alone = {i for i in failing if sum(own[i].values()) == 1}
                shapley[f] += len(gone)
                alive -= gone
                rows[part, "".join(order), step] = [
                    len(alive), len(gone), len(failing - gone), len(alone),
                    sum(labels.get(i, (0, 0))[0] for i in gone), sum(labels.get(i, (0, 0))[1] for i in gone)]
        for (p, order, step), row in rows.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in rows.items()}


def test_audit_equals_filters_applied_in_turn(spark):
    rng = random.Random(4)
    texts = [None, "", "a b\tc\nd"]
    for _ in range(40):
        words = [rng.choice(["a", "b", "cc", "Dd"]) if rng.random() < .6 else f"w{rng.randrange(400)}"
                 for _ in range(rng.randrange(150, 260))]
        texts.append(" ".join(words) + rng.choice(["", "", " #", " |"]))
    texts += texts[:12]
    docs = [(i, t, rng.choice(["x", "y", None, ""])) for i, t in enumerate(texts)]
    labels = {i: (rng.randrange(2), rng.randrange(2)) for i in range(0, len(docs), 2)}
    frame = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in docs], DOCS)
    known = spark.createDataFrame([(i, q, t) for i, (q, t) in labels.items()], LABELS)
    found = filter_audit.audit(frame, known.unionAll(known)).collect()
    assert len(found) == 3 * 600
    assert {(r[0], r[1], r[2]): tuple(r[3:]) for r in found} == plainly(docs, labels)


def test_rows_without_id_neither_fail_nor_make_others_fail(spark):
    frame = spark.createDataFrame([(None, "a", "x"), (None, "a", "x"), (7, "a", "x"), (7, "a", "x"), (8, "a", "x")],
                                  "doc_id bigint, text string, source string")
    frame = frame.selectExpr("*", "1 AS mask", "'z' AS part", "'q' AS digest", "3 AS first", "5 AS good")
    found = filter_audit.audit(frame, spark.createDataFrame([], LABELS))
    assert {r["removed"] for r in found.collect() if r["filter_order"] == "EABCD" and r["step"] == 1} == {1}


def test_empty_table_and_very_long_text(spark):
    empty = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([(0, 1, None), (None, 1, 1)], LABELS)
    assert filter_audit.audit(empty, labels).count() == 0
    long = spark.createDataFrame([(0, "Ab " * 500_000, "en", "s", 0)], DOCS)
    found = filter_audit.audit(long, labels).where("filter_order = 'BCADE'").orderBy("step").collect()
    assert [(r["kept"], r["removed"], r["redundant"], r["good_lost"]) for r in found] == [
        (0, 1, 0, 1), (0, 0, 1, 0), (0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0)]


def test_walk_stores_every_subset():
    counts = np.random.default_rng(1).integers(0, 9, (3, 32, 2))
    states = filter_audit.gray_walk(counts, 5)
    for active in range(32):
        assert (states[:, active] == counts[:, [m for m in range(32) if not m & active]].sum(axis=1)).all()
