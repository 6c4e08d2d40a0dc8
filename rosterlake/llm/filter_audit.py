"""What each of five filters removes under every order in which they can be applied.

A document's mask has a bit for each filter that it fails. Documents are counted by part
and mask, 32 cells at most, so that what follows does not grow with them. A Gray-code walk then
visits all 32 subsets of filters, toggling one filter at a time: each cell keeps the number
of active filters that it fails, and the survivors change by the cells whose number leaves or
reaches zero. Every step of every order is the difference of two of the 32 stored states.

Failure conditions: A under 200 words; B fewer than half of the words distinct; C more than 2 % of the
characters in A-Z; D a sign of ``#$%&*|``; E identical to the text of a smaller doc_id.
Null text counts as empty and fails A. Rows with a null doc_id neither fail E nor make others fail
it; rows equal in doc_id and text stand or fail together. A null source is the part ''. Labels that
repeat a doc_id count if any of them says so. An empty table has no parts and gives no rows. Other columns of the
tables are not read.
"""

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .common import stored, table

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT = 50
MAX_CAPITALS = 2
SIGNS = "[#$%&*|]"
WORD = r"[^\x20\x09-\x0D]+"
MEASURES = ("n", "good", "toxic")
SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def own_failures(text):
    """Bits of the filters that look at one text only."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    failed = [
        F.size(words) < MIN_WORDS,
        F.size(F.array_distinct(words)) * 100 < F.size(words) * MIN_DISTINCT,
        F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * MAX_CAPITALS,
        text.rlike(SIGNS),
    ]
    return sum((F.when(bad, 1 << place).otherwise(0) for place, bad in enumerate(failed)), F.lit(0))


def cells(docs, labels):
    """Counts of documents, good and toxic ones by part and mask.

    The first copy of a text is found by its hash and doc_id together, so that no join key is as
    frequent as a text is.
    """
    text = F.coalesce("text", F.lit(""))
    known = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                         F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = stored(docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"),
        own_failures(text).alias("mask")).join(known, "doc_id", "left"))
    first = marked.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return marked.join(first, ["digest", "doc_id"], "left").groupBy(
        "part", (F.col("mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).alias("mask")).agg(
            F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))


def gray_walk(counts, filters):
    """Survivors of every subset of filters.

    counts: parts x masks x measures. Returns parts x subsets x measures. The counters of
    active failures depend on the mask alone and serve all parts.
    """
    masks = np.arange(1 << filters)
    failing = np.zeros(len(masks), dtype=int)
    survivors = counts.sum(axis=1)
    states = np.empty_like(counts)
    active = 0
    states[:, active] = survivors
    for step in range(1, len(masks)):
        toggled = (step & -step).bit_length() - 1
        active ^= 1 << toggled
        hit = (masks >> toggled & 1).astype(bool)
        if active >> toggled & 1:
            survivors = survivors - counts[:, hit & (failing == 0)].sum(axis=1)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            survivors = survivors + counts[:, hit & (failing == 0)].sum(axis=1)
        states[:, active] = survivors
    return states


def steps(names, counts, filters=FILTERS):
    """All orders and steps of the given parts, from the stored states."""
    states = gray_walk(counts, len(filters))
    masks = np.arange(1 << len(filters))
    everything = len(masks) - 1
    rows = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, f in enumerate(order, 1):
            lost = states[:, before] - states[:, before | 1 << f]
            fails = counts[:, masks >> f & 1 == 1, 0].sum(axis=1)
            alone = states[:, everything ^ 1 << f, 0] - states[:, everything, 0]
            rows.append((f, "".join(filters[i] for i in order), step, states[:, before | 1 << f, 0], lost[:, 0],
                         fails - lost[:, 0], alone, lost[:, 1], lost[:, 2]))
            before |= 1 << f
    shapley = {f: sum(r[4] for r in rows if r[0] == f) for f in range(len(filters))}
    return pd.concat([pd.DataFrame({
        "part": names, "filter_order": order, "step": np.int32(step), "kept": kept, "removed": removed,
        "redundant": redundant, "unique_fails": alone, "good_lost": good, "toxic_lost": toxic, "shapley": shapley[f],
    }) for f, order, step, kept, removed, redundant, alone, good, toxic in rows])


def _walks(batches):
    for batch in batches:
        counts = np.stack([np.stack([np.array(v) for v in batch[m]]) for m in MEASURES], axis=2)
        for at in range(0, len(batch), 100):
            yield steps(batch["part"].to_numpy()[at:at + 100], counts[at:at + 100])


def audit(docs, labels):
    """One row per part, order and step."""
    wide = cells(docs, labels).groupBy("part").agg(*[
        F.array(*[F.sum(F.when(F.col("mask") == mask, F.col(m)).otherwise(0)) for mask in range(1 << len(FILTERS))])
        .alias(m) for m in MEASURES])
    return wide.mapInPandas(_walks, SCHEMA)


def op11_filter_audit(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         doc_id > min(doc_id) OVER (PARTITION BY t) AS copy
  FROM d
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
         + CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN copy THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask
), f AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, own)
), o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM f a, f b, f c, f d, f e
  WHERE a.own + b.own + c.own + d.own + e.own = 31
    AND len(list_distinct([a.own, b.own, c.own, d.own, e.own])) = 5
), s AS (
  SELECT filter_order, step, f.own,
         (SELECT coalesce(sum(g.own), 0) FROM f g
          WHERE strpos(filter_order, g.letter) < step) AS earlier
  FROM o, range(1, 6) r(step), f WHERE f.letter = substr(filter_order, step, 1)
), x AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN mask & (earlier | own) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & earlier = 0 AND mask & own > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & earlier > 0 AND mask & own > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & earlier = 0 AND mask & own > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & earlier = 0 AND mask & own > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, (SELECT filter_order, step, own, earlier::INT AS earlier FROM s) GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM x
"""
