"""Weighted fair queueing over sources.

Each document's copies get a virtual finish time, the cumulative words of its source
(in a seeded shuffle, copy after copy of the source) divided by the source's target. The
documents are range-sorted by finish time and truncated at the total budget. The targets sum to
the budget, so it is spent at virtual time 1 in every source at once; a copy that is under way then
is cut, which keeps each source within a word of its target, however long its documents are.

Null text has no words and is never taken. Null sources form one source, the last. Equal
rows are interchangeable. An empty table gives an empty mix. Columns named like an output
column are replaced; all others are kept.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import table

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized, weights=WEIGHTS, max_repeats=MAX_REPEATS):
    """One row per source: source_size and target. The window is as long as the list of sources."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").isNull(), "source")
    place = (F.row_number().over(ordered) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    caps = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeats)
    caps = caps.withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", "source").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    filled = caps.select(
        "*",
        F.sum("source_size").over(whole).alias("total"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("left_weight"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("full"),
    )
    level = (F.col("total") - F.col("full")) / F.col("left_weight")
    level = F.min(F.when(level <= F.col("ratio"), F.struct("ratio", level.alias("level")))).over(whole)["level"]
    target = F.least(F.col("cap").cast("double"), level * F.col("weight"))
    return filled.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def queue(sized, targets, seed):
    """Adds the place in the source's queue: words up to and including the document."""
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    keyed = sized.withColumn("_key", F.md5(F.concat(F.lit(f"{seed}:"), text_id)))
    keyed = keyed.withColumn("_block", F.conv(F.substring("_key", 1, 3), 16, 10).cast("int"))
    sums = keyed.groupBy("source", "_block").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("_source"), F.col("_block").alias("_start_block"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
    ).join(targets.withColumnRenamed("source", "_source2"), F.col("_source").eqNullSafe(F.col("_source2")))
    inside = (Window.partitionBy("source", "_block").orderBy("_key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, 0))
    placed = keyed.withColumn("_inside", F.sum("size").over(inside))
    return placed.join(
        starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_block") == F.col("_start_block"))
    ).withColumn("_end", F.col("_start") + F.col("_inside")).drop(
        "_source", "_source2", "_start_block", "_start", "_inside", "_block")


def mix(docs, weights=WEIGHTS, max_repeats=MAX_REPEATS, seed=7, text="text"):
    """Adds size, source_size, target, finish and taken to every document, in order of finish."""
    sized = docs.drop("size", "source_size", "target", "finish", "taken").withColumn("size", word_count(F.col(text)))
    targets = source_targets(sized.select("source", "size"), weights, max_repeats)
    queued = queue(sized, targets, seed)
    budget = F.round("target").cast("long")
    copies = [F.least(F.col("size"), F.greatest(F.lit(0), budget - (F.col("_end") - F.col("size"))
                                                - F.col("source_size") * copy)) for copy in range(max_repeats)]
    finish = F.when(F.col("target") > 0, F.col("_end") / F.col("target"))
    return (queued.withColumn("finish", finish).withColumn("taken", reduce(lambda a, b: a + b, copies).cast("long"))
            .drop("_key", "_end").orderBy("finish", "source", "doc_id"))


def op5_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "finish", "taken")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('7:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT a.source, a.source_size, a.weight, 3 * a.source_size / a.weight AS ratio,
         ((SELECT sum(source_size) FROM sources)
           - coalesce((SELECT sum(3 * b.source_size) FROM sources b
                       WHERE 3 * b.source_size / b.weight < 3 * a.source_size / a.weight), 0))::DOUBLE
         / (SELECT sum(b.weight) FROM sources b
            WHERE 3 * b.source_size / b.weight >= 3 * a.source_size / a.weight) AS level
  FROM sources a
), targets AS (
  SELECT source, source_size,
         least((3 * source_size)::DOUBLE,
               weight * (SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio)) AS target
  FROM levels
), queued AS (
  SELECT s.doc_id, s.source, s.size, s.key, t.source_size, t.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS UNBOUNDED PRECEDING)::BIGINT
           AS until
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target, until / nullif(target, 0) AS finish,
       (SELECT sum(greatest(0, least(size, round(target)::BIGINT - (until - size) - source_size * c)))
        FROM range(3) r(c))::BIGINT AS taken
FROM queued
"""
