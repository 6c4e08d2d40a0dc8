"""Exact top-k by inner product, term at a time.

Queries come in blocks of at most QUERY_BLOCK rows, sent to every task; a task keeps its
candidates in blocks as postings (dimension: rows and weights), and each query's
non-zero dimensions scatter their weighted postings into a dense score array, from which
the block's best are selected. The best of all blocks are merged by score and vec_id.

Vectors that are null or hold null or non-finite components take no part, nor rows with a null
vec_id. Vectors shorter than others count as zero in the missing places. Ties go to the smaller vec_id. Repeated vec_ids are rows of
their own as candidates; a query skips all rows with its own vec_id. Empty tables give an empty result.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import stored, table

QUERY_BLOCK = 2048
K = 20
SCALE = 64
MODULUS = 20


def usable(vectors):
    """Vectors in whole numbers, without those that take no part."""
    sound = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & F.forall("embedding", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return vectors.where(sound).select("vec_id", F.transform(
        "embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("whole"))


def _scores(ids, vectors, k):
    def run(batches):
        for batch in batches:
            rows = batch["vec_id"].to_numpy()
            width = max((len(v) for v in batch["whole"]), default=0)
            dense = np.zeros((len(rows), width), dtype=np.int64)
            for i, v in enumerate(batch["whole"]):
                dense[i, :len(v)] = v
            postings = {}
            for term in range(width):
                at = np.flatnonzero(dense[:, term])
                postings[term] = (at, dense[at, term])
            out = []
            for query, vector in zip(ids, vectors):
                scores = np.zeros(len(rows), dtype=np.int64)
                for term in np.flatnonzero(vector[:width]):
                    at, weights = postings[term]
                    scores[at] += weights * vector[term]
                others = np.flatnonzero(rows != query)
                if len(others) > k:
                    # All rows that reach the k-th score stay, so that ties are cut by vec_id.
                    kth = np.partition(scores[others], len(others) - k)[len(others) - k]
                    others = others[scores[others] >= kth]
                best = others[np.lexsort((rows[others], -scores[others]))][:k]
                out.append(pd.DataFrame({"query_id": query, "vec_id": rows[best], "score": scores[best]}))
            if out:
                yield pd.concat(out)
    return run


def search(vectors, queries, k=K, query_block=QUERY_BLOCK):
    """The k best other rows of each query: query_id, rank, vec_id and score."""
    candidates = stored(vectors)
    ordered = queries.select("vec_id", "whole").dropDuplicates(["vec_id"]).orderBy("vec_id")
    schema = "query_id long, vec_id long, score long"
    found, last = None, None
    while True:
        block = (ordered if last is None else ordered.where(F.col("vec_id") > last)).limit(query_block).collect()
        if not block:
            break
        ids = [r["vec_id"] for r in block]
        rows = [np.array(r["whole"], dtype=np.int64) for r in block]
        part = stored(candidates.mapInPandas(_scores(ids, rows, k), schema))
        found = part if found is None else found.unionByName(part)
        last = ids[-1]
    if found is None:
        found = candidates.sparkSession.createDataFrame([], schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op8_topk_search(spark, sf_dir):
    vectors = usable(table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.where(F.col("vec_id") % MODULUS == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS whole FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.whole, c.whole), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
