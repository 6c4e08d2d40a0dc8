"""Benchmark decontamination by spaced seeds.

A seed is a mask over SPAN neighbouring words; only its marked words are hashed, so that a
changed word under a gap leaves the hash alone. Hashes of benchmark items and documents
are joined, and each hit is verified on its diagonal: around it, in one of the windows of
WINDOW words that hold it (the whole item, if that is shorter), a share of SHARE of the
words must agree place by place.

Null and empty texts have no hits. Items shorter than SPAN words hold no seed and report
nothing. Repeated rows share their doc_id's result, a null doc_id has none. Extra
columns of the documents are kept; `contaminated` and `items` are replaced.
"""

from pyspark.sql import functions as F

from .common import stored, table, words

MASKS = ("1101100101101", "1011010011011", "1110010110101")
SPAN = 13
WINDOW = 24
SHARE = 0.8


def _seeds(tokens, mask):
    """Hashes of a mask at every position of the array."""
    picked = [i for i, mark in enumerate(mask) if mark == "1"]
    places = F.when(F.size(tokens) >= len(mask), F.sequence(F.lit(0), F.size(tokens) - len(mask))).otherwise(
        F.array().cast("array<int>"))
    return F.transform(places, lambda at: F.xxhash64(F.lit(mask), *[F.get(tokens, at + i) for i in picked]))


def _exploded(frame, key, masks):
    """One row per mask and position: key, position and seed."""
    every = F.array(*[_seeds(F.col("_words"), mask) for mask in masks])
    rows = frame.select(key, F.explode(every).alias("_mask"))
    return rows.select(key, F.posexplode("_mask").alias("_at", "_seed"))


def contaminated_items(docs, benchmark, masks=MASKS, window=WINDOW, share=SHARE):
    """Verified pairs: doc_id, item_id and the best share of agreeing words."""
    hashed = F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("_words")
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    train = texts.select("doc_id", hashed)
    test = benchmark.where(F.col("item_id").isNotNull()).select("item_id", hashed)
    wanted = _exploded(test, "item_id", masks).select("item_id", F.col("_at").alias("_item_at"), "_seed")
    # The benchmark is broadcast only below Spark's threshold.
    hits = (_exploded(train, "doc_id", masks).join(wanted, "_seed")
            .select("doc_id", "item_id", "_at", "_item_at").distinct())
    hits = stored(hits.groupBy("doc_id").agg(F.collect_set(F.struct("item_id", "_at", "_item_at")).alias("_hits")))
    # Hits grow with the documents, so they are never broadcast. Texts are shuffled, shorter than their words' hashes, and
    # only those with hits are split again.
    found = texts.hint("merge").join(hits, "doc_id").select("doc_id", hashed, "_hits").select(
        "doc_id", "_words", F.explode("_hits").alias("_hit"))
    span = len(masks[0])
    wide = found.select(
        "doc_id", "_hit.*",
        F.when(F.col("_hit._at") < window, F.col("_hit._at")).otherwise(F.lit(window)).alias("_left"),
        F.slice("_words", F.greatest(F.lit(1), F.col("_hit._at") + 1 - window),
                F.lit(2 * window + span)).alias("_near"),
    )
    sides = wide.join(test.withColumnRenamed("_words", "_item"), "item_id")
    length = F.least(F.lit(window), F.size("_item"))

    def agreeing(back):
        # Start of the window in the item, so that it holds the hit and stays inside the item.
        begin = F.greatest(F.lit(0), F.least(F.col("_item_at") - back, F.size("_item") - length))
        shift = F.col("_left") - F.col("_item_at")
        return F.size(F.filter(F.sequence(F.lit(0), length - 1), lambda i: F.coalesce(
            F.get("_near", F.when(begin + i + shift >= 0, begin + i + shift))
            == F.get("_item", begin + i), F.lit(False)))) / length

    best = F.greatest(agreeing(F.lit(0)), agreeing(F.lit((window - span) // 2)), agreeing(F.lit(window - span)))
    return (sides.withColumn("share", best).where(F.col("share") >= share)
            .groupBy("doc_id", "item_id").agg(F.max("share").alias("share")))


def op4_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pairs = contaminated_items(docs, table(spark, sf_dir, "benchmark"))
    found = pairs.groupBy("doc_id").agg(
        F.sort_array(F.collect_set("item_id")).alias("items"), F.max("share").alias("share"))
    return docs.select("doc_id").join(found, "doc_id", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"), "share")


def without_contaminated(docs, benchmark):
    pairs = contaminated_items(docs.select("doc_id", "text"), benchmark)
    gone = stored(pairs.select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
