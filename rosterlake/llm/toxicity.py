"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Learns from at most SAMPLE labelled rows outside the held-out fold, the least by a hash of
doc_id. The lexicon holds the words that mark toxic texts among them, at most LEXICON. Features are rates and
counts of lexicon words, nearness to second-person words, capitals, punctuation and
obfuscated spellings. Two thirds of the sample grow the trees, the rest calibrates.

Null texts count as empty and are scored. Repeated rows are scored alike. Without labels of
both classes every score is the share of toxic ones (0 if there are none). Other columns
of the documents are kept; held_out, score and predicted are replaced.
"""

import math
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import stored, table, words

SAMPLE = 20000
LEXICON = 400
FOLDS = 5
KNOWN = 200000  # tokens a task remembers
BATCH = 512  # sample rows that a task takes at once
SAMPLE_TASKS = 6

# Second-person words of the four languages, and spellings of letters.
SECOND_PERSON = frozenset(("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr",
                 "euch", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "usted", "ti", "tus", "vosotros"))
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": ""})

_EDGE = regex.compile(r"^[^\p{L}\p{N}@$]+|[^\p{L}\p{N}]+$")
_DISGUISED = regex.compile(r"\p{L}[0-9@$!*.\-_]+\p{L}")
_SHOUT = re.compile(r"[!?]{2,}|([^\W\d_])\1{2,}")


def _reading(token, lexicon):
    """What one token says, whatever its text: word, weight, and its counts. A plain token's word is left out."""
    word = _EDGE.sub("", token).lower()
    weight, disguised = lexicon.get(word), False
    if weight is None and _DISGUISED.search(token):
        disguised = True
        folded = word.translate(LEET).replace(".", "").replace("-", "").replace("_", "")
        weight, word = lexicon.get(folded), folded
    letters = sum(c.isalpha() for c in token)
    capitals = sum(c.isupper() for c in token)
    marks = token.count("!") + token.count("?")
    plain = weight is None and not disguised and word not in SECOND_PERSON
    counts = letters, capitals, marks, len(_SHOUT.findall(token))
    return plain, None if plain else word, weight, disguised, word in SECOND_PERSON, counts


def features(text, lexicon, known=None):
    """The dense features of one text; `known` keeps readings of tokens between texts."""
    text, known = text or "", {} if known is None else known
    raw = text.split()
    n = max(len(raw), 1)
    weights, places, second, disguised, hidden, seen = [], [], [], 0, 0, set()
    letters = capitals = marks = shouts = 0
    for place, token in enumerate(raw):
        reading = known.get(token)
        if reading is None:
            if len(known) >= KNOWN:
                known.clear()
            reading = _reading(token, lexicon)
            # Nearly all tokens are plain and read alike, so equal readings are kept once.
            reading = known[token] = known.setdefault(reading, reading)
        plain, word, weight, changed, person, counts = reading
        letters += counts[0]
        capitals += counts[1]
        marks += counts[2]
        shouts += counts[3]
        if plain:
            continue
        if weight is not None:
            weights.append(weight)
            places.append(place)
            seen.add(word)
            hidden += changed
        disguised += changed
        if person:
            second.append(place)
    near = 0
    if second and places:
        at, persons = np.array(places), np.array(second)
        after = np.searchsorted(persons, at)
        right = persons[np.minimum(after, len(persons) - 1)]
        left = persons[np.maximum(after - 1, 0)]
        near = int((np.minimum(np.abs(right - at), np.abs(left - at)) <= 5).sum())
    return [
        len(weights) / n, sum(weights) / n, float(len(weights)), float(sum(weights)),
        float(len(seen)), max(weights, default=0.0), near / n, float(near), len(second) / n,
        capitals / max(letters, 1), marks / max(len(text), 1), shouts / n,
        disguised / n, hidden / n, math.log1p(len(raw)),
    ]


def learnt_lexicon(train, size=LEXICON):
    """Words by the log ratio of the texts of either label that hold them, smoothed; at most `size`."""
    totals = {row["toxic"]: row["count"] for row in train.groupBy("toxic").count().collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    held = train.select("toxic", F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    counted = held.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    ratio = F.log(((F.col("bad") + 0.5) / (bad + 1.0)) / ((F.col("good") + 0.5) / (good + 1.0)))
    # A word must stand out beyond chance: the ratio times the texts it was seen in.
    strong = counted.withColumn("weight", ratio).where(
        (F.col("bad") >= max(2, bad * 0.01)) & (F.col("weight") > 0.9)).withColumn(
        "strength", F.col("weight") * F.col("bad"))
    top = strong.orderBy(F.desc("strength"), "word").limit(size).collect()
    return {row["word"]: float(row["weight"]) for row in top}


def _featured(frame, lexicon, name):
    """The frame with the features of its texts. Batches stay Arrow; a task makes Python objects of one text at a time."""

    def build(batches):
        known = {}
        for batch in batches:
            found = [features(text.as_py(), lexicon, known) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.float64()))],
                                             [*batch.schema.names, name])

    schema = type(frame.schema)([*frame.schema.fields]).add(name, ArrayType(DoubleType()))
    return frame.mapInArrow(build, schema)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))


def train(docs, labels, sample=SAMPLE):
    """Lexicon, trees and calibration; or only the share of toxic labels if one class is missing."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(sample)
    bounded = stored(docs.select("doc_id", "text").join(rows, "doc_id").dropDuplicates(["doc_id"]))
    counts = bounded.agg(F.count("*"), F.sum("toxic")).first()
    if not counts[0] or counts[1] in (0, counts[0]):
        return None, (counts[1] or 0) / max(counts[0], 1), None
    lexicon_rows = bounded.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) != 2)
    lexicon = learnt_lexicon(lexicon_rows)
    # The trees take many small jobs over these few numbers, so few tasks hold them.
    featured = _featured(bounded, lexicon, "features").select("doc_id", "toxic", array_to_vector("features").alias("features"))
    featured = stored(featured.repartition(SAMPLE_TASKS, "doc_id"), batch=BATCH)
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3))
    grown = GBTClassifier(labelCol="toxic", maxIter=20, maxDepth=3, stepSize=0.3, seed=1).fit(
        featured.where(part != 2))
    judged = grown.transform(featured.where(part == 2)).select(
        "toxic", vector_to_array("probability")[1].alias("probability"))
    if judged.agg(F.count_distinct("toxic")).first()[0] < 2:
        return lexicon, grown, None
    calibrated = IsotonicRegression(labelCol="toxic", featuresCol="probability").fit(
        judged.select(F.col("toxic").cast("double").alias("toxic"), "probability"))
    return lexicon, grown, calibrated


def score(docs, model):
    """Adds held_out, score and predicted to every document."""
    lexicon, grown, calibrated = model
    kept = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    out = docs.select(*kept)
    if lexicon is None:
        scored = out.withColumn("score", F.lit(float(grown)))
    else:
        featured = _featured(out, lexicon, "_features")
        if grown.getFeaturesCol() != "_vector":
            grown = grown.copy()
            for setter, name in ((grown.setFeaturesCol, "_vector"), (grown.setPredictionCol, "_prediction"),
                                 (grown.setRawPredictionCol, "_raw"), (grown.setProbabilityCol, "_probabilities")):
                setter(name)
        scored = grown.transform(featured.withColumn("_vector", array_to_vector("_features"))).withColumn(
            "_probability", vector_to_array("_probabilities")[1])
        if calibrated is None:
            scored = scored.withColumn("score", F.col("_probability"))
        else:
            calibrated = calibrated.copy()
            calibrated.setFeaturesCol("_probability").setPredictionCol("score")
            scored = calibrated.transform(scored)
    return scored.select(*kept, held_out().alias("held_out"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).drop("text")


def without_toxic(docs, labels):
    return score(docs, train(docs, labels)).where(F.col("predicted") == 0).select(*docs.columns)
