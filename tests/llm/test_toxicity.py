"""What the toxicity operator holds of its texts, and what it hands on."""

from pyspark.sql import functions as F

from rosterlake.llm import toxicity
from tests.llm.test_llm import DOCS, prose


def test_equal_readings_are_kept_once():
    known, texts = {}, [" ".join(prose(seed, 200)) for seed in range(20)]
    for text in texts:
        assert toxicity.features(text, {}, known) == toxicity.features(text, {})
    assert len(known) > 1000
    assert len({id(reading) for reading in known.values()}) == 1


def test_other_columns_pass_unchanged(spark):
    """A long beyond 2^53 beside a null is no double on its way."""
    docs = [(i, " ".join(prose(i, 40) + (["blockhead"] * 3 if i % 4 == 0 else ["friend"])), "en", "a", 2**53 + i if i % 3 else None)
            for i in range(120)]
    frame = spark.createDataFrame([*docs, (None, None, None, None, None)], DOCS)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)], "doc_id bigint, toxic int")
    model = toxicity.train(frame, labels)
    assert model[0]
    out = toxicity.score(frame, model).where(F.col("doc_id").isNotNull()).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in out] == docs
    kept = toxicity.without_toxic(frame, labels)
    assert kept.schema == frame.schema
