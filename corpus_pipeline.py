"""Training-text pipeline over the documents table.

Toxic documents go, one document of each near-duplicate class stays, documents with
benchmark passages go, personal data gets surrogates, and the sources are mixed. Every
stage is written as Parquet in the shared work folder and read again by the next.
The last stage adds size, source_size, target, finish and taken, and keeps documents
of which the mix takes words. An empty table passes through empty.
"""

from pyspark.sql import functions as F

from rosterlake.llm.common import stored, table
from rosterlake.llm.decontamination import without_contaminated
from rosterlake.llm.mixing import mix
from rosterlake.llm.near_duplicates import one_of_each
from rosterlake.llm.surrogates import distinct_surrogates, surrogate_key
from rosterlake.llm.toxicity import without_toxic


def toxicity(spark, docs, sf_dir):
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    return one_of_each(docs)


def decontamination(spark, docs, sf_dir):
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark, docs, sf_dir):
    """Surrogates may change the text's length; n_chars follows."""
    marked = distinct_surrogates(docs, surrogate_key(spark))
    return marked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark, docs, sf_dir):
    return mix(docs).where("taken > 0")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing", mixing),
]

# Trained trees, alignment and keyed surrogates are beyond SQL; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
