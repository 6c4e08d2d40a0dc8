"""Monthly exchange-rate documents on storage."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.functions.numbers import usd_per_unit
from rosterlake.schemas import FX_DOCUMENT


def read_documents(spark, path):
    """JSON lines: {"fx_month": "2024-01-01", "rates": {"PKR": 278.1, ...}}."""
    return spark.read.schema(FX_DOCUMENT).json(path)


def read_dated_documents(spark, path):
    """One JSON document per file, the month in the name of the file or of its folder: 2024-01-01.json.

    `unreadable` holds the text of a file that is no such document. Its rates are null, so its month
    counts as not fetched, like a month without a file, and the load goes on; see document_faults.
    """
    shape = T.StructType([f for f in FX_DOCUMENT.fields if f.name != "fx_month"])
    named = (
        spark.read.schema(shape.add("unreadable", T.StringType()))
        .options(multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="unreadable")
        .json(path)
        .select("rates", "unreadable", F.col("_metadata.file_path").alias("file"))
    )
    month = F.regexp_extract("file", r"(\d{4}-\d{2}-\d{2})(?:\.json|/[^/]*)$", 1).try_cast("date")
    return named.select(month.alias("fx_month"), "rates", "unreadable", "file")


def document_faults(documents):
    """The documents of read_dated_documents that do not count as fetched, each with the reason."""
    reason = (
        F.when(F.col("fx_month").isNull(), "no month in the name")
        .when(F.col("unreadable").isNotNull(), "not a JSON document")
        .when(F.col("rates").isNull(), "no rates")
        .when(~is_complete(F.col("rates")), "a rate without reciprocal")
    )
    return documents.select("fx_month", "file", reason.alias("reason")).filter("reason IS NOT NULL")


def is_complete(rates):
    """A document counts as fetched only if every rate has a reciprocal."""
    return rates.isNotNull() & F.forall(
        F.map_values(rates), lambda r: F.coalesce(r != 0, F.lit(False))
    )


def explode_rates(documents, *keep):
    """One row per currency of each complete document, as USD per unit."""
    return (
        documents.filter(is_complete(F.col("rates")))
        .select(*keep, F.explode("rates").alias("currency_code", "units_per_usd"))
        .select(*keep, "currency_code", usd_per_unit(F.col("units_per_usd")).alias("rate_to_usd"))
    )
