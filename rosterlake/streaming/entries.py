"""Raw entries from a stream into the timesheet fact.

The same steps as the batch load for entries that arrive as files and already
name their project: metrics, range check, key check, one append per micro-batch.
"""

import hashlib

from pyspark.sql import functions as F

from rosterlake.operators.checks import with_reason
from rosterlake.operators.keys import fingerprint, stored_on_days
from rosterlake.plans.facts import BASE, complete, fact_metrics
from rosterlake.plans.load import CONTENT, FACT, KEY, QUARANTINE, keyed_originals, new_batch, newly_set_aside, part
from rosterlake.plans.load import UNFINISHED, parts_of, same_key, stage_parts
from rosterlake.session import tidy

STAGING = "staging_stream_"


def read_entries(spark, folder, schema, files_per_trigger=None):
    """A stream of the files in a folder; `arrival` orders its rows by file and place in the file."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    place = F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.row_index")
    return reader.parquet(folder).select("*", place.alias("arrival"))


def decide(judged, stored):
    """Judged rows of a micro-batch against each other and the stored facts: what is new, with its reason.

    The first row in range of a key is the fact, however long ago it came. A later row that says the same is
    dropped, one that says something else is a conflict. The fact table is the memory of the
    stream: it forgets nothing, and only the days that occur are read. So the outcome depends on
    the order of arrival alone, not on how the files fall into micro-batches.
    """
    return complete(decide_base(judged, stored), ["reason"])


def decide_base(judged, stored):
    """Like decide, of and with the columns of BASE only, and the reason; judged has arrival too."""
    said = judged.withColumn("_said", fingerprint(*CONTENT))
    told = said.groupBy(*BASE, "reason", "_said").agg(F.min("arrival").alias("arrival"))
    fit = F.col("reason").isNull()
    first = told.filter(fit).groupBy(*[F.col(k).alias(f"_{k}") for k in KEY]).agg(
        F.min(F.struct("arrival", "_said")).getField("_said").alias("_first"))
    met = told.drop("arrival").join(first, same_key(), "left").drop("_emp_id", "_work_date")
    known = keyed_originals(
        stored_on_days(judged, stored, ["timesheet_id", "emp_id", "entry_type", *CONTENT]),
        fingerprint(*CONTENT).alias("_stored"))
    met = met.join(known, same_key(), "left")
    leading = F.coalesce("_stored", "_first")
    new = ~fit | F.col("_stored").isNull() | (F.col("_said") != F.col("_stored"))
    return met.filter(new).select(*BASE, F.when(~fit, F.col("reason")).when(
        F.col("_said") != leading, "conflict").alias("reason"))


def load_entries(lake, entries, checkpoint, trigger=None):
    """Start the load of a streaming frame of entries (see facts.fact_metrics).

    entries may have a column `arrival` that orders them (see read_entries); without it, rows of one
    micro-batch go by content. Deliveries may repeat, and a replayed micro-batch appends nothing twice. Rows
    out of range and rows that contradict the fact are set aside, once each, and the stream goes on.
    A micro-batch is staged under a name of its own; what a lost run left staged is dropped, as
    the stream replays it.
    """
    lake.create(FACT)
    batch_id, load_timestamp = new_batch()
    prefix = f"{STAGING}{hashlib.sha256(checkpoint.encode()).hexdigest()[:12]}_"
    for left in lake.tables(prefix):
        lake.drop(left)

    def append(rows, number):
        if "arrival" not in rows.columns:
            rows = rows.withColumn("arrival", fingerprint(*rows.columns))
        judged = with_reason(fact_metrics(rows, f"{batch_id}-{number}", load_timestamp, keep=["arrival"]))
        staging = f"{prefix}{number}"
        parts = parts_of(rows)

        def decided(number):
            return decide_base(part(judged, number, parts, KEY), part(lake.read(FACT), number, parts, KEY))

        lake.drop(UNFINISHED + staging)
        stage_parts(lake, decided, parts, staging)
        with tidy(lake.spark):
            staged = lake.read(staging)
            rejected = complete(newly_set_aside(
                staged.filter("reason IS NOT NULL"), lake.read_or_empty(QUARANTINE)), ["reason"])
            # set aside first: once a fact is stored, a replay no longer tells its repeats from it
            if not rejected.isEmpty():
                lake.append(rejected, QUARANTINE)
            facts = staged.filter("reason IS NULL").select(*BASE)
            lake.append(facts.withColumn("entry_type", F.lit("original")), FACT)
        lake.drop(staging)

    return (
        entries.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
