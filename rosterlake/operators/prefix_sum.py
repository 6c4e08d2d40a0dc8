"""Running totals per key that do not need a whole key in one task."""

from pyspark.sql import Window
from pyspark.sql import functions as F

BLOCK = 4096


def add_sum_before(frame, key, position, value, name, block=BLOCK):
    """Sum of `value` over the earlier positions of the same key, 0 for the first.

    position: whole numbers, unique per key. Each key is cut into blocks of
    positions: blocks are summed before the shuffle, their totals run over the key,
    and only the rows of one block meet in a window.
    """
    keys = [key, "_block"]
    cut = frame.withColumn("_block", F.floor(F.col(position) / F.lit(block)))
    earlier_rows = Window.partitionBy(*keys).orderBy(position).rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier_blocks = Window.partitionBy(key).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = cut.groupBy(*keys).agg(F.sum(value).alias("_total"))
    offsets = totals.select(
        *keys, F.coalesce(F.sum("_total").over(earlier_blocks), F.lit(0)).alias("_offset")
    )
    within = cut.withColumn("_within", F.coalesce(F.sum(value).over(earlier_rows), F.lit(0)))
    return (
        within.join(offsets, keys)
        .withColumn(name, F.col("_offset") + F.col("_within"))
        .drop("_block", "_within", "_offset")
    )
