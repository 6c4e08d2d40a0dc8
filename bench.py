"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data
and cores. Each query runs twice in one session, its result written to the noop
sink; the better run counts. The bronze tables are derived from the test tables and
written beforehand, untimed, so that the times are those of the operators. Queries
that write a folder per day are left out: they time the local file system.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from rosterlake.session import work_folder  # noqa: E402
from verification.lens import StoredLens  # noqa: E402
from verification.queries import OVER_LENS  # noqa: E402

HEADLINE = [
    "gold_timesheets_enriched", "gold_totals", "gold_employees", "silver_employees",
    "silver_timesheets", "profile_hours", "profile_currencies", "profile_entry_types",
    "profile_uuid_uniqueness", "profile_batches", "dim_date", "fx_from_json",
    "fx_carry_forward", "schedule_asof", "build_schedule", "employee_day_spine",
    "rate_card_lookup", "non_billable_chance", "fact_metrics", "fact_quarantine",
    "apply_corrections", "correction_lineage", "natural_key_duplicates",
    "not_null_report", "expectation_report",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    lens = StoredLens(spark, folder, work_folder(spark))

    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(2):
            begin = time.perf_counter()
            OVER_LENS[name](lens).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        timings[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
