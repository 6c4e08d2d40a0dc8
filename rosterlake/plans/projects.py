"""The project dimension and its bench row."""

from pyspark.sql import functions as F

from rosterlake.constants import BENCH_PROJECT, BENCH_PROJECT_ID
from rosterlake.schemas import PROJECTS


def with_bench(projects):
    """Add the sentinel row that stands for time without a client project."""
    bench = projects.sparkSession.createDataFrame([BENCH_PROJECT], PROJECTS)
    return projects.unionByName(bench)


def client_projects(projects):
    return projects.filter(F.col("project_id") != BENCH_PROJECT_ID).select(
        "project_id", "client_country"
    )
