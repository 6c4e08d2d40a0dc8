"""Catalog tables on Parquet: reads, replace and append loads, evolution, upkeep."""

import datetime as dt
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rosterlake.plans.facts import complete
from rosterlake.schemas import PARTITIONING, TABLES
from rosterlake.session import COMPRESSION, session_setting, tidy

# rows of these tables may come without the columns that follow from others; they are added after the shuffle of a write
COMPLETED = {"fact_timesheets": complete}


def read_files(spark, path, schema, columns=None):
    """Scan Parquet files with an explicit schema and column list."""
    frame = spark.read.schema(schema).parquet(path)
    return frame.select(*columns) if columns else frame


def read_files_or_empty(spark, path, schema):
    """A missing path reads as an empty frame of the same type."""
    try:
        return read_files(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_merged(spark, path, schema):
    """Folders of files written under older and newer schemas, by the union of their footers.

    A column that a file lacks reads null, and one that no file has is added; columns that the schema does not name
    are left out.
    """
    frame = spark.read.option("mergeSchema", "true").parquet(path)
    present = set(frame.columns)
    return frame.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def lay_out_fact(facts, tasks=None):
    """One shuffle by day before a partitioned write, sorted by employee and project.

    By default REBALANCE: adaptive execution splits a day that is too large for one
    task and merges days that are too small for one. With a number of tasks, ranges
    of day, employee, project and id instead: as even whatever the keys, with files
    that hold few employees each, at the price of a sampling pass. That suits loads
    of many small days, where files rather than bytes are the cost. Rows that have no
    id yet go by the entry type, which tells the ids of an employee and day apart.
    """
    order = ["work_date", "emp_id", "project_id"]
    last = "timesheet_id" if "timesheet_id" in facts.columns else "entry_type"
    if tasks is None:
        spread = facts.hint("rebalance", F.col("work_date"))
    else:
        spread = facts.repartitionByRange(tasks, *order, last)
    return spread.sortWithinPartitions(*order)


class Lake:
    """The tables of one database, each with its files below one root folder.

    write_tasks: see lay_out_fact; used for appends to partitioned tables. max_file_rows: no file of an
    append holds more rows.
    """

    def __init__(self, spark, database, root, write_tasks=None, max_file_rows=None):
        self.spark = spark
        self.max_file_rows = max_file_rows
        self.write_tasks = write_tasks
        self.database = database
        self.root = root.rstrip("/")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}'")

    def name(self, table):
        return f"{self.database}.{table}"

    def _set(self, key, value):
        return session_setting(self.spark, key, value)

    def exists(self, table):
        return self.spark.catalog.tableExists(self.name(table))

    def _fresh_location(self, table):
        return f"{self.root}/{table}/{uuid.uuid4().hex}"

    def create(self, table, schema=None, location=None):
        """Create the table if absent; an existing one keeps its rows."""
        schema = schema or TABLES[table]
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        keys = PARTITIONING.get(table)
        layout = f"PARTITIONED BY ({', '.join(keys)})" if keys else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet "
            f"{layout} LOCATION '{location or self._fresh_location(table)}'"
        )

    def drop(self, table):
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def recreate(self, table, schema=None):
        """Create or replace: the new table starts empty in a new folder."""
        self.drop(table)
        self.create(table, schema)

    def read(self, table, columns=None):
        frame = self.spark.table(self.name(table))
        return frame.select(*columns) if columns else frame

    def read_or_empty(self, table, schema=None):
        if self.exists(table):
            return self.read(table)
        return self.spark.createDataFrame([], schema or TABLES[table])

    def tables(self, prefix=""):
        listed = self.spark.catalog.listTables(self.database)
        return sorted(t.name for t in listed if not t.isTemporary and t.name.startswith(prefix))

    def partition_days(self, table):
        """The values of the table's one date partition column, from the catalog alone."""
        (column,) = PARTITIONING[table]
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}")
        return listed.select(F.split("partition", "=")[1].cast("date").alias(column))

    def replace(self, frame: DataFrame, table, schema=None) -> int:
        """Replace all rows; returns how many were written.

        The rows go to a new folder and the table is pointed at it afterwards, so
        the plan may read the table it replaces and a failed write changes nothing.
        """
        if table in PARTITIONING:
            raise ValueError(f"{table} is loaded by append")
        schema = schema or TABLES[table]
        location = self._fresh_location(table)
        observed = Observation()
        self._aligned(frame, schema).observe(
            observed, F.count(F.lit(1)).alias("rows")
        ).write.parquet(location)
        if self.exists(table):
            self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{location}'")
            self.spark.catalog.refreshTable(self.name(table))
        else:
            self.create(table, schema, location)
        return observed.get["rows"]

    def append(self, frame: DataFrame, table) -> int:
        """Append in one write; returns how many rows were written."""
        if not self.exists(table):
            self.create(table)
        observed = Observation()
        target = self.read(table).schema
        if table in PARTITIONING:
            frame = lay_out_fact(frame, self.write_tasks)
        if table in COMPLETED and "timesheet_id" not in frame.columns:
            frame = COMPLETED[table](frame)
        observed_write = self._aligned(frame, target).observe(
            observed, F.count(F.lit(1)).alias("rows")
        ).write
        # an insert into a table takes these from the session, not from the writer's options
        with (self._set("spark.sql.files.maxRecordsPerFile", self.max_file_rows),
              self._set("spark.sql.parquet.compression.codec", COMPRESSION), tidy(self.spark)):
            observed_write.insertInto(self.name(table))
        self.spark.catalog.refreshTable(self.name(table))
        return observed.get["rows"]

    def append_clustered(self, frame, table, key, order, buckets) -> int:
        """Append to a table in buckets of the key, each sorted by order; created if absent.

        A window or join on the key then reads the table without a shuffle, and sorted buckets let filters on
        order skip row groups. The one shuffle here deals rows as the buckets do, so a load adds one
        file per bucket. Choose buckets so that one fits a task at the size the table will have.
        """
        if not self.exists(table):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields)
            self.spark.sql(
                f"CREATE TABLE {self.name(table)} ({columns}) USING parquet CLUSTERED BY ({', '.join(key)}) "
                f"SORTED BY ({', '.join(order)}) INTO {buckets} BUCKETS LOCATION '{self._fresh_location(table)}'"
            )
        observed = Observation()
        self._aligned(frame, self.read(table).schema).observe(
            observed, F.count(F.lit(1)).alias("rows")
        ).repartition(buckets, *key).write.insertInto(self.name(table))
        self.spark.catalog.refreshTable(self.name(table))
        return observed.get["rows"]

    def compact_days(self, table, most_rows):
        """Rewrite the days whose rows lie in more files than they need; returns those days.

        A day needs one file per most_rows rows. The rows of such days are staged first and then
        replace their own partitions only. If a run dies while it replaces, the staged rows are whole,
        and the next run begins with them.
        """
        staging = f"staging_compact_{table}"
        (column,) = PARTITIONING[table]
        if self.exists(staging):
            self._replace_days(table, staging, most_rows)
        files = self.read(table).groupBy(column, F.input_file_name().alias("file")).count()
        needed = F.ceil(F.sum("count") / F.lit(most_rows))
        days = [r[column] for r in files.groupBy(column).agg(
            F.count(F.lit(1)).alias("files"), needed.alias("needed")).filter("files > needed").collect()]
        if days:
            self.read(table).filter(F.col(column).isin(days)).write.saveAsTable(self.name(staging))
            self._replace_days(table, staging, most_rows)
        return sorted(days)

    def _replace_days(self, table, staging, most_rows):
        (column,) = PARTITIONING[table]
        staged = self.read(staging).repartition(F.col(column))
        ordered = staged.sortWithinPartitions(column, "emp_id", "project_id")
        with (self._set("spark.sql.sources.partitionOverwriteMode", "dynamic"),
              self._set("spark.sql.files.maxRecordsPerFile", most_rows)):
            ordered.write.insertInto(self.name(table), overwrite=True)
        self.spark.catalog.refreshTable(self.name(table))
        self.drop(staging)

    def _location(self, table):
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").filter(
            "col_name = 'Location'").select("data_type").head(1)
        return rows[0][0].rstrip("/").rsplit("/", 1)[-1] if rows else None

    def remove_unused(self, older_than=dt.timedelta(days=7), now=None):
        """Delete the folders that no table points at any more and that nothing has touched for a while.

        Replaced and dropped tables and crashed replaces leave such folders. The age keeps away from
        plans that still read a table just replaced and from writes under way. Only folders that this class names, one
        per version below a table's own, are looked at. Returns how many went.
        """
        jvm, hadoop = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        files = root.getFileSystem(hadoop)
        oldest = ((now or dt.datetime.now(dt.timezone.utc)) - older_than).timestamp() * 1000
        live = {self._location(t) for t in self.tables()}
        removed = 0
        for table in files.listStatus(root) if files.exists(root) else []:
            for version in files.listStatus(table.getPath()) if table.isDirectory() else []:
                name = version.getPath().getName()
                if not version.isDirectory() or not re.fullmatch("[0-9a-f]{32}", name) or name in live:
                    continue
                touched = max([version.getModificationTime(),
                               *[f.getModificationTime() for f in files.listStatus(version.getPath())]])
                if touched <= oldest:
                    files.delete(version.getPath(), True)
                    removed += 1
        return removed

    def add_missing_columns(self, table, schema=None):
        """Additive evolution; rows written before read null in the new columns."""
        present = set(self.read(table).columns)
        missing = [f for f in (schema or TABLES[table]).fields if f.name not in present]
        if missing:
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in missing)
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({columns})")
        return [f.name for f in missing]

    def read_or_seed(self, table, seed: DataFrame):
        """The persisted source if it holds rows, else the seed, written as the source."""
        if not self.exists(table) or self.read(table).isEmpty():
            self.replace(seed, table)
        return self.read(table)

    @staticmethod
    def _aligned(frame, schema):
        return frame.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
