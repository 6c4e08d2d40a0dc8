"""Reference-shaped tables derived from the test tables, as DataFrames.

The oracle side states the same derivation as SQL text (lens_sql.py); the two are
written apart so that each checks the other.
"""

from functools import cached_property

from pyspark.sql import functions as F

from rosterlake.plans.projects import with_bench
from rosterlake.session import COMPRESSION, tidy, work_folder

CURRENCIES = [("PKR", 0.0036), ("USD", 1.0), ("GBP", 1.27), ("AED", 0.2723),
              ("EUR", 1.08), ("SAR", 0.2666), ("SGD", 0.74)]
MARKETS = ["USA", "United Kingdom", "Australia", "Canada", "Germany", "Netherlands",
           "United Arab Emirates", "Saudi Arabia", "Singapore", "Qatar", "Brazil"]
DEPARTMENTS = ["Engineering", "Data Science", "Cloud", "Sales", "HR", "QA", None, "Legal"]
REGIONS = ["Pakistan", "USA", "UNITED KINGDOM", "UAE", "Germany", "SAUDI ARABIA", "Atlantis"]

SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
              "props string",
}


def _pick(index, values):
    """values[index] as a chain of conditions; a null value stays null."""
    expr = F.lit(None).cast("string")
    for i, value in reversed(list(enumerate(values))):
        expr = F.when(index == i, F.lit(value)).otherwise(expr)
    return expr


class Lens:
    def __init__(self, spark, folder):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def source(self, table):
        return self.spark.read.schema(SOURCES[table]).parquet(f"{self.folder}/{table}.parquet")

    @cached_property
    def employees(self):
        key = F.col("c_custkey")
        name = F.concat_ws("-", "c_mktsegment", "c_name")
        places = self.source("nation").join(
            self.source("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.source("customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                key.alias("emp_id"),
                F.when(key % 5 == 0, F.concat(F.lit("   "), F.lower(name), F.lit("  ")))
                .otherwise(name).alias("name"),
                F.when(key % 14 != 0, F.col("c_mktsegment")).alias("department"),
                _pick(key % 5, ["consultant", "MANAGER", "Analyst", "SENIOR ANALYST", "manager"])
                .alias("designation"),
                F.abs("c_acctbal").alias("local_salary"),
                _pick(F.col("c_nationkey") % 7, ["PKR", "USD", "GBP", "AED", "EUR", "SAR", "SGD"])
                .alias("currency"),
                F.when(key % 7 == 0, F.col("r_name"))
                .otherwise(F.concat(
                    F.left("r_name", F.lit(1)), F.lower(F.substr("r_name", F.lit(2)))
                ))
                .alias("region"),
                F.date_add(F.lit("1995-01-01").cast("date"), (key % 1461).cast("int"))
                .alias("join_date"),
            )
        )

    @cached_property
    def clients(self):
        """The projects without the bench row."""
        return (
            self.source("supplier")
            .join(self.source("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                (F.col("s_suppkey") + 1).alias("project_id"),
                F.concat(F.lit("  PRJ-"), F.upper("s_name"), F.lit("  ")).alias("project_name"),
                F.col("s_name").alias("client_name"),
                F.col("n_name").alias("client_country"),
            )
        )

    @cached_property
    def projects(self):
        return with_bench(self.clients)

    @cached_property
    def markets(self):
        """Client projects with the market names of the rate card."""
        key = F.col("s_suppkey")
        return self.source("supplier").select(
            (key + 1).alias("project_id"), _pick(key % 11, MARKETS).alias("client_country")
        )

    @cached_property
    def roster(self):
        """Employees with the department and region names of the business model."""
        key = F.col("c_custkey")
        region = F.col("c_nationkey") % 7
        return self.source("customer").select(
            key.alias("emp_id"),
            _pick(key % 8, DEPARTMENTS).alias("department"),
            _pick(key % 5, ["consultant", "MANAGER", "Analyst", "SENIOR ANALYST", "intern"])
            .alias("designation"),
            _pick(region, REGIONS).alias("region"),
            (F.abs("c_acctbal") * F.when(region == 0, 50.0).otherwise(2.0)).alias("local_salary"),
        )

    @cached_property
    def exchange_rates(self):
        """Twelve months a year of seven currencies, with two kinds of gaps."""
        months = self.source("lineitem").select(
            F.trunc("l_shipdate", "MM").alias("fx_month")
        ).distinct()
        offers = F.array(*[
            F.struct(F.lit(code).alias("currency_code"), F.lit(base).alias("base"))
            for code, base in CURRENCIES
        ])
        code, month = F.col("currency_code"), F.col("fx_month")
        rate = F.col("base") * (F.lit(1.0) + (F.month(month) - 6) * F.lit(0.005))
        return (
            months.select("fx_month", F.inline(offers))
            .filter(~((code == "SGD") & (F.month(month) == 3)))
            .filter(~((code == "SAR") & (month == F.lit("2001-11-01").cast("date"))))
            .select(
                "fx_month",
                F.lit("USD").alias("base_currency"),
                "currency_code",
                F.when(code == "USD", 1.0)
                .otherwise(F.round(rate.cast("decimal(28,10)"), 6).cast("double"))
                .alias("rate_to_usd"),
            )
        )

    @cached_property
    def raw(self):
        """Order lines with their customer and the flags the facts derive from."""
        line = self.source("lineitem")
        orders = self.source("orders").select("o_orderkey", "o_custkey")
        return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumns({
            "emp_id": F.col("o_custkey"),
            "work_date": F.col("l_shipdate").cast("date"),
            "q": F.col("l_quantity").cast("long"),
            "corr": (F.col("l_orderkey") + F.col("l_linenumber")) % 50 == 0,
            "on_bench": F.col("l_suppkey") % 10 == 0,
        }).withColumn("bill", (F.col("l_linestatus") == "F") & ~F.col("on_bench"))

    def joined_once(self, folder=None):
        """A lens whose raw lines are joined once and stored, with the columns that entries and lists derive from."""
        folder = folder or work_folder(self.spark)
        kept = self.raw.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_returnflag",
                               "emp_id", "work_date", "q", "on_bench")
        with tidy(self.spark):
            kept.write.option("compression", COMPRESSION).parquet(folder)
        lens = Lens(self.spark, self.folder)
        # takes the place of the cached property
        lens.__dict__["raw"] = self.spark.read.schema(kept.schema).parquet(folder)
        return lens

    @cached_property
    def timesheets(self):
        q, corr, bill = F.col("q"), F.col("corr"), F.col("bill")
        order, line = F.col("l_orderkey").cast("string"), F.col("l_linenumber")
        hours = F.when(corr, -((q % 8 + 1) * F.lit(0.5))).otherwise((q % 17) * F.lit(0.5))
        rate = F.when(bill, (F.col("l_suppkey") % 56 + 40).cast("double")).otherwise(0.0)
        day = F.col("work_date")
        late = F.expr("make_dt_interval(0, 0, 0, 1)") * (F.col("l_partkey") * 50 + q)
        return self.raw.select(
            F.concat_ws("-", order, line.cast("string")).alias("timesheet_id"),
            "emp_id",
            F.when(F.col("on_bench"), F.lit(-1).cast("long"))
            .otherwise(F.col("l_suppkey") + 1).alias("project_id"),
            "work_date",
            F.trunc(day, "MM").alias("fx_month"),
            F.col("l_shipdate").alias("created_at"),
            hours.alias("hours_worked"),
            bill.alias("is_billable"),
            rate.alias("hourly_rate_usd"),
            F.when(bill, F.round(hours * rate, 2)).otherwise(0.0).alias("revenue_usd"),
            F.when(line % 3 == 0, 0.6).when(line % 3 == 1, 0.8).otherwise(1.0)
            .alias("allocation_pct"),
            (hours < 0).alias("is_anomaly"),
            (F.weekday(day) >= 5).alias("is_weekend_work"),
            corr.alias("is_correction"),
            F.when(corr, "correction").otherwise("original").alias("entry_type"),
            F.when(corr, F.concat_ws("-", order, (line + 1).cast("string")))
            .alias("original_timesheet_id"),
            (F.col("l_shipdate") + late).alias("load_timestamp"),
            F.concat(F.lit("RUN-"), F.year(day).cast("string")).alias("batch_id"),
        )

    @cached_property
    def entries(self):
        """Raw entries as they come in: several per employee and day, some out of range."""
        line = F.col("l_linenumber")
        return self.raw.select(
            "emp_id", "work_date",
            F.when(~F.col("on_bench"), F.col("l_suppkey") + 1).alias("project_id"),
            (F.col("q") * F.lit(0.25)).alias("base_hours"),
            _share(line).alias("allocation_pct"),
            (F.col("l_linestatus") == "F").alias("is_billable"),
            (F.col("l_suppkey") % 56 + 40).cast("double").alias("hourly_rate_usd"),
        )

    @cached_property
    def numbered_entries(self):
        """The raw entries with the order in which they count as delivered."""
        line = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "q", "l_linestatus")
        return self.raw.select(
            "emp_id", "work_date",
            F.when(~F.col("on_bench"), F.col("l_suppkey") + 1).alias("project_id"),
            (F.col("q") * F.lit(0.25)).alias("base_hours"),
            _share(F.col("l_linenumber")).alias("allocation_pct"),
            (F.col("l_linestatus") == "F").alias("is_billable"),
            (F.col("l_suppkey") % 56 + 40).cast("double").alias("hourly_rate_usd"),
            line.alias("line"),
        )

    @cached_property
    def daily_entries(self):
        """One entry per employee and day: the first order line, combined map-side."""
        first = F.min(F.struct(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "q", "l_linestatus"
        ))
        one = self.raw.groupBy("emp_id", "work_date").agg(first.alias("f"))
        return one.select(
            "emp_id", "work_date",
            F.when(F.col("f.l_suppkey") % 10 != 0, F.col("f.l_suppkey") + 1).alias("project_id"),
            (F.col("f.q") * F.lit(0.25)).alias("base_hours"),
            _share(F.col("f.l_linenumber")).alias("allocation_pct"),
            (F.col("f.l_linestatus") == "F").alias("is_billable"),
            (F.col("f.l_suppkey") % 56 + 40).cast("double").alias("hourly_rate_usd"),
        )

    @cached_property
    def absences(self):
        return self.raw.filter(F.col("l_returnflag") == "R").select("emp_id", "work_date")

    @cached_property
    def weekend_work(self):
        return self.raw.filter(F.col("l_returnflag") == "A").select("emp_id", "work_date")

    @cached_property
    def daily_adjustments(self):
        """Adjusted hours per employee and day, one each."""
        return (
            self.raw.filter((F.col("l_orderkey") + F.col("l_linenumber")) % 20 == 0)
            .groupBy("emp_id", "work_date")
            .agg((F.max("q") * F.lit(0.15)).alias("adjusted_hours"))
        )

    @cached_property
    def adjustments(self):
        """Adjusted hours for one in twenty timesheets, one each."""
        picked = self.raw.filter((F.col("l_orderkey") + F.col("l_linenumber")) % 20 == 7)
        key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        return picked.groupBy(key.alias("timesheet_id")).agg(
            (F.max("q") * F.lit(0.15)).alias("adjusted_hours")
        )

    @cached_property
    def event_probes(self):
        return self.source("events").select(
            "event_id", F.col("user_id").alias("emp_id"), F.col("ts").cast("date").alias("work_date")
        )

    @cached_property
    def event_schedule(self):
        """An interval per signup day of a user; the latest signup of a day wins."""
        latest = F.max(F.struct("ts", "event_id")).alias("s")
        day = F.col("ts").cast("date").alias("start_date")
        signups = self.source("events").filter(F.col("event_type") == "signup")
        return signups.groupBy(F.col("user_id").alias("emp_id"), day).agg(latest).select(
            "emp_id",
            F.col("s.event_id").alias("project_id"),
            "start_date",
            F.date_add("start_date", (F.col("s.event_id") % 4).cast("int")).alias("end_date"),
        )

    @cached_property
    def cycles(self):
        """Employees with one to three assigned projects."""
        key = F.col("c_custkey")
        three = F.array(key % 97 + 1, key % 89 + 1, key % 83 + 1)
        return self.source("customer").select(
            key.alias("emp_id"),
            F.date_add(F.lit("1995-01-01").cast("date"), (key % 1461).cast("int")).alias("join_date"),
            F.slice(three, F.lit(1), (key % 3 + 1).cast("int")).alias("project_ids"),
        )

    @cached_property
    def assignments(self):
        """Up to twelve assignments per employee, with their days and gaps."""
        key, seq = F.col("emp_id"), F.col("seq")
        count = key % 8 + 4
        return (
            self.source("customer").select(F.col("c_custkey").alias("emp_id"))
            .withColumn("seq", F.explode(F.sequence(F.lit(0).cast("long"), count)))
            .select(
                "emp_id", "seq",
                ((key * 7 + seq * 13) % 141 + 28).alias("duration_days"),
                ((key + seq) % 4 * 7).alias("gap_days"),
            )
        )


class StoredLens(Lens):
    """The lens with its tables written once and read back, as a lake would hold them."""

    TABLES = [name for name, value in vars(Lens).items()
              if isinstance(value, cached_property) and name != "raw"]

    def __init__(self, spark, folder, root, files=8):
        super().__init__(spark, folder)
        for name in self.TABLES:
            frame = getattr(Lens(spark, folder), name)
            frame.repartition(files).write.parquet(f"{root}/{name}")
            # takes the place of the cached property
            self.__dict__[name] = spark.read.schema(frame.schema).parquet(f"{root}/{name}")


def _share(line):
    return _pick_number(line % 5, [0.0, 0.6, 0.8, 1.0, 1.2])


def _pick_number(index, values):
    expr = F.lit(values[-1])
    for i, value in reversed(list(enumerate(values[:-1]))):
        expr = F.when(index == i, F.lit(value)).otherwise(expr)
    return expr
