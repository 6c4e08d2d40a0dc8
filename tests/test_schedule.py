import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rosterlake.operators.asof import active_project
from rosterlake.operators.prefix_sum import add_sum_before
from rosterlake.plans import schedule
from rosterlake.schemas import SCHEDULE
from tests.conftest import day, rows

START = day("2024-01-01")


def plus(days):
    return START + dt.timedelta(days=days)


def lookup(spark, intervals, probes, **options):
    table = spark.createDataFrame([(1, p, plus(a), plus(b)) for p, a, b in intervals], SCHEDULE)
    asked = spark.createDataFrame([(1, plus(d)) for d in probes], "emp_id long, work_date date")
    return [r[1] for r in rows(active_project(asked, table, **options), "work_date", "project_id")]


@pytest.mark.parametrize("intervals, probe, expected", [
    ([(10, 1, 10), (20, 10, 20)], 10, 20),          # touch: the later start
    ([(10, 1, 10), (20, 17, 20)], 12, -1),          # gap
    ([(10, 1, 30), (20, 5, 6)], 10, -1),            # shadowed interval
    ([(10, 1, 30), (20, 5, 6)], 6, 20),
    ([(10, 5, 9)], 4, -1),                          # before the first
    ([(10, 5, 9)], 9, 10),                          # the end counts
    ([], 3, -1),
])
def test_lookup_cases(spark, intervals, probe, expected):
    assert lookup(spark, intervals, [probe]) == [expected]
    assert lookup(spark, intervals, [probe], days_unique=True) == [expected]


def test_lookup_keeps_every_probe_and_its_columns(spark):
    table = spark.createDataFrame([(1, 5, plus(0), plus(3))], SCHEDULE)
    asked = spark.createDataFrame(
        [(1, plus(2), "a"), (1, plus(2), "b"), (1, plus(9), "c"), (2, plus(2), "d")],
        "emp_id long, work_date date, tag string")
    assert rows(active_project(asked, table), "tag", "project_id") == [
        ("a", 5), ("b", 5), ("c", -1), ("d", -1)]


def test_lookup_equals_binary_search(spark):
    rng = random.Random(7)
    intervals, probes, expected = [], [], []
    for emp in range(30):
        starts = sorted(rng.sample(range(200), rng.randint(0, 12)))
        mine = [(emp, rng.randint(1, 99), s, s + rng.randint(0, 25)) for s in starts]
        intervals += [(e, p, plus(a), plus(b)) for e, p, a, b in mine]
        for probe in rng.choices(range(-5, 230), k=60):
            at = bisect.bisect_right(starts, probe) - 1
            hit = mine[at][1] if at >= 0 and probe <= mine[at][3] else -1
            probes.append((emp, plus(probe)))
            expected.append((emp, plus(probe), hit))
    asked = spark.createDataFrame(probes, "emp_id long, work_date date")
    got = active_project(asked, spark.createDataFrame(intervals, SCHEDULE))
    assert rows(got, "emp_id", "work_date", "project_id") == sorted(expected, key=repr)


def test_sum_before_over_blocks(spark):
    rng = random.Random(3)
    data = [(k, i, rng.randint(0, 9)) for k in range(3) for i in range(50 + k)]
    frame = spark.createDataFrame(data, "k long, i long, v long")
    expected = [(k, i, sum(v for k2, j, v in data if k2 == k and j < i)) for k, i, _ in data]
    for block in (1, 7, 4096):
        got = add_sum_before(frame, "k", "i", "v", "before", block)
        assert rows(got, "k", "i", "before") == sorted(expected, key=repr)


def timeline(spark, join, projects, steps, horizon, history):
    people = spark.createDataFrame([(1, join, projects)], "emp_id long, join_date date, project_ids array<long>")
    table = spark.createDataFrame(
        [(1, i, d, g) for i, (d, g) in enumerate(steps)],
        "emp_id long, seq long, duration_days long, gap_days long")
    return rows(schedule.build_schedule(people, table, horizon, history), "start_date", "end_date", "project_id")


def test_timeline_cycles_and_clamps(spark):
    got = timeline(spark, plus(-9), [5, 6], [(28, 7), (30, 0), (50, 14), (40, 0)], plus(100), START)
    assert got == [
        (plus(0), plus(28), 5), (plus(35), plus(65), 6), (plus(65), plus(100), 5)]


def test_joiner_on_the_horizon_has_no_timeline(spark):
    assert timeline(spark, plus(100), [5], [(28, 7)], plus(100), START) == []


def test_intervals_do_not_overlap_but_touch(spark):
    from verification.lens import Lens

    lens = Lens(spark, "/root/testdata/sf0.001")
    built = schedule.build_schedule(lens.cycles, lens.assignments, day("2001-12-31"), day("1995-01-01"))
    other = built.select("emp_id", F.col("start_date").alias("s2"), F.col("end_date").alias("e2"))
    overlap = built.join(other, "emp_id").filter(
        (F.col("start_date") < F.col("s2")) & (F.col("end_date") > F.col("s2")))
    assert built.count() > 0 and overlap.count() == 0


DAYS = "emp_id long, work_date date"


def expected_days(join, first, last, away, extra):
    out, d = [], max(join, first)
    while d <= last:
        if d not in away and (d.weekday() < 5 or d in extra):
            out.append(d)
        d += dt.timedelta(days=1)
    return out


def test_spine_and_filter_agree_with_a_loop(spark):
    rng = random.Random(5)
    first, last = plus(3), plus(40)
    people, away, extra, expected = [], [], [], []
    for emp in range(8):
        join = plus(rng.randint(-10, 45))
        off = {plus(rng.randint(0, 45)) for _ in range(6)}
        on = {plus(rng.randint(0, 45)) for _ in range(9)}
        people.append((emp, join))
        away += [(emp, d) for d in off] * 2
        extra += [(emp, d) for d in on] * 2
        expected += [(emp, d) for d in expected_days(join, first, last, off, on)]
    staff = spark.createDataFrame(people, "emp_id long, join_date date")
    lists = spark.createDataFrame(away, DAYS), spark.createDataFrame(extra, DAYS)
    spine = schedule.employee_days(staff, first, last, *lists)
    assert rows(spine, "emp_id", "work_date") == sorted(expected, key=repr)
    every = spark.createDataFrame([(e, plus(d)) for e, _ in people for d in range(-5, 50)], DAYS)
    assert rows(schedule.loggable(every, staff, first, last, *lists)) == sorted(expected, key=repr)


def test_spine_is_empty_when_up_to_date(spark):
    staff = spark.createDataFrame([(1, START)], "emp_id long, join_date date")
    none = spark.createDataFrame([], DAYS)
    assert schedule.employee_days(staff, plus(5), plus(4), none, none).count() == 0
    assert schedule.employee_days(staff, plus(0), plus(0), none, none).count() == 1
