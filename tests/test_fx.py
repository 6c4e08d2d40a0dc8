import json

import pytest

from rosterlake.operators.checks import require_unique_rates
from rosterlake.plans import calendar, fx
from rosterlake.schemas import EXCHANGE_RATES, FX_DOCUMENT
from rosterlake.sources import fx_documents
from tests.conftest import day, plan, rows

PAIR = ("PKR", "GBP")


def month(m):
    return day(f"2024-{m:02d}-01")


def build(spark, documents, last=4, currencies=PAIR):
    docs = spark.createDataFrame([(month(m), r) for m, r in documents.items()], FX_DOCUMENT)
    bounds = calendar.date_bounds(spark, month(1), month(last))
    return fx.carry_forward(fx.fetched_rates(docs), bounds, currencies)


def found(frame):
    return {(r["fx_month"].month, r["currency_code"]): r["rate_to_usd"] for r in frame.collect()}


def test_outage_takes_the_last_known_rates(spark):
    got = found(build(spark, {1: {"PKR": 250.0, "GBP": 0.8}, 3: {"PKR": 200.0, "GBP": 0.5}}, 3))
    assert got == {
        (1, "PKR"): 0.004, (1, "GBP"): 1.25, (1, "USD"): 1.0,
        (2, "PKR"): 0.004, (2, "GBP"): 1.25, (2, "USD"): 1.0,
        (3, "PKR"): 0.005, (3, "GBP"): 2.0, (3, "USD"): 1.0,
    }


def test_partial_month_keeps_its_gap_and_the_memory(spark):
    got = found(build(spark, {1: {"PKR": 250.0, "GBP": 0.8}, 2: {"PKR": 250.0, "GBP": 0.8},
                              3: {"PKR": 200.0}}))
    assert (3, "GBP") not in got
    assert got[4, "GBP"] == 1.25 and got[4, "PKR"] == 0.005


def test_gaps_may_be_filled_on_request(spark):
    docs = spark.createDataFrame(
        [(month(1), {"PKR": 250.0}), (month(2), {"PKR": 250.0, "GBP": 0.8}), (month(3), {"PKR": 200.0})], FX_DOCUMENT)
    bounds = calendar.date_bounds(spark, month(1), month(4))
    got = found(fx.carry_forward(fx.fetched_rates(docs), bounds, PAIR, fill_gaps=True))
    assert (1, "GBP") not in got
    assert got[3, "GBP"] == got[4, "GBP"] == 1.25 and got[3, "PKR"] == 0.005 and len(got) == 11


@pytest.mark.parametrize("broken", [{"PKR": 0.0, "GBP": 0.5}, {"PKR": None, "GBP": 0.5}, None])
def test_a_month_is_taken_whole_or_not(spark, broken):
    got = found(build(spark, {1: {"PKR": 250.0, "GBP": 0.8}, 2: broken}, 2))
    assert got[2, "GBP"] == 1.25 and got[2, "PKR"] == 0.004 and got[2, "USD"] == 1.0


def test_first_month_missing_names_the_currencies(spark):
    rates = build(spark, {3: {"PKR": 250.0, "GBP": 0.8}})
    with pytest.raises(RuntimeError, match="GBP, PKR on 2024-01-01"):
        fx.require_known_rates(rates)
    fx.require_known_rates(build(spark, {1: {"PKR": 250.0, "GBP": 0.8}}))


def test_currency_outside_the_list_is_kept_but_not_filled(spark):
    got = found(build(spark, {1: {"PKR": 250.0, "GBP": 0.8, "JPY": 100.0}}, 2))
    assert got[1, "JPY"] == 0.01 and (2, "JPY") not in got


def test_months_begin_at_the_first_month_start(spark):
    bounds = calendar.date_bounds(spark, day("2024-01-15"), day("2024-04-01"))
    docs = spark.createDataFrame([(month(2), {"PKR": 250.0, "GBP": 0.8})], FX_DOCUMENT)
    got = found(fx.carry_forward(fx.fetched_rates(docs), bounds, PAIR))
    assert sorted({m for m, _ in got}) == [2, 3, 4]


def test_duplicate_keys_raise(spark):
    rates = build(spark, {1: {"PKR": 250.0, "GBP": 0.8}}, 1)
    require_unique_rates(rates)
    with pytest.raises(ValueError, match="exchange-rate key"):
        require_unique_rates(rates.unionByName(rates))
    # a document that quotes the base currency itself clashes with the added row
    with pytest.raises(ValueError, match="exchange-rate key"):
        require_unique_rates(build(spark, {1: {"PKR": 250.0, "GBP": 0.8, "USD": 1.0}}, 1))


def test_new_rates(spark):
    rates = build(spark, {1: {"PKR": 250.0, "GBP": 0.8}}, 2)
    known = rates.filter("currency_code = 'PKR'")
    assert sorted(found(fx.new_rates(rates.unionByName(rates), known))) == [
        (1, "GBP"), (1, "USD"), (2, "GBP"), (2, "USD")]


def test_load_appends_missing_keys_only(spark, lake):
    docs = spark.createDataFrame([(month(1), {"PKR": 250.0, "GBP": 0.8})], FX_DOCUMENT)
    first = calendar.date_bounds(spark, month(1), month(2))
    assert fx.load_exchange_rates(lake, docs, first, PAIR) == 6
    assert fx.load_exchange_rates(lake, docs, first, PAIR) == 0
    # the outage of February was filled; a document that arrives later changes nothing
    later = docs.unionByName(spark.createDataFrame([(month(2), {"PKR": 1.0, "GBP": 1.0})], FX_DOCUMENT))
    bounds = calendar.date_bounds(spark, month(1), month(3))
    assert fx.load_exchange_rates(lake, later, bounds, PAIR) == 3
    got = found(lake.read("dim_exchange_rates"))
    assert got[2, "PKR"] == 0.004 and got[3, "PKR"] == 1.0
    assert {v for (_, c), v in got.items() if c == "USD"} == {1.0}
    assert lake.read("dim_exchange_rates").schema.names == EXCHANGE_RATES.names


def test_failed_load_writes_nothing(spark, lake):
    docs = spark.createDataFrame([(month(2), {"PKR": 250.0, "GBP": 0.8})], FX_DOCUMENT)
    with pytest.raises(RuntimeError):
        fx.load_exchange_rates(lake, docs, calendar.date_bounds(spark, month(1), month(2)), PAIR)
    assert not lake.exists("dim_exchange_rates")


def test_documents_from_files(spark, tmp_path):
    for m, rates in ((1, {"PKR": 250.0}), (2, {"PKR": 200.0, "GBP": 0.8})):
        (tmp_path / f"2024-{m:02d}-01.json").write_text(json.dumps({"rates": rates}, indent=1))
    docs = fx_documents.read_dated_documents(spark, str(tmp_path))
    assert rows(fx_documents.explode_rates(docs, "fx_month")) == [
        (month(1), "PKR", 0.004), (month(2), "GBP", 1.25), (month(2), "PKR", 0.005)]
    lines = tmp_path / "lines"
    docs.write.json(str(lines))
    assert rows(fx_documents.explode_rates(fx_documents.read_documents(spark, str(lines)), "fx_month")) == rows(
        fx_documents.explode_rates(docs, "fx_month"))


def test_calendar(spark):
    got = rows(calendar.dim_date(calendar.date_bounds(spark, day("2024-02-28"), day("2024-03-02"))))
    assert [r[0].day for r in got] == [28, 29, 1, 2]
    assert got[1] == (day("2024-02-29"), 2024, 1, 2, "February", "Thursday", False)
    assert got[3][5:] == ("Saturday", True)
    assert calendar.dim_date(calendar.date_bounds(spark, day("2024-03-02"), day("2024-03-01"))).count() == 0


def test_bad_files_are_outages_and_reported(spark, lake, tmp_path):
    for name, text in (("2024-01-01", '{"rates": {"PKR": 250.0, "GBP": 0.8}}'), ("2024-02-01", "{broken"),
                       ("2024-03-01", '{"rates": {"PKR": 0.0}}'), ("2024-04-01", '{"other": 1}'),
                       ("undated", '{"rates": {"PKR": 1.0}}')):
        (tmp_path / f"{name}.json").write_text(text)
    docs = fx_documents.read_dated_documents(spark, str(tmp_path))
    assert rows(fx_documents.document_faults(docs), "fx_month", "reason") == sorted([
        (month(2), "not a JSON document"), (month(3), "a rate without reciprocal"), (month(4), "no rates"),
        (None, "no month in the name")], key=repr)
    bounds = calendar.date_bounds(spark, month(1), month(4))
    assert fx.load_exchange_rates(lake, docs, bounds, PAIR) == 12
    assert {r["rate_to_usd"] for r in lake.read("dim_exchange_rates").filter("currency_code = 'PKR'").collect()} == {0.004}
    assert lake.tables("staging") == []


def test_rates_come_from_one_scan_of_the_documents(spark, tmp_path):
    (tmp_path / "2024-01-01.json").write_text('{"rates": {"PKR": 250.0, "GBP": 0.8}}')
    docs = fx_documents.read_dated_documents(spark, str(tmp_path))
    rates = fx.carry_forward(fx.fetched_rates(docs), calendar.date_bounds(spark, month(1), month(4)), PAIR)
    assert plan(rates).count("FileScan") == 1
    assert rates.count() == 12
