"""Calendars and plans on literal days."""

import datetime as dt

import pytest

from quotewell.operators import planning as p

D = dt.date
AUGUST = (17, 18, 19, 20, 21, 24, 25, 26)


@pytest.fixture
def days(spark):
    return lambda *x: spark.createDataFrame([(d if isinstance(d, dt.date) else D(2026, 8, d),) for d in x], "date date")


def listed(df, *names):
    return sorted(tuple(r[n] for n in names) if len(names) > 1 else r[names[0]] for r in df.collect())


def test_calendar(days):
    cal = days(*AUGUST)
    assert listed(p.trading_days_between(cal, D(2026, 8, 18), D(2026, 8, 20)), "date") == [D(2026, 8, d) for d in (18, 19, 20)]
    assert listed(p.missing_dates(cal, days(17, 18, 20, 21), D(2026, 8, 17), D(2026, 8, 21)), "date") == [D(2026, 8, 19)]
    assert p.shift_trading_days(cal, D(2026, 8, 26), -2).first().date == D(2026, 8, 24)
    assert p.shift_trading_days(cal, D(2026, 8, 17), -99).first().date == D(2026, 8, 17)
    assert p.shift_trading_days(cal, D(2026, 8, 23), 1).first().date == D(2026, 8, 24)
    assert p.last_closed_trading_day(cal, D(2026, 8, 23)).first().date == D(2026, 8, 21)


def test_middle_day(days):
    assert listed(p.middle_days(days(*(D(2010, 3, d) for d in range(1, 32)))), "date") == [D(2010, 3, 16)]


def test_daily_targets(days):
    got = p.daily_targets(days(*AUGUST), days(17, 18, 20, 21), days(), D(2026, 8, 25), revision=2)
    assert listed(got, "date", "reason") == [(D(2026, 8, 19), "gap"), (D(2026, 8, 20), "revision"), (D(2026, 8, 21), "revision"), (D(2026, 8, 24), "forward"), (D(2026, 8, 25), "forward")]
    assert listed(p.daily_targets(days(*AUGUST), days(17, 18, 20, 21), days(19), D(2026, 8, 21), revision=0), "date") == []
    with pytest.raises(p.TooFarBehind, match="4 days"):
        p.daily_targets(days(*AUGUST), days(17, 18, 19, 20), days(), D(2026, 8, 26), most=3)


def test_checkable(spark):
    ids = spark.createDataFrame([(x,) for x in "ABCD"], "stock_id string")
    gone = spark.createDataFrame([("B", D(2020, 1, 1)), ("C", D(2020, 1, 1)), ("D", D(2020, 1, 1))], "stock_id string, delisted_date date")
    bars = spark.createDataFrame([("A", D(2021, 1, 1)), ("B", D(2019, 1, 1)), ("C", D(2021, 1, 1))], "stock_id string, date date")
    assert listed(p.checkable(ids, gone, bars), "stock_id") == ["A", "C"]
    assert listed(p.checkable(ids, gone.limit(0), bars), "stock_id") == list("ABCD")


def test_reconcile(spark, days):
    ids = spark.createDataFrame([(x,) for x in "AXS"], "stock_id string")
    bars = spark.createDataFrame([("A", D(2026, 8, 17)), ("A", D(2026, 8, 26)), ("S", D(2026, 8, 18))] + [("A", D(2026, 8, d)) for d in (20, 21, 24, 25)], "stock_id string, date date")
    none = spark.createDataFrame([], "stock_id string, delisted_date date")
    got = p.reconcile(ids, days(*AUGUST), bars, none, days(20), days(19), D(2026, 8, 26), stale_after=5)
    assert listed(got, "kind", "key") == [("absent security", "X"), ("stale security", "S"), ("thin day", "2026-08-20")]


def test_workbook_plan(spark, days):
    cal = days(*(D(2026, 9, d) for d in (2, 3, 4)), D(2021, 1, 5), *(D(2026, 1, 1) + dt.timedelta(d) for d in range(40)))
    latest = spark.createDataFrame([("2330", D(2026, 9, 2)), ("2317", D(2026, 9, 2)), ("2448", D(2021, 1, 5))], "stock_id string, last_date date")
    assert listed(p.workbook_plan(cal, latest, D(2026, 9, 4)).where("stock_id <> '2317'"), "stock_id", "date") == [("2330", D(2026, 9, 3)), ("2330", D(2026, 9, 4))]


def test_index_seed_plan(days):
    cal = days(*(D(2026, 9, d) for d in (2, 3, 4, 7, 8)))
    assert listed(p.index_seed_plan(cal, D(2026, 9, 3), D(2026, 9, 5)), "date", "required") == [(D(2026, 9, 4), True), (D(2026, 9, 7), False)]
    turn = days(D(2026, 12, 30), D(2026, 12, 31), D(2027, 1, 4))
    assert listed(p.index_seed_plan(turn, D(2026, 12, 30), D(2026, 12, 31)), "date", "required") == [(D(2026, 12, 31), True)]


def test_pools(spark):
    u = spark.createDataFrame([("A", "a", None, None, True), ("B", "b", None, None, False)], "stock_id string, stock_name string, first_date date, last_date date, has_price_history boolean")
    assert listed(p.members_without_prices(u), "stock_id") == ["B"]
    pool = spark.createDataFrame([("A", D(1990, 1, 1), None), ("B", D(1990, 1, 1), D(1999, 1, 1)), ("C", None, None)], "stock_id string, listed_date date, delisted_date date")
    assert listed(p.company_pool(pool, D(2000, 9, 4)), "stock_id") == ["A"]
