"""Literal rows through the raw-to-processed rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotewell.functions import scalars
from quotewell.operators import etl
from quotewell.sources import schemas

RAW = schemas.RAW_PRICE
D = dt.date


def raw(spark, *rows):
    """date, id, close, volume; other values are fixed."""
    return spark.createDataFrame([(d, i, v, 10, 1.0, 2.0, 0.5, c, 0.0, 3) for d, i, c, v in rows], RAW)


def kept(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_typed_under_processed_names(spark):
    row = etl.type_prices(raw(spark, ("2026-08-21", "0050", 100.0, 1000)), "ticker").first()
    assert (row.date, row.stock_id, row.open, row.high, row.low, row.close, row.volume, row.source) == (D(2026, 8, 21), "0050", 1.0, 2.0, 0.5, 100.0, 1000, "ticker")


def test_unadjusted_prefers_market(spark):
    t, m = raw(spark, ("2026-08-21", "0050", 100.0, 111)), raw(spark, ("2026-08-21", "0050", 104.65, 222))
    assert kept(etl.dedupe_prices(t, m, "market"), "close", "source") == [(104.65, "market")]


def test_adjusted_prefers_ticker(spark):
    t, m = raw(spark, ("2026-08-28", "6669", 2413.843901, 5)), raw(spark, ("2026-08-28", "6669", 7200.0, 5))
    assert kept(etl.dedupe_prices(t, m, "ticker"), "close", "source") == [(2413.843901, "ticker")]


def test_market_fills_what_ticker_lacks(spark):
    t, m = raw(spark, ("2026-09-11", "1", 1.0, 1)), raw(spark, ("2026-09-11", "1", 2.0, 1), ("2026-09-14", "1", 3.0, 1))
    assert kept(etl.dedupe_prices(t, m, "ticker"), "date", "source") == [(D(2026, 9, 11), "ticker"), (D(2026, 9, 14), "market")]


def test_rows_without_a_date_go(spark):
    t = raw(spark, (None, "1", 1.0, 1), ("None", "1", 1.0, 1), ("2026-09-11", "1", 1.0, 1))
    assert etl.dedupe_prices(t, raw(spark), "ticker").count() == 1


def test_unknown_preference(spark):
    with pytest.raises(ValueError, match="newest"):
        etl.dedupe_prices(raw(spark), raw(spark), "newest")


def test_repeats_of_one_source_are_settled(spark):
    t = raw(spark, ("2026-09-11", "1", 1.0, 5), ("2026-09-11", "1", 2.0, 7), ("2026-09-11", "1", 3.0, None))
    assert kept(etl.dedupe_prices(t, raw(spark), "ticker"), "close") == [(2.0,)]


def test_processed_contract(spark):
    out = etl.processed_prices(raw(spark, ("2026-09-11", "1", 1.0, 5)), raw(spark), "ticker", F.lit(dt.datetime(2026, 9, 12)))
    assert out.columns == [*schemas.PRICE.names, "year", "month"] and out.first().month == 9
    with pytest.raises(schemas.ContractError, match="stock_id"):
        schemas.enforce(spark.range(1), schemas.PRICE)
    assert schemas.coerce(spark.createDataFrame([("x", "9")], "open string, stock_id string"), RAW).first().open is None


@pytest.mark.parametrize("text", ["None", "none", "", "nan", "NaN", "null", None, "  "])
def test_sentinels(spark, text):
    assert spark.createDataFrame([(text,)], "x string").select(scalars.clean_text(F.col("x")).alias("y")).first().y is None


@pytest.mark.parametrize(
    ("stock_id", "shape"),
    [("2330", "common"), ("0050", "etf"), ("00679B", "etf"), ("006202", "etf"), ("91009T", "tdr"), ("910322", "warrant"), ("0347", "warrant"), ("0617P", "warrant"), ("1101A", "preferred"), ("TAIEX", "index"), ("", "other"), ("2887Z1", "other")],
)
def test_classifier(spark, stock_id, shape):
    assert spark.createDataFrame([(stock_id,)], "x string").select(scalars.classify(F.col("x")).alias("y")).first().y == shape


def test_scalars(spark):
    row = spark.createDataFrame([("2330 A  B ", "2024-01-05T10:00:00", "2.5", 36773.0)], "s string, d string, n string, x double")
    sid, name = scalars.split_security(F.col("s"))
    got = row.select(sid.alias("a"), name.alias("b"), scalars.parse_date(F.col("d")).alias("c"), scalars.to_long(F.col("n")).alias("d"), scalars.serial_to_date(F.col("x")).alias("e")).first()
    assert tuple(got) == ("2330", "A  B", D(2024, 1, 5), 2, D(2000, 9, 4))
    with pytest.raises(Exception, match="ambiguous"):
        row.select(scalars.serial_to_date(F.lit(60.0))).collect()
    assert scalars.normalise_industry(F.lit("x"), {}) is not None
    assert row.select(scalars.normalise_industry(F.lit("a"), {"a": "b"}).alias("y")).first().y == "b"
    names = [scalars.safe_filename(x) for x in ("0050", "a", "A", "a/b", "a_b", "CON", "")]
    assert names[0] == "0050" and len({n.lower() for n in names}) == len(names)


def test_master_keeps_first_seen_and_industry_last_seen(spark):
    info = spark.createDataFrame([("Old", "1", "n", "t", "2020-01-01"), ("Old", "1", "n", "t", "2021-01-01"), ("New", "1", "n", "t", "2022-01-01"), ("Index", "X", "i", None, "None")], schemas.RAW_STOCK_INFO)
    out = etl.stock_info(info, {"Old": "O"}, ("Index",))
    assert kept(out.where("stock_id = '1'"), "snapshot_date", "industry_category_norm") == [(D(2020, 1, 1), "O"), (D(2022, 1, 1), "New")]
    assert kept(out.where("is_index"), "stock_id", "snapshot_date") == [("X", None)]
    ind = spark.createDataFrame([("1", "a", "b", "2020-01-01"), ("1", "a", "b", "2021-01-01"), ("1", "a", None, "2021-01-01")], schemas.RAW_INDUSTRY)
    assert sorted(etl.industry(ind).select("sub_industry", "snapshot_date").collect(), key=str) == sorted([("b", D(2021, 1, 1)), (None, D(2021, 1, 1))], key=str)


def test_delisted_universe(spark):
    seen = spark.createDataFrame([("1111", "common", D(2001, 1, 1), D(2002, 1, 1), 2, 9, None), ("2222", "common", D(2001, 1, 1), D(2002, 1, 1), 2, 9, None), ("0347", "warrant", D(2001, 1, 1), D(2002, 1, 1), 1, 9, None)], schemas.DISCOVERED)
    log = etl.delisting(spark.createDataFrame([("2003-01-01", "1111", "a"), ("2004-01-01", "1111", "b"), ("2005-01-01", "3333", "c"), ("2005-01-01", "3333", "c")], schemas.RAW_DELISTING))
    master = spark.createDataFrame([("2222",)], "stock_id string")
    out = etl.delisted_securities(seen, log, master)
    assert kept(out, "stock_id", "source", "shape", "delisted_date") == [("1111", "both", "common", D(2004, 1, 1)), ("3333", "delisting", "common", D(2005, 1, 1))]


def test_expanded_calendar_and_ledger(spark):
    days = lambda *x: spark.createDataFrame([(D(2026, 8, d),) for d in x], "date date")
    assert kept(etl.expanded_calendar(days(17, 18), days(18, 22)), "date", "source") == [(D(2026, 8, 17), "official"), (D(2026, 8, 18), "official"), (D(2026, 8, 22), "derived")]
    empty = spark.createDataFrame([(D(2026, 8, 1), None)], schemas.KNOWN_EMPTY)
    now = F.lit(dt.datetime(2026, 9, 1))
    one = etl.record_empty(empty, days(10, 20, 21), days(20), now)
    assert kept(one, "date") == [(D(2026, 8, 1),), (D(2026, 8, 10),)]
    assert kept(etl.record_empty(one, days(10), days(20), now), "date") == kept(one, "date")


def test_observations_add_up(spark):
    rows = spark.createDataFrame([("2330", D(2010, 5, 1)), ("2330", D(2008, 1, 1)), ("2330", D(2012, 9, 1)), ("2330", D(2012, 9, 1))], "stock_id string, date date")
    one = etl.observations(rows, F.lit(dt.datetime(2026, 1, 1)))
    r = one.first()
    assert (r.sample_hits, r.first_seen, r.last_seen, r.sampled_days, r["shape"]) == (3, D(2008, 1, 1), D(2012, 9, 1), 3, "common")
    assert etl.merge_observations(one, one).first().sample_hits == 6


def test_keys_and_files(spark):
    rows = spark.createDataFrame([("A", D(2024, 1, 2), "2330", "A/2024.xlsx"), ("B", D(2024, 1, 2), "2330", "B/2024.xlsx")], "index_id string, date date, stock_id string, source_file string")
    assert etl.assert_unique(rows, "index_id", "date", "stock_id") is rows and etl.assert_one_file_a_day(rows) is rows
    with pytest.raises(ValueError, match="A"):
        etl.assert_unique(rows.union(rows.limit(1)), "index_id", "date", "stock_id")
    with pytest.raises(ValueError, match="several workbooks"):
        etl.assert_one_file_a_day(rows.withColumn("index_id", F.lit("A")))
    with pytest.raises(ValueError, match="nothing"):
        etl.rebuilt(rows.where("false"), "stock_id")
    assert etl.rebuilt(rows, "index_id", "date", "stock_id").columns[-2:] == ["year", "month"]
