"""Ids have four characters, so longer supplier keys share them: several bars a security and day. Queries against their SQL on such tables."""

import datetime as dt
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_queries import QUERIES, SQL, TABLES, table

from quotewell.operators import compare, explore
from quotewell.operators.feed_views import BAR
from quotewell.operators.vendor_views import VENDOR_BAR
from quotewell.plans.queries import trial
from quotewell.plans.warehouse import Warehouse

#: Six copies of ten suppliers, from 9970 on: three ids of ten suppliers each, and thirty of one.
COPIES, FIRST = 6, 9970


@pytest.fixture(scope="module")
def shared_dir(sf_dir, tmp_path_factory):
    out = tmp_path_factory.mktemp("shared")
    con = duckdb.connect()
    for t in TABLES:
        key = {"supplier": "s_suppkey", "lineitem": "l_suppkey"}.get(t)
        rows = f"SELECT t.* REPLACE ({key} + {FIRST} + 10 * i AS {key}) FROM '{sf_dir}/{t}.parquet' t, range({COPIES}) g(i)" if key else f"FROM '{sf_dir}/{t}.parquet'"
        con.execute(f"COPY ({rows}) TO '{out}/{t}.parquet'")
    return str(out)


@pytest.fixture(scope="module")
def shared_db(shared_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{shared_dir}/{t}.parquet'")
    return con


def same(spark, shared_dir, shared_db, name):
    got = QUERIES[name](spark, shared_dir)
    told = shared_db.execute(SQL[name])
    names = [x[0] for x in told.description]
    assert sorted(got.columns) == sorted(names)
    assert table(got.columns, [tuple(r) for r in got.collect()]) == table(names, told.fetchall())


def test_ids_are_shared(spark, shared_dir):
    assert trial(spark, shared_dir).feed_bars.groupBy("stock_id", "date").count().where("count > 2").count() > 0


@pytest.mark.parametrize("name", ["coverage_by_index", "etl_industry", "feed_health", "vendor_health", "cmp_overlap_size", "cmp_activity_by_year", "cmp_volume_unit_error", "cmp_level_by_year", "cmp_volume_mismatch_shape"])
def test_shared_ids_match_sql(spark, shared_dir, shared_db, name):
    same(spark, shared_dir, shared_db, name)


def measured(rows, times):
    count = lambda x: F.sum(F.when(x, times))
    return rows.groupBy("market", F.year("date").alias("year")).agg(
        F.sum(times).alias("n"), count(F.col("clean")).alias("clean"), count(F.col("r_up").isNotNull()).alias("up"), *(count(compare.beyond(r)).alias(r) for r in ("r_vendor", "r_feed", "r_up", "r_raw"))
    )


@pytest.mark.parametrize("free_rows", [0, compare.FREE_ROWS])
def test_weighted_rows_stand_for_all_returns(spark, shared_dir, free_rows):
    w = trial(spark, shared_dir)
    whole = measured(w.returns.where(F.col("seq") > free_rows), F.lit(1)).collect()
    fewer = measured(compare.weighted(w, free_rows), F.col("times")).collect()
    assert sorted(map(tuple, whole), key=repr) == sorted(map(tuple, fewer), key=repr) and len(whole) > 20


def test_returns_have_a_row_for_each_of_aligned(spark, shared_dir):
    w = trial(spark, shared_dir)
    linked = compare._combined(compare._copied(compare._linked(compare.days(w))), *"vfur")
    told = linked.agg(F.count("*").alias("n"), F.countDistinct("stock_id", "seq").alias("places"), F.countDistinct("stock_id").alias("ids")).first()
    assert told.n == told.places == w.aligned.count() > 100_000
    assert linked.groupBy("stock_id").agg(F.max("seq").alias("last"), F.count("*").alias("n")).where("last <> n").count() == 0


def test_disagreements_are_those_of_all_returns(spark, shared_dir):
    w = trial(spark, shared_dir)
    whole = w.returns.where(compare.listed() & (compare.apart("r_vendor", "r_feed") > compare.MATERIAL)).withColumn("cause", compare.cause())
    assert whole.exceptAll(w.disagreements).count() == 0 and whole.count() == w.disagreements.count() > 0


def test_no_trade_rule_counts_all_rows(spark, shared_dir):
    w = trial(spark, shared_dir)
    near = lambda a, b: compare.apart(a, b) < 0.0051
    whole = compare._combined(compare._copied(compare._linked(compare.days(w))), *"vfur").where((F.col("raw") == 0) & (F.col("p_raw") > 0) & near("p_vendor", "p_raw") & compare.listed())
    told = compare.cmp_no_trade_day_rule(w).first()
    assert (told.no_trade_days_at_factor_1, told.feed_carries_last_close) == (whole.count(), whole.where(near("feed", "p_feed")).count())


def test_weighted_rows_are_no_more_than_a_days_bars(spark, shared_dir):
    w = trial(spark, shared_dir)
    held = compare.days(w).select(*compare.KEY, (F.size("v") + F.size("f") + F.size("u") + 2 * F.size("r")).alias("bars"))
    rows = compare.weighted(w, kinds=compare.LISTED_ALONE).groupBy(*compare.KEY).count().join(held, compare.KEY)
    assert rows.where("count > bars").count() == 0 and rows.agg(F.max("count")).first()[0] > 20


def test_all_sides_come_from_one_scan(spark, shared_dir):
    plan = compare.cmp_vendor_suspicious_summary(trial(spark, shared_dir))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_aligned_is_made_without_joins(spark, shared_dir, shared_db):
    rows = trial(spark, shared_dir).aligned
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    some = "date BETWEEN DATE '1996-01-01' AND DATE '1996-01-20'"
    told = shared_db.execute(f"SELECT {', '.join(rows.columns)} FROM ({SQL['aligned']}) WHERE {some}").fetchall()
    assert len(told) > 10 and table(rows.columns, [tuple(r) for r in rows.where(some).collect()]) == table(rows.columns, told)


def test_days_of_tables_that_are_apart(spark, sf_dir):
    w = trial(spark, sf_dir)
    apart = Warehouse(spark, {x: w.tables[x] for x in ("vendor_bars", "feed_adj_bars", "feed_bars", "feed_raw_ticker", "feed_raw_market")})
    one, other = compare.days(w), compare.days(apart)
    assert one.count() == other.count() > 0 and one.exceptAll(other).count() == 0


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    columns = "snapshot_date string, stock_id string, stock_name string, industry_category string, industry_category_norm string, type string, is_index boolean"
    rows = [("2001-01-04", "1000", name, "PERU", "PERU", kind, False) for name, kind in (("b", "main"), ("a", "other"), ("c", "main"))]
    for order in (rows, rows[::-1]):
        w = Warehouse(spark, {"feed_stock_info": spark.createDataFrame(order, columns).coalesce(1)})
        assert [r.stock_name for r in w.feed_v_stock_info_latest.collect()] == ["a"]


def test_vendor_returns_do_not_depend_on_the_order_of_rows(spark, shared_dir):
    bars = trial(spark, shared_dir).vendor_bars.where("stock_id = '1000'")
    told = [compare.cmp_vendor_internal_return_check(Warehouse(spark, {"vendor_bars": bars.orderBy(*order)})).orderBy("segment").collect() for order in (("k" if "k" in bars.columns else "stock_name",), (F.desc("stock_name"), F.desc("date")))]
    assert told[0] == told[1] and told[0][0].n > 0


@pytest.mark.parametrize("name", ["cmp_disagreement_causes_by_year", "cmp_return_agreement", "cmp_beyond_limit_by_year", "cmp_vendor_beyond_limit_sample", "disagreements", "cmp_level_by_year"])
def test_lists_of_a_day_are_not_made_again_in_filters(spark, shared_dir, name):
    """The optimizer would copy a list's expression into a test of its size, and from there into lambdas: once an element."""
    plan = QUERIES[name](spark, shared_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array" in plan and not re.search(r"Filter .*size\((sort_array|transform|filter|flatten)\(", plan)


def test_counts_of_a_day_are_those_of_its_lists(spark, shared_dir):
    up, day = ("1000", "2001-01-01"), "stock_id string, date string, close double"
    t, m = spark.createDataFrame([(*up, x) for x in (3.0, None, 0.0)], day), spark.createDataFrame([(*up, x) for x in (5.0, 0.0, None, 7.0)], day)
    bars = trial(spark, shared_dir)
    own = lambda x: x.withColumn("stock_id", F.lit(up[0])).withColumn("date", F.lit(up[1]).cast("date")).limit(3)
    odd = Warehouse(spark, {"vendor_bars": own(bars.vendor_bars), "feed_adj_bars": own(bars.feed_adj_bars), "feed_bars": own(bars.feed_bars), "feed_raw_ticker": t, "feed_raw_market": m})
    for w, least in ((bars, 100), (odd, 1)):
        moves = lambda x: x["feed_up"] != 0
        times = lambda u: F.aggregate(u, F.lit(0).cast("long"), lambda n, x: n + x["times"])
        told = compare.days(w).select("*", *(x.alias(f"_{n}") for n, x in {
            "n_v": F.size("v"), "n_f": F.size("f"), "n_r": F.size("r"), "n_u": times("u"), "f_positive": F.size(F.filter("f", lambda x: x["feed"] > 0)), "u_moving": times(F.filter("u", moves)), "u_values": F.size(F.filter("u", moves)),
        }.items()))
        assert told.count() >= least
        assert told.where(" OR ".join(f"NOT {x} <=> _{x}" for x in ("n_v", "n_f", "n_r", "n_u", "f_positive", "u_moving", "u_values"))).count() == 0


@pytest.mark.parametrize("name", ["aligned", "returns"])
def test_rows_of_a_day_are_not_held_together(spark, shared_dir, name):
    """Steps compiled together hold all rows that come of one row. Pairs of bars are made in one, the rows of a pair in another."""
    rows = QUERIES[name](spark, shared_dir).where("date = DATE '1996-01-09'")
    assert rows.collect()
    compiled = re.findall(r"\*\((\d+)\) Generate", rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
    assert len(compiled) >= 3 and len(set(compiled)) == 2


def test_level_metrics_match_sql_without_a_row_a_pair(spark, shared_dir, shared_db, sf_dir):
    same(spark, shared_dir, shared_db, "level_metrics")
    w = trial(spark, sf_dir)
    apart = Warehouse(spark, {x: w.tables[x] for x in ("vendor_bars", "feed_adj_bars")})
    assert sorted(explore.level_metrics(apart).collect()) == sorted(explore.level_metrics(w).collect())
    plan = explore.level_metrics(trial(spark, shared_dir))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (" not in plan.replace("(price", "price")  # bars are gathered by day, not joined


def test_level_metrics_with_few_ties_and_unknown_prices(spark):
    columns = "stock_id string, date date, open double, high double, low double, close double, year int, month int"
    day = dt.date(2001, 1, 1)
    bars = lambda prices: spark.createDataFrame([("1000", day, x, 1.0, float(k), None, 2001, 1) for k, x in enumerate(prices)], columns)
    pad = lambda rows, names: rows.select(*(n if n in rows.columns else F.lit(None).cast("string").alias(n) for n in names))
    v, f = [float(k * k % 97) for k in range(60)], [float(k % 7) / 3 for k in range(50)] + [None]
    w = Warehouse(spark, {"vendor_bars": pad(bars(v), VENDOR_BAR), "feed_adj_bars": pad(bars(f), BAR)})
    got = {r.price: r for r in explore.level_metrics(w).collect()}
    offs = [abs(a - b) for a in v for b in f if b is not None]
    assert [got[x].n for x in explore.LEVELS] == [60 * 51] * 4
    assert got["open"].p999_off == pytest.approx(float(np.quantile(offs, 0.999)), abs=1e-6) and got["open"].largest_off == round(max(offs), 6)
    assert (got["high"].p999_off, got["high"].exact_pct, got["close"].p999_off, got["close"].largest_off) == (0.0, 100.0, None, None)
    assert got["low"].p999_off == pytest.approx(float(np.quantile([abs(a - b) for a in range(60) for b in range(51)], 0.999)), abs=1e-6)
