"""Every registered warehouse query against its SQL on the same tables."""

import datetime as dt
import math

import duckdb
import pytest

from quotewell.plans.oracles import all_sql
from quotewell.plans.queries import RANGE, all_queries, trial
from quotewell.plans.warehouse import RANGES, VIEWS

QUERIES, SQL = all_queries(), all_sql()
TABLES = ("lineitem", "orders", "customer", "supplier", "nation", "region", "part", "events")


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None)
    return tuple(x) if isinstance(x, list) else x


def table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and len(QUERIES) > 100 and len([v for v in VIEWS if "_v_" in v]) == 39


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, db, name):
    got = QUERIES[name](spark, sf_dir)
    told = db.execute(SQL[name])
    names = [x[0] for x in told.description]
    assert sorted(got.columns) == sorted(names)
    assert table(got.columns, [tuple(r) for r in got.collect()]) == table(names, told.fetchall())


def test_views_register_and_answer_sql(spark, sf_dir):
    w = trial(spark, sf_dir)
    assert "feed_v_daily_prices" in w.register()
    by_sql = spark.sql("SELECT count(*) AS n FROM vendor_v_adj_daily_prices WHERE year = :y", args={"y": 1998}).first().n
    assert by_sql == w.vendor_v_adj_daily_prices.where("year = 1998").count() > 0
    with pytest.raises(AttributeError):
        w.no_such_view


def test_range_prunes_folders(spark, sf_dir, tmp_path):
    from quotewell.operators.between import between
    from quotewell.sources.sinks import write_partitioned

    w = trial(spark, sf_dir)
    write_partitioned(w.feed_v_daily_prices, str(tmp_path / "bars"))
    plan = between(spark.read.parquet(str(tmp_path / "bars")), "1997-11-15", "1998-02-14")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [IsNotNull(date)" in plan


def test_ranges_are_table_functions(spark, sf_dir, db):
    w = trial(spark, sf_dir)
    w.register()
    lo, hi = RANGE
    for name in RANGES:
        call = f"{name}('TM100', '1998-01-05')" if name == "index_members_on" else f"{name}('{lo}', '{hi}')"
        by_sql, by_call = spark.sql(f"SELECT * FROM {call}"), QUERIES[name](spark, sf_dir)
        assert by_sql.columns == by_call.columns
        assert table(by_sql.columns, [tuple(r) for r in by_sql.collect()]) == table(by_call.columns, [tuple(r) for r in by_call.collect()])


def test_table_function_prunes_folders(spark, sf_dir, tmp_path):
    from quotewell.sources.readers import open_warehouse
    from quotewell.sources.sinks import write_partitioned

    write_partitioned(trial(spark, sf_dir).feed_bars, str(tmp_path / "processed" / "daily-prices"))
    open_warehouse(spark, str(tmp_path)).register()
    plan = spark.sql("SELECT * FROM daily_prices_between('1997-11-15', '1998-02-14')")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "1997" in plan.split("PartitionFilters")[1] and "PushedFilters: [IsNotNull(date)" in plan
