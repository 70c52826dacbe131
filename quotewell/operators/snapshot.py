"""Size, coverage and health of the warehouse as it is now: a table each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.functions.exprs import c
from quotewell.plans.warehouse import Warehouse

QUERIES: dict[str, object] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _span(rows: DataFrame, *keys: str, days: str | None = "trading_days") -> DataFrame:
    out = [F.count("*").alias("n_rows"), F.countDistinct("stock_id").alias("securities"), F.min("date").alias("first_date"), F.max("date").alias("last_date")]
    return rows.groupBy(*keys).agg(*out, *([F.countDistinct("date").alias(days)] if days else []))


@query
def snapshot_price_tables(w: Warehouse) -> DataFrame:
    names = ("feed_v_daily_prices", "feed_v_adj_daily_prices", "vendor_v_adj_daily_prices", "vendor_v_index_constituents")
    return reduce(DataFrame.unionByName, (_span(getattr(w, x)).select(F.lit(x).alias("view_name"), "*") for x in names))


@query
def snapshot_index_constituents(w: Warehouse) -> DataFrame:
    return _span(w.vendor_v_index_constituents, "index_id", days="sessions")


@query
def snapshot_feed_universe(w: Warehouse) -> DataFrame:
    return w.feed_v_securities_all.groupBy(F.coalesce("type", F.lit("(delisted, recovered)")).alias("type"), "is_delisted", "is_index").agg(F.count("*").alias("securities"))


@query
def snapshot_feed_delisted_coverage(w: Warehouse) -> DataFrame:
    held = lambda x, name: x.select("stock_id").distinct().withColumn(name, F.lit(True))
    rows = w.feed_v_delisted_securities.join(held(w.feed_v_daily_prices, "raw"), "stock_id", "left").join(held(w.feed_v_adj_daily_prices, "adj"), "stock_id", "left")
    return rows.agg(F.count("*").alias("delisted_recovered"), F.count("raw").alias("with_unadjusted"), F.count("adj").alias("with_adjusted"))


@query
def snapshot_vendor_universe(w: Warehouse) -> DataFrame:
    return w.vendor_v_securities.groupBy("is_current").agg(F.count("*").alias("securities"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


@query
def snapshot_vendor_market_rows(w: Warehouse) -> DataFrame:
    return w.vendor_v_adj_daily_prices.groupBy("market").agg(F.count("*").alias("n_rows"), F.countDistinct("stock_id").alias("securities"))


@query
def snapshot_rows_per_year(w: Warehouse) -> DataFrame:
    sides = {"feed_unadjusted": w.feed_v_daily_prices, "feed_adjusted": w.feed_v_adj_daily_prices, "vendor_adjusted": w.vendor_v_adj_daily_prices}
    return reduce(lambda a, b: a.join(b, "year", "full"), (x.groupBy("year").agg(F.count("*").alias(name)) for name, x in sides.items()))


@query
def snapshot_ingestion_runs(w: Warehouse) -> DataFrame:
    runs = {"feed": w.feed_v_ingestion_runs, "vendor": w.vendor_v_ingestion_runs}
    each = [x.groupBy("job", "status").agg(F.count("*").alias("runs"), F.min("started_at").alias("first_run"), F.max("started_at").alias("last_run")).withColumn("pipeline", F.lit(name)) for name, x in runs.items()]
    return reduce(DataFrame.unionByName, each).select("pipeline", "job", "status", "runs", "first_run", "last_run")


@query
def snapshot_health(w: Warehouse) -> DataFrame:
    """One row. Each figure is an aggregate of its own; one-row frames are joined."""
    n = lambda rows, name: rows.agg(F.count("*").alias(name))
    gaps = w.vendor_v_security_gaps.agg(F.count("*").alias("vendor_gap_rows"), F.countDistinct("stock_id").alias("vendor_gap_securities"))
    status = w.vendor_v_workbook_status
    figures = [
        n(w.feed_v_missing_trading_days, "feed_missing_days"), n(w.feed_v_thin_trading_days, "feed_thin_days"), n(w.feed_v_known_empty_days, "feed_known_empty_days"), n(w.feed_v_trading_calendar, "feed_calendar_days"),
        n(w.vendor_v_thin_trading_days, "vendor_thin_days"), gaps, n(w.vendor_v_index_price_gaps, "vendor_index_price_gaps"), n(w.vendor_v_index_universe.where(~c("has_price_history")), "vendor_members_without_prices"),
        n(status.where("rows_delta <> 0"), "vendor_workbook_rows_delta"), n(status.where(~c("query_matches_contract")), "vendor_contract_mismatch"),
    ]
    return reduce(DataFrame.crossJoin, figures)
