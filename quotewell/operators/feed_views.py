"""Views over the exchange feed: calendar, security master, industries, prices, runs and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotewell.functions.exprs import c, neighbour_median
from quotewell.plans.warehouse import Warehouse, view

BAR = ("date", "stock_id", "open", "high", "low", "close", "spread", "volume", "turnover_value", "transactions", "source", "ingested_at", "year", "month")


@view
def feed_v_trading_calendar(w: Warehouse) -> DataFrame:
    weekday = F.dayofweek("date") - 1  # 0 is Sunday
    return w.feed_calendar.select("date", "source", F.year("date").alias("year"), F.month("date").alias("month"), weekday.alias("day_of_week"), weekday.isin(0, 6).alias("is_weekend"))


@view
def feed_v_stock_info_history(w: Warehouse) -> DataFrame:
    return w.feed_stock_info.select("snapshot_date", "stock_id", "stock_name", "industry_category", "industry_category_norm", "type", "is_index")


@view
def feed_v_stock_info_latest(w: Warehouse) -> DataFrame:
    """The newest row of each id; rows without a date are the oldest, and categories break ties, then the other columns: the result does not depend on the order of rows."""
    newest = Window.partitionBy("stock_id").orderBy(F.desc_nulls_last("snapshot_date"), F.asc_nulls_last("industry_category"), "stock_name", "industry_category_norm", "type", "is_index")
    return w.feed_v_stock_info_history.withColumn("rn", F.row_number().over(newest)).where("rn = 1").drop("rn")


@view
def feed_v_securities(w: Warehouse) -> DataFrame:
    return w.feed_v_stock_info_latest.where(~c("is_index"))


@view
def feed_v_indices(w: Warehouse) -> DataFrame:
    return w.feed_v_stock_info_latest.where("is_index")


@view
def feed_v_delisted_securities(w: Warehouse) -> DataFrame:
    return w.feed_delisted.select("stock_id", "stock_name", "delisted_date", "shape", "first_seen", "last_seen", "source")


@view
def feed_v_securities_all(w: Warehouse) -> DataFrame:
    """Every security ever: the current master, marked if delisted, and those found only among the delisted."""
    gone = w.feed_v_delisted_securities
    current = w.feed_v_stock_info_latest.drop("snapshot_date")
    marked = current.join(gone.select("stock_id", "delisted_date", F.lit(True).alias("found")), "stock_id", "left").withColumn("is_delisted", c("found").isNotNull())
    lost = gone.join(current, "stock_id", "left_anti").select(
        "stock_id", "stock_name", *(F.lit(None).cast("string").alias(x) for x in ("industry_category", "industry_category_norm", "type")), F.lit(False).alias("is_index"), F.lit(True).alias("is_delisted"), "delisted_date"
    )
    return marked.select(lost.columns).unionByName(lost)


@view
def feed_v_industry(w: Warehouse) -> DataFrame:
    return w.feed_industry.select("stock_id", "industry", "sub_industry", "snapshot_date")


@view
def feed_v_industry_by_stock(w: Warehouse) -> DataFrame:
    names = lambda x: F.sort_array(F.collect_set(x))  # noqa: E731  sorted, so that the result is one
    return w.feed_v_industry.groupBy("stock_id").agg(names("industry").alias("industries"), names("sub_industry").alias("sub_industries"), F.max("snapshot_date").alias("last_seen"))


@view
def feed_v_daily_prices(w: Warehouse) -> DataFrame:
    return w.feed_bars.select(*BAR)


@view
def feed_v_adj_daily_prices(w: Warehouse) -> DataFrame:
    return w.feed_adj_bars.select(*BAR)


@view
def feed_v_daily_prices_enriched(w: Warehouse) -> DataFrame:
    """Bars with their security. The master has a row a security, and AQE broadcasts it where it is small enough."""
    about = w.feed_v_securities_all.select("stock_id", "stock_name", c("industry_category_norm").alias("industry"), "type", "is_index", "is_delisted", "delisted_date")
    return w.feed_v_daily_prices.join(about, "stock_id", "left").withColumn("is_delisted", F.coalesce("is_delisted", F.lit(False)))


@view
def feed_v_prices_combined(w: Warehouse) -> DataFrame:
    """Unadjusted bars beside adjusted ones. year and month are join keys, too, so that a filter on them prunes both sides."""
    adjusted = w.feed_v_adj_daily_prices.select("stock_id", "date", "year", "month", *(c(x).alias(f"adj_{x}") for x in ("open", "high", "low", "close")))
    both = w.feed_v_daily_prices.join(adjusted, ["stock_id", "date", "year", "month"], "left")
    factor = F.when(c("close") != 0, c("adj_close") / c("close")).alias("adj_factor")
    return both.select("date", "stock_id", "open", "high", "low", "close", "adj_open", "adj_high", "adj_low", "adj_close", "volume", "turnover_value", "transactions", factor, "year", "month")


def runs_of(table: DataFrame) -> DataFrame:
    """A run log; metrics stay JSON text, because every job has its own."""
    errors = F.coalesce("errors", F.array().cast("array<string>")) if "errors" in table.columns else F.array().cast("array<string>")
    when = lambda x: F.try_to_timestamp(c(x)).cast("timestamp_ntz").alias(x)
    return table.select("job", "status", when("started_at"), when("finished_at"), "duration_seconds", "host", "metrics", errors.alias("errors"), F.size(errors).alias("error_count"))


@view
def feed_v_ingestion_runs(w: Warehouse) -> DataFrame:
    return runs_of(w.feed_runs)


@view
def feed_v_last_trading_day(w: Warehouse) -> DataFrame:
    return w.newest_rows("feed_bars").agg(F.max("date").alias("date"))


def coverage(bars: DataFrame) -> DataFrame:
    return bars.groupBy("date").agg(F.count("*").alias("row_count"), F.countDistinct("stock_id").alias("securities"), F.max("ingested_at").alias("last_ingested"))


@view
def feed_v_daily_coverage(w: Warehouse) -> DataFrame:
    return coverage(w.feed_v_daily_prices)


@view
def feed_v_known_empty_days(w: Warehouse) -> DataFrame:
    return w.feed_known_empty.select("date", "confirmed_at")


@view
def feed_v_missing_trading_days(w: Warehouse) -> DataFrame:
    """Calendar days inside the observed range without a bar and not known to be empty."""
    held = w.feed_v_daily_prices
    span = held.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    days = w.feed_v_trading_calendar.select("date").crossJoin(F.broadcast(span)).where("date BETWEEN first AND last").select("date")
    return days.join(held.select("date").distinct(), "date", "left_anti").join(w.feed_v_known_empty_days, "date", "left_anti")


def thin(days: DataFrame, count: str, least: float, *keys: str) -> DataFrame:
    """Days with fewer rows than a share of the median of the eleven days around them.

    The window runs over one row a day (and key): thousands of rows, however large the prices are.
    """
    around = days.select(*keys, "date", count, neighbour_median(count, *keys).alias("neighbour_median"))
    few = around.where((c("neighbour_median") > 0) & (c(count) < c("neighbour_median") * least))
    return few.withColumn("ratio", F.round(c(count).cast("double") / c("neighbour_median"), 3))


@view
def feed_v_thin_trading_days(w: Warehouse) -> DataFrame:
    return thin(w.feed_v_daily_coverage, "row_count", 0.5)
