"""Views over the vendor's workbooks: bars, securities, coverage and gaps, index constituents and membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.functions.exprs import c, last_by
from quotewell.operators.feed_views import coverage, runs_of, thin
from quotewell.plans.warehouse import Warehouse, view

VENDOR_BAR = (
    "date", "stock_id", "stock_name", "open", "high", "low", "close", "volume_k_shares", "turnover_k", "transactions", "return_pct", "return_ln", "turnover_pct",
    "shares_outstanding_k", "market_cap_m", "market_cap_weight_pct", "turnover_weight_pct", "pe_a", "pe_b", "pbr_a", "pbr_b", "psr_b", "div_yield_a", "cash_div_yield",
    "price_change", "high_low_spread_pct", "bid", "offer", "next_ref_price", "next_limit_up", "next_limit_down", "limit_flag", "attention_flag", "disposition_flag",
    "full_delivery_flag", "market", "source_file", "ingested_at", "year", "month",
)
CONSTITUENT = (
    "date", "index_id", "index_name", "stock_id", "stock_name", "prev_weight_pct", "index_factor", "free_float_factor", "cap_factor", "shares", "index_base_value",
    "prev_adj_close", "source_file", "ingested_at", "year", "month",
)
WORKBOOK = ("file_bytes", "modified_at", "sheet_name", "defined_name", "defined_range", "declared_rows", "vendor_table", "vendor_field_count", "descending", "query_matches_contract", "scanned_at")


@view
def vendor_v_adj_daily_prices(w: Warehouse) -> DataFrame:
    return w.vendor_bars.select(*VENDOR_BAR)


def newest_day(w: Warehouse, bars: str = "vendor_bars") -> DataFrame:
    """One row: the newest day of a base table of bars."""
    return F.broadcast(w.newest_rows(bars).agg(F.max("date").alias("newest")))


@view
def vendor_v_securities(w: Warehouse) -> DataFrame:
    bars = w.vendor_v_adj_daily_prices
    each = bars.groupBy("stock_id").agg(
        last_by("stock_name", "date").alias("stock_name"), last_by("market", "date").alias("market"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("trading_days")
    )
    return each.crossJoin(newest_day(w)).withColumn("is_current", c("last_date") == c("newest")).drop("newest")


@view
def vendor_v_trading_calendar(w: Warehouse) -> DataFrame:
    return w.vendor_v_adj_daily_prices.select("date").distinct()


@view
def vendor_v_last_trading_day(w: Warehouse) -> DataFrame:
    return w.newest_rows("vendor_bars").agg(F.max("date").alias("date"))


@view
def vendor_v_daily_coverage(w: Warehouse) -> DataFrame:
    return coverage(w.vendor_v_adj_daily_prices)


@view
def vendor_v_thin_trading_days(w: Warehouse) -> DataFrame:
    return thin(w.vendor_v_daily_coverage, "row_count", 0.5)


@view
def vendor_v_security_gaps(w: Warehouse) -> DataFrame:
    """Sessions between a security's first and last day on which it has no bar.

    No range join: with sessions numbered, a gap is a jump between the numbers of neighbouring bars, and only jumps are expanded. The calendar has
    one row a session, so numbering it, and looking numbers up, costs nothing beside the bars.
    """
    from pyspark.sql import Window

    days = w.vendor_v_trading_calendar.withColumn("no", F.row_number().over(Window.orderBy("date")))
    near = Window.partitionBy("stock_id").orderBy("no")
    bars = w.vendor_v_adj_daily_prices.select("stock_id", "date").join(days, "date").withColumn("before", F.lag("no").over(near))
    jumps = bars.where("no - before > 1").select("stock_id", F.explode(F.sequence(c("before") + 1, c("no") - 1)).alias("no"))
    return jumps.join(days, "no").join(w.vendor_v_securities.select("stock_id", "stock_name"), "stock_id").select("stock_id", "stock_name", c("date").alias("missing_date"))


@view
def vendor_v_workbooks(w: Warehouse) -> DataFrame:
    return w.vendor_workbooks.select("source_file", "stock_id", *WORKBOOK)


def file_mb() -> Column:
    return F.round(F.col("file_bytes") / F.lit(1024.0) / F.lit(1024.0), 2).alias("file_mb")


@view
def vendor_v_workbook_status(w: Warehouse) -> DataFrame:
    """Workbooks against what was parsed from them. Days behind: sessions after the security's last, from its place in the calendar."""
    from pyspark.sql import Window

    days = w.vendor_v_trading_calendar
    later = days.withColumn("days_behind", F.row_number().over(Window.orderBy(F.desc("date"))) - F.lit(1)).select(c("date").alias("last_date"), c("days_behind").cast("long").alias("days_behind"))
    status = w.vendor_v_workbooks.join(w.vendor_v_securities, "stock_id", "left").join(later, "last_date", "left")
    return status.select(
        "stock_id", "stock_name", "source_file", "modified_at", "first_date", "last_date", "trading_days", "declared_rows", (c("declared_rows") - c("trading_days")).alias("rows_delta"),
        "is_current", F.coalesce("days_behind", F.lit(0)).alias("days_behind"), "query_matches_contract", file_mb(),
    )


@view
def vendor_v_ingestion_runs(w: Warehouse) -> DataFrame:
    return runs_of(w.vendor_runs)


@view
def vendor_v_index_constituents(w: Warehouse) -> DataFrame:
    return w.index_rows.select(*CONSTITUENT)


@view
def vendor_v_index_membership(w: Warehouse) -> DataFrame:
    rows = w.vendor_v_index_constituents
    each = rows.groupBy("index_id", "stock_id").agg(
        last_by("stock_name", "date").alias("stock_name"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("days_in_index"),
        last_by("prev_weight_pct", "date").alias("latest_weight_pct"),
    )
    return each.join(rows.groupBy("index_id").agg(F.max("date").alias("newest")), "index_id").withColumn("is_current", c("last_date") == c("newest")).drop("newest")


@view
def vendor_v_index_universe(w: Warehouse) -> DataFrame:
    members = w.vendor_v_index_membership
    each = members.groupBy("stock_id").agg(
        F.max_by("stock_name", F.struct("last_date", "index_id")).alias("stock_name"), F.bool_or(c("index_id") == "TWN50").alias("in_twn50"), F.bool_or(c("index_id") == "TM100").alias("in_tm100"),
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
    )
    priced = w.vendor_v_securities.select("stock_id", F.lit(True).alias("priced"))
    return each.join(priced, "stock_id", "left").withColumn("has_price_history", c("priced").isNotNull()).drop("priced")


@view
def vendor_v_index_calendar(w: Warehouse) -> DataFrame:
    return w.vendor_v_index_constituents.select("index_id", "date").distinct()


@view
def vendor_v_index_last_trading_day(w: Warehouse) -> DataFrame:
    return w.vendor_v_index_constituents.groupBy("index_id").agg(F.max("date").alias("date"))


@view
def vendor_v_index_daily_coverage(w: Warehouse) -> DataFrame:
    return w.vendor_v_index_constituents.groupBy("index_id", "date").agg(
        F.count("*").alias("constituents"), F.countDistinct("stock_id").alias("distinct_stocks"), F.round(F.sum("prev_weight_pct"), 4).alias("total_weight_pct"), F.max("ingested_at").alias("last_ingested")
    )


@view
def vendor_v_thin_index_days(w: Warehouse) -> DataFrame:
    return thin(w.vendor_v_index_daily_coverage, "constituents", 0.9, "index_id")


@view
def vendor_v_index_price_gaps(w: Warehouse) -> DataFrame:
    """Members without a bar on a session of the index, up to the newest bar."""
    bars = w.vendor_v_adj_daily_prices
    asked = w.vendor_v_index_constituents.select("index_id", "date", "stock_id", "stock_name").crossJoin(newest_day(w)).where("date <= newest").drop("newest")
    return asked.join(bars.select("stock_id", "date"), ["stock_id", "date"], "left_anti").join(w.vendor_v_index_universe.select("stock_id", "has_price_history"), "stock_id").select("index_id", "date", "stock_id", "stock_name", "has_price_history")


@view
def vendor_v_index_workbooks(w: Warehouse) -> DataFrame:
    return w.vendor_index_workbooks.select("source_file", "index_id", "year", *WORKBOOK)


@view
def vendor_v_index_workbook_status(w: Warehouse) -> DataFrame:
    """As of w.as_of if set, else today."""
    parsed = w.vendor_v_index_constituents.groupBy("index_id", "year").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.countDistinct("date").alias("sessions"), F.count("*").alias("parsed_rows"))
    today = F.current_date() if w.as_of is None else F.lit(w.as_of)
    status = w.vendor_v_index_workbooks.join(parsed, ["index_id", "year"], "left")
    return status.select(
        "index_id", "year", "source_file", "modified_at", "first_date", "last_date", "sessions", "parsed_rows", "declared_rows", (c("declared_rows") - c("parsed_rows")).alias("rows_delta"),
        (c("year") == F.year(today)).alias("is_current_year"), "query_matches_contract", file_mb(),
    )
