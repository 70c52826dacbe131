"""Views with parameters. A range of dates also bounds the year, the partition key, so that scans prune folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewell.functions.exprs import c
from quotewell.plans.warehouse import Warehouse

Day = str | dt.date


def day(x: Day) -> dt.date:
    return x if isinstance(x, dt.date) else dt.date.fromisoformat(x)


def between(rows: DataFrame, lo: Day, hi: Day) -> DataFrame:
    """Rows from lo to hi, both included."""
    lo, hi = day(lo), day(hi)
    return rows.where(c("year").between(lo.year, hi.year) & c("date").between(F.lit(lo), F.lit(hi)))


def daily_prices_between(w: Warehouse, lo: Day, hi: Day) -> DataFrame:
    return between(w.feed_v_daily_prices, lo, hi)


def adj_daily_prices_between(w: Warehouse, lo: Day, hi: Day) -> DataFrame:
    return between(w.feed_v_adj_daily_prices, lo, hi)


def prices_combined_between(w: Warehouse, lo: Day, hi: Day) -> DataFrame:
    """Both sides of the join are pruned: the year is a join key."""
    return between(w.feed_v_prices_combined, lo, hi)


def vendor_prices_between(w: Warehouse, lo: Day, hi: Day) -> DataFrame:
    return between(w.vendor_v_adj_daily_prices, lo, hi)


def index_constituents_between(w: Warehouse, lo: Day, hi: Day) -> DataFrame:
    return between(w.vendor_v_index_constituents, lo, hi)


def effective_on(reviews: DataFrame, on: Day) -> DataFrame:
    """Rows of a review log in force on a day: effective_date <= day < next_effective_date (open if null)."""
    when = F.lit(day(on))
    return reviews.where((c("effective_date") <= when) & (c("next_effective_date").isNull() | (c("next_effective_date") > when)))


def effective_by_session(reviews: DataFrame, calendar: DataFrame) -> DataFrame:
    """A row for each session on which a review is in force. Sessions are numbered, so that intervals expand without a range join."""
    from pyspark.sql import Window

    days = calendar.select("date").distinct().withColumn("no", F.row_number().over(Window.orderBy("date")))  # a row a session
    ends = reviews.select("effective_date").unionByName(reviews.select(c("next_effective_date").alias("effective_date"))).where("effective_date IS NOT NULL").distinct()
    # for each end of an interval, the first session not before it: sessions and ends in one order
    marked = days.select(c("date").alias("at"), "no").unionByName(ends.select(c("effective_date").alias("at"), F.lit(None).cast("int").alias("no")))
    following = marked.withColumn("first", F.min("no").over(Window.orderBy("at").rangeBetween(Window.currentRow, Window.unboundedFollowing))).where("no IS NULL").select("at", "first")
    last = F.broadcast(days.agg(F.max("no").alias("last")))
    opened = reviews.join(following.select(c("at").alias("effective_date"), c("first").alias("a")), "effective_date")
    closed = opened.join(following.select(c("at").alias("next_effective_date"), c("first").alias("b")), "next_effective_date", "left").crossJoin(last)
    spans = closed.withColumn("z", F.coalesce(c("b") - 1, c("last"))).where("a IS NOT NULL AND a <= z")
    return spans.select(*reviews.columns, F.explode(F.sequence("a", "z")).alias("no")).join(F.broadcast(days), "no").drop("no")


def index_members_on(w: Warehouse, index_id: str, as_of: Day) -> DataFrame:
    """Members of an index on exactly that session; none if it was not published, never the nearest."""
    when = day(as_of)
    rows = w.vendor_v_index_constituents.where((c("year") == when.year) & (c("date") == F.lit(when)) & (c("index_id") == index_id))
    return rows.select("stock_id", "stock_name", c("prev_weight_pct").alias("weight_pct"), "index_factor", "free_float_factor", "cap_factor", "shares", "prev_adj_close")
