"""What to fetch next: calendar arithmetic, daily targets, reconciliation, refresh plans. All of it set algebra on small frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotewell.functions.exprs import c

#: Days fetched again, because corrections come late; days that a catch-up may take; rows that a workbook may lag and be alive.
REVISION_DAYS, MOST_CATCH_UP, ACTIVE_WINDOW = 3, 30, 20


def _day(x: dt.date) -> F.Column:
    return F.lit(x).cast("date")


def trading_days_between(calendar: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    return calendar.where(c("date").between(_day(lo), _day(hi))).select("date").distinct()


def last_closed_trading_day(calendar: DataFrame, on: dt.date) -> DataFrame:
    """One row: the newest calendar day up to on."""
    return calendar.where(c("date") <= _day(on)).agg(F.max("date").alias("date"))


def missing_dates(calendar: DataFrame, held: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    return trading_days_between(calendar, lo, hi).join(held.select("date"), "date", "left_anti")


def numbered(calendar: DataFrame) -> DataFrame:
    """Days with their place, from 1. A row a session: one window over it is small."""
    return calendar.select("date").distinct().withColumn("no", F.row_number().over(Window.orderBy("date")))


def shift_trading_days(calendar: DataFrame, on: dt.date, by: int) -> DataFrame:
    """One row: the day that many sessions after (before) the last session up to on, held inside the calendar."""
    days = numbered(calendar)
    ends = days.agg(F.max("no").alias("last"), F.max(F.when(c("date") <= _day(on), c("no"))).alias("at"))
    aim = F.greatest(F.lit(1), F.least(c("last"), F.coalesce(c("at"), F.lit(1)) + by))
    return days.join(F.broadcast(ends.select(aim.alias("no"))), "no").select("date")


def middle_days(calendar: DataFrame) -> DataFrame:
    """The middle session of each month: what a discovery samples."""
    month = Window.partitionBy("y", "m")
    rows = calendar.select("date", F.year("date").alias("y"), F.month("date").alias("m")).distinct()
    placed = rows.withColumn("rn", F.row_number().over(month.orderBy("date"))).withColumn("n", F.count("*").over(month))
    return placed.where(c("rn") == F.floor(c("n") / 2) + 1).select("date")


class TooFarBehind(RuntimeError):
    """More days are missing than a daily run may fetch."""


def daily_targets(calendar: DataFrame, held: DataFrame, known_empty: DataFrame, last_closed: dt.date, *, revision: int = REVISION_DAYS, most: int = MOST_CATCH_UP) -> DataFrame:
    """date, reason: days after the newest held, gaps inside what is held, and the newest days again."""
    mine = held.select("date").distinct()
    span = F.broadcast(mine.agg(F.min("date").alias("lo"), F.max("date").alias("hi")))
    days = calendar.where(c("date") <= _day(last_closed)).select("date").distinct().crossJoin(span)
    lacking = days.join(mine, "date", "left_anti").join(known_empty.select("date"), "date", "left_anti")
    forward = lacking.where(c("hi").isNull() | (c("date") > c("hi"))).select("date", F.lit("forward").alias("reason"))
    gaps = lacking.where((c("date") > c("lo")) & (c("date") < c("hi"))).select("date", F.lit("gap").alias("reason"))
    again = mine.where(c("date") <= _day(last_closed)).orderBy(F.desc("date")).limit(revision).select("date", F.lit("revision").alias("reason"))
    behind = forward.count()
    if behind > most:
        raise TooFarBehind(f"{behind} days are missing and a daily run fetches {most}: run a backfill")
    return forward.unionByName(gaps).unionByName(again)


def checkable(universe: DataFrame, delistings: DataFrame, bars: DataFrame) -> DataFrame:
    """Securities that a reconciliation may miss bars of: never delisted, or traded after the delisting (listed again). No events: all."""
    newest = delistings.groupBy("stock_id").agg(F.max("delisted_date").alias("gone"))
    last = bars.groupBy("stock_id").agg(F.max("date").alias("last_seen"))
    marked = universe.select("stock_id").distinct().join(newest, "stock_id", "left").join(last, "stock_id", "left")
    return marked.where(c("gone").isNull() | F.coalesce(c("last_seen") > c("gone"), F.lit(False))).select("stock_id")


def reconcile(universe: DataFrame, calendar: DataFrame, bars: DataFrame, delistings: DataFrame, thin_days: DataFrame, known_empty: DataFrame, last_closed: dt.date, stale_after: int = 30) -> DataFrame:
    """kind, key: days without bars, thin days, securities without any bar, and those whose bars have stopped."""
    held = bars.select("date").distinct()
    span = F.broadcast(held.agg(F.min("date").alias("lo"), F.max("date").alias("hi")))
    days = calendar.select("date").distinct().crossJoin(span).where("date BETWEEN lo AND hi")
    missing = days.join(held, "date", "left_anti").join(known_empty.select("date"), "date", "left_anti").select(F.lit("missing day").alias("kind"), c("date").cast("string").alias("key"))
    thin = thin_days.select(F.lit("thin day").alias("kind"), c("date").cast("string").alias("key"))
    wanted = checkable(universe, delistings, bars)
    last = bars.groupBy("stock_id").agg(F.max("date").alias("last_seen"))
    absent = wanted.join(last, "stock_id", "left_anti").select(F.lit("absent security").alias("kind"), c("stock_id").alias("key"))
    cutoff = F.date_sub(_day(last_closed), stale_after)
    stale = wanted.join(last, "stock_id").where(c("last_seen") < cutoff).select(F.lit("stale security").alias("kind"), c("stock_id").alias("key"))
    return missing.unionByName(thin).unionByName(absent).unionByName(stale)


def workbook_plan(calendar: DataFrame, latest: DataFrame, last_closed: dt.date, window: int = ACTIVE_WINDOW) -> DataFrame:
    """stock_id, date: sessions that active workbooks lack. Active are those near the date that most workbooks end at (the later of equals)."""
    days = numbered(calendar)
    modal = latest.groupBy(c("last_date").alias("modal")).count().orderBy(F.desc("count"), F.desc("modal")).limit(1).select("modal")
    at = latest.join(days.withColumnRenamed("date", "last_date"), "last_date").withColumnRenamed("no", "own")
    top = modal.join(days.withColumnRenamed("date", "modal"), "modal").select(c("no").alias("modal_no"))
    end = days.where(c("date") <= _day(last_closed)).agg(F.max("no").alias("end"))
    active = at.crossJoin(F.broadcast(top)).crossJoin(F.broadcast(end)).where((c("own") >= c("modal_no") - window) & (c("own") < c("end")))
    # sessions are numbered, so that what each workbook lacks expands without a range join
    return active.select("stock_id", F.explode(F.sequence(c("own") + 1, c("end"))).alias("no")).join(days, "no").select("stock_id", "date")


def index_seed_plan(calendar: DataFrame, latest: dt.date, as_of: dt.date) -> DataFrame:
    """date, required: sessions after latest up to as_of, and as an option the next one, whose list is published ahead; never beyond the year."""
    days = calendar.select("date").distinct().where((c("date") > _day(latest)) & (F.year("date") == latest.year))
    due = days.where(c("date") <= _day(as_of)).select("date", F.lit(True).alias("required"))
    following = calendar.select("date").where(c("date") > _day(as_of)).agg(F.min("date").alias("date"))
    optional = following.join(days, "date", "left_semi").select("date", F.lit(False).alias("required"))
    return due.unionByName(optional)


def members_without_prices(index_universe: DataFrame) -> DataFrame:
    return index_universe.where(~c("has_price_history")).select("stock_id", "stock_name", "first_date", "last_date")


def company_pool(companies: DataFrame, since: dt.date) -> DataFrame:
    """Companies ever listed and not delisted before the history starts."""
    return companies.where(c("listed_date").isNotNull() & (c("delisted_date").isNull() | (c("delisted_date") >= _day(since))))
