"""From raw to processed tables: typing, deduplication, first and last seen, universes, calendars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewell.functions.exprs import c
from quotewell.functions.scalars import clean_text, in_scope, classify, normalise_industry, parse_date
from quotewell.sources.schemas import PRICE, enforce

SOURCES = ("market", "ticker")


def type_prices(raw: DataFrame, source: str) -> DataFrame:
    """Raw bars under the processed names. Rows without a date or id go: they have no key."""
    if source not in SOURCES:
        raise ValueError(f"source must be one of {SOURCES}, not {source!r}")
    names = {"open": "open", "max": "high", "min": "low", "close": "close", "spread": "spread"}
    counts = {"Trading_Volume": "volume", "Trading_money": "turnover_value", "Trading_turnover": "transactions"}
    typed = raw.select(
        parse_date(c("date")).alias("date"), clean_text(c("stock_id")).alias("stock_id"), *(c(a).cast("double").alias(b) for a, b in names.items()),
        *(c(a).cast("bigint").alias(b) for a, b in counts.items()), F.lit(source).alias("source"),
    )
    return typed.where("date IS NOT NULL AND stock_id IS NOT NULL")


def dedupe_prices(ticker: DataFrame, market: DataFrame, prefer: str) -> DataFrame:
    """One bar a security and day: the preferred source's where both have one, else whichever there is.

    Of rows of one source and key the one with the largest volume stays, then the largest close: the result does not depend on order.
    """
    if prefer not in SOURCES:
        raise ValueError(f"unknown preference {prefer!r}")
    both = type_prices(ticker, "ticker").unionByName(type_prices(market, "market"))
    best = Window.partitionBy("stock_id", "date").orderBy((c("source") == prefer).desc(), F.desc_nulls_last("volume"), F.desc_nulls_last("close"))
    return both.withColumn("rn", F.row_number().over(best)).where("rn = 1").drop("rn")


def processed_prices(ticker: DataFrame, market: DataFrame, prefer: str, ingested_at: Column | None = None) -> DataFrame:
    """The full rebuild: deduplicated, under contract, with partition keys. Spill and shuffle take the place of a loop over years."""
    rows = enforce(dedupe_prices(ticker, market, prefer).withColumn("ingested_at", F.current_timestamp() if ingested_at is None else ingested_at), PRICE)
    return rows.withColumn("year", F.year("date")).withColumn("month", F.month("date"))


def stock_info(raw: DataFrame, aliases: dict[str, str], index_categories: tuple[str, ...]) -> DataFrame:
    """Content changes of the master: every distinct content with the day it was first seen; unknown days come first."""
    content = raw.select(
        parse_date(c("date")).alias("snapshot_date"), clean_text(c("stock_id")).alias("stock_id"), clean_text(c("stock_name")).alias("stock_name"),
        clean_text(c("industry_category")).alias("industry_category"), clean_text(c("type")).alias("type"),
    ).where("stock_id IS NOT NULL")
    first = content.groupBy("stock_id", "stock_name", "industry_category", "type").agg(F.min("snapshot_date").alias("snapshot_date"))
    norm = normalise_industry(c("industry_category"), aliases)
    return first.select("snapshot_date", "stock_id", "stock_name", "industry_category", norm.alias("industry_category_norm"), "type", F.coalesce(c("industry_category").isin(*index_categories), F.lit(False)).alias("is_index"))


def industry(raw: DataFrame) -> DataFrame:
    """Pairs of security and industry with the day they were last seen."""
    rows = raw.select(clean_text(c("stock_id")).alias("stock_id"), clean_text(c("industry")).alias("industry"), clean_text(c("sub_industry")).alias("sub_industry"), parse_date(c("date")).alias("snapshot_date"))
    return rows.where("stock_id IS NOT NULL").groupBy("stock_id", "industry", "sub_industry").agg(F.max("snapshot_date").alias("snapshot_date"))


def delisting(raw: DataFrame) -> DataFrame:
    return raw.select(clean_text(c("stock_id")).alias("stock_id"), clean_text(c("stock_name")).alias("stock_name"), parse_date(c("date")).alias("delisted_date")).where("stock_id IS NOT NULL").distinct()


def latest_delisting(events: DataFrame) -> DataFrame:
    """The newest event of each security."""
    return events.groupBy("stock_id").agg(F.max_by("stock_name", F.struct("delisted_date", "stock_name")).alias("stock_name"), F.max("delisted_date").alias("delisted_date"))


def delisted_securities(discovered: DataFrame, events: DataFrame, master: DataFrame) -> DataFrame:
    """What was discovered or delisted, is in scope, and is not in the current master; source tells who knows it."""
    seen = discovered.select("stock_id", "shape", "first_seen", "last_seen", F.lit(True).alias("d"))
    logged = latest_delisting(events).withColumn("l", F.lit(True))
    both = seen.join(logged, "stock_id", "full").where(in_scope(c("stock_id"))).join(master.select("stock_id").distinct(), "stock_id", "left_anti")
    source = F.when(c("d") & c("l"), "both").when(c("d"), "discovered").otherwise("delisting")
    return both.select("stock_id", "stock_name", "delisted_date", F.coalesce("shape", classify(c("stock_id"))).alias("shape"), "first_seen", "last_seen", source.alias("source"))


def expanded_calendar(official: DataFrame, *observed: DataFrame) -> DataFrame:
    """Official days and days with a price; source tells official from derived."""
    days = reduce(DataFrame.unionByName, (x.select("date") for x in (official, *observed))).where("date IS NOT NULL").distinct()
    return days.join(official.select("date", F.lit(True).alias("o")).distinct(), "date", "left").select("date", F.when(c("o"), "official").otherwise("derived").alias("source"))


def record_empty(ledger: DataFrame, dates: DataFrame, newest_held: DataFrame, now: Column) -> DataFrame:
    """The ledger of closed days with those dates that are strictly older than the newest day held: a newer empty day may still fill up.

    newest_held has one row and column, date. Adding is idempotent; as upstream, every row gets the new stamp.
    """
    safe = dates.select("date").crossJoin(F.broadcast(newest_held.select(c("date").alias("newest")))).where("date < newest").select("date")
    return ledger.select("date").unionByName(safe).where("date IS NOT NULL").distinct().withColumn("confirmed_at", now)


def observations(samples: DataFrame, discovered_at: Column) -> DataFrame:
    """Codes seen in sampled days: kind, span and hits."""
    days = samples.select(F.countDistinct("date").alias("sampled_days"))
    tally = samples.groupBy("stock_id").agg(F.min("date").alias("first_seen"), F.max("date").alias("last_seen"), F.countDistinct("date").alias("sample_hits"))
    return tally.crossJoin(F.broadcast(days)).select("stock_id", classify(c("stock_id")).alias("shape"), "first_seen", "last_seen", "sample_hits", "sampled_days", discovered_at.alias("discovered_at"))


def merge_observations(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two discoveries as one: spans widen, hits and days add up."""
    return old.unionByName(new).groupBy("stock_id").agg(
        F.max("shape").alias("shape"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("sample_hits").alias("sample_hits"), F.sum("sampled_days").alias("sampled_days"),
        F.max("discovered_at").alias("discovered_at"),
    )


class KeyError_(ValueError):
    """Rows that break a key; the message has the first few."""


def assert_unique(df: DataFrame, *keys: str) -> DataFrame:
    """df, if its keys are unique."""
    worst = df.groupBy(*keys).count().where("count > 1").orderBy(F.desc("count"), *keys).limit(5).collect()
    if worst:
        raise KeyError_(f"{', '.join(keys)} is not unique: " + "; ".join(str(tuple(r)) for r in worst))
    return df


def assert_one_file_a_day(df: DataFrame) -> DataFrame:
    """df of index rows, if no session of an index comes from two workbooks."""
    worst = df.groupBy("index_id", "date").agg(F.countDistinct("source_file").alias("files")).where("files > 1").orderBy("index_id", "date").limit(5).collect()
    if worst:
        raise KeyError_("sessions from several workbooks: " + "; ".join(f"{r.index_id} {r.date}" for r in worst))
    return df


def rebuilt(df: DataFrame, *keys: str) -> DataFrame:
    """A vendor dataset ready to be written: not empty, unique keys, partition keys."""
    if df.isEmpty():
        raise ValueError("nothing to rebuild from: the processed data stay as they are")
    return assert_unique(df, *keys).withColumn("year", F.year("date")).withColumn("month", F.month("date"))
