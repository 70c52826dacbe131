"""Jobs: rebuilds in dependency order, stages that stop at the first failure, backfills that can be resumed."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.functions.exprs import c
from quotewell.operators import etl
from quotewell.sources import schemas
from quotewell.sources.readers import exists, partitioned, single, snapshots
from quotewell.sources.sinks import RunRecord
from quotewell.sources.versions import publish

#: Preferred source of each price dataset: a market day is final for unadjusted bars; an adjusted one is a snapshot of an older basis.
PRICES = {"daily-prices": ("daily", "market"), "adj-daily-prices": ("adj", "ticker")}


def rebuild_prices(spark: SparkSession, root: str, dataset: str, ingested_at: Column | None = None) -> int:
    """Processed prices anew from all raw files, published whole. An empty source is an error and leaves what is there. Returns rows kept."""
    raw, prefer = PRICES[dataset]
    ticker, market = (snapshots(spark, f"{root}/raw/{raw}-{source}", schemas.RAW_PRICE) for source in ("ticker", "market"))
    rows = etl.processed_prices(ticker, market, prefer, ingested_at)
    if rows.isEmpty():
        raise ValueError(f"{dataset}: no raw rows")
    live = f"{root}/processed/{dataset}"
    publish(rows, live, "date", "stock_id")
    return partitioned(spark, live, schemas.PRICE).count()


def rebuild_dimensions(spark: SparkSession, root: str, aliases: dict[str, str], index_categories: tuple[str, ...]) -> list[str]:
    """Master, industries, delisting log, calendar, delisted securities: each after what it needs. Returns what was written."""
    raw = lambda name, contract: snapshots(spark, f"{root}/raw/{name}", contract)
    at = lambda name: f"{root}/processed/{name}"
    written: list[str] = []

    def keep(name: str, df: DataFrame, contract: object) -> DataFrame:
        publish(schemas.enforce(df, contract), at(name), by=())
        written.append(name)
        return single(spark, at(name), contract)

    master = keep("stock-info", etl.stock_info(raw("stock-info", schemas.RAW_STOCK_INFO), aliases, index_categories), schemas.STOCK_INFO)
    keep("industry", etl.industry(raw("industry", schemas.RAW_INDUSTRY)), schemas.INDUSTRY)
    log = etl.delisting(raw("delisting", schemas.RAW_DELISTING))
    if exists(spark, f"{root}/raw/delisting"):
        keep("delisting", log, schemas.DELISTING)
    official = raw("trading-dates", schemas.schema("date string")).select(F.expr("try_cast(date AS DATE)").alias("date"))
    observed = [partitioned(spark, at(name), schemas.PRICE) for name in PRICES]
    keep("trading-dates", etl.expanded_calendar(official.where("date IS NOT NULL"), *observed), schemas.CALENDAR)
    seen = single(spark, f"{root}/raw/discovered", schemas.DISCOVERED)
    keep("delisted-securities", etl.delisted_securities(seen, log, master), schemas.DELISTED)
    return written


def universe(master: DataFrame, delisted: DataFrame | None = None, *, with_indices: bool = True) -> DataFrame:
    """stock_id, is_delisted: the current master, and the recovered delisted if given."""
    now = master.where(F.lit(True) if with_indices else ~c("is_index")).select("stock_id").distinct().withColumn("is_delisted", F.lit(False))
    if delisted is None:
        return now
    return now.unionByName(delisted.select("stock_id").distinct().join(now, "stock_id", "left_anti").withColumn("is_delisted", F.lit(True)))


def run_stages(spark: SparkSession, log: str, job: str, stages: Iterable[tuple[str, Callable[[], object]]]) -> list[str]:
    """Run stages in order, stop at the first failure, and record the run. Returns the names of those that ended."""
    done: list[str] = []
    with RunRecord(spark, log, job) as run:
        for name, stage in stages:
            run.events.append({"stage": name})
            run.metrics[name] = stage()
            done.append(name)
    return done


def pending(wanted: DataFrame, held: DataFrame, state: set[str]) -> tuple[DataFrame, DataFrame]:
    """stock_id still to be fetched, and those that the checkpoint has as done but whose rows are lost. wanted and held have stock_id."""
    have = held.select("stock_id").distinct()
    lacking = wanted.select("stock_id").distinct().join(have, "stock_id", "left_anti")
    done = c("stock_id").isin(sorted(state)) if state else F.lit(False)
    return lacking.where(~done), lacking.where(done)


def save_checkpoint(spark: SparkSession, path: str, done: set[str]) -> None:
    """The ids done so far, replaced whole."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(json.dumps(sorted(done)).encode()))
    out.close()


def load_checkpoint(spark: SparkSession, path: str) -> set[str]:
    return set(json.loads("".join(r.value for r in spark.read.text(path, wholetext=True).collect()))) if exists(spark, path) else set()


def accept_template(rows: DataFrame) -> DataFrame:
    """source_file, accepted: a workbook made from a template holds exactly one security and at least one close."""
    return rows.groupBy("source_file").agg(F.countDistinct("stock_id").alias("ids"), F.count("close").alias("closes")).select("source_file", ((c("ids") == 1) & (c("closes") > 0)).alias("accepted"))


def longest_history(workbooks: DataFrame) -> DataFrame:
    """One row: the workbook that declares most rows, the template for new ones."""
    return workbooks.orderBy(F.desc_nulls_last("declared_rows"), "source_file").limit(1)
