"""All queries of the warehouse by name: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.operators import between, checks, compare, explore, feed_views, snapshot, upkeep, vendor_views  # noqa: F401  registers the views
from quotewell.plans.warehouse import VIEWS, Warehouse
from quotewell.sources.adapters import warehouse

RANGE = ("1997-11-15", "1998-02-14")

RANGES: dict[str, Callable[[Warehouse], DataFrame]] = {
    f.__name__: lambda w, f=f: f(w, *RANGE)
    for f in (between.daily_prices_between, between.adj_daily_prices_between, between.prices_combined_between, between.vendor_prices_between, between.index_constituents_between)
} | {"index_members_on": lambda w: between.index_members_on(w, "TM100", "1998-01-05")}


def trial(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The trial warehouse as of a fixed day."""
    w = warehouse(spark, sf_dir)
    w.as_of = dt.date(2001, 6, 30)
    return w


def flat(df: DataFrame) -> DataFrame:
    """Lists as text, so that results compare by plain values; the views themselves keep their lists."""
    return df.select(*(F.array_join(f.name, "|").alias(f.name) if isinstance(f.dataType, T.ArrayType) else f.name for f in df.schema))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    views = {name: lambda w, name=name: getattr(w, name) for name in VIEWS}
    own = views | compare.QUERIES | snapshot.QUERIES | explore.QUERIES | RANGES | upkeep.QUERIES | checks.QUERIES
    return {name: lambda spark, sf_dir, f=f: flat(f(trial(spark, sf_dir))) for name, f in own.items()}
