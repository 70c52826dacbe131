"""Health checks: each measures one number and says between which bounds it passes.

All checks of a source make one DataFrame, a row a check; outside its bounds a check has its severity: FAIL, or WARN for what may be so.
Nothing is collected: the report is a query like any other. Checks that are aggregates over the same view share one scan of it.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewell.functions.exprs import KNOWN_MARKETS, c
from quotewell.operators.between import adj_daily_prices_between, daily_prices_between, prices_combined_between
from quotewell.operators.compare import KEY
from quotewell.operators.vendor_views import CONSTITUENT, VENDOR_BAR
from quotewell.plans.warehouse import Warehouse


@dataclass(frozen=True)
class Over:
    """An aggregate over a view."""

    view: str
    column: Callable[[], Column]


@dataclass(frozen=True)
class Check:
    name: str
    measure: Over | Callable[[Warehouse], DataFrame]  # the latter gives one row: value double
    least: float = -math.inf
    most: float = math.inf
    severity: str = "FAIL"


@dataclass(frozen=True)
class Expected:
    """What a warehouse should hold. The defaults are those of the full market; a trial warehouse brings its own."""

    feed_rows: int = 1_000_000
    null_snapshot_dates: int = 32
    index_tickers: int = 32
    calendar_days: int = 8_141
    derived_days: int = 1_204
    derived_before: str = "1999-01-01"
    market_sourced_days: int = 7
    golden: tuple[tuple[str, str, float, float], ...] = (("0050", "2003-07-01", 37.09, 4.427356),)  # id, day, open, adjusted open
    quarter: tuple[str, str] = ("2024-01-01", "2024-03-31")
    vendor_rows: int = 600_000
    vendor_securities: int = 100
    vendor_start: str = "2000-09-04"
    golden_vendor: tuple[str, str, float, int] = ("2330", "2000-09-04", 133.5, 3324)  # id, day, next reference price, transactions
    index_rows: int = 800_000
    index_starts: tuple[tuple[str, str], ...] = (("TWN50", "2003-06-30"), ("TM100", "2003-06-30"))
    index_bands: tuple[tuple[str, int, int], ...] = (("TWN50", 44, 53), ("TM100", 95, 104))
    weights_from: str = "2003-01-01"
    weight_band: tuple[float, float] = (99.5, 100.5)
    golden_weight: tuple[str, str, str, float] = ("TWN50", "2015-06-30", "2330", 23.8845)
    today: str = field(default_factory=lambda: dt.date.today().isoformat())


def value(rows: DataFrame, of: Column | None = None) -> DataFrame:
    return rows.agg((F.count("*") if of is None else of).cast("double").alias("value"))


def rows_of(view: str) -> Over:
    return Over(view, lambda: F.count("*"))


def rows_where(view: str, condition: Callable[[], Column]) -> Over:
    return Over(view, lambda: F.count(F.when(condition(), True)))


def repeated(rows: DataFrame, *keys: str) -> DataFrame:
    """How many keys come twice or more."""
    return value(rows.groupBy(*keys).count().where("count > 1"))


def surplus(rows: DataFrame, *keys: str) -> DataFrame:
    """How many rows there are beyond one a key."""
    return value(rows.groupBy(*keys).count(), F.coalesce(F.sum(c("count") - 1), F.lit(0)))


def on(text: str) -> Column:
    return F.lit(text).cast("date")


def days_until(column: str, text: str) -> Column:
    return F.datediff(F.min(column), on(text))


ZERO = {"least": 0, "most": 0}


def feed_checks(x: Expected) -> list[Check]:
    prices, adjusted = (lambda w: w.feed_v_daily_prices), (lambda w: w.feed_v_adj_daily_prices)
    raw, adj = "feed_v_daily_prices", "feed_v_adj_daily_prices"
    out = [
        Check("prices populated", rows_of(raw), least=x.feed_rows, severity="WARN"),
        Check("adjusted prices populated", rows_of(adj), least=x.feed_rows, severity="WARN"),
        Check("stock info without a snapshot date", rows_where("feed_v_stock_info_history", lambda: c("snapshot_date").isNull()), x.null_snapshot_dates, x.null_snapshot_dates),
        Check("index tickers", rows_of("feed_v_indices"), x.index_tickers, x.index_tickers),
        Check("calendar days", rows_of("feed_v_trading_calendar"), least=x.calendar_days),
        Check("derived early days", rows_where("feed_v_trading_calendar", lambda: (c("source") == "derived") & (c("date") < on(x.derived_before))), least=x.derived_days),
        Check("one bar a security and day", lambda w: surplus(prices(w), *KEY), **ZERO),
        Check("one adjusted bar a security and day", lambda w: surplus(adjusted(w), *KEY), **ZERO),
        Check("industry key is unique", lambda w: repeated(w.feed_v_industry, "stock_id", "industry", "sub_industry"), **ZERO),
        Check("stock info content is unique", lambda w: surplus(w.feed_v_stock_info_history, "stock_id", "stock_name", "industry_category", "industry_category_norm", "type", "is_index", "snapshot_date"), **ZERO),
        Check("adjusted days from the whole market", Over(adj, lambda: F.countDistinct(F.when(c("source") == "market", c("date")))), most=x.market_sourced_days, severity="WARN"),
        Check("every price date is in the calendar", lambda w: value(prices(w).select("date").distinct().join(w.feed_v_trading_calendar, "date", "left_anti")), **ZERO),
        Check("no price from the future", rows_where(raw, lambda: c("date") > on(x.today)), **ZERO),
        Check("no security outside the universe", lambda w: value(prices(w).select("stock_id").distinct().join(w.feed_v_securities_all, "stock_id", "left_anti")), **ZERO),
        Check("adjusted ids are unadjusted ids", lambda w: value(adjusted(w).select("stock_id").distinct().join(prices(w).select("stock_id").distinct(), "stock_id", "left_anti")), **ZERO),
        Check("delisted securities with prices", lambda w: value(w.feed_v_delisted_securities.join(prices(w).select("stock_id").distinct(), "stock_id", "left_semi")), severity="WARN"),
        Check("missing trading days", rows_of("feed_v_missing_trading_days"), most=0, severity="WARN"),
        Check("days known to be empty", rows_of("feed_v_known_empty_days"), severity="WARN"),
        Check("thin trading days", rows_of("feed_v_thin_trading_days"), most=0, severity="WARN"),
    ]
    for i, d, opened, adj_opened in x.golden:
        bar = lambda i=i, d=d: (c("stock_id") == i) & (c("date") == on(d))
        out += [
            Check(f"open of {i} on {d}", Over(raw, lambda bar=bar: F.round(F.max(F.when(bar(), c("open"))), 6)), opened, opened),
            Check(f"adjusted open of {i} on {d}", Over(adj, lambda bar=bar: F.round(F.max(F.when(bar(), c("open"))), 6)), adj_opened, adj_opened),
            Check(f"adjusted differs from unadjusted for {i} on {d}", lambda w, bar=bar: value(w.feed_v_prices_combined.where(bar() & (c("open") != c("adj_open")))), least=1),
        ]
    lo, hi = x.quarter
    for name, f in (("prices", daily_prices_between), ("adjusted prices", adj_daily_prices_between), ("combined prices", prices_combined_between)):
        out.append(Check(f"{name} between {lo} and {hi}", lambda w, f=f: value(f(w, lo, hi)), least=1))
    out.append(Check("failed runs", rows_where("feed_v_ingestion_runs", lambda: c("status") == "failed"), most=0, severity="WARN"))
    return out


def vendor_checks(x: Expected) -> list[Check]:
    bars, index = "vendor_v_adj_daily_prices", "vendor_v_index_constituents"
    none = lambda view, name: rows_where(view, lambda: c(name).isNull())
    wrong_partition = lambda: (F.year("date") != c("year")) | (F.month("date") != c("month"))
    i, d, ref, traded = x.golden_vendor
    golden = lambda: (c("stock_id") == i) & (c("date") == on(d))
    idx, idx_day, member, weight = x.golden_weight
    golden_member = lambda: (c("index_id") == idx) & (c("date") == on(idx_day)) & (c("stock_id") == member)
    off_band = lambda: reduce(lambda a, b: a | b, ((c("index_id") == k) & ~c("constituents").between(lo, hi) for k, lo, hi in x.index_bands))
    columns = lambda view: lambda w: value(w.spark.range(len(getattr(w, view).columns)))
    out = [
        Check("vendor rows", rows_of(bars), least=x.vendor_rows),
        Check("vendor securities", Over(bars, lambda: F.countDistinct("stock_id")), least=x.vendor_securities),
        Check("one vendor bar a security and day", lambda w: surplus(w.vendor_v_adj_daily_prices, *KEY), **ZERO),
        *(Check(f"vendor {name} is never null", none(bars, name), **ZERO) for name in ("stock_id", "date", "close")),
        Check("vendor history starts on its day", Over(bars, lambda: days_until("date", x.vendor_start)), **ZERO),
        Check("one security a workbook", lambda w: value(w.vendor_v_adj_daily_prices.groupBy("source_file").agg(F.countDistinct("stock_id").alias("n")).where("n > 1")), **ZERO),
        Check("workbooks are named after their security", rows_where(bars, lambda: c("source_file") != F.concat("stock_id", F.lit(".xlsx"))), **ZERO),
        Check("workbooks are on contract", rows_where("vendor_v_workbooks", lambda: ~c("query_matches_contract")), **ZERO),
        Check("workbooks have the rows they declare", rows_where("vendor_v_workbook_status", lambda: c("rows_delta") != 0), **ZERO),
        Check("market codes are known", rows_where(bars, lambda: ~c("market").isin(*KNOWN_MARKETS)), **ZERO),
        Check("golden reference price", Over(bars, lambda: F.round(F.max(F.when(golden(), c("next_ref_price"))), 6)), ref, ref),
        Check("golden transactions", Over(bars, lambda: F.max(F.when(golden(), c("transactions")))), traded, traded),
        Check("adjusted close below the reference price", rows_where(bars, lambda: golden() & (c("close") < c("next_ref_price"))), least=1),
        Check("vendor partitions agree with dates", rows_where(bars, wrong_partition), **ZERO),
        Check("vendor view has its columns", columns(bars), len(VENDOR_BAR), len(VENDOR_BAR)),
        Check("index rows", rows_of(index), least=x.index_rows),
        Check("indices", Over(index, lambda: F.countDistinct("index_id")), 2, 2),
        Check("one row an index, day and member", lambda w: surplus(w.vendor_v_index_constituents, "index_id", "date", "stock_id"), **ZERO),
        Check("index member is never null", none(index, "stock_id"), **ZERO),
        Check("index weight is never null", none(index, "prev_weight_pct"), **ZERO),
        *(Check(f"history of {k} starts on its day", Over(index, lambda k=k, s=s: F.datediff(F.min(F.when(c("index_id") == k, c("date"))), on(s))), **ZERO) for k, s in x.index_starts),
        Check("one workbook an index and day", lambda w: value(w.vendor_v_index_constituents.groupBy("index_id", "date").agg(F.countDistinct("source_file").alias("n")).where("n > 1")), **ZERO),
        Check("index workbooks are named after their year", rows_where(index, lambda: ~c("source_file").endswith(F.concat(F.lit("/"), c("year").cast("string"), F.lit(".xlsx")))), **ZERO),
        Check("index workbooks are on contract", rows_where("vendor_v_index_workbooks", lambda: ~c("query_matches_contract")), **ZERO),
        Check("index workbooks have the rows they declare", rows_where("vendor_v_index_workbook_status", lambda: c("rows_delta") != 0), **ZERO),
        Check("member counts are in their band", rows_where("vendor_v_index_daily_coverage", off_band), **ZERO),
        Check("weights sum to a hundred", rows_where("vendor_v_index_daily_coverage", lambda: (c("date") >= on(x.weights_from)) & ~c("total_weight_pct").between(*x.weight_band)), **ZERO),
        Check("golden weight", Over(index, lambda: F.round(F.max(F.when(golden_member(), c("prev_weight_pct"))), 4)), weight, weight),
        Check("index partitions agree with dates", rows_where(index, wrong_partition), **ZERO),
        Check("index view has its columns", columns(index), len(CONSTITUENT), len(CONSTITUENT)),
        Check("members are not behind prices", lambda w: w.vendor_v_last_trading_day.select(c("date").alias("p")).crossJoin(w.vendor_v_index_constituents.agg(F.max("date").alias("m"))).select(F.datediff("p", "m").cast("double").alias("value")), most=5),
        Check("every member has prices", rows_where("vendor_v_index_universe", lambda: ~c("has_price_history")), **ZERO),
    ]
    return out


def storage_checks(w: Warehouse, root: str, *, most_files: int = 100_000, most_mb: float = 1e6) -> DataFrame:
    """Files and megabytes below a folder, as Hadoop's file system counts them (any store that Spark reads)."""
    path = w.spark._jvm.org.apache.hadoop.fs.Path(root)
    told = path.getFileSystem(w.spark._jsc.hadoopConfiguration()).getContentSummary(path)
    rows = [("files", float(told.getFileCount()), 0.0, float(most_files)), ("megabytes", told.getLength() / 1e6, 0.0, most_mb)]
    frame = w.spark.createDataFrame(rows, "name string, value double, least double, most double")
    return frame.withColumn("status", F.when(c("value").between(c("least"), c("most")), "PASS").otherwise("WARN")).select("name", "value", "status")


def report(w: Warehouse, checks: list[Check]) -> DataFrame:
    """name, value, status of each check. A measure that is null (nothing to look at) does not pass."""
    told = lambda k, v: F.struct(F.lit(k.name).alias("name"), v.alias("value"), F.when(v.between(k.least, k.most), "PASS").otherwise(k.severity).alias("status"))
    shared: dict[str, list[Check]] = {}
    rows = []
    for k in checks:
        if isinstance(k.measure, Over):
            shared.setdefault(k.measure.view, []).append(k)
        else:
            rows.append(k.measure(w).select(told(k, c("value")).alias("row")))
    for name, own in shared.items():
        once = getattr(w, name).agg(*(k.measure.column().cast("double").alias(f"m{n}") for n, k in enumerate(own)))
        rows.append(once.select(F.explode(F.array(*(told(k, c(f"m{n}")) for n, k in enumerate(own)))).alias("row")))
    return reduce(DataFrame.unionByName, rows).select("row.*")


#: What the trial warehouse of sources/adapters.py is held against.
TRIAL = Expected(
    feed_rows=1_000, null_snapshot_dates=18, index_tickers=4, calendar_days=100, derived_days=10, market_sourced_days=7, golden=(("0012", "1996-07-16", 0.0, 0.0),), quarter=("1998-01-01", "1998-03-31"),
    vendor_rows=1_000, vendor_securities=10, vendor_start="1995-01-02", golden_vendor=("0012", "1996-07-16", 0.0, 1), index_rows=1_000, index_starts=(("TWN50", "1995-01-05"), ("TM100", "1995-01-05")),
    index_bands=(("TWN50", 5, 5), ("TM100", 8, 10)), weights_from="1996-01-01", golden_weight=("TWN50", "1996-07-17", "0012", 0.0), today="2024-01-01",
)

QUERIES = {"feed_health": lambda w: report(w, feed_checks(TRIAL)), "vendor_health": lambda w: report(w, vendor_checks(TRIAL))}
