"""The analyst's queries: look-ups, rankings, rollups, and the comparison of price levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewell.functions.exprs import by_security, c, number_of, share
from quotewell.operators.between import Day, between
from quotewell.operators.compare import BARS, KEY, apart, exploded
from quotewell.operators.vendor_views import newest_day
from quotewell.plans.warehouse import Warehouse

ADJUSTED, RAW = "adjusted", "raw"
LEVELS = ("open", "high", "low", "close")


def get_prices(w: Warehouse, ids: list[str], lo: Day, hi: Day, kind: str = ADJUSTED) -> DataFrame:
    """Bars of some securities over a range of dates."""
    rows = {ADJUSTED: w.feed_v_adj_daily_prices, RAW: w.feed_v_daily_prices}[kind]
    return between(rows, lo, hi).where(c("stock_id").isin(ids))


def search_securities(w: Warehouse, pattern: str) -> DataFrame:
    """Securities whose id or name is like the pattern, in any case."""
    return w.feed_v_securities_all.where(c("stock_id").ilike(pattern) | c("stock_name").ilike(pattern))


def latest_market(w: Warehouse) -> DataFrame:
    """Every bar of the newest day with its security."""
    return w.feed_v_daily_prices_enriched.crossJoin(newest_day(w, "feed_bars")).where("date = newest").drop("newest")


def most_active(w: Warehouse, k: int = 20) -> DataFrame:
    """The k bars of the newest day with the largest turnover."""
    return latest_market(w).orderBy(F.desc("turnover_value"), "stock_id").limit(k).select("stock_id", "stock_name", "industry", "close", "volume", "turnover_value")


def cross_section(w: Warehouse, on: Day) -> DataFrame:
    """All bars of one day, delisted securities included: no survivorship bias."""
    return between(w.feed_v_daily_prices_enriched, on, on)


def adjustment_history(w: Warehouse, stock_id: str) -> DataFrame:
    return w.feed_v_prices_combined.where(c("stock_id") == stock_id).select("date", "close", "adj_close", "adj_factor")


def month_end_close(w: Warehouse, ids: list[str]) -> DataFrame:
    """The last close of each month."""
    return w.feed_v_adj_daily_prices.where(c("stock_id").isin(ids)).groupBy("stock_id", F.trunc("date", "MM").alias("month")).agg(F.max("date").alias("date"), F.max_by("close", "date").alias("close"))


def daily_return(w: Warehouse, stock_id: str) -> DataFrame:
    rows = w.feed_v_adj_daily_prices.where(c("stock_id") == stock_id)
    return rows.select("date", "close", (F.try_divide(c("close"), F.lag("close").over(by_security())) - 1).alias("daily_return"))


def moving_average(w: Warehouse, stock_id: str, n: int = 20) -> DataFrame:
    """Mean of the last n closes, null until there are n."""
    last = by_security().rowsBetween(-(n - 1), 0)
    rows = w.vendor_v_adj_daily_prices.where(c("stock_id") == stock_id)
    return rows.select("date", "close", F.when(F.count("*").over(last) == n, F.round(F.avg("close").over(last), 6)).alias("average"))


def normalised(w: Warehouse, ids: list[str], lo: Day, hi: Day) -> DataFrame:
    """Closes in a column a security, on days that all have, as 100 at the first."""
    wide = between(w.vendor_v_adj_daily_prices, lo, hi).where(c("stock_id").isin(ids)).groupBy("date").pivot("stock_id", ids).agg(F.first("close"))
    whole = wide.dropna()
    start = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row a day
    return whole.select("date", *(F.round(F.lit(100) * c(f"`{i}`") / F.first(c(f"`{i}`")).over(start), 6).alias(f"s{i}") for i in ids))


def monthly_rollup(w: Warehouse, stock_id: str) -> DataFrame:
    rows = w.vendor_v_adj_daily_prices.where(c("stock_id") == stock_id)
    return rows.groupBy(F.trunc("date", "MM").alias("month")).agg(
        F.min_by("open", "date").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "date").alias("close"), F.round(F.sum("turnover_k"), 3).alias("turnover_k"), F.count("*").alias("days")
    )


def alive_at(w: Warehouse, on: Day) -> DataFrame:
    """Securities not yet delisted on a day."""
    return w.feed_v_securities_all.where(c("delisted_date").isNull() | (c("delisted_date") > F.lit(str(on)).cast("date"))).select("stock_id", "stock_name", "is_delisted", "delisted_date")


def survivors_and_all(w: Warehouse) -> DataFrame:
    """Securities with bars, by year: those alive now against all."""
    rows = w.feed_v_daily_prices_enriched
    each = rows.groupBy("year", "stock_id").agg(F.count(F.when(~c("is_delisted"), True)).alias("alive"))
    return each.groupBy("year").agg(F.count("stock_id").alias("all_securities"), F.count(F.when(c("stock_id").isNotNull() & (c("alive") > 0), True)).alias("survivors"))


def with_industries(w: Warehouse, on: Day) -> DataFrame:
    bars = between(w.feed_v_daily_prices, on, on).select("stock_id", "close")
    return bars.join(w.feed_v_industry_by_stock, "stock_id", "left").select("stock_id", "close", F.array_join("industries", "|").alias("industries"), F.array_join("sub_industries", "|").alias("sub_industries"))


def failed_runs(w: Warehouse) -> DataFrame:
    return w.feed_v_ingestion_runs.where(c("status") != "ok").groupBy("job", "status").agg(F.count("*").alias("runs"), F.max("started_at").alias("newest"))


# --- levels ---------------------------------------------------------------------------------------------------------


def overlap(w: Warehouse) -> DataFrame:
    """Bars that both sources have adjusted, with both sets of prices."""
    vendor = w.vendor_v_adj_daily_prices.select(*KEY, "stock_name", "market", *(c(x).alias(f"vendor_{x}") for x in LEVELS))
    feed = w.feed_v_adj_daily_prices.select(*KEY, *(c(x).alias(f"feed_{x}") for x in LEVELS))
    return vendor.join(feed, KEY)


def overlap_summary(w: Warehouse) -> DataFrame:
    """Common securities and days, and the rows that each side has of them."""
    ids = w.vendor_v_adj_daily_prices.select("stock_id").intersect(w.feed_v_adj_daily_prices.select("stock_id"))
    days = w.vendor_v_adj_daily_prices.select("date").intersect(w.feed_v_adj_daily_prices.select("date"))
    held = lambda rows, name: rows.join(ids, "stock_id", "left_semi").join(days, "date", "left_semi").agg(F.count("*").alias(name))
    parts = [ids.agg(F.count("*").alias("securities")), days.agg(F.count("*").alias("days")), held(w.vendor_v_adj_daily_prices, "vendor_rows"), held(w.feed_v_adj_daily_prices, "feed_rows")]
    return reduce(DataFrame.crossJoin, parts)


def ids_on_one_side(w: Warehouse) -> DataFrame:
    vendor, feed = (x.select("stock_id").distinct() for x in (w.vendor_v_adj_daily_prices, w.feed_v_adj_daily_prices))
    return vendor.join(feed, "stock_id", "left_anti").select(F.lit("vendor").alias("only_in"), "stock_id").unionByName(feed.join(vendor, "stock_id", "left_anti").select(F.lit("feed").alias("only_in"), "stock_id"))


def level_days(w: Warehouse) -> DataFrame:
    """A row a security and day that both sources have adjusted, with each side's prices as a list: v, f. An id that is shared has several bars a day, and overlap all their pairs."""
    sides = {name: BARS[name][:2] for name in "vf"}
    told = lambda of="": F.struct(*(F.expr(of + x).alias(x) for x in LEVELS))
    beside = getattr(w.tables, "beside", None)
    if beside is not None and not any(view in w.tables for view, _ in sides.values()):
        made = beside(*(table for _, table in sides.values()))
        rows = made.select(*KEY, *(F.when(c(f"has_{table}"), told(f"{table}.")).alias(name) for name, (_, table) in sides.items()))
        rows = rows.where("stock_id IS NOT NULL AND date IS NOT NULL AND (v IS NOT NULL OR f IS NOT NULL)").repartition("stock_id")
        return rows.groupBy(*KEY).agg(*(F.collect_list(x).alias(x) for x in sides)).where("size(v) > 0 AND size(f) > 0")
    gathered = [getattr(w, view).groupBy(*KEY).agg(F.collect_list(told()).alias(name)) for name, (view, _) in sides.items()]
    return gathered[0].join(gathered[1], KEY)


#: Shares of the pairs that are farther apart, about which p999 is looked for.
TAILS = (0.25, 0.064, 0.016, 0.008, 0.004, 0.0025, 0.0016, 0.00125, 0.001, 0.0008, 0.0005, 0.00025)


def level_metrics(w: Warehouse) -> DataFrame:
    """A row for each of open, high, low, close: how far the sources are apart.

    p999 is exact. A sketch of one pair a vendor bar only proposes cuts, between which all pairs are counted; then the distances of the one slice that holds the rank are sorted. No row is made of
    a pair but of those of this slice, so shuffles grow with the bars.
    """
    days = level_days(w)
    off = {x: F.abs(c("v")[x] - c("f")[x]) for x in LEVELS}
    some = days.select(F.posexplode_outer("v").alias("at", "v"), "f").select("v", F.get("f", F.pmod(c("at"), F.size("f"))).alias("f"))
    cuts = F.broadcast(some.agg(*(F.percentile_approx(off[x], [1 - t for t in TAILS], 100_000).alias(f"cuts_{x}") for x in LEVELS)))
    pairs = lambda about: days.crossJoin(about).withColumn("v", exploded("v")).withColumn("f", exploded("f"))

    def counts(x: str) -> list[Column]:
        same, near = c("v")[x] == c("f")[x], off[x] <= 0.01
        above = (number_of(off[x] > c(f"cuts_{x}")[k], f"above_{x}_{k}") for k in range(len(TAILS)))
        return [number_of(same, f"same_{x}"), number_of(near, f"near_{x}"), F.max(off[x]).alias(f"most_{x}"), F.count(off[x]).alias(f"known_{x}"), *above]

    def span(x: str) -> list[Column]:
        """The slice (low, high] of the values about the rank; null is no bound. `beyond` counts the values above low."""
        known, each = c(f"known_{x}"), [(c(f"cuts_{x}")[k], c(f"above_{x}_{k}")) for k in range(len(TAILS))]
        rank = F.lit(0.999) * (known - 1)
        under = lambda n: n >= known - F.floor(rank)
        low, beyond = F.greatest(*(F.when(under(n), cut) for cut, n in each)), F.least(*(F.when(under(n), n) for _, n in each))
        high = F.least(*(F.when(n < known - F.ceil(rank), cut) for cut, n in each))
        return [low.alias(f"low_{x}"), high.alias(f"high_{x}"), (known - F.coalesce(beyond, known)).alias(f"below_{x}"), rank.alias(f"rank_{x}")]

    counted = pairs(cuts).agg(F.count("*").alias("n"), *(y for x in LEVELS for y in counts(x)))
    spans = counted.crossJoin(cuts).select("*", *(y for x in LEVELS for y in span(x)))
    spans = spans.agg(F.any_value(F.struct("*")).alias("s")).select("s.*")  # one row as it was; the two readers would prune it to two plans, and count twice
    within = {x: (c(f"low_{x}").isNull() | (off[x] > c(f"low_{x}"))) & (c(f"high_{x}").isNull() | (off[x] <= c(f"high_{x}"))) for x in LEVELS}
    close = pairs(F.broadcast(spans.select(*(f"{end}_{x}" for x in LEVELS for end in ("low", "high"))))).where(reduce(lambda a, b: a | b, within.values()))
    values = close.select(F.explode(F.array(*(F.struct(F.lit(x).alias("price"), F.when(within[x], off[x]).alias("off")) for x in LEVELS))).alias("p")).select("p.*").where("off IS NOT NULL")
    told = ("same", "near", "most", "below", "rank")
    prices = spans.select("n", F.explode(F.array(*(F.struct(F.lit(x).alias("price"), *(c(f"{y}_{x}").alias(y) for y in told)) for x in LEVELS))).alias("p")).select("n", "p.*").where("n > 0")
    upto = F.sum("m").over(Window.partitionBy("price").orderBy("off").rowsBetween(Window.unboundedPreceding, 0))
    ranked = values.groupBy("price", "off").agg(F.count("*").alias("m")).withColumn("upto", upto).join(F.broadcast(prices.select("price", "below", "rank")), "price").withColumn("upto", c("upto") + c("below"))
    at = lambda place: F.max(F.when((c("upto") > place) & (c("upto") - c("m") <= place), c("off")))
    found = ranked.groupBy("price").agg(F.any_value("rank").alias("place"), at(F.floor("rank")).alias("lower"), at(F.ceil("rank")).alias("upper"))
    part = c("place") - F.floor("place")
    p999 = found.select("price", F.when(part == 0, c("lower")).otherwise(c("lower") * (1 - part) + c("upper") * part).alias("p999"))
    return prices.join(F.broadcast(p999), "price", "left").select(
        "price", "n", c("same").alias("exact_equal"), share(c("same"), c("n"), 4).alias("exact_pct"), share(c("near"), c("n"), 4).alias("within_1c_pct"), F.round("p999", 6).alias("p999_off"), F.round("most", 6).alias("largest_off")
    )


def rowwise_agreement(w: Warehouse) -> DataFrame:
    same = reduce(lambda a, b: a & b, (c(f"vendor_{x}") == c(f"feed_{x}") for x in LEVELS))
    near = reduce(lambda a, b: a & b, (apart(f"vendor_{x}", f"feed_{x}") <= 0.01 for x in LEVELS))
    return overlap(w).agg(F.count("*").alias("n"), number_of(same, "all_equal"), number_of(near, "all_within_1c"))


#: Edges of the histogram of relative differences of closes; a bin holds its upper edge.
EDGES = (0.0, 0.0001, 0.001, 0.01, 0.05, 0.1)


def difference_histogram(w: Warehouse) -> DataFrame:
    off = F.try_divide(apart("vendor_close", "feed_close"), F.abs("feed_close"))
    label = F.when(off <= EDGES[0], "= 0")
    for hi in EDGES[1:]:
        label = label.when(off <= hi, f"<= {hi:g}")
    return overlap(w).groupBy(F.when(off.isNull(), "none").otherwise(label.otherwise(f"> {EDGES[-1]:g}")).alias("bin")).agg(F.count("*").alias("n"))


def level_by_stock(w: Warehouse) -> DataFrame:
    off = apart("vendor_close", "feed_close")
    return overlap(w).groupBy("stock_id").agg(F.max_by("stock_name", "date").alias("stock_name"), F.count("*").alias("n"), F.round(F.avg(off), 6).alias("mean_off"), F.round(F.max(off), 6).alias("largest_off"))


def largest_differences(w: Warehouse, k: int = 20) -> DataFrame:
    rows = overlap(w).select(*KEY, "vendor_close", "feed_close", F.round(apart("vendor_close", "feed_close"), 6).alias("off"))
    return rows.orderBy(F.desc("off"), *KEY).limit(k)


def corporate_action_proxy(w: Warehouse) -> DataFrame:
    """Days on which the feed's adjustment factor moves by more than half a per cent, by year. Of an id's rows of one day the smaller factor comes first."""
    factor = F.try_divide(c("adj_close"), F.when(c("close") != 0, c("close")))
    rows = w.feed_v_prices_combined.select("stock_id", "date", "year", factor.alias("f"))
    moved = rows.withColumn("p", F.lag("f").over(Window.partitionBy("stock_id").orderBy("date", "f"))).where(F.abs(F.try_divide(c("f"), c("p")) - 1) > 0.005)
    return moved.groupBy("year").agg(F.count("*").alias("days"), F.countDistinct("stock_id").alias("securities"))


# --- members and their prices ----------------------------------------------------------------------------------------


def member_coverage(w: Warehouse) -> DataFrame:
    """Each stock that was ever a member: its span, its bars, and what is to be done about it."""
    members = w.vendor_v_index_constituents.groupBy("stock_id").agg(
        F.countDistinct("stock_name").alias("names"), F.countDistinct("index_id").alias("indices"), F.min("date").alias("first_member"), F.max("date").alias("last_member"), F.countDistinct("date").alias("member_days")
    )
    bars = w.vendor_v_adj_daily_prices.groupBy("stock_id").agg(F.min("date").alias("first_bar"), F.max("date").alias("last_bar"), F.count("close").alias("closes"), F.count("open").alias("opens"))
    action = F.when(c("first_bar").isNull(), "fetch").when(c("first_bar") > c("first_member"), "extend back").when(c("last_bar") < c("last_member"), "refresh").otherwise("none")
    return members.join(bars, "stock_id", "left").withColumn("action", action)


def coverage_by_index(w: Warehouse) -> DataFrame:
    """Member days of each index, and those with a bar. A day with several bars of an id counts once."""
    held = w.vendor_v_adj_daily_prices.select(*KEY).distinct().withColumn("has", F.lit(True))
    rows = w.vendor_v_index_constituents.join(held, KEY, "left")
    return rows.groupBy("index_id").agg(F.count("*").alias("member_days"), F.count("has").alias("with_bar"), F.countDistinct("stock_id").alias("members"))


QUERIES = {
    "get_prices": lambda w: get_prices(w, ["0001", "0012"], "1996-01-01", "1997-12-31").select("stock_id", "date", "close", "volume"),
    "search_securities": lambda w: search_securities(w, "%1%").select("stock_id", "stock_name", "is_delisted"),
    "latest_market": lambda w: latest_market(w).select("stock_id", "date", "close", "stock_name", "industry", "is_delisted"),
    "most_active": most_active,
    "cross_section": lambda w: cross_section(w, "1998-05-05").select("stock_id", "close", "type", "is_delisted"),
    "adjustment_history": lambda w: adjustment_history(w, "0012"),
    "month_end_close": lambda w: month_end_close(w, ["0012", "0013"]),
    "daily_return": lambda w: daily_return(w, "0012"),
    "moving_average": lambda w: moving_average(w, "0012"),
    "normalised": lambda w: normalised(w, ["0012", "0013"], "1996-01-01", "1999-12-31"),
    "monthly_rollup": lambda w: monthly_rollup(w, "0012"),
    "alive_at": lambda w: alive_at(w, "1996-06-30"),
    "survivors_and_all": survivors_and_all,
    "with_industries": lambda w: with_industries(w, "1998-05-05"),
    "failed_runs": failed_runs,
    "overlap_summary": overlap_summary,
    "ids_on_one_side": ids_on_one_side,
    "level_metrics": level_metrics,
    "rowwise_agreement": rowwise_agreement,
    "difference_histogram": difference_histogram,
    "level_by_stock": level_by_stock,
    "largest_differences": largest_differences,
    "corporate_action_proxy": corporate_action_proxy,
    "member_coverage": member_coverage,
    "coverage_by_index": coverage_by_index,
}
