"""Comparison of the two sources, on daily returns.

Levels of back-adjusted series differ by a constant a security whenever they were refreshed on different days; returns do not. Aligned rows, returns
and disagreements are views that others share: persist them once for a session of many queries (see cached()).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewell.functions.exprs import KNOWN_MARKETS, LISTED, by_security, c, gap_days, number_of, share
from quotewell.operators.quantiles import with_weighted_quantiles
from quotewell.operators.vendor_views import newest_day
from quotewell.plans.warehouse import VIEWS, Warehouse, view

#: Rounding noise in a return; a real disagreement; days a return may span; rows a new security may move freely.
AGREE, MATERIAL, MAX_GAP, FREE_ROWS = 0.001, 0.01, 7, 6
#: The daily price limit, with half a per cent of slack, and the day from which the wider one holds.
NARROW, WIDE, WIDE_FROM = 0.075, 0.105, "2015-06-01"
KEY = ["stock_id", "date"]

QUERIES: dict[str, object] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def listed(column: str = "market") -> Column:
    return c(column).isin(*LISTED)


def pct(column: str | Column, digits: int = 2) -> Column:
    return F.round((c(column) if isinstance(column, str) else column) * F.lit(100), digits)


def raw_closes(table: DataFrame) -> DataFrame:
    """Raw snapshots are text as it came; a date that is none becomes null."""
    return table.select(F.expr("try_cast(date AS DATE)").alias("date"), "stock_id", c("close").cast("double").alias("close"))


@view
def upstream_adjusted(w: Warehouse) -> DataFrame:
    """Adjusted closes as the feed serves them a ticker at a time, filled up from its days of the whole market. A key that comes several times on both sides comes once for each pair."""
    ticker, market = raw_closes(w.feed_raw_ticker).withColumnRenamed("close", "t"), raw_closes(w.feed_raw_market).withColumnRenamed("close", "m")
    return ticker.join(market, KEY, "full").select(*KEY, F.coalesce("t", "m").alias("close"))


@view
def aligned(w: Warehouse) -> DataFrame:
    """A row for each bar that both sources have adjusted; vendor thousands become units. Rows are made from a day's lists: one pass over the bars and no join."""
    up = F.flatten(F.transform("u", lambda x: F.array_repeat(x["feed_up"], x["times"].cast("int"))))
    upward = F.flatten(F.transform(up, lambda u: F.transform("r", lambda r: F.struct(u.alias("feed_up"), *(r[x].alias(x) for x in RAW_SIDE)))))
    pairs = days(w, *VENDOR_SIDE, *FEED_SIDE, *RAW_SIDE).select(*KEY, "v", "f", upward.alias("upward"))
    for side in "vf":
        pairs = pairs.withColumn(side, exploded(side))
    told = pairs.select(*KEY, "v.*", "f.*", one_by_one("upward"))
    return told.select(*(x for x in told.columns if x != "upward"), F.inline_outer("upward"))


#: What the sides of a day hold, by the names of `aligned`; a side's rows of one day are sorted by their columns in this order.
VENDOR_SIDE = {
    "stock_name": "stock_name", "market": "market", "vendor": "close", "bid": "bid", "offer": "offer", "vendor_return_pct": "return_pct", "vendor_vol": "volume_k_shares * 1000", "vendor_amt": "turnover_k * 1000", "vendor_tx": "transactions",
}
FEED_SIDE = {"feed": "close", "feed_source": "source"}
RAW_SIDE = {"raw": "close", "feed_vol": "volume", "feed_amt": "turnover_value", "feed_tx": "transactions"}


#: The views of the sides, and the base tables that they select from.
BARS = {"v": ("vendor_v_adj_daily_prices", "vendor_bars", VENDOR_SIDE), "f": ("feed_v_adj_daily_prices", "feed_adj_bars", FEED_SIDE), "r": ("feed_v_daily_prices", "feed_bars", RAW_SIDE)}
SNAPSHOTS = {"t": "feed_raw_ticker", "m": "feed_raw_market"}


def _told(columns: dict[str, str], wanted: tuple[str, ...], of: str = "") -> Column:
    return F.struct(*(F.expr(of + columns[x]).alias(x) for x in columns if x in wanted))


def _paired(t: Column, m: Column) -> Column:
    """t and m, lists of the raw snapshots' closes, as u: the closes of upstream_adjusted with the times they come. A day's pairs are never expanded."""
    times = lambda rows, n: F.transform(rows, lambda x: F.struct(x["close"].alias("feed_up"), n.cast("long").alias("times")))
    known, unknown = F.filter(t, lambda x: x["close"].isNotNull()), F.size(F.filter(t, lambda x: x["close"].isNull()))
    paired = F.concat(times(known, F.size(m)), F.when(unknown > 0, times(m, unknown)).otherwise(F.array().cast("array<struct<feed_up:double,times:bigint>>")))
    return F.sort_array(F.when(F.size(m) == 0, times(t, F.lit(1))).when(F.size(t) == 0, times(m, F.lit(1))).otherwise(paired))


def _stored_sides(w: Warehouse, wanted: tuple[str, ...]) -> DataFrame:
    """Joined side by side, as stored tables of a comparison are bucketed by security: nothing moves."""

    def side(name: str, *more: Column) -> DataFrame:
        view_, _, columns = BARS[name]
        return getattr(w, view_).groupBy(*KEY).agg(F.sort_array(F.collect_list(_told(columns, wanted))).alias(name), F.count("*").alias(f"n_{name}"), *more)

    each = w.upstream_adjusted.groupBy(*KEY, c("close").alias("feed_up")).agg(F.count("*").alias("times"))
    moves = c("feed_up") != 0
    up = each.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("feed_up", "times"))).alias("u"), F.sum("times").alias("n_u"), F.sum(F.when(moves, c("times"))).alias("u_moving"), F.count_if(moves).alias("u_values"))
    return side("v").join(side("f", F.count_if(c("close") > 0).alias("f_positive")), KEY).join(up, KEY, "left").join(side("r"), KEY, "left")


def _sides(w: Warehouse, wanted: tuple[str, ...]) -> DataFrame:
    """Bars of all tables go to their security in one shuffle, and are gathered there by day."""
    beside = getattr(w.tables, "beside", None)
    if beside is not None and not any(view_ in w.tables for view_, _, _ in BARS.values()):
        made = beside(*(table for _, table, _ in BARS.values()), *SNAPSHOTS.values())
        bars = {name: F.when(c(f"has_{table}"), _told(columns, wanted, f"{table}.")) for name, (_, table, columns) in BARS.items()}
        same_day = lambda table: c(f"has_{table}") & (F.expr(f"try_cast({table}.date AS DATE)") == c("date"))
        snapshots = {name: F.when(same_day(table), F.struct(F.expr(f"CAST({table}.close AS DOUBLE)").alias("close"))) for name, table in SNAPSHOTS.items()}
        rows = made.select(*KEY, *(x.alias(name) for name, x in (bars | snapshots).items()))
    else:
        each = [getattr(w, view_).select(*KEY, _told(columns, wanted).alias(name)) for name, (view_, _, columns) in BARS.items()]
        each += [raw_closes(getattr(w, table)).select(*KEY, F.struct("close").alias(name)) for name, table in SNAPSHOTS.items()]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each)
    near = rows.where("stock_id IS NOT NULL AND date IS NOT NULL").repartition("stock_id")
    n = {x: F.count(x) for x in "vfrtm"}
    moving = {x: F.count_if(c(f"{x}.close") != 0) for x in "tm"}
    unknown = F.count_if(c("t").isNotNull() & c("t.close").isNull())
    up = lambda t, m, both: F.when(n["m"] == 0, t).when(n["t"] == 0, m).otherwise(both)
    return near.groupBy(*KEY).agg(
        *(F.sort_array(F.collect_list(x)).alias(x) for x in "vfr"), _paired(F.collect_list("t"), F.collect_list("m")).alias("u"), *(n[x].alias(f"n_{x}") for x in "vfr"),
        F.count_if(c("f.feed") > 0).alias("f_positive"), up(n["t"], n["m"], n["t"] * n["m"]).alias("n_u"), up(moving["t"], moving["m"], moving["t"] * n["m"] + unknown * moving["m"]).alias("u_moving"),
        up(moving["t"], moving["m"], moving["t"] + F.when(unknown > 0, moving["m"]).otherwise(0)).alias("u_values"),
    ).where("n_v > 0 AND n_f > 0")


def days(w: Warehouse, *more: str) -> DataFrame:
    """`aligned` before it is multiplied out: a row a security and day, with the rows of each side as lists v, f, u, r. An absent u or r is one row of nulls.

    Ids may be shared, so that a day has several bars on each side; aligned has all their combinations, the product of four numbers, and this their sum. n_ counts a side's rows, f_positive those
    with a price above 0, u_moving those with a known one other than 0, and u_values the elements of u that hold these.
    """
    wanted = ("stock_name", "market", "vendor", "feed", "feed_source", "raw", *more)
    both = (_stored_sides if "upstream_adjusted" in w.tables else _sides)(w, wanted)
    none = F.array(F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in both.schema["r"].dataType.elementType)))
    absent = F.array(F.struct(F.lit(None).cast("double").alias("feed_up"), F.lit(1).cast("long").alias("times")))
    held = lambda x, other: F.when(F.coalesce(F.size(x), F.lit(0)) > 0, c(x)).otherwise(other).alias(x)
    count = lambda x, least: F.greatest(F.coalesce(x, F.lit(0)), F.lit(least)).cast("long").alias(x)
    return both.select(*KEY, "v", "f", held("u", absent), held("r", none), *(count(f"n_{x}", 1) for x in "vfur"), *(count(x, 0) for x in ("f_positive", "u_moving", "u_values")))


def exploded(values: str | Column) -> Column:
    """A row for each element; none for an empty list if nulls are left out afterwards.

    A plain explode makes the optimizer test the list's size further down, where the whole expression of the list is copied into the lambdas that read it: a day's lists are then sorted once an element.
    """
    return F.explode_outer(values)


def one_by_one(values: str) -> Column:
    """The same list, read through a lambda.

    Steps that are compiled together hold all rows that come of one row, for a day the product of its lists. A lambda is not compiled with others, so what follows gets one pair of vendor and
    adjusted bars at a time, and memory holds the rows of a pair.
    """
    return F.get(F.transform(F.array(values), lambda x: x), F.lit(0)).alias(values)


def activity(w: Warehouse, *more: str) -> DataFrame:
    """Vendor rows by unadjusted rows, with the times that aligned has each pair."""
    rows = days(w, *more).select(*KEY, exploded("v").alias("v"), "r", (c("n_f") * c("n_u")).alias("times"))
    return rows.select(*KEY, "v", exploded("r").alias("r"), "times").select(*KEY, "v.*", "r.*", "times")


def levels(w: Warehouse) -> DataFrame:
    """Vendor rows by adjusted rows, with the times that aligned has each pair."""
    rows = days(w).select(*KEY, exploded("v").alias("v"), "f", (c("n_u") * c("n_r")).alias("times"))
    return rows.select(*KEY, "v", exploded("f").alias("f"), "times").select(*KEY, "v.*", "f.*", "times")


def times_of(condition: Column | None, name: str) -> Column:
    """number_of for rows that stand for several."""
    return F.coalesce(F.sum("times" if condition is None else F.when(condition, c("times"))), F.lit(0)).alias(name)


def times_share(condition: Column, digits: int, name: str) -> Column:
    return share(times_of(condition, "x"), F.sum("times"), digits).alias(name)


#: The values that rows follow, and their sides.
ENDS = {"vendor": "v", "feed": "f", "feed_up": "u", "raw": "r"}


def _ends(d: DataFrame) -> DataFrame:
    """Days with what their rows follow. A day's rows come in the order of (v, f, u, r), r fastest; the first follows the last row of the security's day before.

    l_ is a list's last value, b_ that of the day before; so_far counts the security's rows before the day.
    """
    last = d.withColumns({f"l_{x}": F.element_at(side, -1)[x] for x, side in ENDS.items()})
    rows_before = F.sum(c("n_v") * c("n_f") * c("n_u") * c("n_r")).over(by_security().rowsBetween(Window.unboundedPreceding, -1))
    return last.withColumns({f"b_{x}": F.lag(f"l_{x}").over(by_security()) for x in ENDS} | {"day_gap": gap_days(), "so_far": F.coalesce(rows_before, F.lit(0))})


def _linked(d: DataFrame) -> DataFrame:
    """_ends, where each element of a list also tells its place, and the value of the one before it."""

    def told(x: str, side: str) -> Column:
        return F.transform(side, lambda e, i: F.struct(e.alias("is"), i.cast("long").alias("at"), F.get(c(side), i - 1)[x].alias("was")))

    return _ends(d).withColumns({side: told(x, side) for x, side in ENDS.items()})


def _copied(linked: DataFrame, most: int | None = None) -> DataFrame:
    """Linked days whose u has an element for each copy of a value (or for `most` of them, which is enough for as many rows)."""
    times = lambda x: x["is"]["times"] if most is None else F.least(x["is"]["times"], F.lit(most))
    copies = lambda x: F.transform(F.sequence(F.lit(1).cast("long"), times(x)), lambda n: F.struct(x["is"].alias("is"), F.when(n == 1, x["was"]).otherwise(x["is"]["feed_up"]).alias("was")))
    return linked.withColumn("u", F.transform(F.flatten(F.transform("u", copies)), lambda x, i: F.struct(x["is"].alias("is"), i.cast("long").alias("at"), x["was"].alias("was"))))


def _combined(linked: DataFrame, *sides: str) -> DataFrame:
    """Rows of aligned with the values of the row before. Sides that are not named stay at their first element. `tail`: the vendor's row is the one before."""
    rows = linked
    for side in "vf":
        rows = rows.withColumn(side, exploded(side) if side in sides else F.get(side, F.lit(0)))
    own, was, new = (lambda side, x: c(side)["is"][x]), (lambda side: c(side)["was"]), (lambda side: c(side)["at"] > 0)
    new_v, new_f = new("v"), new("f")
    pairs = rows.select(  # a pair's first row; of the others, the row before is of the same pair
        *KEY, "v.is.*", "f.is.*", F.when(new_f, own("v", "vendor")).when(new_v, was("v")).otherwise(c("b_vendor")).alias("_vendor"),
        F.when(new_f, was("f")).when(new_v, c("l_feed")).otherwise(c("b_feed")).alias("_feed"), *(F.when(new_f | new_v, c(f"l_{x}")).otherwise(c(f"b_{x}")).alias(f"_{x}") for x in ("feed_up", "raw")), "l_raw",
        F.when(new_v | new_f, 0).otherwise(c("day_gap")).alias("_gap"), (c("so_far") + (c("v")["at"] * c("n_f") + c("f")["at"]) * c("n_u") * c("n_r") + 1).alias("_seq"), new_f.alias("_tail"),
        "n_r", one_by_one("u") if "u" in sides else "u", "r",
    )
    for side in "ur":
        pairs = pairs.withColumn(side, exploded(side) if side in sides else F.get(side, F.lit(0)))
    new_u, new_r = new("u"), new("r")
    same = lambda x: F.when(new_u | new_r, c(x)).otherwise(c(f"_{x}")).alias(f"p_{x}")
    bars = [x for side in "vf" for x in linked.schema[side].dataType.elementType["is"].dataType.names]
    return pairs.select(
        *KEY, *bars, own("u", "feed_up").alias("feed_up"), "r.is.*", same("vendor"), same("feed"),
        F.when(new_r, own("u", "feed_up")).when(new_u, was("u")).otherwise(c("_feed_up")).alias("p_feed_up"), F.when(new_r, was("r")).when(new_u, c("l_raw")).otherwise(c("_raw")).alias("p_raw"),
        F.when(new_u | new_r, 0).otherwise(c("_gap")).alias("gap"), (c("_seq") + c("u")["at"] * c("n_r") + c("r")["at"]).alias("seq"), (c("_tail") | new_u | new_r).alias("tail"),
    )


def _moves(ended: DataFrame) -> DataFrame:
    """The rows of aligned at which the vendor's row is another than before, one for each vendor row: the other sides stand at their first."""
    first = {"f": F.get("f", F.lit(0)), "u": F.get("u", F.lit(0)), "r": F.get("r", F.lit(0))}
    placed = F.transform("v", lambda e, i: F.struct(e.alias("is"), i.cast("long").alias("at"), F.get(c("v"), i - 1)["vendor"].alias("was")))
    rows = ended.withColumns({"v": placed, "u": first["u"]["feed_up"], "f": first["f"], "r": first["r"]}).withColumn("v", exploded("v"))
    new = c("v")["at"] > 0
    before = {"p_vendor": F.when(new, c("v")["was"]).otherwise(c("b_vendor"))} | {f"p_{x}": F.when(new, c(f"l_{x}")).otherwise(c(f"b_{x}")) for x in ("feed", "feed_up", "raw")}
    seq = c("so_far") + c("v")["at"] * c("n_f") * c("n_u") * c("n_r") + 1
    return rows.select(*KEY, "v.is.*", "f.*", c("u").alias("feed_up"), "r.*", *(x.alias(name) for name, x in before.items()), F.when(new, 0).otherwise(c("day_gap")).alias("gap"), seq.alias("seq"))


def _firsts(ended: DataFrame) -> DataFrame:
    """The first row of each security and day."""
    return _moves(ended.withColumn("v", F.slice("v", 1, 1)))


STEP = ("feed", "p_feed", "feed_up", "p_feed_up", "raw", "p_raw")


def _tails(ended: DataFrame, kinds: dict[str | None, tuple[str, ...] | None], sides: str) -> DataFrame:
    """All other rows: the vendor's price stands, so its rows tell only markets apart, and a day's rows are the steps of f, u and r, with the times they come.

    Vendor rows of the markets that a kind names (None: of all that no kind names) come together under the kind's name, with the greatest stock_name among them. Prices of 0 and less are left out:
    a return from them is unknown. A day has as many rows as its lists are long, not as their product.
    """
    one, none = F.lit(1.0), F.lit(None).cast("double")
    kind = f"array<struct<feed_source:string,{','.join(f'{x}:double' for x in STEP)},times:bigint>>"  # one type, whether or not a part may hold nulls

    def step(times: Column, source: Column | None = None, **values: Column) -> Column:
        still = {"feed": one, "p_feed": one, "feed_up": F.get("u", F.lit(0))["feed_up"], "p_feed_up": c("l_feed_up"), "raw": F.get("r", F.lit(0))["raw"], "p_raw": c("l_raw")} | values
        return F.struct((F.lit(None).cast("string") if source is None else source).alias("feed_source"), *(still[x].alias(x) for x in STEP), times.cast("long").alias("times"))

    after = lambda side, f: F.transform(F.slice(side, 2, F.greatest(F.size(side) - 1, F.lit(0))), lambda x, i: f(x, F.get(c(side), i)))  # noqa: E731  all but the first, with the one before
    positive, moving, distinct = c("f_positive"), c("u_moving"), c("u_values")  # the return of an upstream price is 0 while it stands; of 0 or none, unknown
    stands = lambda x: {"feed_up": x, "p_feed_up": x}
    r_steps = lambda up, times: after("r", lambda x, was: step(times * positive, raw=x["raw"], p_raw=was["raw"], **stands(up)))
    parts = {
        "f": [after("f", lambda x, was: step(F.lit(1), x["feed_source"], feed=x["feed"], p_feed=was["feed"]))],
        "u": [
            after("u", lambda x, was: step(positive, feed_up=x["feed_up"], p_feed_up=was["feed_up"])),
            F.array(step((moving - distinct) * positive, **stands(one)), step((c("n_u") - moving - F.size("u") + distinct) * positive, **stands(none))),
        ],
        "r": [r_steps(one, moving), r_steps(none, c("n_u") - moving)],
    }
    steps = F.filter(F.concat(*(x.cast(kind) for side in sides for x in parts[side])), lambda x: x["times"] > 0)
    named = [x for markets in kinds.values() for x in markets or ()]
    within = lambda x, markets: ~F.coalesce(x["market"].isin(*named), F.lit(False)) if markets is None else x["market"].isin(*markets)
    of = lambda markets: F.filter("v", lambda x: (x["vendor"] > 0) & within(x, markets))
    own = {code: of(markets) for code, markets in kinds.items()}
    groups = F.array(*(F.struct(F.lit(code).cast("string").alias("market"), F.size(x).cast("long").alias("n"), F.try_element_at(x, F.lit(-1))["stock_name"].alias("stock_name")) for code, x in own.items()))
    several = reduce(lambda a, b: a | b, (c(f"n_{side}") > 1 for side in sides))
    rows = ended.where(several).select(*KEY, exploded(F.filter(groups, lambda x: x["n"] > 0)).alias("g"), steps.alias("steps")).where("g IS NOT NULL")
    rows = rows.select(*KEY, "g", exploded("steps").alias("s")).where("s IS NOT NULL").select(*KEY, "g.*", "s.*")
    return rows.withColumns({"times": c("times") * c("n"), "vendor": one, "p_vendor": one, "gap": F.lit(0), "seq": F.lit(None).cast("long")}).drop("n")


def change(now: str, before: str) -> Column:
    return F.try_divide(now, before) - 1


def _as_returns(rows: DataFrame, *more: str) -> DataFrame:
    near = rows.where((c("gap") <= MAX_GAP) & (c("p_vendor") > 0) & (c("p_feed") > 0))
    return near.select(
        "stock_id", "stock_name", "date", "market", "feed_source", "seq", "vendor", "feed", "feed_up", "raw", "p_raw",
        change("vendor", "p_vendor").alias("r_vendor"), change("feed", "p_feed").alias("r_feed"), change("feed_up", "p_feed_up").alias("r_up"), change("raw", "p_raw").alias("r_raw"),
        ((c("raw") > 0) & (c("p_raw") > 0)).alias("clean"), F.when(c("date") >= F.lit(WIDE_FROM).cast("date"), WIDE).otherwise(NARROW).alias("lim"), *more,
    )


@view
def returns(w: Warehouse) -> DataFrame:
    """Four returns over at most MAX_GAP days; `clean` if the feed saw a trade on both days (unknown stays unknown).

    An id that is shared has several rows a day, whose order the date leaves open: it is that of _linked. Rows are made from a day's lists, so none is sorted or shuffled.
    """
    return _as_returns(_combined(_copied(_linked(days(w))), *"vfur"))


def heads(w: Warehouse) -> DataFrame:
    """The rows of returns at which the vendor or the feed may move; at all others both returns are 0."""
    return _as_returns(_combined(_linked(days(w)), *"vf"))


#: Kinds of markets that queries tell apart, by the market that their rows show: all, listed or not, listed alone.
BY_MARKET: dict[str | None, tuple[str, ...] | None] = {x: (x,) for x in KNOWN_MARKETS} | {None: None}
BY_SEGMENT: dict[str | None, tuple[str, ...] | None] = {LISTED[0]: LISTED, None: None}
LISTED_ALONE: dict[str | None, tuple[str, ...] | None] = {LISTED[0]: LISTED}


def weighted(w: Warehouse, free_rows: int = 0, kinds: dict[str | None, tuple[str, ...] | None] = BY_MARKET, sides: str = "fur") -> DataFrame:
    """Returns beyond a security's first rows, as fewer rows with the times they come: _moves, and the others by steps. A day has a few rows for each bar of it.

    sides: those whose steps are wanted; steps of u and r alone change neither the vendor's nor the feed's return from 0. Rows of markets that no kind names may be left out.
    """
    ended = _ends(days(w))
    parts = [_moves(ended).where(c("seq") > free_rows).withColumn("times", F.lit(1).cast("long")), _tails(ended, kinds, sides)]
    if free_rows:  # the first rows of a security are taken off again, one by one
        several = (c("n_f") > 1) | (c("n_u") > 1) | (c("n_r") > 1)
        lists = {side: F.slice(side, 1, free_rows) for side in "vfr"}
        first = _copied(_linked(days(w)).where((c("so_far") < free_rows) & several), free_rows).withColumns(lists | {"u": F.slice("u", 1, free_rows)})
        parts.append(_combined(first, *"vfur").where(c("tail") & (c("seq") <= free_rows)).withColumn("times", F.lit(-1).cast("long")))
    return reduce(DataFrame.unionByName, (_as_returns(x, "times") for x in parts))


def apart(a: str, b: str) -> Column:
    return F.abs(c(a) - c(b))


def beyond(name: str) -> Column:
    return F.abs(name) > c("lim")


#: Causes in the order in which they are tried.
CAUSES = {
    "A": "A no trade that day (unadjusted close is 0)",
    "B": "B own pipeline: adjustment bases mixed",
    "C": "C feed left a corporate action unadjusted",
    "D": "D feed adjusted without an event in the unadjusted price",
    "E": "E both adjusted, by different amounts",
}


def cause() -> Column:
    """The first cause that explains a disagreement. A comparison with an unknown return explains nothing."""
    follows_raw = lambda x: apart(x, "r_raw") <= AGREE
    leaves_raw = lambda x: apart(x, "r_raw") > AGREE
    return (
        F.when(~c("clean"), CAUSES["A"])
        .when((apart("r_vendor", "r_up") <= AGREE) | (c("feed_source") == "market"), CAUSES["B"])
        .when(follows_raw("r_feed") & leaves_raw("r_vendor"), CAUSES["C"])
        .when(follows_raw("r_vendor") & leaves_raw("r_feed"), CAUSES["D"])
        .otherwise(CAUSES["E"])
    )


@view
def disagreements(w: Warehouse) -> DataFrame:
    return heads(w).where(listed() & (apart("r_vendor", "r_feed") > MATERIAL)).withColumn("cause", cause())


def weighted_disagreements(w: Warehouse, kinds: dict[str | None, tuple[str, ...] | None] = LISTED_ALONE) -> DataFrame:
    """disagreements as fewer rows with the times they come; by default the listed markets may show as one."""
    return weighted(w, kinds=kinds, sides="f").where(listed() & (apart("r_vendor", "r_feed") > MATERIAL)).withColumn("cause", cause())


def cached(w: Warehouse) -> Warehouse:
    """Persist what the comparisons share, to memory and, beyond it, disk. The caller unpersists with w.spark.catalog.clearCache()."""
    for name in ("aligned", "returns", "disagreements"):
        getattr(w, name).persist()
    return w


def letter() -> Column:
    return F.left(c("cause"), F.lit(1))


def settled(w: Warehouse) -> DataFrame:
    """With the times each row comes."""
    return weighted(w, FREE_ROWS, LISTED_ALONE).where(listed() & c("clean"))


def settled_moves(w: Warehouse) -> DataFrame:
    """The rows among the settled at which the vendor may move."""
    return _as_returns(_moves(_ends(days(w)))).where(listed() & c("clean") & (c("seq") > FREE_ROWS))


@query
def cmp_universe_overlap(w: Warehouse) -> DataFrame:
    ids = w.vendor_v_securities.select("stock_id", "is_current")
    adjusted, unadjusted = (x.select("stock_id").distinct() for x in (w.feed_v_adj_daily_prices, w.feed_v_daily_prices))
    marked = ids.join(unadjusted.withColumn("in_raw", F.lit(True)), "stock_id", "left").join(adjusted.withColumn("in_adj", F.lit(True)), "stock_id", "left")
    stopped = ~c("is_current")
    ours = marked.agg(
        F.count("*").alias("vendor_securities"), F.count("in_raw").alias("also_in_feed_unadjusted"), F.count("in_adj").alias("also_in_feed_adjusted"), number_of(stopped, "vendor_stopped_trading"),
        number_of(stopped & c("in_raw"), "stopped_in_feed_unadjusted"), number_of(stopped & c("in_adj"), "stopped_in_feed_adjusted"),
    )
    missing = lambda x, name: x.join(ids, "stock_id", "left_anti").agg(F.count("*").alias(name))
    return ours.crossJoin(missing(adjusted, "feed_adjusted_not_in_vendor")).crossJoin(missing(unadjusted, "feed_unadjusted_not_in_vendor"))


@query
def cmp_coverage_by_year(w: Warehouse) -> DataFrame:
    unadjusted = w.feed_v_daily_prices.select(*KEY, c("stock_id").alias("raw_id"))
    adjusted = w.feed_v_adj_daily_prices.select(*KEY, c("stock_id").alias("adj_id"))
    newest = newest_day(w, "feed_bars")
    rows = w.vendor_v_adj_daily_prices.where(listed()).select(*KEY).crossJoin(newest).where("date <= newest").join(unadjusted, KEY, "left").join(adjusted, KEY, "left")
    # the ids are equal where they are there, so one row a security and year has all three distinct counts
    each = rows.groupBy(F.year("date").alias("year"), "stock_id").agg(F.count("*").alias("n"), F.count("raw_id").alias("raw"), F.count("adj_id").alias("adj"))
    return each.groupBy("year").agg(
        F.sum("n").alias("vendor_listed_rows"), F.count("stock_id").alias("vendor_listed_securities"), number_of(c("raw") > 0, "in_feed_unadjusted_securities"),
        number_of(c("adj") > 0, "in_feed_adjusted_securities"), share(F.sum("raw"), F.sum("n"), 2).alias("feed_unadjusted_row_pct"), share(F.sum("adj"), F.sum("n"), 2).alias("feed_adjusted_row_pct"),
    )


@query
def cmp_overlap_size(w: Warehouse) -> DataFrame:
    """By counts a security and day: no row of aligned is made."""
    held = lambda rows, name: rows.groupBy(*KEY).agg(F.count("*").alias(name))
    if "upstream_adjusted" in w.tables:
        up = held(w.upstream_adjusted, "u")
    else:
        both = held(raw_closes(w.feed_raw_ticker), "t").join(held(raw_closes(w.feed_raw_market), "m"), KEY, "full")
        up = both.select(*KEY, (F.coalesce("t", F.lit(1)) * F.coalesce("m", F.lit(1))).alias("u"))
    sides = held(w.vendor_v_adj_daily_prices, "v").join(held(w.feed_v_adj_daily_prices, "f"), KEY).join(up, KEY, "left").join(held(w.feed_v_daily_prices, "r"), KEY, "left")
    rows = c("v") * c("f") * F.coalesce("u", F.lit(1)) * F.coalesce("r", F.lit(1))
    return sides.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("overlap_rows"), F.countDistinct("stock_id").alias("securities"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def relative() -> Column:
    return F.try_divide(apart("vendor", "feed"), c("feed"))


@query
def cmp_level_by_year(w: Warehouse) -> DataFrame:
    rows = levels(w).where("feed > 0").withColumn("off", relative())
    got = with_weighted_quantiles(
        rows, {"year": F.year("date")}, {"median_off": (c("off"), 0.5), "p95_off": (c("off"), 0.95)}, "times", times_of(None, "n"),
        times_share(apart("vendor", "feed") <= 0.01, 2, "close_within_1c_pct"), times_share(c("off") <= 0.001, 2, "close_within_10bp_pct"),
    )
    return got.select("year", "n", "close_within_1c_pct", "close_within_10bp_pct", pct("median_off", 5).alias("median_rel_diff_pct"), pct("p95_off", 3).alias("p95_rel_diff_pct"))


@query
def cmp_latest_common_date(w: Warehouse) -> DataFrame:
    newest = F.broadcast(w.aligned.agg(F.max("date").alias("newest")))
    off = apart("vendor", "feed")
    # a feed price of 0 is off by any measure unless the vendor's is 0, too, when the quotient is not a number and counts as large
    far = (c("feed") == 0) | (relative() > 0.001)
    return w.aligned.crossJoin(newest).where("date = newest").groupBy("date").agg(F.count("*").alias("n"), number_of(c("vendor") == c("feed"), "exact_close"), number_of(off <= 0.01, "within_1c"), number_of(far, "off_by_more_than_10bp"))


@query
def cmp_return_agreement(w: Warehouse) -> DataFrame:
    segment = F.when(listed(), "listed (TSE/OTC/TIB)").otherwise("emerging (REG)")
    known = lambda x: F.when(c("r_vendor").isNotNull() & c("r_feed").isNotNull(), x)
    total = lambda x: F.sum(known(x * c("times")))
    n, v, f = total(F.lit(1)), total(c("r_vendor")), total(c("r_feed"))
    both, own = total(c("r_vendor") * c("r_feed")) - v * f / n, lambda x, sum_: total(c(x) * c(x)) - sum_ * sum_ / n
    return weighted(w, kinds=BY_SEGMENT).groupBy(segment.alias("segment"), c("clean").alias("both_days_traded")).agg(
        times_of(None, "n"), times_share(apart("r_vendor", "r_feed") <= AGREE, 4, "agree_within_10bp_pct"), times_of(apart("r_vendor", "r_feed") > MATERIAL, "disagree_gt_1pct"),
        F.round(F.try_divide(both, F.sqrt(own("r_vendor", v) * own("r_feed", f))), 6).alias("correlation"),
    )


@query
def cmp_disagreement_causes(w: Warehouse) -> DataFrame:
    sources = ("raw", "vendor", "feed")
    got = with_weighted_quantiles(
        weighted_disagreements(w), {"cause": c("cause")}, {f"m_{x}": (F.abs(f"r_{x}"), 0.5) for x in sources}, "times",
        times_of(None, "days"), F.countDistinct("stock_id").alias("securities"), times_of(beyond("r_vendor"), "vendor_beyond_limit"), times_of(beyond("r_feed"), "feed_beyond_limit"),
    )
    return got.select("cause", "days", "securities", *(pct(f"m_{x}").alias(f"median_abs_{x}_return_pct") for x in sources), "vendor_beyond_limit", "feed_beyond_limit")


@query
def cmp_disagreement_causes_by_year(w: Warehouse) -> DataFrame:
    counts = (times_of(letter() == x, f"cause_{x.lower()}") for x in CAUSES)
    return weighted_disagreements(w).groupBy(F.year("date").alias("year")).agg(*counts)


@query
def cmp_unadjusted_actions_by_market_year(w: Warehouse) -> DataFrame:
    out = []
    for code in ("TSE", "OTC"):
        broke = (c("market") == code) & c("clean") & beyond("r_raw")
        out += [times_of(broke, f"{code.lower()}_unadjusted_breaches"), times_of(broke & beyond("r_feed"), f"{code.lower()}_still_in_feed"), times_of(broke & beyond("r_vendor"), f"{code.lower()}_still_in_vendor")]
    return weighted(w, FREE_ROWS, {x: (x,) for x in ("TSE", "OTC")} | {None: None}).groupBy(F.year("date").alias("year")).agg(*out)


@query
def cmp_no_trade_disagreements(w: Warehouse) -> DataFrame:
    return weighted_disagreements(w).where(letter() == "A").agg(
        times_of(None, "days"), times_of(F.abs("r_feed") <= 0.0005, "feed_flat"), times_of(F.abs("r_vendor").between(c("lim") - 0.012, c("lim")), "vendor_at_limit"),
        times_of(beyond("r_vendor"), "vendor_beyond_limit"), times_of(beyond("r_feed"), "feed_beyond_limit"),
    )


@query
def cmp_halt_resumptions(w: Warehouse) -> DataFrame:
    rows = _firsts(_ends(days(w))).where((c("gap") > MAX_GAP) & (c("raw") > 0) & (c("p_raw") > 0) & (c("p_feed") > 0) & listed())
    moved = rows.select(change("vendor", "p_vendor").alias("r_vendor"), change("feed", "p_feed").alias("r_feed"), change("raw", "p_raw").alias("r_raw"))
    jump = F.abs("r_raw") > 0.25
    return moved.agg(
        F.count("*").alias("resumptions"), number_of(apart("r_vendor", "r_feed") > MATERIAL, "sources_disagree"), number_of(jump, "unadjusted_jump_gt_25pct"), number_of(jump & (F.abs("r_vendor") <= 0.25), "vendor_removed_jump"),
        number_of(jump & (F.abs("r_feed") <= 0.25), "feed_removed_jump"), number_of(jump & (apart("r_feed", "r_raw") <= AGREE), "feed_left_unadjusted"),
    )


def in_pct(*more: str) -> list[Column]:
    names = {"raw": "r_raw", "vendor": "r_vendor", "feed": "r_feed", "feed_ticker": "r_up"}
    return [pct(names[x]).alias(f"{x}_pct") for x in more]


WHO = ["stock_id", "stock_name", "date", "market"]


@query
def cmp_spurious_adjustments(w: Warehouse) -> DataFrame:
    return w.disagreements.where(letter() == "D").orderBy(F.desc(apart("r_feed", "r_vendor")), *KEY).select(*WHO, *in_pct("raw", "vendor", "feed", "feed_ticker"))


@query
def cmp_beyond_limit(w: Warehouse) -> DataFrame:
    series = {"feed_processed": "r_feed", "feed_ticker": "r_up", "vendor": "r_vendor"}
    return settled(w).agg(
        times_of(None, "n"), times_of(beyond("r_raw"), "unadjusted_beyond_limit"), *(times_of(beyond(r), f"{x}_beyond_limit") for x, r in series.items()), *(times_of(F.abs(r) > 0.5, f"{x}_gt_50pct") for x, r in series.items())
    )


@query
def cmp_beyond_limit_by_year(w: Warehouse) -> DataFrame:
    series = {"unadjusted": "r_raw", "feed_processed": "r_feed", "feed_ticker": "r_up", "vendor": "r_vendor"}
    return settled(w).groupBy(F.year("date").alias("year")).agg(times_of(None, "n"), *(times_of(beyond(r), x) for x, r in series.items()))


@query
def cmp_vendor_beyond_limit_sample(w: Warehouse) -> DataFrame:
    return settled_moves(w).where(beyond("r_vendor")).orderBy(F.desc(F.abs("r_vendor")), *KEY).limit(40).select(*WHO, *in_pct("raw", "vendor", "feed", "feed_ticker"))


def log_total(r: str) -> Column:
    return F.sum(F.log(F.lit(1) + c(r)) * c("times"))


def _long_enough(rows: DataFrame, **gaps: tuple[str, str]) -> DataFrame:
    """Securities of 250 returns or more, with the distance between two sums of log returns."""
    each = rows.groupBy("stock_id").agg(times_of(None, "n"), *(F.abs(log_total(a) - log_total(b)).alias(x) for x, (a, b) in gaps.items()))
    return each.where("n >= 250")


@query
def cmp_total_return_gap(w: Warehouse) -> DataFrame:
    rows = weighted(w, kinds=LISTED_ALONE).where(listed() & c("r_up").isNotNull() & (c("r_vendor") > -1) & (c("r_feed") > -1) & (c("r_up") > -1))
    each = _long_enough(rows, processed=("r_vendor", "r_feed"), ticker=("r_vendor", "r_up"))
    long = each.select(F.explode(F.array(F.struct(F.lit("feed processed vs vendor").alias("pair"), c("processed").alias("gap")), F.struct(F.lit("feed ticker vs vendor").alias("pair"), c("ticker").alias("gap")))).alias("x")).select("x.*")
    steps = (number_of(c("gap") <= 0.01, "within_1pct"), number_of((c("gap") > 0.01) & (c("gap") <= 0.10), "gap_1_to_10pct"), number_of((c("gap") > 0.10) & (c("gap") <= 0.50), "gap_10_to_50pct"), number_of(c("gap") > 0.50, "gap_over_50pct"))
    pairs = w.spark.createDataFrame([("feed processed vs vendor",), ("feed ticker vs vendor",)], "pair string")
    counted = long.groupBy("pair").agg(F.count("*").alias("securities"), *steps)
    return pairs.join(counted, "pair", "left").fillna(0)  # a pair without securities has a row of zeros


@query
def cmp_total_return_gap_recent(w: Warehouse) -> DataFrame:
    rows = weighted(w, kinds=LISTED_ALONE).where(listed() & (c("date") >= F.lit("1997-01-01").cast("date")) & c("r_up").isNotNull() & (c("r_vendor") > -1) & (c("r_up") > -1))
    each = _long_enough(rows, gap=("r_vendor", "r_up"))
    return each.agg(F.count("*").alias("securities"), number_of(c("gap") <= 0.01, "within_1pct"), number_of((c("gap") > 0.01) & (c("gap") <= 0.10), "gap_1_to_10pct"), number_of(c("gap") > 0.10, "gap_over_10pct"), pct(F.median("gap"), 4).alias("median_gap_pct"))


def _suspicious(w: Warehouse) -> DataFrame:
    return settled_moves(w).where(beyond("r_vendor") & (F.abs("r_raw") <= c("lim")))


@query
def cmp_vendor_suspicious(w: Warehouse) -> DataFrame:
    return _suspicious(w).orderBy(F.desc(F.abs("r_vendor")), *KEY).select(*WHO, *in_pct("raw", "vendor", "feed_ticker"))


@query
def cmp_vendor_suspicious_summary(w: Warehouse) -> DataFrame:
    return _suspicious(w).agg(F.count("*").alias("vendor_breach_while_unadjusted_within_limit"), number_of(beyond("r_up"), "feed_ticker_also_breaches"), number_of(F.abs("r_up") <= c("lim"), "only_vendor_breaches"))


@query
def cmp_stale_market_snapshots(w: Warehouse) -> DataFrame:
    both = raw_closes(w.feed_raw_market).withColumnRenamed("close", "m").join(raw_closes(w.feed_raw_ticker).withColumnRenamed("close", "t"), KEY).where("t > 0")
    differs = F.abs(c("m") / c("t") - 1) > AGREE
    each = both.groupBy("stock_id").agg(F.count("*").alias("n"), number_of(differs, "off"), F.min("date").alias("first"), F.max("date").alias("last"))
    return each.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in_both"), F.count("stock_id").alias("securities"), F.coalesce(F.sum("off"), F.lit(0)).alias("rows_market_differs"), number_of(c("off") > 0, "securities_affected"),
        F.min("first").alias("first_market_day"), F.max("last").alias("last_market_day"),
    )


@query
def cmp_zero_price_by_year(w: Warehouse) -> DataFrame:
    zero = c("close") == 0
    return w.feed_v_daily_prices.groupBy("year").agg(F.count("*").alias("n_rows"), number_of(zero, "close_is_zero"), number_of(zero & (c("volume") > 0), "zero_price_with_volume"), share(number_of(zero, "x"), F.count("*"), 3).alias("zero_pct"))


@query
def cmp_no_trade_day_rule(w: Warehouse) -> DataFrame:
    """Days without trade where both series stand at factor 1: does a source carry the last close, or move to bid or offer?"""
    near = lambda a, b: apart(a, b) < 0.0051
    ended = _ends(days(w, "bid", "offer"))
    one = _moves(ended).withColumns({"times": F.lit(1).cast("long"), "carried": F.when(near("feed", "p_feed"), 1).otherwise(0).cast("long")})
    # raw prices only rise within a day, so none falls to 0: all other rows that matter stand at the first, and follow the last
    long = lambda x: F.size(x).cast("long")
    steps = F.zip_with(F.slice("f", 2, F.greatest(F.size("f") - 1, F.lit(0))), F.slice("f", 1, F.greatest(F.size("f") - 1, F.lit(0))), lambda x, was: F.abs(x["feed"] - was["feed"]) < 0.0051)
    carried = (c("n_u") - 1) * long(F.filter("f", lambda x: x["feed"].isNotNull())) + long(F.filter(steps, lambda x: x))
    still = ended.withColumns({"raw": F.get("r", F.lit(0))["raw"], "p_raw": c("l_raw")}).where((c("raw") == 0) & (c("p_raw") > 0) & (c("n_f") * c("n_u") > 1))
    tails = still.select("raw", "p_raw", (c("n_f") * c("n_u") - 1).alias("times"), carried.alias("carried"), exploded("v").alias("v")).select("*", "v.*").withColumn("p_vendor", c("vendor"))
    told = ("market", "vendor", "p_vendor", "bid", "offer", "raw", "p_raw", "times", "carried")
    rows = one.select(*told).unionByName(tails.select(*told)).where((c("raw") == 0) & (c("p_raw") > 0) & near("p_vendor", "p_raw") & listed())
    moved = apart("vendor", "p_vendor") >= 0.0051
    return rows.agg(
        times_of(None, "no_trade_days_at_factor_1"), F.coalesce(F.sum("carried"), F.lit(0)).alias("feed_carries_last_close"), times_of(near("vendor", "p_vendor"), "vendor_equals_last_close"),
        times_of(moved & near("vendor", "bid"), "vendor_moved_to_bid"), times_of(moved & near("vendor", "offer"), "vendor_moved_to_offer"),
        times_of(moved & (apart("vendor", "bid") >= 0.0051) & (apart("vendor", "offer") >= 0.0051), "vendor_other"),
    )


@query
def cmp_vendor_zero_volume_rows(w: Warehouse) -> DataFrame:
    none = c("volume_k_shares") == 0
    return w.vendor_v_adj_daily_prices.groupBy("market").agg(F.count("*").alias("n_rows"), number_of(none, "zero_volume_rows"), share(number_of(none, "x"), F.count("*"), 3).alias("zero_volume_pct"))


@query
def cmp_activity_by_year(w: Warehouse) -> DataFrame:
    return activity(w, "vendor_vol", "vendor_amt", "vendor_tx", "feed_vol", "feed_amt", "feed_tx").groupBy(F.year("date").alias("year")).agg(
        times_of(None, "n"), times_share(apart("vendor_vol", "feed_vol") > 1000, 3, "volume_off_gt_1000_pct"), times_share(apart("vendor_amt", "feed_amt") > 1000, 3, "turnover_off_gt_1000_pct"),
        times_share(~c("vendor_tx").eqNullSafe(c("feed_tx")), 3, "transactions_differ_pct"),
    )


@query
def cmp_volume_mismatch_shape(w: Warehouse) -> DataFrame:
    ratio = F.try_divide(c("feed_vol"), c("vendor_vol"))
    period = F.when(c("date") < F.lit("2004-02-11").cast("date"), "before 2004-02-11").otherwise("from 2004-02-11")
    quartiles = {"ratio_p25": (ratio, 0.25), "ratio_median": (ratio, 0.5), "ratio_p75": (ratio, 0.75)}
    larger = times_share(c("feed_vol") > c("vendor_vol"), 2, "feed_larger_pct")
    rows = activity(w, "vendor_vol", "feed_vol").where(apart("vendor_vol", "feed_vol") > 1000)
    got = with_weighted_quantiles(rows, {"period": period}, quartiles, "times", times_of(None, "mismatched_rows"), larger)
    return got.select("period", "mismatched_rows", "feed_larger_pct", *(F.round(x, 4).alias(x) for x in quartiles))


@query
def cmp_volume_unit_error(w: Warehouse) -> DataFrame:
    """Years before 2008 in which the feed's figures look like thousandths."""
    small = lambda kind: (c(f"feed_{kind}") > 0) & (F.abs(F.try_divide(c(f"vendor_{kind}"), c(f"feed_{kind}")) / 1000 - 1) < 0.01)
    rows = activity(w, "vendor_vol", "vendor_amt", "feed_vol", "feed_amt").where(c("date") < F.lit("2008-01-01").cast("date"))
    return rows.groupBy(F.year("date").alias("year")).agg(
        times_of(None, "n"), times_of(small("vol"), "feed_volume_is_1_1000th"), times_of(small("amt"), "feed_turnover_is_1_1000th"), times_share(small("vol"), 2, "volume_pct")
    )


def cmp_volume_unit_error_sample_of(w: Warehouse, ids: tuple[str, ...], first: str, last: str) -> DataFrame:
    rows = w.aligned.where(c("stock_id").isin(*ids) & c("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return rows.select(
        "stock_id", "stock_name", "date", c("vendor_vol").alias("vendor_volume_shares"), c("feed_vol").alias("feed_volume"), c("vendor_amt").alias("vendor_turnover"), c("feed_amt").alias("feed_turnover"),
        c("raw").alias("feed_unadjusted_close"), F.round(F.try_divide(c("feed_amt"), c("feed_vol")), 2).alias("feed_implied_price"),
    )


@query
def cmp_volume_unit_error_sample(w: Warehouse) -> DataFrame:
    return cmp_volume_unit_error_sample_of(w, ("0012", "0021"), "1998-03-01", "1998-06-30")


def missing_by_month(w: Warehouse, first: str, last: str) -> DataFrame:
    feed = w.feed_v_daily_prices.select(*KEY, c("date").alias("feed_date"))
    rows = w.vendor_v_adj_daily_prices.where(c("market").isin("TSE", "OTC") & c("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).join(feed, KEY, "left")
    each = rows.groupBy("date", "market").agg(F.count("*").alias("n"), F.count("feed_date").alias("fed"))
    return each.groupBy(F.date_format("date", "yyyy-MM").alias("month"), "market").agg(
        F.sum("n").alias("vendor_rows"), (F.sum("n") - F.sum("fed")).alias("missing_in_feed"), F.count("date").alias("vendor_days"), number_of(c("fed") > 0, "feed_days")
    )


@query
def cmp_feed_hole(w: Warehouse) -> DataFrame:
    return missing_by_month(w, "1996-10-01", "1998-03-31")


def _vendor_returns(w: Warehouse) -> DataFrame:
    """An id's rows of one day come by name, then by what is looked at, so that the result does not depend on the order of rows."""
    upward = Window.partitionBy("stock_id").orderBy("date", "stock_name", "close", "return_pct", "volume_k_shares", "market")
    rows = w.vendor_v_adj_daily_prices.select(*KEY, "market", "close", "return_pct", "volume_k_shares", F.lag("close").over(upward).alias("p"), F.datediff("date", F.lag("date").over(upward)).alias("gap"))
    return rows.where((c("gap") <= MAX_GAP) & (c("p") > 0)).withColumn("off", F.abs(c("return_pct") / 100 - (F.try_divide(c("close"), c("p")) - 1)))


@query
def cmp_vendor_internal_return_check(w: Warehouse) -> DataFrame:
    return _vendor_returns(w).groupBy(F.when(listed(), "listed").otherwise("emerging").alias("segment")).agg(
        F.count("*").alias("n"), number_of(c("return_pct").isNull(), "return_null"), share(number_of(c("off") <= 0.0005, "x"), F.count("*"), 4).alias("matches_within_5bp_pct"), number_of(c("off") > 0.01, "differs_gt_1pct")
    )


@query
def cmp_vendor_internal_return_sample(w: Warehouse) -> DataFrame:
    return _vendor_returns(w).where(listed() & (c("off") > 0.01)).groupBy(F.year("date").alias("year")).agg(
        F.count("*").alias("rows_differ_gt_1pct"), number_of(c("volume_k_shares") == 0, "on_zero_volume_days"), number_of(F.abs("return_pct") < 0.0001, "vendor_return_field_is_zero")
    )


def case_series(w: Warehouse, stock_id: str, first: str, last: str, *more: str) -> DataFrame:
    """The aligned series of one security."""
    rows = w.aligned.where((c("stock_id") == stock_id) & c("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return rows.select("date", "vendor", c("feed").alias("feed_processed"), c("feed_up").alias("feed_ticker"), c("raw").alias("feed_unadjusted"), *more)


@query
def case_stale_basis(w: Warehouse) -> DataFrame:
    return case_series(w, "0012", "1997-08-10", "1997-12-16", "feed_source")


@query
def case_capital_reduction(w: Warehouse) -> DataFrame:
    return case_series(w, "0025", "1996-10-01", "1998-06-30")


@query
def case_largest_disagreements(w: Warehouse) -> DataFrame:
    most = Window.partitionBy(letter()).orderBy(F.desc(apart("r_vendor", "r_feed")), *KEY)
    return w.disagreements.where(letter().isin("B", "C", "D", "E")).withColumn("nth", F.row_number().over(most)).where("nth <= 6").select("cause", "stock_id", "stock_name", "date", *in_pct("raw", "vendor", "feed", "feed_ticker"))


@query
def cmp_disagreement_top_securities(w: Warehouse) -> DataFrame:
    rows = weighted_disagreements(w, {x: (x,) for x in LISTED}).where(letter().isin("C", "D", "E"))
    newest = F.max(F.struct("date", "stock_name", "market"))  # of several on a day, the greatest name
    each = rows.groupBy("stock_id").agg(
        newest["stock_name"].alias("stock_name"), newest["market"].alias("market"), times_of(None, "days"), *(times_of(letter() == x, f"{x.lower()}_days") for x in "CDE"),
        F.min("date").alias("first_day"), F.max("date").alias("last_day"),
    )
    return each.orderBy(F.desc("days"), "stock_id").limit(12)


@query
def cmp_weighted_agreement(w: Warehouse) -> DataFrame:
    """One figure over all segments: agreement weighted by rows, from the grouped table."""
    rows = cmp_return_agreement(w).where("both_days_traded")
    return rows.agg(F.sum("n").alias("n"), F.round(F.sum(c("n") * c("agree_within_10bp_pct")) / F.sum("n"), 4).alias("agree_within_10bp_pct"))


@query
def cmp_residual_breach_share(w: Warehouse) -> DataFrame:
    """By year, the share of unadjusted limit breaches that each source leaves in its adjusted series; null without any."""
    rows = cmp_beyond_limit_by_year(w)
    left = lambda x: F.when(c("unadjusted") > 0, F.round(F.lit(100.0) * c(x) / c("unadjusted"), 1)).alias(f"{x}_pct")
    return rows.select("year", "unadjusted", left("feed_processed"), left("vendor"))


__all__ = ["CAUSES", "QUERIES", "VIEWS", "cached"]
