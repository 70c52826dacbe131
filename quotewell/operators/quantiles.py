"""Exact quantiles with interpolation, by distributed selection.

The engine's exact percentile keeps every distinct value of a group in one buffer, however large the group is. Here a first pass makes a sketch of bounded size, which
names for each quantile a narrow range that must hold its rank, beside any other aggregates. The second pass counts the values below each range and, of each value
in it, how often it comes; both are combined before they are shuffled. Only the distinct values of one range are then sorted together: about 4 / ACCURACY of a
group's rows, or all of a group of fewer than 4 * ACCURACY.

Nulls are left out, as percentile does; a group without values has null quantiles. NaN is the largest value. The groups must be few (a year, a cause, a price
each): a row for each goes to every task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The inverse of the sketch's error, in ranks relative to the group's size.
ACCURACY = 10_000


def with_quantiles(rows: DataFrame, by: dict[str, Column], wanted: dict[str, tuple[Column, float]], *aggregates: Column, accuracy: int = ACCURACY) -> DataFrame:
    """A row a group: the columns of `by`, the aggregates, and for each name of `wanted` the quantile (0 to 1) of its value, between neighbours in proportion."""
    keys, names = [f"_k{k}" for k in range(len(by))], list(wanted)
    values = {n: f"_v{k}" for k, n in enumerate(names)}
    told = rows.select("*", *(x.alias(k) for k, x in zip(keys, by.values(), strict=True)), *(x.cast("double").alias(values[n]) for n, (x, _) in wanted.items()))

    def sketch(name: str) -> Column:
        q, value = wanted[name][1], values[name]
        ends = F.percentile_approx(value, [max(0.0, q - 2 / accuracy), min(1.0, q + 2 / accuracy)], accuracy)
        many = F.count(value) >= 4 * accuracy  # of a small group every value is in the range
        return F.struct(F.count(value).alias("n"), F.when(many, ends[0]).alias("low"), F.when(many, ends[1]).alias("high")).alias(values[name])

    first = told.groupBy(*keys).agg(*(sketch(n) for n in names), F.struct(F.lit(0).alias("_none"), *aggregates).alias("_other"))
    groups = first.select(*(F.col(k).alias(f"g{k}") for k in keys), F.struct(*values.values(), "_other").alias("_group"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"g{k}")) for k in keys), F.lit(True))

    def place(k: int, name: str) -> Column:
        """(which quantile, value or null if it is below the range); null if it is above, or unknown."""
        value, span = F.col(values[name]), F.col("_group")[values[name]]
        below = span["low"].isNotNull() & (value < span["low"])
        within = span["high"].isNull() | (value <= span["high"])
        return F.when(value.isNotNull() & (below | within), F.struct(F.lit(k).alias("which"), F.when(~below, value).alias("value")))

    # every row counts for its group once (which = -1), so that groups without values stay
    always = F.struct(F.lit(-1).alias("which"), F.lit(None).cast("double").alias("value"))
    placed = F.array_compact(F.array(always, *(place(k, n) for k, n in enumerate(names))))
    near = told.join(F.broadcast(groups), same).select(*keys, "_group", F.explode(placed).alias("_p")).select(*keys, "_group", "_p.which", "_p.value")
    counted = near.groupBy(*keys, "which", "value").agg(F.count("*").alias("m"), F.any_value("_group").alias("_group"))

    upward = Window.partitionBy(*keys, "which").orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    spans = F.array(*(F.col("_group")[values[n]]["n"] for n in names))
    rank = F.element_at(F.array(*(F.lit(float(q)) for _, q in wanted.values())), F.col("which") + 1) * (F.element_at(spans, F.col("which") + 1) - 1)
    ranked = counted.withColumn("upto", F.sum("m").over(upward)).withColumn("rank", F.when(F.col("which") >= 0, rank))
    at = lambda place: F.max(F.when(F.col("value").isNotNull() & (F.col("upto") > place) & (F.col("upto") - F.col("m") <= place), F.col("value")))
    chosen = ranked.groupBy(*keys, "which").agg(
        F.any_value("_group").alias("_group"), F.max("rank").alias("rank"), at(F.floor("rank")).alias("lower"), at(F.ceil("rank")).alias("upper")
    )
    part = F.col("rank") - F.floor("rank")
    between = F.when(part == 0, F.col("lower")).otherwise(F.col("lower") * (1 - part) + F.col("upper") * part)
    sound = F.when(F.col("lower").isNull() | F.col("upper").isNull(), F.raise_error(F.lit("a quantile is outside its range"))).otherwise(between)
    done = chosen.withColumn("quantile", F.when(F.col("which") >= 0, sound))
    wide = done.groupBy(*keys).agg(F.any_value("_group").alias("_group"), *(F.max(F.when(F.col("which") == k, F.col("quantile"))).alias(n) for k, n in enumerate(names)))
    others = first.schema["_other"].dataType.names[1:]
    return wide.select(*(F.col(k).alias(n) for k, n in zip(keys, by, strict=True)), *(F.col("_group")["_other"][x].alias(x) for x in others), *names)


#: Slices of a group, of about equally many rows, for weighted quantiles; a power of 2.
SLICES = 64


def with_weighted_quantiles(rows: DataFrame, by: dict[str, Column], wanted: dict[str, tuple[Column, float]], weight: str, *aggregates: Column) -> DataFrame:
    """with_quantiles for rows that each stand for `weight` equal ones.

    Exact, too: the sketch, which knows no weights, only cuts a group's values into slices. Weights are summed by slice, which finds the slice of a rank, and only that slice's distinct values
    are sorted together: about 1 / SLICES of a group's rows.
    """
    keys, names = [f"_k{k}" for k in range(len(by))], list(wanted)
    told = rows.select("*", *(x.alias(k) for k, x in zip(keys, by.values(), strict=True)), *(x.cast("double").alias(f"_v{k}") for k, (x, _) in enumerate(wanted.values())))
    cuts = [n / SLICES for n in range(1, SLICES)]
    sketches = told.groupBy(*keys).agg(*(F.percentile_approx(f"_v{k}", cuts, ACCURACY).alias(f"_c{k}") for k in range(len(names))), F.struct(F.lit(0).alias("_none"), *aggregates).alias("_other"))
    first = sketches.select(*keys, "_other.*").drop("_none")
    groups = sketches.select(*(F.col(k).alias(f"g{k}") for k in keys), *(f"_c{k}" for k in range(len(names))))
    own = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"g{k}")) for k in keys), F.lit(True))
    cut = told.join(F.broadcast(groups), own).withColumns({f"_s{k}": F.lit(0) for k in range(len(names))})
    for step in (SLICES >> n for n in range(1, SLICES.bit_length())):  # by halves: how many cuts are no greater than the value, which never falls as values rise
        further = lambda k: F.when(F.get(f"_c{k}", F.col(f"_s{k}") + F.lit(step - 1)) <= F.col(f"_v{k}"), F.lit(step)).otherwise(F.lit(0))  # noqa: E731, B023
        cut = cut.withColumns({f"_s{k}": F.col(f"_s{k}") + further(k) for k in range(len(names))})
    pairs = F.array(*(F.struct(F.lit(k).alias("which"), F.col(f"_v{k}").alias("value"), F.col(f"_s{k}").alias("slice")) for k in range(len(names))))
    long = cut.select(*keys, F.col(weight).alias("_w"), F.explode(pairs).alias("_p"))
    placed = long.select(*keys, "_w", "_p.which", "_p.value", "_p.slice").where("value IS NOT NULL AND _w > 0")
    group = [*keys, "which"]

    def summed(x: DataFrame, by_: str) -> DataFrame:
        upward = Window.partitionBy(*group).orderBy(by_).rowsBetween(Window.unboundedPreceding, 0)
        each = x.groupBy(*group, by_).agg(F.sum("_w").alias("m"))
        return each.withColumn("upto", F.sum("m").over(upward)).withColumn("n", F.sum("m").over(Window.partitionBy(*group)))

    rank = F.element_at(F.array(*(F.lit(float(q)) for _, q in wanted.values())), F.col("which") + 1) * (F.col("n") - 1)
    holds = lambda at: (F.col("upto") > at) & (F.col("upto") - F.col("m") <= at)
    slices = summed(placed, "slice").withColumn("rank", rank).where(holds(F.floor("rank")) | holds(F.ceil("rank")))
    slices = slices.select(*(F.col(g).alias(f"s{g}") for g in group), F.col("slice").alias("s_slice"), "rank", (F.col("upto") - F.col("m")).alias("below"))
    same = reduce(lambda a, b: a & b, (F.col(g).eqNullSafe(F.col(f"s{g}")) for g in group), F.col("slice") == F.col("s_slice"))
    near = placed.join(F.broadcast(slices), same).groupBy(*group, "slice", "value").agg(F.sum("_w").alias("m"), F.any_value("rank").alias("rank"), F.any_value("below").alias("below"))
    upward = Window.partitionBy(*group, "slice").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = near.withColumn("upto", F.col("below") + F.sum("m").over(upward))
    at = lambda place: F.max(F.when(holds(place), F.col("value")))
    chosen = ranked.groupBy(*group).agg(F.any_value("rank").alias("rank"), at(F.floor("rank")).alias("lower"), at(F.ceil("rank")).alias("upper"))
    part = F.col("rank") - F.floor("rank")
    between = F.when(part == 0, F.col("lower")).otherwise(F.col("lower") * (1 - part) + F.col("upper") * part)
    sound = F.when(F.col("lower").isNull() | F.col("upper").isNull(), F.raise_error(F.lit("a quantile is outside its slice"))).otherwise(between)
    wide = chosen.withColumn("quantile", sound).groupBy(*(F.col(k).alias(f"s{k}") for k in keys)).agg(*(F.max(F.when(F.col("which") == k, F.col("quantile"))).alias(n) for k, n in enumerate(names)))
    together = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"s{k}")) for k in keys), F.lit(True))
    others = first.columns[len(keys):]
    return first.join(F.broadcast(wide), together, "left").select(*(F.col(k).alias(n) for k, n in zip(keys, by, strict=True)), *others, *names)
