"""Column shorthands used by the views and comparisons."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

#: Market codes whose securities are listed; the others trade over the counter without limits.
LISTED = ("TSE", "OTC", "TIB")
KNOWN_MARKETS = (*LISTED, "REG", "PSB")


def by_security() -> WindowSpec:
    return Window.partitionBy("stock_id").orderBy("date")


def c(name: str) -> Column:
    return F.col(name)


def number_of(condition: Column, name: str) -> Column:
    """How many rows meet the condition; unknown counts as no."""
    return F.count(F.when(condition, True)).alias(name)


def share(part: Column, whole: Column, digits: int) -> Column:
    return F.round(F.lit(100.0) * part / whole, digits)


def gap_days() -> Column:
    """Days since the security's row before."""
    return F.datediff("date", F.lag("date").over(by_security()))


def last_by(value: str, order: str) -> Column:
    """The value of the row with the largest order. Rows whose value is null count, as the newest row is what is asked for."""
    return F.max_by(value, order)


def year_of(column: str = "date") -> Column:
    return F.year(column)


def neighbour_median(value: str, *partition: str) -> Column:
    """Median over five rows before, the row, and five after, by date."""
    frame = Window.partitionBy(*partition).orderBy("date").rowsBetween(-5, 5)
    return F.expr(f"percentile({value}, 0.5D)").over(frame)
