"""The warehouse: base tables, and the views over them by name.

A view is a function of the warehouse. It is planned when first asked for and stores no rows; what a query does not use, Catalyst
prunes. Names carry the source: feed (exchange bars, adjusted and not) or vendor (adjusted bars with 38 columns, index constituents).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

View = Callable[["Warehouse"], DataFrame]
VIEWS: dict[str, View] = {}


def view(f: View) -> View:
    """Register a function under its name."""
    VIEWS[f.__name__] = f
    return f

_SPAN = "year BETWEEN year(lo) AND year(hi) AND date BETWEEN lo AND hi"
#: Table functions for SQL users: arguments, the view they read, its columns with their names (None: all as they are), and the rows. The year bounds let scans prune folders.
RANGES: dict[str, tuple[str, str, dict[str, str] | None, str]] = {
    "daily_prices_between": ("lo DATE, hi DATE", "feed_v_daily_prices", None, _SPAN),
    "adj_daily_prices_between": ("lo DATE, hi DATE", "feed_v_adj_daily_prices", None, _SPAN),
    "prices_combined_between": ("lo DATE, hi DATE", "feed_v_prices_combined", None, _SPAN),
    "vendor_prices_between": ("lo DATE, hi DATE", "vendor_v_adj_daily_prices", None, _SPAN),
    "index_constituents_between": ("lo DATE, hi DATE", "vendor_v_index_constituents", None, _SPAN),
    "index_members_on": (
        "wanted STRING, as_of DATE", "vendor_v_index_constituents",
        {x: x for x in ("stock_id", "stock_name")} | {"prev_weight_pct": "weight_pct"} | {x: x for x in ("index_factor", "free_float_factor", "cap_factor", "shares", "prev_adj_close")},
        "year = year(as_of) AND date = as_of AND index_id = wanted",
    ),
}


class Warehouse:
    """Base tables by name, and views as attributes: w.feed_v_daily_prices."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame], as_of: dt.date | None = None) -> None:
        """as_of: the day that counts as today; by default the session's."""
        self.spark, self.tables, self.as_of, self._planned = spark, tables, as_of, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._planned:
            if name in self.tables:  # a stored table may stand for a view
                self._planned[name] = self.tables[name]
            elif name in VIEWS:
                self._planned[name] = VIEWS[name](self)
            else:
                raise AttributeError(f"no view or table {name!r}")
        return self._planned[name]

    def newest_rows(self, name: str) -> DataFrame:
        """Rows of a base table among which its newest day is: those of its newest month, if the store can tell it by folder names, or else all."""
        return self.tables.get(f"{name}@newest", self.tables[name])

    def register(self) -> list[str]:
        """Make every view a temporary view of the session, for SQL users; a view that can't be planned names itself. RANGES become table functions."""
        for name in VIEWS:
            try:
                getattr(self, name).createOrReplaceTempView(name)
            except Exception as e:
                raise RuntimeError(f"view {name}") from e
        for name, (arguments, source, columns, where) in RANGES.items():
            rows = getattr(self, source)
            shown = {x: x for x in rows.columns} if columns is None else columns
            kinds = ", ".join(f"`{alias}` {rows.schema[x].dataType.simpleString()}" for x, alias in shown.items())
            picked = ", ".join(f"`{x}`" for x in shown)
            self.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE ({kinds}) RETURN SELECT {picked} FROM {source} WHERE {where}")
        return list(VIEWS)

    def smoke_test(self) -> dict[str, int | str]:
        """Rows of each view, or the first line of its error."""
        out: dict[str, int | str] = {}
        for name in VIEWS:
            try:
                out[name] = getattr(self, name).count()
            except Exception as e:  # noqa: BLE001  the report is about all of them
                out[name] = str(e).splitlines()[0]
        return out
