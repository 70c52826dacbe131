"""A market data API as a Spark source: spark.read.format("market_api"), a partition a day, a ticker, or a whole table.

Options: url, dataset; mode day (the whole market of each day from `first` to `last`), ticker (the history of each of `tickers`) or table (one call); token; quota (the
address of a QuotaServer); attempts, pause (of passing failures), quota_attempts, quota_pause (of refusals for quota). The schema is the caller's: values are
brought to it, columns that an answer lacks are null.

With the option pushdown=true, filters on date (day mode) and stock_id (ticker mode) decide which calls are made at all. It is off by
default: Spark 4.1 keeps the calls that a filter left with the loaded DataFrame, so that the same DataFrame without a filter, later, would make only those. With pushdown, load
anew for each query.
 A call depends on its partition alone, so a task that is run again fetches its
rows again, and none twice. As a stream (mode day), offsets are days: a restart goes on after the last day that was committed.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from quotewell.sources.quota import Quota


class ApiError(RuntimeError):
    """An answer that trying again won't change."""


class Passing(RuntimeError):
    """A failure that may pass: the net, a busy server, an answer cut short."""


class QuotaRefused(RuntimeError):
    """The provider says that the quota is spent."""


@dataclass
class Call(InputPartition):
    """The parameters that one partition's call has besides the dataset."""

    asked: dict[str, str]


def fetch(options: dict[str, str], asked: dict[str, str], quota: Quota | None = None) -> list[dict[str, object]]:
    """The rows of one call; an empty list is an answer. Passing failures are tried again after growing pauses, refusals for quota after a long one with the bucket drained."""
    tries, refusals = int(options.get("attempts", 5)), int(options.get("quota_attempts", 6))
    pause = float(options.get("pause", 2.0))
    while True:
        try:
            if quota:
                quota.turn()
            return _once(options, asked)
        except Passing:
            tries -= 1
            if not tries:
                raise
            time.sleep(min(pause, 60.0))
            pause *= 2
        except QuotaRefused:
            refusals -= 1
            if not refusals:
                raise
            if quota:
                quota.drain()
            time.sleep(float(options.get("quota_pause", 300.0)))


def _once(options: dict[str, str], asked: dict[str, str]) -> list[dict[str, object]]:
    headers = {"Authorization": f"Bearer {options['token']}"} if options.get("token") else {}
    where = f"{options['url']}?{urllib.parse.urlencode({'dataset': options['dataset'], **asked})}"
    try:
        with urllib.request.urlopen(urllib.request.Request(where, headers=headers), timeout=float(options.get("timeout", 120))) as answer:
            body = json.loads(answer.read())
    except urllib.error.HTTPError as e:
        if e.code == 402:
            raise QuotaRefused("HTTP 402") from e
        if e.code == 429 or e.code >= 500:
            raise Passing(f"HTTP {e.code}") from e
        raise ApiError(f"HTTP {e.code} for {asked}: {e.read()[:300]!r}") from e
    except (OSError, ValueError) as e:  # the net, or no JSON
        raise Passing(str(e)) from e
    if body.get("status", 200) != 200:
        raise ApiError(f"status {body['status']} for {asked}: {body.get('msg')}")
    return body.get("data") or []


def typed(value: object, kind: T.DataType) -> object:
    """A JSON value as a column's type; what can't be one is null."""
    if value is None:
        return None
    try:
        if isinstance(kind, T.StringType):
            return value if isinstance(value, str) else json.dumps(value)
        if isinstance(kind, T.DateType):
            return dt.date.fromisoformat(str(value)[:10])
        if isinstance(kind, (T.LongType, T.IntegerType)):
            return int(value) if not isinstance(value, float) or value.is_integer() else None
        if isinstance(kind, T.DoubleType):
            return float(value)
    except (ValueError, TypeError, OverflowError):
        return None
    return value


def _day(value: object) -> dt.date:
    return dt.date.fromisoformat(str(value)[:10])


class _Reads:
    """What batch and stream have in common."""

    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        self.options, self.schema = dict(options), schema

    def read(self, partition: Call | None) -> Iterator[tuple]:
        if partition is None:  # what Spark passes if there are no partitions
            return
        quota = Quota(self.options["quota"]) if self.options.get("quota") else None
        try:
            rows = fetch(self.options, partition.asked, quota)
        finally:
            if quota:
                quota.close()
        for row in rows:
            yield tuple(typed(row.get(f.name), f.dataType) for f in self.schema)


class ApiReader(_Reads, DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        super().__init__(options, schema)
        self.mode = options.get("mode", "day")
        if self.mode == "day":
            self.first, self.last = _day(options["first"]), _day(options["last"])
        self.only: set[str] | None = None

    def partitions(self) -> list[Call]:
        if self.mode == "table":
            return [Call({})]
        if self.mode == "ticker":
            span = {k: self.options[o] for k, o in (("start_date", "first"), ("end_date", "last")) if self.options.get(o)}
            return [Call({"data_id": t, **span}) for t in self.options["tickers"].split(",") if t and (self.only is None or t in self.only)]
        return _days(self.first, self.last, self.only)


class NarrowedReader(ApiReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Filters narrow the calls; Spark still applies them to the rows."""
        on = {"day": ("date",), "ticker": ("stock_id",)}.get(self.mode, ())
        for f in filters:
            if getattr(f, "attribute", None) == on:
                self._narrow(f)
            yield f

    def _narrow(self, f: Filter) -> None:
        if isinstance(f, (EqualTo, In)):
            wanted = {str(x)[:10] if self.mode == "day" else str(x) for x in (f.value if isinstance(f, In) else [f.value]) if x is not None}
            self.only = wanted if self.only is None else self.only & wanted
        elif self.mode == "day" and isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
            try:
                day = _day(f.value)
            except ValueError:  # text that is no day
                return
            if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.first = max(self.first, day)
            else:
                self.last = min(self.last, day)


def _days(first: dt.date, last: dt.date, only: set[str] | None = None) -> list[Call]:
    every = (first + dt.timedelta(k) for k in range((last - first).days + 1))
    return [Call({"start_date": str(d)}) for d in every if only is None or str(d) in only]


class ApiStream(_Reads, DataSourceStreamReader):
    """Whole days as they end: up to `last`, or else up to yesterday."""

    def initialOffset(self) -> dict:
        return {"next": self.options["first"]}

    def latestOffset(self) -> dict:
        end = _day(self.options["last"]) if self.options.get("last") else dt.datetime.now(dt.UTC).date() - dt.timedelta(1)
        return {"next": str(max(_day(self.options["first"]), end + dt.timedelta(1)))}

    def partitions(self, start: dict, end: dict) -> list[Call]:
        return _days(_day(start["next"]), _day(end["next"]) - dt.timedelta(1))

    def commit(self, end: dict) -> None:
        pass


class MarketApi(DataSource):
    @classmethod
    def name(cls) -> str:
        return "market_api"

    def schema(self) -> T.StructType:
        raise ValueError("give the schema: spark.read.format('market_api').schema(...)")

    def reader(self, schema: T.StructType) -> ApiReader:
        return (NarrowedReader if self.options.get("pushdown", "false").lower() == "true" else ApiReader)(self.options, schema)

    def streamReader(self, schema: T.StructType) -> ApiStream:
        return ApiStream(self.options, schema)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let filters reach Python sources that ask for them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MarketApi)
