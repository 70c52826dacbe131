"""The revision window as a stream: a session is open until later ones have closed it, a session without rows is a gap, and a job too far behind stops.

Time is counted in sessions, not days: the calendar numbers them, and the clock is the number of the newest session that has landed. The state, a few values a
dataset and session, is fed by one row a landing (`landings`), never by bars. The column that moves the watermark goes before the state sees the rows, so a landing
of an old session is not dropped as late: it is what the state is for. Datasets of one stream share its clock, so they should be such as land together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from quotewell.functions.exprs import c
from quotewell.operators.planning import MOST_CATCH_UP, REVISION_DAYS, TooFarBehind
from quotewell.sources.schemas import schema

LANDING = schema("dataset string, date date, n_rows bigint, digest bigint")
SESSION = schema("date date, no bigint")
STATUS = "dataset string, date date, status string, n_rows bigint, corrections bigint"
SESSION_MS = 86_400_000


def landings(bars: DataFrame, dataset: str) -> DataFrame:
    """A row a day of landed bars: how many, and a digest that does not depend on their order. Nothing for rows without a day."""
    content = F.xxhash64(*sorted(x for x in bars.columns if x != "ingested_at")).cast("decimal(38,0)")
    rows = bars.where("date IS NOT NULL").groupBy("date").agg(F.count("*").alias("n_rows"), F.sum(content).alias("total"))
    return rows.select(F.lit(dataset).alias("dataset"), "date", "n_rows", F.xxhash64(c("total").cast("string")).alias("digest"))


class Session(StatefulProcessor):
    """State of one dataset and session. Statuses that it tells:

    open: landed for the first time; corrected: landed anew with other rows while open; final: its window is over;
    gap: a later session has landed and this has not; closed: the source was asked and has nothing, though a later session has landed;
    filled: a gap (or closed session) has landed; late: other rows than the final ones. The same rows again tell nothing.
    """

    def __init__(self, revision: int) -> None:
        self.revision = revision

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "no bigint, n_rows bigint, digest bigint, corrections bigint, status string")

    def _load(self) -> dict[str, Any]:
        got = self.held.get()
        return dict(zip(("no", "n_rows", "digest", "corrections", "status"), got or (None, None, None, 0, None), strict=True))

    def _told(self, key: tuple[str, dt.date], x: dict[str, Any], status: str) -> Row:
        x["status"] = status
        return Row(dataset=key[0], date=key[1], status=status, n_rows=x["n_rows"], corrections=x["corrections"])

    def _due(self, no: int) -> int:
        """Just before the clock says no."""
        return no * SESSION_MS - 1

    def handleInputRows(self, key: tuple[str, dt.date], rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        x, now, out = self._load(), timerValues.getCurrentWatermarkInMs(), []
        # the calendar first, then landings in a fixed order: a batch is told the same way when it is repeated
        for r in sorted(rows, key=lambda r: (r.kind, r.digest or 0)):
            if x["no"] is None:
                x["no"] = r.no
                for due in {self._due(r.no + 1), self._due(r.no + self.revision)}:
                    self.handle.registerTimer(max(due, now + 1))
            if r.kind == "landing":
                out += self._landed(key, x, r, now)
        if x["no"] is not None:
            self.held.update((x["no"], x["n_rows"], x["digest"], x["corrections"], x["status"]))
        yield from out

    def _landed(self, key: tuple[str, dt.date], x: dict[str, Any], r: Row, now: int) -> list[Row]:
        if not r.n_rows:  # asked for, and nothing there: a fact only if no rows are held
            if x["n_rows"]:
                return []
            x["n_rows"] = 0
            return [self._told(key, x, "closed")] if x["status"] == "gap" else []
        if x["n_rows"] and x["digest"] == r.digest:
            return []
        before, first = x["status"], not x["n_rows"]
        x["n_rows"], x["digest"] = r.n_rows, r.digest
        if first:
            told = [self._told(key, x, "filled" if before in ("gap", "closed") else "open")]
            return told + ([self._told(key, x, "final")] if now >= self._due(x["no"] + self.revision) and before is not None else [])
        x["corrections"] += 1
        return [self._told(key, x, "late" if before in ("final", "late") else "corrected")]

    def handleExpiredTimer(self, key: tuple[str, dt.date], timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        x, now, out = self._load(), timerValues.getCurrentWatermarkInMs(), []
        if x["status"] is None and not x["n_rows"]:
            out.append(self._told(key, x, "gap" if x["n_rows"] is None else "closed"))
        if x["n_rows"] and x["status"] not in ("final", "late") and now >= self._due(x["no"] + self.revision):
            out.append(self._told(key, x, "final"))
        self.held.update((x["no"], x["n_rows"], x["digest"], x["corrections"], x["status"]))
        yield from out

    def close(self) -> None:
        pass


def session_statuses(landed: DataFrame, sessions: DataFrame, datasets: tuple[str, ...], *, revision: int = REVISION_DAYS) -> DataFrame:
    """Changes of status (STATUS) from a stream of landings and a stream of numbered sessions, which may be known ahead. Landings name their session's number as `no`.

    Sessions that come after landings of later ones are told as soon as they come. Landings without a number (days that the calendar lacks) have no window and are not followed.
    """
    shape = lambda df, kind, no: df.select("dataset", "date", "no", F.lit(kind).alias("kind"), *(c(x) if x in df.columns else F.lit(None).cast("bigint").alias(x) for x in ("n_rows", "digest")), F.timestamp_seconds(no * (SESSION_MS // 1000)).alias("clock"))
    due = sessions.select(F.explode(F.array(*map(F.lit, datasets))).alias("dataset"), "date", "no")
    known = landed.where("date IS NOT NULL AND no IS NOT NULL")
    both = shape(due, "calendar", F.lit(0)).unionByName(shape(known, "landing", F.when(c("n_rows") > 0, c("no")).otherwise(0))).withWatermark("clock", "0 seconds").drop("clock")
    return both.groupBy("dataset", "date").transformWithState(Session(revision), STATUS, "Append", "EventTime")


def watch_sessions(landed: DataFrame, sessions: DataFrame, datasets: tuple[str, ...], root: str, checkpoint: str, *, revision: int = REVISION_DAYS, most: int = MOST_CATCH_UP) -> StreamingQuery:
    """Follow the landings and keep changes of status below root, a folder a batch, so that a repeated batch replaces itself. Over `most` gaps at once stop the stream
    (TooFarBehind) before any of them is kept: a backfill is due, and a start with a larger `most` then goes on from the checkpoint.
    """

    def keep(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        try:
            worst = rows.where("status = 'gap'").groupBy("dataset").count().orderBy(F.desc("count"), "dataset").first()
            if worst and worst["count"] > most:
                raise TooFarBehind(f"{worst['dataset']}: {worst['count']} sessions are missing and a daily run fetches {most}: run a backfill")
            rows.write.mode("overwrite").parquet(f"{root}/batch={number}")
        finally:
            rows.unpersist()

    statuses = session_statuses(landed, sessions, datasets, revision=revision)
    return statuses.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
