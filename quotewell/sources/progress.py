"""State of backfills as an append-only table: an attempt is a row, the newest one counts, and nothing of it passes through the driver.

Rows: dataset, stock_id, n_rows (what the fetch wrote; 0: the source has nothing; FAILED: an error), attempted_at. A batch of attempts is one commit of
versions.py, so a job that dies between batches repeats at most one. compact() folds the table to the newest attempts; appends meanwhile make it start again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.functions.exprs import c
from quotewell.sources import versions
from quotewell.sources.schemas import enforce, schema

ATTEMPT = schema("dataset string, stock_id string, n_rows bigint, attempted_at timestamp")
KEY = ["dataset", "stock_id"]
#: Fixed value: n_rows of an attempt that failed.
FAILED = -1


def record(attempts: DataFrame, root: str) -> int:
    """Append a batch of attempts. Rows without a dataset or id name nothing that could be fetched, and go. Returns the version."""
    rows = enforce(attempts, ATTEMPT).where("dataset IS NOT NULL AND stock_id IS NOT NULL")
    return versions.publish(rows, root, *KEY, by=(), replace="nothing")


def attempts(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """All attempts; none if nothing was recorded."""
    return versions.read(spark, root, ATTEMPT, by=(), number=number)


def newest(rows: DataFrame) -> DataFrame:
    """The newest attempt of each key. Of attempts at one time the one that wrote most counts, so that a success outdoes a failure; an unknown n_rows is a failure."""
    known = rows.withColumn("n_rows", F.coalesce("n_rows", F.lit(FAILED)))
    return known.groupBy(*KEY).agg(F.max_by(F.struct("n_rows", "attempted_at"), F.struct("attempted_at", "n_rows")).alias("x")).select(*KEY, "x.n_rows", "x.attempted_at")


def plan(wanted: DataFrame, held: DataFrame, rows: DataFrame) -> DataFrame:
    """dataset, stock_id, reason: what a resumed backfill has to fetch, of the wanted keys.

    new: never tried; retry: the newest attempt failed; lost: it wrote rows, but held has none, so the record is not to be trusted.
    What wrote rows that are held is done, and so is what the source had nothing of. wanted and held have dataset and stock_id, repeated or not.
    """
    last = newest(rows).withColumn("tried", F.lit(True))
    kept = held.select(*KEY).distinct().withColumn("held", F.lit(True))
    keys = wanted.select(*KEY).where("dataset IS NOT NULL AND stock_id IS NOT NULL").distinct()
    marked = keys.join(last, KEY, "left").join(kept, KEY, "left")
    reason = F.when(c("tried").isNull(), "new").when(c("n_rows") < 0, "retry").when((c("n_rows") > 0) & c("held").isNull(), "lost")
    return marked.withColumn("reason", reason).where("reason IS NOT NULL").select(*KEY, "reason")


def compact(spark: SparkSession, root: str, tries: int = 5) -> int | None:
    """Fold the table to the newest attempts, as one commit. Returns the version; None if there is nothing to fold."""
    for left in reversed(range(tries)):
        based_on = versions.newest(spark, root)
        if based_on is None:
            return None
        try:
            return versions.publish(newest(attempts(spark, root, based_on)), root, *KEY, by=(), based_on=based_on)
        except versions.Conflict:
            if not left:
                raise
    return None
