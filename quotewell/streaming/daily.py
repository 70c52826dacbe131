"""The daily job as a stream: raw market days land in a folder, and each micro-batch replaces their days in the processed dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotewell.operators.etl import type_prices
from quotewell.sources.schemas import PRICE, RAW_PRICE, enforce
from quotewell.sources.versions import replace_days


def process_market_days(raw: DataFrame, root: str, universe: DataFrame | None = None) -> None:
    """Type a batch of whole-market rows, keep the universe's, drop repeated keys, and replace its days. Idempotent: a day twice is that day once."""
    rows = type_prices(raw, "market")
    if universe is not None:
        rows = rows.join(universe.select("stock_id").distinct(), "stock_id", "left_semi")
    one = rows.groupBy("stock_id", "date").agg(*(F.max_by(x, F.struct("volume", "close")).alias(x) for x in rows.columns if x not in ("stock_id", "date")))
    typed = enforce(one.withColumn("ingested_at", F.current_timestamp()), PRICE)
    if not typed.isEmpty():
        replace_days(typed, root, PRICE, "date", "stock_id")


def follow_market_days(spark: SparkSession, folder: str, root: str, checkpoint: str, universe: DataFrame | None = None, *, once: bool = True) -> StreamingQuery:
    """Process files as they arrive in folder; once: all that are there, then stop. A corrected day is a new file and replaces the old."""
    files = spark.readStream.schema(RAW_PRICE).option("maxFilesPerTrigger", 64).parquet(folder)
    writer = files.writeStream.foreachBatch(lambda batch, _: process_market_days(batch, root, universe)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def late_rows(bars: DataFrame, *, delay: str = "3 days") -> DataFrame:
    """Rows and securities of each day of a stream of bars (with an event time ts), final when the watermark passes the day."""
    return bars.withWatermark("ts", delay).groupBy(F.window("ts", "1 day").alias("day")).agg(F.count("*").alias("row_count"), F.approx_count_distinct("stock_id").alias("securities"))
