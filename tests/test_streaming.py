import datetime as dt

from pyspark.sql import functions as F

from quotewell.sources.readers import partitioned
from quotewell.sources.schemas import PRICE, RAW_PRICE
from quotewell.streaming.daily import follow_market_days, late_rows, process_market_days

D = dt.date


def raw(spark, *rows):
    return spark.createDataFrame([(d, i, v, 10, 1.0, 2.0, 0.5, c, 0.0, 3) for d, i, c, v in rows], RAW_PRICE)


def held(spark, root):
    return sorted((r.date, r.stock_id, r.close) for r in partitioned(spark, root, PRICE).collect())


def test_files_are_processed_once_and_corrections_replace(spark, tmp_path):
    inbox, root, mark = (str(tmp_path / x) for x in ("in", "bars", "mark"))
    universe = spark.createDataFrame([("1",), ("2",)], "stock_id string")
    raw(spark, ("2024-08-01", "1", 1.0, 5), ("2024-08-01", "9", 1.0, 5), ("2024-08-02", "1", 2.0, 5)).coalesce(1).write.parquet(inbox)
    follow_market_days(spark, inbox, root, mark, universe).awaitTermination()
    assert held(spark, root) == [(D(2024, 8, 1), "1", 1.0), (D(2024, 8, 2), "1", 2.0)]
    raw(spark, ("2024-08-02", "1", 2.5, 5), ("2024-08-02", "2", 7.0, 5)).coalesce(1).write.mode("append").parquet(inbox)
    for _ in range(2):
        follow_market_days(spark, inbox, root, mark, universe).awaitTermination()
    assert held(spark, root) == [(D(2024, 8, 1), "1", 1.0), (D(2024, 8, 2), "1", 2.5), (D(2024, 8, 2), "2", 7.0)]


def test_a_day_twice_is_that_day_once(spark, tmp_path):
    root = str(tmp_path / "bars")
    day = raw(spark, ("2024-08-01", "1", 1.0, 5), ("2024-08-01", "1", 3.0, 9), (None, "1", 1.0, 5))
    for _ in range(2):
        process_market_days(day, root)
        assert held(spark, root) == [(D(2024, 8, 1), "1", 3.0)]
    process_market_days(raw(spark), root)
    assert len(held(spark, root)) == 1


def test_watermarked_counts(spark, tmp_path):
    rows = spark.createDataFrame([(dt.datetime(2024, 8, d), str(k)) for d in (1, 2, 9) for k in range(3)], "ts timestamp, stock_id string")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = late_rows(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), delay="1 day")
    stream.writeStream.format("memory").queryName("late").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = spark.table("late").select(F.col("day.start").cast("date").alias("d"), "row_count").orderBy("d").collect()
    assert [(r.d, r.row_count) for r in got] == [(D(2024, 8, 1), 3), (D(2024, 8, 2), 3)]
