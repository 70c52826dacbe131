"""A comparison store: the sources' bars bucketed by security and sorted by day, so that their joins, and windows by security, move no rows.

Comparing two sources joins four tables by (stock_id, date) and then looks back along each security. From month folders that is a shuffle of each table for the
joins and another for the window. Here the shuffle is paid once, when bars are stored; every comparison after that reads bucket k of each table in task k.
A security's bars are few (one a session), so no bucket grows but with the number of securities: choose buckets so that one is some hundred MB.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from quotewell.plans.warehouse import Warehouse

#: Views that the comparisons join, with their reading order.
JOINED = ("vendor_v_adj_daily_prices", "feed_v_adj_daily_prices", "feed_v_daily_prices", "upstream_adjusted")


def _at(root: str, name: str, buckets: int) -> str:
    return f"{root}/{name}__{buckets}"


def store_for_comparison(w: Warehouse, root: str, buckets: int, catalog: str = "comparison") -> Warehouse:
    """Write JOINED below root, as tables of a database of the catalog, and return the warehouse that reads them."""
    w.spark.sql(f"CREATE DATABASE IF NOT EXISTS {catalog}")
    for name in JOINED:
        rows = getattr(w, name).repartition(buckets, "stock_id").sortWithinPartitions("stock_id", "date")
        rows.write.mode("overwrite").bucketBy(buckets, "stock_id").sortBy("stock_id", "date").option("compression", "zstd").option("path", _at(root, name, buckets)).saveAsTable(f"{catalog}.{name}")
    return open_for_comparison(w, root, buckets, catalog)


def open_for_comparison(w: Warehouse, root: str, buckets: int, catalog: str = "comparison") -> Warehouse:
    """A warehouse whose JOINED views are the stored tables. A session with a catalog of its own learns of them here.

    Joins on (stock_id, date) may use a distribution by stock_id alone only if spark.sql.requireAllClusterKeysForCoPartition is off; this turns it off for the session.
    """
    spark: SparkSession = w.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {catalog}")
    for name in JOINED:
        path = _at(root, name, buckets)
        if not spark.catalog.tableExists(f"{catalog}.{name}"):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
            spark.sql(f"CREATE TABLE {catalog}.{name} ({columns}) USING parquet CLUSTERED BY (stock_id) SORTED BY (stock_id, date) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return Warehouse(spark, w.tables | {name: spark.table(f"{catalog}.{name}") for name in JOINED}, w.as_of)
