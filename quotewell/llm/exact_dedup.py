"""Exact deduplication by content sort (DataFrame operators only).

Sampled splitters range-partition the normalised texts by their first PREFIX characters and, where those are equal, a hash, so that splitters
are small and headers that many texts share do not gather them. An external sort of the whole texts within each partition puts equal texts next to
each other, and a window compares neighbours in full; no hash decides equality there.

A text that alone holds more than 1/HOT_SHARE of the rows is dealt out over salted slices, each sorted like any
other text. The at most HOT_SHARE such texts are then joined across their slices, one row a slice.

Cases: a null text counts as empty. Of rows equal in text and id one stays. Null ids rank below all others; a group of
null ids only has a null keep_id and one row kept. Very long texts are sorted and compared whole. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, text_or_empty

#: A text is hot with more than one in so many rows; so at most this many texts are hot, whatever the size of the table.
HOT_SHARE = 2048
PREFIX = 32


def hot_texts(rows: DataFrame) -> list[int]:
    """Hashes of the hot texts: at most HOT_SHARE numbers. They choose salts and never decide equality."""
    total = rows.count()
    counted = rows.groupBy(F.xxhash64("t").alias("h")).agg(F.count("*").alias("n"))
    return [r.h for r in counted.where((F.col("n") > total / HOT_SHARE) & (F.col("n") > 64)).select("h").collect()]


def _grouped(rows: DataFrame, keep: str, carried: list[str]) -> DataFrame:
    """rows (id, t, carried) -> id, carried, keep, n (the group's size), kept."""
    hot = hot_texts(rows)
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("head", F.left("t", F.lit(PREFIX))).withColumn("hash", F.xxhash64("t")).withColumn("hot", F.col("hash").isin(hot) if hot else F.lit(False))
    place = ["head", "hash"]
    if hot:
        salted = salted.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(slices))).otherwise(F.lit(0).cast("long")))
        place.append("salt")
    order = F.desc_nulls_last("id") if keep == "largest" else F.asc_nulls_last("id")
    near = Window.partitionBy(*place, "t")
    sorted_rows = salted.repartitionByRange(*place).sortWithinPartitions(*place, "t", order)
    local = sorted_rows.select(
        "id", "hot", F.sha2("t", 256).alias("sha"), *carried,
        F.row_number().over(near.orderBy(order)).alias("rn"), F.first("id").over(near.orderBy(order)).alias("keep"), F.count("*").over(near).alias("n"),
    )
    if hot:
        local = materialise(local, "exact")
        best = F.max("keep") if keep == "largest" else F.min("keep")
        whole = local.where("hot AND rn = 1").groupBy("sha").agg(best.alias("keep_all"), F.sum("n").alias("n_all"))  # <= HOT_SHARE rows
        local = local.join(F.broadcast(whole), "sha", "left")
        local = local.withColumn("rn", F.when(F.col("n_all").isNull() | F.col("keep").eqNullSafe(F.col("keep_all")), F.col("rn")).otherwise(F.lit(0)))
        local = local.withColumn("keep", F.when(F.col("n_all").isNull(), F.col("keep")).otherwise(F.col("keep_all"))).withColumn("n", F.coalesce("n_all", "n"))
    return local.withColumn("kept", F.col("rn") == 1)


def exact_dedup(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = lambda c: c, keep: str = "largest"
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    keep: "smallest" or "largest" id of each group of equal texts stays.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep!r}")
    rows = docs.select(F.col(id_col).alias("id"), normalise(text_or_empty(text_col)).alias("t"))
    return _grouped(rows, keep, []).select(F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("n").cast("long").alias("group_size"), "kept", F.col("sha").alias("text_sha256"))


def distinct_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of docs that exact_dedup() keeps, with all their columns. Texts move once and are joined to nothing."""
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t"), F.struct(F.col(text_col).isNull().alias("none"), *(F.col(c).alias(f"c{k}") for k, c in enumerate(others))).alias("row"))
    kept = _grouped(rows, keep, ["t", "row"]).where("kept")
    text = F.when(~F.col("row.none"), F.col("t")).alias(text_col)
    return kept.select(*(text if c == text_col else F.col(f"row.c{others.index(c)}").alias(c) for c in docs.columns))


SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
