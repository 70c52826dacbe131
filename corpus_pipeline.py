"""From raw documents to tokens, in five stages. Each reads what the one before it wrote.

STAGES holds (name, function); a function takes (spark, docs, sf_dir). All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.llm import bpe, exact_dedup, jaccard, mixing, quality
from quotewell.llm.common import drop_tables, fresh_path, load, made, materialise, row_key, text_or_empty

#: Near copies share word shingles of five: those within 10 of 64 bits and 16 of a second fingerprint's, as strangers hardly ever are, and all with
#: a Jaccard similarity of NEAR_LEAST or more, however far their fingerprints are apart.
NEAR_SHINGLE, NEAR_BITS, NEAR_SECOND_BITS, NEAR_LEAST = 5, 10, 16, 0.8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: null, empty and short texts with them. Other rows stay as often as they come; without labels the base rules decide alone."""
    return quality.good_rows(docs, load(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, of any length, the largest doc_id stays; null ids rank last, and of rows equal in both one stays."""
    return exact_dedup.distinct_texts(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: that of the smallest doc_id, null ids last. Ties go to the lesser digest; of rows equal in id and text one stays."""
    key = row_key(F.col("doc_id"), text_or_empty())
    groups = jaccard.near_groups(docs, shingle=NEAR_SHINGLE, max_bits=NEAR_BITS, second_bits=NEAR_SECOND_BITS, least=NEAR_LEAST)
    grouped = materialise(groups.groupBy("key", "component").agg(F.count("*").alias("near_n")), "groups")
    named = docs.select("doc_id", key.alias("key")).distinct().join(grouped, "key")
    lowest = named.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "near_n")).alias("low"))
    kept = materialise(lowest.select(F.col("low.key").alias("near_key"), "low.near_n"), "kept")
    rows = docs.select(F.struct(*(docs[x] for x in docs.columns)).alias("row"), key.alias("near_key")).join(kept, "near_key")  # a struct, as documents may have columns of these names
    if kept.where("near_n > 1").isEmpty():
        return rows.select("row.*")
    return rows.where("near_n = 1").unionByName(rows.where("near_n > 1").dropDuplicates(["near_key"])).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The production mixture; documents of scarce sources come once for each epoch. Null languages and sources are leaves named null; a very long text is taken or left whole; an empty table gives none."""
    return mixing.mixed_rows(docs, **mixing.production())


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and what they decode to, as digests: a row a row, null texts as empty ones, texts of any length whole."""
    return bpe.production_round_trip(docs)


STAGES = [("quality", quality_rules), ("exact", exact_copies), ("near", near_copies), ("mix", mix_sources), ("tokens", tokenise)]

#: Stages train models, compare fingerprints and tokenise: SQL cannot express them. Tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again. What a stage has read and written on the way is deleted after it."""
    docs, since = load(spark, sf_dir, "documents"), made()
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = fresh_path(spark, f"stage-{name}")
        out.write.parquet(path)
        drop_tables(spark, since, keep=path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
