"""Helpers shared by the text operators: tables in the shared folder, and row keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIR: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where driver and executors are one process (a local master, as in tests) a temporary folder may take its place.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        _OWN_DIR[app] = tempfile.mkdtemp(prefix="quotewell-")
    return _OWN_DIR[app]


#: Paths written so far; those that are gone are harmless.
_MADE: list[str] = []
_RUNS: set[str] = set()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the session's run folder. Results are lazy, so tables stay until drop_tables(), or until the driver's JVM ends."""
    run = f"{shared_dir(spark)}/quotewell-{spark.sparkContext.applicationId}"
    if run not in _RUNS:
        p = spark._jvm.org.apache.hadoop.fs.Path(run)
        store = p.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(p)
        store.deleteOnExit(p)
        _RUNS.add(run)
    path = f"{run}/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def made() -> int:
    """How many paths have been written and not dropped: a mark for drop_tables()."""
    return len(_MADE)


def drop_tables(spark: SparkSession, since: int = 0, keep: str = "") -> int:
    """Delete what this process has written to the shared folder since a mark, once its results have been read. Returns how many paths."""
    gone = [x for x in _MADE[since:] if x != keep]
    _MADE[since:] = [keep] if keep in _MADE[since:] else []
    for path in gone:
        _delete(spark, path)
    return len(gone)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df once to the shared folder and read it back: the lineage is cut and survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by materialise() once nothing reads them any more."""
    for t in tables:
        for f in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            _delete(t.sparkSession, f)


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def row_key(row_id: Column, text: Column) -> Column:
    """16 bytes that stand for a row's id and text. Rows equal in both share it and are interchangeable."""
    named = F.coalesce(F.concat(F.lit("="), row_id.cast("string"), F.lit(" ")), F.lit("null "))
    return F.unhex(F.md5(F.concat(named, text).cast("binary")))


#: Bytes of texts that Python gets at once.
BATCH_BYTES = 4 << 20


def to_python(df: DataFrame) -> DataFrame:
    """df, with the session's Arrow batches bounded by bytes: rows are whole texts, and by rows alone a batch may be any size."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    return df


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
