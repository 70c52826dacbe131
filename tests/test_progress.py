"""The state of backfills: append, newest attempts, resumption, compaction under concurrent appends, and plans without literal lists."""

import datetime as dt
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from quotewell.plans.queries import trial
from quotewell.sources import progress, versions

T0 = dt.datetime(2026, 8, 3)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def rows(spark, *found):
    return spark.createDataFrame([("adj", i, n, at(m)) for i, n, m in found], progress.ATTEMPT)


def keys(spark, *ids):
    return spark.createDataFrame([("adj", i) for i in ids], "dataset string, stock_id string")


def reasons(df):
    return {r.stock_id: r.reason for r in df.collect()}


def test_what_is_left_to_fetch(spark):
    log = rows(spark, ("done", 5, 1), ("failed", -1, 1), ("mended", -1, 1), ("mended", 7, 2), ("broke", 7, 1), ("broke", -1, 2), ("nothing", 0, 1), ("lost", 9, 1), ("tie", -1, 1), ("tie", 3, 1), ("unknown", None, 1))
    wanted = keys(spark, "done", "done", "failed", "mended", "broke", "nothing", "lost", "tie", "unknown", "never", None)
    held = keys(spark, "done", "done", "mended", "broke", "tie", "stranger", None)
    assert reasons(progress.plan(wanted, held, log)) == {"failed": "retry", "broke": "retry", "unknown": "retry", "lost": "lost", "never": "new"}
    assert reasons(progress.plan(wanted.limit(0), held, log)) == {}
    assert reasons(progress.plan(keys(spark, "a"), held.limit(0), log.limit(0))) == {"a": "new"}
    clash = wanted.withColumn("held", F.lit(1)).withColumn("n_rows", F.lit(2)).withColumn("reason", F.lit("x"))
    assert len(reasons(progress.plan(clash, held, log))) == 5


def test_state_is_appended_read_and_folded(spark, tmp_path):
    root = str(tmp_path / "state")
    assert progress.attempts(spark, root).isEmpty() and progress.compact(spark, root) is None
    progress.record(rows(spark, ("1", -1, 1), ("2", 4, 1), (None, 4, 1)), root)
    progress.record(rows(spark, ("1", 6, 2)), root)
    assert progress.attempts(spark, root).count() == 3 and len(versions.folders(spark, root)) == 2
    before = sorted(map(tuple, progress.newest(progress.attempts(spark, root)).collect()))
    progress.compact(spark, root)
    assert sorted(map(tuple, progress.attempts(spark, root).collect())) == before == [("adj", "1", 6, at(2)), ("adj", "2", 4, at(1))]


def test_an_append_during_compaction_is_kept(spark, tmp_path, monkeypatch):
    root, publish = str(tmp_path / "state"), versions.publish
    progress.record(rows(spark, ("1", -1, 1)), root)

    def late(df, *args, **kwargs):
        monkeypatch.setattr(versions, "publish", publish)
        progress.record(rows(spark, ("1", 8, 5)), root)
        return publish(df, *args, **kwargs)

    monkeypatch.setattr(versions, "publish", late)
    progress.compact(spark, root)
    assert [tuple(r) for r in progress.attempts(spark, root).collect()] == [("adj", "1", 8, at(5))]


def explained(df):
    with redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()


def test_many_ids_need_no_list(spark, tmp_path):
    root, n = str(tmp_path / "state"), 300_000
    ids = spark.range(n).select(F.lit("adj").alias("dataset"), F.col("id").cast("string").alias("stock_id"))
    progress.record(ids.withColumn("n_rows", F.when(F.col("stock_id").endswith("7"), -1).otherwise(1)).withColumn("attempted_at", F.lit(T0)), root)
    left = progress.plan(ids, ids, progress.attempts(spark, root))
    assert left.groupBy("reason").count().collect() == [("retry", n // 10)]
    assert len(explained(left)) < 20_000


@pytest.mark.parametrize("name", ["cmp_coverage_by_year", "survivors_and_all", "cmp_stale_market_snapshots"])
def test_distinct_counts_expand_no_rows(spark, sf_dir, name):
    from quotewell.plans.queries import all_queries

    assert "Expand" not in explained(all_queries()[name](spark, sf_dir)), trial
