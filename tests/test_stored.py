"""Stored warehouses: what the layout saves is asserted on plans and files, and results are those of the trial tables."""

import pytest

from quotewell.operators import compare
from quotewell.plans.queries import trial
from quotewell.sources import buckets, readers, schemas, versions

BARS = (("daily-prices", "feed_bars"), ("adj-daily-prices", "feed_adj_bars"), ("vendor-prices", "vendor_bars"))


@pytest.fixture(scope="module")
def w(spark, sf_dir):
    return trial(spark, sf_dir)


@pytest.fixture(scope="module")
def root(w, tmp_path_factory):
    home = str(tmp_path_factory.mktemp("stored"))
    for folder, name in BARS:
        versions.publish(getattr(w, name), f"{home}/processed/{folder}", "date", "stock_id")
    return home


def test_the_newest_day_reads_one_folder(spark, w, root):
    stored = readers.open_warehouse(spark, root)
    assert len(versions.folders(spark, f"{root}/processed/daily-prices")) > 50
    for view in ("feed_v_last_trading_day", "vendor_v_last_trading_day"):
        got = getattr(stored, view)
        assert len({f.rsplit("/", 1)[0] for f in got.inputFiles()}) == 1
        assert got.collect() == getattr(w, view).collect()
    day = versions.read(spark, f"{root}/processed/daily-prices", schemas.PRICE).orderBy("date").limit(1)
    before = stored.feed_v_last_trading_day.first().date
    versions.replace_days(day.drop("year", "month"), f"{root}/processed/daily-prices", schemas.PRICE)
    assert readers.open_warehouse(spark, root).feed_v_last_trading_day.first().date == before


def test_comparisons_of_bucketed_bars_move_no_rows(spark, w, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near = buckets.store_for_comparison(w, str(tmp_path / "cmp"), 3)
        plan = near.returns._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "SortMergeJoin" in plan and "Exchange" not in plan
        rounded = lambda rows: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows), key=str)
        assert near.returns.count() == w.returns.count() > 0
        for query in (compare.cmp_return_agreement, compare.cmp_disagreement_causes, compare.cmp_coverage_by_year, compare.cmp_level_by_year):
            assert rounded(query(near).collect()) == rounded(query(w).collect())
        # another session's catalog knows nothing yet
        spark.sql("DROP DATABASE comparison CASCADE")
        again = buckets.open_for_comparison(w, str(tmp_path / "cmp"), 3)
        assert "Exchange" not in again.returns._jdf.queryExecution().executedPlan().toString() and again.returns.count() == w.returns.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
        spark.sql("DROP DATABASE IF EXISTS comparison CASCADE")
