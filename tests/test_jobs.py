"""Jobs end to end on a small warehouse."""

import datetime as dt

import pyarrow as pa
import pytest
from pyarrow import feather

from quotewell.operators import between, planning
from quotewell.plans import jobs
from quotewell.sources import readers, schemas

D = dt.date


def raw(spark, *rows):
    return spark.createDataFrame([(d, i, v, 10, 1.0, 2.0, 0.5, c, 0.0, 3) for d, i, c, v in rows], schemas.RAW_PRICE)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    home = str(tmp_path_factory.mktemp("warehouse"))
    days = ("2026-08-17", "2026-08-18", "2026-08-20")
    for kind, factor in (("daily", 1.0), ("adj", 0.5)):
        raw(spark, *((d, "2330", 10.0 * factor, 5) for d in days)).write.parquet(f"{home}/raw/{kind}-ticker")
        raw(spark, ("2026-08-20", "2330", 99.0, 5), ("2026-08-20", "1101", 7.0, 5)).write.parquet(f"{home}/raw/{kind}-market")
    table = lambda rows, contract, name: spark.createDataFrame(rows, contract).write.parquet(f"{home}/raw/{name}")
    table([("Chips", "2330", "T", "main", "2020-01-01"), ("Index", "ALL", "All", None, "None")], schemas.RAW_STOCK_INFO, "stock-info")
    table([("2330", "Chips", "Foundry", "2021-01-01")], schemas.RAW_INDUSTRY, "industry")
    table([("2001-01-01", "1101", "Gone")], schemas.RAW_DELISTING, "delisting")
    table([("2026-08-17",), ("2026-08-18",), ("2026-08-19",), ("2026-08-20",), ("None",)], schemas.schema("date string"), "trading-dates")
    return home


def test_rebuild_and_read(spark, root):
    done = jobs.run_stages(spark, f"{root}/logs/feed", "weekly", [(name, lambda name=name: jobs.rebuild_prices(spark, root, name)) for name in jobs.PRICES] + [("dimensions", lambda: jobs.rebuild_dimensions(spark, root, {"Chips": "Semis"}, ("Index",)))])
    assert done == [*jobs.PRICES, "dimensions"]
    w = readers.open_warehouse(spark, root)
    got = {(r.date, r.stock_id): (r.close, r.adj_close, r.adj_factor) for r in w.feed_v_prices_combined.collect()}
    assert got[D(2026, 8, 20), "2330"] == (99.0, 5.0, 5.0 / 99.0) and got[D(2026, 8, 18), "2330"] == (10.0, 5.0, 0.5) and len(got) == 4
    assert [r.date for r in w.feed_v_missing_trading_days.collect()] == [D(2026, 8, 19)]
    assert {r.stock_id: r.is_delisted for r in w.feed_v_securities_all.collect()} == {"2330": False, "ALL": False, "1101": True}
    assert [r.status for r in w.feed_v_ingestion_runs.collect()] == ["success"]
    assert sorted(r.date for r in readers.held_dates(w.feed_v_daily_prices).collect()) == [D(2026, 8, 17), D(2026, 8, 18), D(2026, 8, 20)]
    ids = jobs.universe(w.feed_v_stock_info_latest, w.feed_v_delisted_securities, with_indices=False)
    assert {(r.stock_id, r.is_delisted) for r in ids.collect()} == {("2330", False), ("1101", True)}
    targets = planning.daily_targets(w.feed_v_trading_calendar, w.feed_v_daily_prices, w.feed_v_known_empty_days, D(2026, 8, 20), revision=1)
    assert {(r.date.day, r.reason) for r in targets.collect()} == {(19, "gap"), (20, "revision")}


def test_failures_stop_and_are_told(spark, root, tmp_path):
    ran = []
    with pytest.raises(ValueError, match="no raw rows"):
        jobs.run_stages(spark, f"{tmp_path}/logs", "x", [("a", lambda: ran.append("a")), ("b", lambda: jobs.rebuild_prices(spark, str(tmp_path), "daily-prices")), ("c", lambda: ran.append("c"))])
    assert ran == ["a"] and readers.run_log(spark, f"{tmp_path}/logs/*.jsonl").first().status == "failed"


def test_backfill_is_resumed_and_losses_are_found(spark, tmp_path):
    path = f"{tmp_path}/state.json"
    assert jobs.load_checkpoint(spark, path) == set()
    jobs.save_checkpoint(spark, path, {"1", "2"})
    wanted, held = (spark.createDataFrame([(x,) for x in ids], "stock_id string") for ids in ("123", "1"))
    todo, lost = jobs.pending(wanted, held, jobs.load_checkpoint(spark, path))
    assert [r.stock_id for r in todo.collect()] == ["3"] and [r.stock_id for r in lost.collect()] == ["2"]
    assert jobs.pending(wanted, held, set())[1].isEmpty()


def test_templates(spark):
    rows = spark.createDataFrame([("a", "1", 2.0), ("a", "1", None), ("b", "1", 1.0), ("b", "2", 1.0), ("c", "1", None)], "source_file string, stock_id string, close double")
    assert {r.source_file: r.accepted for r in jobs.accept_template(rows).collect()} == {"a": True, "b": False, "c": False}
    books = spark.createDataFrame([("a", 5), ("b", 9), ("c", None)], "source_file string, declared_rows long")
    assert jobs.longest_history(books).first().source_file == "b"


def test_reviews_in_force(spark):
    reviews = spark.createDataFrame([("A", D(2024, 1, 2), D(2024, 1, 4)), ("B", D(2024, 1, 4), None), ("C", D(2030, 1, 1), None)], "stock_id string, effective_date date, next_effective_date date")
    days = spark.createDataFrame([(D(2024, 1, d),) for d in (1, 2, 3, 5, 8)], "date date")
    assert [r.stock_id for r in between.effective_on(reviews, "2024-01-03").collect()] == ["A"]
    got = {(r.stock_id, r.date.day) for r in between.effective_by_session(reviews, days).collect()}
    assert got == {("A", 2), ("A", 3), ("B", 5), ("B", 8)}


def test_feather(spark, tmp_path):
    feather.write_feather(pa.table({"date": pa.array([D(2024, 1, 2)]), "stock_id": ["0050"]}), str(tmp_path / "x.feather"))
    got = readers.feather(spark, str(tmp_path / "x.feather"), schemas.schema("stock_id string, date date, open double")).first()
    assert tuple(got) == ("0050", D(2024, 1, 2), None)
