"""Sessions followed as a stream: late, corrected, missing and closed ones, with a restart from the checkpoint before every step."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException

from quotewell.sources.schemas import RAW_PRICE
from quotewell.streaming import watch
from quotewell.streaming.daily import type_prices

FIRST = dt.date(2026, 8, 3)
LANDED = "dataset string, date date, n_rows bigint, digest bigint, no bigint"
CONF = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.shuffle.partitions": "2"}


def day(no):
    return FIRST + dt.timedelta(no)


@pytest.fixture(scope="module", autouse=True)
def rocks(spark):
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture
def follow(spark, tmp_path):
    """Land rows (no, n_rows, digest), run the stream from its checkpoint to its end, and return the statuses that are new."""
    told = set()

    def run(*rows, sessions=(), most=30, fail=False):
        if sessions:
            spark.createDataFrame([(day(n), n) for n in sessions], watch.SESSION).coalesce(1).write.mode("append").parquet(f"{tmp_path}/sessions")
        spark.createDataFrame([("bars", day(no), n, d, no) for no, n, d in rows], LANDED).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landed")
        streams = (spark.readStream.schema(s).parquet(f"{tmp_path}/{name}") for s, name in ((LANDED, "landed"), (watch.SESSION, "sessions")))
        query = watch.watch_sessions(*streams, ("bars",), f"{tmp_path}/told", f"{tmp_path}/mark", most=most)
        if fail:
            with pytest.raises(StreamingQueryException, match="run a backfill"):
                query.awaitTermination()
            return None
        query.awaitTermination()
        everything = {(r.date, r.status, r.n_rows, r.corrections) for r in spark.read.parquet(f"{tmp_path}/told").collect()}
        new = sorted(((d - FIRST).days, s, n, k) for d, s, n, k in everything - told)
        told.update(everything)
        return new

    return run


def test_a_session_from_open_to_final(follow):
    assert follow((1, 5, 11), sessions=range(1, 12)) == [(1, "open", 5, 0)]
    assert follow((1, 5, 11)) == []  # the same rows again
    assert follow((1, 6, 12)) == [(1, "corrected", 6, 1)]
    assert follow((2, 5, 21), (3, 5, 31)) == [(2, "open", 5, 0), (3, "open", 5, 0)]
    assert follow((4, 5, 41)) == [(1, "final", 6, 1), (4, "open", 5, 0)]
    assert follow((1, 7, 13)) == [(1, "late", 7, 2)]
    assert follow((1, 7, 13)) == []


def test_gaps_are_told_filled_and_closed(follow):
    assert follow((1, 5, 11), sessions=range(1, 12)) == [(1, "open", 5, 0)]
    assert follow((3, 5, 31), (4, 0, None)) == [(2, "gap", None, 0), (3, "open", 5, 0)]
    assert follow((2, 4, 21)) == [(2, "filled", 4, 0)]
    assert follow((6, 5, 61)) == [(1, "final", 5, 0), (2, "final", 4, 0), (3, "final", 5, 0), (4, "closed", 0, 0), (5, "gap", None, 0), (6, "open", 5, 0)]
    assert follow((5, 0, None)) == [(5, "closed", 0, 0)]
    assert follow((4, 9, 42)) == [(4, "filled", 9, 0)]  # it was open after all
    assert follow((6, 0, None)) == []  # an empty answer takes nothing away


def test_a_gap_that_is_filled_after_its_window_is_final_at_once(follow):
    follow((1, 5, 11), sessions=range(1, 12))
    assert (2, "gap", None, 0) in follow((8, 5, 81))
    assert follow((2, 5, 21)) == [(2, "filled", 5, 0), (2, "final", 5, 0)]


def test_too_far_behind_stops_and_goes_on_when_allowed(follow):
    assert follow((1, 5, 11), sessions=range(1, 50)) == [(1, "open", 5, 0)]
    assert follow((40, 5, 401), fail=True) is None
    assert follow(fail=True) is None  # nothing of it was kept, and it stops again
    got = follow(most=100)
    assert [x[0] for x in got if x[1] == "gap"] == list(range(2, 40)) and {x for x in got if x[1] != "gap"} == {(1, "final", 5, 0), (40, "open", 5, 0)}


def test_landings_count_and_digest_rows(spark):
    raw = [("2026-08-03", "1", 10, 1, 1.0, 2.0, 0.5, 1.5, 0.0, 3), ("2026-08-03", "2", 10, 1, 1.0, 2.0, 0.5, None, 0.0, 3), ("2026-08-04", "1", 10, 1, 1.0, 2.0, 0.5, 1.5, 0.0, 3), (None, "1", 1, 1, 1.0, 1.0, 1.0, 1.0, 0.0, 1)]
    told = lambda rows: {r.date: (r.n_rows, r.digest) for r in watch.landings(type_prices(spark.createDataFrame(rows, RAW_PRICE), "market"), "bars").collect()}
    once = told(raw)
    assert {k.day: n for k, (n, _) in once.items()} == {3: 2, 4: 1}
    assert told(list(reversed(raw))) == once
    assert told([*raw, raw[0]])[FIRST] != once[FIRST]  # a repeated row is another content
    assert told([]) == {}
