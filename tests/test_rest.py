"""The API source against a local HTTP server, and the quota that its tasks share."""

import datetime as dt
import json
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from quotewell.sources import rest
from quotewell.sources.quota import Bucket, Quota, QuotaServer
from quotewell.sources.schemas import schema
from quotewell.sources.versions import read, replace_days

SCHEMA = schema("date string, stock_id string, close double, Trading_Volume bigint")


class Api:
    """Serves two rows a day, or a history; `faults` maps a day or ticker to what it answers first."""

    def __init__(self):
        self.calls, self.times, self.faults, self.factor = [], [], {}, 1.0
        api = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                asked = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
                key = asked.get("data_id") or asked.get("start_date") or "table"
                api.calls.append(key)
                api.times.append(time.monotonic())
                fault = api.faults.get(key) or []
                code, body = fault.pop(0) if fault else (200, None)
                if body is None:
                    body = json.dumps({"status": 200, "msg": "", "data": api.rows(asked)})
                self.send_response(code)
                self.end_headers()
                self.wfile.write(body.encode())

            def log_message(self, *_):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_port}/data"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def rows(self, asked):
        if "data_id" in asked:
            return [{"date": f"2024-01-0{k}", "stock_id": asked["data_id"], "close": k} for k in (1, 2, 3) if f"2024-01-0{k}" >= asked.get("start_date", "")]
        day = dt.date.fromisoformat(asked.get("start_date", "2024-01-01"))
        return [] if day.weekday() > 4 else [{"date": str(day), "stock_id": i, "close": self.factor * day.day, "Trading_Volume": 7.0, "other": [1]} for i in ("1101", "2330")]


@pytest.fixture
def api(spark):
    rest.register(spark)
    made = Api()
    yield made
    made.server.shutdown()


def source(spark, api, **options):
    return spark.read.format("market_api").schema(SCHEMA).options(url=api.url, dataset="prices", pause="0.01", quota_pause="0.01", **options)


def test_days_and_pushed_filters(spark, api):
    days = lambda: source(spark, api, mode="day", first="2024-01-01", last="2024-12-31", pushdown="true").load()  # noqa: E731  anew for each query
    got = days().where("date >= '2024-03-01' AND date < '2024-03-05'").collect()
    assert sorted((r.date, r.stock_id, r.close, r.Trading_Volume) for r in got) == [(f"2024-03-0{k}", i, float(k), 7) for k in (1, 4) for i in ("1101", "2330")]
    assert set(api.calls) <= {f"2024-03-0{k}" for k in range(1, 6)}
    api.calls.clear()
    assert days().where("date IN ('2024-05-01', '2024-05-02') AND stock_id = '2330'").count() == 2
    assert Counter(api.calls) == {"2024-05-01": 1, "2024-05-02": 1}
    assert days().where("date = 'never'").count() == 0


def test_tickers_and_a_whole_table(spark, api):
    rows = lambda: source(spark, api, mode="ticker", tickers="1101,2330,9999", first="2024-01-02", pushdown="true").load()
    assert rows().where("stock_id = '2330'").count() == 2 and api.calls == ["2330"]
    assert rows().groupBy("stock_id").count().count() == 3
    assert source(spark, api, mode="table").load().count() == 2


def test_without_pushdown_a_frame_may_be_used_again(spark, api):
    rows = source(spark, api, mode="ticker", tickers="1101,2330").load()
    assert rows.where("stock_id = '2330'").count() == 3 and rows.count() == 6


def test_failures(spark, api):
    api.faults = {"2024-01-02": [(500, ""), (200, "{torn"), (429, ""), (402, "")]}
    assert source(spark, api, first="2024-01-02", last="2024-01-02").load().count() == 2 and len(api.calls) == 5
    api.faults = {"2024-01-02": [(500, "")] * 9}
    with pytest.raises(Exception, match="HTTP 500"):
        source(spark, api, first="2024-01-02", last="2024-01-02", attempts="2").load().count()
    api.faults = {"2024-01-03": [(400, "what?")], "2024-01-04": [(200, json.dumps({"status": 400, "msg": "no such dataset"}))]}
    for day, said in (("2024-01-03", "HTTP 400"), ("2024-01-04", "no such dataset")):
        api.calls.clear()
        with pytest.raises(Exception, match=said):
            source(spark, api, first=day, last=day).load().count()
        assert api.calls == [day]


def test_a_partition_read_again_gives_the_same_rows(api):
    reader = rest.MarketApi({"url": api.url, "dataset": "prices", "first": "2024-01-02", "last": "2024-01-03"}).reader(SCHEMA)
    parts = reader.partitions()
    assert [list(reader.read(p)) for p in parts] == [list(reader.read(p)) for p in parts] and len(parts) == 2


def test_a_stream_goes_on_where_it_stopped(spark, api, tmp_path):
    bars = schema("date date, stock_id string, close double")

    def follow(last):
        rows = spark.readStream.format("market_api").schema(bars).options(url=api.url, dataset="prices", first="2024-01-01", last=last).load()
        put = lambda batch, _: replace_days(batch, f"{tmp_path}/bars", bars) if not batch.isEmpty() else None
        rows.writeStream.foreachBatch(put).option("checkpointLocation", f"{tmp_path}/mark").trigger(availableNow=True).start().awaitTermination()
        return set(api.calls), read(spark, f"{tmp_path}/bars", bars).count()

    assert follow("2024-01-03") == ({"2024-01-01", "2024-01-02", "2024-01-03"}, 6)
    api.calls.clear()
    assert follow("2024-01-05") == ({"2024-01-04", "2024-01-05"}, 10)


def test_tasks_share_a_quota(spark, api):
    rate, burst = 20.0, 4
    with QuotaServer(rate, burst) as quota:
        assert source(spark, api, first="2024-01-01", last="2024-02-09", quota=quota.address).load().repartition(8).count() == 60
    assert len(api.times) == 40
    times = sorted(api.times)
    for i in range(len(times)):
        for j in range(i, len(times)):
            assert j - i + 1 <= burst + rate * (times[j] - times[i] + 0.15)  # a request takes a moment to arrive


def test_a_lost_task_returns_its_lease():
    now = [0.0]
    bucket = Bucket(1.0, 5, hold=10.0, clock=lambda: now[0])
    assert bucket.reserve()[0] is None
    now[0] = 100.0
    lost, got, _ = bucket.reserve(3)
    held, _, _ = bucket.reserve(9)
    assert got == 3 and bucket.reserve()[0] is None
    assert bucket.spend(held) and bucket.spend(held) and not bucket.spend(held)
    now[0] = 109.9
    assert bucket.spend(lost)  # 2 left
    now[0] = 110.0
    assert not bucket.spend(lost)
    lease, got, _ = bucket.reserve(99)
    assert got == 4  # the two came back, beside the two that the bucket could hold while they were reserved
    bucket.drain()
    assert not bucket.spend(lease) and bucket.reserve()[2] == pytest.approx(1.0)


def test_reservations_count_against_the_burst():
    now = [0.0]
    bucket = Bucket(1.0, 3, hold=50.0, clock=lambda: now[0])
    now[0] = 3.0
    lease, _, _ = bucket.reserve(3)
    now[0] = 40.0
    assert bucket.reserve()[0] is None  # else six could be sent at once
    bucket.release(lease)
    assert bucket.reserve(9)[1] == 3
    with QuotaServer(50.0, 2) as server:
        mine = Quota(server.address, at_once=2)
        for _ in range(4):
            mine.turn()
        mine.close()
        with pytest.raises(Exception, match="404"):
            Quota(server.address.rsplit("/", 2)[0] + "/x/").turn()
