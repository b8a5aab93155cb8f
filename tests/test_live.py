"""Sources that ask servers, and stateful event streams."""

import json
import threading
import time
from collections import Counter, defaultdict
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from gridweave.sources import live
from gridweave.sources.tables import KeyedTable
from gridweave.streaming import events as E
from gridweave.streaming import stateful


class Server(ThreadingHTTPServer):
    """/newest and /events of a list; /call answers 429 to every third first try."""

    daemon_threads, request_queue_size = True, 512

    def __init__(self):
        self.events, self.calls, self.lock, self.flying, self.most = [], Counter(), threading.Lock(), 0, 0
        super().__init__(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server_port}"


class Handler(BaseHTTPRequestHandler):
    def log_message(self, *_):
        pass

    def do_GET(self):
        at, s = urlparse(self.path), self.server
        query, status = {k: v[0] for k, v in parse_qs(at.query).items()}, 200
        if at.path == "/newest":
            text = str(len(s.events))
        elif at.path == "/events":
            text = "\n".join(map(json.dumps, s.events[int(query["start"]) : int(query["end"])]))
        else:
            with s.lock:
                s.calls[at.path] += 1
                s.flying += 1
                s.most = max(s.most, s.flying)
                status = 429 if int(at.path.rsplit("/", 1)[1]) % 3 == 0 and s.calls[at.path] == 1 else 200
            time.sleep(0.002)
            with s.lock:
                s.flying -= 1
            text = at.path
        self.send_response(status)
        if status == 429:
            self.send_header("Retry-After", "0")
        self.send_header("Content-Length", str(len(text.encode())))
        self.end_headers()
        self.wfile.write(text.encode())


@pytest.fixture
def server():
    s = Server()
    yield s
    s.shutdown()
    s.server_close()


SCHEMA = "event_id string, event_type string, ts timestamp, curve_name string"


def an_event(i):
    return {"event_id": str(i), "event_type": "CURVE_UPDATE", "ts": f"2025-01-01T{i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}+00:00", "curve_name": f"c{i % 7}"}


def test_live_events_survive_failures(spark, server, tmp_path):
    """A batch that fails after it was written comes again; the keyed table has every event once."""
    server.events = [an_event(i) for i in range(500)]
    log = live.HttpEventLog(server.url, SCHEMA)
    table = KeyedTable(spark, f"file://{tmp_path}/t", spark.createDataFrame([], SCHEMA).schema, ["event_id"], 2).create()
    seen, failing = [], [True]

    def write(batch, _):
        table.insert(batch)
        seen.append(batch.count())
        if failing:
            failing.clear()
            raise OSError("killed")

    start = lambda: E.drain(live.live_events(spark, log, SCHEMA, span=50), write, f"file://{tmp_path}/cp")
    with pytest.raises(Exception, match="killed"):
        start()
    server.events += [an_event(i) for i in range(500, 800)]
    start()  # the failed batch again
    start()
    assert sorted(int(r.event_id) for r in table.read().select("event_id").collect()) == list(range(800))
    before = len(seen)
    assert sum(seen) == 1300
    start()  # nothing is new
    assert sum(seen[before:]) == 0
    assert table.read().where("event_id = '61'").first().ts.isoformat().endswith("00:01:01")


def test_live_events_of_a_trigger_are_bounded(spark, server, tmp_path):
    server.events = [an_event(i) for i in range(150)]
    sizes, began = [], time.monotonic()
    query = live.live_events(spark, live.HttpEventLog(server.url, SCHEMA), SCHEMA, most=100).writeStream.foreachBatch(lambda b, _: sizes.append(b.count())).option("checkpointLocation", f"file://{tmp_path}/cp").trigger(processingTime="0 seconds").start()
    try:
        while sum(sizes) < 400 and time.monotonic() - began < 60:
            time.sleep(0.1)
            if sum(sizes) == 150 and len(server.events) == 150:
                server.events += [an_event(i) for i in range(150, 400)]
    finally:
        query.stop()
    assert [n for n in sizes if n] == [150, 100, 100, 50]


def test_live_catalog_in_pages(spark):
    names = live.live_catalog(spark, lambda: 23, lambda a, b: ((f"curve {k}", k) for k in range(a, b)), "name string, k int", size=5)
    assert names.rdd.getNumPartitions() == 5 and sorted(r.k for r in names.collect()) == list(range(23))


def call(base):
    def send(url, params):
        from urllib.error import HTTPError
        from urllib.request import urlopen

        try:
            with urlopen(f"{base}/{url}", timeout=30) as answer:
                return answer.status, answer.read().decode(), None
        except HTTPError as e:
            return e.code, "", float(e.headers.get("Retry-After") or 0)

    return send


def test_ten_thousand_requests_each_sent_once(spark, server):
    requests = spark.range(10_000).select(F.concat(F.lit("call/"), "id").alias("url"), F.lit(None).cast("map<string,string>").alias("params"))
    began = time.monotonic()
    got = {r.url: r for r in live.send_all(requests, call(server.url), tasks=4, flight=16).collect()}
    assert len(got) == 10_000 and all(r.ok and r.body == f"/{r.url}" for r in got.values())
    assert all(n == (2 if int(k.rsplit("/", 1)[1]) % 3 == 0 else 1) for k, n in server.calls.items()) and len(server.calls) == 10_000
    assert server.most > 4 and time.monotonic() - began < 120


def test_sender_rate_retries_and_errors():
    tries = Counter()

    def send(url, params):
        tries[url] += 1
        if url == "bad":
            raise OSError("down")
        return (503, "", None) if url == "late" and tries[url] < 3 else (404, "none", None) if url == "gone" else (200, url, None)

    began = time.monotonic()
    asked = [("bad", {}), ("late", {}), ("gone", {}), *((f"u{k}", {}) for k in range(20))]
    got = sorted(live.Sender(send, 4, rate=50, retries=2, pause=0.01).run(iter(asked)))
    assert len(got) == 23 and ("bad", 0, "down") in got and ("late", 200, "late") in got and ("gone", 404, "none") in got
    assert tries["bad"] == 3 and tries["late"] == 3 and tries["gone"] == 1 and time.monotonic() - began >= 26 / 50
    assert list(live.Sender(send).run(iter([]))) == []


# ---- state


def put(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps({"event_id": str(i), "event_type": kind, "ts": f"2025-01-01T00:{t // 60:02d}:{t % 60:02d}Z", "curve_name": "c"}) for t, i, kind in events))


def test_batches_by_number_or_age(spark, tmp_path):
    put(tmp_path / "in", "a", [(i, i, "CURVE_UPDATE") for i in range(7)])
    events, got, began = E.read_events(spark, f"file://{tmp_path}/in"), [], time.monotonic()
    query = stateful.batch_events(events, 3, 4.0).writeStream.foreachBatch(lambda b, _: got.extend((r.batch, r.place, r.reason, r.event_id) for r in b.collect())).option("checkpointLocation", f"file://{tmp_path}/cp").trigger(processingTime="100 milliseconds").start()
    try:
        while len(got) < 7 and time.monotonic() - began < 60:
            time.sleep(0.1)
    finally:
        query.stop()
    assert got == [(0, 0, "size", "0"), (0, 1, "size", "1"), (0, 2, "size", "2"), (1, 0, "size", "3"), (1, 1, "size", "4"), (1, 2, "size", "5"), (2, 0, "time", "6")]


def test_open_batches_and_recent_keys_survive_a_restart(spark, tmp_path):
    kinds = "CURVE_UPDATE"
    put(tmp_path / "in", "a", [(i, i, kinds) for i in range(5)])
    batches, passed = [], []
    events = lambda: E.read_events(spark, f"file://{tmp_path}/in", files_per_trigger=1)

    def run():
        E.drain(stateful.batch_events(events(), 3, None, recent=100), lambda b, _: batches.extend((r.batch, r.reason, r.event_id) for r in b.orderBy("batch", "place").collect()), f"file://{tmp_path}/cp1")
        E.drain(stateful.deduplicate_recent(events(), 3, lane=F.lit(0)), lambda b, _: passed.extend(r.event_id for r in b.collect()), f"file://{tmp_path}/cp2")

    run()
    assert batches == [(0, "size", "0"), (0, "size", "1"), (0, "size", "2")] and passed == ["0", "1", "2", "3", "4"]
    # 4 is a repeat within three keys, 0 came five keys ago; as batches remember more, it is a repeat there
    put(tmp_path / "in", "b", [(60, 4, kinds), (61, 0, kinds), (62, 4, kinds), (63, 7, kinds), (64, "off", "DISCONNECTED"), (65, 8, kinds)])
    run()
    assert batches[3:] == [(1, "size", "3"), (1, "size", "4"), (1, "size", "7")] and passed[5:] == ["0", "7", "8"]
    put(tmp_path / "in", "c", [(70, "off", "DISCONNECTED"), (71, "off", "DISCONNECTED")])
    run()
    assert batches[6:] == [(2, "disconnect", "8")]
    assert stateful.deduplicate_recent(events(), 0).columns == events().columns
    with pytest.raises(ValueError):
        stateful.batch_events(events(), 0)


def test_recent_keys_are_least_recently_used():
    recent, order = stateful.Recent(2, []), defaultdict(list)
    for key in "abacbca":
        order[key].append(recent.repeated(key))
    assert order == {"a": [False, True, False], "b": [False, False], "c": [False, True]}


def test_a_lane_is_sorted_by_runs():
    """However many events a micro-batch brings, a run of them is held, and what is merged is read by blocks."""
    events = [((k * 7919 % 1000, k), k) for k in range(1000)]
    for run in (64, 250, 999, 1000, 1001):
        merged = stateful.in_order(iter(events), run, 16)
        assert list(merged) == sorted(events)
    assert list(stateful.in_order([])) == []


def test_a_lane_gives_its_events_out_by_blocks():
    """The first events of a large lane leave the task before the last are batched."""
    processor, taken = stateful.LaneProcessor(None, None, 0), []
    blocks = processor._blocks((k, 0, None, taken.append(k) or b"x") for k in range(3 * stateful.BLOCK))
    assert len(next(blocks)) == stateful.BLOCK and len(taken) == stateful.BLOCK


def test_events_of_any_type_and_lane_pass_unchanged(spark, tmp_path):
    """Whole numbers beyond doubles beside nulls, decimals, fine times, nested values, and a lane that is null."""
    columns = "event_id BIGINT, ts TIMESTAMP, naive TIMESTAMP_NTZ, price DECIMAL(20,4), raw BINARY, tags ARRAY<STRING>, m MAP<STRING,INT>, s STRUCT<a: INT, b: TIMESTAMP>, lane INT"
    spark.sql("""SELECT id * 9007199254740993 AS event_id, timestamp_micros(1700000000000001 + id) AS ts, timestamp_ntz'1400-01-01 00:00:00.000001' AS naive, CAST(id + 0.0001 AS DECIMAL(20,4)) AS price, CAST('x' AS BINARY) AS raw,
        array('a', NULL) AS tags, map('k', int(id)) AS m, named_struct('a', int(NULL), 'b', timestamp'2500-01-01') AS s, int(if(id = 1, NULL, 1)) AS lane FROM range(3) UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL""").coalesce(1).write.parquet(f"{tmp_path}/in")
    events, got = spark.readStream.schema(columns).parquet(f"{tmp_path}/in"), []
    E.drain(stateful.batch_events(events.withColumnRenamed("lane", "l"), 1, None, F.col("l")), lambda b, _: got.extend(tuple(r) for r in b.select("lane", "event_id", "ts", "naive", "price", "raw", "tags", "m", "s", "l").collect()), f"file://{tmp_path}/cp")
    want = [(r[-1], *r) for r in spark.read.schema(columns).parquet(f"{tmp_path}/in").collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == 4
