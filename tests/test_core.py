import datetime as dt
import json
from collections import Counter
from pathlib import Path

import pytest
import xxhash
from pyspark.sql import functions as F

from gridweave import queries as core_queries
from gridweave.functions import scalars as S
from gridweave.functions.hashing import signed_xxh3, xxh3_64
from gridweave.operators import catalog as C
from gridweave.operators import curation as U
from gridweave.plans import pipeline as P
from gridweave.plans import requests as R
from gridweave.schemas import curated_schema, queue_schema
from gridweave.sources import responses as X
from gridweave.sources.tables import KeyedTable, merge, resolve_mode
from gridweave.streaming import events as E

D = dt.datetime
FOLDER = Path("/root/testdata/sf0.001")


def values(spark, column, texts, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_durations(spark):
    texts = ["PT1H", "PT15M", "P1D", "P1W", "P1M", "P1Y", "P1DT2H30M", "", "NONE", None, " pt5s ", "PT0.5S", "-P1D"]
    assert values(spark, S.iso_duration_seconds, texts) == [3600, 900, 86400, 604800, 2592000, 31536000, 95400, 0, 0, 0, 5, 0, 0]


def test_units(spark):
    texts = ["MWh", "MWh/h", "EUR/MWh", "a/b/c", None, ""]
    assert values(spark, S.unit_of, texts) == ["MWh", "MWh", "EUR", "a", None, None]
    assert values(spark, S.denominator_of, texts) == [None, "h", "MWh", "c", None, None]


def test_time_texts(spark):
    texts = ["2025-01-01T00:00Z", "2025-07-01T12:00+02:00", "2025-07-01 12:00:30-05:30", "2025-01-01", "x", None]
    assert values(spark, S.normal_time_text, texts)[:2] == ["2025-01-01T00:00:00+00:00", "2025-07-01T12:00:00+02:00"]
    assert values(spark, S.offset_seconds, texts) == [0, 7200, -19800, 0, 0, None]
    assert values(spark, S.utc_time, texts) == [D(2025, 1, 1), D(2025, 7, 1, 10), D(2025, 7, 1, 17, 30, 30), D(2025, 1, 1), None, None]


def test_localize_gap_overlap_and_gas_day(spark):
    rows = [(0, "2025-03-30T02:30", "CET"), (1, "2025-10-26T02:30", "CET"), (2, "2025-07-01T12:00", "CET"), (3, "2025-07-01T12:00+02:00", "CET"), (4, "2025-07-01", "Europe/Gas_Day"), (5, "2025-01-01", None), (6, None, "CET"), (7, "2025-01-01", "")]
    df = spark.createDataFrame(rows, "i int, t string, z string")
    got = {r.i: (r.u, r.o) for r in S.localize(df, "t", "z", "u", "o").collect()}
    assert got == {0: (None, None), 1: (D(2025, 10, 26, 0, 30), 3600), 2: (D(2025, 7, 1, 10), 3600), 3: (D(2025, 7, 1, 10), 7200), 4: (D(2025, 7, 1, 4), 3600), 5: (D(2025, 1, 1), 0), 6: (None, None), 7: (D(2025, 1, 1), 0)}


def test_period_ends(spark):
    day = dt.date(2025, 1, 31)
    df = spark.createDataFrame([(k, day) for k in ("day", "Week", "weekend", " month ", "quarter", "season", "year", "?", None)], "k string, d date")
    ends = [r[0] for r in df.select(S.ohlc_period_end(F.col("d"), F.col("k"))).collect()]
    assert ends == [dt.date(2025, 2, 1), dt.date(2025, 2, 7), dt.date(2025, 2, 2), dt.date(2025, 2, 28), dt.date(2025, 4, 30), dt.date(2025, 7, 31), dt.date(2026, 1, 31), day, day]


def test_hash_is_xxh3(spark):
    texts = ["test", "", None, "Ä", "test"]
    assert values(spark, xxh3_64, texts) == [signed_xxh3(t) for t in texts]
    assert signed_xxh3("test") == xxhash.xxh3_64_intdigest("test") - (1 << 64)


def test_names(spark):
    df = spark.createDataFrame([("ACTUAL", "TIMESERIES", ["Power ", "Wind/Onshore", "x"]), ("FORECAST", "INSTANCE", None), (None, "OHLC", ["--"])], "d string, t string, c array<string>")
    assert [r[0] for r in df.select(S.table_category(F.col("d"), F.col("t"), F.col("c"), "raw")).collect()] == ["raw_actual_timeseries_power_wind_onshore", "raw_forecast_instance", "raw_none_ohlc"]


def body(kind, data, **more):
    return json.dumps({"curve": {"name": f"c {kind}", "curve_type": kind, "data_type": "ACTUAL"}, "resolution": {"frequency": "PT1H", "timezone": "CET"}, "unit": "MWh/h", "data": data} | more)


def curated(spark, *bodies, catalog=None, **limits):
    raw = spark.createDataFrame([(True, b) for b in bodies], "ok boolean, body string")
    return U.curate(U.parse_responses(raw, ok="ok"), catalog, **limits)


def test_curate_every_kind(spark):
    series = body("TIMESERIES", [{"d": f"2025-01-01T{h:02}:00:00+01:00", "v": h * 10.0} for h in range(3)])
    scenario = body("SCENARIO_TIMESERIES", [{"d": "2025-01-01T00:00", "s": [1.0, 2.0, 3.0]}], scenario_names=["a", "b"])
    instance = body("INSTANCE", [{"d": "2025-01-01T00:00", "v": 5.0}], instance={"issued": "2025-01-01T00:00Z", "tag": "ec", "created": "2025-01-01T01:00Z", "modified": None})
    period = body("PERIOD", [{"begin": "2025-01-01T00:00", "end": "2025-01-02T00:00", "v": 1.5, "capacity": 9.0}], resolution={"timezone": "CET"})
    ohlc = body("OHLC", [{"open": 1.0, "close": 2.0, "product": {"traded_at": "2025-01-05", "delivery": "2025-02-01", "period": "month", "front": 1}}])
    rows = curated(spark, series, scenario, instance, period, ohlc, "not json")
    assert rows.schema.names == curated_schema().names
    by = {}
    for r in rows.collect():
        by.setdefault(r.curve_type, []).append(r)
    assert sorted(r.value for r in by["TIMESERIES"]) == [0.0, 10.0, 20.0]
    first = min(by["TIMESERIES"], key=lambda r: r.from_timestamp)
    assert (first.from_timestamp, first.to_timestamp, first.from_utc_offset, first.resolution_frequency, first.unit, first.denominator) == (D(2024, 12, 31, 23), D(2025, 1, 1), 3600, 3600, "MWh", "h")
    assert sorted((r.scenario_name, r.value) for r in by["SCENARIO_TIMESERIES"]) == [("a", 1.0), ("b", 2.0)]
    assert len({r.run_hash for r in by["SCENARIO_TIMESERIES"]}) == 2
    assert by["INSTANCE"][0].instance_tag == "ec" and by["INSTANCE"][0].instance_issued == D(2025, 1, 1)
    p = by["PERIOD"][0]
    assert (p.capacity, p.resolution_frequency, p.to_timestamp) == (9.0, 86400, D(2025, 1, 1, 23))
    o = by["OHLC"][0]
    # the declared frequency decides the far end
    assert (o.value, o.scenario_name, o.from_timestamp, o.traded_at, o.front) == (2.0, "front_1", D(2025, 1, 31, 23), D(2025, 1, 5), 1)
    want = json.dumps({"curve_name": "c TIMESERIES", "instance_created": "", "instance_modified": "", "instance_tag": "", "unit": "MWh", "denominator": "h"}, separators=(",", ":"))
    assert first.run_hash == signed_xxh3(want) and first.curve_id == signed_xxh3("c TIMESERIES")


def test_curate_range_defaults_and_missing(spark):
    data = [{"d": f"2025-01-01T{h:02}:00Z", "v": float(h)} for h in range(10)] + [{"d": None, "v": 1.0}, {"d": "2025-01-01T00:00Z", "v": None}]
    catalog = spark.createDataFrame([("c TIMESERIES", "X", None, None, None), ("c TIMESERIES", None, "y", None, None)], "name string, unit string, denominator string, frequency bigint, timezone string")
    rows = curated(spark, body("TIMESERIES", data, unit=None), catalog=catalog, begin="2025-01-01T02:00Z", end="2025-01-01T05:00Z").collect()
    assert len(rows) == 3 and {(r.unit, r.denominator) for r in rows} == {("X", "y")}
    assert curated(spark, body("TIMESERIES", [])).count() == 0


def test_only_undeclared_rows_are_dealt_by_curve(spark):
    """The same rows as through one window, with declared and undeclared responses of one curve; no window above the declared ones."""
    data = [{"d": f"2025-01-01T0{h}:00Z", "v": float(h)} for h in range(5)]
    bodies = [(body("TIMESERIES", data),), (json.dumps(json.loads(body("TIMESERIES", [{"d": f"2025-02-01T00:{m:02d}Z", "v": 1.0} for m in (0, 15, 30)])) | {"resolution": None}),)]
    flat = U.flatten(U.parse_responses(spark.createDataFrame(bodies, "body string")))
    one, two = U.bound_intervals(U.explode_observations(flat)), U.observations(flat)
    rows = lambda df: sorted(map(str, df.select(*sorted(one.columns)).collect()))
    assert sorted(one.columns) == sorted(two.columns) and rows(one) == rows(two) and len(rows(one)) == 8
    assert {r.resolution_frequency for r in two.collect()} == {3600, 900}
    plan = U.bound_intervals(U.explode_observations(flat), declared=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_infer_frequency(spark):
    data = [{"d": f"2025-01-01T{h:02}:00Z", "v": 1.0} for h in (0, 1, 3)]
    rows = curated(spark, body("TIMESERIES", data, resolution=None)).orderBy("from_timestamp").collect()
    assert [r.resolution_frequency for r in rows] == [3600, 7200, 7200]
    assert all(r.to_timestamp == r.from_timestamp for r in rows)


def test_conform(spark):
    df = spark.createDataFrame([("a", "1.5", 7, [("x", 1)]), (None, "2", 8, [])], "curve_name string, value string, odd int, curve_categories array<struct<a:string,b:int>>")
    out = U.conform(df.drop("curve_categories"))
    assert out.schema.names == curated_schema().names and [(r.curve_name, r.value) for r in out.collect()] == [("a", 1.5)]
    assert U.unexpected_columns(df) == ["odd"]


@pytest.fixture(scope="module")
def curves(spark):
    docs = [
        {"name": "DE Wind Power Production MWh/h H Actual", "area": "DE", "curve_type": "TIMESERIES", "data_type": "ACTUAL", "unit": "MWh/h", "categories": ["Wind Power", "Production"], "resolution": {"frequency": "PT1H", "timezone": "CET"}},
        {"name": "FR Wind Power Production Forecast", "area": "FR", "curve_type": "INSTANCE", "data_type": "FORECAST", "unit": "MWh/h", "categories": ["Wind", "Power"], "place": {"key": "p", "area": "FR", "fuels": ["gas"]}},
        {"name": "UK Price Spot", "area": "UK", "curve_type": "TIMESERIES", "data_type": "ACTUAL", "unit": "GBP/MWh", "categories": ["Price Spot"], "access": {"by": "me", "package": "all"}},
        {"name": "US Price", "area": " ", "curve_type": None, "data_type": "none", "unit": "USD/bbl", "categories": ["Price", None]},
    ]
    raw = spark.createDataFrame([(json.dumps(x),) for x in docs], "j string")
    return C.parse_curves(raw, "j").cache()


def names(df):
    return sorted(r[0][:2] for r in df.select("name").collect())


def test_catalog_search(curves):
    assert names(C.search(curves, "*wind*")) == ["DE", "FR"]
    assert names(C.search(curves, ["price", "DE?wind*"])) == ["DE", "UK", "US"]
    assert names(C.search(curves, "US Price")) == ["US"]
    assert names(C.search(curves, categories=["Wind", "Power"])) == ["FR"]
    assert names(C.search(curves, frequency="", curve_type="instance")) == ["FR"]
    assert names(C.search(curves, place_area="FR", place_fuel=["gas", "oil"])) == ["FR"]
    assert names(C.search(curves, access_by="me")) == ["UK"]
    assert names(C.preset_curves(curves)) == ["DE", "UK"]
    with pytest.raises(KeyError):
        C.search(curves, curve_type="WRONG")
    us = curves.where("name = 'US Price'").first()
    assert (us.area, us.curve_type, us.data_type, us.categories) == (None, "TIMESERIES", "NORMAL", ["Price"])
    assert C.catalog_table(curves).count() == 4


def test_scope(curves):
    C.check_scope(curves, ["forecast_instance_wind_power"], ["UK Price Spot", str(signed_xxh3("US Price"))])
    with pytest.raises(ValueError):
        C.check_scope(curves, ["nothing"])
    with pytest.raises(ValueError):
        C.check_scope(curves, None, ["nobody"])


def test_request_windows(spark):
    rows = [("TIMESERIES", "PT1H", D(2025, 1, 31), D(2025, 4, 10)), ("PERIOD", "P1D", D(2024, 1, 1), D(2025, 6, 1)), ("INSTANCE", "PT1H", D(2025, 1, 1), D(2025, 6, 1)), ("OHLC", None, D(2025, 1, 1), D(2025, 1, 1))]
    df = spark.createDataFrame(rows, "curve_type string, frequency string, begin timestamp_ntz, end timestamp_ntz")
    got = {}
    for r in R.fan_out_windows(df).orderBy("begin").collect():
        got.setdefault(r.curve_type, []).append((r.begin, r.end))
    assert got["TIMESERIES"] == [(D(2025, 1, 31), D(2025, 2, 28)), (D(2025, 2, 28), D(2025, 3, 31)), (D(2025, 3, 31), D(2025, 4, 10))]
    assert got["PERIOD"] == [(D(2024, 1, 1), D(2025, 1, 1)), (D(2025, 1, 1), D(2025, 6, 1))]
    assert len(got["INSTANCE"]) == len(got["OHLC"]) == 1


def test_request_variants_and_queue(curves):
    routed = C.with_routes(curves)
    assert R.variants(routed).count() == 7
    begin, end = F.lit("2025-01-01").cast("timestamp"), F.lit("2025-01-02").cast("timestamp")
    rows = R.queue_rows(routed, begin, end, "UPSERT", end)
    assert rows.columns == queue_schema().names
    ids = {r.request_id for r in rows.collect()}
    assert "UK Price Spot|EUR/MWh|2025-01-01T00:00:00+00:00|2025-01-02T00:00:00+00:00" in ids and len(ids) == 7


def test_instances(spark):
    requests = spark.createDataFrame([("a", "INSTANCE", D(2025, 1, 1), D(2025, 1, 3)), ("b", "INSTANCE_PERIOD", D(2025, 1, 1), D(2025, 1, 3))], "curve_name string, curve_type string, issued_earliest timestamp_ntz, issued_latest timestamp_ntz")
    issues = [(c, D(2025, 1, d, h), "t") for c in "ab" for d in (1, 2, 9) for h in (0, 1, 5)]
    instances = spark.createDataFrame(issues, "curve_name string, issued timestamp_ntz, tag string")
    out = R.fan_out_instances(requests, instances)
    assert out.where("curve_name = 'a'").count() == 6
    assert {(r.issued_earliest.day, r.issued_earliest.hour) for r in out.where("curve_name = 'b'").collect()} == {(1, 0), (1, 4), (2, 0), (2, 4)}


def test_urls(spark):
    row = ("A/B c", "INSTANCE", False, D(2025, 1, 1), ["EC"], None, None, "MWh", "PT1H", "CET", None, None, 25)
    df = spark.createDataFrame([row], "name string, curve_type string, ensembles boolean, issued_at timestamp_ntz, tags array<string>, begin timestamp_ntz, end timestamp_ntz, unit string, frequency string, timezone string, issued_earliest timestamp_ntz, issued_latest timestamp_ntz, page_limit int")
    r = df.select(R.url_path(df).alias("u"), R.parameters(df).alias("p")).first()
    assert r.u == "instances/A%2FB%20c/get/2025-01-01%2000%3A00%3A00%2B00%3A00/ec/"
    assert r.p == {"unit": "MWh", "frequency": "PT1H", "timezone": "CET"}


def test_merge_modes(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (None, "b", 1)], "id int, owner string, v int")
    source = spark.createDataFrame([(2, "a", 2), (3, "c", 2), (None, "b", 2)], "id int, owner string, v int")
    rows = lambda mode, **k: sorted((r.id or 0, r.v) for r in merge(target, source, ["id"], mode, **k).collect())
    assert rows("UPSERT") == [(0, 2), (1, 1), (2, 2), (3, 2)]
    assert rows("append") == [(0, 1), (1, 1), (2, 1), (3, 2)]
    assert rows("OVERWRITE", scope="owner") == [(0, 2), (2, 2), (3, 2)]
    assert resolve_mode(None) == "APPEND"
    with pytest.raises(ValueError):
        resolve_mode("replace")


def test_keyed_table(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}/t", spark.createDataFrame([], "id int, v string").schema, ["id"], 4)
    assert not table.exists() and table.read().count() == 0
    table.insert(spark.createDataFrame([(i, "a") for i in range(20)], "id int, v string"))
    table.insert(spark.createDataFrame([(5, "b"), (30, "b")], "id int, v string"))
    assert table.read().count() == 21 and table.read().where("id = 5").first().v == "b"
    table.insert(spark.createDataFrame([(5, "c", 1)], "id int, v string, more int"))
    assert {r.more for r in table.read().where("id = 5").collect()} == {1}
    table.delete(spark.createDataFrame([(i,) for i in range(10)], "id int"))
    assert sorted(r.id for r in table.read().select("id").collect()) == [*range(10, 20), 30]


def test_curated_rows_are_not_sorted_to_find_their_route(spark, curves):
    rows = spark.range(10).select(F.col("id").cast("string").alias("curve_name"), "id")
    assert "ShuffledHashJoin" in P.route(rows, curves)._jdf.queryExecution().executedPlan().toString()


def test_dispatch_and_ingest(spark, curves, tmp_path):
    queue = KeyedTable(spark, f"file://{tmp_path}/queue", queue_schema(), ["request_id"], 4)
    config = P.Config(seconds=7200, end="2025-01-02 00:00:00")
    sent = P.dispatch(curves, queue, config)
    assert sent.status == "dispatched" and queue.read().count() == 7 and sent.jobs.agg(F.sum("requests")).first()[0] == 7
    P.dispatch(curves, queue, config)
    assert queue.read().count() == 7  # a replay changes nothing
    own = lambda name, value: body("TIMESERIES", [{"d": "2025-01-01T00:00Z", "v": value}]).replace("c TIMESERIES", name)
    raw = spark.createDataFrame([(True, own("UK Price Spot", 1.0), "u1"), (False, "x", "u2"), (True, body("OHLC", []), "u3"), (True, "{not json", "u4"), (True, None, "u5"), (None, "?", "u6"), (True, own("US Price", 2.0), "u7")], "ok boolean, body string, url string")
    tables = P.curated_tables(spark, f"file://{tmp_path}", 2)
    stats = P.ingest(spark, raw, curves, tables)
    assert {k: stats[k] for k in ("status", "batches", "responses", "failed_responses", "curation_failures", "curated_rows", "inserts", "insert_failures")} == {"status": "ingested", "batches": 1, "responses": 7, "failed_responses": 2, "curation_failures": 1, "curated_rows": 2, "inserts": 2, "insert_failures": 0}
    assert tables.read(["actual_timeseries_price_spot"]).count() == 1 and tables.read().count() == 2
    assert stats["routes"] == {"actual_timeseries_price_spot": 1, "normal_timeseries_price": 1}
    again = P.ingest(spark, raw, curves, tables, cached=raw.where("url <> 'u7'"))
    assert again["responses"] == 1 and again["curated_rows"] == 1 and tables.read().count() == 2
    assert P.ingest(spark, raw, curves, tables, cached=raw, insert_all=True)["responses"] == 7
    empty = P.ingest(spark, raw, curves, tables, cached=raw)
    assert empty["status"] == "empty", empty["reason"]
    done = spark.createDataFrame([("UK Price Spot",)], "curve_name string")
    assert P.drain(queue, "actual_timeseries_price_spot", done, stats | {"insert_failures": 1}) == "kept"
    assert P.drain(queue, "actual_timeseries_price_spot", done, stats) == "drained" and queue.read().count() == 5  # bad bodies don't block
    assert P.drain(queue, "actual_timeseries_price_spot", done, stats) == "nothing_pending"
    (tmp_path / "file").write_text("")
    failed = P.ingest(spark, raw, curves, P.curated_tables(spark, f"file://{tmp_path}/file"))
    assert failed["insert_failures"] == 1 and failed["status"] == "failed" and failed["reason"]
    assert P.dispatch(curves, queue, P.Config(), spark.createDataFrame([], "curve_name string")).status == "no_new_data"


def test_dispatch_queues_what_it_plans(spark, tmp_path):
    """With the time taken at dispatch, and with a plan that depends on chance."""
    names_ = [(f"curve {k}", "TIMESERIES", "ACTUAL", None, None, ["Gas"], None, None, None, "MWh", None, ("PT1H", "CET")) for k in range(40)]
    many = spark.createDataFrame(names_, "name string, curve_type string, data_type string, area string, area_sink string, categories array<string>, commodity string, denominator string, source string, unit string, instance_issued_timezone string, resolution struct<frequency string, timezone string>")
    for k in range(2):
        queue = KeyedTable(spark, f"file://{tmp_path}/queue{k}", queue_schema(), ["request_id"], 8)
        sent = P.dispatch(many, queue, P.Config(seconds=7200))
        assert queue.read().count() == 40 == sent.jobs.agg(F.sum("requests")).first()[0]
    table = KeyedTable(spark, f"file://{tmp_path}/chance", spark.createDataFrame([], "id string, v int").schema, ["id"], 8)
    table.insert(spark.range(200).select(F.concat(F.col("id"), F.lit(" "), F.rand().cast("string")).alias("id"), F.lit(1).alias("v")))
    assert table.read().count() == 200


def test_pending_falls_back_to_category(spark, curves):
    empty = spark.createDataFrame([], "curve_name string, table_category string")
    assert names(P.pending_curves(empty, curves, "actual_timeseries_price_spot")) == ["UK"]


def test_fetch_keeps_failures(spark):
    def send(url, params):
        if url == "bad":
            raise OSError("down")
        return 200, json.dumps(params)

    requests = spark.createDataFrame([("good", {"a": "1"}), ("bad", None)], "url string, params map<string,string>")
    got = {r.url: r for r in X.fetch(requests, send, 2).collect()}
    assert got["good"].ok and json.loads(got["good"].body) == {"a": "1"} and not got["bad"].ok
    assert X.only_new(X.fetch(requests, send, 2), requests.where("url = 'bad'")).count() == 1


def test_event_stream(spark, curves, tmp_path):
    rows = [{"event_id": str(i % 3), "event_type": "CURVE_UPDATE" if i != 1 else "OTHER", "ts": f"2025-01-01T00:0{i}:00Z", "curve_name": "UK Price Spot" if i < 3 else "unknown", "tags": ["x"]} for i in range(4)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    got = []
    stream = E.join_curves(E.deduplicate(E.filter_events(E.read_events(spark, f"file://{tmp_path}/in"), tags=["x"])), curves)
    run = lambda: E.drain(stream, lambda b, _: got.extend(r.event_id for r in b.collect()), f"file://{tmp_path}/cp").stop()
    run()
    run()  # a restart goes on from the checkpoint
    assert sorted(got) == ["0", "2"]
    batch = spark.createDataFrame([("a", "1", 1), ("a", "2", 5), ("b", "3", 2)], "curve_name string, event_id string, ts int")
    assert {(r.curve_name, r.event_id) for r in E.last_per_curve(batch).collect()} == {("a", "2"), ("b", "3")}


def test_entry_lists_queries_and_their_sql():
    import __spark_entry__ as e

    core = {k for k in e.queries() if not k.startswith("op") and k != "pipeline"}
    assert set(e.oracle_sql()) <= set(e.queries()) and len(core) >= 60


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not FOLDER.exists():
        pytest.skip("no tables")
    con = duckdb.connect()
    for f in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(core_queries.oracle_sql()))
def test_queries_match_their_sql(spark, duck, name):
    """All of the core's queries that have SQL, on the smallest tables."""
    got, found = core_queries.queries()[name](spark, str(FOLDER)), duck.execute(core_queries.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    plain = lambda v: round(v, 6) if isinstance(v, float) else tuple(map(plain, v)) if isinstance(v, list) else v
    assert Counter(tuple(map(plain, r)) for r in got.select(*columns).collect()) == Counter(tuple(map(plain, r)) for r in found.fetchall())
