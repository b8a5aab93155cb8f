import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from gridweave.plans import requests as R
from gridweave.sources import responses as X
from gridweave.sources.routed import RoutedTables
from gridweave.sources.tables import KeyedTable, latest, merge, merge_into
from gridweave.streaming import events as E


def test_two_writers_lose_nothing(spark, tmp_path):
    schema = spark.createDataFrame([], "id int, v string").schema
    table = lambda: KeyedTable(spark, f"file://{tmp_path}/t", schema, ["id"], 2)
    assert not table().exists() and table().create().exists() and table().read().count() == 0
    table().insert(spark.createDataFrame([(i, "a") for i in range(20)], schema))
    writers = [threading.Thread(target=table().insert, args=(spark.createDataFrame([(i, "b") for i in range(k, k + 20)], schema),)) for k in (20, 40, 60)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert table().read().count() == 80
    table().vacuum()
    assert table().read().count() == 80 and len(table()._versions()) == 1


def test_merge_into_has_no_overwrite(spark):
    with pytest.raises(ValueError):
        merge_into(spark.range(1), "t", ["id"], "overwrite")


def write_events(folder, n):
    folder.mkdir()
    for i in range(n):
        (folder / f"{i}.json").write_text(json.dumps({"event_id": str(i % 4), "event_type": "CURVE_UPDATE", "ts": f"2025-01-01T00:0{i}:00Z", "curve_name": "c", "data_type": "ACTUAL"}))


def test_drain_that_takes_too_long_raises_and_goes_on(spark, tmp_path):
    write_events(tmp_path / "in", 6)
    seen = []

    def slow(batch, _):
        seen.extend(r.event_id for r in batch.collect())
        time.sleep(2)

    events = E.read_events(spark, f"file://{tmp_path}/in", files_per_trigger=1)
    with pytest.raises(TimeoutError):
        E.drain(events, slow, f"file://{tmp_path}/cp", seconds=1)
    E.drain(events, lambda b, _: seen.extend(r.event_id for r in b.collect()), f"file://{tmp_path}/cp")
    assert set(seen) == {"0", "1", "2", "3"} and len(seen) >= 6


def test_stream_in_one_call_and_restarts(spark, tmp_path):
    write_events(tmp_path / "in", 6)
    curves = spark.createDataFrame([("c", "TIMESERIES", "ACTUAL", "MWh", ["x"]), ("d", "OHLC", "FOREX", "EUR", None)], "name string, curve_type string, data_type string, unit string, categories array<string>")
    got = []
    E.stream(spark, f"file://{tmp_path}/in", curves, lambda b, _: got.extend(r.event_id for r in b.collect()), f"file://{tmp_path}/cp", batch_files=2, curve_types=["TIMESERIES"])
    assert sorted(got) == ["0", "1", "2", "3"]
    calls = []

    def broken(batch, _):
        calls.append(batch.count())
        raise OSError("down")

    with pytest.raises(Exception, match="down"):
        E.follow(E.read_events(spark, f"file://{tmp_path}/in"), broken, f"file://{tmp_path}/cp2", "0 seconds", restarts=1, backoff=0.1)
    assert len(calls) == 2


def test_silent_streams_are_started_again(spark, tmp_path):
    write_events(tmp_path / "in", 2)
    made, began, said = [], time.monotonic(), []
    progress = E.Progress(said.append)
    spark.streams.addListener(progress)

    def source():
        made.append(time.monotonic())
        return E.read_events(spark, f"file://{tmp_path}/in")

    try:
        with pytest.raises(E.Idle):
            E.follow(source, lambda b, _: b.count(), f"file://{tmp_path}/cp", "0 seconds", restarts=1, backoff=0.1, idle_seconds=4)
    finally:
        spark.streams.removeListener(progress)
    # the first start gets events, so both restarts are still to come; the later ones are silent
    assert len(made) >= 2 and time.monotonic() - began >= 8 and any("rows" in x for x in said) and progress.rows >= 2


def test_stream_in_batches(spark, tmp_path):
    write_events(tmp_path / "in", 6)
    curves = spark.createDataFrame([("c", "TIMESERIES", "ACTUAL", "MWh", ["x"])], "name string, curve_type string, data_type string, unit string, categories array<string>")
    got = []
    run = lambda folder, **k: E.stream(spark, f"file://{tmp_path}/in", curves, lambda b, _: got.extend((r.batch, r.event_id) for r in b.orderBy("batch", "place").collect()), f"file://{tmp_path}/{folder}", **k)
    run("cp1", batch_size=3)
    assert [b for b, _ in got] == [0, 0, 0, 1, 1, 1]
    got.clear()
    run("cp2", batch_size=2, recent=10)
    assert sorted(e for _, e in got) == ["0", "1", "2", "3"]
    with pytest.raises(ValueError):
        run("cp3", batch_size=2, batch_seconds=5.0)


# ---- routed tables


def routed(spark, path, buckets=4):
    return RoutedTables(spark, f"file://{path}", spark.createDataFrame([], "id int, owner bigint, v string").schema, ["id"], "owner", "route", buckets)


def some_rows(spark, routes, n=60, v="a"):
    return spark.createDataFrame([(i, i % 20, f"{v}{i}", f"r{i % routes}") for i in range(n)], "id int, owner bigint, v string, route string")


def test_routed_tables_by_mode(spark, tmp_path):
    tables = routed(spark, tmp_path / "t")
    assert tables.read().count() == 0 and tables.write(some_rows(spark, 3).where("1 = 0")) == {}
    assert tables.write(some_rows(spark, 3), "upsert") == {"r0": 20, "r1": 20, "r2": 20}
    tables.write(some_rows(spark, 3, 6, "b"), "append")
    assert tables.read().where("v LIKE 'b%'").count() == 0
    tables.write(some_rows(spark, 3, 6, "b"), "upsert")
    assert tables.read().where("v LIKE 'b%'").count() == 6 and tables.read().count() == 60
    # OVERWRITE: all rows of the owner in that route; the same owner elsewhere stays
    tables.write(spark.createDataFrame([(900, 0, "c", "r0")], "id int, owner bigint, v string, route string"), "overwrite")
    left = {(r.id, r.route) for r in tables.read().where("owner = 0").collect()}
    assert left == {(900, "r0"), (20, "r2"), (40, "r1")}
    tables.write(spark.createDataFrame([(1, 1, "may", "r1", True), (2, 2, "may not", "r2", False), (77, 5, "new", "r5", None)], "id int, owner bigint, v string, route string, may boolean"), replace="may")
    assert {r.v for r in tables.read().where("id IN (1, 2, 77)").collect()} == {"may", "b2", "new"}
    assert {r.route for r in tables.read(["r5"]).collect()} == {"r5"}


def test_routed_write_takes_as_many_jobs_for_many_routes(spark, tmp_path):
    counts = []
    for routes in (2, 40):
        tables = routed(spark, tmp_path / f"t{routes}", 1)
        tables.write(some_rows(spark, routes))
        spark.sparkContext.setJobGroup(f"routes {routes}", "")
        tables.write(some_rows(spark, routes, v="b"), "upsert")
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"routes {routes}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert tables.read().where("v LIKE 'b%'").count() == 60
    assert abs(counts[0] - counts[1]) <= 2


def test_routed_write_deals_rows_by_their_number(spark, tmp_path, monkeypatch):
    """A task takes a fixed number of rows: of a large partition, and of many rows of one key; what is stored is the same."""
    monkeypatch.setattr("gridweave.sources.routed.ROWS", 100, raising=False)
    rows = lambda v, n=1000: spark.range(n).selectExpr("int(id) AS id", "id % 20 AS owner", f"'{v}' || id AS v", "if(id % 10 = 0, 's' || id % 7, 'big') AS route")
    tables = routed(spark, tmp_path / "t", 1)
    assert tables.write(rows("a"))["big"] == 900
    plain = tables.read().select("id", "v", "route", F.input_file_name().alias("f"))
    assert plain.groupBy("f").count().agg(F.max("count")).first()[0] <= 200
    assert 8 <= plain.where("route = 'big'").select("f").distinct().count() <= 11
    assert plain.where("route <> 'big'").select("f").distinct().count() <= 10
    tables.write(rows("b", 500), "upsert")
    tables.write(rows("c", 1200), "append")
    assert {(r.id, r.v[0]) for r in tables.read().collect()} == {(i, "b" if i < 500 else "a" if i < 1000 else "c") for i in range(1200)}
    many = spark.range(2000).selectExpr("7 AS id", "id % 1000 AS owner", "string(id) AS v", "'big' AS route", "id >= 1500 AS may")
    tables.write(many, "upsert", "owner")
    assert [r.v for r in tables.read().where("id = 7").collect()] == ["999"]  # of 1999 and 999, equally recent, the greater text
    tables.write(many, recency="owner", replace="may")
    assert [r.v for r in tables.read().where("id = 7").collect()] == ["1999"]
    assert tables.read().count() == 1200
    tables.write(spark.createDataFrame([(9000, 3, "d", "big")], "id int, owner bigint, v string, route string"), "overwrite")
    assert {r.id for r in tables.read(["big"]).where("owner = 3").collect()} == {9000} and tables.read(["big"]).count() == 1080 - 60 + 1


def test_read_by_ids_prunes_partitions(spark, tmp_path):
    tables = routed(spark, tmp_path / "t", 16)
    tables.write(some_rows(spark, 2, 400))
    ids = spark.createDataFrame([(3,), (3,), (None,)], "owner bigint")
    read = tables.read(ids=ids)
    assert {r.owner for r in read.collect()} == {3} and read.count() == 20
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_latest_is_the_same_in_every_run(spark):
    rows = [(1, 5, "a", {"k": "1"}), (1, 5, "b", {"k": "0"}), (1, None, "z", None), (2, None, None, None)]
    df = spark.createDataFrame(rows, "id int, at int, v string, m map<string,string>")
    for order in (df, df.repartition(3), df.orderBy("v")):
        assert {(r.id, r.at, r.v) for r in latest(order, ["id"], "at").collect()} == {(1, 5, "b"), (2, None, None)}
    assert latest(df.select("id"), ["id"]).count() == 2


def test_cache_says_by_row_what_may_change(spark, tmp_path):
    cache = KeyedTable(spark, f"file://{tmp_path}/raw", spark.createDataFrame([], X.RAW_DDL).schema, ["url"], 2)
    rows = lambda body: spark.createDataFrame([(f"u{k}", k != 9, 200, body, k % 2 == 0) for k in range(10)], f"{X.RAW_DDL}, may boolean")
    X.cache_raw(rows("old"), cache, "may")
    X.cache_raw(rows("new"), cache, "may")
    assert {(r.url, r.body) for r in cache.read().collect()} == {(f"u{k}", "new" if k % 2 == 0 else "old") for k in range(9)}
    assert merge(cache.read(), rows("x"), ["url"], replace="may").columns == X.RAW_COLUMNS


def test_responses_as_files(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"url": "u", "ok": True, "status": 200, "body": "{}"}) + "\n")
    assert [tuple(r) for r in X.read_responses(spark, f"file://{tmp_path}").collect()] == [("u", True, 200, "{}")]


def test_busy_curve_meets_its_requests_block_by_block(spark):
    """A thousand issues and many requests of one curve: as if each were compared with each, but joined within blocks."""
    day = "timestamp_ntz'2024-01-01' + make_dt_interval({0})"
    issues = spark.range(1000).select(F.lit("c").alias("curve_name"), F.expr(day.format("int(id)")).alias("issued"), F.lit("t").alias("tag"))
    asked = spark.range(50).selectExpr("'c' AS curve_name", "'INSTANCE' AS curve_type", f"{day.format('int(id * 19)')} AS issued_earliest", f"{day.format('int(id * 19 + id % 7 * 20)')} AS issued_latest").unionByName(spark.sql("SELECT 'c' AS curve_name, 'INSTANCE' AS curve_type, timestamp_ntz'2025-01-01' AS issued_earliest, timestamp_ntz'2024-01-01' AS issued_latest"))
    got = R.in_issue_range(asked, issues)
    want = sum(sum(k * 19 <= i <= k * 19 + k % 7 * 20 for i in range(1000)) for k in range(50))
    assert got.count() == want and got.distinct().count() == got.count()
    assert "__block" in got._jdf.queryExecution().optimizedPlan().toString()


def test_requests_dealt_to_blocks_are_not_broadcast(spark):
    """A small table of requests is many rows once it is dealt to blocks, whatever its size on disk says."""
    requests = spark.range(5).select(F.concat(F.lit("c"), "id").alias("curve_name"), F.expr("timestamp_ntz'1995-01-01'").alias("issued_earliest"), F.expr("timestamp_ntz'1997-01-01'").alias("issued_latest"))
    instances = spark.range(20).select(F.concat(F.lit("c"), F.col("id") % 4).alias("curve_name"), F.expr("timestamp_ntz'1995-01-01' + make_interval(0, 0, 0, int(id * 50))").alias("issued"), F.lit("t").alias("tag"))
    met = R.in_issue_range(requests, instances)
    assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()
    assert met.count() == 15
