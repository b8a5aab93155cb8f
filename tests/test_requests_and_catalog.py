import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gridweave import model as M
from gridweave import queries as Q
from gridweave.functions.hashing import signed_xxh3
from gridweave.operators import catalog as C
from gridweave.plans import pipeline as P
from gridweave.plans import requests as R
from gridweave.schemas import catalog_schema
from gridweave.sources import responses as X

D = dt.datetime


@pytest.fixture(scope="module")
def curves(spark):
    docs = [{"name": n, "curve_type": t, "data_type": "FORECAST", "unit": "MWh", "resolution": {"frequency": "PT1H", "timezone": "CET"}} for n, t in (("DE Wind", "INSTANCE"), ("FR Wind", "INSTANCE_PERIOD"), ("UK Price", "TIMESERIES"))]
    return C.parse_curves(spark.createDataFrame([(json.dumps(x),) for x in docs], "j string"), "j").cache()


def test_requests_from_anything(spark, curves):
    events = spark.createDataFrame([("CURVE_UPDATE", "DE Wind", D(2025, 1, 1), D(2025, 1, 2), D(2025, 1, 1, 6), "ec"), ("CURVE_UPDATE", "nobody", None, None, None, None), ("OTHER", "UK Price", None, None, None, None)], "event_type string, curve_name string, begin timestamp_ntz, end timestamp_ntz, instance_issued timestamp_ntz, instance_tag string")
    r = R.requests_for(events, curves).collect()
    assert [(x.name, x.begin, x.issued_at, x.tags, x.event_type, x.curve_frequency) for x in r] == [("DE Wind", D(2025, 1, 1), D(2025, 1, 1, 6), ["ec"], "CURVE_UPDATE", "PT1H")]
    both = R.requests_for(["*wind", curves.where("name = 'UK Price'"), R.requests_for(events, curves)], curves, begin=D(2024, 5, 1), unit="EUR")
    assert sorted(x.name for x in both.collect()) == ["DE Wind", "DE Wind", "FR Wind", "UK Price"] and {(x.begin, x.unit) for x in both.collect()} == {(D(2024, 5, 1), "EUR")}
    assert R.with_overrides(both, unit=None, end=F.col("begin")).first().unit is None
    with pytest.raises(KeyError):
        R.with_overrides(both, colour="red")
    with pytest.raises(ValueError):
        R.requests_for(3, curves)
    filled = R.with_defaults(R.requests_for("UK Price", curves), F.expr("timestamp_ntz'2025-03-01'")).first()
    assert (filled.begin, filled.end, filled.issued_earliest, filled.unit, filled.timezone) == (D(2025, 2, 15), D(2025, 3, 1), D(2025, 2, 22), "MWh", "CET")


def test_instance_pages(spark):
    """A listing of many pages, one with more issues in a block of hours than a page holds, a short one, and a failing one."""
    start = D(2025, 1, 1)
    issues = {"DE%20Wind": [start + dt.timedelta(hours=h) for h in range(100)], "FR": [start + dt.timedelta(minutes=m) for m in range(45)], "bad": []}

    def send(url, params):
        name = url.split("/")[1]
        if name == "bad":
            return 500, "no"
        at = dt.datetime.fromisoformat(params["issued-at-latest"]).replace(tzinfo=None)
        past = sorted((x for x in issues[name] if x <= at), reverse=True)[: int(params["limit"])]
        return 200, json.dumps([{"issued": x.isoformat() + "Z", "created": None, "modified": None, "tag": params.get("tags")} for x in past])

    requests = spark.createDataFrame([("DE Wind", "INSTANCE", start + dt.timedelta(hours=10), start + dt.timedelta(hours=90), ["ec"]), ("FR", "INSTANCE_PERIOD", None, None, None), ("bad", "INSTANCE", None, None, None), ("x", "OHLC", None, None, None)], "curve_name string, curve_type string, issued_earliest timestamp_ntz, issued_latest timestamp_ntz, tags array<string>")
    got = {}
    for r in X.page_instances(requests, send, D(2025, 6, 1), parallel=2).collect():
        got.setdefault(r.curve_name, []).append((r.issued, r.tag))
    assert sorted(got["DE Wind"]) == [(start + dt.timedelta(hours=h), "ec") for h in range(10, 91)]
    assert sorted(x for x, _ in got["FR"]) == [issues["FR"][0], *issues["FR"][25:]] and set(got) == {"DE Wind", "FR"}  # the rest of the block lies behind its start


def test_retries(spark):
    requests = spark.createDataFrame([("a", None)], "url string, params map<string,string>")
    calls = []

    def send(url, params):
        calls.append(url)
        return (503, "busy") if len(calls) < 3 else (200, "fine")

    assert X.fetch(requests, send, 1, retries=3, pause=0.01).first().body == "fine"


def test_refresh_metadata_sql_and_exits(spark, curves, tmp_path):
    table = P.metadata_table(spark, f"file://{tmp_path}")
    rows = P.refresh_metadata(curves, table)
    P.refresh_metadata(curves, table)
    assert table.read().count() == 3 == rows.count()
    with pytest.raises(RuntimeError):
        P.refresh_metadata(curves.where("1 = 0"), table)
    assert P.sql_over(rows, "SELECT curve_name FROM {self} WHERE table_category = 'forecast_timeseries'").first().curve_name == "UK Price"
    assert P.early_exit(rows, P.Config()) is None and P.early_exit(rows.where("1 = 0"), P.Config()) == "no_new_data" and P.early_exit(rows.where("1 = 0"), P.Config(seconds=7200)) == "no_categories"


def test_cached_catalog_and_cache_parameter(spark, curves, tmp_path):
    loads = []

    def load():
        loads.append(1)
        return curves

    catalog = X.CachedCatalog(spark, f"file://{tmp_path}/catalog", load, seconds=100)
    assert catalog.read(1000.0).count() == 3 and catalog.read(1050.0).count() == 3 and len(loads) == 1
    assert X.CachedCatalog(spark, f"file://{tmp_path}/catalog", load, seconds=100).read(1090.0).count() == 3 and len(loads) == 1
    assert catalog.read(1101.0).count() == 3 and len(loads) == 2
    made = object()
    assert X.check_cache(None, lambda: made, True) is made and X.check_cache(None, lambda: made, False) is None
    assert X.check_cache(True, lambda: made, False) is made and X.check_cache(False, lambda: made, True) is None and X.check_cache("t", lambda: made, True) == "t"


def test_catalog_from_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text('name,categories,resolution\na,"[\'Wind\', ""King\'s Lynn"", None]","{\'frequency\': \'PT1H\', \'timezone\': None}"\nb,"[\'None of it\', \'x, None, y\']",\n')
    got = {r.name: (r.categories, r.resolution) for r in X.catalog_from_csv(spark, f"file://{tmp_path}/c.csv").collect()}
    assert got["a"][0] == ["Wind", "King's Lynn", None] and got["a"][1].frequency == "PT1H" and got["a"][1].timezone is None
    assert got["b"] == (["None of it", "x, None, y"], None)


def test_model_rows_and_lookups(curves):
    now = D(2025, 1, 1)
    c = M.Curve.parse({"name": "A", "access": {"by": "me"}, "categories": ["x"]})
    row = c.to_metadata_row(now)
    assert set(row) == set(catalog_schema().names) and row["curve_id"] == signed_xxh3("A") and row["curve_access_by"] == "me" and row["table_category"] == "normal_timeseries_x"
    known = {n: M.Curve(name=n) for n in ("DE Wind", "FR Wind", "UK")}
    assert [c.name for c in M.iter_curves("*wind", known)] == ["DE Wind", "FR Wind"] and [c.name for c in M.iter_curves("UK", known)] == ["UK"]
    assert [c.name for c in M.iter_curves([c, "UK"], known)] == ["A", "UK"] and list(M.iter_curves(c, known)) == [c]
    with pytest.raises(ValueError):
        M.find_curve("nobody", known)


def test_selected_curves_without_key_zero(spark, tmp_path):
    """Key 0 is left out by the query's SQL, also where its curve is of a wanted category; the named curve stays whatever its key."""
    spark.createDataFrame([(0, "AFRICA")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    spark.createDataFrame([(0, "KENYA", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    rows = [(0, "Customer#000000000", 0, "BUILDING"), (210, "Customer#000000210", 0, "BUILDING"), (420, "Customer#000000420", 0, "FURNITURE"), (0, "Customer#000000030", 0, "BUILDING")]
    spark.createDataFrame(rows, "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    got = Q.catalog_select(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [("Customer#000000030", "actual_timeseries_consumption_building"), ("Customer#000000210", "actual_timeseries_consumption_building")]
