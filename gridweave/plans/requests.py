"""Request planning: what to fetch for which curve and window, as DataFrames of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.functions import scalars as S
from gridweave.operators.catalog import search

# The path of each kind of curve.
ENDPOINTS = {"INSTANCE": "instances", "INSTANCE_PERIOD": "period-instances", "OHLC": "ohlc", "PERIOD": "periods", "TIMESERIES": "timeseries", "SCENARIO_TIMESERIES": "timeseries"}
ENSEMBLES = "ensembles"


def with_defaults(requests: DataFrame, now: Column) -> DataFrame:
    """end: now; begin: 14 days before the end; issued_latest: now; issued_earliest: 7 days before; unit, frequency, timezone
    from the curve."""
    days = lambda c, n: F.timestamp_add("DAY", F.lit(-n), c)
    out = requests.withColumn("end", F.coalesce("end", now)).withColumn("issued_latest", F.coalesce("issued_latest", now))
    out = out.withColumns({"begin": F.coalesce("begin", days(F.col("end"), 14)), "issued_earliest": F.coalesce("issued_earliest", days(F.col("issued_latest"), 7)), "unit": F.coalesce("unit", "curve_unit"), "frequency": F.coalesce("frequency", "curve_frequency")})
    zone = S.effective_zone(F.col("curve_type"), F.col("frequency"), F.coalesce("timezone", "curve_timezone"))
    return out.withColumns({"timezone": zone, "page_limit": S.page_limit(F.col("curve_type"), F.coalesce("ensembles", F.lit(False)), F.col("page_limit"))})



REQUEST_DDL = "begin timestamp_ntz, end timestamp_ntz, issued_at timestamp_ntz, issued_earliest timestamp_ntz, issued_latest timestamp_ntz, tags array<string>, page_limit int, ensembles boolean, unit string, frequency string, timezone string, event_type string"


def _requests(curves: DataFrame, own: dict[str, Column] | None = None) -> DataFrame:
    """A request for each row of ``curves``: its columns, and those of REQUEST_DDL, null where nothing is given."""
    own = own or {}
    kinds = dict(part.strip().rsplit(" ", 1) for part in REQUEST_DDL.split(","))
    inherited = {"curve_unit": F.col("unit"), "curve_frequency": F.col("resolution.frequency"), "curve_timezone": F.col("resolution.timezone")}
    return curves.select(F.col("name"), "curve_type", "data_type", "categories", *(c.alias(k) for k, c in inherited.items()), *(own.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()))


def requests_for(wanted: DataFrame | str | list, curves: DataFrame, **overrides: object) -> DataFrame:
    """Requests from what names curves: a name or pattern, a frame of update events (event_type, curve_name, begin, end,
    and perhaps instance_issued, instance_tag), a frame of curves (name, curve_type and more), a frame of requests, or a
    list of these. Events of other kinds, and of unknown curves, give none."""
    if isinstance(wanted, (list, tuple)):
        parts = [requests_for(w, curves) for w in wanted]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
    elif isinstance(wanted, str):
        out = _requests(search(curves, wanted))
    elif not isinstance(wanted, DataFrame):
        raise ValueError(f"cannot make requests from {type(wanted).__name__}")
    elif "event_type" in wanted.columns and "curve_name" in wanted.columns:
        null = {c: F.lit(None) for c in ("instance_issued", "instance_tag") if c not in wanted.columns}
        events = wanted.where(F.col("event_type") == "CURVE_UPDATE").withColumns(null).select("event_type", "curve_name", "begin", "end", "instance_issued", "instance_tag")
        told = curves.join(events.select(F.struct(*events.columns).alias("e"), F.col("curve_name").alias("name")), "name")
        tags = F.when(F.col("e.instance_tag").isNotNull(), F.array("e.instance_tag")).otherwise(F.array().cast("array<string>"))
        out = _requests(told, {"begin": F.col("e.begin"), "end": F.col("e.end"), "issued_at": F.col("e.instance_issued"), "tags": tags, "event_type": F.col("e.event_type")})
    elif "issued_earliest" in wanted.columns:
        out = wanted
    else:
        out = _requests(wanted)
    return with_overrides(out, **overrides) if overrides else out


def with_overrides(requests: DataFrame, **values: object) -> DataFrame:
    """Requests with some columns replaced, by columns or plain values; null is a value like others."""
    if unknown := sorted(set(values) - set(requests.columns)):
        raise KeyError(f"unknown columns: {unknown}")
    kinds = dict(requests.dtypes)
    return requests.withColumns({k: (v if isinstance(v, Column) else F.lit(v)).cast(kinds[k]) for k, v in values.items()})


def fan_out_windows(requests: DataFrame, begin: str = "begin", end: str = "end", frequency: str = "frequency") -> DataFrame:
    """Each window of a series in steps of a month (data within a day) or a year, counted from its begin so that days of
    the month don't drift; the last is cut at the end. Instances keep one row."""
    step = F.when(S.fetch_interval(F.col(frequency)) == "P1M", 1).otherwise(12)
    months = F.greatest(F.floor(F.months_between(F.col(end), F.col(begin))), F.lit(0))
    count = F.floor(months / step).cast("int")
    at = lambda k: F.timestamp_add("MONTH", (k * step).cast("int"), F.col(begin))
    series = ~F.col("curve_type").isin("INSTANCE", "INSTANCE_PERIOD")
    # one window more than whole steps, left out if it is empty
    steps = F.filter(F.sequence(F.lit(0), count + 1), lambda k: (at(k) < F.col(end)) | (k == 0))
    windows = F.when(series & (F.col(begin) < F.col(end)), F.transform(steps, lambda k: F.struct(at(k).alias("begin"), F.least(at(k + 1), F.col(end)).alias("end")))).otherwise(F.array(F.struct(F.col(begin).alias("begin"), F.col(end).alias("end"))))
    out = requests.withColumn("__window", F.explode(windows))
    return out.withColumns({begin: F.col("__window.begin"), end: F.col("__window.end")}).drop("__window")


#: Days of a block of issue times: instances and requests meet by curve and block.
ISSUE_BLOCK_DAYS = 30


def in_issue_range(requests: DataFrame, instances: DataFrame, days: int = ISSUE_BLOCK_DAYS) -> DataFrame:
    """Requests (curve_name, issued_earliest, issued_latest, ...) with the instances (issued, issue_tag) of their curve in range, both ends
    included. A request's range is dealt to the blocks that it meets, so instances and requests of a busy curve are joined block by
    block, not each with each; an instance is in one block, so no pair comes twice. Both sides are shuffled: dealt to blocks, requests are many
    times what the engine takes them for, so it would broadcast more than a driver holds."""
    block = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / (days * 86_400_000_000)).cast("int")
    issued = instances.select(F.col("curve_name").alias("__name"), "issued", F.col("tag").alias("issue_tag"), block(F.col("issued")).alias("__block"))
    first, last = block(F.col("issued_earliest")), block(F.col("issued_latest"))
    asked = requests.where("issued_earliest <= issued_latest").withColumn("__asked", F.explode(F.sequence(first, last)))
    inside = (F.col("curve_name") == F.col("__name")) & (F.col("__asked") == F.col("__block")) & F.col("issued").between(F.col("issued_earliest"), F.col("issued_latest"))
    return asked.hint("merge").join(issued, inside).drop("__name", "__block", "__asked")


def fan_out_instances(requests: DataFrame, instances: DataFrame) -> DataFrame:
    """One request per issued instance of the curve in range; of period instances one per block of four hours."""
    both = in_issue_range(requests.where(F.col("curve_type").isin("INSTANCE", "INSTANCE_PERIOD")), instances)
    bucket = S.issue_bucket(F.col("issued"))
    blocks = F.col("curve_type") == "INSTANCE_PERIOD"
    shaped = both.withColumns({"issued_earliest": F.when(blocks, bucket).otherwise(F.col("issued_earliest")), "issued_latest": F.when(blocks, F.timestamp_add("HOUR", F.lit(4), bucket)).otherwise(F.col("issued_latest")), "issued": F.when(~blocks, F.col("issued")), "issue_tag": F.when(~blocks, F.col("issue_tag"))})
    return shaped.distinct()


def variants(curves: DataFrame) -> DataFrame:
    """The plain request, for instances one for ensembles, for GBP and USD units one in EUR: columns ensembles, unit, variant."""
    plain = F.struct(F.lit(False).alias("ensembles"), F.col("unit").alias("unit"), F.lit(None).cast("string").alias("variant"))
    ensembles = F.struct(F.lit(True).alias("ensembles"), F.col("unit").alias("unit"), F.lit(ENSEMBLES).alias("variant"))
    eur = F.struct(F.lit(False).alias("ensembles"), S.eur_unit(F.col("unit")).alias("unit"), S.eur_unit(F.col("unit")).alias("variant"))
    chosen = F.filter(F.array(plain, F.when(F.col("curve_type") == "INSTANCE", ensembles), F.when(S.is_foreign(F.col("unit")), eur)), lambda x: x.isNotNull())
    return curves.withColumn("__v", F.explode(chosen)).withColumns({k: F.col(f"__v.{k}") for k in ("ensembles", "unit", "variant")}).drop("__v")


def request_id(name: Column, variant: Column, begin: Column, end: Column) -> Column:
    return F.concat_ws("|", name, variant, S.iso_text(begin), S.iso_text(end))


def queue_rows(routed: DataFrame, begin: Column, end: Column, mode: str, now: Column) -> DataFrame:
    """Rows of the work queue for curves with table_category and cluster_key."""
    rows = variants(routed)
    ident = request_id(F.col("name"), F.col("variant"), begin.cast("timestamp_ntz"), end.cast("timestamp_ntz"))
    return rows.select(ident.alias("request_id"), F.col("name").alias("curve_name"), "curve_type", "data_type", "table_category", "cluster_key", begin.cast("timestamp").alias("begin"), end.cast("timestamp").alias("end"), "ensembles", "unit", F.lit(mode).alias("mode"), now.cast("timestamp").alias("created_at"))


def endpoint(curve_type: Column, ensembles: Column) -> Column:
    """The path of a curve's kind; an unknown kind raises."""
    out = F.raise_error(F.concat(F.lit("invalid curve type "), F.coalesce(curve_type, F.lit("null")))).cast("string")
    for kind, path in ENDPOINTS.items():
        out = F.when(curve_type == kind, F.when(F.coalesce(ensembles, F.lit(False)) & (curve_type == "INSTANCE"), F.lit(ENSEMBLES)).otherwise(F.lit(path))).otherwise(out)
    return out


def path_encode(c: Column) -> Column:
    return F.regexp_replace(F.url_encode(c), r"\+", "%20")


def url_path(requests: DataFrame) -> Column:
    """endpoint/name/, and for one issued instance get/time/ and its tag if it has just one."""
    single = (F.col("curve_type") == "INSTANCE") & F.col("issued_at").isNotNull()
    issued = F.concat(F.lit("get/"), path_encode(F.date_format("issued_at", "yyyy-MM-dd HH:mm:ss'+00:00'")), F.lit("/"))
    tag = F.when(F.size("tags") == 1, F.concat(path_encode(F.lower(F.get("tags", 0))), F.lit("/"))).otherwise("")
    return F.concat(endpoint(F.col("curve_type"), F.col("ensembles")), F.lit("/"), path_encode(F.col("name")), F.lit("/"), F.when(single, F.concat(issued, tag)).otherwise(""))


def parameters(requests: DataFrame) -> Column:
    """Query parameters as a map of texts, without nulls."""
    kind = F.col("curve_type")
    instance, block = kind == "INSTANCE", kind == "INSTANCE_PERIOD"
    single = instance & F.col("issued_at").isNotNull()
    dated = lambda c: F.when(kind == "OHLC", F.date_format(c, "yyyy-MM-dd")).when(~instance & ~block, S.iso_text(F.col(c)))
    tags = F.when((instance | block) & (F.size("tags") > 0) & ~(single & (F.size("tags") == 1)), F.array_join("tags", ","))
    values = {
        "begin": dated("begin"), "end": dated("end"), "unit": F.col("unit"), "frequency": F.col("frequency"), "timezone": F.col("timezone"),
        "issued-at-earliest": F.when(instance & ~single, S.iso_text(F.col("issued_earliest"))), "issued-at-latest": F.when(instance & ~single, S.iso_text(F.col("issued_latest"))),
        "tags": tags, "limit": F.when((instance | block) & ~single, F.col("page_limit").cast("string")),
    }
    return F.map_filter(F.create_map(*(x for k, v in values.items() for x in (F.lit(k), v))), lambda _, v: v.isNotNull())


def deduplicate(requests: DataFrame, url: str = "url", params: str = "params") -> DataFrame:
    """One request per path and parameters."""
    return requests.withColumn("__key", F.to_json(F.array_sort(F.map_entries(params)))).dropDuplicates([url, "__key"]).drop("__key")


def must_upsert(by_event: Column, end: Column, now: Column) -> Column:
    """Data of an update event, or of a window that isn't over, may come again changed."""
    return F.coalesce(by_event, F.lit(False)) | (end > now)


def list_instances(instances: DataFrame, earliest: Column, latest: Column) -> DataFrame:
    """Issued instances in range, one per curve, time and tag, newest first."""
    return instances.where(F.col("issued").between(earliest, latest)).dropDuplicates(["curve_name", "issued", "tag"]).orderBy(F.desc("issued"), "curve_name", "tag")
