"""Curation: nested responses of every curve kind become one flat table of interval observations.

Every row is handled by its own curve type, so one frame may mix all kinds. Plan: parse with one superset schema, flatten,
explode observations, localise times, infer missing frequencies by a window per curve (rows that declare theirs take no part), bound the intervals, fill nulls from
the catalog by a broadcast join, hash the series identity, filter the range, project to the target schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from gridweave.functions import scalars as S
from gridweave.functions.hashing import canonical_json, xxh3_64
from gridweave.schemas import RESPONSE_DDL, curated_schema
from gridweave.shared import cut

#: Catalogs up to this many curves are broadcast to the join; larger ones are shuffled.
BROADCAST_CURVES = 1_000_000
#: Groups that a curve's rows with a declared frequency are spread over.
SPREAD = 1 << 16


def parse_responses(raw: DataFrame, body: str = "body", ok: str | None = None, malformed: str | None = None) -> DataFrame:
    """JSON bodies as columns of the superset schema; rows whose ``ok`` is not true are left out. With ``malformed``, a column of this
    name holds the body where it isn't JSON (its other columns are null); else such bodies are rows of nulls."""
    kept = raw.where(F.col(ok)) if ok else raw
    if malformed is None:
        return kept.select(F.from_json(body, RESPONSE_DDL).alias("r")).select("r.*")
    options = {"columnNameOfCorruptRecord": malformed}
    return kept.select(F.from_json(body, f"{RESPONSE_DDL}, {malformed} string", options).alias("r")).select("r.*")


def flatten(responses: DataFrame) -> DataFrame:
    """One row per response: structs as prefixed columns, units split, zones and frequencies normalised."""
    c, r, i = "curve", "resolution", "instance"
    return responses.select(
        F.col(f"{c}.name").alias("curve_name"),
        F.col(f"{c}.access.by").alias("curve_access_by"),
        F.col(f"{c}.access.package").alias("curve_access_package"),
        *(F.col(f"{c}.{k}").alias(f"curve_{k}") for k in ("area", "area_sink", "categories", "commodity", "data_type", "denominator", "source", "subscription", "place", "instance_issued_timezone", "unit")),
        F.col(f"{c}.curve_type").alias("curve_type"),
        S.iso_duration_seconds(F.col(f"{c}.resolution.frequency")).alias("curve_resolution_frequency"),
        S.normal_zone(F.col(f"{c}.resolution.timezone")).alias("curve_resolution_timezone"),
        S.iso_duration_seconds(F.col(f"{r}.frequency")).alias("resolution_frequency"),
        S.normal_zone(F.col(f"{r}.timezone")).alias("resolution_timezone"),
        S.unit_of(F.col("unit")).alias("unit"),
        S.denominator_of(F.col("unit")).alias("denominator"),
        *(S.utc_time(F.col(f"{i}.{k}")).alias(f"instance_{k}") for k in ("issued", "created", "modified")),
        F.col(f"{i}.tag").alias("instance_tag"),
        "scenario_names",
        "data",
    )


def zip_shorter(a: Column, b: Column) -> Column:
    """Pairs (a, b) up to the end of the shorter array; null arrays give none."""
    n = F.coalesce(F.least(F.size(a), F.size(b)), F.lit(0))
    n = F.greatest(n, F.lit(0))
    return F.transform(F.arrays_zip(F.slice(a, F.lit(1), n).alias("a"), F.slice(b, F.lit(1), n).alias("b")), lambda z: F.struct(z["a"].alias("name"), z["b"].alias("value")))


def explode_observations(flat: DataFrame) -> DataFrame:
    """One row per observation, and per scenario: data_begin, data_end (texts), value, capacity, OHLC columns."""
    rows = flat.select("*", F.explode_outer("data").alias("o")).drop("data")
    ohlc = F.col("curve_type") == "OHLC"
    scenario = F.col("curve_type") == "SCENARIO_TIMESERIES"
    pairs = F.when(scenario, zip_shorter(F.col("scenario_names"), F.col("o.s"))).otherwise(F.array(F.struct(F.lit(None).cast("string").alias("name"), F.col("o.v").alias("value"))))
    rows = rows.select("*", F.explode_outer(pairs).alias("pair")).drop("scenario_names")
    p = "o.product"
    delivery = F.col(f"{p}.delivery").try_cast("date")
    traded = F.col(f"{p}.traded_at").try_cast("date").cast("timestamp_ntz")
    settled = F.coalesce(*(F.col(f"o.{k}") for k in ("settlement", "close", "open", "high", "low")))
    front = F.col(f"{p}.front")
    return rows.withColumns({
        "data_begin": F.when(ohlc, delivery.cast("string")).otherwise(F.coalesce("o.d", "o.begin")),
        "data_end": F.when(ohlc, S.ohlc_period_end(delivery, F.col(f"{p}.period")).cast("string")).otherwise(F.col("o.end")),
        "value": F.when(ohlc, settled).otherwise(F.col("pair.value")),
        "scenario_name": F.when(ohlc, F.concat(F.lit("front_"), front.cast("string"))).otherwise(F.col("pair.name")),
        "instance_issued": F.when(ohlc, traded).otherwise(F.col("instance_issued")),
        "traded_at": F.when(ohlc, traded),
        "front": F.when(ohlc, front),
        "period": F.when(ohlc, F.col(f"{p}.period")),
        "capacity": F.col("o.capacity"),
        **{k: F.when(ohlc, F.col(f"o.{k}")) for k in ("open", "high", "low", "close", "settlement", "volume", "open_interest")},
    }).drop("o", "pair")


def infer_frequency(df: DataFrame, begin: str, end: str, declared: str, keys: tuple[str, ...] = ("curve_name",), ties: tuple[str, ...] = (), valid: Column | None = None) -> DataFrame:
    """``df`` with effective_frequency: the declared one, or else the length of the interval, the step to the next
    observation of the curve, or the step from the one before; 0 if there is none.

    One pass: rows without a declared frequency are sorted by curve; others, and rows that aren't ``valid``, take no part and are
    spread over many small groups, so a curve that declares its frequency is not gathered in one task."""
    takes_part = (F.coalesce(declared, F.lit(0)) == 0) & (F.lit(True) if valid is None else valid)
    spread = F.when(takes_part, F.lit(-1)).otherwise(F.pmod(F.xxhash64(begin, end, *ties), F.lit(SPREAD)).cast("int"))
    order = W.partitionBy(*keys, "__spread").orderBy(F.coalesce(begin, end), *ties)

    def step(c: str) -> Column:
        ahead = F.timestamp_diff("SECOND", F.col(c), F.lead(c).over(order))
        return F.coalesce(ahead, F.timestamp_diff("SECOND", F.lag(c).over(order), F.col(c)))

    found = F.when(F.col(begin).isNotNull() & F.col(end).isNotNull(), F.timestamp_diff("SECOND", F.col(begin), F.col(end))).when(F.col(begin).isNotNull(), step(begin)).otherwise(step(end))
    effective = F.when(F.col("__spread") < 0, F.coalesce(found, F.lit(0))).otherwise(F.coalesce(F.col(declared), F.lit(0)))
    return df.withColumn("__spread", spread).withColumn("effective_frequency", effective.cast("bigint")).drop("__spread")


def bound_intervals(rows: DataFrame, declared: bool = False) -> DataFrame:
    """Localised times, effective frequencies and interval bounds. The far end goes by the declared frequency;
    the frequency that is stored is the effective one. Rows without a name, value or time are left out after the window,
    in which they take no part: a filter below it would compute the times twice. ``declared``: all rows declare their frequency, so
    nothing is inferred and nothing shuffled."""
    zone = F.coalesce(*(S.blank_to_null(F.col(c)) for c in ("resolution_timezone", "curve_resolution_timezone", "curve_instance_issued_timezone")))
    zoned = rows.withColumn("zone", F.when(F.col("curve_type") == "OHLC", F.coalesce("resolution_timezone", F.lit("UTC"))).otherwise(zone))
    timed = S.localize(S.localize(zoned, "data_begin", "zone", "b", "bo"), "data_end", "zone", "e", "eo")
    valid = F.expr("curve_name IS NOT NULL AND value IS NOT NULL AND (b IS NOT NULL OR e IS NOT NULL)")
    if declared:
        timed = timed.where(valid).withColumn("effective_frequency", F.col("resolution_frequency"))
    else:
        timed = infer_frequency(timed.withColumn("__valid", valid), "b", "e", "resolution_frequency", ties=("value",), valid=F.col("__valid")).where("__valid").drop("__valid")
    timed = timed.withColumns(S.interval_bounds(F.col("b"), F.col("bo"), F.col("e"), F.col("eo"), F.col("resolution_frequency")))
    return timed.withColumn("resolution_frequency", F.col("effective_frequency")).drop("b", "bo", "e", "eo", "zone", "effective_frequency", "data_begin", "data_end")


def observations(flat: DataFrame) -> DataFrame:
    """Bounded observations of flat responses. Whether a response declares its frequency is known before its observations are exploded: those
    that do go straight through, and only the others are dealt by curve and sorted. Responses are written down once, parsed and
    compact, so neither branch parses them again."""
    parsed = cut(flat)
    declares = F.coalesce("resolution_frequency", F.lit(0)) != 0
    straight = bound_intervals(explode_observations(parsed.where(declares)), declared=True)
    return straight.unionByName(bound_intervals(explode_observations(parsed.where(~declares))))


def fill_defaults(rows: DataFrame, catalog: DataFrame | None) -> DataFrame:
    """Null units, frequencies and zones from the catalog (name, unit, denominator, frequency, timezone)."""
    if catalog is None:
        return rows
    defaults = catalog.groupBy(F.col("name").alias("curve_name")).agg(*(F.first(c, ignorenulls=True).alias(f"default_{c}") for c in ("unit", "denominator", "frequency", "timezone")))
    few = defaults.limit(BROADCAST_CURVES + 1).count() <= BROADCAST_CURVES
    defaults = F.broadcast(defaults) if few else defaults.hint("shuffle_hash")  # the wide rows are not sorted
    pairs = {"unit": "unit", "denominator": "denominator", "resolution_frequency": "frequency", "resolution_timezone": "timezone"}
    joined = rows.join(defaults, "curve_name", "left").withColumns({c: F.coalesce(c, f"default_{d}") for c, d in pairs.items()})
    return joined.drop(*(f"default_{d}" for d in pairs.values()))


def identify(rows: DataFrame) -> DataFrame:
    """curve_id and run_hash. The scenario is part of the identity only of kinds that have one."""
    common = {"instance_created": S.hash_time_text(F.col("instance_created")), "instance_modified": S.hash_time_text(F.col("instance_modified")), "instance_tag": F.col("instance_tag"), "unit": F.col("unit"), "denominator": F.col("denominator")}
    with_scenario = canonical_json(curve_name=F.col("curve_name"), scenario_name=F.col("scenario_name"), **common)
    without = canonical_json(curve_name=F.col("curve_name"), **common)
    text = F.when(F.col("curve_type").isin("OHLC", "SCENARIO_TIMESERIES"), with_scenario).otherwise(without)
    return rows.withColumn("identity", text).withColumns({"curve_id": xxh3_64(F.col("curve_name")), "run_hash": xxh3_64(F.col("identity"))}).drop("identity")


def within(rows: DataFrame, begin: str | None = None, end: str | None = None, column: str = "from_timestamp") -> DataFrame:
    """begin <= column < end; texts count as UTC unless they have an offset."""
    limits = F.col(column).isNotNull()
    if "to_timestamp" in rows.columns:
        limits &= F.col("to_timestamp").isNotNull()
    if begin:
        limits &= F.col(column) >= S.utc_time(F.lit(str(begin)))
    if end:
        limits &= F.col(column) < S.utc_time(F.lit(str(end)))
    return rows.where(limits)


def _cast(c: Column, kind: T.DataType, source: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        if not isinstance(source, T.StructType):
            return F.lit(None).cast(kind)
        have = {f.name: f.dataType for f in source.fields}
        made = F.struct(*(_cast(c[f.name], f.dataType, have[f.name]).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields))
        return F.when(c.isNotNull(), made)
    if isinstance(kind, T.ArrayType):
        if not isinstance(source, T.ArrayType):
            return F.lit(None).cast(kind)
        return F.transform(c, lambda x: _cast(x, kind.elementType, source.elementType))
    return c if kind == source else c.try_cast(kind) if isinstance(source, T.StringType) or isinstance(kind, T.NumericType) else c.cast(kind)


def conform(df: DataFrame, schema: T.StructType | None = None, key: str | None = "curve_name") -> DataFrame:
    """Exactly the columns of the schema, in order: leniently cast, null where missing, others dropped; rows without
    the key column's value are left out."""
    schema = schema or curated_schema()
    have = {f.name: f.dataType for f in df.schema.fields}
    out = df.select(*(_cast(F.col(f"`{f.name}`"), f.dataType, have[f.name]).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))
    return out.where(F.col(key).isNotNull()) if key else out


def unexpected_columns(df: DataFrame, schema: T.StructType | None = None) -> list[str]:
    return sorted(set(df.columns) - set((schema or curated_schema()).names))


def curate(responses: DataFrame, catalog: DataFrame | None = None, begin: str | None = None, end: str | None = None) -> DataFrame:
    """Responses (columns of the superset schema) as rows of the curated schema. Needs a UTC session. Parses at once, and leaves the rest to
    the query that uses it."""
    return conform(within(identify(fill_defaults(observations(flatten(responses)), catalog)), begin, end))
