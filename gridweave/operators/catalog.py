"""The curve catalog: parsing, projection to the catalog table, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.functions import scalars as S
from gridweave.functions.hashing import xxh3_64
from gridweave.schemas import CURVE_DDL, catalog_schema

# The kinds of curves and of data.
CURVE_TYPES = ("TIMESERIES", "SCENARIO_TIMESERIES", "INSTANCE", "INSTANCE_PERIOD", "PERIOD", "OHLC")
DATA_TYPES = ("NORMAL", "ACTUAL", "FORECAST", "REMIT", "OHLC", "CLIMATE", "BACKCAST", "CAPACITY", "FOREX", "SCENARIO", "SYNTHETIC")

# Categories of the preset selection.
PRESET_CATEGORIES = ("Exchange Net Transfer Capacity", "Price Spot", "Consumption", "Hydro Pumped-storage Pumping", "Exchange Day-Ahead Schedule")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Curves from JSON lines."""
    return parse_curves(spark.read.text(path).where("trim(value) <> ''"), "value")


def parse_curves(raw: DataFrame, body: str) -> DataFrame:
    """Curves from JSON texts: blank texts as null, kinds upper-cased with defaults, nulls out of arrays."""
    c = raw.select(F.from_json(body, CURVE_DDL).alias("c")).select("c.*")
    text = {k: S.blank_to_null(F.col(k)) for k in ("name", "area", "area_sink", "commodity", "denominator", "source", "unit", "instance_issued_timezone")}
    kind = lambda k, default: F.coalesce(F.nullif(F.upper(S.blank_to_null(F.col(k))), F.lit("NONE")), F.lit(default))
    frequency = F.when(F.lower("resolution.frequency") != "none", S.blank_to_null(F.col("resolution.frequency")))
    resolution = F.struct(frequency.alias("frequency"), S.blank_to_null(F.col("resolution.timezone")).alias("timezone"))
    return c.withColumns({**text, "data_type": kind("data_type", "NORMAL"), "curve_type": kind("curve_type", "TIMESERIES"), "resolution": resolution, "categories": F.filter("categories", lambda x: x.isNotNull())})


def unknown_kinds(curves: DataFrame) -> DataFrame:
    """Curves whose kinds are none of the known ones."""
    return curves.where(~F.col("curve_type").isin(*CURVE_TYPES) | ~F.col("data_type").isin(*DATA_TYPES))


def catalog_table(curves: DataFrame, now: Column | None = None) -> DataFrame:
    """Rows of the catalog table; access columns stay null there."""
    null = F.lit(None).cast("string")
    return curves.select(
        xxh3_64(F.col("name")).alias("curve_id"),
        F.col("name").alias("curve_name"),
        "curve_type",
        F.col("data_type").alias("curve_data_type"),
        *(F.col(k).alias(f"curve_{k}") for k in ("area", "area_sink", "commodity", "source", "unit", "denominator", "categories")),
        F.col("resolution.frequency").alias("curve_resolution_frequency"),
        F.col("resolution.timezone").alias("curve_resolution_timezone"),
        null.alias("curve_access_by"),
        null.alias("curve_access_package"),
        F.col("instance_issued_timezone").alias("curve_instance_issued_timezone"),
        S.table_category(F.col("data_type"), F.col("curve_type"), F.col("categories")).alias("table_category"),
        (now if now is not None else F.current_timestamp()).alias("updated_at"),
    ).select(*catalog_schema().names)


def name_matches(name: Column, patterns: str | list[str]) -> Column:
    """Case-insensitive: any pattern. Globs match whole names, others a part."""
    return F.lower(name).rlike(S.glob_pattern([patterns] if isinstance(patterns, str) else list(patterns)))


def _listed(value: object) -> list:
    return list(value) if isinstance(value, (list, tuple, set)) else [value]


def search(curves: DataFrame, name: str | list[str] | None = None, **wanted: object) -> DataFrame:
    """Curves that fit all predicates given.

    name: a plain name that exists is that curve alone; else see name_matches. Scalars (curve_type, data_type, area,
    area_sink, commodity, source, unit, denominator, instance_issued_timezone): one of. categories: all of. frequency,
    timezone: one of, null as empty. place_key: one of. place_area: the place's area, or one of its areas. place_fuel: any.
    access_by, access_package: one of."""
    out = curves
    if name is not None:
        plain = isinstance(name, str) and "*" not in name and "?" not in name
        if plain and not curves.where(F.col("name") == name).isEmpty():
            out = out.where(F.col("name") == name)
        else:
            out = out.where(name_matches(F.col("name"), name))
    for key, value in wanted.items():
        if value is None:
            continue
        values = _listed(value)
        arrays = F.array(*map(F.lit, values))
        if key in ("curve_type", "data_type"):
            known = CURVE_TYPES if key == "curve_type" else DATA_TYPES
            if missing := [v for v in values if str(v).upper() not in known]:
                raise KeyError(f"unknown {key}: {missing}")
            out = out.where(F.col(key).isin(*(str(v).upper() for v in values)))
        elif key == "categories":
            out = out.where(F.size(F.array_except(arrays, F.coalesce("categories", F.array().cast("array<string>")))) == 0)
        elif key in ("frequency", "timezone"):
            out = out.where(F.coalesce(f"resolution.{key}", F.lit("")).isin(*values))
        elif key == "place_area":
            out = out.where(F.col("place.area").isin(*values) | F.arrays_overlap("place.areas", arrays))
        elif key == "place_fuel":
            out = out.where(F.arrays_overlap("place.fuels", arrays))
        elif key in ("place_key", "access_by", "access_package"):
            out = out.where(F.col(key.replace("_", ".", 1)).isin(*values))
        elif key in ("area", "area_sink", "commodity", "source", "unit", "denominator", "instance_issued_timezone"):
            out = out.where(F.col(key).isin(*values))
        else:
            raise KeyError(f"unknown predicate: {key}")
    return out


def preset_predicate() -> Column:
    """The preset selection as one predicate over data_type, curve_type and categories."""
    data, kind = F.col("data_type"), F.col("curve_type")
    listed = F.exists("categories", lambda c: c.isin(*PRESET_CATEGORIES))
    holds = lambda word: F.exists("categories", lambda c: c.contains(word))
    series = kind == "TIMESERIES"
    return (
        ((data == "REMIT") & (kind == "INSTANCE_PERIOD") & holds("Capacity Available"))
        | ((data == "FORECAST") & (kind == "INSTANCE") & listed)
        | (data.isin("REMIT", "ACTUAL") & series & listed)
        | (series & (holds("Production") | holds("Consumption")))
    )


def preset_curves(curves: DataFrame) -> DataFrame:
    return curves.where(preset_predicate()).dropDuplicates(["name"])


def curve_data_types(curves: DataFrame) -> DataFrame:
    return curves.select("curve_type", "data_type").distinct()


def with_routes(curves: DataFrame, prefix: str = "") -> DataFrame:
    """Curves with table_category and cluster_key."""
    return curves.withColumns({"table_category": S.table_category(F.col("data_type"), F.col("curve_type"), F.col("categories"), prefix), "cluster_key": S.cluster_key(F.col("data_type"), F.col("curve_type"))})


def categories(curves: DataFrame) -> DataFrame:
    return with_routes(curves).select("table_category").distinct().orderBy("table_category")


def wanted_curves(curves: DataFrame, wanted: DataFrame) -> DataFrame:
    """Curves whose id (a number as text) or name is in ``wanted`` (one text column): the union of both look-ups."""
    texts = wanted.select(F.col(wanted.columns[0]).cast("string").alias("__wanted")).distinct()
    keyed = curves.withColumn("__id", xxh3_64(F.col("name")).cast("string"))
    by = lambda c: keyed.join(texts, keyed[c] == texts["__wanted"], "left_semi")
    others = keyed.join(texts, keyed["name"] == texts["__wanted"], "left_anti")
    return by("name").unionByName(others.join(texts, others["__id"] == texts["__wanted"], "left_semi")).drop("__id")


def missing_curves(curves: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of ``wanted`` (one text column), what is neither a curve's id nor its name."""
    known = curves.select(F.explode(F.array("name", xxh3_64(F.col("name")).cast("string"))).alias("__known"))
    texts = wanted.select(F.col(wanted.columns[0]).cast("string").alias("wanted")).where("wanted IS NOT NULL").distinct()
    return texts.join(known, F.col("wanted") == F.col("__known"), "left_anti")


def missing_categories(curves: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of ``wanted`` (one text column), the table categories that no curve has."""
    texts = wanted.select(F.col(wanted.columns[0]).alias("wanted")).where("wanted IS NOT NULL").distinct()
    return texts.join(with_routes(curves).select(F.col("table_category").alias("wanted")), "wanted", "left_anti")


def _texts(curves: DataFrame, values: list[str]) -> DataFrame:
    return curves.sparkSession.createDataFrame([(v,) for v in values], "wanted string")


def select_curves(curves: DataFrame, table_categories: list[str] | None = None, ids: list[str] | DataFrame | None = None) -> DataFrame:
    """Curves of the categories, and among the ids (numbers as text) or names: a list, or a frame of one text column."""
    out = with_routes(curves)
    if table_categories:
        out = out.where(F.col("table_category").isin(*table_categories))
    if isinstance(ids, DataFrame) or ids:
        out = wanted_curves(out, ids if isinstance(ids, DataFrame) else _texts(curves, ids))
    return out


def check_scope(curves: DataFrame, table_categories: list[str] | None = None, ids: list[str] | None = None) -> None:
    """ValueError for categories or ids that no curve has; it names the first of them."""
    for what, values, missing in (("categories", table_categories, missing_categories), ("curves", ids, missing_curves)):
        if values and (found := sorted(r[0] for r in missing(curves, _texts(curves, values)).limit(20).collect())):
            raise ValueError(f"unknown {what}: {found}")


def curve_tags(request_tags: Column | None = None) -> Column:
    """Name, area, unit, commodity, kinds and categories of a curve as a map, without nulls; with the request's own tags (a map), which take
    the place of the curve's."""
    pairs = F.create_map(*(x for k in ("name", "area", "unit", "commodity", "data_type", "curve_type") for x in (F.lit(k), F.col(k))), F.lit("categories"), F.nullif(F.array_join("categories", ","), F.lit("")))
    own = F.map_filter(pairs, lambda _, v: v.isNotNull() & (v != ""))
    if request_tags is None:
        return own
    given = F.coalesce(request_tags, F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(own, lambda k, _: ~F.map_contains_key(given, k)), given)
