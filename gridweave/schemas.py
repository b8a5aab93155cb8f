"""Table and response schemas. Column metadata carries keys."""

from __future__ import annotations

from pyspark.sql import types as T

_PLACE = "type string, key string, name string, unit string, area string, areas array<string>, location array<double>, fuels array<string>, remit_units array<string>"
_SUBSCRIPTION = "access string, area string, label string, package string, type string"

# The columns of the curated table, in order. "!" marks columns that are never null.
_CURATED = f"""
curve_id! bigint; curve_name! string; curve_access_by string; curve_access_package string; curve_area string; curve_area_sink string;
curve_categories array<string>; curve_commodity string; curve_type! string; curve_data_type! string; curve_denominator string;
curve_source string; curve_subscription struct<{_SUBSCRIPTION}>; curve_place struct<{_PLACE}>; curve_instance_issued_timezone string;
curve_unit string; curve_resolution_frequency bigint; curve_resolution_timezone string; resolution_frequency bigint;
resolution_timezone string; unit string; denominator string; scenario_name string; instance_issued timestamp; instance_tag string;
instance_created timestamp; instance_modified timestamp; run_hash! bigint; from_timestamp! timestamp; from_utc_offset! bigint;
to_timestamp! timestamp; to_utc_offset! bigint; value double; capacity double; open double; high double; low double; close double;
settlement double; volume double; open_interest double; traded_at timestamp; front bigint; period string
"""

# The columns of the catalog table and of the work queue.
_CATALOG = """
curve_id! bigint; curve_name! string; curve_type! string; curve_data_type! string; curve_area string; curve_area_sink string;
curve_commodity string; curve_source string; curve_unit string; curve_denominator string; curve_categories array<string>;
curve_resolution_frequency string; curve_resolution_timezone string; curve_access_by string; curve_access_package string;
curve_instance_issued_timezone string; table_category! string; updated_at! timestamp
"""
_QUEUE = """
request_id! string; curve_name! string; curve_type! string; data_type! string; table_category! string; cluster_key! string;
begin! timestamp; end! timestamp; ensembles! boolean; unit string; mode! string; created_at! timestamp
"""


def _schema(text: str, keys: tuple[str, ...]) -> T.StructType:
    fields = []
    for part in filter(None, map(str.strip, text.replace("\n", " ").split("; "))):
        name, kind = part.split(" ", 1)
        plain = name.rstrip("!")
        tags = {"primary_key": "true"} if plain in keys else {}
        fields.append(T.StructField(plain, T._parse_datatype_string(kind), not name.endswith("!"), tags))
    return T.StructType(fields)


CURATED_KEYS = ("curve_id", "run_hash", "from_timestamp")
#: Rows of the curated table are matched by these.
MERGE_KEYS = ("curve_id", "curve_name", "run_hash", "from_timestamp")


def curated_schema() -> T.StructType:
    return _schema(_CURATED, CURATED_KEYS)


def catalog_schema() -> T.StructType:
    return _schema(_CATALOG, ("curve_id",))


def queue_schema() -> T.StructType:
    return _schema(_QUEUE, ("request_id",))


_CURVE = f"""name string, curve_type string, data_type string, area string, area_sink string, categories array<string>, commodity string,
denominator string, source string, unit string, instance_issued_timezone string, access struct<by string, package string>,
resolution struct<frequency string, timezone string>, subscription struct<{_SUBSCRIPTION}>, place struct<{_PLACE}>"""

#: One superset schema for every kind of response: what a response lacks is null.
CURVE_DDL = f"struct<{_CURVE}>"
RESPONSE_DDL = f"""curve struct<{_CURVE}>, resolution struct<frequency string, timezone string>, unit string,
instance struct<issued string, tag string, created string, modified string>, scenario_names array<string>,
data array<struct<d string, v double, s array<double>, begin string, end string, capacity double, open double, high double, low double,
close double, settlement double, volume double, open_interest double,
product struct<traded_at string, delivery string, period string, front bigint>>>"""
