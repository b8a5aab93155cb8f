"""Scalar column functions; all are built from Catalyst expressions.

Local times are handled as TIMESTAMP_NTZ in UTC, so nothing depends on the session's time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAS_DAY = "Europe/Gas_Day"
GAS_DAY_ZONE, GAS_DAY_HOURS = "Europe/Paris", 6

# Seconds of each part of a duration; years and months have nominal lengths.
_PART_SECONDS = {"Y": 365 * 86400, "M": 30 * 86400, "W": 7 * 86400, "D": 86400, "h": 3600, "m": 60, "s": 1}
_DURATION = r"^P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?"

# Time-zone names of the data source and the IANA names they stand for.
ZONE_ALIASES = {"CEST": "CET", "WEST": "WET", "EEST": "EET", "Z": "UTC", "GMT": "UTC", "Etc/UTC": "UTC", "Etc/GMT": "UTC"}

# How far each OHLC period reaches.
_PERIOD_DAYS = {"day": 1, "week": 7, "weekend": 2}
_PERIOD_MONTHS = {"month": 1, "quarter": 3, "season": 6, "year": 12}


def _number(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def iso_duration_seconds(c: Column) -> Column:
    """Seconds of an ISO-8601 duration of whole numbers; 0 where there is none."""
    text = F.upper(F.trim(c))
    total = F.lit(0).cast("bigint")
    for n, seconds in enumerate(_PART_SECONDS.values(), 1):
        total = total + _number(F.regexp_extract(text, _DURATION, n)) * seconds
    return F.when(text.rlike("^P"), total).otherwise(F.lit(0).cast("bigint"))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def unit_of(c: Column) -> Column:
    """The text before the first slash."""
    return blank_to_null(F.regexp_extract(c, r"^([^/]*)", 1))


def denominator_of(c: Column) -> Column:
    """The text after the last slash; null if there is none."""
    return blank_to_null(F.regexp_extract(c, r"/([^/]*)$", 1))


def normal_time_text(c: Column) -> Column:
    """Trimmed; Z as +00:00; with seconds."""
    text = F.regexp_replace(F.trim(c), "Z$", "+00:00")
    return F.regexp_replace(text, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})([+-]\d{2}:\d{2})?$", "$1:00$2")


def _given_offset(text: Column) -> Column:
    """Signed seconds of the trailing ±HH:MM of a normal time text; null if there is none."""
    digits = F.regexp_extract(text, r"\d{2}:\d{2}.*([+-]\d{2}:\d{2})$", 1)
    size = F.substring(digits, 2, 2).try_cast("bigint") * 3600 + F.substring(digits, 5, 2).try_cast("bigint") * 60
    return F.when(F.substring(digits, 1, 1) == "-", -size).otherwise(size)


def offset_seconds(c: Column) -> Column:
    """Signed seconds of a trailing ±HH:MM; 0 where there is none; null stays null."""
    text = normal_time_text(c)
    return F.when(text.isNotNull(), F.coalesce(_given_offset(text), F.lit(0).cast("bigint")))


def _shift(ntz: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ntz)


def local_part(c: Column) -> Column:
    """The wall-clock time of a text, without its offset; null if it can't be parsed."""
    return F.regexp_replace(normal_time_text(c), r"(:\d{2}[0-9.]*)[+-]\d{2}:\d{2}$", "$1").try_cast("timestamp_ntz")


def utc_time(c: Column) -> Column:
    """A text with an offset (none: UTC) as UTC time."""
    return _shift(local_part(c), -offset_seconds(c))


def to_utc(ntz: Column, zone: Column) -> Column:
    """Wall-clock time in a zone as UTC. Of an ambiguous time the earlier instant; a time that a clock change
    skips is null."""
    gas = zone == GAS_DAY
    real = F.coalesce(F.when(gas, F.lit(GAS_DAY_ZONE)).otherwise(F.nullif(zone, F.lit(""))), F.lit("UTC"))
    local = F.when(gas, _shift(ntz, F.lit(GAS_DAY_HOURS * 3600))).otherwise(ntz)
    utc = F.convert_timezone(real, F.lit("UTC"), local)
    return F.when(F.convert_timezone(F.lit("UTC"), real, utc) == local, utc)


def standard_offset(utc: Column, zone: Column) -> Column:
    """Seconds by which a zone's standard time is ahead of UTC in the year of ``utc``: the lesser of its offsets in
    January and July."""
    real = F.coalesce(F.when(zone == GAS_DAY, F.lit(GAS_DAY_ZONE)).otherwise(F.nullif(zone, F.lit(""))), F.lit("UTC"))

    def at(month: int) -> Column:
        day = F.make_date(F.year(utc), F.lit(month), F.lit(1)).cast("timestamp_ntz")
        return F.timestamp_diff("SECOND", day, F.convert_timezone(F.lit("UTC"), real, day))

    return F.least(at(1), at(7))


def localize(df: DataFrame, text: str, zone: str, utc: str, offset: str) -> DataFrame:
    """``df`` with a text's UTC time and its offset in seconds. Texts with an offset keep it; others are wall-clock times of
    the zone, with its standard offset. The steps are columns of their own, so no step is computed twice."""
    own = {k: f"__{utc}_{k}" for k in ("text", "given", "local")}
    out = df.withColumn(own["text"], normal_time_text(F.col(text)))
    pure = F.regexp_replace(own["text"], r"(:\d{2}[0-9.]*)[+-]\d{2}:\d{2}$", "$1").try_cast("timestamp_ntz")
    out = out.withColumns({own["given"]: _given_offset(F.col(own["text"])), own["local"]: pure})
    given, local = F.col(own["given"]), F.col(own["local"])
    out = out.withColumn(utc, F.when(given.isNotNull(), _shift(local, -given)).otherwise(to_utc(local, F.col(zone))))
    return out.withColumn(offset, F.when(F.col(utc).isNotNull(), F.coalesce(given, standard_offset(F.col(utc), F.col(zone))))).drop(*own.values())


def normal_zone(c: Column, aliases: dict[str, str] | None = None) -> Column:
    """Zone names that the data source abbreviates, as IANA names, in any case; others, known or not, stay as they are. ``aliases`` are further
    ones, which come first."""
    table = {k.upper(): v for k, v in (ZONE_ALIASES | (aliases or {})).items()}
    text = blank_to_null(c)
    names = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.coalesce(names[F.upper(text)], text)


def instant(c: Column, now: Column) -> Column:
    """A text as UTC time: "now" (in any case) is ``now``; a day, or a time with or without an offset (none: UTC); else null."""
    text = F.trim(c)
    day = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date").cast("timestamp_ntz"))
    return F.when(F.lower(text) == "now", now.cast("timestamp_ntz")).otherwise(F.coalesce(day, utc_time(text)))


def ohlc_period_end(delivery: Column, period: Column) -> Column:
    """The day on which a delivery period ends; unknown periods end when they begin."""
    kind = F.lower(F.trim(period))
    out = delivery
    for name, days in _PERIOD_DAYS.items():
        out = F.when(kind == name, F.date_add(delivery, days)).otherwise(out)
    for name, months in _PERIOD_MONTHS.items():
        out = F.when(kind == name, F.add_months(delivery, months)).otherwise(out)
    return out


def interval_bounds(begin: Column, begin_offset: Column, end: Column, end_offset: Column, frequency: Column) -> dict[str, Column]:
    """from/to times and offsets: a declared frequency decides the far end; else the known ends stand."""
    regular = frequency > 0
    ahead, back = _shift(begin, frequency), _shift(end, -frequency)
    return {
        "from_timestamp": F.coalesce(begin, F.when(regular, back).otherwise(end)),
        "from_utc_offset": F.when(begin.isNotNull(), begin_offset).otherwise(end_offset),
        "to_timestamp": F.when(begin.isNotNull() & regular, ahead).otherwise(F.coalesce(end, begin)),
        "to_utc_offset": F.when(end.isNotNull(), end_offset).otherwise(begin_offset),
    }


def safe_name(c: Column) -> Column:
    """Lower case; everything but a-z and 0-9 as single underscores inside."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def _named(c: Column) -> Column:
    return F.coalesce(F.nullif(safe_name(c), F.lit("")), F.lit("none"))


def cluster_key(data_type: Column, curve_type: Column) -> Column:
    return F.concat_ws("_", _named(data_type), _named(curve_type))


def table_category(data_type: Column, curve_type: Column, categories: Column, prefix: str = "") -> Column:
    """The table a curve is routed to: data type, curve type and its first two categories."""
    first = F.filter(F.transform(F.slice(F.coalesce(categories, F.array().cast("array<string>")), 1, 2), safe_name), lambda x: x != "")
    front = [F.nullif(safe_name(F.lit(prefix)), F.lit(""))] if prefix else []
    return F.concat_ws("_", *front, _named(data_type), _named(curve_type), first)


def eur_unit(unit: Column) -> Column:
    return F.regexp_replace(unit, "GBP|USD", "EUR")


def is_foreign(unit: Column) -> Column:
    return F.coalesce(unit.rlike("GBP|USD"), F.lit(False))


def iso_text(ntz: Column) -> Column:
    return F.date_format(ntz, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def hash_time_text(ntz: Column) -> Column:
    return F.date_format(ntz, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def zone_matters(frequency: Column) -> Column:
    """Whether a time zone changes data of this frequency: not for days and longer."""
    return frequency.isNull() | ~frequency.rlike("^P") | frequency.contains("T")


def effective_zone(curve_type: Column, frequency: Column, zone: Column) -> Column:
    return F.when((curve_type != "OHLC") & zone_matters(frequency), F.coalesce(request_zone(zone), F.lit("UTC")))


def request_zone(zone: Column) -> Column:
    text = blank_to_null(zone)
    return F.when(text.isin("UTC", "Z", "Etc/UTC"), F.lit("UTC")).otherwise(text)


def fetch_interval(frequency: Column) -> Column:
    return F.when(F.coalesce(frequency, F.lit("PT1H")).startswith("PT"), F.lit("P1M")).otherwise(F.lit("P1Y"))


def page_limit(curve_type: Column, ensembles: Column, wanted: Column) -> Column:
    most = F.when(curve_type == "INSTANCE", F.when(ensembles, 10).otherwise(25)).when(curve_type == "INSTANCE_PERIOD", 20)
    return F.when(most.isNotNull(), F.greatest(F.lit(1), F.least(F.coalesce(wanted, most), most)))


def issue_bucket(ntz: Column, hours: int = 4) -> Column:
    """The start of the block of hours that a time is in."""
    day = F.date_trunc("DAY", ntz).cast("timestamp_ntz")
    return F.timestamp_add("HOUR", (F.floor(F.hour(ntz) / hours) * hours).cast("int"), day)


def next_full_hour(ntz: Column) -> Column:
    """The start of the hour after the one that a time is in."""
    return F.timestamp_add("HOUR", F.lit(1), F.date_trunc("HOUR", ntz).cast("timestamp_ntz"))


def glob_pattern(patterns: list[str]) -> str:
    """One regular expression for lower-cased names: globs match whole names, other patterns anywhere."""
    def quoted(text: str) -> str:
        return "".join(ch if ch.isalnum() or ch.isspace() else "\\" + ch for ch in text)

    def one(p: str) -> str:
        if "*" not in p and "?" not in p:
            return quoted(p)
        return "^" + "".join({"*": ".*", "?": "."}.get(ch, quoted(ch)) for ch in p) + "$"

    return "|".join(f"(?:{one(p.lower())})" for p in patterns)
