"""Sources: stored responses, a fetcher over partitions, and the raw cache."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.functions import scalars as S
from gridweave.shared import cut
from gridweave.sources.tables import APPEND, UPSERT, KeyedTable

RAW_DDL = "url string, ok boolean, status int, body string"
RAW_COLUMNS = ["url", "ok", "status", "body"]


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Responses stored as JSON lines."""
    return spark.read.schema(RAW_DDL).json(path)


def fetch(requests: DataFrame, send: Callable[[str, dict], tuple[int, str]], parallel: int = 64, retries: int = 0, pause: float = 0.5) -> DataFrame:
    """Responses of requests (url, params). ``send`` runs on the executors, once per request; it returns status and body.
    With ``retries``, a request that raises or gets a status of 429 or 500 and more is sent again, after pauses that double. A
    request that still raises is a row with ok false and the message as body."""

    def sent(url: str, params: dict) -> tuple[int, str]:
        for attempt in range(retries + 1):
            try:
                status, body = send(url, params)
                if attempt == retries or (status != 429 and status < 500):
                    return status, body
            except Exception as e:  # a failed request must not lose the others
                if attempt == retries:
                    return 0, str(e)
            time.sleep(pause * 2**attempt)
        raise AssertionError

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                status, body = sent(r["url"], dict(r["params"] or {}))
                rows.append((r["url"], 200 <= status < 300, status, body))
            kinds = [pa.string(), pa.bool_(), pa.int32(), pa.string()]
            columns = zip(*rows, strict=True) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["url", "ok", "status", "body"])

    return requests.select("url", "params").repartition(parallel).mapInArrow(run, RAW_DDL)


def only_new(responses: DataFrame, cached: DataFrame) -> DataFrame:
    """Responses whose url the cache lacks."""
    return responses.join(cached.select("url").distinct(), "url", "left_anti")


def cache_raw(responses: DataFrame, cache: KeyedTable, upsert: bool | str) -> None:
    """Keep raw responses by url: those that may change (see plans.requests.must_upsert) are replaced, others stay as first
    stored. ``upsert`` holds for all, or names the column by which each response says whether it may replace another, in one
    write."""
    kept = [*RAW_COLUMNS, upsert] if isinstance(upsert, str) else RAW_COLUMNS
    rows = responses.where("ok").select(*kept)
    if isinstance(upsert, str):
        cache.insert(rows, APPEND, replace=upsert)
    else:
        cache.insert(rows, UPSERT if upsert else APPEND)


def catalog_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """Curves from a CSV whose nested columns are written as literals (single quotes, or double ones around apostrophes; None)."""
    raw = spark.read.csv(path, header=True, quote='"', escape='"')

    def literal(c: str, ddl: str):
        # None where a value stands, not inside a text
        text = F.regexp_replace(c, r"""((?:^|[\[{:,])\s*)None(?=\s*(?:$|[\]},]))(?=(?:[^'"]|'[^']*'|"[^"]*")*$)""", "$1null")
        return F.from_json(text, ddl, {"allowSingleQuotes": "true"})

    return raw.withColumns({"categories": literal("categories", "array<string>"), "resolution": literal("resolution", "struct<frequency string, timezone string>")})


def check_cache(cache: KeyedTable | bool | None, table: Callable[[], KeyedTable], deployed: bool) -> KeyedTable | None:
    """Which table caches: None: the usual one where ``deployed``; True or False: it or none; a table is itself."""
    if cache is None:
        cache = deployed
    return (table() if cache else None) if isinstance(cache, bool) else cache


class CachedCatalog:
    """The curve catalog from ``load``, kept as a Parquet snapshot with a life time. Snapshots are named by when they were taken,
    so sessions share them and a stale one is never read."""

    def __init__(self, spark: SparkSession, folder: str, load: Callable[[], DataFrame], seconds: float = 7 * 86400):
        self.spark, self.folder, self.load, self.seconds = spark, folder.rstrip("/"), load, seconds
        self._taken, self._curves = 0.0, None

    def _latest(self) -> float:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return 0.0
        done = [f.getPath().getName() for f in fs.listStatus(path) if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
        return max((float(n[9:]) for n in done if n.startswith("snapshot-")), default=0.0)

    def read(self, now: float | None = None) -> DataFrame:
        now = time.time() if now is None else now
        if self._curves is None or now - self._taken > self.seconds:
            self._taken = self._latest()
            if now - self._taken > self.seconds:
                self._taken = round(now, 3)
                self.load().write.parquet(f"{self.folder}/snapshot-{self._taken:.3f}")
            self._curves = self.spark.read.parquet(f"{self.folder}/snapshot-{self._taken:.3f}")
        return self._curves


_PAGE = "array<struct<issued string, created string, modified string, tag string>>"


def page_instances(requests: DataFrame, send: Callable[[str, dict], tuple[int, str]], now: object, parallel: int = 64, hours: int = 4) -> DataFrame:
    """curve_name, issued, created, modified, tag: the issues of instance curves, listed backwards page by page.

    requests: curve_name, curve_type, issued_earliest (may be null), issued_latest (null: now), tags. All open listings ask for their
    next page at once, on the executors; a page is asked for once, as rounds are written down. A listing ends with a
    failed, empty or short page, or when its oldest issue reaches the start of the earliest block of hours; else it goes on
    from the block of its oldest issue, or one block back if that is no earlier. Issues outside the range are left out, and
    repeated ones (time and tag) count once."""
    kind = F.col("curve_type")
    path = F.concat(F.when(kind == "INSTANCE", F.lit("instances")).otherwise(F.lit("period-instances")), F.lit("/"), F.regexp_replace(F.url_encode("curve_name"), r"\+", "%20"), F.lit("/list/"))
    block = lambda c: S.issue_bucket(c, hours)
    latest = F.coalesce("issued_latest", F.lit(now).cast("timestamp_ntz"))
    listing = requests.where(kind.isin("INSTANCE", "INSTANCE_PERIOD")).select("curve_name", path.alias("url"), F.when(kind == "INSTANCE", 25).otherwise(20).alias("limit"), "issued_earliest", latest.alias("issued_latest"), "tags")
    open_ = cut(listing.distinct().withColumn("cursor", F.timestamp_add("HOUR", F.lit(hours), block(F.col("issued_latest")))))
    found = []
    while not open_.isEmpty():
        tags = F.when(F.size("tags") > 0, F.array_join("tags", ","))
        params = F.map_filter(F.create_map(F.lit("limit"), F.col("limit").cast("string"), F.lit("issued-at-latest"), S.iso_text(F.col("cursor")), F.lit("tags"), tags), lambda _, v: v.isNotNull())
        asked = open_.withColumn("params", params)
        pages = fetch(asked.select("url", "params"), lambda url, p: _keyed(send, url, p), parallel).select(F.get_json_object("body", "$.key").alias("key"), "ok", F.from_json(F.get_json_object("body", "$.body"), _PAGE).alias("page")).dropDuplicates(["key"])
        got = cut(asked.withColumn("key", F.to_json(F.struct("url", F.array_sort(F.map_entries("params")).alias("params")))).join(pages, "key").where("ok AND size(page) > 0"))
        issues = got.select("curve_name", "issued_earliest", "issued_latest", F.inline("page")).select("curve_name", "issued_earliest", "issued_latest", *(S.utc_time(F.col(c)).alias(c) for c in ("issued", "created", "modified")), S.blank_to_null(F.col("tag")).alias("tag"))
        found.append(issues.where("issued <= issued_latest AND (issued_earliest IS NULL OR issued >= issued_earliest)").select("curve_name", "issued", "created", "modified", "tag"))
        oldest = F.array_min(F.transform("page", lambda r: S.utc_time(r["issued"])))
        on = got.withColumn("oldest", oldest).where(F.size("page") >= F.col("limit")).where(F.col("oldest").isNotNull() & (F.col("issued_earliest").isNull() | (F.col("oldest") > block(F.col("issued_earliest")))))
        back = F.when(block(F.col("oldest")) < F.col("cursor"), block(F.col("oldest"))).otherwise(F.timestamp_add("HOUR", F.lit(-hours), F.col("cursor")))
        open_ = cut(on.withColumn("cursor", back).select(*open_.columns))
    if not found:
        return listing.sparkSession.createDataFrame([], "curve_name string, issued timestamp_ntz, created timestamp_ntz, modified timestamp_ntz, tag string")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out.dropDuplicates(["curve_name", "issued", "tag"])


def _keyed(send: Callable[[str, dict], tuple[int, str]], url: str, params: dict) -> tuple[int, str]:
    """The response with what was asked, so that a page finds its listing."""
    status, body = send(url, params)
    key = {"url": url, "params": [{"key": k, "value": params[k]} for k in sorted(params)]}
    return status, json.dumps({"key": json.dumps(key, separators=(",", ":")), "body": body})
