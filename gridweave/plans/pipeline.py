"""Dispatch and ingestion: events or whole categories become queue rows; the queue is fetched, curated, routed, written
and, if all writes succeeded, drained."""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridweave.operators import catalog as C
from gridweave.operators.curation import curate, parse_responses
from gridweave.plans import requests as Q
from gridweave.schemas import MERGE_KEYS, catalog_schema, curated_schema
from gridweave.shared import cut
from gridweave.sources.responses import only_new
from gridweave.sources.routed import RoutedTables
from gridweave.sources.tables import UPSERT, KeyedTable, resolve_mode

BACKFILL_SECONDS = 3600


@dataclass
class Config:
    """seconds: length of the window before ``end`` (a time in UTC; None: now, without fractions)."""

    seconds: int = 3600
    end: str | None = None
    mode: str = UPSERT
    table_categories: list[str] = field(default_factory=list)
    curve_ids: list[str] = field(default_factory=list)

    @property
    def backfill(self) -> bool:
        return self.seconds > BACKFILL_SECONDS

    def pinned(self) -> Config:
        """The same, with ``end`` as a fixed time: what is planned with it is the same in every job."""
        return self if self.end else replace(self, end=dt.datetime.now(dt.UTC).strftime("%Y-%m-%d %H:%M:%S"))

    def window(self):
        end = F.lit(self.end).cast("timestamp") if self.end else F.date_trunc("SECOND", F.current_timestamp())
        return F.timestamp_add("SECOND", F.lit(-self.seconds), end), end


def plan_queue(curves: DataFrame, config: Config, events: DataFrame | None = None, now: Column | None = None) -> DataFrame:
    """Queue rows of the curves in scope: all in a backfill, else those with events."""
    C.check_scope(curves, config.table_categories, config.curve_ids)
    chosen = C.select_curves(curves, config.table_categories, config.curve_ids)
    if not config.backfill and events is not None:
        chosen = chosen.join(events.select(F.col("curve_name").alias("name")).distinct(), "name", "left_semi")
    begin, end = config.window()
    return Q.queue_rows(chosen, begin, end, config.mode, F.current_timestamp() if now is None else now)


def refresh_metadata(curves: DataFrame, table: KeyedTable, mode: str | None = UPSERT) -> DataFrame:
    """Write one row per curve to the catalog table, by curve_id; returns the rows. RuntimeError for an empty catalog."""
    rows = C.catalog_table(curves)
    if rows.isEmpty():
        raise RuntimeError("no curves found")
    table.create().insert(rows, mode)
    return rows


def metadata_table(spark: SparkSession, folder: str, buckets: int = 4) -> KeyedTable:
    return KeyedTable(spark, f"{folder}/curated_curve_metadata", catalog_schema(), ["curve_id"], buckets)


def sql_over(frame: DataFrame, query: str) -> DataFrame:
    """Rows of a query over ``frame``, which it names {self}."""
    return frame.sparkSession.sql(query.replace("{self}", "{frame}"), frame=frame)


#: How a step ended, for its caller.
DISPATCHED, NO_NEW_DATA, NO_CATEGORIES = "dispatched", "no_new_data", "no_categories"
INGESTED, EMPTY, FAILED = "ingested", "empty", "failed"
DRAINED, KEPT, NOTHING_PENDING = "drained", "kept", "nothing_pending"


def early_exit(rows: DataFrame, config: Config) -> str | None:
    """Why there is nothing to dispatch: no curve in scope has news, or none is in scope; None if there is."""
    if not rows.isEmpty():
        return None
    return NO_CATEGORIES if config.backfill else NO_NEW_DATA


@dataclass
class Dispatched:
    """jobs: table_category, cluster_key, requests, of what was queued; status: DISPATCHED, or why nothing was."""

    status: str
    jobs: DataFrame


def dispatch(curves: DataFrame, queue: KeyedTable, config: Config, events: DataFrame | None = None) -> Dispatched:
    """Write the queue. The window's end and the time of creation are taken once, and the rows are written down once: what is queued
    and what is returned are the same."""
    now = F.lit(dt.datetime.now(dt.UTC))
    rows = cut(plan_queue(curves, config.pinned(), events, now))
    status = early_exit(rows, config)
    if not status:
        queue.insert(rows, UPSERT)
    jobs = rows.groupBy("table_category").agg(F.min("cluster_key").alias("cluster_key"), F.count("*").alias("requests")).orderBy("table_category")
    return Dispatched(status or DISPATCHED, jobs)


def pending_curves(queue: DataFrame, curves: DataFrame, category: str) -> DataFrame:
    """Curves of a category that the queue holds; all of them if it holds none."""
    routed = C.with_routes(curves).where(F.col("table_category") == category)
    waiting = queue.where(F.col("table_category") == category).select(F.col("curve_name").alias("name")).distinct()
    return routed if waiting.isEmpty() else routed.join(waiting, "name", "left_semi")


def route(curated: DataFrame, curves: DataFrame) -> DataFrame:
    """Curated rows with the table they go to; rows of unknown curves go nowhere. The curves are what a task holds: the wide rows are not sorted."""
    routes = C.with_routes(curves).select(F.col("name").alias("curve_name"), "table_category").dropDuplicates(["curve_name"])
    return curated.join(routes.hint("shuffle_hash"), "curve_name")


def _counted(found: Observation) -> dict[str, int]:
    """What was observed; nothing where the engine found beforehand that there are no rows, and left the step out."""
    try:
        return {k: v or 0 for k, v in found.get.items()}
    except Py4JJavaError:
        return {}


def ingest(spark: SparkSession, responses: DataFrame, curves: DataFrame, tables: RoutedTables, mode: str | None = None, begin: str | None = None, end: str | None = None, cached: DataFrame | None = None, insert_all: bool = False) -> dict:
    """Curate stored responses (ok, body; url if there are ``cached`` ones) and write all routes in one job.

    Of responses whose url is in ``cached`` none is taken up again, unless ``insert_all``. Counted on the way, in the same pass: batches (one, if
    there was any response), responses, failed_responses (not ok), curation_failures (bodies that aren't JSON: these won't get better, and don't keep the
    queue from being drained), curated_rows, inserts (routes written) and routes (rows by route). A job that fails is one insert failure, with its
    reason; nothing is written then. status is EMPTY if there was no row to write."""
    resolve_mode(mode)
    started = time.time()
    stats = {"batches": 0, "responses": 0, "failed_responses": 0, "curation_failures": 0, "curated_rows": 0, "inserts": 0, "insert_failures": 0, "routes": {}, "reason": None}
    catalog = curves.select("name", "unit", "denominator", F.lit(None).cast("bigint").alias("frequency"), F.col("resolution.timezone").alias("timezone"))
    taken = responses if cached is None or insert_all else only_new(responses, cached)
    came, parsed, made = Observation(), Observation(), Observation()
    ok = F.coalesce(F.col("ok"), F.lit(False))
    seen = taken.observe(came, F.count(F.lit(1)).alias("responses"), F.count_if(~ok).alias("failed_responses"))
    bodies = parse_responses(seen, ok="ok", malformed="bad_body").observe(parsed, F.count("bad_body").alias("curation_failures"))
    try:
        rows = route(curate(bodies, catalog, begin, end), curves).observe(made, F.count(F.lit(1)).alias("curated_rows"))
        stats["routes"] = tables.write(rows, mode)
        for found in (came, parsed, made):
            stats |= _counted(found)
        stats |= {"inserts": len(stats["routes"]), "batches": int(stats["responses"] > 0)}
    except Exception as e:  # counted: the caller decides whether to try again
        stats |= {"insert_failures": 1, "reason": f"{type(e).__name__}: {e}"[:500]}
    status = FAILED if stats["insert_failures"] else INGESTED if stats["inserts"] else EMPTY
    return stats | {"status": status, "elapsed": time.time() - started}


def curated_tables(spark: SparkSession, folder: str, buckets: int = 16) -> RoutedTables:
    """All curated tables, one for each route."""
    return RoutedTables(spark, f"{folder}/curated", curated_schema(), list(MERGE_KEYS), "curve_id", buckets=buckets)


def curves_by_table(curves: DataFrame) -> DataFrame:
    """table_category, curves, names (sorted) and ids of every route."""
    routed = C.catalog_table(curves).select("table_category", F.col("curve_name").alias("name"), F.col("curve_id").alias("id")).distinct()
    return routed.groupBy("table_category").agg(F.count("*").alias("curves"), F.array_sort(F.collect_list("name")).alias("names"), F.array_sort(F.collect_list("id")).alias("ids"))


def drain(queue: KeyedTable, category: str, ingested: DataFrame, stats: dict) -> str:
    """Take ingested requests off the queue, unless a write failed: DRAINED, KEPT (a write failed), or NOTHING_PENDING."""
    if stats["insert_failures"]:
        return KEPT
    done = queue.read().where(F.col("table_category") == category).join(ingested.select("curve_name").distinct(), "curve_name", "left_semi")
    gone = cut(done.select("request_id"))
    if gone.isEmpty():
        return NOTHING_PENDING
    queue.delete(gone)
    return DRAINED
