"""Curve-update events as a stream: filters, deduplication, joins with the catalog, idempotent writes.

Progress is the query's checkpoint, back pressure its rate limits, and a bounded drain is the availableNow trigger. Repeats are found by
event id within a watermark, or among the last keys (``streaming.stateful``). A query that fails or falls silent is started again from its checkpoint.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from gridweave.streaming import stateful

EVENT_DDL = "event_id string, event_type string, ts timestamp, curve_name string, begin timestamp, end timestamp, tags array<string>, area string, data_type string, commodity string, categories array<string>"
CURVE_UPDATE = "CURVE_UPDATE"


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 100, kind: str = "json") -> DataFrame:
    return spark.readStream.schema(EVENT_DDL).option("maxFilesPerTrigger", files_per_trigger).format(kind).load(path)


def filter_events(events: DataFrame, event_types: list[str] | None = None, tags: list[str] | None = None, exclude_tags: list[str] | None = None, areas: list[str] | None = None, data_types: list[str] | None = None, commodities: list[str] | None = None, categories: list[str] | None = None, exact_categories: list[str] | None = None, begin: object = None, end: object = None) -> DataFrame:
    """Attribute filters; those that are given must all hold."""
    out = events
    for column, values in (("event_type", event_types), ("area", areas), ("data_type", data_types), ("commodity", commodities)):
        if values:
            out = out.where(F.col(column).isin(*values))
    some = lambda c, values: F.coalesce(F.arrays_overlap(c, F.array(*map(F.lit, values))), F.lit(False))
    if tags:
        out = out.where(some("tags", tags))
    if exclude_tags:
        out = out.where(~some("tags", exclude_tags))
    if categories:
        out = out.where(some("categories", categories))
    if exact_categories:
        out = out.where(F.array_sort("categories") == F.array_sort(F.array(*map(F.lit, exact_categories))))
    if begin is not None:
        out = out.where(F.col("end").isNull() | (F.col("end") >= F.lit(begin)))
    if end is not None:
        out = out.where(F.col("begin").isNull() | (F.col("begin") < F.lit(end)))
    return out


def data_types_of(curves: DataFrame, curve_types: list[str]) -> DataFrame:
    """The data types that curves of some curve types have."""
    return curves.where(F.col("curve_type").isin(*curve_types)).select("data_type").distinct()


def deduplicate(events: DataFrame, keys: list[str] | None = None, delay: str = "10 minutes") -> DataFrame:
    keys = keys or ["event_id"]
    if events.isStreaming:
        return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)
    return events.dropDuplicates(keys)


def join_curves(events: DataFrame, curves: DataFrame, curve_types: list[str] | None = None, names: list[str] | None = None) -> DataFrame:
    """Update events of known curves with the curves' columns; unknown ones are left out."""
    dim = curves.where(F.col("curve_type").isin(*curve_types)) if curve_types else curves
    dim = dim.where(F.col("name").isin(*names)) if names else dim
    dim = dim.select(F.col("name").alias("curve_name"), "curve_type", F.col("data_type").alias("curve_data_type"), F.col("unit").alias("curve_unit"), F.col("categories").alias("curve_categories"))
    return events.where(F.col("event_type") == CURVE_UPDATE).join(dim, "curve_name")


def last_per_curve(events: DataFrame) -> DataFrame:
    """The latest event of each curve of a batch."""
    ranked = events.groupBy("curve_name").agg(F.max_by(F.struct(*[c for c in events.columns if c != "curve_name"]), F.struct("ts", "event_id")).alias("e"))
    return ranked.select("curve_name", "e.*")


def drain(events: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, seconds: float | None = None) -> StreamingQuery:
    """Handle all that has arrived, in micro-batches, and stop. A batch may come again after a failure: ``handle`` must
    be idempotent, as keyed writes are. With ``seconds``, TimeoutError if it takes longer: what was handled by then is in the
    checkpoint, and the next call goes on from there."""
    query = events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"not all events were handled within {seconds} s")
    return query


class Idle(TimeoutError):
    """No event came for as long as was allowed."""


def _await(query: StreamingQuery, idle_seconds: float | None, poll: float) -> None:
    """Wait until the query ends; Idle if it takes in no row for ``idle_seconds``."""
    active, seen = time.monotonic(), None
    while not query.awaitTermination(poll if idle_seconds is None else min(poll, idle_seconds)):
        progress = query.lastProgress
        if progress is not None and progress["batchId"] != seen:
            seen = progress["batchId"]
            if progress["numInputRows"]:
                active = time.monotonic()
        if idle_seconds is not None and time.monotonic() - active >= idle_seconds:
            query.stop()
            raise Idle(f"no event for {idle_seconds} s")


def follow(events: DataFrame | Callable[[], DataFrame], handle: Callable[[DataFrame, int], None], checkpoint: str, every: str = "300 seconds", restarts: int = 0, backoff: float = 1.0, most: float = 30.0, idle_seconds: float | None = None) -> StreamingQuery:
    """Handle batches as they come, at most one in each interval; how many files a batch takes at most is the reader's limit.
    With ``restarts``, waits and starts a failed query again from its checkpoint, so often and after pauses that double. With ``idle_seconds``
    too, a query that takes in nothing for so long counts as failed: it is stopped and started anew, which connects its source again
    (``events`` as a function makes a new one). A query that gets events has all its restarts before it again."""
    make = events if callable(events) else lambda: events
    attempt = 0
    while True:
        query = make().writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
        if not restarts:
            return query
        try:
            _await(query, idle_seconds, 1.0)
            return query
        except (StreamingQueryException, Idle):
            if any(p["numInputRows"] for p in query.recentProgress):
                attempt = 0
            if attempt == restarts:
                raise
            time.sleep(min(most, backoff * 2**attempt))
            attempt += 1


def stream(spark: SparkSession, source: str | DataFrame, curves: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, batch_files: int = 100, every: str | None = None, curve_types: list[str] | None = None, names: list[str] | None = None, delay: str | None = "10 minutes", recent: int = 0, batch_size: int | None = 0, batch_seconds: float | None = None, restarts: int = 0, idle_seconds: float | None = None, **filters: object) -> StreamingQuery:
    """Update events of known curves, filtered, each once. ``source``: a folder of event files, or a stream of events (see
    ``sources.live``). Repeats are found within ``delay`` of event time, or with ``recent`` among so many last keys. Without ``batch_size``, ``handle`` gets what a
    trigger brings; with it (None: no bound), rows come with batch, place and reason, in batches that are closed by number or, with
    ``batch_seconds``, by age. If only curve types are asked for, events are first reduced to the data types that curves of these have. Without
    ``every``, all that has arrived is handled, which leaves no time for batches to close by age."""
    if batch_seconds is not None and not every:
        raise ValueError("batches close by age only in a query that goes on: name an interval")
    if curve_types and not filters.get("data_types"):
        filters["data_types"] = [r[0] for r in data_types_of(curves, curve_types).collect()]  # a handful of kinds
    arrived = read_events(spark, source, batch_files) if isinstance(source, str) else source
    kept = filter_events(arrived, **filters)
    by_number = recent > 0 or batch_size != 0
    events = join_curves(kept if by_number else deduplicate(kept, delay=delay), curves, curve_types, names)
    if by_number:
        events = stateful.batch_events(events, batch_size, batch_seconds, recent=recent) if batch_size != 0 else stateful.deduplicate_recent(events, recent)
    return follow(events, handle, checkpoint, every, restarts, idle_seconds=idle_seconds) if every else drain(events, handle, checkpoint)


class Progress(StreamingQueryListener):
    """Counts batches and rows of all queries and hands a line per batch to ``say``; idle: seconds since a query last took in rows, by its
    id."""

    def __init__(self, say: Callable[[str], None] = print):
        self.say, self.batches, self.rows, self.idle, self._active = say, 0, 0, {}, {}

    def onQueryStarted(self, event) -> None:
        self._active[str(event.id)] = time.monotonic()
        self.say(f"started {event.name or event.id}")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            self._active[str(p.id)], self.idle[str(p.id)] = time.monotonic(), 0.0
        self.batches += 1
        self.rows += p.numInputRows
        self.say(f"batch {p.batchId}: {p.numInputRows} rows, {self.rows} in {self.batches} batches")

    def onQueryIdle(self, event) -> None:
        own = str(event.id)
        self.idle[own] = time.monotonic() - self._active.setdefault(own, time.monotonic())

    def onQueryTerminated(self, event) -> None:
        self.say(f"ended {event.id}" + (f": {event.exception}" if event.exception else ""))
