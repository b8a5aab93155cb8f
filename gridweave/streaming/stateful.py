"""Events by lanes: repeats dropped by a bounded memory of recent keys, batches closed by number or age.

A lane is a value of a column that the caller chooses: one for all events gives one sequence of batches, a hash of the curve
gives as many as the cluster has tasks. A lane's state is its open batch (at most the batch size) and the keys seen last (at most the
bound), in the state store: both survive restarts with the query's checkpoint. Within a micro-batch a lane's events are taken in
the order of time and id, so results don't depend on how rows were dealt.

A task holds a part of a lane's events at a time, however many a micro-batch brings: they come in and go out by blocks, each as one packed
value, and are sorted in runs on the local disk.

Needs the RocksDB state store (see ``use_state``).
"""

from __future__ import annotations

import heapq
import os
import pickle
import tempfile
from collections import OrderedDict
from collections.abc import Iterable, Iterator
from itertools import batched, islice
from typing import IO

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DISCONNECTED = "DISCONNECTED"
SIZE, TIME, DISCONNECT = "size", "time", "disconnect"
#: Keys that are remembered unless another bound is given.
RECENT = 512
#: Events that are sorted in memory, and events of a block that goes to disk or out of the task.
RUN, BLOCK = 100_000, 2_000


def use_state(spark: SparkSession) -> None:
    """Let the session's queries keep state of this kind."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


class Recent:
    """The keys seen last, least recent first, up to a bound; one that is seen again becomes the most recent."""

    def __init__(self, bound: int, keys: list[str]):
        self.bound, self.keys = bound, OrderedDict.fromkeys(keys)

    def repeated(self, key: str) -> bool:
        known = key in self.keys
        self.keys[key] = None
        self.keys.move_to_end(key)
        while len(self.keys) > self.bound:
            self.keys.popitem(last=False)
        return known


def in_order(events: Iterable[tuple], run: int = RUN, block: int = BLOCK) -> Iterator[tuple]:
    """``events`` sorted by their first element. More than a run are sorted run by run, and merged from the task's local disk."""
    rest, runs, first = iter(events), [], lambda e: e[0]

    def read(file: IO[bytes], blocks: int) -> Iterator[tuple]:
        file.seek(0)
        for _ in range(blocks):
            yield from pickle.load(file)

    while part := sorted(islice(rest, run), key=first):
        if not runs and len(part) < run:
            return iter(part)
        file = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
        blocks = 0
        for some in batched(part, block):
            pickle.dump(some, file, pickle.HIGHEST_PROTOCOL)
            blocks += 1
        runs.append(read(file, blocks))
    return heapq.merge(*runs, key=first)


class LaneProcessor(StatefulProcessor):
    """Rows are (lane as text, packed); what is given out is (batch, place, reason, event), the event as it was packed. size None: batches end by
    age alone; 0: no batches, events pass as they are, with batch -1."""

    def __init__(self, size: int | None, seconds: float | None, recent: int):
        self.size, self.seconds, self.bound = size, seconds, recent

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", T.StructType().add("event", T.BinaryType()))
        self.recent = handle.getListState("recent", T.StructType().add("key", T.StringType()))
        self.mark = handle.getValueState("mark", T.StructType().add("number", T.LongType()).add("due", T.LongType()))

    def _blocks(self, made: Iterable[tuple]) -> Iterator[pd.DataFrame]:
        for some in batched(made, BLOCK):
            yield pd.DataFrame(some, columns=["batch", "place", "reason", "event"])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        yield from self._blocks(self._taken((pickle.loads(x) for block in rows for x in block["packed"]), timerValues))

    def _taken(self, events: Iterable[tuple], timerValues) -> Iterator[tuple]:
        number, due = self.mark.get() if self.mark.exists() else (0, -1)
        recent = Recent(self.bound, [k for (k,) in self.recent.get()]) if self.bound > 0 and self.recent.exists() else Recent(self.bound, [])
        batch = [bytes(x) for (x,) in self.open.get()] if self.open.exists() else []
        was_due, fresh = due, not batch
        for _, own_key, control, event in in_order(events):
            reason = None
            if control:
                reason = DISCONNECT
            elif self.bound <= 0 or not recent.repeated(own_key):
                if self.size == 0:
                    yield -1, 0, None, event
                    continue
                batch.append(event)
                reason = SIZE if self.size is not None and len(batch) >= self.size else None
            if reason and batch:
                for place, own in enumerate(batch):
                    yield number, place, reason, own
                number, batch, fresh = number + 1, [], True
        if fresh:
            due = timerValues.getCurrentProcessingTimeInMs() + int(self.seconds * 1000) if batch and self.seconds is not None else -1
        if due != was_due:
            if was_due >= 0:
                self.handle.deleteTimer(was_due)
            if due >= 0:
                self.handle.registerTimer(due)
        self.open.put([(x,) for x in batch]) if batch else self.open.clear()
        if self.bound > 0:
            self.recent.put([(k,) for k in recent.keys])
        self.mark.update((number, due))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, due = self.mark.get() if self.mark.exists() else (0, -1)
        if due == expiredTimerInfo.getExpiryTimeInMs() and self.open.exists():
            yield from self._blocks([(number, place, TIME, bytes(own)) for place, (own,) in enumerate(self.open.get())])
            self.open.clear()
            self.mark.update((number + 1, -1))

    def close(self) -> None:
        pass


def _packed(names: list[str], order: list[str]):
    """Of each row of (__lane, __key, __control, lane, event columns): the lane as text, and (order, key, control, packed lane and event)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            ranks = zip(*([(x is not None, x) for x in columns[c]] for c in order), strict=True)
            events = (pickle.dumps(x, pickle.HIGHEST_PROTOCOL) for x in zip(*(columns[c] for c in names), strict=True))
            packed = [pickle.dumps(x, pickle.HIGHEST_PROTOCOL) for x in zip(ranks, columns["__key"], columns["__control"], events, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("__lane"), pa.array(packed, pa.binary())], ["__lane", "packed"])

    return run


def _unpacked(out: T.StructType, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(out)
        for batch in batches:
            columns = dict(zip(names, zip(*map(pickle.loads, batch.column("event").to_pylist()), strict=True), strict=True)) if batch.num_rows else dict.fromkeys(names, ())
            columns |= {c: batch.column(c).to_pylist() for c in ("place", "reason")} | {"batch": [None if x < 0 else x for x in batch.column("batch").to_pylist()]}
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in kinds], schema=kinds)

    return run


def _by_lane(events: DataFrame, lane: Column, keys: list[str], order: list[str], size: int | None, seconds: float | None, recent: int, lanes: DataFrame | None = None) -> DataFrame:
    use_state(events.sparkSession)
    control = F.coalesce(F.col("event_type") == DISCONNECTED, F.lit(False)) if "event_type" in events.columns else F.lit(False)
    key = F.to_json(F.struct(*(F.col(k) for k in keys)), {"ignoreNullFields": "false"})
    text = F.to_json(F.struct(lane.alias("lane")))  # the lane as a text that isn't null, whatever its type
    rows = events.select(text.alias("__lane"), key.alias("__key"), control.alias("__control"), lane.alias("lane"), *(F.col(c) for c in events.columns))
    out = T.StructType([rows.schema["lane"], T.StructField("batch", T.LongType()), T.StructField("place", T.IntegerType()), T.StructField("reason", T.StringType()), *events.schema.fields])
    names = ["lane", *events.columns]
    timed = "ProcessingTime" if seconds is not None and size != 0 else "None"
    made = rows.mapInArrow(_packed(names, order), "__lane string, packed binary").groupBy("__lane").transformWithStateInPandas(LaneProcessor(size, seconds, recent), "batch bigint, place int, reason string, event binary", "Append", timed)
    return made.mapInArrow(_unpacked(out, names), out)


def batch_events(events: DataFrame, size: int | None = 1, seconds: float | None = 300.0, lane: Column | None = None, recent: int = 0, keys: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """``events`` (a stream) with lane, batch (numbered from 0 in its lane), place in the batch, and reason: a batch is given out when it has
    ``size`` events, or ``seconds`` after its first one arrived, though nothing else arrives, or when the source says that it
    disconnected (an event of that type; it belongs to no batch). With ``recent``, repeats are dropped first. Timers are looked at
    with each trigger. The last, open batch of a query that ends stays in its state, for the next start."""
    if size is not None and size < 1:
        raise ValueError("a batch has one event at least")
    return _by_lane(events, F.lit(0) if lane is None else lane, keys or ["event_id"], order or ["ts", "event_id"], size, seconds, recent)


def deduplicate_recent(events: DataFrame, bound: int = RECENT, keys: list[str] | None = None, lane: Column | None = None, order: list[str] | None = None) -> DataFrame:
    """``events`` (a stream) without those whose key is among the last ``bound`` different keys of their lane, however late they come; a key
    further back passes again. A repeat makes its key the most recent. 0: all pass. Without a lane, one lane for each hash of the key
    in 64: repeats are in one lane, and each remembers ``bound`` keys."""
    if bound <= 0:
        return events
    keys = keys or ["event_id"]
    own = F.pmod(F.xxhash64(*keys), F.lit(64)).cast("int") if lane is None else lane
    return _by_lane(events, own, keys, order or ["ts", "event_id"], 0, None, bound).drop("lane", "batch", "place", "reason")
