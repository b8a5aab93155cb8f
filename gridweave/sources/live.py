"""Live sources as data sources of the engine: an event log that can be read again from any offset, a catalog in pages, and
a sender that keeps several calls in flight.

A source is made around a client, which is pickled to where it is used: the driver asks only for the newest offset or the number of
rows, executors fetch the rows themselves.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from typing import Protocol
from urllib.request import urlopen

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from gridweave.sources.responses import RAW_DDL

# ---- events


class EventLog(Protocol):
    """What an event server offers: events are numbered, and kept for long enough to be read again after a failure."""

    def newest(self) -> int:
        """How many events there are so far."""

    def between(self, start: int, end: int) -> Iterable[tuple]:
        """Events number start to end - 1, as tuples of the schema."""


class HttpEventLog:
    """An event log behind HTTP: ``<url>/newest`` answers with a number, ``<url>/events?start=&end=`` with a JSON object a line. Times
    are ISO texts; fields that an event lacks are null."""

    def __init__(self, url: str, schema: str, timeout: float = 30.0):
        self.url, self.fields, self.timeout = url.rstrip("/"), T.StructType.fromDDL(schema).fields, timeout

    def _get(self, path: str) -> str:
        with urlopen(f"{self.url}/{path}", timeout=self.timeout) as answer:
            return answer.read().decode()

    def newest(self) -> int:
        return int(self._get("newest"))

    def between(self, start: int, end: int) -> Iterator[tuple]:
        at = lambda f, v: dt.datetime.fromisoformat(v) if v is not None and isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else v
        for line in self._get(f"events?start={start}&end={end}").splitlines():
            event = json.loads(line)
            yield tuple(at(f, event.get(f.name)) for f in self.fields)


class _Span(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


class _EventReader(DataSourceStreamReader):
    """Offsets are numbers of events. A trigger takes at most ``most`` of them (None: all there are), from where the last one ended, dealt to tasks in
    spans."""

    def __init__(self, log: EventLog, first: int, most: int | None, span: int):
        self.log, self.first, self.most, self.span, self.reached = log, first, most, span, None

    def initialOffset(self) -> dict:
        return {"events": self.first}

    def latestOffset(self) -> dict:
        newest = self.log.newest()
        if self.most is None or self.reached is None:  # a new reader doesn't know where the query stands until partitions() tells
            return {"events": newest}
        return {"events": max(self.reached, min(newest, self.reached + self.most))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.reached = end["events"]
        return [_Span(k, min(k + self.span, end["events"])) for k in range(start["events"], end["events"], self.span)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from self.log.between(partition.start, partition.end)

    def commit(self, end: dict) -> None:
        self.reached = max(self.reached or 0, end["events"])


def event_source(log: EventLog, schema: str, name: str = "curve_events") -> type[DataSource]:
    """A streaming data source over ``log``. Options: first (the event to begin with), span (events of a task), and most (events of
    a trigger; the first one of each start takes all there are). A query that takes what is available now has one trigger, so for these leave ``most`` out."""

    class Events(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: ARG002
            most = self.options.get("most")
            return _EventReader(log, int(self.options.get("first", 0)), int(most) if most else None, int(self.options.get("span", 10_000)))

    return Events


def live_events(spark: SparkSession, log: EventLog, schema: str, first: int = 0, most: int | None = None, span: int = 10_000, name: str = "curve_events") -> DataFrame:
    """The log as a stream. Its place is in the query's checkpoint: after a restart the same events are read again, so what is written by
    key has none lost and none twice. A query that takes what is available now may, after a failure, only repeat the failed batch: newer
    events are then left to its next start."""
    spark.dataSource.register(event_source(log, schema, name))
    return spark.readStream.format(name).options(first=first, span=span, **({"most": most} if most else {})).load()


# ---- catalog


class _Pages(DataSourceReader):
    def __init__(self, count: Callable[[], int], page: Callable[[int, int], Iterable[tuple]], size: int):
        self.count, self.page, self.size = count, page, size

    def partitions(self) -> list[InputPartition]:
        n = self.count()
        return [_Span(k, min(n, k + self.size)) for k in range(0, n, self.size)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from self.page(partition.start, partition.end)


def paged_source(count: Callable[[], int], page: Callable[[int, int], Iterable[tuple]], schema: str, size: int = 5000, name: str = "curve_catalog") -> type[DataSource]:
    """A batch data source: ``count`` rows, of which a task fetches a page (first, end). Made for the curve catalog."""

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:  # noqa: ARG002
            return _Pages(count, page, int(self.options.get("size", size)))

    return Paged


def live_catalog(spark: SparkSession, count: Callable[[], int], page: Callable[[int, int], Iterable[tuple]], schema: str, size: int = 5000, name: str = "curve_catalog") -> DataFrame:
    spark.dataSource.register(paged_source(count, page, schema, size, name))
    return spark.read.format(name).load()


# ---- requests

#: status, body, and the seconds after which to ask again if the server says so.
Answer = tuple[int, str, float | None]


class Sender:
    """Sends requests with up to ``flight`` calls at a time, ``rate`` new ones a second at most. A call that raises, or is answered with 429 or
    500 and more, is made again up to ``retries`` times: after what the server asks for, or else pauses that double. Waiting
    calls don't hold a place in flight. Answers come as they are ready."""

    def __init__(self, send: Callable[[str, dict], Answer], flight: int = 16, rate: float | None = None, retries: int = 5, pause: float = 0.5, most_pause: float = 60.0):
        self.send, self.flight, self.rate, self.retries, self.pause, self.most_pause = send, flight, rate, retries, pause, most_pause

    def _delay(self, attempt: int, answer: Answer | None) -> float:
        asked = answer[2] if answer and answer[2] is not None else self.pause * 2**attempt
        return min(self.most_pause, asked)

    def run(self, requests: Iterator[tuple[str, dict]]) -> Iterator[tuple[str, int, str]]:
        """(url, status, body) of every request, once; status 0 and the message as body of one that still raises."""
        later: deque[tuple[float, int, str, dict]] = deque()
        running: dict[Future, tuple[int, str, dict]] = {}
        next_call, ended = 0.0, False
        with ThreadPoolExecutor(self.flight) as pool:
            while True:
                now = time.monotonic()
                while len(running) < self.flight and now >= next_call:
                    due = min(later, default=None, key=lambda x: x[0])
                    if due and due[0] <= now:
                        later.remove(due)
                        attempt, url, params = due[1:]
                    elif not ended and len(later) < 4 * self.flight and (new := next(requests, None)) is not None:
                        attempt, (url, params) = 0, new
                    else:
                        ended = ended or len(later) < 4 * self.flight
                        break
                    running[pool.submit(self.send, url, params)] = attempt, url, params
                    next_call = now + (1 / self.rate if self.rate else 0)
                if ended and not running and not later:
                    return
                waits = [x[0] - now for x in later] + ([next_call - now] if not ended or later else [])
                timeout = max(0.0, min((w for w in waits if w > 0), default=0.05)) if len(running) < self.flight else None
                if running:
                    done, _ = wait(running, timeout, FIRST_COMPLETED)
                else:
                    time.sleep(timeout or 0.0)
                    done = ()
                for call in done:
                    attempt, url, params = running.pop(call)
                    try:
                        answer, error = call.result(), None
                    except Exception as e:  # a failed request must not lose the others
                        answer, error = None, str(e)
                    again = answer is None or answer[0] == 429 or answer[0] >= 500
                    if again and attempt < self.retries:
                        later.append((time.monotonic() + self._delay(attempt, answer), attempt + 1, url, params))
                    else:
                        yield (url, 0, error or "") if answer is None else (url, answer[0], answer[1])


def send_all(requests: DataFrame, send: Callable[[str, dict], Answer], tasks: int = 64, flight: int = 16, rate: float | None = None, retries: int = 5, pause: float = 0.5, batch: int = 256) -> DataFrame:
    """Responses (url, ok, status, body) of requests (url, params), each sent by one of ``tasks`` tasks. ``rate`` is the number of calls a
    second that all tasks together may begin, if all run at once. Bodies are handed on in small batches, so a task holds few."""
    own = rate / tasks if rate else None
    kinds = [pa.string(), pa.bool_(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = ((r["url"], dict(r["params"] or {})) for b in batches for r in b.to_pylist())
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["url", "ok", "status", "body"])
            rows.clear()
            return made

        for url, status, body in Sender(send, flight, own, retries, pause).run(asked):
            rows.append((url, 200 <= status < 300, status, body))
            if len(rows) == batch:
                yield out()
        if rows:
            yield out()

    dealt = requests.select("url", "params").repartition(tasks, F.xxhash64("url", F.to_json("params")))
    return dealt.mapInArrow(run, RAW_DDL)
