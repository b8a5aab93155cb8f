"""Bounded-space online packing of token ids into windows of a fixed capacity.

Every partition keeps a fixed number of open windows. A document's whole windows go out at once; its tail goes
into the open window where it fits best. If none fits and no further window may be opened, the fullest is
emitted. At the end of a partition the open windows are left over; those of up to ``MERGED_PARTITIONS``
partitions are merged by best fit. Memory is bounded by the open windows, so there is one pass over
the documents, and a lost executor costs only its own partitions.

Cases: null and empty texts are a single end token. Documents are never dropped, however long; ids lie in exactly one piece.
Repeated rows, and rows of equal or null ids, are packed one by one. Of windows that fit equally well the one opened first
is taken, so ties have one result for one order of rows. An empty table gives an empty one. Other columns take no part, whatever their names.
Byte sequences that aren't UTF-8 are encoded as U+FFFD, one for each that a decoder would replace.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm import textkernel as K
from gridweave.llm.bpe import TextEncoder, encoded_slices
from gridweave.llm.spark_util import cut

CAPACITY, OPEN_WINDOWS, MERGED_PARTITIONS = 1024, 128, 64
#: Sequences are numbered by partition and, within it, by order.
_LOCAL_BITS = 36

_FIELDS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_TYPES = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


class BestFit:
    """Windows by the room left in them; finds the least room that is enough."""

    def __init__(self, capacity: int):
        self.windows: list[list] = [[] for _ in range(capacity + 1)]
        self.rooms, self.count = 0, 0

    def put(self, room: int, window: object) -> None:
        self.windows[room].append(window)
        self.rooms |= 1 << room
        self.count += 1

    def take(self, room: int) -> tuple[int, object]:
        """The window with the least room of ``room`` or more; (-1, None) if there is none."""
        rooms = self.rooms >> room
        if not rooms:
            return -1, None
        room += (rooms & -rooms).bit_length() - 1
        window = self.windows[room].pop()
        if not self.windows[room]:
            self.rooms ^= 1 << room
        self.count -= 1
        return room, window


class _Rows:
    """Pieces of finished windows, as columns."""

    def __init__(self, with_ids: bool):
        self.columns: list[list] = [[] for _ in range(9 if with_ids else 8)]
        self.with_ids = with_ids

    def add(self, window: list[tuple], sequence: int, leftover: bool) -> None:
        offset = 0
        for doc, start, ids, total in window:
            raw = ids.tobytes()
            row = (doc, start, len(ids), zlib.crc32(raw), total, sequence, offset, leftover)
            for column, value in zip(self.columns, (*row, raw) if self.with_ids else row, strict=True):
                column.append(value)
            offset += len(ids)

    def flush(self, kind: pa.DataType) -> pa.RecordBatch:
        kinds = [kind, *[pa.int64()] * 6, pa.bool_(), pa.binary()]
        names = [*_FIELDS, "leftover", "ids"]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.columns, kinds, strict=False)], names[: len(self.columns)])
        self.columns = [[] for _ in self.columns]
        return out


def _pack(path: str, capacity: int, most_open: int, end_id: int, with_ids: bool):
    @K.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, open_windows, rows = TextEncoder(path, trie=False), BestFit(capacity), _Rows(with_ids)
        sequence = (TaskContext.get().partitionId()) << _LOCAL_BITS
        kind = pa.int64()
        for batch in batches:
            kind = batch.column("doc_id").type
            for a, b, ids, at in encoded_slices(batch, "text", encoder):
                for doc, i, j in zip(batch.column("doc_id").slice(a, b - a).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                    own = np.append(ids[i:j], np.uint32(end_id)).astype("<u4")
                    total = len(own)
                    tail = total - total % capacity
                    for start in range(0, tail, capacity):
                        rows.add([(doc, start, own[start : start + capacity], total)], sequence, False)
                        sequence += 1
                    if tail == total:
                        continue
                    piece = (doc, tail, own[tail:].copy(), total)
                    room, window = open_windows.take(total - tail)
                    if window is None:
                        if open_windows.count >= most_open:
                            _, fullest = open_windows.take(0)
                            rows.add(fullest, sequence, False)
                            sequence += 1
                        room, window = capacity, []
                    window.append(piece)
                    if room == total - tail:
                        rows.add(window, sequence, False)
                        sequence += 1
                    else:
                        open_windows.put(room - total + tail, window)
                yield rows.flush(kind)
        while open_windows.count:
            rows.add(open_windows.take(0)[1], sequence, True)
            sequence += 1
        yield rows.flush(kind)

    return run


def _merge(capacity: int, names: list[str]):
    """Left-over windows of some partitions, by falling length, each into the window where it fits best."""

    @K.tidy_group
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        sequence, length = table.column("sequence_id").to_numpy(), table.column("length").to_numpy()
        windows, where = np.unique(sequence, return_inverse=True)
        filled = np.bincount(where, length, len(windows)).astype(np.int64)
        fit, new, base = BestFit(capacity), windows.copy(), np.zeros(len(windows), np.int64)
        for k in np.lexsort((windows, -filled)).tolist():
            size = int(filled[k])
            room, first = fit.take(size)
            if first is None:
                room, first = capacity, k
            new[k], base[k] = windows[first], capacity - room
            fit.put(room - size, first)
        columns = {c: table.column(c) for c in names}
        columns["sequence_id"] = pa.array(new[where])
        columns["offset"] = pa.array(table.column("offset").to_numpy() + base[where])
        yield from pa.table(columns).to_batches()

    return run


def pack_online(docs: DataFrame, path: str, capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with ``with_ids``
    the ids as little-endian unsigned 32-bit numbers."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.make_valid_utf8(text).alias("text"))
    schema = f"doc_id {dict(named.dtypes)['doc_id']}, {_TYPES}"
    ids = ", ids binary" if with_ids else ""
    names = [*_FIELDS, *["ids"] * with_ids]
    placed = cut(named.mapInArrow(_pack(path, capacity, open_windows, end_id, with_ids), f"{schema}, leftover boolean{ids}"))
    group = F.shiftright("sequence_id", _LOCAL_BITS + MERGED_PARTITIONS.bit_length() - 1)
    merged = placed.where("leftover").groupBy(group.alias("part")).applyInArrow(_merge(capacity, names), f"{schema}{ids}")
    return placed.where("NOT leftover").select(*names).unionByName(merged)
