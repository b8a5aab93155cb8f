"""Best-fit-decreasing packing into fixed-length rows of token ids.

Documents are encoded, ended by an end token, and gathered into blocks of a bounded number of ids. Documents
longer than a row are split without loss into whole rows and a tail. The tails of a block are placed by falling
length into the row with the least room that is enough; a segment tree over room sizes finds it
in logarithmic time. Rows are padded to the capacity, so the ids of successive rows form a matrix.

Each row has input_ids (capacity numbers: unsigned 16 bits where the vocabulary allows, else 32; little-endian), n_tokens
before padding, cu_seqlens (0 and the cumulative segment lengths), position_ids (unsigned 16 or 32 bits, starting from 0 in every
segment), and per segment doc_ids and starts (its place in its document's ids). ``token_files`` writes these rows as matrix files.

Cases: null and empty texts are a single end token, and nothing is dropped. A text of any length is cut into as many rows as it needs.
Repeated rows, and rows of equal or null ids, are packed one by one, with their ids as they are. Pieces of equal length
keep the order in which they were read, so ties have one result for one order of rows. An empty table gives an empty one. Other columns take no part, whatever
their names. Byte sequences that aren't UTF-8 are encoded as U+FFFD, one for each that a decoder would replace.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm import textkernel as K
from gridweave.llm.bpe import TextEncoder, encoded_slices

CAPACITY, BLOCK_IDS = 2048, 8_000_000
_LOCAL_BITS = 36


class RoomTree:
    """Segment tree over room sizes: how many rows have each room, and the least room not below a bound."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, change: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += change
            at >>= 1

    def least(self, room: int) -> int:
        """The least room of ``room`` or more that some row has; -1 if there is none."""
        count, at = self.count, room + self.leaves
        if count[at]:
            return room
        while at > 1:
            if not at & 1 and count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return -1


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Rows of item numbers; items of equal length keep their order."""
    tree, by_room, rows = RoomTree(capacity), [[] for _ in range(capacity + 1)], []
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        room = tree.least(size)
        if room < 0:
            room, row = capacity, len(rows)
            rows.append([])
        else:
            row = by_room[room].pop()
            tree.add(room, -1)
        rows[row].append(item)
        if room > size:
            by_room[room - size].append(row)
            tree.add(room - size, 1)
    return rows


def _packed(path: str, capacity: int, end_id: int, pad_id: int, block: int):
    @K.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(path, trie=False)
        kind = np.dtype("<u2" if len(encoder.model.bytes_of) <= 1 << 16 else "<u4")
        spots = np.dtype("<u2" if capacity <= 1 << 16 else "<u4")
        counting = np.arange(capacity, dtype=spots)
        sequence = TaskContext.get().partitionId() << _LOCAL_BITS
        docs, pieces, held, id_type = [], [], 0, pa.int64()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            segments = [(doc, start, own[start : start + capacity]) for doc, own in zip(docs, pieces, strict=True) for start in range(0, len(own), capacity)]
            rows = best_fit_decreasing(np.array([len(x[2]) for x in segments], np.int64), capacity)
            for at in range(0, len(rows), 2000):
                out: list[list] = [[] for _ in range(7)]
                for row in rows[at : at + 2000]:
                    own = [segments[k] for k in row]
                    sizes = [len(x[2]) for x in own]
                    total = sum(sizes)
                    ids = np.full(capacity, pad_id, kind)
                    ids[:total] = np.concatenate([x[2] for x in own])
                    places = np.concatenate([*(counting[:k] for k in sizes), counting[: capacity - total]])
                    values = (sequence, total, ids.tobytes(), places.tobytes(), np.concatenate(([0], np.cumsum(sizes))).tolist(), [x[0] for x in own], [x[1] for x in own])
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                    sequence += 1
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(id_type), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["sequence_id", "n_tokens", "input_ids", "position_ids", "cu_seqlens", "doc_ids", "starts"])

        for batch in batches:
            id_type = batch.column("doc_id").type
            for a, b, ids, at in encoded_slices(batch, "text", encoder):
                docs += batch.column("doc_id").slice(a, b - a).to_pylist()
                pieces += [np.append(ids[i:j], np.uint32(end_id)).astype(kind) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                held += int(at[-1]) + b - a
                if held >= block:
                    yield from flush()
                    docs, pieces, held = [], [], 0
        if docs:
            yield from flush()

    return run


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 50256, pad_id: int = 50256, block: int = BLOCK_IDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    named = docs.select(F.col(doc_id).alias("doc_id"), F.make_valid_utf8(text).alias("text"))
    kind = dict(named.dtypes)["doc_id"]
    schema = f"sequence_id bigint, n_tokens bigint, input_ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<{kind}>, starts array<bigint>"
    return named.mapInArrow(_packed(path, capacity, end_id, pad_id, block), schema)
