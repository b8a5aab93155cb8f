"""Quality rules with cross-document line frequency.

Each document gets counts of its own (words, symbols, repeated lines and windows). Its lines are
normalised (A-Z lower-cased, digits as 0, white space runs as one blank), hashed, and counted over the
distinct documents of its host; a document counts once for a line, however often it has it. Lines in more documents than the limit
are removed; a document that loses more than ``max_removed`` of its words is depleted and rejected.

Null and empty texts have no words and fail the base rules. A null host counts as the empty host. Every row is a document:
repeated rows, and rows of equal or null ids, count one by one and are kept or rejected alike, as no step joins on ids. A line
in exactly as many documents as the limit stays. An empty table gives an empty one. Other columns are carried along by
``apply_quality_rules`` whatever their names, and left out by ``quality_rules``. Byte sequences that aren't UTF-8 are words like others
where texts are counted, and become U+FFFD where texts are rewritten.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridweave.llm import textkernel as K
from gridweave.llm.spark_util import BROADCAST_ROWS, cut, spread_join

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: A line in more documents of its host than this is limited. The number does not grow with the host.
LINE_DOCS = 50
MAX_REMOVED = 0.5

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_STATS, _LINES = ", ".join(f"{c} bigint" for c in _COUNTS), "lines array<struct<h: bigint, w: bigint>>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _per_doc(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between each pair of neighbouring bounds."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: whether another entry has its key; whether an earlier one has it."""
    if not len(keys):
        return np.zeros(0, bool), np.zeros(0, bool)
    order = np.argsort(keys, kind="stable")
    same = np.concatenate(([False], keys[order][1:] == keys[order][:-1]))
    earlier, any_other = np.empty(len(keys), bool), np.empty(len(keys), bool)
    earlier[order] = same
    any_other[order] = same | np.concatenate((same[1:], [False]))
    return any_other, earlier


class _Lines:
    """Lines of a slice that hold a word, with their documents."""

    def __init__(self, words: K.Words):
        data, offsets = words.data, words.offsets
        breaks = np.flatnonzero(data == 10) + 1
        starts = np.union1d(offsets[:-1][np.diff(offsets) > 0], breaks[breaks < len(data)])
        # a break at a text's end starts an empty line, whose place is the next text's start
        self.starts, self.ends = starts, np.concatenate((starts[1:], [len(data)]))[: len(starts)]
        first = np.searchsorted(words.starts, self.starts)
        self.n_words = np.searchsorted(words.starts, self.ends) - first
        keep = self.n_words > 0
        self.starts, self.ends, self.n_words, self.first = self.starts[keep], self.ends[keep], self.n_words[keep], first[keep]
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1

    def normal_hashes(self, words: K.Words) -> np.ndarray:
        return K.run_hashes(words.hashes("normal"), self.n_words)


def _slice_stats(data: np.ndarray, offsets: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
    n = len(offsets) - 1
    words = K.Words(data, offsets)
    out = {"n_words": np.diff(words.of_doc)}
    out["word_chars"] = _per_doc(words.inside & ((data & 0xC0) != 0x80), offsets)
    out["n_symbols"] = _per_doc(_SYMBOL[data], offsets)
    lines = _Lines(words)
    salt = K.random_table(n, 7)
    # exact lines: each runs up to its line break, which is not part of it
    stop = np.where(data[lines.ends - 1] == 10, lines.ends - 1, lines.ends) if len(lines.ends) else lines.ends
    raw = K.run_hashes(K._BYTE_CODE[data[np.repeat(lines.starts, stop - lines.starts) + K.ranges(stop - lines.starts)]], stop - lines.starts)
    _, earlier = _repeated(raw ^ salt[lines.doc])
    line_bounds = np.searchsorted(lines.doc, np.arange(n + 1))
    out["n_dup_lines"] = _per_doc(earlier, line_bounds)
    spans = K.windows(words.hashes(), WINDOW)
    doc_of_word = np.repeat(np.arange(n), out["n_words"])
    inside = doc_of_word[: len(spans)] == doc_of_word[WINDOW - 1 :] if len(spans) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    again, _ = _repeated(spans[at] ^ salt[doc_of_word[at]])
    cover = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + WINDOW, -1)
    out["n_repeat_words"] = _per_doc(np.cumsum(cover[:-1]) > 0, words.of_doc)
    return out, lines.normal_hashes(words), lines.n_words, line_bounds


def _stats_of(keep: list[str], text: Callable[[pa.RecordBatch], pa.Array]):
    @K.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.string_buffers(text(batch))
            for a, b, part, at in K.slices(data, offsets):
                counts, hashes, n_words, bounds = _slice_stats(part, at)
                h, w, ends = [], [], [0]
                for i in range(b - a):
                    own, where = np.unique(hashes[bounds[i] : bounds[i + 1]], return_inverse=True)
                    h.append(own)
                    w.append(np.bincount(where, n_words[bounds[i] : bounds[i + 1]], len(own)))
                    ends.append(ends[-1] + len(own))
                lines = pa.StructArray.from_arrays([pa.array(K.signed(np.concatenate(h))), pa.array(np.concatenate(w).astype(np.int64))], ["h", "w"])
                columns = [batch.column(k).slice(a, b - a) for k in keep]
                columns += [pa.array(counts[c].astype(np.int64)) for c in _COUNTS]
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines))
                yield pa.RecordBatch.from_arrays(columns, [*keep, *_COUNTS, "lines"])

    return run


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def document_stats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host, the counts, and lines (hash and words of each distinct normalised line)."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.col(text).alias("text"))
    return named.mapInArrow(_stats_of(["doc_id", "host"], lambda b: b.column("text")), f"doc_id {dict(named.dtypes)['doc_id']}, host string, {_STATS}, {_LINES}")


def limited_lines(stats: DataFrame, most: int = LINE_DOCS) -> DataFrame:
    """host, h: the lines above the limit, counted over the documents of their host."""
    lines = stats.select("host", F.explode("lines.h").alias("h"))
    return lines.groupBy("host", "h").agg(F.count("*").alias("n")).where(F.col("n") > most).select("host", "h")


def with_limited(stats: DataFrame, limits: DataFrame) -> tuple[DataFrame, Broadcast | None]:
    """``stats`` and, if the limited lines are few enough, these by host for all tasks; if not, each document gets its own in a
    column ``limited``, by joins on a number of its row."""
    limits = cut(limits)
    if limits.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        by_host = {r.host: np.sort(np.array(r.h, np.int64)) for r in limits.groupBy("host").agg(F.collect_list("h").alias("h")).collect()}
        return stats, stats.sparkSession.sparkContext.broadcast(by_host)
    numbered = cut(stats.withColumn("row", F.monotonically_increasing_id()))
    own = spread_join(numbered.select("row", "host", F.explode("lines.h").alias("h")), ["host", "h"], ["row"], limits)
    return numbered.join(own.groupBy("row").agg(F.collect_list("h").alias("limited")), "row", "left").drop("row"), None


def _gone(batch: pa.RecordBatch, limits: Broadcast | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds of each row's lines, their hashes, which of them are limited) of a batch of stats."""
    lines = batch.column("lines")
    bounds = lines.offsets.to_numpy() - lines.offsets[0].as_py()
    hashes = lines.flatten().field("h").to_numpy(zero_copy_only=False)
    gone = np.zeros(len(hashes), bool)
    row = np.repeat(np.arange(len(batch)), np.diff(bounds))
    if limits is None:
        limited = batch.column("limited")
        for i in np.flatnonzero(limited.is_valid().to_numpy(zero_copy_only=False)):
            gone[bounds[i] : bounds[i + 1]] = np.isin(hashes[bounds[i] : bounds[i + 1]], limited[int(i)].values.to_numpy())
        return bounds, hashes, gone
    hosts = batch.column("host").dictionary_encode()
    codes = hosts.indices.to_numpy()[row]
    for k, name in enumerate(hosts.dictionary.to_pylist()):
        known = limits.value.get(name)
        if known is not None:
            mine = np.flatnonzero(codes == k)
            place = np.minimum(np.searchsorted(known, hashes[mine]), len(known) - 1)
            gone[mine] = known[place] == hashes[mine]
    return bounds, hashes, gone


def _judged(limits: Broadcast | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, _, gone = _gone(batch, limits)
            words = batch.column("lines").flatten().field("w").to_numpy(zero_copy_only=False)
            columns = [batch.column(c) for c in ("doc_id", *_COUNTS)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(_per_doc(words * gone, bounds))], ["doc_id", *_COUNTS, "n_removed_words"])

    return run


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", max_removed: float = MAX_REMOVED) -> DataFrame:
    """One row per document: doc_id, the counts, n_removed_words, base_failed, kept."""
    stats = cut(document_stats(docs, doc_id, text, host))
    known, limits = with_limited(stats, limited_lines(stats))
    judged = known.mapInArrow(_judged(limits), f"doc_id {dict(stats.dtypes)['doc_id']}, {_STATS}, n_removed_words bigint")
    return judged.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("n_removed_words") <= max_removed * F.col("n_words")))


def _strip(names: list[str], max_removed: float, limits: Broadcast | None):
    """Documents whose limited lines are not too many, without these."""

    @K.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, hashes, gone = _gone(batch, limits)
            words = batch.column("lines").flatten().field("w").to_numpy(zero_copy_only=False)
            lost, total = _per_doc(words * gone, bounds), batch.column("n_words").to_numpy()
            keep = np.flatnonzero(lost <= max_removed * total)
            docs = batch.column("doc").take(pa.array(keep))
            columns = dict(zip(names, docs.flatten(), strict=True))
            texts = columns["text"].to_pylist()
            for k in np.flatnonzero(lost[keep]).tolist():
                i = keep[k]
                own = hashes[bounds[i] : bounds[i + 1]][gone[bounds[i] : bounds[i + 1]]]
                data, offsets = K.string_buffers(pa.array([texts[k]]))
                found = K.Words(data, offsets)
                lines, stay = _Lines(found), np.ones(len(data), bool)
                for at in np.flatnonzero(np.isin(K.signed(lines.normal_hashes(found)), own)):
                    stay[lines.starts[at] : lines.ends[at]] = False
                texts[k] = data[stay].tobytes().decode("utf-8")
            columns |= {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(x) for x in texts], pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return run


def apply_quality_rules(docs: DataFrame, max_removed: float = MAX_REMOVED) -> DataFrame:
    """Documents (text, source, n_chars bigint and more) that the rules keep, without their limited lines; n_chars follows
    the text. Texts are counted once: the counts are written with the documents that pass the base rules or not, since lines are
    counted over all, and read again for the verdict."""
    docs = docs.withColumn("text", F.make_valid_utf8("text"))
    whole = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"))
    schema = T.StructType([*whole.schema.fields, *T._parse_datatype_string(f"{_STATS}, {_LINES}").fields])
    place = docs.columns.index("text")
    stats = cut(whole.mapInArrow(_stats_of(["doc", "host"], lambda b: b.column("doc").flatten()[place]), schema))
    passed, limits = with_limited(stats.where(~base_failed()), limited_lines(stats))
    return passed.mapInArrow(_strip(docs.columns, max_removed, limits), docs.schema)
