"""Filter interaction audit: what every order of a few filters would keep, and what each filter adds to the others.

Every document gets a mask: a bit for each filter that it fails. Masks are counted by part, all documents, those of good and those of toxic
labels. A subset-zeta transform turns the 32 counts of a part into the documents that survive each set of filters: those whose
mask lies within the filters left out. A step of an order is the difference between two neighbouring sets, so all 120 orders come from
32 numbers, and no filter runs twice.

Filters: A: under 100 words; B: distinct words under 80 % of words; C: A-Z over 10 % of code points; D: any of ``#$%&*|``; E: a
smaller doc_id has the same text, in any part, whether removed or not. Words are runs outside ``\\x20 \\x09-\\x0D``.

One scan of the texts leaves an id, a mask and a SHA-256 of each, written down; copies are found by the smallest id of a digest, which rows
fetch by salted keys, so a text that a third of all rows share is many keys. Labels are joined by id (of ids that many rows share, the
engine splits the larger side). Per part there are 32 numbers of each kind, however many documents.

Cases: a null text is empty, and empty texts are copies of each other. Rows count one by one, also repeated ones; rows of one id
aren't smaller than each other. A null id is neither smaller than another nor has it smaller ones. Labels of one id count as good or toxic if any says
so; null ids have none. A null part is the empty one. Parts without any document don't appear, so an empty table gives no
rows. Very long texts are handled whole, one slice of a batch after another. Bytes that aren't UTF-8 are counted as they stand:
code points are bytes that don't continue one. Other columns take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.llm import textkernel as K
from gridweave.llm.spark_util import cut, spread_join

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT, SIGNS = 100, 80, 10, b"#$%&*|"
MEASURES = ("n", "good", "toxic")

_SIGN = np.zeros(256, bool)
_SIGN[list(SIGNS)] = True


def _per_text(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marked bytes each text has."""
    sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(marked, dtype=np.int64)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def text_masks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bits of A to D for each text of a slice."""
    words = K.Words(data, offsets)
    n = np.diff(words.of_doc)
    of, hashes = np.repeat(np.arange(len(n)), n), words.hashes()
    order = np.lexsort((hashes, of))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (of[order][1:] != of[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    distinct = np.bincount(of[order][fresh], minlength=len(n))
    upper, points = _per_text((data >= 65) & (data <= 90), offsets), _per_text((data & 0xC0) != 0x80, offsets)
    fails = (n < MIN_WORDS, 100 * distinct < MIN_DISTINCT_PERCENT * n, 100 * upper > MAX_UPPER_PERCENT * points, _per_text(_SIGN[data], offsets) > 0)
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


@K.tidy
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = K.string_buffers(batch.column("text"))
        masks = [text_masks(part, at) for _, _, part, at in K.slices(data, offsets)]
        view, ends = memoryview(data), offsets.tolist()
        digests = [hashlib.sha256(view[a:b]).digest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        masks = np.concatenate(masks) if masks else np.zeros(0, np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("part"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], ["id", "part", "mask", "digest"])


def failure_masks(docs: DataFrame, part: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, part, mask of every document."""
    named = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    scanned = cut(named.mapInArrow(_scan, f"id {dict(named.dtypes)['id']}, part string, mask int, digest binary"))
    least = scanned.groupBy("digest").agg(F.min("id").alias("least"))
    copied = F.when(F.col("id") > F.col("least"), 1 << FILTERS.index("E")).otherwise(0)
    return spread_join(scanned, ["digest"], ["id"], least).select("id", "part", F.col("mask").bitwiseOR(copied).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """part, mask, and how many documents of it there are, are good, are toxic."""
    any_of = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c)
    labelled = labels.groupBy(F.col(doc_id).alias("id")).agg(any_of("quality"), any_of("toxic"))
    both = masks.join(labelled, "id", "left")
    return both.groupBy("part", "mask").agg(F.count("*").alias("n"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def survivors(counts: DataFrame) -> DataFrame:
    """part, failing (documents of each mask) and, for each measure, <measure>_within: for every set of filters, given as a number, the
    documents that fail none but those of the set (the subset-zeta transform of the counts)."""
    size = 1 << len(FILTERS)
    by_mask = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", F.struct(*MEASURES)))).alias("by_mask"))
    masks = F.sequence(F.lit(0), F.lit(size - 1))
    dense = {m: F.transform(masks, lambda k: F.coalesce(F.col("by_mask")[k][m], F.lit(0)).cast("bigint")) for m in MEASURES}  # noqa: B023
    out = by_mask.select("part", *(c.alias(f"{m}_within") for m, c in dense.items())).withColumn("failing", F.col("n_within"))
    for bit in (1 << k for k in range(len(FILTERS))):
        step = lambda c: F.transform(c, lambda x, i: F.when(i.bitwiseAND(bit) != 0, x + F.get(F.col(c), i - bit)).otherwise(x))  # noqa: B023, E731
        out = out.withColumns({f"{m}_within": step(f"{m}_within") for m in MEASURES})
    return out


def _kept(measure: str, filters: Column | int) -> Column:
    """Documents that survive a set of filters: they fail none but others."""
    others = (F.lit(filters) if isinstance(filters, int) else filters).bitwiseXOR(F.lit((1 << len(FILTERS)) - 1))
    return F.get(F.col(f"{measure}_within"), others)


def _shapley(k: int) -> Column:
    """Removals by filter ``k``, summed over all orders: a set before it counts as often as it and the rest can be ordered."""
    n, out = len(FILTERS), F.lit(0).cast("bigint")
    for before in (s for s in range(1 << n) if not s >> k & 1):
        times = factorial(before.bit_count()) * factorial(n - 1 - before.bit_count())
        out = out + times * (_kept("n", before) - _kept("n", before | 1 << k))
    return out


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """A row per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    table = survivors(mask_counts(failure_masks(docs, part), labels))
    steps = [{"filter_order": "".join(order), "step": k + 1, "own": FILTERS.index(order[k]), "before": sum(1 << FILTERS.index(f) for f in order[:k])} for order in permutations(FILTERS) for k in range(len(order))]
    orders = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, own: int, before: int>>")
    rows = table.withColumn("shapleys", F.array(*(_shapley(k) for k in range(len(FILTERS))))).select("*", F.inline(orders))
    bit = F.call_function("shiftleft", F.lit(1), F.col("own"))
    lost = lambda m: _kept(m, F.col("before")) - _kept(m, F.col("before").bitwiseOR(bit))
    failing = _kept("n", 0) - _kept("n", bit)
    return rows.select("part", "filter_order", "step", _kept("n", F.col("before").bitwiseOR(bit)).alias("kept"), lost("n").alias("removed"), (failing - lost("n")).alias("redundant"), F.get("failing", bit).alias("unique_fails"), lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.get("shapleys", F.col("own")).alias("shapley"))
