"""N-gram Jaccard self-join by rare-first prefix filtering.

Documents are sets of word n-grams; two link when their Jaccard similarity reaches the threshold. Equal sets
are one node, so copies are never paired. All n-grams are ordered by rising document frequency. For a set of
n of which ``ceil(threshold * n)`` must be shared at least, two linked sets share one of the n-grams before
that many last ones: the prefix. N-grams of a single set cannot be shared at all; they stand first in the
order, take up prefix places, and are dropped as soon as they are counted. That leaves few nodes and few
postings, joined on the n-gram, with filters on length, position and suffix, then verified once per pair.

Postings of one n-gram are not paired with each other. Each list has a probe, the node with the fewest n-grams of its own (that no other
set has): in a group of near copies that is the one with the fewest changes, which most others link with, however few links they have among
themselves. First every node is compared with the one of its lists' probes that passes the filters and has the fewest such n-grams. Lists that still hold several components are then taken up
whole: nodes outside a list's largest component are paired with the rest, block by block. A pair inside one component can't change the result, so no link between
components is lost. Every posting has a summary of the suffix after its place: for each of 128 ranges of hashes, whether it holds an
odd number of the suffix's n-grams. Where two suffixes differ in this they differ in an n-gram of that range, so what they don't
share is at least the number of such ranges (the suffix filter, with all seven halvings made at once).

Counting: documents are hashed twice from their texts (cheaper than keeping the sets). The first pass finds
n-grams that fill more than a share of the documents; their count is their order, and they are not dealt out
by n-gram, so no list to be counted grows past that share. The second deals (n-gram, node) blobs by n-gram, where
frequencies are counted, and back by node. A blob writer deals to a bounded number of keys; where more parts are
needed, blobs are dealt again, level by level, so the number of blobs grows with the input and not with its square. Postings
of one n-gram and neighbours of one node meet in joins that salt them.

Null, empty and blank texts have no n-grams and link with nothing; texts shorter than n words are one n-gram.
Every row gives one row. Repeated rows and rows of equal texts are one node; of equal ids each row has its own text's
component. A null id is never a component's id unless all ids of it are null. Ids keep their type, and the smallest by its order
names the component, so ties have one result. An empty table gives an empty one. Other columns of the input aren't looked at, so
their names may clash. n-grams and sets are told apart by 64-bit hashes. Texts of any length are taken whole, slice by slice. Bytes that aren't UTF-8 are compared as
they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.llm import textkernel as K
from gridweave.llm.components import connected_components
from gridweave.llm.spark_util import BROADCAST_ROWS, cut, release, spread_join

NGRAM = 5
#: Similarity threshold as a fraction of whole numbers.
OVER, UNDER = 80, 100
#: Counters of the first pass; n-grams in more than this share of the documents, or this many, count as frequent.
COUNTER_BITS, FREQUENT_SHARE, FREQUENT_MOST = 21, 0.005, 200_000
#: (n-gram, node) entries counted by one task and gathered by one blob; keys that one blob writer deals to.
ENTRIES_PER_TASK, ENTRIES_PER_BLOB, FAN = 1_500_000, 2_000_000, 256
#: Hash ranges of the suffix filter (64 to a number, a bit each), and postings in a block of a list.
SUFFIX_PARTS, LIST_BLOCK = 128, 1000

_SHIFT = np.uint64(64 - COUNTER_BITS)


def _sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each document of a slice."""
    words = K.Words(data, offsets)
    hashes = words.hashes("lower")
    grams = K.windows(hashes, width)
    for first, end in zip(words.of_doc[:-1].tolist(), words.of_doc[1:].tolist(), strict=True):
        if end - first >= width:
            own = np.sort(grams[first : end - width + 1])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif end > first:
            yield K.windows(hashes[first:end], end - first)
        else:
            yield hashes[:0]


def _set_key(grams: np.ndarray) -> int:
    return int(K.mix(np.array([K.mix(grams).sum() + np.uint64(len(grams))], np.uint64)).view(np.int64)[0])


def _first_pass(width: int):
    """Rows of kind 0: id, node, n of each document; of kind 1: counter, count, for counters that stand out here.

    An n-gram that stands out in the whole does in some task. Copies within a task count once."""

    @K.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, seen, total, kind = np.zeros(1 << COUNTER_BITS, np.uint32), set(), 0, None
        for batch in batches:
            kind = batch.column("id").type
            data, offsets = K.string_buffers(batch.column("text"))
            nodes, sizes = [], []
            for _, _, part, at in K.slices(data, offsets):
                fresh = []
                for grams in _sets(part, at, width):
                    key = _set_key(grams) if len(grams) else 0
                    nodes.append(key)
                    sizes.append(len(grams))
                    if len(grams) and key not in seen:
                        seen.add(key)
                        fresh.append(grams)
                if fresh:
                    where = (np.concatenate(fresh) >> _SHIFT).astype(np.int64)
                    total += len(where)
                    np.add.at(counters, where, np.uint32(1))
            n = len(nodes)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int8)), batch.column("id"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64())], ["kind", "id", "node", "n"])
        hot = np.flatnonzero(counters > max(4, 4 * total / len(counters), FREQUENT_SHARE / 4 * len(seen)))
        if len(hot):
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(hot), np.int8)), pa.nulls(len(hot), kind), pa.array(hot), pa.array(counters[hot].astype(np.int64))], ["kind", "id", "node", "n"])

    return run


_BLOB = "key bigint, nodes binary, sizes binary, grams binary, where binary, counts binary"
_BLOB_NAMES = ["key", "nodes", "sizes", "grams", "where", "counts"]


def _blob(key: int, nodes=None, sizes=None, grams=None, where=None, counts=None) -> tuple:
    pack = lambda x, kind: None if x is None else np.ascontiguousarray(x, kind).tobytes()
    return key, pack(nodes, np.int64), pack(sizes, np.uint32), None if grams is None else _squeeze(grams), None if where is None else _planes(where, ">u4"), pack(counts, np.uint32)


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Like bytes together: high bytes are mostly zero, which compression then takes away."""
    return values.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T.tobytes()


def _unplanes(data: bytes, kind: str) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T
    return np.ascontiguousarray(rows).view(kind).ravel()


def _squeeze(grams: np.ndarray) -> bytes:
    """Sorted hashes as differences."""
    return _planes(np.diff(grams, prepend=np.uint64(0)), ">u8")


def _unsqueeze(data: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(data, ">u8").astype(np.uint64), dtype=np.uint64)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _BLOB_NAMES)


def _by_node(ids: np.ndarray, sizes: np.ndarray | None, grams: np.ndarray, where: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """One blob for each key of ``keys`` (one per node): its nodes and their entries."""
    place, rows = np.empty(len(ids), np.int64), []
    entry_order = np.argsort(keys[where], kind="stable")
    bounds = np.searchsorted(keys[where][entry_order], np.unique(keys))
    for n, (k, own) in enumerate(zip(*_groups(keys, np.argsort(keys, kind="stable")), strict=True)):
        place[own] = np.arange(len(own))
        mine = entry_order[bounds[n] : bounds[n + 1] if n + 1 < len(bounds) else len(where)]
        mine = mine[np.argsort(grams[mine])]
        rows.append(_blob(int(k), ids[own], None if sizes is None else sizes[own], grams[mine], place[where[mine]], counts[mine]))
    return _table(rows)


def _by_gram(ids: np.ndarray, grams: np.ndarray, where: np.ndarray, level: tuple[int, int], number: int) -> Iterator[pa.RecordBatch]:
    """One blob for each range of n-grams of the level. ``number`` tells writers apart: a range's blobs are dealt to so many
    keys that each gets about one task's share."""
    parts, salts = level
    order = np.argsort(grams)
    grams, where = grams[order], where[order]
    part = _part(grams, parts)
    bounds = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else np.zeros(1, int)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        used, local = np.unique(where[a:b], return_inverse=True)
        yield _table([_blob(int(part[a]) * salts + number % salts, ids[used], None, grams[a:b], local)])


def _second_pass(width: int, level: tuple[int, int], frequent):
    """Blobs of (n-gram, node) by n-gram; and of (node, n, frequent n-grams), with negative keys."""

    def flush(nodes: list[int], sets: list[np.ndarray], number: int) -> Iterator[pa.RecordBatch]:
        counts = frequent.value
        ids, sizes = np.array(nodes, np.int64), np.array([len(x) for x in sets], np.int64)
        grams, where = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
        count = counts[(grams >> _SHIFT).astype(np.int64)]
        hot, rest = np.flatnonzero(count), np.flatnonzero(count == 0)
        yield _by_node(ids, sizes, grams[hot], where[hot], count[hot], np.full(len(ids), -1 - number % (level[0] * level[1])))
        yield from _by_gram(ids, grams[rest], where[rest], level, number)

    @K.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() * 7919
        nodes, sets, seen, held = [], [], set(), 0
        for batch in batches:
            data, offsets = K.string_buffers(batch.column("text"))
            for _, _, part, at in K.slices(data, offsets):
                for grams in _sets(part, at, width):
                    if len(grams) and (key := _set_key(grams)) not in seen:
                        seen.add(key)
                        nodes.append(key)
                        sets.append(grams)
                        held += len(grams)
                if held >= ENTRIES_PER_BLOB:
                    yield from flush(nodes, sets, number)
                    nodes, sets, held, number = [], [], 0, number + 1
        if sets:
            yield from flush(nodes, sets, number)

    return run


def _levels(parts: int) -> list[tuple[int, int]]:
    """(ranges, keys per range) of each dealing: a level has at most FAN times the ranges of the one before, and ends with
    ``parts``; all have about ``parts`` keys, so tasks are alike."""
    steps = 1
    while FAN**steps < parts:
        steps += 1
    counts = [min(parts, FAN**k) for k in range(1, steps)] + [parts]
    return [(n, -(-parts // n)) for n in counts]


def _entries(batches: Iterator[pa.RecordBatch]) -> tuple[list, list]:
    """n-grams and nodes of blobs."""
    grams, nodes = [], []
    for batch in batches:
        for ids, own, where in zip(batch.column("nodes"), batch.column("grams"), batch.column("where"), strict=True):
            grams.append(_unsqueeze(own.as_py()))
            nodes.append(np.frombuffer(ids.as_py(), np.int64)[_unplanes(where.as_py(), ">u4")])
    return grams, nodes


def _deal_again(level: tuple[int, int]):
    """Blobs of a range of n-grams, dealt to the ranges of the next level."""

    @K.tidy_group
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key[0].as_py() < 0:
            yield from batches
            return
        grams, nodes = map(np.concatenate, _entries(batches))
        ids, where = np.unique(nodes, return_inverse=True)
        yield from _by_gram(ids, grams, where, level, key[0].as_py() * 7919)

    return run


def _part(grams: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` ranges of hashes each is in; rises with the hash."""
    return (((grams >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _groups(keys: np.ndarray, order: np.ndarray) -> tuple[list, list]:
    """Distinct keys and, for each, the places that have it."""
    if not len(keys):
        return [], []
    ranked = keys[order]
    cuts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    return ranked[cuts].tolist(), np.split(order, cuts[1:])


def _node_key(ids: np.ndarray, level: tuple[int, int], number: int) -> np.ndarray:
    return _part(ids.view(np.uint64), level[0]) * level[1] + number % level[1]


def _count(level: tuple[int, int]):
    """Of all blobs of one range of n-grams: the entries in two nodes or more, with frequencies, by node."""

    @K.tidy_group
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = key[0].as_py()
        if number < 0:
            yield from _nodes_dealt(batches, level, number)
            return
        grams, nodes = map(np.concatenate, _entries(batches))
        order = np.argsort(grams, kind="stable")
        shared = np.zeros(len(order), bool)
        same = grams[order][1:] == grams[order][:-1]
        shared[1:] |= same
        shared[:-1] |= same
        order = order[shared]
        grams, nodes = grams[order], nodes[order]
        order = np.lexsort((nodes, grams))  # tasks that met copies sent the same entries
        grams, nodes = grams[order], nodes[order]
        fresh = np.concatenate(([True], (grams[1:] != grams[:-1]) | (nodes[1:] != nodes[:-1]))) if len(grams) else np.zeros(0, bool)
        grams, nodes = grams[fresh], nodes[fresh]
        starts = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))) if len(grams) else np.zeros(0, int)
        counts = np.repeat(np.diff(starts, append=len(grams)), np.diff(starts, append=len(grams)))
        many = counts > 1
        ids, where = np.unique(nodes[many], return_inverse=True)
        if len(ids):
            yield _by_node(ids, None, grams[many], where, counts[many], _node_key(ids, level, number))

    return run


def _nodes_dealt(batches: Iterator[pa.RecordBatch], level: tuple[int, int], number: int) -> Iterator[pa.RecordBatch]:
    """Blobs of nodes by the ranges of the level; those with the sizes of sets (frequent n-grams) and others apart."""
    kinds: dict[bool, list] = {True: [], False: []}
    for batch in batches:
        for ids, sizes, own, where, count in zip(*batch.columns[1:], strict=True):
            kinds[sizes.is_valid].append((np.frombuffer(ids.as_py(), np.int64), np.frombuffer(sizes.as_py() or b"", np.uint32), _unsqueeze(own.as_py()), _unplanes(where.as_py(), ">u4").astype(np.int64), np.frombuffer(count.as_py(), np.uint32)))
    for sized, blobs in kinds.items():
        if blobs:
            first = np.cumsum([0, *(len(b[0]) for b in blobs[:-1])])
            ids, sizes, grams, where, counts = (np.concatenate([b[k] + f if k == 3 else b[k] for b, f in zip(blobs, first, strict=True)]) for k in range(5))
            yield _by_node(ids, sizes if sized else None, grams, where, counts, _node_key(ids, level, number))


def _deal_nodes_again(level: tuple[int, int]):
    @K.tidy_group
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _nodes_dealt(batches, level, key[0].as_py() * 7919)

    return run


def _assemble(over: int, under: int):
    """Of all blobs of one range of nodes: nodes whose shared n-grams could be enough, each with those n-grams,
    rare ones first."""

    @K.tidy_group
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, grams, counts, known, known_n = [], [], [], [], []
        for batch in batches:
            for ids, sizes, own, where, count in zip(*batch.columns[1:], strict=True):
                ids = np.frombuffer(ids.as_py(), np.int64)
                if sizes.is_valid:
                    known.append(ids)
                    known_n.append(np.frombuffer(sizes.as_py(), np.uint32))
                grams.append(_unsqueeze(own.as_py()))
                nodes.append(ids[_unplanes(where.as_py(), ">u4")])
                # frequent n-grams come after all that were counted by range
                counts.append(np.frombuffer(count.as_py(), np.uint32).astype(np.int64) + (1 << 40) * sizes.is_valid)
        known, first = np.unique(np.concatenate(known), return_index=True)
        n = np.concatenate(known_n)[first].astype(np.int64)
        grams, nodes, counts = np.concatenate(grams), np.concatenate(nodes), np.concatenate(counts)
        order = np.lexsort((grams, counts, nodes))
        grams, nodes = grams[order], nodes[order]
        fresh = np.concatenate(([True], (grams[1:] != grams[:-1]) | (nodes[1:] != nodes[:-1]))) if len(grams) else np.zeros(0, bool)
        grams, nodes = grams[fresh], nodes[fresh]
        begin, end = np.searchsorted(nodes, known), np.searchsorted(nodes, known, "right")
        enough = np.flatnonzero((end - begin) * under >= n * over)
        parts = (grams >> np.uint64(64 - SUFFIX_PARTS.bit_length() + 1)).astype(np.int64)
        yield from (_with_suffixes(known[own], n[own], (end - begin)[own], begin[own], grams, parts, over, under) for own in np.split(enough, range(500, len(enough), 500)))

    return run


def _with_suffixes(nodes: np.ndarray, n: np.ndarray, u: np.ndarray, begin: np.ndarray, grams: np.ndarray, parts: np.ndarray, over: int, under: int) -> pa.RecordBatch:
    """Nodes, their n-grams in order, and for each place of the prefix two numbers with a bit for each range of the suffix: set if
    it holds an odd number of n-grams."""
    prefix = u - (n * over + under - 1) // under + 1
    summaries = []
    for first, k, places in zip(begin.tolist(), u.tolist(), prefix.tolist(), strict=True):
        own = parts[first : first + k]
        bits = np.zeros((k, SUFFIX_PARTS // 64), np.uint64)
        bits[np.arange(k), own // 64] = np.uint64(1) << (own % 64).astype(np.uint64)
        left = np.bitwise_xor.reduce(bits, axis=0) ^ np.bitwise_xor.accumulate(bits[:places], axis=0)
        summaries.append(left.view(np.int64).ravel())
    taken = np.repeat(begin, u) + K.ranges(u)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(u))), pa.int32()), pa.array(K.signed(grams[taken])))
    suffixes = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(prefix * (SUFFIX_PARTS // 64)))), pa.int32()), pa.array(np.concatenate([*summaries, np.zeros(0, np.int64)])))
    return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(n), pa.array(u), lists, suffixes], ["node", "n", "u", "grams", "suffixes"])


def _needed(over: int, under: int, a: str, b: str) -> str:
    """SQL: the smallest intersection with which sets of sizes a and b link."""
    return f"(({a} + {b}) * {over} + {under + over - 1}) div {under + over}"


def _suffix(over: int, under: int, a: str, b: str) -> Column:
    """Suffix filter for two postings of one n-gram, the first that their sets share: apart from it they can only share
    n-grams of both suffixes, and these differ in at least as many as there are ranges of different parity."""
    apart = " + ".join(f"bit_count({a}.suffix[{k}] ^ {b}.suffix[{k}])" for k in range(SUFFIX_PARTS // 64))
    return F.expr(f"{a}.n - {a}.pos + {b}.n - {b}.pos - 2 - ({apart}) >= 2 * ({_needed(over, under, f'{a}.n', f'{b}.n')} - 1)")


def _promising(over: int, under: int, a: str, b: str) -> Column:
    """Length, positional and suffix filter for two postings (structs) of one n-gram."""
    length = f"least({a}.n, {b}.n) * {under} >= greatest({a}.n, {b}.n) * {over}"
    position = f"least({a}.n - {a}.pos, {b}.n - {b}.pos) >= {_needed(over, under, f'{a}.n', f'{b}.n')}"
    return F.expr(f"{length} AND {position}") & _suffix(over, under, a, b)


def _verified(pairs: DataFrame, sets: DataFrame, over: int, under: int) -> DataFrame:
    """Of (a, b, ...) pairs, each tested once: those that link. If few nodes take part, only their sets are dealt out."""
    pairs = cut(pairs)
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    if nodes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        sets = sets.join(F.broadcast(nodes), "node", "left_semi")
    side = lambda k: sets.select(F.col("node").alias(k), F.struct("n", "grams").alias(f"s{k}"))
    both = spread_join(spread_join(pairs, ["a"], ["b"], side("a")), ["b"], ["a"], side("b"))
    return both.where(f"size(array_intersect(sa.grams, sb.grams)) >= {_needed(over, under, 'sa.n', 'sb.n')}").select(*pairs.columns)


def ngram_nodes(docs: DataFrame, width: int = NGRAM, over: int = OVER, under: int = UNDER, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, node, n) of every document, and the nodes that could link: node, n, u, grams, bits."""
    spark = docs.sparkSession
    named = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    first = cut(named.mapInArrow(_first_pass(width), f"kind tinyint, id {dict(named.dtypes)['id']}, node bigint, n bigint"))
    members = first.where("kind = 0").select("id", "node", "n")
    total, n_docs = members.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    least = max(64, 4 * total / (1 << COUNTER_BITS), min(FREQUENT_SHARE / 2 * n_docs, FREQUENT_MOST))
    frequent = np.zeros(1 << COUNTER_BITS, np.uint32)
    for k, n in first.where("kind = 1").groupBy("node").agg(F.sum("n").alias("n")).where(F.col("n") > least).collect():  # one row per counter at most
        frequent[k] = min(n, 2**32 - 1)
    levels = _levels(max(4, -(-int(total) // ENTRIES_PER_TASK)))
    blobs = named.mapInArrow(_second_pass(width, levels[0], spark.sparkContext.broadcast(frequent)), _BLOB)
    for level in levels[1:]:
        blobs = blobs.groupBy("key").applyInArrow(_deal_again(level), _BLOB)
    # written down, so that the largest shuffle can go before the sets are put together
    blobs = cut(blobs.groupBy("key").applyInArrow(_count(levels[0]), _BLOB))
    release(spark)
    for level in levels[1:]:
        blobs = blobs.groupBy("key").applyInArrow(_deal_nodes_again(level), _BLOB)
    sets = blobs.groupBy("key").applyInArrow(_assemble(over, under), "node bigint, n bigint, u bigint, grams array<bigint>, suffixes array<bigint>")
    return members, cut(sets)


def _with_probe(lists: DataFrame) -> DataFrame:
    """``lists`` (gram, own, p, c) of two postings or more, with the posting of the fewest own n-grams and their length."""
    probes = lists.groupBy("gram").agg(F.min(F.struct("own", "p", "c")).alias("probe"), F.count("*").alias("lists")).where("lists > 1")
    return spread_join(lists.drop("own"), ["gram"], ["p.node"], probes)


def _of_mixed(labelled: DataFrame) -> DataFrame:
    """The postings (gram, lists, p, c) of lists that hold several components, with the largest of them."""
    groups = labelled.groupBy("gram", "c").agg(F.count("*").alias("m"))
    mixed = groups.groupBy("gram").agg(F.max_by("c", F.struct("m", "c")).alias("major"), F.count("*").alias("groups")).where("groups > 1").select("gram", "major")
    return spread_join(labelled, ["gram"], ["p.node"], mixed)


def _mixed_lists(sets: DataFrame, over: int, under: int) -> tuple[DataFrame, DataFrame]:
    """(node, component) of nodes that link with a probe, and the postings of lists that hold several components."""
    kept = sets.select("node", "n", "u", "suffixes", F.expr(f"slice(grams, 1, int(u - ((n * {over} + {under - 1}) div {under}) + 1))").alias("prefix"))
    width = SUFFIX_PARTS // 64
    places = kept.select("node", "n", "suffixes", F.posexplode("prefix").alias("k", "gram"), (F.col("n") - F.col("u")).alias("before"))
    lists = places.select("gram", F.col("before").alias("own"), F.struct("node", "n", (F.col("before") + F.col("k")).alias("pos"), F.slice("suffixes", F.col("k") * width + 1, F.lit(width)).alias("suffix")).alias("p"), F.col("node").alias("c"))
    probed = cut(_with_probe(lists))
    pairs = probed.where("c <> probe.c").where(_promising(over, under, "probe.p", "p")).groupBy(F.col("p.node").alias("b")).agg(F.min(F.struct("probe.own", "probe.p.node")).alias("best")).select(F.col("best.node").alias("a"), "b")
    labels = connected_components(_verified(pairs, sets, over, under))
    labelled = probed.select("gram", "lists", "p", F.col("p.node").alias("node")).join(labels, "node", "left").select("gram", "lists", "p", F.coalesce("component", "node").alias("c"))
    return labels, cut(_of_mixed(labelled))


def ngram_classes(sets: DataFrame, over: int = OVER, under: int = UNDER) -> DataFrame:
    """node, component of every node that links with another."""
    labels, members = _mixed_lists(sets, over, under)
    edges = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
    release(sets.sparkSession)
    # A long list is a square of blocks, each pair of blocks a key of its own.
    members = members.withColumn("blocks", F.expr(f"int((lists + {LIST_BLOCK - 1}) div {LIST_BLOCK})"))
    block = F.pmod(F.xxhash64("p.node", "gram"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    minor = members.where("c <> major").select("gram", F.col("c").alias("ca"), F.col("p").alias("pa"), block.alias("i"), F.explode(every).alias("j"))
    others = members.select("gram", "major", F.col("c").alias("cb"), F.col("p").alias("pb"), F.explode(every).alias("i"), block.alias("j"))
    both = minor.join(others, ["gram", "i", "j"]).where(F.expr("ca <> cb AND (cb = major OR ca < cb)") & _promising(over, under, "pa", "pb"))
    rest = both.select(F.least("pa.node", "pb.node").alias("a"), F.greatest("pa.node", "pb.node").alias("b")).distinct()
    return connected_components(_verified(rest, sets, over, under).unionByName(edges))


def ngram_components(docs: DataFrame, width: int = NGRAM, over: int = OVER, under: int = UNDER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) of every document."""
    members, sets = ngram_nodes(docs, width, over, under, doc_id, text)
    release(docs.sparkSession)
    labels = ngram_classes(sets, over, under)
    nodes = members.where("n > 0").groupBy("node").agg(F.min("id").alias("least"))
    grouped = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    grouped = cut(grouped)
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    by_node = spread_join(grouped, ["component"], ["node"], least).select("node", "component_id")
    named = spread_join(members, ["node"], ["id"], by_node, "left")  # copies of one text are one node
    return named.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
