"""Approximate nearest neighbours with balanced posting lists.

Equal vectors are one entry with their smallest ids, so a vector that very many rows have is searched once. Centroids, one
for about ``LIST_VECTORS`` entries, come from a bounded sample by k-means in two levels; lists that hold too much of
it are split again. The centroids are linked to a graph held in memory (near ones, some in every direction, and back links to
those that few others link to) and searched best-first with a beam, from entry points that the upper level picks. An entry goes to its nearest list and, near a boundary, to a few others
whose distance is within a ratio. A query takes up lists until they hold enough entries, and then all within a ratio of the
distance reached; ratios are fitted on the sample, apart for groups of queries by that distance (from those in dense places to
the farthest hundredth), so that in each group the wanted share of true neighbours is found. Queries that end with too few neighbours search eight times as many
lists, and so on up to all, so every query has its full number.

Nearness is the cosine in double precision. Vectors that are null, zero, of another length than most others (of equally
common lengths the least counts), or hold null or non-finite components, and rows with a null id, take no part. Ids are
whole numbers (cast to bigint). An id stands for its row: rows that repeat a query's id are not its candidates; repeated rows
count once; of an id with several vectors the best counts. Ties go to the smaller id. An empty table gives an
empty result. Other columns are not looked at, so their names may clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridweave.llm.spark_util import cut, spread_join

#: Entries of a list, and the most lists, whose centroids are held in memory; beyond that lists grow.
LIST_VECTORS, MOST_LISTS = 1000, 65_536
#: Sampled entries: so many a list, within bounds.
SAMPLE_A_LIST, SAMPLE_LEAST, SAMPLE_MOST = 6, 20_000, 400_000
#: The most lists of one entry, how much farther than the nearest they may be, edges of a centroid (and back links), candidates
#: for these, and the beams for entries and, to begin with, for queries.
REPLICAS, NEAR_RATIO, EDGES, CANDIDATES, ENTRY_BEAM, BEAM = 4, 1.08, 12, 64, 8, 16
#: The share of true neighbours to be found in each group of queries, the quantiles between groups, and the queries sampled in each.
WANTED, GROUPS, GROUP_QUERIES = 0.98, (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.98, 0.99), 100
TOP = 5
#: Entries that one task compares with its queries.
CHUNK = 8 * LIST_VECTORS


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _means(x: np.ndarray, k: int, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """k unit centroids and the nearest of them for each row."""
    c = x[random.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(8):
        own = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        c = np.where(size > 0, sums / np.where(size > 0, size, 1), c)
    return c, (x @ c.T).argmax(axis=1)


class CentroidIndex:
    """Centroids, their graph, and what was fitted on the sample."""

    def __init__(self, sample: np.ndarray, total: int, wanted: float = WANTED):
        unit, random = _unit(sample), np.random.default_rng(7)
        self.dim = unit.shape[1]
        lists = int(np.clip(total // LIST_VECTORS, 1, max(1, min(MOST_LISTS, len(unit) // SAMPLE_A_LIST))))
        self.centroids, self.upper, self.entries = self._two_levels(unit, lists, random)
        n = len(self.centroids)
        self.graph = self._links()
        owners = self.assign(unit)
        _, first = np.unique(owners[:, 0], return_index=True)
        nearest = owners[first, 1]
        self.members = np.bincount(nearest, minlength=n) * (total / len(unit))
        self.chunks = np.maximum(1, np.ceil(np.bincount(owners[:, 1], minlength=n) / len(unit) * total / CHUNK)).astype(np.int64)
        self.edges, self.ratio = np.zeros(len(GROUPS)), np.ones(len(GROUPS) + 1)
        self._fit(unit, owners, wanted, random)

    @staticmethod
    def _two_levels(unit: np.ndarray, lists: int, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centroids, the upper level's centres, and for each of these its nearest own centroid."""
        upper, own = _means(unit, max(1, round(np.sqrt(lists))), random)
        out, centres, entries, limit = [], [], [], 2 * max(1, len(unit) // lists)
        for k in range(len(upper)):
            rows, first = np.flatnonzero(own == k), len(out)
            if not len(rows):
                continue
            parts, inner = _means(unit[rows], max(1, round(lists * len(rows) / len(unit))), random)
            todo = [(parts[j], rows[inner == j]) for j in range(len(parts))]
            while todo:
                centre, held = todo.pop()
                if len(held) > limit and np.ptp(unit[held], axis=0).max() > 1e-12:
                    halves, side = _means(unit[held], 2, random)
                    if 0 < side.sum() < len(held):
                        todo += [(halves[j], held[side == j]) for j in (0, 1)]
                        continue
                if len(held):
                    out.append(centre)
            centres.append(upper[k])
            entries.append(first + int((np.array(out[first:]) @ upper[k]).argmax()))
        return np.array(out), np.array(centres), np.array(entries)

    def _links(self) -> np.ndarray:
        """For each centroid its edges: half of them such that none is nearer to an earlier one than to the centroid, the rest the
        nearest; and back links, first of those that have few."""
        c, n = self.centroids, len(self.centroids)
        edges, pool = min(EDGES, n - 1), min(CANDIDATES, n - 1)
        forward = np.zeros((n, edges), np.int64)
        for at in range(0, n if edges else 0, 512):
            near = c[at : at + 512] @ c.T
            near[np.arange(len(near)), np.arange(at, at + len(near))] = -2
            cand = np.argsort(-near, axis=1)[:, :pool]
            near, among = np.take_along_axis(near, cand, 1), np.einsum("bid,bjd->bij", c[cand], c[cand])
            chosen = np.zeros(cand.shape, bool)
            for j in range(pool):
                chosen[:, j] = (~chosen | (among[:, j] <= near[:, j : j + 1])).all(axis=1)
            chosen &= np.cumsum(chosen, axis=1) <= edges // 2
            forward[at : at + 512] = np.take_along_axis(cand, np.argsort(~chosen, axis=1, kind="stable")[:, :edges], 1)
        back = np.repeat(forward[:, :1], edges, axis=1)
        source, target = np.repeat(np.arange(n), edges), forward.ravel()
        order = np.lexsort((np.bincount(target, minlength=n)[source], target))
        place = np.arange(len(order)) - np.searchsorted(target[order], target[order])
        keep = place < edges
        back[target[order][keep], place[keep]] = source[order][keep]
        return np.concatenate((forward, back), axis=1)

    def _distances(self, unit: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """From each row to its own centroids, by differences: exact for vectors that are very near, too."""
        return np.sqrt(((unit[:, None, :] - self.centroids[ids]) ** 2).sum(axis=2))

    def search(self, unit: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) found for each row, nearest first: best-first search of the graph."""
        beam = min(beam, len(self.centroids))
        rows = max(1, 4_000_000 // (self.dim * (beam + 2 * EDGES)))
        found = [self._search(unit[at : at + rows], beam) for at in range(0, max(1, len(unit)), rows)]
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])

    def _search(self, unit: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        starts = min(len(self.entries), beam, 4)
        ids = np.full((len(unit), beam), -1)
        distance = np.full(ids.shape, np.inf)
        ids[:, :starts] = self.entries[np.argsort(-(unit @ self.upper.T), axis=1)[:, :starts]]
        distance[:, :starts] = self._distances(unit, ids[:, :starts])
        done = ids < 0
        while self.graph.shape[1]:
            left = np.where(done, np.inf, distance)
            rows = np.flatnonzero(np.isfinite(left).any(axis=1))
            if not len(rows):
                break
            pick = np.argsort(left[rows], axis=1)[:, :2]
            real = np.isfinite(np.take_along_axis(left[rows], pick, 1))
            pick[:, 1:] = np.where(real[:, 1:], pick[:, 1:], pick[:, :1])
            done[rows[:, None], pick] = True
            fresh = np.sort(self.graph[ids[rows[:, None], pick]].reshape(len(rows), -1), axis=1)
            known = (fresh[:, :, None] == ids[rows][:, None, :]).any(axis=2)
            known[:, 1:] |= fresh[:, 1:] == fresh[:, :-1]
            far = np.where(known, np.inf, self._distances(unit[rows], fresh))
            every = np.concatenate((distance[rows], far), axis=1)
            best = np.argpartition(every, beam - 1, axis=1)[:, :beam]
            take = lambda a, b: np.take_along_axis(np.concatenate((a, b), axis=1), best, 1)  # noqa: B023, E731
            ids[rows], done[rows], distance[rows] = take(ids[rows], fresh), take(done[rows], known), np.take_along_axis(every, best, 1)
            ids[~np.isfinite(distance)] = -1
            done |= ids < 0
        order = np.argsort(distance, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(distance, order, 1)

    def assign(self, unit: np.ndarray) -> np.ndarray:
        """(row, list) pairs by row: the nearest list, and those near enough behind it."""
        lists, d = self.search(unit, ENTRY_BEAM)
        near = np.isfinite(d) & (d <= NEAR_RATIO * d[:, :1])
        near[:, REPLICAS:] = False
        near[:, 0] = True
        row, place = np.nonzero(near)
        return np.stack((row, lists[row, place]), axis=1)

    def _reached(self, lists: np.ndarray, d: np.ndarray, least: int) -> np.ndarray:
        """Of each row the distance at which its lists hold four times the neighbours wanted, and are ``least`` at least."""
        held = np.cumsum(np.where(lists >= 0, self.members[lists], 0), axis=1)
        place = np.minimum(np.maximum((held < 4 * TOP).sum(axis=1), least - 1), np.maximum((lists >= 0).sum(axis=1) - 1, 0))
        return d[np.arange(len(d)), place]

    def _fit(self, unit: np.ndarray, owners: np.ndarray, wanted: float, random: np.random.Generator) -> None:
        starts = np.searchsorted(owners[:, 0], np.arange(len(unit) + 1))
        reached = self._reached(*self.search(unit, BEAM), 1)
        self.edges = np.quantile(reached, GROUPS)
        group = np.searchsorted(self.edges, reached)
        for g in range(len(GROUPS) + 1):
            asked = np.flatnonzero(group == g)
            asked = random.choice(asked, min(GROUP_QUERIES, len(asked)), replace=False)
            need = []
            for q in asked:
                near = unit @ unit[q]
                near[q] = -2
                for v in np.argsort(-near)[:TOP]:
                    nearest = np.sqrt(((unit[q] - self.centroids[owners[starts[v] : starts[v + 1], 1]]) ** 2).sum(axis=1).min())
                    need.append(nearest / max(reached[q], 1e-12))
            if need:
                self.ratio[g] = max(1.0, float(np.quantile(need, wanted))) + 1e-6

    def lists_of(self, unit: np.ndarray, least: int = 1) -> list[np.ndarray]:
        """The lists that each row takes up. The beam is doubled for rows whose every list was near enough."""
        n, beam = len(self.centroids), max(BEAM, 2 * least)
        out, rows = [np.zeros(0, np.int64)] * len(unit), np.arange(len(unit))
        while len(rows):
            lists, d = self.search(unit[rows], beam)
            ratio = self.ratio[np.searchsorted(self.edges, self._reached(lists, d, 1))]
            near = d <= np.maximum(self._reached(lists, d, least) * ratio, 1e-12)[:, None]
            near[:, :least] = True
            near &= lists >= 0
            whole = near.all(axis=1) if beam < n else np.zeros(len(rows), bool)
            for k in np.flatnonzero(~whole):
                out[rows[k]] = lists[k][near[k]]
            rows, beam = rows[whole], min(n, 2 * beam)
        return [np.arange(n) if least >= n else x for x in out]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as bytes."""
    rows = np.ascontiguousarray(rows, np.dtype(rows.dtype).newbyteorder("<"))
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(rows.tobytes())])


def _route(shared, least: int):
    """Entries (ids not null) and queries (ids null) by list and chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.slice(at, 2000)
                vectors, rows, asks = _matrix(part.column("vec"), index.dim), part.column("row").to_numpy(), part.column("asks").to_numpy(zero_copy_only=False)
                unit = _unit(vectors)
                owners = index.assign(unit)
                asked = np.flatnonzero(asks)
                taken = index.lists_of(unit[asked], least) if len(asked) else []
                counts = [index.chunks[x] for x in taken]
                q_rows = np.repeat(asked, [int(c.sum()) for c in counts]) if len(asked) else np.zeros(0, np.int64)
                q_lists = np.concatenate([np.repeat(x, c) for x, c in zip(taken, counts, strict=True)]) if len(asked) else q_rows
                q_chunks = np.concatenate([np.arange(k) for c in counts for k in c]) if len(asked) else q_rows
                source = np.concatenate((owners[:, 0], q_rows)).astype(np.int64)
                lists = np.concatenate((owners[:, 1], q_lists)).astype(np.int64)
                chunks = np.concatenate((rows[owners[:, 0]] % 1_000_003 % index.chunks[owners[:, 1]], q_chunks)).astype(np.int64)
                ids = part.column("ids").take(pa.array(np.concatenate((owners[:, 0], np.full(len(q_rows), -1))), mask=np.arange(len(source)) >= len(owners)))
                yield pa.RecordBatch.from_arrays([pa.array(lists), pa.array(chunks), pa.array(rows[source]), _binary(vectors[source]), ids], ["list", "chunk", "row", "vec", "ids"])

    return run


def cosines(q: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Each row is added up in the same way, so equal vectors have equal cosines."""
    return (vectors * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((vectors * vectors).sum(axis=1)))


def _best(top: int, kind: str):
    """Of one chunk of a list: for each query the ``top`` nearest ids."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        entry = table.column("ids").is_valid().to_numpy(zero_copy_only=False)
        stack = lambda mask: np.frombuffer(b"".join(table.column("vec").filter(pa.array(mask)).to_pylist()), kind).reshape(int(mask.sum()), -1).astype(np.float64)
        asked, out = table.column("row").to_numpy()[~entry], [[], [], []]
        if entry.any() and len(asked):
            vectors, queries, ids = stack(entry), stack(~entry), table.column("ids").filter(pa.array(entry)).to_pylist()
            unit = _unit(vectors)
            for at in range(0, len(asked), 256):
                near = _unit(queries[at : at + 256]) @ unit.T
                k = min(top, near.shape[1]) - 1
                limit = -np.partition(-near, k, axis=1)[:, k] - 1e-9
                for i, q in enumerate(asked[at : at + 256].tolist()):
                    hit = np.flatnonzero(near[i] >= limit[i])
                    score = cosines(queries[at + i], vectors[hit])
                    found: dict[int, float] = {}
                    for s, h in sorted(zip(-score, hit.tolist(), strict=True)):
                        for x in ids[h]:
                            found[x] = max(found.get(x, -2.0), -s)
                    for x in sorted(found, key=lambda x: (-found[x], x))[:top]:  # noqa: B023
                        for column, value in zip(out, (q, x, float(found[x])), strict=True):
                            column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["row", "vec_id", "score"])

    return run


def _usable(vec: Column) -> Column:
    """Not null, no null or non-finite components, not zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return finite & F.exists(vec, lambda x: x != 0)


def fit_index(entries: DataFrame, total: int, wanted: float = WANTED) -> CentroidIndex:
    """entries: row, vec. The sample is drawn by a hash of the row and bounded."""
    most = int(np.clip(SAMPLE_A_LIST * total // LIST_VECTORS, SAMPLE_LEAST, SAMPLE_MOST))
    scale = 1 << 30
    share = F.pmod(F.xxhash64("row"), F.lit(scale)) < int(scale * min(1.0, most / total))
    drawn = entries.where(share).select("vec").toArrow().column("vec").combine_chunks()
    return CentroidIndex(_matrix(drawn, len(drawn[0])), total, wanted)


def nearest(df: DataFrame, every: int = 50, top: int = TOP, vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found of each row whose id is divisible by ``every``."""
    spark = df.sparkSession
    named = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vec).alias("vec")).where("vec_id IS NOT NULL").where(_usable(F.col("vec")))
    sizes = named.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    usable = named.where(F.size("vec") == sizes["dim"])
    # Of equal vectors the smallest ids are enough: one more than wanted, since a query leaves its own out.
    place = F.dense_rank().over(W.partitionBy("vec").orderBy("vec_id"))
    equal = usable.withColumn("place", place).where(F.col("place") <= top + 1).groupBy("vec").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    entries = cut(equal.withColumn("row", F.monotonically_increasing_id()))
    queries = usable.where(F.col("vec_id") % every == 0).distinct()
    asked = cut(spread_join(queries, ["vec"], ["vec_id"], entries.select("vec", "row")).select(F.col("vec_id").alias("query_id"), "row"))
    wanted = min(top + 1, usable.select("vec_id").distinct().limit(top + 1).count())
    index = fit_index(entries, entries.count())
    shared = spark.sparkContext.broadcast(index)
    kind = "<f4" if dict(entries.dtypes)["vec"] == "array<float>" else "<f8"
    casts = entries if kind == "<f4" else entries.withColumn("vec", F.col("vec").cast("array<double>"))
    order = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    waiting, least, results = cut(asked.select("row").distinct()), 1, None
    while True:
        routed = casts.join(waiting.withColumn("asks", F.lit(True)), "row", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))
        routed = routed.select("row", "vec", "ids", "asks").mapInArrow(_route(shared, least), "list bigint, chunk bigint, row bigint, vec binary, ids array<bigint>")
        found = routed.groupBy("list", "chunk").applyInArrow(_best(top + 1, kind), "row bigint, vec_id bigint, score double")
        best = found.groupBy("row", "vec_id").agg(F.max("score").alias("score")).withColumn("place", F.row_number().over(order)).where(F.col("place") <= top + 1)
        hits = cut(best.groupBy("row").agg(F.collect_list(F.struct("vec_id", "score")).alias("hits")))
        full = hits.where(F.size("hits") >= wanted)
        results = full if results is None else results.unionByName(full)
        waiting = cut(waiting.join(full.select("row"), "row", "left_anti"))
        if least >= len(index.centroids) or waiting.isEmpty():
            break
        least = min(8 * least, len(index.centroids))
    answers = spread_join(asked, ["row"], ["query_id"], results).select("query_id", F.explode("hits").alias("hit")).where("hit.vec_id <> query_id")
    distinct = answers.groupBy("query_id", F.col("hit.vec_id").alias("vec_id")).agg(F.max("hit.score").alias("score"))
    ranked = distinct.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
