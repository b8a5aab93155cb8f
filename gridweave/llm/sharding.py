"""Sharding by balanced label propagation.

Documents with equal texts are linked. Linked documents start in shards drawn by hash; in every round each may
move to the shard that holds most of its group (counts weighed by what shards could admit lately), if that
holds no fewer than its own. Moves are admitted net of departures: as many rows of each pair of shards as swaps,
cycles and room allow, so sizes stay within bounds while cut links fall, however full the shards are. A move never takes a
row to where its group has fewer, so links within shards do not fall; rounds end when ``STILL`` in a row, each with other ties, move
nothing, and there is no other limit. A group is one node of a star, so its links are as many as its rows, and its rows are alike: the rounds handle
one row per group with its count in each shard, and documents take part only before and after. They look their group up by salted keys
and are numbered in bins, so a group of a third of all rows is many keys. Afterwards
rows over quota and unlinked documents fill the shards to counts at most one apart.

Null texts count as empty, of size 16; all null and empty texts are one group. Every row is placed once: repeated rows are
members of a group like others, and ids, null or repeated, are only carried along. Ties are broken by hashes. With fewer
rows than shards some shards are empty; an empty table gives an empty one. Other columns are not looked at, so their names may
clash.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridweave.llm.spark_util import cut, spread_join

SHARDS, ROWS_PER_TASK = 40, 20_000
#: Rounds end when this many in a row, each with other ties, let no row move.
STILL = 3
#: The least that a full shard's count of a group is taken for when groups choose where to gather.
LEAST_WORTH = 0.001


def numbered(df: DataFrame, key: Column, row: str, bins: int, name: str, weight: Column | None = None) -> DataFrame:
    """``df`` and a gapless number from 0 within each key, or the weights of the rows before. Rows are ordered in hash bins of
    bounded size, whose offsets come from their sums."""
    dealt = df.withColumn("__key", key).withColumn("__bin", F.pmod(F.xxhash64(row), F.lit(bins))).withColumn("__w", F.lit(1) if weight is None else weight)
    earlier = lambda w: F.coalesce(F.sum("__w").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inside = dealt.withColumn("__in", earlier(W.partitionBy("__key", "__bin").orderBy(row)))
    if bins == 1:
        return inside.withColumn(name, F.col("__in")).drop("__key", "__bin", "__w", "__in")
    sums = dealt.groupBy("__key", "__bin").agg(F.sum("__w").alias("__w"))
    offsets = sums.select("__key", "__bin", earlier(W.partitionBy("__key").orderBy("__bin")).alias("__before"))
    return inside.join(offsets, ["__key", "__bin"]).withColumn(name, F.col("__before") + F.col("__in")).drop("__key", "__bin", "__w", "__before", "__in")


def _flows(demand: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many of the rows that wish from one shard to another may move, so that no shard without room grows. ``room`` is
    negative for shards over their quota. Those are relieved first; then rows are swapped between pairs of shards, and
    sent along cycles and paths to room, until there are no more of these."""
    left, flow, room = dict(demand), Counter(), list(room)
    out: dict[int, list[int]] = {}
    for s, t in sorted(left):
        out.setdefault(s, []).append(t)

    def push(path: list[int], n: int) -> None:
        for edge in zip(path, path[1:], strict=False):
            left[edge] -= n
            flow[edge] += n

    for s, t in sorted(left):
        n = min(left[s, t], -room[s], room[t])
        if n > 0:
            push([s, t], n)
            room[s], room[t] = room[s] + n, room[t] - n
    for s, t in sorted(left):
        n = min(left[s, t], left.get((t, s), 0))
        if n > 0:
            push([s, t, s], n)
    dead: set[int] = set()  # shards that no cycle and no way to room goes through any more
    for start in sorted(out):
        while start not in dead:
            path = [start]
            while path:
                here = path[-1]
                if len(path) > 1 and room[here] > 0:
                    n = min(room[here], *(left[e] for e in zip(path, path[1:], strict=False)))
                    push(path, n)
                    room[start], room[here] = room[start] + n, room[here] - n
                    break
                ahead = next((t for t in out.get(here, ()) if left[here, t] and (t not in dead or room[t] > 0)), None)
                if ahead is None:
                    dead.add(path.pop())
                elif ahead in path:
                    cycle = [*path[path.index(ahead) :], ahead]
                    push(cycle, min(left[e] for e in zip(cycle, cycle[1:], strict=False)))
                    break
                else:
                    path.append(ahead)
    return +flow


def _propagate(base: DataFrame, shards: int, room_for: int, bins: int) -> DataFrame:
    """grp, spread (shard, n) of the groups of two rows or more after the rounds. A move takes rows only to where their group has as many or
    more, so the links within shards grow with each and the rounds come to an end."""
    start = base.groupBy("grp", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(shards)).cast("int").alias("shard")).agg(F.count("*").alias("n"))
    groups = cut(start.groupBy("grp").agg(F.collect_list(F.struct("shard", "n")).alias("spread")).where("size(spread) > 1 OR spread[0].n > 1"))
    admits, still, turn = [1.0] * shards, 0, 0  # the share of wishes that each shard could admit lately
    while still < STILL:
        turn += 1
        worth = F.expr(f"array({', '.join(f'{x}D' for x in admits)})")
        best = F.array_max(F.transform("spread", lambda x: F.struct((x.n * F.get(worth, x.shard)).alias("worth"), F.xxhash64("grp", x.shard, F.lit(turn)).alias("tie"), x.n.alias("n"), x.shard.alias("shard"))))
        own = groups.withColumn("best", best).select("grp", "best", F.inline("spread"))
        wishes = own.select("grp", "shard", "n", F.when((F.col("best.shard") != F.col("shard")) & (F.col("best.n") >= F.col("n")), F.col("best.shard")).alias("target"))
        counts = wishes.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect()  # shards * (shards + 1) rows at most
        room, demand = [room_for] * shards, {}
        for s, t, n in counts:
            room[s] -= n
            if t is not None:
                demand[s, t] = n
        flow = _flows(demand, room)
        if not demand and min(admits) == 1:
            break
        still = 0 if flow else still + 1
        if flow:
            pair = F.col("shard") * shards + F.col("target")
            quota = F.get(F.expr(f"array({', '.join(str(flow[s, t]) for s in range(shards) for t in range(shards))})"), pair)
            asked = numbered(wishes.where("target IS NOT NULL"), pair, "grp", bins, "place", F.col("n"))
            moved = asked.select("grp", "shard", "n", "target", F.greatest(F.lit(0), F.least(F.col("n"), quota - F.col("place"))).alias("goes"))
            every = wishes.where("target IS NULL").withColumn("goes", F.lit(0)).unionByName(moved)
            met = every.groupBy("grp").agg(F.max("target").alias("target"), F.sum("goes").alias("come"), F.collect_list(F.struct("shard", (F.col("n") - F.col("goes")).alias("n"))).alias("spread"))
            with_come = F.transform("spread", lambda x: F.struct(x.shard.alias("shard"), F.when(x.shard == F.col("target"), x.n + F.col("come")).otherwise(x.n).alias("n")))
            groups = cut(met.select("grp", F.filter(with_come, lambda x: x.n > 0).alias("spread")))
        wished, let = Counter(), Counter()
        for (s, t), n in demand.items():
            wished[t] += n
            let[t] += flow[s, t]
        # a shard that was not asked regains its worth by steps; if none was, all do
        admits = [max(LEAST_WORTH, let[t] / wished[t]) if wished[t] else min(1.0, 4 * admits[t]) if demand else 1.0 for t in range(shards)]
    return groups


def _of_groups(base: DataFrame, groups: DataFrame, bins: int) -> DataFrame:
    """row, shard of the rows of groups: of a group's rows, which are alike, as many to each shard as its spread says."""
    linked = spread_join(base.select("row", "grp"), ["grp"], ["row"], groups)
    ends = F.transform("spread", lambda x, k: F.struct(F.aggregate(F.slice("spread", 1, k + 1), F.lit(0).cast("bigint"), lambda a, y: a + y.n).alias("end"), x.shard.alias("shard")))
    placed = numbered(linked, F.col("grp"), "row", bins, "place")
    return placed.select("row", F.filter(ends, lambda x: x.end > F.col("place"))[0].shard.alias("shard"))


def balanced_shards(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot; row counts of shards are at most one apart."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    base = cut(docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(raw) + 16).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("grp"), F.monotonically_increasing_id().alias("row")))
    total = base.count()
    bins = max(1, -(-total // (shards * ROWS_PER_TASK)))
    labels = _of_groups(base, _propagate(base.select("row", "grp"), shards, total // shards, bins), bins * shards)
    # rows over a shard's quota give up their place
    placed = cut(numbered(labels, F.col("shard"), "row", bins, "slot").where(F.col("slot") < total // shards).select("row", "shard", "slot"))
    held = dict(placed.groupBy("shard").agg(F.count("*")).collect())
    vacant = [total // shards + (s < total % shards) - held.get(s, 0) for s in range(shards)]
    ends = [sum(vacant[: s + 1]) for s in range(shards)]
    rest = numbered(base.join(placed.select("row"), "row", "left_anti").select("row"), F.lit(0), "row", bins * shards, "spot")
    shard = F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e <= F.col("spot")))
    first = F.array(*(F.lit(held.get(s, 0) - (ends[s] - vacant[s])) for s in range(shards)))
    rest = rest.withColumn("shard", shard).select("row", "shard", (F.col("spot") + F.get(first, F.col("shard"))).alias("slot"))
    return base.join(placed.unionByName(rest), "row").select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("bigint").alias("slot"), "grp")
