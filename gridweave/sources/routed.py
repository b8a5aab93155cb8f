"""Many tables of one schema as one Parquet dataset: a partition for each route and for each bucket of the lead key.

A write deals all routes in one job: rows are written down once, the partitions that they touch are read, merged by key, and put
in place by dynamic partition overwrite; other partitions aren't looked at. Rows are counted before they are dealt, and a task of a write sorts
a fixed number of them, however many there are. How many jobs run doesn't depend on how many routes there are.

A task that is lost, or tried twice, leaves no trace; a write that fails before its end leaves the tables as they were. When it ends, partitions are put in place one after
another: a reader may meanwhile see some of them new and others old, and after a crash just then the same write, made
again, completes it, as writes are by key. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridweave.shared import cut
from gridweave.sources.tables import OVERWRITE, chosen, merge, resolve_mode

#: Ids up to this many are broadcast to the read that they prune; more are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Rows that a task of a write takes, about; a smaller write is dealt to all cores, down to SMALL rows a task.
ROWS, SMALL = 200_000, 10_000


class RoutedTables:
    """``keys`` tell rows of a route apart; ``lead`` is the one that buckets go by."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], lead: str | None = None, route: str = "table_category", buckets: int = 16):
        self.spark, self.path, self.keys, self.lead, self.route, self.buckets = spark, path.rstrip("/"), list(keys), lead or keys[0], route, buckets
        self.columns = [f.name for f in schema.fields if f.name != route]
        self.schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in schema.fields if f.name != route), T.StructField(route, T.StringType()), T.StructField("bucket", T.IntegerType())])

    def exists(self) -> bool:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.lead), F.lit(self.buckets)).cast("int")

    def _all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path) if self.exists() else self.spark.createDataFrame([], self.schema)

    def read(self, routes: list[str] | None = None, ids: DataFrame | None = None) -> DataFrame:
        """Rows with their route; of some routes only, or of the lead keys in ``ids`` (a column of the same name): other routes, and
        buckets that no id falls into, aren't read (ids are looked up when the query runs)."""
        rows = self._all()
        if routes is not None:
            rows = rows.where(F.col(self.route).isin(*routes))
        if ids is not None:
            # the condition on the bucket lets the engine prune by what the ids turn out to be
            wanted = ids.select(self.lead).distinct().withColumn("bucket", self._bucket()).where("bucket >= 0")
            if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
                wanted = F.broadcast(wanted)
            rows = rows.join(wanted, ["bucket", self.lead], "left_semi")
        return rows.select(*self.columns, self.route)

    def write(self, rows: DataFrame, mode: str | None = None, recency: str | None = None, replace: str | None = None) -> dict[str, int]:
        """Rows (with their route) into their tables, by mode (see ``merge``; OVERWRITE goes by lead key); how many rows each route was
        sent. Rows without a route are left out. Of rows of one key the most recent counts."""
        mode = resolve_mode(mode)
        extra = [replace] if replace else []
        source = cut(rows.where(F.col(self.route).isNotNull()).select(*self.columns, self.route, *extra, self._bucket().alias("bucket")))
        at = [self.route, "bucket"]
        count = lambda rows: rows.groupBy(*at).agg(F.count("*").alias("n")).collect()  # noqa: E731 (one row per partition touched)
        parts = count(source)
        if not parts:
            return {}
        place = F.concat_ws("/", self.route, F.col("bucket").cast("string"))
        target = self._all().where(place.isin(*(f"{r[0]}/{r[1]}" for r in parts)))
        sizes = {(r[0], r[1]): r["n"] for r in parts}
        for r in count(target):
            sizes[r[0], r[1]] += r["n"]
        total = sum(sizes.values())
        tasks = max(-(-total // ROWS), min(self.spark.sparkContext.defaultParallelism, -(-total // SMALL)))
        # one key that is never null, and of one type, so that both sides are dealt as they are joined
        kind = T.StructType([T.StructField(k, self.schema[k].dataType) for k in [*at, *self.keys]])
        source, target = (rows.withColumn("__key", F.struct(*at, *self.keys).cast(kind)) for rows in (source, target))
        if tasks > 1:  # rows of one key are first thinned out wherever they are, so that they don't meet in one task
            spread = source.withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.lit(tasks)).cast("int")).repartitionById(tasks, "__part")
            source = chosen(spread, ["__part", "__key"], recency, replace).drop("__part")
        merged = merge(target.repartition(tasks, "__key"), source.repartition(tasks, "__key"), ["__key"], mode, recency, [self.route, self.lead] if mode == OVERWRITE else None, replace)
        # partitions stand one after another, and tasks are equal stretches of all: a large one is split, small ones share a task
        each, starts, begin = -(-total // tasks), [], 0
        for (route, bucket), n in sorted(sizes.items()):
            starts.append((route, bucket, begin, n))
            begin += n
        ranges = self.spark.createDataFrame(starts, T.StructType([*self.schema.fields[-2:], T.StructField("__begin", T.LongType()), T.StructField("__n", T.LongType())]))
        task = F.floor((F.col("__begin") + F.pmod(F.xxhash64("__key"), "__n")) / F.lit(each)).cast("int")
        dealt = merged.join(F.broadcast(ranges), at).select(*self.columns, *at, task.alias("__task")).repartitionById(tasks, "__task").drop("__task")
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*at).parquet(self.path)
        sent: dict[str, int] = {}
        for r in parts:
            sent[r[0]] = sent.get(r[0], 0) + r["n"]
        return sent
