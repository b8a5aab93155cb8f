"""Small Spark helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lookup tables up to this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where none is named, a local session gets one of its own; a
    cluster, whose executors don't see the driver's disk, an error."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"file://{tempfile.gettempdir()}/gridweave-{spark.sparkContext.applicationId}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies, if they share the driver's disk; on a cluster it is installed
    or shipped with the job."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (*paths, root) if p)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there, so that lost executors
    cost a reread and several readers don't compute it twice."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Spark removes shuffle files and broadcasts that nothing refers to any more when the driver collects garbage, which
    may be long after; ask for it where a step has left large ones behind."""
    gc.collect()
    spark._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_join(rows: DataFrame, keys: list[str], by: list[str], table: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has one row per ``keys``, without dealing a hot key to one task.

    Rows are salted by a hash of ``by``, with as many salts as there are shuffle partitions. The (key, salt) pairs that occur,
    counted on the map side, fetch the table's row; rows then fetch it from their own pair. So of one key no task gets
    more than the number of salts, or one salt's share."""
    salts = partitions(rows.sparkSession)
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    pairs = salted.select(*keys, "__salt").distinct().join(table, keys)
    return salted.join(pairs, [*keys, "__salt"], how).drop("__salt")


def union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
