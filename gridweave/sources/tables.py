"""Keyed tables on plain Parquet.

A table is a folder of files and of numbered pointers, each naming the folders that make up every bucket; the highest number is
the table. A write makes new folders and then the next pointer, which must not exist yet: of two writers that started from one
version, the second finds its number taken and does its work again on the newer table, so neither loses rows and
readers never see half a write (on file systems whose rename fails where there is a target, as HDFS; on object stores this is a test
and then a rename, so there only one may write). Rows are spread over hash buckets of their keys' lead column: a write reads and rewrites only
buckets that the source touches; others are carried over by name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridweave.shared import cut

APPEND, OVERWRITE, UPSERT = "APPEND", "OVERWRITE", "UPSERT"
MODES = (APPEND, OVERWRITE, UPSERT)


def resolve_mode(mode: str | None) -> str:
    name = (mode or APPEND).upper()
    if name not in MODES:
        raise ValueError(f"unknown insert mode: {mode}")
    return name


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        # plain where nothing is null: frames that are dealt by such a column meet without another shuffle
        cond = cond & (a[k].eqNullSafe(b[k]) if a.schema[k].nullable or b.schema[k].nullable else a[k] == b[k])
    return cond


def _without(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys aren't in ``others``. An outer join, as the optimizer moves an anti join below the step that deals the rows to tasks."""
    there = others.select(*keys).distinct().withColumn("__there", F.lit(True))
    return rows.join(there, _same(rows, there, keys), "left").where(there["__there"].isNull()).select(rows["*"])


def latest(source: DataFrame, keys: list[str], recency: str | None = None) -> DataFrame:
    """One row per key: the most recent if a recency column is named (nulls are the least recent); of equally recent ones the
    greatest by its other columns, in their order, so that a replay gives the same."""
    rest = [f for f in source.schema.fields if f.name not in keys]
    if not rest:
        return source.select(*keys).distinct()
    rank = [F.col(recency)] if recency else []
    rank += [F.to_json(f.name) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in rest]
    found = source.groupBy(*keys).agg(F.max_by(F.struct(*(F.col(f"`{f.name}`") for f in rest)), F.struct(*rank)).alias("__row"))
    return found.select(*keys, "__row.*").select(*source.columns)


def chosen(source: DataFrame, keys: list[str], recency: str | None = None, replace: str | None = None) -> DataFrame:
    """One row per key, as ``merge`` takes them: of rows that say by ``replace`` whether they may replace others, those that may come first."""
    if not replace:
        return latest(source, keys, recency)
    flagged = source.withColumn(replace, F.coalesce(F.col(replace), F.lit(False)))
    ranked = flagged.withColumn("__rank", F.struct(replace, *([recency] if recency else [])))
    return latest(ranked, keys, "__rank").drop("__rank")


def merge(target: DataFrame, source: DataFrame, keys: list[str], mode: str = UPSERT, recency: str | None = None, scope: str | list[str] | None = None, replace: str | None = None) -> DataFrame:
    """The target after the write. Keys are compared null-safe.

    APPEND adds rows with new keys, so a replay changes nothing. UPSERT puts source rows in the place of target rows with
    their keys. OVERWRITE replaces all target rows of the ``scope`` values (the first key) that the source has. Columns that
    only one side has are null on the other. With ``replace``, a column of the source that isn't kept, each row says itself whether it may take
    the place of another (UPSERT) or not (APPEND; null too); of rows of one key, one that may comes first."""
    mode = resolve_mode(mode)
    new = chosen(source, keys, recency, replace)
    if replace:
        changing, rest = new.where(replace).drop(replace), new.where(~F.col(replace)).drop(replace)
        fresh = _without(rest, target, keys)
        kept = _without(target, changing, keys)
        return kept.unionByName(changing, allowMissingColumns=True).unionByName(fresh, allowMissingColumns=True)
    if mode == APPEND:
        fresh = _without(new, target, keys)
        return target.unionByName(fresh, allowMissingColumns=True)
    by = ([scope] if isinstance(scope, str) else scope or [keys[0]]) if mode == OVERWRITE else keys
    return _without(target, new, by).unionByName(new, allowMissingColumns=True)


class KeyedTable:
    """A table matched by keys, stored in hash buckets of its lead key."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = 16, lead: str | None = None):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets
        self.lead = lead or keys[0]

    def _fs(self):
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        jvm, fs = self._fs()
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n[8:-5]) for n in names if n.startswith("pointer-") and n.endswith(".json"))

    def _pointer(self) -> tuple[int, dict[str, list[str]]]:
        """The current version (0: none) and the folders that make up each bucket."""
        versions = self._versions()
        return (versions[-1], self._at(versions[-1])) if versions else (0, {})

    def _at(self, version: int) -> dict[str, list[str]]:
        return json.loads(self.spark.read.text(f"{self.path}/pointer-{version}.json", wholetext=True).first()[0])

    def _publish(self, version: int, pointer: dict[str, list[str]]) -> bool:
        """Make the pointer of a version; False if there is one already."""
        jvm, fs = self._fs()
        path = jvm.org.apache.hadoop.fs.Path
        fs.mkdirs(path(self.path))
        draft, final = path(f"{self.path}/draft-{uuid.uuid4().hex}"), path(f"{self.path}/pointer-{version}.json")
        out = fs.create(draft)
        out.write(bytearray(json.dumps(pointer).encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(final), options)
        except Py4JJavaError as e:
            if not isinstance_of(e, "FileAlreadyExistsException"):
                raise
            fs.delete(draft, False)
            return False
        return True

    def create(self) -> KeyedTable:
        """Make the table, empty, if there is none."""
        if not self.exists():
            self._publish(1, {})
        return self

    def exists(self) -> bool:
        return bool(self._versions())

    def vacuum(self, keep: int = 1) -> None:
        """Remove all but the last ``keep`` versions, and folders that none of these names; not while others write."""
        jvm, fs = self._fs()
        path, versions = jvm.org.apache.hadoop.fs.Path, self._versions()
        used = {f.split("/")[0] for v in versions[-keep:] for fs_ in self._at(v).values() for f in fs_}
        for v in versions[:-keep]:
            fs.delete(path(f"{self.path}/pointer-{v}.json"), False)
        for status in fs.listStatus(path(self.path)):
            name = status.getPath().getName()
            if name.startswith("v-") and name not in used:
                fs.delete(status.getPath(), True)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.lead), F.lit(self.buckets))

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.option("mergeSchema", "true").parquet(*(f"{self.path}/{f}" for f in folders)).drop("__bucket")

    def read(self) -> DataFrame:
        return self._read(sorted({f for fs in self._pointer()[1].values() for f in fs}))

    def _change(self, source: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Rewrite the buckets that ``source`` touches; again if the table has moved on meanwhile. The source is written down first: it may
        name the time or chance, and must be the same in every job."""
        source = cut(source)
        touched = sorted(r[0] for r in source.select(self._bucket()).distinct().collect())  # one row per bucket
        while touched:
            version, pointer = self._pointer()
            rows = change(self._read(sorted({f for b in touched for f in pointer.get(str(b), [])})), source)
            folder = f"v-{uuid.uuid4().hex}"
            rows.withColumn("__bucket", self._bucket()).repartition(max(1, len(touched)), "__bucket").write.partitionBy("__bucket").parquet(f"{self.path}/{folder}")
            jvm, fs = self._fs()
            for b in touched:
                there = fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}/__bucket={b}"))
                pointer[str(b)] = [f"{folder}/__bucket={b}"] if there else []
            if self._publish(version + 1, pointer):
                return
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}"), True)

    def insert(self, source: DataFrame, mode: str | None = UPSERT, recency: str | None = None, replace: str | None = None) -> None:
        """Write by mode; only buckets that the source has rows for are read and written again."""
        resolve_mode(mode)
        self._change(source, lambda target, new: merge(target, new, self.keys, mode, recency, self.lead, replace))

    def delete(self, keys: DataFrame) -> None:
        """Remove rows whose keys are in ``keys`` (a frame of the key columns)."""
        self._change(keys, lambda target, gone: target.join(gone, _same(target, gone, self.keys), "left_anti"))


def isinstance_of(error: Py4JJavaError, name: str) -> bool:
    return name in error.java_exception.getClass().getName()


def merge_into(source: DataFrame, table: str, keys: list[str], mode: str = UPSERT) -> None:
    """The same writes on a catalog table with row-level operations; OVERWRITE, which goes by scope, is left to KeyedTable."""
    if resolve_mode(mode) == OVERWRITE:
        raise ValueError("OVERWRITE is not a row-level merge")
    writer = source.alias("s").mergeInto(table, F.expr(" AND ".join(f"{table}.{k} <=> s.{k}" for k in keys))).whenNotMatched().insertAll()
    if resolve_mode(mode) == UPSERT:
        writer = writer.whenMatched().updateAll()
    writer.merge()
