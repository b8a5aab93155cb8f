"""Packed rows as files of id matrices, for loaders that map them into memory.

Each task writes three files: ``.ids`` and ``.positions`` are matrices of numbers in row order (the little-endian cells of the packed
rows, one after another, so row k begins at k times the row's bytes), and ``.segments`` is an Arrow file with what is ragged: sequence_id,
n_tokens, cu_seqlens, doc_ids, starts. ``manifest.json`` names the files, their rows and checksums, the capacity and the widths of the numbers.

Tasks write to a folder of drafts; when all have ended the driver moves the files of the attempts that count, and then puts the manifest in
place. Without a manifest there is nothing to read, so half a write, or a second try of a lost task, is never seen. An empty table gives a manifest without
files. Writing again replaces what was there; files of the write before are removed once the new manifest stands. Ids of documents
may be of any type that Arrow files hold, and null. The folder has to be one that all tasks reach (any file system that pyarrow opens by URI).
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

FORMAT = "packed_tokens"
_MATRICES = {"ids": "input_ids", "positions": "position_ids"}
_RAGGED = ["sequence_id", "n_tokens", "cu_seqlens", "doc_ids", "starts"]
_COLUMNS = ["sequence_id", "n_tokens", "input_ids", "position_ids", "cu_seqlens", "doc_ids", "starts"]


def _at(path: str) -> tuple[pafs.FileSystem, str]:
    fs, folder = pafs.FileSystem.from_uri(path)
    return fs, folder.rstrip("/")


def _cells(column: pa.Array) -> pa.Buffer:
    """The cells of a binary column, one after another."""
    column = column.cast(pa.large_binary())
    ends = column.buffers()[1]
    first, last = (int.from_bytes(ends[8 * k : 8 * k + 8].to_pybytes(), "little") for k in (column.offset, column.offset + len(column)))
    return column.buffers()[2].slice(first, last - first) if last > first else pa.py_buffer(b"")


@dataclass
class _Written(WriterCommitMessage):
    name: str
    rows: int
    row_bytes: dict
    crc32: dict


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, ddl: str):
        self.path, self.ddl, self.drafts = path, ddl, f"_drafts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        fs, folder = _at(self.path)
        drafts, name = f"{folder}/{self.drafts}", f"part-{uuid.uuid4().hex}"
        rows, sizes, sums, segments = 0, {}, dict.fromkeys(_MATRICES, 0), None
        first = next(iterator, None)
        if first is None:
            return _Written("", 0, {}, {})
        fs.create_dir(drafts)
        with fs.open_output_stream(f"{drafts}/{name}.ids") as ids, fs.open_output_stream(f"{drafts}/{name}.positions") as positions, fs.open_output_stream(f"{drafts}/{name}.segments") as ragged:
            for batch in (b for source in ([first], iterator) for b in source):
                for (key, column), out in zip(_MATRICES.items(), (ids, positions), strict=True):
                    data = _cells(batch.column(column))
                    if len(batch):
                        sizes[key] = len(data) // len(batch)
                    sums[key] = zlib.crc32(data, sums[key])
                    out.write(data)
                own = batch.select(_RAGGED)
                segments = segments or pa.ipc.new_file(ragged, own.schema)
                segments.write_batch(own)
                rows += len(batch)
            segments.close()
        return _Written(name, rows, sizes, sums)

    def commit(self, messages: list) -> None:
        fs, folder = _at(self.path)
        fs.create_dir(folder)
        made = [m for m in messages if m is not None and m.rows]
        for m in made:
            for kind in (*_MATRICES, "segments"):
                fs.move(f"{folder}/{self.drafts}/{m.name}.{kind}", f"{folder}/{m.name}.{kind}")
        sizes = made[0].row_bytes if made else {}
        manifest = {"ddl": self.ddl, "row_bytes": sizes, "files": [{"name": m.name, "rows": m.rows, "crc32": m.crc32} for m in sorted(made, key=lambda m: m.name)]}
        with fs.open_output_stream(f"{folder}/{self.drafts}.json") as out:
            out.write(json.dumps(manifest).encode())
        fs.move(f"{folder}/{self.drafts}.json", f"{folder}/manifest.json")
        kept = {m.name for m in made}
        for info in fs.get_file_info(pafs.FileSelector(folder)):
            if info.base_name.startswith("part-") and info.base_name.rpartition(".")[0] not in kept:
                fs.delete_file(info.path)
        self._clear(fs, folder)

    def abort(self, messages: list) -> None:  # noqa: ARG002
        self._clear(*_at(self.path))

    def _clear(self, fs: pafs.FileSystem, folder: str) -> None:
        if fs.get_file_info(f"{folder}/{self.drafts}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{folder}/{self.drafts}")


class _Batch(InputPartition):
    """A record batch of a file's segments: its number, and the rows before it."""

    def __init__(self, name: str, number: int, first: int):
        self.name, self.number, self.first = name, number, first


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path
        self.sizes = manifest(path)["row_bytes"]

    def partitions(self) -> list[InputPartition]:
        fs, folder = _at(self.path)
        out: list[InputPartition] = []
        for f in manifest(self.path)["files"]:
            with fs.open_input_file(f"{folder}/{f['name']}.segments") as own:
                segments, first = pa.ipc.open_file(own), 0
                for k in range(segments.num_record_batches):
                    out.append(_Batch(f["name"], k, first))
                    first += segments.get_batch(k).num_rows
        return out

    def read(self, partition: _Batch | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no file at all
            return
        fs, folder = _at(self.path)
        with fs.open_input_file(f"{folder}/{partition.name}.segments") as own:
            columns = {c: v for c, v in zip(_RAGGED, pa.ipc.open_file(own).get_batch(partition.number).columns, strict=True)}
        n = len(columns["sequence_id"])
        for key, column in _MATRICES.items():
            size = self.sizes[key]
            with fs.open_input_file(f"{folder}/{partition.name}.{key}") as own:
                data = own.read_at(n * size, partition.first * size)
            columns[column] = pa.array([data[k * size : (k + 1) * size] for k in range(n)], pa.binary())
        yield pa.RecordBatch.from_arrays([columns[c] for c in _COLUMNS], _COLUMNS)


class PackedFiles(DataSource):
    """The option path is a URI."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return manifest(self.options["path"])["ddl"]

    def writer(self, schema, overwrite: bool) -> _Writer:  # noqa: ARG002
        return _Writer(self.options["path"], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields))

    def reader(self, schema) -> _Reader:  # noqa: ARG002
        return _Reader(self.options["path"])


def manifest(path: str) -> dict:
    fs, folder = _at(path)
    with fs.open_input_stream(f"{folder}/manifest.json") as own:
        return json.loads(own.read())


def write_packed(packed: DataFrame, path: str) -> None:
    """Rows of ``pack_documents`` as files under ``path`` (a URI)."""
    packed.sparkSession.dataSource.register(PackedFiles)
    packed.select(*_COLUMNS).write.format(FORMAT).mode("overwrite").option("path", path).save()


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(PackedFiles)
    return spark.read.format(FORMAT).option("path", path).load()
