"""`fragments`: a Spark data source for fragment text, in batches, as a stream and as a sink.

    register(spark)
    spark.read.format("fragments").load("s3a://bucket/folder")
    spark.readStream.format("fragments").load(folder)
    raw.write.format("fragments").mode("append").save(folder)

Reads every file with an accepted suffix below the given paths (separated by commas). Block-gzipped
files are cut into splits of `splitBytes`, planned from the file sizes alone; other files are one
split each. Columns are those of raw fragments and `path`. Files are listed and opened through
Arrow's file systems, so local paths, s3, gs and hdfs addresses work alike. The sink writes
block-gzipped parts, below a folder for each sample where there is a column sample_id.
"""

import sys
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import csv, fs
from pyspark import cloudpickle
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage,
)

from fragloom.constants import ACCEPTED_SUFFIXES
from fragloom.sources.bgzf import is_blocked
from fragloom.sources.split_text import BGZ_SPLIT, FIELDS, frames

# The source travels to the workers, executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "chrom string, start bigint, end bigint, mapq bigint, strand string, path string"
ARROW = pa.schema([("chrom", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("mapq", pa.int64()),
                   ("strand", pa.string()), ("path", pa.string())])
#: Text in one block of the sink.
BLOCK_TEXT = 60_000


def open_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a local path or an address."""
    for old, new in (("s3a://", "s3://"), ("s3n://", "s3://"), ("file:///", "/"), ("file:/", "/")):
        if path.startswith(old):
            path = new + path[len(old):]
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _full_path(path: str, system: fs.FileSystem, inner: str) -> str:
    if isinstance(system, fs.LocalFileSystem):
        return inner
    return path.split("://")[0].replace("s3a", "s3").replace("s3n", "s3") + "://" + inner


def list_files(paths: str) -> list[tuple[int, str, int]]:
    """(time of change in ns, path, length) of the accepted files below `paths`, in this order."""
    found = []
    for path in paths.split(","):
        system, inner = open_system(path.strip())
        info = system.get_file_info(inner)
        if info.type == fs.FileType.NotFound:
            raise ValueError(f"no such path: {path}")
        files = [info] if info.is_file else system.get_file_info(fs.FileSelector(inner, recursive=True))
        found += [(f.mtime_ns or 0, _full_path(path.strip(), system, f.path), f.size) for f in files
                  if f.is_file and f.path.endswith(tuple(ACCEPTED_SUFFIXES)) and "/_" not in f.path[len(inner):]]
    return sorted(set(found))


@dataclass
class Split(InputPartition):
    path: str
    start: int
    length: int


def plan_splits(files, split_bytes: int) -> list[Split]:
    """Splits of block files, and one split for any other file; empty files have none."""
    splits = []
    for _, path, length in files:
        step = split_bytes if length > split_bytes and is_blocked(path) else max(length, 1)
        splits += [Split(path, start, length) for start in range(0, length, step)]
    return splits


def read_split(split: Split, split_bytes: int):
    for frame in frames(split.path, split.length, split.start, max(split_bytes, 1)):
        yield pa.RecordBatch.from_pandas(frame, ARROW, preserve_index=False)


class FragmentSource(DataSource):
    @classmethod
    def name(cls):
        return "fragments"

    def schema(self):
        return SCHEMA

    def _paths(self):
        if not self.options.get("path"):
            raise ValueError("fragments need a path")
        return self.options["path"]

    def _split_bytes(self):
        return int(self.options.get("splitBytes", BGZ_SPLIT))

    def reader(self, schema):
        return FragmentReader(self._paths(), self._split_bytes())

    def streamReader(self, schema):
        return FragmentStream(self._paths(), self._split_bytes())

    def writer(self, schema, overwrite):
        return FragmentWriter(self._paths(), schema.fieldNames(), overwrite)


class FragmentReader(DataSourceReader):
    def __init__(self, paths: str, split_bytes: int):
        self.paths, self.split_bytes = paths, split_bytes

    def partitions(self):
        return plan_splits(list_files(self.paths), self.split_bytes)

    def read(self, partition):
        return read_split(partition, self.split_bytes)


class FragmentStream(DataSourceStreamReader):
    """Files in the order of (time of change, path); an offset is the last file of a batch.

    Files are moved into the folder whole. One that appears with an older time than a file that
    was already read is not seen.
    """

    def __init__(self, paths: str, split_bytes: int):
        self.paths, self.split_bytes = paths, split_bytes

    def initialOffset(self):
        return {"time": -1, "path": ""}

    def latestOffset(self):
        files = list_files(self.paths)
        return {"time": files[-1][0], "path": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start, end):
        after, upto = ((o["time"], o["path"]) for o in (start, end))
        return plan_splits([f for f in list_files(self.paths) if after < f[:2] <= upto], self.split_bytes)

    def read(self, partition):
        return read_split(partition, self.split_bytes)


@dataclass
class Written(WriterCommitMessage):
    files: list  # (path below the temporary folder, final path)


def block(data: bytes) -> bytes:
    """One member of a block chain: gzip with its own size in an extra field."""
    codec = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = codec.compress(data) + codec.flush()
    head = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff\x06\0BC\x02\0" + (len(body) + 25).to_bytes(2, "little")
    return head + body + zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little")


def _by_sample(batch: pa.RecordBatch, named: bool):
    """The raw columns of a batch, apart by sample."""
    rows = pa.Table.from_batches([batch])
    if not named:
        yield "", rows.select(FIELDS)
        return
    rows = rows.sort_by("sample_id")
    samples = rows["sample_id"].combine_chunks().dictionary_encode()
    cuts = np.flatnonzero(np.diff(samples.indices.to_numpy(), prepend=-1, append=-1)) if len(samples) else []
    for first, last in zip(cuts[:-1], cuts[1:]):
        yield samples[int(first)].as_py(), rows.select(FIELDS).slice(first, last - first)


class FragmentWriter(DataSourceArrowWriter):
    """Tasks write below `_temporary`; their files move to their places when the job commits."""

    def __init__(self, path: str, columns: list[str], overwrite: bool):
        missing = [c for c in FIELDS if c not in columns]
        if missing:
            raise ValueError(f"fragments need the columns {', '.join(missing)}")
        self.path, self.by_sample, self.overwrite = path, "sample_id" in columns, overwrite

    def write(self, iterator):
        system, folder = open_system(self.path)
        lines = csv.WriteOptions(include_header=False, delimiter="\t", quoting_style="none")
        held, open_files, files = {}, {}, []

        def flush(sample, last=False):
            data = bytes(held[sample])
            stop = len(data) if last else len(data) - len(data) % BLOCK_TEXT
            for at in range(0, stop, BLOCK_TEXT):
                open_files[sample].write(block(data[at: min(at + BLOCK_TEXT, stop)]))
            held[sample] = bytearray(data[stop:])

        for batch in iterator:
            for sample, rows in _by_sample(batch, self.by_sample):
                if sample not in open_files:
                    name = f"part-{uuid.uuid4().hex}.frag.tsv.bgz"
                    final = f"{folder}/{sample}/{name}" if self.by_sample else f"{folder}/{name}"
                    files.append((f"{folder}/_temporary/{name}", final))
                    system.create_dir(f"{folder}/_temporary", recursive=True)
                    open_files[sample], held[sample] = system.open_output_stream(files[-1][0], compression=None), bytearray()
                text = pa.BufferOutputStream()
                csv.write_csv(rows, text, lines)
                held[sample] += text.getvalue()
                if len(held[sample]) >= 16 * BLOCK_TEXT:
                    flush(sample)
        for sample, file in open_files.items():
            flush(sample, last=True)
            file.write(block(b""))  # the end mark of a block chain
            file.close()
        return Written(files)

    def commit(self, messages):
        system, folder = open_system(self.path)
        system.create_dir(folder, recursive=True)
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(folder)):
                if not info.path.endswith("/_temporary"):
                    system.delete_dir(info.path) if info.type == fs.FileType.Directory else system.delete_file(info.path)
        for message in messages:
            for old, new in message.files if message else ():
                system.create_dir(new.rsplit("/", 1)[0], recursive=True)
                system.move(old, new)

    def abort(self, messages):
        system, _ = open_system(self.path)
        for message in messages:
            for old, _ in message.files if message else ():
                system.delete_file(old)


def register(spark) -> None:
    spark.dataSource.register(FragmentSource)
