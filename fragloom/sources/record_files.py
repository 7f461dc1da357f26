"""`record_files`: a sink of one file for each row of text, and tasks that list and read such files.

Spark's own text sink starts a program for every file it makes on a local disk and writes a checksum file beside
it; its reader lists all files in the driver. Here a task writes folders of FOLDER_FILES files below
`_temporary`, the driver moves one folder for each task when the job commits, and folders are listed by tasks.
"""

import sys
import uuid
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter

from fragloom.session import stage
from fragloom.sources import fragment_source
from fragloom.sources.fragment_source import Written, _full_path, open_system

# The functions travel to the workers, executors need no copy of this package.
cloudpickle.register_pickle_by_value(fragment_source)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Files in one folder; texts and bytes that a task holds at most, beside one file.
FOLDER_FILES, HELD_FILES, HELD_BYTES = 1000, 1000, 1 << 20


def opens(path: str) -> bool:
    """Whether Arrow has the file system of a path; patterns are left to Spark."""
    if any(c in path for c in "*?[{"):
        return False
    try:
        system, inner = open_system(path)
        system.get_file_info(inner)
        return True
    except (OSError, pa.ArrowException):
        return False


class RecordSink(DataSource):
    @classmethod
    def name(cls):
        return "record_files"

    def schema(self):
        return "text string"

    def writer(self, schema, overwrite):
        return RecordWriter(self.options["path"].rstrip("/"), overwrite)


class RecordWriter(DataSourceArrowWriter):
    """A task that runs again writes a folder of its own; only one of them is moved to its place."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator):
        system, folder = open_system(self.path)
        task = f"part-{TaskContext.get().partitionId():05d}"
        own, made = f"{folder}/_temporary/{task}-{uuid.uuid4().hex}", 0
        for batch in iterator:
            for text in batch.column(0).cast(pa.large_binary()):
                part = f"{own}/{made // FOLDER_FILES:06d}"
                if made % FOLDER_FILES == 0:
                    system.create_dir(part, recursive=True)
                with system.open_output_stream(f"{part}/{task}-{made:09d}.txt", compression=None) as file:
                    file.write((text.as_py() or b"") + b"\n")
                made += 1
        return Written([(own, f"{folder}/{task}")] if made else [])

    def commit(self, messages):
        system, folder = open_system(self.path)
        system.create_dir(folder, recursive=True)
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(folder)):
                if not info.path.endswith("/_temporary"):
                    system.delete_dir(info.path) if info.type == fs.FileType.Directory else system.delete_file(info.path)
        for message in messages:
            for old, new in message.files if message else ():
                system.move(old, new)
        if system.get_file_info(f"{folder}/_temporary").type == fs.FileType.Directory:
            system.delete_dir(f"{folder}/_temporary")

    def abort(self, messages):
        system, _ = open_system(self.path)
        for message in messages:
            for old, _ in message.files if message else ():
                system.delete_dir(old)


def _shown(name: str) -> bool:
    return not (name.startswith(".") or name.startswith("_") and "=" not in name)


def _children(batches):
    """The files and folders in each folder, and files that were given as such; hidden names and empty files go, as in Spark."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, inner = open_system(path)
            info = system.get_file_info(inner)
            if info.type == fs.FileType.NotFound:
                raise ValueError(f"no such path: {path}")
            inside = [info] if info.is_file else system.get_file_info(fs.FileSelector(inner))
            found = [i for i in inside if i.size != 0 and (info.is_file or _shown(i.base_name))]
            for first in range(0, len(found), HELD_FILES):
                some = found[first: first + HELD_FILES]
                yield pa.record_batch(
                    [pa.array([_full_path(path, system, i.path) for i in some], pa.string()), pa.array([i.is_file for i in some], pa.bool_())],
                    names=["path", "is_file"])


def _contents(batches):
    """Each file whole, as (path, json)."""
    def packed():
        # Bytes as they are: a text that is no UTF-8 is not refused here.
        return pa.record_batch([pa.array(paths, pa.string()), pa.array(texts, pa.binary()).view(pa.string())], names=["path", "json"])

    paths, texts, held = [], [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, inner = open_system(path)
            with system.open_input_stream(inner, compression="detect") as file:
                texts.append(file.read())
            paths.append(f"file:{quote(path, safe="/:=@!$&'()*+,;~")}" if path.startswith("/") else path)
            held += len(texts[-1])
            if len(texts) >= HELD_FILES or held >= HELD_BYTES:
                yield packed()
                paths, texts, held = [], [], 0
    if texts:
        yield packed()


def list_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All files below the paths, listed level by level, each by a task for every core."""
    level, files = spark.createDataFrame([(p,) for p in paths], "path string"), None
    while True:
        dealt = level.repartition(spark.sparkContext.defaultParallelism, F.xxhash64("path"))
        found = stage(dealt.mapInArrow(_children, "path string, is_file boolean"), "listed")
        here = found.filter("is_file").select("path")
        files = here if files is None else files.union(here)
        level = found.filter("NOT is_file").select("path")
        if not level.head(1):
            return files


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, json) of every file below the paths. A task holds few of its files at once."""
    tasks = 4 * spark.sparkContext.defaultParallelism
    return list_files(spark, paths).repartition(tasks, F.xxhash64("path")).mapInArrow(_contents, "path string, json string")
