"""Session settings and the shared folder for checkpoints and stage tables."""

import gc
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_folders: dict[str, str] = {}


def build_session(app_name="fragloom", master=None, **extra) -> SparkSession:
    """A session with adaptive execution and UTC; `extra` holds further settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and stage tables that every executor can reach.

    A cluster names it in `spark.checkpoint.dir`. Only a local session may fall
    back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    key = context.applicationId
    if key not in _local_folders:
        _local_folders[key] = tempfile.mkdtemp(prefix="fragloom-")
    return _local_folders[key]


def shuffle_tasks(spark: SparkSession) -> int:
    """Configured number of shuffle tasks, for steps with little data but much work:
    a repartition by a stated number is not merged by adaptive execution."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by=None) -> DataFrame:
    """Write `df` to the shared folder and read it back: later jobs start from the
    stored table instead of repeating its lineage, also after executors are lost."""
    path = stage_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Seconds between two collections of the driver's garbage.
COLLECT_S = 5
_collecting = threading.Lock()


def collect_garbage(spark: SparkSession) -> None:
    """Free what finished jobs left in the driver: plans, and with them broadcasts and shuffles."""
    gc.collect()  # DataFrames that nobody holds keep their plans in the JVM
    spark.sparkContext._jvm.System.gc()


@contextmanager
def collected(spark: SparkSession):
    """For steps of many small jobs: the driver's garbage is collected every few seconds.

    Each stage leaves buffers of megabytes behind. By itself the driver grows its heap to the limit
    before it collects them all, and keeps what it has grown. Inside another such step this does nothing.
    """
    if not _collecting.acquire(blocking=False):
        yield
        return
    over = threading.Event()

    def collect():
        while not over.wait(COLLECT_S):
            collect_garbage(spark)

    thread = threading.Thread(target=collect, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()
        _collecting.release()
