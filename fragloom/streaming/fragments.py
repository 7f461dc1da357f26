"""File streams of fragment text: ingest, running bin counts, and bin statistics with the exact
median kept in a table of mergeable deltas."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from fragloom import schemas as S
from fragloom.functions import measures as m
from fragloom.operators.coverage import bin_statistics, fragment_hits, length_counts
from fragloom.operators.fragments import ingest
from fragloom.params import DEFAULTS, Params
from fragloom.sources.readers import bgz_splits, decode_splits, tab_fields

KEYS = ["sample_id", "chrom", "start"]


def fragment_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """New fragment files under `folder/<sample_id>/`; the folder that holds a file names its sample.

    `.gz` and plain text are decoded by Spark, `.bgz` files by the block reader in splits, as in
    the batch readers. Malformed rows fail the query instead of vanishing.
    """
    def files(reader, names):
        return reader.option("maxFilesPerTrigger", files_per_trigger).option(
            "recursiveFileLookup", "true").option("pathGlobFilter", names)

    lines = files(spark.readStream, "{*.gz,*[!z]}").text(folder).filter(F.trim("value") != "")
    text = lines.select(*tab_fields(lines, S.RAW_FRAGMENT), F.col("_metadata.file_path").alias("path"))
    blocked = files(spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary"), "*.bgz").load(folder).select("path", "length")
    rows = text.unionByName(decode_splits(bgz_splits(blocked)))
    return rows.withColumn("sample_id", F.element_at(F.split("path", "/"), -2)).drop("path")


def ingest_stream(raw: DataFrame, out: str, checkpoint: str, style: str = "no_chr",
                  params: Params = DEFAULTS, trigger=None):
    """Canonical fragments appended to a Parquet table by sample, each file exactly once.

    The transformation is row-wise, so the stream keeps no state.
    """
    writer = (
        ingest(raw, style, params).writeStream.format("parquet").partitionBy("sample_id")
        .option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    )
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def running_bin_counts(fragments: DataFrame, bin_size: int, params: Params = DEFAULTS) -> DataFrame:
    """Counts and length sums per sample and tile of a stream (or batch) of fragments.

    State is bounded by samples x tiles; there is no event time and no watermark. `BinState`
    keeps the exact median too.
    """
    length = F.col("length")
    hits = fragment_hits(fragments, None, bin_size)
    return hits.groupBy("sample_id", "chrom", "start").agg(
        F.count(F.lit(1)).alias("n_total_fragments"),
        m.count_where(m.is_short(length, params)).alias("n_short_100_150"),
        m.count_where(m.is_long(length, params)).alias("n_long_151_220"),
        F.sum(length).alias("length_sum"))


def store_updates(counts: DataFrame, out: str, checkpoint: str, trigger=None):
    """Write running totals in update mode: each trigger appends the rows of the keys it touched,
    under its batch number, so that a batch that is run again replaces itself."""
    def store(df, batch):
        df.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    writer = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(store)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def latest_rows(spark: SparkSession, out: str, keys, schema) -> DataFrame:
    """The last row of every key among stored updates."""
    rows = spark.read.schema(schema.add("batch", "long") if "batch" not in schema.names else schema).parquet(out)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_last"))
    return last.select(*keys, *[f"_last.{c}" for c in values])


class BinState:
    """Counts per sample, tile and length of a stream, as tables that merge by adding up.

    `deltas/batch=N` holds what micro-batch N added, only the keys it touched; a batch that is run
    again after a failure replaces its own delta. `base/upto=N` holds everything up to batch N, and
    is written by `compact`, at any time and from any session. Reading adds the last finished base
    and the deltas after it. From these counts follow all bin statistics, the exact median too.
    """

    SCHEMA = "sample_id string, chrom string, start long, length long, n long"

    def __init__(self, spark: SparkSession, folder: str, bin_size: int):
        self.spark, self.folder, self.bin_size = spark, folder.rstrip("/"), bin_size

    def follow(self, fragments: DataFrame, checkpoint: str, trigger=None):
        """Start adding a stream of fragments."""
        def store(df, batch):
            counted = length_counts(fragment_hits(df, None, self.bin_size), KEYS)
            counted.write.mode("overwrite").parquet(f"{self.folder}/deltas/batch={batch}")

        writer = fragments.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def counts(self) -> DataFrame:
        """(sample_id, chrom, start, length, n) over all stored batches."""
        base, deltas = self._tables()
        paths = ([f"{self.folder}/base/upto={base}"] if base is not None else []) + [
            f"{self.folder}/deltas/batch={n}" for n in deltas]
        if not paths:
            return self.spark.createDataFrame([], self.SCHEMA)
        rows = self.spark.read.schema(self.SCHEMA).parquet(*paths)
        return rows.groupBy(*KEYS, "length").agg(F.sum("n").alias("n"))

    def statistics(self, params: Params = DEFAULTS) -> DataFrame:
        """Counts, length sum and exact median of every touched tile, as `coverage.bin_counts`."""
        return bin_statistics(self.counts(), KEYS, (), params)

    def compact(self) -> None:
        """Merge base and deltas into a new base. Tables that the base before it already replaced
        are deleted; those just merged stay for readers that have begun."""
        base, deltas = self._tables()
        if not deltas:
            return
        self.counts().write.mode("overwrite").parquet(f"{self.folder}/base/upto={max(deltas)}")
        if base is not None:
            for kind, numbers in (("base/upto", self._numbers("base")), ("deltas/batch", self._numbers("deltas"))):
                for n in numbers:
                    if n < base or kind.startswith("deltas") and n == base:
                        self._fs().delete(self._path(f"{kind}={n}"), True)

    def _tables(self):
        """Number of the last finished base, and of the finished deltas after it."""
        base = max(self._numbers("base"), default=None)
        return base, [n for n in self._numbers("deltas") if base is None or n > base]

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the finished tables of a kind, in order."""
        path, files = self._path(kind), self._fs()
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return sorted(int(n.split("=")[1]) for n in names if "=" in n and files.exists(self._path(f"{kind}/{n}/_SUCCESS")))

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())
