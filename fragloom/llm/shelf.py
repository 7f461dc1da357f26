"""Intermediate tables in the shared folder, with an owner that can delete them."""

from pyspark.sql import DataFrame, SparkSession

from fragloom.session import stage_path

from .words import small_batches


class Shelf:
    """Tables that one call of an operator writes under one folder.

    `keep` cuts the lineage: later jobs start from the written table, also after executors are
    lost. `drop` deletes tables that no returned DataFrame reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = stage_path(spark, name)
        small_batches(spark)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
