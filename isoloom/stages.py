"""Tables written between the stages of a query."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the context's
    checkpoint folder. Where neither is set, a folder of our own in local mode, and an error
    on a cluster, whose executors would not see it."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path
    have = spark.sparkContext._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(path)
    return path


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of a query that ends inside go as soon as it has ended."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


class Staged:
    """Intermediate tables in the shared folder: each cuts the lineage, outlives
    lost executors, and can be dropped once a later table has been written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.paths[name] = f"{self.root}/{name}"
        with freed_shuffles(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(conf).delete(path, True)


def numbered(df: DataFrame, order: list[str], into: str, staged: Staged) -> DataFrame:
    """Rows with their number from 0 by ``order``, in a written table.

    Rows are sorted over ranges, and numbered within them; how many rows earlier ranges have is
    carried over one row a range. Equal rows are numbered in any order.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first, at = F.spark_partition_id().alias("range_of_rows"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place_in_range")
    table = staged.write(df.repartitionByRange(max(1, ranges), *order).sortWithinPartitions(*order).select("*", first, at), into)
    before = F.coalesce(F.sum("count").over(Window.orderBy("range_of_rows").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = table.groupBy("range_of_rows").count().select("range_of_rows", before.alias("rows_before"))
    return table.join(F.broadcast(starts), "range_of_rows").select(*df.columns, (F.col("place_in_range") + F.col("rows_before")).alias(into))
