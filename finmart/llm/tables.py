"""Written intermediate tables and connected components, shared by the operators."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType

from finmart.session import shuffles_removed, work_dir  # noqa: F401, shuffles_removed for the operators


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone at exit; leftovers are only disk
        return


class Scratch:
    """Tables written once into the shared work folder, so lost executors cost no recomputation.

    Tables that a returned DataFrame still reads stay until the process ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, self.root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        _remove(self.spark, f"{self.root}/{name}")


#: Bytes of rows handed to Python at once.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows handed to Python at once by bytes, unless the session already does.

    Texts are long: the default of 10,000 rows, whatever their size, fills a worker.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(name, None) or -1) <= BATCH_BYTES:
        spark.conf.set(name, BATCH_BYTES)


def long_id(column: Column) -> Column:
    return column.cast(LongType())


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, component)``, the least node of each.

    Alternates the large-star and small-star steps until the edges are stars around the least
    node. Minima are pre-aggregated before the shuffle and joined back, so a node with a
    third of all edges is never gathered. Every step is a written table.
    """
    current = scratch.keep(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{name}-0",
    )
    seen, step = None, 0
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        step += 1
        large = scratch.keep(large, f"{name}-{step}-large")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lowest.select("u", F.col("m").alias("v"))).distinct()
        )
        small = scratch.keep(small, f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        scratch.drop(f"{name}-{step}-large")
        # decimal: a sum of 64-bit hashes would overflow
        found = small.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        current = small
        if seen == found:
            break
        seen = found
    return (
        current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .union(current.select("v", "v").distinct())
    )
