"""Tables stored by layer, as files under a root or as catalog tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from finmart.session import shuffles_removed

LAYERS = ("bronze", "silver_raw", "silver", "gold")


class TableStore:
    """Parquet tables at ``root/layer/name``, packed by zstd; the folder per layer is its namespace."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root}/{layer}/{name}"

    def save(self, df: DataFrame, layer: str, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` as a full refresh and return the stored table.

        The new files are written aside. When they are complete, the old ones are moved away, the
        new ones take their place, and the old ones are deleted last: a failed build or switch
        leaves the stored table as it was. What was shuffled for them is removed once they are written.
        """
        target = self.path(layer, name)
        aside = f"{target}.{uuid.uuid4().hex}"
        with shuffles_removed(self.spark):
            df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(aside)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(target).getFileSystem(self.spark._jsc.hadoopConfiguration())
        old = f"{aside}.old"
        replaces = files.exists(path(target))
        if replaces and not files.rename(path(target), path(old)):
            raise OSError(f"{target} could not be moved away")
        if not files.rename(path(aside), path(target)):
            if replaces:
                files.rename(path(old), path(target))
            raise OSError(f"{aside} could not be moved to {target}")
        files.delete(path(old), True)
        return self.spark.read.schema(df.schema).parquet(self.path(layer, name)).select(*df.columns)

    def load(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))


def create_namespaces(spark: SparkSession, prefix: str = "", root: str | None = None) -> None:
    """One database per layer, named ``prefix`` and layer, under ``root`` if that is given."""
    for layer in LAYERS:
        place = f" LOCATION '{root.rstrip('/')}/{layer}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}{place}")


def save_table(df: DataFrame, layer: str, name: str, partition_by: tuple[str, ...] = ()) -> None:
    """Create or refresh a catalog table, keeping the table object on a refresh.

    A refresh fills the columns of the table by name; a missing or an unknown one is an error. It
    replaces a whole table, but of a partitioned table only the partitions that ``df`` has rows for.
    """
    target = f"{layer}.{name}"
    if df.sparkSession.catalog.tableExists(target):
        columns = df.sparkSession.table(target).columns
        if sorted(columns) != sorted(df.columns):
            raise ValueError(f"{target} has columns {columns}, the refresh {df.columns}")
        conf, mode = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
        before = conf.get(mode)
        conf.set(mode, "dynamic")  # inserts into a table take it from the session only
        try:
            df.select(*columns).write.insertInto(target, overwrite=True)
        finally:
            conf.set(mode, before)
    else:
        df.write.saveAsTable(target, format="parquet", partitionBy=list(partition_by) or None)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, in one job; a table without rows is listed with zero."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def catalog_inventory(spark: SparkSession, layer: str) -> DataFrame:
    """Row counts of the catalog tables in one layer."""
    names = sorted(t.name for t in spark.catalog.listTables(layer) if not t.isTemporary)
    return table_inventory({name: spark.table(f"{layer}.{name}") for name in names})
