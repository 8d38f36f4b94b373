"""Range-partitioned reads and staging writes over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: Steps of the id histogram; that many rows of counts reach the driver at most.
STEPS = 10_000


def balanced_predicates(column: str, starts: list[int], counts: list[int], rows: int) -> list[str]:
    """Predicates that hold about ``rows`` rows each, from steps that start at ``starts``.

    Every id lies in exactly one of them: the first one has no lower bound and takes NULL, the last
    one has no upper bound. A step with more than ``rows`` rows is a range of its own.
    """
    cuts, held = [], 0
    for start, count in sorted(zip(starts, counts)):
        if held and held + count > rows:
            cuts.append(start)
            held = 0
        held += count
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"({column} < {cuts[0]} OR {column} IS NULL)", *inner, f"{column} >= {cuts[-1]}"]


def read_partitioned(
    spark: SparkSession,
    url: str,
    table: str,
    column: str = "id",
    rows_per_partition: int = 1_000_000,
    **properties: str,
) -> DataFrame:
    """Scan ``table`` in ranges of ``column`` that hold about equally many rows.

    The database counts its ids in ``STEPS`` steps of equal width; neighbouring steps are put
    together until they hold ``rows_per_partition`` rows, so crowded ids are cut finely.
    """
    bounds = spark.read.jdbc(
        url,
        f"(select min({column}) as low, max({column}) as high from {table}) as bounds",
        properties=properties,
    ).first()
    if bounds["low"] is None:
        return spark.read.jdbc(url, table, properties=properties)
    low, width = bounds["low"], -(-(bounds["high"] + 1 - bounds["low"]) // STEPS)
    step = f"floor(({column} - {low}) / {width})"
    histogram = spark.read.jdbc(
        url,
        f"(select {step} as step, count(*) as n from {table} where {column} is not null group by {step}) as steps",
        properties=properties,
    ).collect()
    predicates = balanced_predicates(
        column, [low + int(r["step"]) * width for r in histogram], [r["n"] for r in histogram], rows_per_partition)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def overwrite_staging(df: DataFrame, url: str, table: str, **properties: str) -> None:
    """Full refresh that empties and refills the table, keeping its grants and indexes."""
    df.write.option("truncate", "true").jdbc(url, table, mode="overwrite", properties=properties)
