"""Choosing one row per key, deterministically and without gathering a key's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    The ``= 1`` filter on the row number lets Spark cut every key to one candidate per
    task before the shuffle, so a key with very many rows is not gathered. Rows whose key
    is NULL form one group.
    """
    keys = [key] if isinstance(key, str) else key
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def keep_latest(df: DataFrame, key: str) -> DataFrame:
    """Latest version of each key.

    Newest load first, then the larger bronze id, then every other column in schema order,
    so only identical rows can tie.
    """
    recency = ["load_timestamp", "bronze_id"]
    rest = [c for c in df.columns if c not in (key, *recency)]
    order = [F.col(c).desc_nulls_last() for c in recency] + [F.col(c).asc_nulls_last() for c in rest]
    return first_per_key(df, key, order)


def latest_documents(parsed: DataFrame) -> DataFrame:
    """Newest document of each customer, without its arrays; documents lacking an id drop out."""
    arrays = ("accounts", "transactions", "loans")
    profile = parsed.where(F.col("customer_id").isNotNull()).drop(*arrays)
    return keep_latest(profile, "customer_id")


def most_complete(df: DataFrame, key: str, recency: str) -> DataFrame:
    """The most filled-in row of each key, then the most recent one."""
    others = [c for c in df.columns if c != key]
    filled = sum((F.col(c).isNotNull().cast("int") for c in others), F.lit(0))
    ranked = df.withColumn("_filled", filled)
    order = [F.col("_filled").desc(), F.col(recency).desc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in others if c != recency
    ]
    return first_per_key(ranked, key, order).drop("_filled")
