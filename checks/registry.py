"""Collects (query, SQL) pairs under one name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.oracle_tables import R, with_tables
from finmart.plans.warehouse import Warehouse, demo_warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at six places, three from 1e8 on, so that both engines print the same digits."""
    def shown(name: str):
        return F.when(F.abs(name) >= 1e8, F.round(name, 3)).otherwise(F.round(name, 6))

    return df.select(*[
        shown(name).alias(name) if kind == "double" else F.col(name) for name, kind in df.dtypes
    ])


def register(name: str, build: Callable[[Warehouse], DataFrame], sql: str | None = None) -> None:
    """``build`` gets the warehouse over the given folder; ``sql`` may name any oracle table."""
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = lambda spark, sf_dir: rounded(build(demo_warehouse(spark, sf_dir)))
    if sql is not None:
        ORACLES[name] = with_tables(sql.strip())


def columns_sql(shape: str) -> str:
    """Select list for a shape: doubles are rounded as in ``rounded``."""
    return ", ".join(
        f"{R(c[:-1])} AS {c[:-1]}" if c.endswith("~") else c for c in shape.split()
    )
