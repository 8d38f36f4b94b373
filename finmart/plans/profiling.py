"""Profiles of raw columns, each computed in one pass over the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from finmart.functions import dates, text
from finmart.functions.numbers import exact_avg, nullable_number
from finmart.operators.analytics import exact_quantiles, count_where

col = F.col


def _stacked(df: DataFrame, columns: dict[str, Column], value: str = "value") -> DataFrame:
    """(column_name, value) for each named column of each row."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), column.alias(value)) for name, column in columns.items()
    ])))


def null_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs, hidden null tokens and their percentage per text column, from one wide aggregate."""
    def counted(name: str) -> Column:
        value = col(name).cast("string")
        nulls = count_where(value.isNull())
        tokens = count_where(value.isNotNull() & text.null_token_to_null(value).isNull())
        return F.struct(
            F.lit(name).alias("column_name"), F.count("*").alias("row_count"), nulls.alias("nulls"),
            tokens.alias("null_tokens"),
            F.round(F.try_divide((nulls + tokens) * 100.0, F.count("*")), 2).alias("pct"))

    return df.agg(F.array(*map(counted, columns)).alias("audited")).select(F.inline("audited"))


def date_format_census(df: DataFrame, columns: list[str]) -> DataFrame:
    shapes = _stacked(df, {c: dates.date_shape(col(c)) for c in columns}, "shape")
    return shapes.groupBy("column_name", "shape").agg(F.count("*").alias("row_count"))


def day_month_order(df: DataFrame, columns: list[str]) -> DataFrame:
    """Which of the two leading numbers is the day, per column and separator."""
    pattern = r"^(\d{2})([-/])(\d{2})[-/](\d{4})\z"
    found = _stacked(df, {c: F.trim(col(c)) for c in columns}).where(col("value").rlike(pattern))
    numbered = found.select(
        "column_name",
        F.regexp_extract("value", pattern, 2).alias("separator"),
        F.regexp_extract("value", pattern, 1).cast("int").alias("first"),
        F.regexp_extract("value", pattern, 3).cast("int").alias("second"),
    )
    counted = numbered.groupBy("column_name", "separator").agg(
        F.count("*").alias("row_count"),
        count_where(col("first") > 12).alias("first_over_12"),
        count_where(col("second") > 12).alias("second_over_12"),
        count_where((col("first") <= 12) & (col("second") <= 12)).alias("ambiguous"),
    )
    day_first, month_first = col("first_over_12") > 0, col("second_over_12") > 0
    return counted.withColumn(
        "verdict",
        F.when(day_first & month_first, "mixed").when(day_first, "day_first")
        .when(month_first, "month_first").otherwise("undecided"),
    )


def coercion_loss(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values present as text that are no number, per column."""
    stacked = _stacked(df, {c: col(c).cast("string") for c in columns})
    lost = col("value").isNotNull() & nullable_number(col("value")).isNull()
    return stacked.groupBy("column_name").agg(
        F.count("value").alias("present"), count_where(lost).alias("lost")
    )


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """How many rows satisfy each named condition."""
    counted = df.agg(*[count_where(rule).alias(name) for name, rule in rules.items()])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("rule"), col(name).alias("row_count")) for name in rules
    ])))


def key_multiplicity(df: DataFrame, key: str) -> DataFrame:
    """How many keys occur once, twice and so on."""
    per_key = df.groupBy(key).agg(F.count("*").alias("occurrences"))
    return per_key.groupBy("occurrences").agg(
        F.count("*").alias("keys"), F.sum("occurrences").alias("row_count")
    )


def inherited_duplicates(children: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Whether repeated child keys occur only under repeated parents.

    Counts are taken per (child key, parent key) first, so a very frequent key is one row.
    """
    repeated_parent = (
        parents.groupBy(parent_key).agg(F.count("*").alias("_n")).where("_n > 1").select(parent_key)
    )
    pairs = children.groupBy(key, parent_key).agg(F.count("*").alias("n"))
    repeated_key = pairs.groupBy(key).agg(F.sum("n").alias("_n")).where("_n > 1").select(key)
    repeated = pairs.join(repeated_key, key, "left_semi")
    marked = repeated.join(
        repeated_parent.withColumn("_repeated", F.lit(True)), parent_key, "left"
    )
    total = F.coalesce(F.sum("n"), F.lit(0))
    explained = F.coalesce(F.sum(F.when(col("_repeated"), col("n"))), F.lit(0))
    return marked.agg(total.alias("duplicate_rows"), explained.alias("under_repeated_parent")).withColumn(
        "fully_explained", col("duplicate_rows") == col("under_repeated_parent")
    )


def category_variants(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Raw spellings of each normalized value, with their counts."""
    stacked = df.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), col(name).alias("raw"), normalized.alias("normalized"))
        for name, normalized in columns.items()
    ])))
    return stacked.groupBy("column_name", "normalized", "raw").agg(F.count("*").alias("row_count"))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Occurrences of each value, NULL included."""
    stacked = _stacked(df, {c: col(c).cast("string") for c in columns})
    return stacked.groupBy("column_name", "value").agg(F.count("*").alias("row_count"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and interpolated quartiles per numeric column."""
    stacked = _stacked(df, {c: col(c).cast("double") for c in columns})
    summary = stacked.groupBy("column_name").agg(
        F.count("value").alias("n"), F.min("value").alias("min_value"),
        exact_avg(col("value")).alias("mean_value"), F.stddev_samp("value").alias("std_value"),
        F.max("value").alias("max_value"),
    )
    quartiles = exact_quantiles(stacked, "column_name", "value", (0.25, 0.5, 0.75)).groupBy("column_name").agg(*[
        F.max(F.when(col("fraction") == q, col("quantile"))).alias(name)
        for q, name in ((0.25, "q1_value"), (0.5, "median_value"), (0.75, "q3_value"))])
    return summary.join(quartiles, "column_name", "left")


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows per equal-width bin of ``[low, high)``; bin 0 and ``bins + 1`` hold the rest."""
    bin_number = F.width_bucket(col(column), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    return df.where(col(column).isNotNull()).groupBy(bin_number.alias("bin")).agg(
        F.count("*").alias("row_count")
    )
