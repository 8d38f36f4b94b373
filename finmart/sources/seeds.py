"""Reference data: exchange rates, country currencies, geography and the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from finmart import schemas
from finmart.functions import dates

# Code, name, region, default currency.
COUNTRIES = [
    ("CO", "Colombia", "LATAM", "COP"),
    ("UY", "Uruguay", "LATAM", "UYU"),
    ("AR", "Argentina", "LATAM", "ARS"),
    ("MX", "Mexico", "LATAM", "MXN"),
    ("CL", "Chile", "LATAM", "CLP"),
    ("PE", "Peru", "LATAM", "PEN"),
    ("BR", "Brazil", "LATAM", "BRL"),
]
# Units of currency, US dollars per unit, quotation date.
FX_RATES = [
    ("USD", "1.000000"),
    ("ARS", "0.000717"),
    ("UYU", "0.024850"),
    ("COP", "0.000264"),
    ("MXN", "0.058000"),
    ("CLP", "0.001127"),
    ("PEN", "0.270000"),
    ("BRL", "0.200000"),
    ("EUR", "1.160000"),
]
FX_QUOTED_ON = "2026-05-16"
CALENDAR = ("2015-01-01", "2030-12-31")


def literal_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A table of constants, built inside the plan."""
    names = columns.split()
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def read_seed(spark: SparkSession, path: str, schema) -> DataFrame:
    """Seed file with a header line and declared column types."""
    return spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(path)


def fx_rates(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path:
        return read_seed(spark, path, schemas.FX_RATES)
    rows = literal_table(spark, FX_RATES, "currency rate")
    return rows.select(
        "currency",
        F.col("rate").cast("decimal(18,8)").alias("rate_to_usd"),
        F.lit(FX_QUOTED_ON).cast("date").alias("as_of_date"),
    )


def country_currency(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path:
        return read_seed(spark, path, schemas.COUNTRY_CURRENCY)
    return dim_geography(spark).select(
        "country_code", F.col("default_currency").alias("currency_code")
    )


def dim_geography(spark: SparkSession) -> DataFrame:
    return literal_table(spark, COUNTRIES, "country_code country_name region default_currency")


def date_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.range(1).select(
        F.explode(
            F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
        ).alias("date_day")
    )


def calendar_attributes(day) -> dict:
    """Columns that describe one day. Month and weekday names are not blank-padded."""
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "week_of_year": F.weekofyear(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week_num": dates.weekday_number(day),
        "day_of_year": F.dayofyear(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_name_short": F.date_format(day, "MMM"),
        "day_name": F.date_format(day, "EEEE"),
        "day_name_short": F.date_format(day, "EEE"),
        "is_weekend": dates.is_weekend(day),
        "year_month_key": dates.year_month_key(day),
        "year_quarter_key": dates.year_quarter_key(day),
        "year_month_label": F.date_format(day, "yyyy-MM"),
        "year_quarter_label": F.format_string("Q%d %d", F.quarter(day), F.year(day)),
        "week_start": F.trunc(day, "week"),
        "month_start": F.trunc(day, "month"),
        "quarter_start": F.trunc(day, "quarter"),
        "year_start": F.trunc(day, "year"),
    }


def dim_date(spark: SparkSession, first: str = CALENDAR[0], last: str = CALENDAR[1]) -> DataFrame:
    day = F.col("date_day")
    attributes = calendar_attributes(day)
    return date_spine(spark, first, last).select(
        day, *[column.alias(name) for name, column in attributes.items()]
    )
