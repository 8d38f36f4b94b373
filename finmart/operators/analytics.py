"""Aggregation, share and ranking helpers used by the marts."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from finmart.functions.numbers import ratio
from finmart.session import cut_lineage

#: Accuracy of the sketch that brackets quantiles: ranks are within 1 / SKETCH of the rows.
SKETCH = 10_000
#: Offsets of ranges and groups that are broadcast; more of them are joined by a shuffle.
BROADCAST_ENTRIES = 100_000


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def share_of(part: Column, *within: str) -> Column:
    """``part`` over its total within the given columns, or over the whole table.

    For aggregated tables only: the total is a window over already grouped rows.
    """
    return ratio(part, F.sum(part).over(Window.partitionBy(*within)))


def percent_of(part: Column, *within: str) -> Column:
    total = F.sum(part).over(Window.partitionBy(*within))
    return F.round(F.try_divide(part * 100.0, total.cast("double")), 2)


def running_total(value: Column, order: str) -> Column:
    return F.sum(value).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def growth_percent(value: Column, order: str) -> Column:
    """Change against the previous row in percent; NULL for the first row or after a zero."""
    previous = F.lag(value).over(Window.orderBy(order))
    return F.round(ratio(value - previous, previous) * 100, 2)


def ordinal(df: DataFrame, within: str, value: str, name: str, rank: str,
            nulls_last: bool = False) -> DataFrame:
    """Row number inside ``within`` by ``value`` from high to low, then by ``name``; NULL values first or last.

    The rows are stored, split into ranges of (group, value, name) by sampled bounds and numbered
    inside each range. Rows of a group in earlier ranges are counted once per range and added up,
    so a rank is that offset plus the place in the range. Equal values are split by name: neither a
    tie nor a group that holds most rows is ever gathered. ``name`` should be unique in a group.
    """
    value_order = (F.desc_nulls_last if nulls_last else F.desc_nulls_first)(value)
    order = [value_order, F.asc_nulls_first(name)]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(
        cut_lineage(df).repartitionByRange(ranges, F.asc_nulls_first(within), *order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_place", F.row_number().over(Window.partitionBy("_range", within).orderBy(*order)))
    )
    # one entry per range and group met in it: fewer than ranges and groups together
    counts = cut_lineage(placed.groupBy("_range", within).agg(F.count("*").alias("_n")))
    before = Window.partitionBy(within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_range").alias("_r"), F.col(within).alias("_w"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    if counts.count() <= BROADCAST_ENTRIES:
        offsets = F.broadcast(offsets)
    same = (F.col("_range") == F.col("_r")) & F.col(within).eqNullSafe(F.col("_w"))
    return placed.join(offsets, same).withColumn(rank, F.col("_ahead") + F.col("_place")).drop(
        "_range", "_place", "_r", "_w", "_ahead")


def to_usd(df: DataFrame, fx_rates: DataFrame, currency: str, rate: str = "rate_to_usd",
           as_of: date | None = None) -> DataFrame:
    """``df`` with the dollar rate of its currency; NULL for a currency without a rate.

    Of several quotations of a currency the newest one counts, up to ``as_of`` if that is given.
    """
    known = fx_rates if as_of is None else fx_rates.where(F.col("as_of_date") <= F.lit(as_of))
    newest = F.struct("as_of_date", "rate_to_usd") if "as_of_date" in fx_rates.columns else F.col("rate_to_usd")
    quotes = known.groupBy(F.col("currency").alias("_ccy")).agg(
        F.max_by("rate_to_usd", newest).cast("double").alias(rate))
    return df.join(quotes, F.col(currency) == F.col("_ccy"), "left").drop("_ccy")


def _sketched(column: str, fractions: tuple[float, ...]) -> list[Column]:
    """Aggregates of the first scan: ``total``, and bounds around every quantile from a mergeable sketch.

    The sketch misses a rank by at most ``1 / SKETCH`` of the rows, so bounds three times as far
    apart hold the quantile; up to ``SKETCH`` rows the bounds are the extremes.
    """
    v = F.col(column).cast("double")

    def bounds(shift: float, extreme: Column) -> Column:
        shares = [min(max(q + shift, 0.0), 1.0) for q in fractions]
        near = F.percentile_approx(v, shares, SKETCH)
        return F.when(F.count(v) > SKETCH, near).otherwise(F.array(*[extreme] * len(fractions)))

    return [F.count(v).alias("total"), bounds(-3 / SKETCH, F.min(v)).alias("lows"), bounds(3 / SKETCH, F.max(v)).alias("highs")]


def _refined(bracketed: DataFrame, column: str, keys: list[str], fractions: tuple[float, ...]) -> DataFrame:
    """``(keys, quantiles)``: the second scan counts values inside the bounds, and other rows by their gap."""
    v, number = F.col(column).cast("double"), range(len(fractions))
    inside = reduce(lambda a, b: a | b, [v.between(F.col("lows")[i], F.col("highs")[i]) for i in number])
    gap = reduce(lambda a, b: F.when(b.isNull() | (a > b), a).otherwise(b), [
        F.when(F.col("highs")[i] < v, F.col("highs")[i]) for i in number])
    slot = F.when(inside, v).otherwise(F.coalesce(gap, F.lit(float("-inf"))))
    counted = bracketed.where(v.isNotNull()).groupBy(*keys, slot.alias("slot")).agg(
        F.count("*").alias("n"), F.first("total").alias("total"))
    upto = Window.partitionBy(*keys).orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counted.withColumn("upto", F.sum("n").over(upto))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto")), F.col("slot")))

    found = []
    for q in fractions:
        position = F.lit(q) * (F.col("total") - 1)
        found += [at(F.floor(position)), at(F.ceil(position)), F.max(position - F.floor(position))]
    low, high, part = (found[i::3] for i in range(3))
    return running.groupBy(*keys).agg(F.array(*[
        a + (b - a) * c for a, b, c in zip(low, high, part)]).alias("quantiles"))


def exact_quantiles(df: DataFrame, group: str, column: str, fractions: tuple[float, ...]) -> DataFrame:
    """``(group, fraction, quantile)``: interpolated quantiles of a numeric column in every group.

    Two scans: a sketch brackets each quantile, then values inside the brackets are counted and
    ordered; all rows between two brackets are one count. ``group`` must not be NULL.
    """
    bounds = df.groupBy(group).agg(*_sketched(column, fractions))
    found = _refined(df.select(group, column).join(bounds, group), column, [group], fractions)
    return found.select(group, F.explode(F.arrays_zip(
        F.array(*map(F.lit, fractions)).alias("fraction"), F.col("quantiles").alias("quantile"))).alias("at")).select(
        group, F.col("at.fraction").alias("fraction"), F.col("at.quantile").alias("quantile"))


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """The median of a numeric column as a one-row table ``median``, NULL without values.

    Two scans as in :func:`exact_quantiles`; the bounds reach the second one as a scalar subquery.
    """
    bounds = df.agg(F.struct(*_sketched(column, (0.5,))).alias("bounds")).scalar()
    found = _refined(df.select(column, bounds.alias("_bounds")).select(column, "_bounds.*"), column, [], (0.5,))
    return found.agg(F.max(F.col("quantiles")[0]).alias("median"))
