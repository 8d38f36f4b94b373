"""Banding of numbers into labelled buckets and the display order of labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def bucketize(
    value: Column,
    bands: list[tuple[float, str, bool]],
    null_label: str,
    else_label: str,
    floor: float | None = None,
) -> Column:
    """First band ``(upper, label, inclusive)`` that ``value`` fits under.

    NULL takes ``null_label``; values under ``floor`` or over every band take ``else_label``.
    """
    chain = F.when(value.isNull(), null_label)
    if floor is not None:
        chain = chain.when(value < floor, else_label)
    for upper, label, inclusive in bands:
        chain = chain.when(value <= upper if inclusive else value < upper, label)
    return chain.otherwise(else_label)


def age_bucket(age_years: Column) -> Column:
    return bucketize(
        age_years,
        [(18, "under_18", False), (25, "18-25", True), (35, "26-35", True),
         (50, "36-50", True), (65, "51-65", True)],
        null_label="unknown",
        else_label="65+",
    )


def tenure_bucket(months: Column) -> Column:
    return bucketize(
        months,
        [(6, "new", False), (24, "established", True)],
        null_label="unknown",
        else_label="loyal",
    )


def risk_bucket(score: Column) -> Column:
    return bucketize(
        score,
        [(30, "low", True), (60, "medium", True), (85, "high", True), (100, "critical", True)],
        null_label="unknown",
        else_label="unknown",
        floor=0,
    )


def credit_score_bucket(score: Column) -> Column:
    return bucketize(
        score,
        [(579, "poor", True), (669, "fair", True), (739, "good", True),
         (799, "very_good", True), (850, "exceptional", True)],
        null_label="unknown",
        else_label="unknown",
        floor=300,
    )


def utilization_bucket(percent: Column) -> Column:
    return bucketize(
        percent,
        [(30, "healthy", False), (60, "moderate", False), (90, "high", False), (100, "maxed", True)],
        null_label="unknown",
        else_label="over_limit",
    )


def dpd_band(days: Column) -> Column:
    """Six-step ageing of a loan; an unknown number of days counts as the worst step."""
    return F.when(days == 0, "00 - Current").otherwise(
        bucketize(
            days,
            [(29, "01 - Early (1-29)", True), (59, "02 - 30-59 DPD", True),
             (89, "03 - 60-89 DPD", True), (179, "04 - 90-179 DPD", True)],
            null_label="05 - 180+ DPD",
            else_label="05 - 180+ DPD",
        )
    )


def days_past_due_bucket(days: Column) -> Column:
    """Five-step ageing. Days are whole numbers, so the bands leave no gap."""
    return F.when(days < 0, "unknown").otherwise(
        bucketize(
            days,
            [(0, "current", True), (30, "1-30", True), (60, "31-60", True), (90, "61-90", True)],
            null_label="unknown",
            else_label="90+",
        )
    )


# The order in which reports list the labels.
DISPLAY_ORDER = {
    "age": ("under_18", "18-25", "26-35", "36-50", "51-65", "65+", "unknown"),
    "credit_score": ("poor", "fair", "good", "very_good", "exceptional", "unknown"),
    "utilization": ("healthy", "moderate", "high", "maxed", "over_limit", "unknown"),
    "risk": ("low", "medium", "high", "critical"),
}


def display_order(label: Column, kind: str) -> Column:
    """1-based position of a label in its report; NULL for a label without one."""
    return F.nullif(
        F.array_position(F.array(*[F.lit(x) for x in DISPLAY_ORDER[kind]]), label), F.lit(0)
    )
