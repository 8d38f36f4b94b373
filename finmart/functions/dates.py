"""Date parsing and calendar arithmetic."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

# The accepted spellings of a date. A slash means day first, a dash month first.
DATE_SHAPES = {
    "iso": r"^\d{4}-\d{2}-\d{2}\z",
    "compact": r"^\d{8}\z",
    "slash_dmy": r"^\d{2}/\d{2}/\d{4}\z",
    "dash_mdy": r"^\d{2}-\d{2}-\d{4}\z",
}
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def parse_date_multi_format(text: Column) -> Column:
    """Date from any accepted spelling; other texts and impossible dates give NULL.

    Digits are put into ISO order first, so one cheap cast serves every spelling.
    """

    def ordered(year_at: int, month_at: int, day_at: int) -> Column:
        return F.concat_ws(
            "-", text.substr(year_at, 4), text.substr(month_at, 2), text.substr(day_at, 2)
        )

    iso = (
        F.when(text.rlike(DATE_SHAPES["iso"]), text)
        .when(text.rlike(DATE_SHAPES["compact"]), ordered(1, 5, 7))
        .when(text.rlike(DATE_SHAPES["slash_dmy"]), ordered(7, 4, 1))
        .when(text.rlike(DATE_SHAPES["dash_mdy"]), ordered(7, 1, 4))
    )
    return iso.try_cast("date")


def date_shape(text: Column) -> Column:
    """Name of the spelling a text uses, for a format census."""
    trimmed = F.trim(text)
    chain = F.when(text.isNull(), "null").when(
        F.lower(trimmed).isin("null", "n/a", "na", "none", ""), "null_token"
    )
    for name, pattern in DATE_SHAPES.items():
        chain = chain.when(trimmed.rlike(pattern), name)
    return chain.when(trimmed.rlike(r"^\d{4}/\d{2}/\d{2}\z"), "slash_ymd").otherwise("other")


def completed_months(later: Column, earlier: Column) -> Column:
    """Whole months from ``earlier`` to ``later``; negative, truncated to zero, if reversed.

    A month is complete once its day of month is reached, so Jan 31 to Feb 29 counts zero.
    """

    def forward(to: Column, since: Column) -> Column:
        months = (F.year(to) - F.year(since)) * 12 + F.month(to) - F.month(since)
        return months - F.when(F.dayofmonth(to) < F.dayofmonth(since), 1).otherwise(0)

    return F.when(later >= earlier, forward(later, earlier)).otherwise(-forward(earlier, later))


def completed_years(later: Column, earlier: Column) -> Column:
    return (completed_months(later, earlier) / 12).cast("int")


def tenure_years(registered: Column, as_of: Column) -> Column:
    return F.round(F.datediff(as_of, registered) / F.lit(365.25), 2)


def as_of_column(as_of: date | None) -> Column:
    """The anchor of ages and cutoffs: a fixed date, or today when none is given."""
    return F.current_date() if as_of is None else F.lit(as_of)


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def weekday_number(day: Column) -> Column:
    """0 is Sunday."""
    return F.dayofweek(day) - 1


def weekday_name(number: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(name) for name in WEEKDAYS]), number + 1)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def year_month_key(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def year_quarter_key(day: Column) -> Column:
    return F.year(day) * 10 + F.quarter(day)
