"""Safe casts, validation, money arithmetic and exact sums."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec, functions as F

# Tokens accepted as booleans, compared trimmed and lower-cased.
TRUE_TOKENS = ("true", "t", "yes", "y", "sí", "si", "1")
FALSE_TOKENS = ("false", "f", "no", "n", "0")
# Fixed value: the plain number shape; prefixes, suffixes and decimal commas do not match.
NUMBER_SHAPE = r"^-?[0-9]+\.?[0-9]*\z"
# The number syntax of SQL text casts; Java's type suffixes (12d), NaN and Infinity are no numbers.
DECIMAL_LITERAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"
# Currency codes and symbols around quoted money.
MONEY_CODES = ("USD", "EUR", "ARS", "BRL", "CLP", "COP", "MXN", "PEN", "UYU")
MONEY_SYMBOLS = "$€£"
#: 20 digits before the point and 18 after it: the widest type of Spark.
FIXED_POINT = "decimal(38,18)"
# One anchored shape per spelling: sign, whole part (plain or with dots between thousands), fraction.
MONEY = (rf"^\s*[{MONEY_SYMBOLS}]?\s*(-?)[{MONEY_SYMBOLS}]?"
         rf"(?:([0-9]{{1,3}}(?:\.[0-9]{{3}})+),([0-9]+)|([0-9]+)(?:[.,]([0-9]*))?)"
         rf"(?:\s+(?:{'|'.join(MONEY_CODES)}))?\s*\z")


def safe_cast_numeric(text: Column, target: str = "double") -> Column:
    """Number from a plainly written text, else NULL; ``12.5`` as an int is NULL too."""
    return F.when(text.rlike(NUMBER_SHAPE), text).try_cast(target)


def safe_cast_boolean(text: Column) -> Column:
    token = F.lower(F.trim(text))
    return F.when(token.isin(*TRUE_TOKENS), True).when(token.isin(*FALSE_TOKENS), False)


def nullable_number(text: Column) -> Column:
    """Number with the empty text as NULL; an unreadable text is NULL as well."""
    return F.when(text.rlike(DECIMAL_LITERAL), F.trim(text)).try_cast("double")


def parse_money(text: Column) -> Column:
    """Amount from ``$78.26``, ``89.5 USD``, ``191286,14`` or ``1.234,56``, else NULL."""
    def part(group: int) -> Column:
        return F.regexp_extract(text, MONEY, group)

    whole = F.concat(F.replace(part(2), F.lit("."), F.lit("")), part(4))
    assembled = F.concat(part(1), whole, F.lit("."), part(3), part(5))
    return F.when(text.rlike(MONEY), assembled).try_cast("double")


def validated_range(value: Column, low: float, high: float) -> tuple[Column, Column]:
    """(value or NULL outside ``[low, high]``, whether it was inside; NULL is not)."""
    inside = value.between(low, high)
    return F.when(inside, value), F.coalesce(inside, F.lit(False))


def validated_point(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Coordinates that are kept only as a valid pair, and the flag of the pair."""
    inside = F.coalesce(lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))
    return F.when(inside, lat), F.when(inside, lon), inside


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL where ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent_to_rate(percent: Column) -> Column:
    return percent / 100.0


def monthly_interest(balance: Column, yearly_rate: Column) -> Column:
    return balance * yearly_rate / 12.0


def billing_months(tenure_months: Column) -> Column:
    """Months that lifetime fees are spread over: at least three, three when unknown."""
    return F.greatest(tenure_months, F.lit(3))


def differs(left: Column, right: Column, tolerance: float) -> Column:
    return F.abs(left - right) > tolerance


def exact_sum(value: Column, over: WindowSpec | None = None) -> Column:
    """Sum of doubles that does not depend on partitioning or order.

    Every value becomes a fixed-point number of 18 places, and one decimal accumulator adds them
    without rounding; the total is stated in the 15 digits a double carries. A value that is no
    number, or of 10**20 and more, stops the query instead of making the total depend on the order.
    """
    v = value.cast("double")
    held = F.when(v.isNull() | (F.abs(v) < 1e20), v.cast(FIXED_POINT)).otherwise(
        F.raise_error(F.lit("a sum met a value that is no number or too large")).cast(FIXED_POINT))
    fixed = F.sum(held)
    total = fixed if over is None else fixed.over(over)
    return F.format_string("%.14e", total.cast("double")).try_cast("double")


def exact_avg(value: Column) -> Column:
    return F.try_divide(exact_sum(value), F.count(value).cast("double"))
