"""Quality rules with risk-controlled cutoffs.

Labelled rows are split by a hash of their id. One half lays out, per stratum, a ladder of
cutoff sets from lenient to strict: level q rejects what lies above the 1 - q quantile of good
documents in any statistic. The other half, the holdout, tests the ladder in that fixed order:
a level stays certified while the exact binomial upper bound (Clopper-Pearson) of its false
rejections is within RISK. The order is fixed before the holdout is seen, so one stratum needs
no further correction; the error budget is divided by the number of strata (Bonferroni). With
probability 1 - ERROR no stratum rejects more than RISK of its good documents. Of the certified
levels the one that parts bad from good documents best in the first half is used; a stratum
without a certified level rejects nothing beyond the base rules.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from finmart.llm.shingles import window_hashes
from finmart.llm.tables import Scratch, long_id, small_batches

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
WINDOW_WORDS = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

#: Share of good documents a stratum may lose, and the chance that any stratum loses more.
RISK = 0.01
ERROR = 0.05
#: Levels of the ladder; 0 is the largest value of a good document.
LEVELS = (0.0, 0.0005, 0.001, 0.002, 0.004, 0.008)
STATISTICS = ("symbol_ratio", "duplicate_ratio", "repeat_ratio", "upper_ratio", "mark_ratio")

_WHITE = [0x20, *range(0x09, 0x0E)]
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")


def text_counts(text: str) -> tuple[int, ...]:
    """The counts of ``_COUNTS`` for one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return (0,) * len(_COUNTS)
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    chars = int(seen.sum() - seen[0x80:0xC0].sum() - seen[_WHITE].sum())
    symbols = int(seen[list(SYMBOLS)].sum())
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeated = 0
    if len(words) > WINDOW_WORDS:
        windows = window_hashes(words, WINDOW_WORDS)
        order = np.argsort(windows, kind="stable")
        equal = windows[order[1:]] == windows[order[:-1]]
        twice = np.zeros(len(windows), dtype=bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        if twice.any():
            change = np.zeros(len(words) + 1, dtype=np.int64)
            at = np.flatnonzero(twice)
            change[at] += 1
            change[at + WINDOW_WORDS] -= 1
            repeated = int(np.count_nonzero(np.cumsum(change[:-1])))
    return (len(words), chars, symbols, len(lines) - len(set(lines)), repeated, len(lines),
            int(seen[0x41:0x5B].sum()), int(seen[0x21] + seen[0x3F]))


@F.pandas_udf(StructType([StructField(name, LongType()) for name in _COUNTS]))
def _counts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_counts(t.decode("utf-8", "replace") if t else "") for t in texts], columns=_COUNTS, dtype="int64")


def _beta_fraction(x: float, a: float, b: float) -> float:
    """Continued fraction of the incomplete beta function, by the modified Lentz method."""
    tiny = 1e-300
    value, c, d = 1.0, 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 1000 + 20 * math.isqrt(int(max(a, b)))):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1.0 + term * d, 1.0 + term / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def binomial_at_most(k: int, n: int, p: float) -> float:
    """Chance of at most k < n successes: the regularised incomplete beta function at 1 - p."""
    a, b, x = float(n - k), float(k + 1), 1.0 - p
    if not 0.0 < p < 1.0:
        return float(p <= 0.0)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(p))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(x, a, b) / a
    return 1.0 - front * _beta_fraction(p, b, a) / b


def upper_bound(rejected: int, total: int, error: float) -> float:
    """Clopper-Pearson: the largest rate at which so few rejections still have chance ``error``."""
    if rejected >= total:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if binomial_at_most(rejected, total, middle) > error else (low, middle)
    return high


def certified_levels(levels: list[tuple[int, int]], risk: float, error: float) -> int:
    """How many levels, from the first on, pass for ``(rejected, total)`` in fixed order."""
    for i, (rejected, total) in enumerate(levels):
        # a level that loses more than risk cannot pass; sparing the sum keeps the test cheap
        if total == 0 or rejected > risk * total or upper_bound(rejected, total, error) > risk:
            return i
    return len(levels)


def _measured(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the counts of each text, shares of them and ``base_failed``."""
    counts = docs.withColumn("_counts", _counts(F.col(text).cast("string").cast("binary"))).withColumns(
        {name: F.col("_counts")[name] for name in _COUNTS}).drop("_counts")

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))

    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return counts.withColumns({
        "base_failed": base,
        "symbol_ratio": share("n_symbols", "word_chars"), "duplicate_ratio": share("n_dup_lines", "n_lines"),
        "repeat_ratio": share("n_repeat_words", "n_words"), "upper_ratio": share("n_upper", "word_chars"),
        "mark_ratio": share("n_marks", "word_chars"),
    })


def _rejects(cutoffs: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.col(name) > cutoffs[i] for i, name in enumerate(STATISTICS)])


def choose_cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> list[tuple]:
    """``(stratum, level, cutoffs)`` per stratum with a certified level.

    Quantiles and counts are Spark aggregations; one row per stratum reaches the driver.
    Labels with NULL quality or id are skipped; an id with several labels is good only if all are.
    """
    marks = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(long_id(F.col("doc_id")).alias("doc_id")).agg((F.min("quality") > 0).alias("good"))
    )
    labelled = (
        measured.where(~F.col("base_failed")).join(marks, "doc_id")
        .withColumn("holdout", F.pmod(F.xxhash64("doc_id", F.lit("quality holdout")), F.lit(2)) == 1)
    )
    fit = labelled.where(~F.col("holdout"))
    shares = F.array(*[F.lit(1.0 - q) for q in LEVELS])
    ladder = fit.where("good").groupBy("stratum").agg(
        *[F.percentile_approx(name, shares, 10_000).alias(name) for name in STATISTICS])
    # level-major: one array of cutoffs per level
    ladder = ladder.select(F.col("stratum").alias("_s"), F.array(*[
        F.array(*[F.col(name)[i] for name in STATISTICS]) for i in range(len(LEVELS))]).alias("ladder"))
    graded = labelled.join(ladder, F.col("stratum").eqNullSafe(F.col("_s")))
    good, held = F.col("good"), F.col("holdout")
    counted = graded.groupBy("stratum").agg(
        F.first("ladder").alias("ladder"), F.count_if(good & held).alias("n"),
        F.count_if(good & ~held).alias("fit_good"), F.count_if(~good & ~held).alias("fit_bad"),
        *[F.count_if(good & held & _rejects(F.col("ladder")[i])).alias(f"k{i}") for i in range(len(LEVELS))],
        *[F.count_if(good & ~held & _rejects(F.col("ladder")[i])).alias(f"g{i}") for i in range(len(LEVELS))],
        *[F.count_if(~good & ~held & _rejects(F.col("ladder")[i])).alias(f"b{i}") for i in range(len(LEVELS))],
    ).collect()
    chosen = []
    for row in counted:
        passed = certified_levels([(row[f"k{i}"], row["n"]) for i in range(len(LEVELS))], risk, error / len(counted))
        gains = [row[f"b{i}"] / max(1, row["fit_bad"]) - row[f"g{i}"] / max(1, row["fit_good"]) for i in range(passed)]
        if gains:
            level = gains.index(max(gains))
            chosen.append((row["stratum"], level, [float(x) for x in row["ladder"][level]]))
    return chosen


def quality_verdicts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     stratum: str = "lang") -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and the level used, for every row of ``docs``.

    A NULL or wordless text has zero counts and fails the base rules. A NULL stratum is a
    stratum. NULL ids never match a label; repeated rows are judged alike. Without labels no
    level is certified, and only the base rules reject. Other columns are not read.
    """
    rows = docs.select(long_id(F.col(doc_id)).alias("doc_id"), F.col(stratum).cast("string").alias("stratum"), F.col(text).alias("text"))
    measured = Scratch(docs.sparkSession, "quality").keep(_measured(rows, "text").drop("text"), "measured")
    return _judged(measured, choose_cutoffs(measured, labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "level", *STATISTICS)


def _judged(measured: DataFrame, chosen: list[tuple]) -> DataFrame:
    table = measured.sparkSession.createDataFrame(chosen, "_s string, level int, cutoffs array<double>")
    rejected = F.coalesce(_rejects(F.col("cutoffs")), F.lit(False))
    # one row per stratum; without the hint Spark does not know its size and shuffles the rows with their texts
    return measured.join(F.broadcast(table), F.col("stratum").eqNullSafe(F.col("_s")), "left").withColumn(
        "kept", ~F.col("base_failed") & ~rejected)


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """Rows of ``docs`` that the base rules and the certified cutoffs keep, with all their columns.

    Rows are stored next to their counts, so each text is measured once and none is shuffled.
    NULL and wordless texts fail the base rules, a NULL stratum is a stratum, NULL ids match no
    label, repeated rows are judged alike. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(whole, long_id(F.col(doc_id)).alias("doc_id"), F.col(stratum).cast("string").alias("stratum"), F.col(text).alias("text"))
    measured = Scratch(docs.sparkSession, "quality").keep(_measured(rows, "text").drop("text"), "measured")
    return _judged(measured, choose_cutoffs(measured, labels)).where("kept").select("_row.*")
