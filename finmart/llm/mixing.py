"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Every document gets a rate r: the expected number of its copies. Among all rates between 0 and
``most`` copies whose expected words meet the target of each source, the ones nearest to one
copy each in relative entropy are exponentially tilted: r = min(most, exp(t * size / scale)),
with one multiplier t per source, found by Newton steps on the convex dual. Rates depend on the
source and the size alone, so each step aggregates the counted (source, size) pairs.

Rates are rounded by systematic sampling: documents of a source in the order of size, a copy
wherever the running sum of rates passes the next whole number. Neighbours have like sizes, so
the words taken miss the target by the size of one document at most; of OFFSETS starting points
the one nearest to the target is used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from finmart.llm.tables import Scratch

#: Characters that separate words, the weights in turn, the share of all sizes.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MOST_COPIES = 2

#: Newton stops when every source is within this share of its target.
TOLERANCE = 1e-12
STEPS = 100
#: Starting points tried per source, and documents of one size numbered by one task at least.
OFFSETS = 32
#: Single copies added or taken back per source, each the one that comes nearest to the target.
REPAIRS = 4
BUCKETS = 64
DOCUMENTS_A_BUCKET = 1_000_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = TOTAL_SHARE,
                   most: float = MOST_COPIES) -> DataFrame:
    """``target`` for ``sources(source, source_size)``: by weight, at most ``most`` times the size.

    What a source cannot take is shared again by weight. In the order of size per weight, the
    sources that stop at their limit are the first ones; the level at which the others settle
    is the largest that the rest can pay. One row per source is looked at. Sources are keys of
    ``_key``: they compare by UTF-8 bytes, which is the order of code points.
    """
    by_name = Window.orderBy("source")
    turn = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("weight", turn).withColumn("limit", F.col("source_size") * float(most))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("weight"), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    pot = F.sum("source_size").over(everything) * float(share)
    levelled = (
        ranked.withColumn("pot", pot)
        .withColumn("left", F.col("pot") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(after))
        # the level at the first source that stays below its limit
        .withColumn("open", F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level")))
        .withColumn("at", F.max("open").over(everything))
    )
    return levelled.select(
        "source", "source_size",
        F.least(F.col("limit"), F.coalesce(F.col("at") * F.col("weight"), F.col("limit"))).alias("target"))


def _tilt(t: Column, size: Column, scale: Column) -> Column:
    return F.least(F.lit(float(MOST_COPIES)), F.exp(F.least(t * size / scale, F.lit(1.0))))


def solve_rates(sizes: DataFrame, targets: DataFrame, scratch: Scratch) -> DataFrame:
    """Multiplier ``t`` and ``scale`` per source for ``sizes(source, size, docs)``.

    The gradient of the dual is the words taken minus the target; it grows with t, so every
    step is kept inside the bracket known so far and halves it where Newton would leave it.
    Each iteration is one aggregation of ``sizes``; only the number of open sources reaches
    the driver. A source at its limit has the multiplier infinity, one of no words zero.
    """
    scaled = targets.join(sizes.groupBy("source").agg(
        (F.sum(F.col("docs") * F.pow(F.col("size"), F.lit(2.0))) / F.sum(F.col("docs") * F.col("size"))).alias("scale"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("smallest")), "source")
    full = F.col("target") >= F.col("source_size") * float(MOST_COPIES) * (1 - TOLERANCE)
    # beyond these every document with a word has the most copies, or next to none
    high = F.col("scale") / F.col("smallest") * math.log(MOST_COPIES)
    low = -F.col("scale") / F.col("smallest") * 745.0
    state = scratch.keep(scaled.select(
        "source", "source_size", "target", "scale",
        F.when(F.col("source_size") == 0, 0.0).when(full, float("inf")).otherwise(0.0).alias("t"),
        low.alias("low"), high.alias("high"),
        ((F.col("source_size") == 0) | full).alias("done")), "state-0")
    for step in range(1, STEPS + 1):
        open_ = state.where(~F.col("done")).select("source", "t", "scale")
        rate = _tilt(F.col("t"), F.col("size"), F.col("scale"))
        moving = F.when(rate < MOST_COPIES, rate * F.col("size") * F.col("size") / F.col("scale")).otherwise(0.0)
        sums = (
            sizes.join(open_, "source")
            .groupBy("source").agg(F.sum(F.col("docs") * rate * F.col("size")).alias("words"),
                               F.sum(F.col("docs") * moving).alias("slope"))
        )
        over = F.col("words") - F.col("target")
        met = F.coalesce(F.abs(over) <= TOLERANCE * F.col("target"), F.lit(True))
        low, high = F.when(over < 0, F.col("t")).otherwise(F.col("low")), F.when(over > 0, F.col("t")).otherwise(F.col("high"))
        newton = F.col("t") - F.try_divide(over, F.col("slope"))
        inside = F.coalesce((newton > low) & (newton < high), F.lit(False))
        following = F.when(inside, newton).otherwise((low + high) / 2)
        state = scratch.keep(
            state.join(sums, "source", "left").select(
                "source", "source_size", "target", "scale",
                F.when(F.col("done") | met, F.col("t")).otherwise(following).alias("t"),
                low.alias("low"), high.alias("high"), (F.col("done") | met).alias("done")), f"state-{step}")
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select("source", "source_size", "target", "scale", "t")


def _key(source: Column) -> Column:
    """Source as a text that is never NULL and sorts like the source, NULL last."""
    return F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source))


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(doc_id, source, size, source_size, target, rate, copies, taken)`` for every row of ``docs``.

    ``copies`` is 0, 1 or 2 and ``taken`` is copies times size. A NULL source is a source, a
    NULL text has no words; a wordless document keeps one copy, which takes nothing. NULL ids
    and repeated rows are mixed like others: equal rows share the copies of their place. The
    result depends on the rows alone, not on their order. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.keep(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        word_count(F.col(text).cast("string")).alias("size")), "sized")
    return _mixed(sized, scratch).drop("_row")


def mix_and_repeat(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Every row of ``docs`` as often as the mix takes it, with all its columns."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    sized = docs.select(
        whole, F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        word_count(F.col(text).cast("string")).alias("size"))
    times = F.array_repeat(F.lit(1), F.col("copies"))
    return _mixed(sized, Scratch(docs.sparkSession, "mixing")).select("_row", F.explode(times)).select("_row.*")


def _mixed(sized: DataFrame, scratch: Scratch) -> DataFrame:
    """Rates and copies for rows ``(doc_id, source, size, ...)``; further columns stay."""
    named = sized.withColumnRenamed("source", "_name").withColumn("source", _key(F.col("_name")))
    buckets = max(BUCKETS, sized.count() // DOCUMENTS_A_BUCKET)
    dealt = named.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    counted = scratch.keep(dealt.groupBy("source", "size", "bucket").agg(F.count("*").alias("docs")), "counted")
    sizes = scratch.keep(counted.groupBy("source", "size").agg(F.sum("docs").alias("docs")), "sizes")
    targets = source_targets(sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size")))
    solved = solve_rates(sizes, targets, scratch)

    rate = F.when(F.col("size") == 0, 1.0).when(F.col("t") == float("inf"), float(MOST_COPIES)).otherwise(
        _tilt(F.col("t"), F.col("size"), F.col("scale")))
    rated = sizes.join(solved, "source").withColumn("rate", rate).withColumn("fraction", F.col("rate") - F.floor("rate"))
    # running sums of the fractions: one row per size of a source, then per bucket of a size
    ladder = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    placed = scratch.keep(
        rated.withColumn("begin", F.coalesce(F.sum(F.col("docs") * F.col("fraction")).over(ladder), F.lit(0.0))), "placed")

    def passed(begin: Column, amount: Column, offset: Column) -> Column:
        return (F.floor(begin + amount + offset) - F.floor(begin + offset)).cast("long")

    offsets = [k / OFFSETS for k in range(OFFSETS)]
    missed = placed.groupBy("source").agg(
        F.first("target").alias("goal"), F.sum(F.floor("rate") * F.col("docs") * F.col("size")).alias("whole"),
        *[F.sum(passed(F.col("begin"), F.col("docs") * F.col("fraction"), F.lit(u)) * F.col("size")).alias(f"extra{k}")
          for k, u in enumerate(offsets)])
    tries = F.array(*[
        F.struct(F.abs(F.col("whole") + F.col(f"extra{k}") - F.col("goal")).alias("miss"), F.lit(u).alias("offset"))
        for k, u in enumerate(offsets)])
    best = missed.select("source", F.array_min(tries)["offset"].alias("offset"))

    within = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        counted.withColumn("ahead", F.coalesce(F.sum("docs").over(within), F.lit(0))).withColumnRenamed("docs", "here")
        .join(placed, ["source", "size"]).join(best, "source")
        .select("source", "size", "bucket", "source_size", "target", "rate", "here",
                passed(F.col("begin") + F.col("ahead") * F.col("fraction"), F.col("here") * F.col("fraction"), F.col("offset")).alias("extra"))
    )
    parts = _repaired(scratch.keep(parts, "parts-0"), scratch)
    place = Window.partitionBy("source", "size", "bucket").orderBy(F.xxhash64("doc_id", F.lit("place")), "doc_id")
    copies = F.floor("rate") + F.when(F.col("place") <= F.col("extra"), 1).otherwise(0)
    others = [c for c in sized.columns if c not in ("doc_id", "source", "size")]
    return (
        dealt.withColumn("place", F.row_number().over(place))
        .join(parts, ["source", "size", "bucket"])
        .withColumn("copies", copies.cast("int"))
        .select("doc_id", F.col("_name").alias("source"), "size", "source_size", "target", "rate", "copies",
                (F.col("copies") * F.col("size")).alias("taken"), *others)
    )


def _repaired(parts: DataFrame, scratch: Scratch) -> DataFrame:
    """Moves extra copies of single documents where that brings a source nearer to its target, ``REPAIRS`` times at most."""
    for step in range(1, REPAIRS + 1):
        left = parts.groupBy("source").agg(
            (F.first("target") - F.sum((F.floor("rate") * F.col("here") + F.col("extra")) * F.col("size"))).alias("_left"))
        choices = F.filter(F.array(
            F.when((F.col("rate") < MOST_COPIES) & (F.col("extra") < F.col("here")),
                   F.struct(F.abs(F.col("_left") - F.col("size")).alias("miss"), F.lit(1).alias("move"),
                            F.col("size").alias("z"), F.col("bucket").alias("b"))),
            F.when(F.col("extra") > 0,
                   F.struct(F.abs(F.col("_left") + F.col("size")).alias("miss"), F.lit(-1).alias("move"),
                            F.col("size").alias("z"), F.col("bucket").alias("b")))), lambda x: x.isNotNull())
        best = (
            parts.where(F.col("size") > 0).join(left, "source")
            .select("source", "_left", F.array_min(choices).alias("choice"))
            .groupBy("source").agg(F.first("_left").alias("_left"), F.min("choice").alias("choice"))
            .where(F.col("choice.miss") < F.abs("_left"))
            .select("source", F.col("choice.z").alias("size"), F.col("choice.b").alias("bucket"), F.col("choice.move").alias("move"))
        )
        parts = scratch.keep(
            parts.join(best, ["source", "size", "bucket"], "left")
            .withColumn("extra", F.col("extra") + F.coalesce("move", F.lit(0))).drop("move"), f"parts-{step}")
        scratch.drop(f"parts-{step - 1}")
    return parts
