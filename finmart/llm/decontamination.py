"""Benchmark decontamination by winnowing.

Of the 5-word hashes inside ten consecutive words the least one is the fingerprint of that window,
so two texts that share ten words share a fingerprint: no shared span of ten words is missed.
Windows of one fingerprint lie next to each other. Documents send only fingerprints that a bitmap
of the benchmark's fingerprints lets through, each with the hashes of its windows; training and
test fingerprints are joined and extended in one step, by fingerprint and window hash (two
independent 64-bit names). Items of fewer words than a window are one window themselves; for their
few widths every place of a document is looked up.

Windows that occur in the same set of items carry the same signature, and documents meet items by
signature, so a passage of ninety windows makes one row for each document and item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from finmart.llm.shingles import mix
from finmart.llm.tables import Scratch, long_id
from finmart.llm.words import bitmap_of, buffers, fold_table, gram_sums, in_bitmap, powers, spans, word_hashes

WINDOW_WORDS = 10
GRAM_WORDS = 5
#: Keys with more than one in so many rows are dealt to ``SALTS`` tasks; at most ``HOT_SHARE`` keys are.
HOT_SHARE = 256
SALTS = 32

#: Letters (lower case), digits and bytes from 0x80 on belong to words.
_FOLD = fold_table(lambda b: None if b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A else 0x20)
_FAR = powers(GRAM_WORDS + 1)[GRAM_WORDS]
_WINDOW_SEED = np.uint64(0xA0761D6478BD642F)
_WIDTH_SEEDS = mix(np.arange(WINDOW_WORDS + 1, dtype=np.uint64))


def _windows(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and hash of every window of ``width`` words, from fingerprints of the words."""
    if width < WINDOW_WORDS:
        sums = gram_sums(words, width)
        return mix(sums ^ _WIDTH_SEEDS[width]), mix(sums ^ _WINDOW_SEED)
    sums = gram_sums(words, GRAM_WORDS)
    n = len(words) - WINDOW_WORDS + 1
    if n <= 0:
        return sums[:0], sums[:0]
    grams = mix(sums)
    least = grams[:n].copy()
    for place in range(1, WINDOW_WORDS - GRAM_WORDS + 1):
        np.minimum(least, grams[place:place + n], out=least)
    return least, mix((sums[:n] + sums[GRAM_WORDS:GRAM_WORDS + n] * _FAR) ^ _WINDOW_SEED)


_HIT = pa.struct([("print", pa.int64()), ("window", pa.int64()), ("width", pa.int32()), ("starts", pa.list_(pa.int32()))])
_HITS = "array<struct<print:long,window:long,width:int,starts:array<int>>>"


def _grouped(text: np.ndarray, prints: np.ndarray, windows: np.ndarray, width: np.ndarray, start: np.ndarray,
             texts: int) -> pa.ListArray:
    """One list per text of its distinct windows, each with the places where it starts."""
    order = np.lexsort((start, windows, prints, text))
    text, prints, windows, width, start = (a[order] for a in (text, prints, windows, width, start))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (text[1:] != text[:-1]) | (prints[1:] != prints[:-1]) | (windows[1:] != windows[:-1])
    first = np.flatnonzero(fresh)
    starts = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), pa.array(start, pa.int32()))
    structs = pa.StructArray.from_arrays(
        [pa.array(prints[first].view(np.int64)), pa.array(windows[first].view(np.int64)),
         pa.array(width[first], pa.int32()), starts], fields=list(_HIT))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text[first], np.arange(texts + 1)), pa.int32()), structs)


def _found(texts: list[bytes], bitmap: np.ndarray | None, widths: list[int]) -> tuple[np.ndarray, pa.ListArray]:
    """Word counts and windows of texts: those in the bitmap, or all of a benchmark item."""
    folded = [t.translate(_FOLD) for t in texts]
    buffer = np.frombuffer(b" ".join(folded), dtype=np.uint8)
    starts, ends = spans(buffer, buffer == 0x20)
    borders = np.cumsum([len(t) + 1 for t in folded])
    text = np.searchsorted(borders, starts, side="right")
    counts = np.bincount(text, minlength=len(texts))
    firsts = np.cumsum(counts) - counts
    words = word_hashes(buffer, starts, ends)
    parts = []
    for width in widths:
        prints, windows = _windows(words, width)
        n = len(prints)
        inside = text[:n] == text[width - 1:width - 1 + n]
        if bitmap is None:  # an item shorter than a window is one window, and no other
            inside &= counts[text[:n]] >= width if width == WINDOW_WORDS else counts[text[:n]] == width
        else:
            inside &= in_bitmap(bitmap, prints)
        at = np.flatnonzero(inside)
        parts.append((text[at], prints[at], windows[at], np.full(len(at), width), at - firsts[text[at]]))
    return counts, _grouped(*map(np.concatenate, zip(*parts)), len(texts))


def _window_batches(bitmap: np.ndarray | None, widths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in buffers(batch, 2):
                counts, hits = _found(texts, bitmap, widths)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)),
                     pa.array(counts, pa.int64()), hits], names=["row", "key", "n_words", "hits"])

    return run


def _with_windows(texts: DataFrame, bitmap: np.ndarray | None, widths: list[int], key: str) -> DataFrame:
    return texts.mapInArrow(_window_batches(bitmap, widths), f"row long, key {key}, n_words long, hits {_HITS}")


def _hot(keys: DataFrame, name: str) -> list[int]:
    """Values of ``name`` with more than one in ``HOT_SHARE`` rows: fewer than that by definition."""
    counts = keys.groupBy(name).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    return [row[0] for row in counts.where(F.col("count") * HOT_SHARE > total).collect()]


def _salted(many: DataFrame, few: DataFrame, on: list[str], spread: Column, hot: list[int]) -> DataFrame:
    """``many.join(few, on)`` with the hot values of the last key dealt to several tasks."""
    if not hot:
        return many.join(few, on)
    is_hot = F.col(on[-1]).isin(hot)
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salt = F.when(is_hot, F.pmod(spread, F.lit(SALTS)).cast("int")).otherwise(0)
    return many.withColumn("salt", salt).join(few.withColumn("salt", F.explode(salts)), [*on, "salt"]).drop("salt")


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words covered by the windows of each row."""
    for batch in batches:
        found = []
        for spots in batch.column(1).to_pylist():
            begin = np.concatenate([np.asarray(s["starts"], dtype=np.int64) for s in spots])
            end = begin + np.repeat([s["width"] for s in spots], [len(s["starts"]) for s in spots])
            order = np.argsort(begin, kind="stable")
            begin, end = begin[order], np.maximum.accumulate(end[order])
            before = np.concatenate(([0], end[:-1]))
            found.append(int(np.maximum(end - np.maximum(begin, before), 0).sum()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64()), batch.column(2)],
                                         names=["row", "n_hit", "signatures"])


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_hit, items array<string>)`` for every row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a window of ten consecutive words of an
    item; an item of fewer words, but not none, is one window. ``items`` are the ids of all items
    with occurring windows, as text, sorted.

    NULL and empty texts have no words; items without words or without id match nothing; rows of
    one item id are one item. Documents with NULL or repeated ids are answered row by row. Other
    columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "decontamination")
    tests = scratch.keep(_with_windows(
        items.where(F.col(item_id).isNotNull()).select(
            F.lit(0).cast("long").alias("row"), F.col(item_id).cast("string").alias("key"),
            F.col(item_text).cast("string").cast("binary").alias("text")),
        None, list(range(1, WINDOW_WORDS + 1)), "string",
    ).select("key", F.explode("hits").alias("hit")).select("key", "hit.print", "hit.window", "hit.width").distinct(), "tests")
    bitmap = bitmap_of(tests.select("print"))
    widths = sorted(row[0] for row in tests.select("width").distinct().collect())
    kept = scratch.keep(_with_windows(
        docs.select(F.monotonically_increasing_id().alias("row"), long_id(F.col(doc_id)).alias("key"),
                    F.col(text).cast("string").cast("binary").alias("text")),
        bitmap, widths or [WINDOW_WORDS], "long"), "documents")

    # windows found in the same items, told by two sums over hashes of the items and their number
    member = F.xxhash64("key").cast("decimal(38,0)")
    other = F.xxhash64(F.lit("item"), F.col("key")).cast("decimal(38,0)")
    signed = scratch.keep(
        tests.groupBy("print", "window").agg(F.sum(member).alias("a"), F.sum(other).alias("b"), F.count("*").alias("n"))
        .select("print", "window", F.xxhash64("a", "b", "n").alias("signature")), "signatures")
    members = tests.join(signed, ["print", "window"]).select("signature", "key").distinct()

    marked = kept.select("row", F.explode("hits").alias("hit")).select("row", "hit.print", "hit.window", "hit.width", "hit.starts")
    spots = _salted(marked, signed, ["print", "window"], F.col("row"), _hot(marked, "window"))
    spots = spots.groupBy("row").agg(
        F.collect_list(F.struct("width", "starts")).alias("spots"), F.collect_set("signature").alias("signatures"))
    spots = scratch.keep(spots.mapInArrow(_covered, "row long, n_hit long, signatures array<long>"), "spots")
    met = spots.select("row", F.explode("signatures").alias("signature"))
    met = _salted(met, members, ["signature"], F.col("row"), _hot(met, "signature"))
    found = met.groupBy("row").agg(F.sort_array(F.collect_set("key")).alias("items"))
    return (
        kept.select("row", F.col("key").alias("doc_id"), "n_words")
        .join(spots.select("row", "n_hit").join(found, "row"), "row", "left")
        .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    )


def contamination_report(found: DataFrame) -> DataFrame:
    """Counts and the hash of the matched item ids, from :func:`contamination`."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
