"""Periodic runs of words: longest common extensions by a difference cover, runs by a harmonic grid.

Only suffixes that start in a difference cover modulo 13 are sorted (by their next 13 words, then
by doubling along their residue class). Two positions reach sampled places together after less
than 13 words, so an extension is a few word comparisons and one range minimum over the sorted
samples. For every period ``p`` a grid as wide as the least run minus ``p`` meets each run; the
grid points that agree are extended both ways. The number of points is harmonic in the length.

The texts of one buffer are laid end to end with a separator of its own after each, so that no
extension leaves its text. Only texts in which some comparison survives 13 words are sorted.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from finmart.llm.tables import long_id
from finmart.llm.words import buffers

#: A perfect difference cover: every residue is a difference of two members in one way.
MODULUS = 13
COVER = (0, 1, 3, 9)
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Grid points compared at once.
BLOCK = 1 << 19


def _shift_table() -> np.ndarray:
    """Least shift that takes both residues into the cover."""
    table = np.zeros((MODULUS, MODULUS), dtype=np.int64)
    for a in range(MODULUS):
        for b in range(MODULUS):
            table[a, b] = next(d for d in range(MODULUS) if (a + d) % MODULUS in COVER and (b + d) % MODULUS in COVER)
    return table


_SHIFTS = _shift_table()


def _names(*keys: np.ndarray) -> np.ndarray:
    """Dense ranks of rows compared by ``keys``, the first one leading."""
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), dtype=np.int64)
    for key in keys:
        fresh[1:] |= key[order[1:]] != key[order[:-1]]
    ranks = np.empty(len(order), dtype=np.int64)
    ranks[order] = np.cumsum(fresh)
    return ranks


class Extensions:
    """Longest common extensions to the right over one sequence of non-negative ids."""

    def __init__(self, words: np.ndarray):
        self.size = len(words)
        # ends differ from every word and from each other: -1, -2, ...
        self.words = np.concatenate((words, -1 - np.arange(MODULUS, dtype=np.int64)))
        self.place: np.ndarray | None = None

    def matching(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | int = MODULUS) -> np.ndarray:
        """Equal words from ``a`` and ``b`` on, at most ``limit``."""
        found = np.zeros(len(a), dtype=np.int64)
        alive = np.arange(len(a))
        limits = np.broadcast_to(limit, len(a))
        for step in range(MODULUS):
            alive = alive[limits[alive] > step]
            if not len(alive):
                break
            same = self.words[np.minimum(a[alive] + step, self.size)] == self.words[np.minimum(b[alive] + step, self.size + 1)]
            alive = alive[same]
            found[alive] += 1
        return found

    def _sort(self) -> None:
        """Ranks of the sampled suffixes, and range minima of their common prefixes."""
        n = self.size
        in_cover = np.zeros(MODULUS, dtype=bool)
        in_cover[list(COVER)] = True
        at = np.arange(n + 1)  # the end is a place, so the last sample of each class reads it
        sample = at[in_cover[at % MODULUS]]
        by_class = sample[np.lexsort((sample, sample % MODULUS))]  # one class after the other
        m = len(by_class)
        last = np.empty(m, dtype=bool)  # last sample of its class
        last[:-1] = by_class[1:] != by_class[:-1] + MODULUS
        last[-1:] = True
        ids = self.words + MODULUS + 1
        width = max(int(ids.max()).bit_length(), 1)
        per = max(1, 62 // width)
        packed = []
        for first in range(0, MODULUS, per):
            key = np.zeros(m, dtype=np.int64)
            for step in range(first, min(first + per, MODULUS)):
                key = (key << width) | ids[by_class + step]
            packed.append(key)
        levels = [_names(*packed)]
        class_end = np.flatnonzero(last)
        follow = class_end[np.searchsorted(class_end, np.arange(m))] - np.arange(m)  # samples that follow in the class
        reach = 1
        while levels[-1].max() + 1 < m:
            name = levels[-1]
            far = np.minimum(np.arange(m) + reach, m - 1)
            second = np.where(follow >= reach, name[far] + 1, 0)
            levels.append(_names(name, second))
            reach *= 2
        rank = levels.pop()
        order = np.empty(m, dtype=np.int64)
        order[rank] = np.arange(m)
        self.place = np.zeros(n + 2, dtype=np.int64)
        self.place[by_class] = rank
        # common prefixes of neighbours: whole blocks from the coarsest names down, then words.
        # No other block equals the last one of a class, so equal names always span whole blocks.
        a, b = order[:-1].copy(), order[1:].copy()
        blocks = np.zeros(len(a), dtype=np.int64)
        for level in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero(levels[level][a] == levels[level][b])
            for side in (a, b, blocks):
                side[same] += 1 << level
        left, right = by_class[order[:-1]] + blocks * MODULUS, by_class[order[1:]] + blocks * MODULUS
        common = blocks * MODULUS + self.matching(np.minimum(left, n), np.minimum(right, n + 1))
        self.minima = [common]
        while 2 << (len(self.minima) - 1) <= len(common):
            half = 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(self.minima[-1][:-half], self.minima[-1][half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``; ``a != b``."""
        if not len(a):
            return np.zeros(0, dtype=np.int64)
        if self.place is None:
            self._sort()
        shift = _SHIFTS[a % MODULUS, b % MODULUS]
        found = self.matching(a, b, shift)
        whole = np.flatnonzero((found == shift) & (np.maximum(a, b) + shift < self.size))
        if len(whole):
            x, y = self.place[a[whole] + shift[whole]], self.place[b[whole] + shift[whole]]
            low, high = np.minimum(x, y), np.maximum(x, y)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            for k in np.unique(level):
                at = np.flatnonzero(level == k)
                found[whole[at]] += np.minimum(self.minima[k][low[at]], self.minima[k][high[at] - (1 << int(k))])
        return found


def _grid(sizes: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Grid points of all texts as (text, place in the sequence, period), about ``BLOCK`` at a time."""
    periods = sizes // LEAST_PERIODS
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(1, len(text) + 1) - np.repeat(np.cumsum(periods) - periods, periods)
    least = np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    fits = sizes[text] >= least
    text, period, least = text[fits], period[fits], least[fits]
    # places below size - period; a run is long enough to hold one of them
    counts = -(-(sizes[text] - period) // (least - period))
    block = np.cumsum(counts) // BLOCK
    for part in np.split(np.arange(len(text)), np.flatnonzero(np.diff(block)) + 1):
        n = counts[part]
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        of = np.repeat(part, n)
        yield text[of], firsts[text[of]] + nth * (least - period)[of], period[of]


def _agreeing(sequence: np.ndarray, sizes: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    for text, at, period in _grid(sizes, firsts):
        same = sequence[at] == sequence[at + period]
        yield text[same], at[same], period[same]


def _least_length(period: np.ndarray) -> np.ndarray:
    return np.maximum(LEAST_WORDS, LEAST_PERIODS * period)


def _worth_sorting(sequence: np.ndarray, sizes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Texts with a grid point whose first words to both sides do not rule out a run already."""
    n = len(sequence)
    forward, backward = Extensions(sequence), Extensions(sequence[::-1])
    found = [np.empty(0, dtype=np.int64)]
    for text, at, period in _agreeing(sequence, sizes, firsts):
        right = forward.matching(at, at + period)
        left = backward.matching(n - at, n - at - period)
        ended = (right < MODULUS) & (left < MODULUS)
        found.append(np.unique(text[~ended | (right + left + period >= _least_length(period))]))
    return np.unique(np.concatenate(found))


def _smallest_periods(rows: np.ndarray) -> np.ndarray:
    """Of one stretch (text, start, length) the smallest period; the others are its multiples."""
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), dtype=bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    return rows[first]


def _laid(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts end to end, a separator of its own after each; sizes and first places."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    firsts = np.cumsum(sizes + 1) - sizes - 1
    sequence = np.empty(int(sizes.sum()) + len(texts), dtype=np.int64)
    separator = max(int(t.max(initial=-1)) for t in texts)
    for k, (text, first) in enumerate(zip(texts, firsts), 1):
        sequence[first:first + len(text)] = text
        sequence[first + len(text)] = separator + k
    return sequence, sizes, firsts


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Runs of each sequence of ids as rows (start, length, period), by start, then period."""
    out = [np.empty((0, 3), dtype=np.int64)] * len(texts)
    numbers = np.flatnonzero([len(t) >= LEAST_WORDS for t in texts])
    if len(numbers):
        numbers = numbers[_worth_sorting(*_laid([texts[k] for k in numbers]))]
    if not len(numbers):
        return out
    sequence, sizes, firsts = _laid([texts[k] for k in numbers])
    n = len(sequence)
    forward, backward = Extensions(sequence), Extensions(sequence[::-1])
    found = [np.empty((0, 4), dtype=np.int64)]
    for text, at, period in _agreeing(sequence, sizes, firsts):
        right = forward(at, at + period)
        left = backward(n - at, n - at - period)
        length = left + right + period
        rows = np.stack((text, at - left - firsts[text], length, period), axis=1)
        found.append(_smallest_periods(rows[length >= _least_length(period)]))
    rows = _smallest_periods(np.concatenate(found))
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    for k, part in zip(*_groups(rows)):
        out[numbers[k]] = part[:, 1:]
    return out


def _groups(rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    keys, first = np.unique(rows[:, 0], return_index=True)
    return keys, np.split(rows, first[1:]) if len(keys) else []


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run of greatest length by period; ties to the smallest start, then period."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """``words`` without those that lie in a run after its first period."""
    if not len(runs):
        return words
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]


SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in buffers(batch, 1):
            ids = defaultdict(count().__next__)
            words = [text.split() for text in texts]
            begins = batch.column(2).slice(first, len(texts)).to_pylist()
            lengths = batch.column(3).slice(first, len(texts)).to_pylist()
            for k, (begin, length) in enumerate(zip(begins, lengths)):
                n = len(words[k])
                if begin is not None and n:
                    a = begin % n
                    p = 1 + (n - a) // length
                    words[k] = words[k][:a] + [words[k][a + i % p] for i in range(n - a)]
            runs = find_runs([np.fromiter(map(ids.__getitem__, w), np.int64, len(w)) for w in words])
            flat = np.concatenate(runs)
            offsets = np.concatenate(([0], np.cumsum([len(r) for r in runs])))
            structs = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(texts)), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs),
                 pa.array([b" ".join(collapse(w, r)) for w, r in zip(words, runs)], pa.binary())],
                names=["doc_id", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  repeat_from: Column | None = None, repeat_part: Column | None = None) -> DataFrame:
    """``(doc_id, runs, collapsed)`` for every row of ``docs``: all runs by start, then period.

    A run is a stretch of words with smallest period ``p``, at least ``max(24, 3 p)`` long, that
    neither neighbour extends. ``collapsed`` holds the words outside of repeats, joined by a space.
    ``repeat_from`` and ``repeat_part`` (non-negative and positive integers, NULL for none) write
    a repetition into a text of ``n`` words first: from word ``a = repeat_from % n`` on, the
    ``1 + (n - a) / repeat_part`` words found there repeat to the end.

    NULL and empty texts have no words, no runs and an empty ``collapsed``. NULL ids and repeated
    rows are kept as they are; other columns are not read.
    """
    nothing = F.lit(None).cast("long")
    return docs.select(
        long_id(F.col(doc_id)).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"),
        long_id(nothing if repeat_from is None else repeat_from).alias("begin"),
        long_id(nothing if repeat_part is None else repeat_part).alias("part"),
    ).mapInArrow(_run_batches, SCHEMA)


def run_report(found: DataFrame) -> DataFrame:
    """Number of runs, the strongest one, and hashes of all runs and of the collapsed text.

    Products of lengths and periods stay inside 64 bits for texts of up to three thousand million
    words, more than a row can hold.
    """
    runs = F.col("runs")
    # reduce keeps the earlier run unless a later one is strictly stronger; the order breaks ties
    best = F.when(F.size(runs) > 0, F.reduce(
        F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), runs[0],
        lambda kept, run: F.when(run["length"] * kept["period"] > kept["length"] * run["period"], run).otherwise(kept),
    ))
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def repeated_tail(doc_id: Column) -> tuple[Column, Column]:
    """Where one document in ten repeats from, and in how many parts: both from crc32 of its id."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    chosen = h % 10 == 0
    return F.when(chosen, g), F.when(chosen, 3 + g % 8)
