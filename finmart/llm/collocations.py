"""Phrase collocations: counts by multikey three-way quicksort of suffix pointers.

A suffix is what follows a word inside its piece, at most five words. Nothing that holds an
infrequent word can be frequent, so words are counted first and the suffixes are cut before the
first infrequent one. Frequent words are numbered, the most frequent first; a suffix is five numbers
in two 64-bit values, and words beyond the numbered ones are spelled out beside them.

The cut suffixes of a task are counted where they are equal and routed by their leading two words,
by more of them as long as the leading words start more than a 1/1024 of all rows. Each task then
sorts pointers to its suffixes by multikey three-way quicksort, all partitions of a step at once:
a partition is split by the word at its depth into less, equal and greater; the size of an equal
partition is the count of a phrase, and partitions below the least count are abandoned.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from finmart.llm.shingles import mix
from finmart.llm.tables import Scratch, small_batches
from finmart.llm.words import BUFFER_BYTES, bitmap_of, fold_table, in_bitmap, spans, word_hashes

LEAST_COUNT = 100
MOST_WORDS = 5
TOP = 2000
UNKNOWN = "und"
#: Leading words of more rows than this share are not enough to route by; at most so many exist.
ROUTE_SHARE = 1024
#: Rows of a routed task, about; its pointers are sorted in memory.
TASK_ROWS = 500_000
#: Distinct words held before they are handed on.
HELD = 100_000
#: Suffixes whose equal ones are merged before they are handed on, and rows handed on at once.
HELD_SUFFIXES, SENT = 1 << 20, 1 << 16
#: Words that get a number, the most frequent ones; every worker looks them up.
NUMBERED = 200_000
#: Bits of a number; 0 ends a suffix, the largest stands for a word that is spelled out.
NUMBER_BITS = 21
SPELLED = (1 << NUMBER_BITS) - 1
#: Suffixes drawn to find frequent leading words; they only steer where rows go.
DRAWN = 1_000_000

_BREAKS = frozenset(b".,;:!?\n\x0b\x0c\r")
#: Pieces end at line feeds, words at spaces; A-Z in lower case.
_FOLD = fold_table(lambda b: 0x0A if b in _BREAKS else 0x20 if b == 0x09 else None)
#: Stands for the end of a piece among words, none of which holds it.
_BREAK = b"."


def _lang_seed(lang: str) -> np.uint64:
    raw = np.frombuffer(lang.encode("utf-8") + b" ", dtype=np.uint8)
    return word_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of a batch by language, ``BUFFER_BYTES`` at a time; NULL texts are left out."""
    held: dict[str, list[bytes]] = defaultdict(list)
    sizes: Counter = Counter()
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        raw = text.as_py()
        if raw:
            held[lang].append(raw)
            sizes[lang] += len(raw)
            if sizes[lang] >= BUFFER_BYTES:
                yield lang, held.pop(lang)
                del sizes[lang]
    yield from held.items()


def _counted(held: dict[str, Counter]) -> pa.RecordBatch:
    langs, phrases, counts = [], [], []
    for lang, found in held.items():
        langs += [lang] * len(found)
        phrases += found.keys()
        counts += found.values()
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()), pa.array(counts, pa.int64())],
        names=["lang", "phrase", "n"])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for lang, texts in _by_language(batch):
            held[lang].update(b"\n".join(texts).translate(_FOLD).split())
            if sum(map(len, held.values())) > HELD:
                yield _counted(held)
                held.clear()
    if held:
        yield _counted(held)


class Numbers(NamedTuple):
    """The numbered words, the first has number 1, and a bitmap that no frequent word without a
    number fails; None if there is no such word."""

    langs: list[str]
    words: list[bytes]
    others: np.ndarray | None


class _Lookup(dict):
    """Numbers of the words of one language, SPELLED for all others."""

    def __missing__(self, word: bytes) -> int:
        return SPELLED


def _numbers_of(tokens: list[bytes], lang: str, lookup: _Lookup, others: np.ndarray | None) -> np.ndarray:
    found = np.fromiter(map(lookup.__getitem__, tokens), np.int64, len(tokens))
    at = np.flatnonzero(found == SPELLED)
    if others is None:
        found[at] = 0
    elif len(at):
        found[at[~in_bitmap(others, _hashes(lang, [tokens[i] for i in at.tolist()]))]] = 0
    return found


_SUFFIXES = "high long, low long, spelled binary, n long"


def _merged(high: np.ndarray, low: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of equal suffixes with their number."""
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.flatnonzero(np.concatenate(([True], (high[1:] != high[:-1]) | (low[1:] != low[:-1]))))
    n = np.diff(first, append=len(high))
    for lo in range(0, len(first), SENT):
        at = first[lo:lo + SENT]
        yield pa.RecordBatch.from_arrays(
            [pa.array(high[at]), pa.array(low[at]), pa.nulls(len(at), pa.binary()), pa.array(n[lo:lo + SENT])],
            names=["high", "low", "spelled", "n"])


def _spelled(found: Counter) -> pa.RecordBatch:
    highs, lows, words = zip(*found)
    return pa.RecordBatch.from_arrays(
        [pa.array(highs, pa.int64()), pa.array(lows, pa.int64()), pa.array(words, pa.binary()), pa.array(found.values(), pa.int64())],
        names=["high", "low", "spelled", "n"])


def _cut_suffixes(numbers: Numbers):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups: dict[str, _Lookup] = defaultdict(lambda: _Lookup({_BREAK: 0}))
        for number, (lang, word) in enumerate(zip(numbers.langs, numbers.words), 1):
            lookups[lang][word] = number
        highs, lows, held, spelled = [], [], 0, Counter()
        for batch in batches:
            for lang, texts in _by_language(batch):
                tokens = b"\n".join(texts).translate(_FOLD).replace(b"\n", b" %b " % _BREAK).split()
                found = _numbers_of(tokens, lang, lookups[lang], numbers.others)
                found = np.concatenate((found, np.zeros(MOST_WORDS, dtype=np.int64)))
                at = np.flatnonzero((found[:-1] > 0) & (found[1:] > 0))
                parts = [found[at]]
                for k in range(1, MOST_WORDS):
                    parts.append(np.where(parts[-1] > 0, found[at + k], 0))
                high, low = (parts[0] << 2 * NUMBER_BITS) | (parts[1] << NUMBER_BITS) | parts[2], (parts[3] << NUMBER_BITS) | parts[4]
                if numbers.others is not None:
                    odd = np.any([part == SPELLED for part in parts], axis=0)
                    tail = b"\n" + lang.encode("utf-8")
                    for i in np.flatnonzero(odd).tolist():
                        words = [tokens[at[i] + k] for k in range(MOST_WORDS) if parts[k][i] == SPELLED]
                        spelled[int(high[i]), int(low[i]), b" ".join(words) + tail] += 1
                    high, low = high[~odd], low[~odd]
                    if len(spelled) > HELD:
                        yield _spelled(spelled)
                        spelled.clear()
                highs.append(high)
                lows.append(low)
                held += len(high)
                if held >= HELD_SUFFIXES:
                    yield from _merged(np.concatenate(highs), np.concatenate(lows))
                    highs, lows, held = [], [], 0
        if held:
            yield from _merged(np.concatenate(highs), np.concatenate(lows))
        if spelled:
            yield _spelled(spelled)

    return run


def multikey_counts(keys: np.ndarray, weights: np.ndarray, floors: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of all prefixes of the rows of ``keys`` (-1 ends a row): row with it, length, weight.

    ``floors[d]`` is the least weight of a partition by column ``d``; lighter ones are abandoned.
    """
    depths = keys.shape[1]
    pointers, sizes = np.arange(len(keys)), np.array([len(keys)])
    depth = np.zeros(1, dtype=np.int64)
    least = np.array(floors, dtype=np.int64)
    out: list[tuple[np.ndarray, ...]] = [(np.empty(0, dtype=np.int64),) * 3]
    while len(pointers):
        first = np.cumsum(sizes) - sizes
        part = np.repeat(np.arange(len(sizes)), sizes)
        pivot_row = pointers[first + sizes // 2]
        pivot = keys[pivot_row, depth]
        word = keys[pointers, depth[part]]
        side = np.sign(word - pivot[part])
        held: list[tuple[np.ndarray, ...]] = []
        for sign in (-1, 0, 1):
            at = np.flatnonzero(side == sign)
            rows, of = pointers[at], part[at]
            parts, begin, n = np.unique(of, return_index=True, return_counts=True)
            if not len(parts):
                continue
            weight = np.add.reduceat(weights[rows], begin)
            deep = depth[parts]
            stays = weight >= least[deep]
            if sign == 0:
                stays &= pivot[parts] >= 0
                out.append((pivot_row[parts[stays]], deep[stays] + 1, weight[stays]))
                deep = deep + 1
                stays &= deep < depths
            held.append((rows[np.repeat(stays, n)], n[stays], deep[stays]))
        pointers, sizes, depth = map(np.concatenate, zip(*held))
    return tuple(map(np.concatenate, zip(*out)))


def _sorted_counts(numbers: Numbers):
    """Counts of phrases from all suffixes of a task, rows ``(high, low, spelled, n, routed)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        rows = pa.Table.from_batches(tables)
        del tables
        high, low, weights, routed = (rows.column(name).to_numpy() for name in ("high", "low", "n", "routed"))
        keys = np.stack([high >> 2 * NUMBER_BITS, high >> NUMBER_BITS & SPELLED, high & SPELLED, low >> NUMBER_BITS, low & SPELLED], axis=1)
        ids = defaultdict(count(SPELLED + 1).__next__)  # of spelled words, in this task only
        for i in np.flatnonzero((keys == SPELLED).any(axis=1)).tolist():
            words, lang = rows.column("spelled")[i].as_py().split(b"\n", 1)
            keys[i, keys[i] == SPELLED] = [ids[lang, word] for word in words.split(b" ")]
        del rows, high, low
        keys[keys == 0] = -1
        others = list(ids)

        def word_of(number: int) -> tuple[str, bytes]:
            if number <= SPELLED:
                return numbers.langs[number - 1], numbers.words[number - 1]
            lang, word = others[number - SPELLED - 1]
            return lang.decode("utf-8"), word

        for leading in np.unique(routed):
            at = np.flatnonzero(routed == leading)
            # phrases shorter than a longer route are spread over tasks: no part of them may be abandoned
            floors = [1 if 2 < leading > depth + 1 else LEAST_COUNT for depth in range(MOST_WORDS)]
            row, length, weight = multikey_counts(keys[at], weights[at], floors)
            wide = length > 1
            row, length, weight = at[row[wide]], length[wide], weight[wide]
            phrases = [[word_of(number) for number in keys[r, :k].tolist()] for r, k in zip(row, length)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([words[0][0] for words in phrases], pa.string()),
                 pa.array([b" ".join(word for _, word in words) for words in phrases], pa.binary()), pa.array(weight, pa.int64())],
                names=["lang", "phrase", "n"])

    return run


_COUNTS = "lang string, phrase binary, n long"


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b" ".join(words) + b" ", dtype=np.uint8)
    return mix(word_hashes(raw, *spans(raw, raw == 0x20)) ^ _lang_seed(lang))


def _hash_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, rows in _rows_by_language(batch):
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(lang, rows).view(np.int64))], names=["hash"])


def _rows_by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    held: dict[str, list[bytes]] = defaultdict(list)
    for lang, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        held[lang].append(word)
    yield from held.items()


def _numbered(frequent: DataFrame) -> Numbers:
    rows = frequent.orderBy(F.col("n").desc(), "lang", "phrase").limit(NUMBERED).select("lang", "phrase").toArrow()
    others = None
    if rows.num_rows == NUMBERED:
        others = bitmap_of(frequent.select("lang", "phrase").mapInArrow(_hash_frequent, "hash long"))
    return Numbers(rows["lang"].to_pylist(), rows["phrase"].to_pylist(), others)


def _routes(suffixes: DataFrame) -> DataFrame:
    """Suffixes with the number of leading words they are routed by, dealt to tasks by those words.

    Leading words go by fingerprints; one that two of them share only sends both further on.
    """
    total = suffixes.count()
    lead = {2: F.xxhash64(F.shiftright("high", NUMBER_BITS)), 3: F.xxhash64("high"),
            4: F.xxhash64("high", F.shiftright("low", NUMBER_BITS)), 5: F.xxhash64("high", "low")}
    drawn = suffixes.sample(DRAWN / total, seed=1) if total > DRAWN else suffixes
    heavy = (
        drawn.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), lead[k].alias("lead")) for k in range(2, MOST_WORDS)])).alias("x"))
        .select("x.*").groupBy("k", "lead").count().where(F.col("count") * ROUTE_SHARE > min(total, DRAWN)).collect()
    )
    routed: Column = F.lit(2)
    for k in range(2, MOST_WORDS):
        hot = [row["lead"] for row in heavy if row["k"] == k]
        if hot:
            routed = F.when(lead[k].isin(hot), F.lit(k + 1)).otherwise(routed)
    route = F.coalesce(*[F.when(F.col("routed") == k, lead[k]) for k in lead])
    tasks = max(int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_ROWS))
    return suffixes.withColumn("routed", routed).repartition(tasks, route)


def phrase_counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Counts ``(lang, phrase, n)`` of all words, and of phrases of 2 to 5 words found ``LEAST_COUNT`` times."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "collocations")
    read = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).cast("string").cast("binary").alias("text"))
    words = scratch.keep(
        read.mapInArrow(_count_words, _COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "words")
    numbers = _numbered(words.where(F.col("n") >= LEAST_COUNT))
    suffixes = scratch.keep(read.mapInArrow(_cut_suffixes(numbers), _SUFFIXES), "suffixes")
    phrases = scratch.keep(
        _routes(suffixes).mapInArrow(_sorted_counts(numbers), _COUNTS)
        .groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT), "phrases")
    scratch.drop("suffixes")
    return words, phrases


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``TOP`` phrases of every language.

    Counts are exact and taken within pieces. A phrase of count ``a`` is cut in two parts of counts
    ``l`` and ``r`` where ``floor(1000 a n / (l r))`` is least (``n``: all words of the language;
    ties: the first cut). Phrases inside a longer one as frequent as themselves are left out.

    NULL languages are ``und``; NULL and empty texts have no words; repeated rows count again; ids
    and other columns are not read. An empty table gives no rows.
    """
    words, phrases = phrase_counts(docs, lang, text)
    as_text = F.col("phrase").cast("string")
    phrases = phrases.select("lang", as_text.alias("phrase"), "n")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    counts = phrases.union(words.where(F.col("n") >= LEAST_COUNT).select("lang", as_text.alias("phrase"), "n"))

    # a longer phrase as frequent as a part of it has a neighbour of one more word as frequent
    longer = phrases.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 2)
    inner = [F.array_join(F.slice("w", first, F.size("w") - 1), " ") for first in (1, 2)]
    inside = longer.select("lang", F.explode(F.array(*inner)).alias("phrase"), "n").distinct()
    kept = phrases.join(inside, ["lang", "phrase", "n"], "left_anti")

    cuts = (
        kept.withColumn("w", F.split("phrase", " "))
        .select("lang", "phrase", F.col("n").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
        .select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
                F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("tail"))
        .join(counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
        .join(counts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
        .join(totals, "lang")
    )
    exact = "CAST(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(total AS DECIMAL(18,0)) AS DECIMAL(38,0))"
    score = F.expr(f"{exact} div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")
    scored = (
        cuts.withColumn("score", score).groupBy("lang", "phrase", "a", F.col("total").alias("n"))
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )
    # the first ones of every part of a language come first, so no task ranks a whole language
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    first = part.where(F.col("rank") <= TOP).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return first.where(F.col("rank") <= TOP).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
