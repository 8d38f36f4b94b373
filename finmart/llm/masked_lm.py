"""Masked pseudo-likelihood: a bidirectional window network predicts every word from both sides.

Words of the whole corpus are counted; the most frequent ones are known, more of them the more
distinct words there are, the others share hashed slots. A slot's probability is divided among
its words by their counts, which stay a distributed table. Word t is predicted from the REACH words on each side, and never from
itself: every offset has its own table of word vectors, whose rows are added and passed through
tanh. The distribution is factored into a group of words and a word of the group, so it is
exact and needs two short rows of logits. A text's score is the sum of the conditional
log-probabilities of all its words.

Training covers every word of all documents once: in each of R rounds every shard of them
predicts one position in R of each document and starts from the common weights; between rounds
every row of weights is averaged over the shards by the number of predictions that touched it.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from finmart.llm.tables import Scratch, long_id, shuffles_removed

#: Least number of known words and of slots that the other words share, words to each side,
#: units of the hidden layer. Known words grow by WORDS_GROW times the root of the distinct words.
VOCABULARY = 4000
SHARED_SLOTS = 95
WORDS_GROW = 6
REACH = 2
HIDDEN = 16
#: Least number of training rounds; every position is predicted in exactly one of them.
ROUNDS = 8
BATCH = 8192
RATE = 0.3
SEED = 3
#: Shards, each trained alone between averages, grow with the root of the words in units of SHARD_WORDS.
SHARD_WORDS = 1 << 16
#: Words whose shares every worker looks up; the shares of all others are joined. Only saves disk.
LISTED = 200_000
#: Bytes of texts split into words at once, words scored at once, weights in a row,
#: words whose neighbours are looked up at once, rows of logits at once, so few that they stay in the cache.
SPLIT = 16 << 20
SCORED = 1 << 14
CHUNK = 4096
STRETCH = 1 << 17
BLOCK = 512

#: Slots of the least network; the last slot is the border.
SLOTS = VOCABULARY + SHARED_SLOTS + 1
OFFSETS = [*range(-REACH, 0), *range(1, REACH + 1)]


def _split(column: pa.BinaryArray) -> Iterator[tuple[slice, np.ndarray, pa.BinaryArray]]:
    """The words of several texts after each other: which texts, how many words each has, the words.

    Texts are taken together up to SPLIT bytes; a NULL text has no words.
    """
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // SPLIT
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(column)]
    for lo, hi in zip(edges, edges[1:]):
        if lo < hi:
            lists = pc.ascii_split_whitespace(column.slice(lo, hi - lo).view(pa.string()))
            owner = np.repeat(np.arange(hi - lo), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            words = lists.flatten().cast(pa.binary())
            # blanks at an end of a text have an empty word beside them
            real = pc.greater(pc.binary_length(words), 0)
            owner = owner[real.to_numpy(zero_copy_only=False)]
            yield slice(lo, hi), np.bincount(owner, minlength=hi - lo), words.filter(real)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, words in _split(batch.column(0)):
            counts = pc.value_counts(words)
            yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], names=["word", "c"])


class Vocabulary(NamedTuple):
    """Known words, most frequent first, numbers of slots for known and for other words, the next
    most frequent words with their log shares, the count of the last of all these, and how
    often the other words of each shared slot occur."""

    words: list[bytes]
    known: int
    shared: int
    listed: list[bytes]
    log_shares: np.ndarray
    last: tuple[int, bytes] | None
    totals: list[int]

    @property
    def slots(self) -> int:
        return self.known + self.shared + 1


def word_counts(texts: DataFrame) -> DataFrame:
    return texts.mapInArrow(_count_words, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(counts: DataFrame) -> Vocabulary:
    """The most frequent words, more of them the more distinct words there are; ties by their bytes.

    A word of a shared slot takes c(w) / (c(slot) + 1) of it. The one count more is the part of
    a slot that words without any count have between them.
    """
    known = max(VOCABULARY, math.ceil(WORDS_GROW * math.sqrt(counts.count())))
    shared = -(-known * SHARED_SLOTS // VOCABULARY)
    rows = counts.orderBy(F.col("c").desc(), "word").limit(known + LISTED).toArrow()
    words, found = rows["word"].to_pylist(), rows["c"].to_numpy()
    totals = [0] * shared
    for row in counts.groupBy((F.crc32("word") % shared).alias("slot")).agg(F.sum("c").alias("c")).collect():
        totals[row["slot"]] = row["c"]
    for word, c in zip(words[:known], found):
        totals[zlib.crc32(word) % shared] -= int(c)
    listed = words[known:]
    of_slot = np.array([totals[zlib.crc32(word) % shared] for word in listed], dtype=np.float64)
    return Vocabulary(words[:known], known, shared, listed, np.log(found[known:] / (of_slot + 1)),
                      (int(found[-1]), words[-1]) if words else None, totals)


def word_shares(counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(word, log_share)`` of every word that is neither known nor listed."""
    if vocabulary.last is None:
        return counts.select("word", F.lit(0.0).alias("log_share"))
    c, word = vocabulary.last
    rest = counts.where((F.col("c") < c) | ((F.col("c") == c) & (F.col("word") > F.lit(bytearray(word)))))
    of_slot = counts.sparkSession.createDataFrame(list(enumerate(vocabulary.totals)), "slot long, all long")
    return (
        rest.withColumn("slot", F.crc32("word") % vocabulary.shared).join(F.broadcast(of_slot), "slot")
        .select("word", F.log(F.col("c") / (F.col("all") + 1)).alias("log_share"))
    )


class Slots:
    """Slots of words and the listed log shares."""

    def __init__(self, vocabulary: Vocabulary):
        self.first, self.shared = vocabulary.known, vocabulary.shared
        words = vocabulary.words + vocabulary.listed
        self.words = pa.array(words, pa.binary())
        self.slot = np.array([i if i < self.first else self.other(w) for i, w in enumerate(words)], dtype=np.int32)
        self.log_share = np.zeros(len(words))
        self.log_share[len(vocabulary.words):] = vocabulary.log_shares

    def other(self, word: bytes) -> int:
        return self.first + zlib.crc32(word) % self.shared

    def of(self, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Slots and log shares of words; places of those that are neither known nor listed, share 0, and these."""
        places = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        missing = np.flatnonzero(places < 0)
        others = words.take(pa.array(missing)).to_pylist()
        slots, shares = self.slot[places], self.log_share[places]
        slots[missing], shares[missing] = [self.other(word) for word in others], 0
        return slots, shares, missing, others


def slot_type(slots: int) -> type:
    return np.uint16 if slots <= 1 << 16 else np.int32


def _encode(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Slots(vocabulary)
        for batch in batches:
            hashes = np.array([zlib.crc32(text.as_py() or b"") for text in batch.column(1)], np.int64)
            for part, sizes, words in _split(batch.column(1)):
                slots, shares, missing, others = lookup.of(words)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                rare = Counter(zip(owner[missing].tolist(), others))
                ends = np.cumsum(np.bincount([text for text, _ in rare], minlength=len(sizes)) if rare else np.zeros(len(sizes), np.int64))
                rows = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], ends)), pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array([word for _, word in rare], pa.binary()), pa.array(list(rare.values()), pa.int64())],
                        names=["word", "c"]))
                data = slots.astype(slot_type(vocabulary.slots))
                begins = (np.concatenate(([0], np.cumsum(sizes))) * data.itemsize).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], pa.array(hashes[part]),
                     pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(begins), pa.py_buffer(data)]),
                     pa.array(np.bincount(owner, weights=shares, minlength=len(sizes)), pa.float64()), rows],
                    names=["doc_id", "hash", "slots", "listed", "rare"])

    return run


class WindowNetwork:
    """The last row of both tables of logits is their bias; the hidden layer ends in a one that meets it."""

    def __init__(self, slots: int = SLOTS):
        random = np.random.default_rng(SEED)
        #: words of a group, groups; near the root of the slots, so that both rows of logits are short
        self.group = math.ceil(math.sqrt(slots))
        self.groups = -(-slots // self.group)
        weights = [
            random.normal(0, 0.3, (len(OFFSETS), slots, HIDDEN)), np.zeros(HIDDEN),
            np.zeros((HIDDEN + 1, self.groups)), np.zeros((self.groups, HIDDEN + 1, self.group)),
        ]
        # slots that do not exist; the border is never predicted
        existing = np.arange(self.groups * self.group).reshape(self.groups, self.group) < slots - 1
        weights[3][:, HIDDEN] = np.where(existing, 0, -1e4)
        self.weights = [w.astype(np.float32) for w in weights]
        #: predictions that used a row of the word tables, a group, and all of them
        self.touched = [np.zeros((len(OFFSETS), slots), np.int64), np.zeros(self.groups, np.int64), np.zeros(1, np.int64)]
        self._logits = np.empty(BLOCK * max(self.group, self.groups), np.float32)

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """(N, HIDDEN + 1) for contexts (N, offsets) of slots."""
        tables, bias = self.weights[0], self.weights[1]
        h = tables[0].take(context[:, 0], axis=0)
        h += bias
        for j in range(1, len(OFFSETS)):
            h += tables[j].take(context[:, j], axis=0)
        found = np.ones((len(h), HIDDEN + 1), np.float32)
        np.tanh(h, out=found[:, :HIDDEN])
        return found

    @staticmethod
    def _within_bounds(weights: np.ndarray) -> bool:
        """Whether no exponential can overflow and no sum of them can be zero, whatever the hidden layer."""
        reach, bias = np.abs(weights[..., :HIDDEN, :]).sum(axis=-2), weights[..., HIDDEN, :]
        # a column of words that exist
        return (bias + reach).max() <= 60 and (bias[..., 0] - reach[..., 0]).min() >= -60

    def _exponentials(self, h: np.ndarray, weights: np.ndarray, safe: bool) -> np.ndarray:
        """Exponentials of at most BLOCK rows of logits; the next call overwrites them."""
        logits = self._logits[:len(h) * weights.shape[1]].reshape(len(h), -1)
        np.matmul(h, weights, out=logits)
        if not safe and (logits.max() > 60 or logits[:, 0].min() < -60):
            logits -= logits.max(axis=1, keepdims=True)
        return np.exp(logits, out=logits)

    def by_word(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """An order of the predictions by their word, and where each group begins in it."""
        target = target.astype(slot_type(self.groups * self.group))
        order = np.argsort(target, kind="stable")
        return order, np.searchsorted(target[order] // self.group, np.arange(self.groups + 1))

    @staticmethod
    def _blocks(lo: int, hi: int) -> Iterator[slice]:
        for at in range(lo, hi, BLOCK):
            yield slice(at, min(at + BLOCK, hi))

    def in_groups(self, edges: np.ndarray) -> Iterator[tuple[slice, int]]:
        """Blocks of the predictions of every group between its ``edges``."""
        for g, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            for rows in self._blocks(lo, hi):
                yield rows, g

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        order, edges = self.by_word(target)
        target = target[order]
        over_groups, over_words = self.weights[2:]
        safe, safe_words = self._within_bounds(over_groups), self._within_bounds(over_words)
        h, every = self.hidden(context.take(order, axis=0)), np.arange(BLOCK)
        group, word, sorted_p = target // self.group, target % self.group, np.empty(len(target), np.float32)

        def share(exponentials: np.ndarray, chosen: np.ndarray) -> np.ndarray:
            return exponentials[every[:len(chosen)], chosen] / (exponentials @ np.ones(exponentials.shape[1], np.float32))

        for rows in self._blocks(0, len(target)):
            sorted_p[rows] = share(self._exponentials(h[rows], over_groups, safe), group[rows])
        for rows, g in self.in_groups(edges):
            sorted_p[rows] *= share(self._exponentials(h[rows], over_words[g], safe_words), word[rows])
        p = np.empty_like(sorted_p)
        p[order] = sorted_p
        return np.log(np.maximum(p, 1e-30))

    def learn(self, context: np.ndarray, target: np.ndarray, memory: list[np.ndarray]) -> None:
        """One AdaGrad step; ``memory`` holds sums of squares shaped like the weights.

        The gradient of a row of logits is its softmax less one at the word. The softmax is never
        divided out: its products are divided by the sums, which a column of ones adds to them. The
        ones at the words are added up once for all rows, which are ordered by them.
        """
        n = len(target)
        self.touched[2] += n
        order, edges = self.by_word(target)
        context, target = context.take(order, axis=0), target[order]
        h = self.hidden(context)
        over_groups, over_words = self.weights[2:]
        safe, safe_words = self._within_bounds(over_groups), self._within_bounds(over_words)
        group, word = target // self.group, target % self.group
        # rows of words with a one in place of the bias, and what the words themselves take from the errors
        groups_back, words_back = over_groups.T.copy(), over_words.transpose(0, 2, 1).copy()
        groups_back[:, HIDDEN] = words_back[..., HIDDEN] = 1
        back = -groups_back.take(group, axis=0)
        back -= words_back.reshape(-1, HIDDEN + 1).take(target, axis=0)
        of_groups, of_words = np.zeros_like(over_groups), np.zeros_like(over_words)

        def spread(rows: slice, weights: np.ndarray, turned: np.ndarray, safe: bool, gradient: np.ndarray) -> None:
            exponentials = self._exponentials(h[rows], weights, safe)
            products = exponentials @ turned
            sums = products[:, HIDDEN:]
            gradient += (h[rows] / sums).T @ exponentials
            back[rows] += products / sums

        for rows in self._blocks(0, n):
            spread(rows, over_groups, groups_back, safe, of_groups)
        for rows, g in self.in_groups(edges):
            spread(rows, over_words[g], words_back[g], safe_words, of_words[g])
        first = np.flatnonzero(np.diff(target, prepend=-1))
        at_words = np.column_stack([self._sums(h[:, :HIDDEN].copy(), first), np.diff(first, append=n).astype(np.float32)])
        of_words[group[first], :, word[first]] -= at_words
        first_of_group = np.flatnonzero(np.diff(group[first], prepend=-1))
        of_groups[:, group[first][first_of_group]] -= np.add.reduceat(at_words, first_of_group, axis=0).T
        self.touched[1] += np.diff(edges)
        self._step(self.weights[2], of_groups, memory[2])
        self._step(self.weights[3], of_words, memory[3])
        back, h = back[:, :HIDDEN], h[:, :HIDDEN]
        back = back * (1 - h * h)
        self._step(self.weights[1], back.sum(axis=0), memory[1])
        for j, column in enumerate(context.T.astype(slot_type(self.weights[0].shape[1]), order="C")):
            order = np.argsort(column, kind="stable")
            column = column[order]
            first = np.concatenate([[0], np.flatnonzero(column[1:] != column[:-1]) + 1])
            words = column[first]
            self.touched[0][j, words] += np.diff(first, append=n)
            table, seen = self.weights[0][j], memory[0][j]
            rows, sums = table.take(words, axis=0), seen.take(words, axis=0)
            self._step(rows, self._sums(back.take(order, axis=0), first), sums)
            table[words], seen[words] = rows, sums

    @staticmethod
    def _step(weights: np.ndarray, grad: np.ndarray, seen: np.ndarray) -> None:
        """Changes ``weights`` and the sums of squares ``seen`` in place; ``grad`` is used up."""
        seen += grad * grad
        grad *= RATE
        grad /= np.sqrt(seen + np.float32(1e-6))
        weights -= grad

    @staticmethod
    def _sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Sums of (N, HIDDEN) rows from each of ``first`` to the next; two floats are added at once, as one complex number."""
        return np.add.reduceat(rows.view(np.complex64), first, axis=0).view(np.float32)

    def rows(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Weights in rows of what is learned together, and the predictions that touched each row."""
        tables, bias, over_groups, over_words = self.weights
        return [
            (tables.reshape(-1, HIDDEN), self.touched[0].reshape(-1)),
            (over_words.reshape(self.groups, -1), self.touched[1]),
            (np.concatenate([bias, over_groups.reshape(-1)])[None], self.touched[2]),
        ]

    @classmethod
    def from_rows(cls, rows: list[np.ndarray], slots: int) -> WindowNetwork:
        made = cls(slots)
        tables, bias, over_groups, over_words = made.weights
        tables[:] = rows[0].reshape(tables.shape)
        over_words[:] = rows[1].reshape(over_words.shape)
        bias[:] = rows[2][0, :HIDDEN]
        over_groups[:] = rows[2][0, HIDDEN:].reshape(over_groups.shape)
        return made


class Texts(NamedTuple):
    """Slots of several texts laid end to end, and where each text begins; one place more for the end."""

    slots: np.ndarray
    begins: np.ndarray

    @classmethod
    def of(cls, column: pa.BinaryArray, kind: type) -> Texts:
        begins = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        data, size = column.buffers()[2], np.dtype(kind).itemsize
        count = int(begins[-1] - begins[0]) // size
        slots = np.frombuffer(data, kind, count, int(begins[0])) if count else np.empty(0, kind)
        return cls(slots, (begins - begins[0]).astype(np.int64) // size)

    def part(self, lo: int, hi: int) -> Texts:
        """The texts from ``lo`` to before ``hi``."""
        begins = self.begins[lo:hi + 1]
        return Texts(self.slots[begins[0]:begins[-1]], begins - begins[0])

    def stretches(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of STRETCH words after each other and the texts they are in."""
        for lo in range(0, len(self.slots), STRETCH):
            places = np.arange(lo, min(lo + STRETCH, len(self.slots)))
            yield places, np.searchsorted(self.begins, places, side="right") - 1

    def every(self, step: int, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Every ``step``-th place of each text from its ``first`` one on, and the texts they are in."""
        ends = np.cumsum(np.maximum(0, -(-(np.diff(self.begins) - first) // step)))
        start = self.begins[:-1] + first - step * np.concatenate(([0], ends[:-1]))
        for lo in range(0, int(ends[-1]) if len(ends) else 0, STRETCH // step):
            found = np.arange(lo, min(lo + STRETCH // step, int(ends[-1])))
            owner = np.searchsorted(ends, found, side="right")
            yield start[owner] + step * found, owner

    def contexts(self, places: np.ndarray, owner: np.ndarray, border: int) -> np.ndarray:
        """(N, offsets) slots around ``places`` of the texts ``owner``; ``border`` outside of them."""
        begin, end = self.begins[owner], self.begins[owner + 1]
        found = np.empty((len(places), len(OFFSETS)), dtype=np.int32)
        for j, offset in enumerate(OFFSETS):
            at = places + offset
            found[:, j] = np.where((at >= begin) & (at < end), self.slots.take(at, mode="clip"), border)
        return found


def _train(slots_in_all: int, values: list[np.ndarray], turn: int, rounds: int):
    border, kind = slots_in_all - 1, slot_type(slots_in_all)

    def targets(texts: Texts, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for places, owner in texts.every(rounds, (hashes + turn) % rounds):
            yield texts.contexts(places, owner, border), texts.slots[places].astype(np.int32)

    def of_shard(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        network = WindowNetwork.from_rows(values, slots_in_all)
        memory = [np.full_like(w, 1.0) for w in network.weights]
        context, target = np.empty((0, len(OFFSETS)), np.int32), np.empty(0, np.int32)
        for more_context, more_target in parts:
            context, target = np.concatenate([context, more_context]), np.concatenate([target, more_target])
            full = len(target) - len(target) % BATCH
            for lo in range(0, full, BATCH):
                network.learn(context[lo:lo + BATCH], target[lo:lo + BATCH], memory)
            context, target = context[full:], target[full:]
        if len(target):
            network.learn(context, target, memory)
        for which, (rows, touched) in enumerate(network.rows()):
            step = max(1, CHUNK // rows.shape[1])
            for lo in range(0, len(rows), step):
                uses = touched[lo:lo + step]
                if uses.any():
                    yield pa.RecordBatch.from_pylist(
                        [{"kind": which, "first": lo, "n": uses.tobytes(), "weights": rows[lo:lo + step].tobytes()}], schema=_PART_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple[int, Texts, np.ndarray]]:
            for batch in batches:
                shards = np.array(batch.column(0))
                hashes, texts = np.array(batch.column(1)), Texts.of(batch.column(2), kind)
                edges = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1), len(shards)]
                for lo, hi in zip(edges, edges[1:]):
                    if lo < hi:
                        yield int(shards[lo]), texts.part(lo, hi), hashes[lo:hi]

        for _, several in groupby(parts(), key=itemgetter(0)):
            yield from of_shard(found for _, texts, hashes in several for found in targets(texts, hashes))

    return run


#: Touches as int64 by row; weights as float32, or their sums times touches as float64.
_PART_SCHEMA = pa.schema([("kind", pa.int32()), ("first", pa.int32()), ("n", pa.binary()), ("weights", pa.binary())])
_PARTS = "kind int, first int, n binary, weights binary"


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], list[np.ndarray]] = {}
    for batch in batches:
        for kind, first, n, weights in zip(*(c.to_pylist() for c in batch.columns)):
            uses = np.frombuffer(n, dtype=np.int64)
            weighted = np.frombuffer(weights, dtype=np.float32).reshape(len(uses), -1) * uses[:, None].astype(np.float64)
            got = sums.get((kind, first))
            sums[kind, first] = [uses, weighted] if got is None else [got[0] + uses, got[1] + weighted]
    for (kind, first), (uses, weighted) in sums.items():
        yield pa.RecordBatch.from_pylist(
            [{"kind": kind, "first": first, "n": uses.tobytes(), "weights": weighted.tobytes()}], schema=_PART_SCHEMA)


def in_shards(encoded: DataFrame, words: int) -> tuple[DataFrame, int]:
    """``encoded`` with its rows dealt to shards, and their number: it follows from the words and
    not from how the input is split."""
    shards = max(1, math.ceil(math.sqrt(words / SHARD_WORDS)))
    dealt = encoded.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")).repartition(shards, "shard")
    return dealt.sortWithinPartitions("shard", "row"), shards


def train(encoded: DataFrame, slots: int, rounds: int, scratch: Scratch) -> list[np.ndarray]:
    """Averaged weights of the network over all texts of ``encoded(shard, hash, slots)``, in rows.

    A row of weights is averaged by the predictions that touched it, so shards without its words
    do not pull it back. One sum per chunk of rows, so no task and not the driver ever holds the
    weights of all shards.
    """
    values = [rows.copy() for rows, _ in WindowNetwork(slots).rows()]
    for turn in range(rounds):
        trained = scratch.keep(
            encoded.select("shard", "hash", "slots").mapInArrow(_train(slots, values, turn, rounds), _PARTS), f"round-{turn}")
        with shuffles_removed(scratch.spark):
            summed = trained.repartition("kind", "first").mapInArrow(_add, _PARTS).collect()
        for part in summed:
            uses = np.frombuffer(part["n"], dtype=np.int64)
            weighted = np.frombuffer(part["weights"], dtype=np.float64).reshape(len(uses), -1)
            rows = values[part["kind"]][part["first"]:part["first"] + len(uses)]
            rows[uses > 0] = weighted[uses > 0] / uses[uses > 0, None]
        scratch.drop(f"round-{turn}")
    return values


def _score(slots_in_all: int, values: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = WindowNetwork.from_rows(values, slots_in_all)
        for batch in batches:
            texts, sums = Texts.of(batch.column(2), slot_type(slots_in_all)), np.array(batch.column(3))
            for places, owner in texts.stretches():
                context, target = texts.contexts(places, owner, slots_in_all - 1), texts.slots[places].astype(np.int32)
                found = [network.log_probabilities(context[lo:lo + SCORED], target[lo:lo + SCORED]) for lo in range(0, len(target), SCORED)]
                first = owner[0]
                of_texts = np.bincount(owner - first, weights=np.concatenate(found))
                sums[first:first + len(of_texts)] += of_texts
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(texts.begins), pa.int64()), pa.array(sums, pa.float64())],
                names=["row", "doc_id", "n_words", "of_slots"])

    return run


def pseudo_likelihoods(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, log_likelihood, mean_log_likelihood)`` for every row of ``docs``.

    A NULL or wordless text has no words, sum 0 and a NULL mean. NULL ids and repeated rows are
    scored like others; repeated texts weigh in training as often as they occur. Other columns
    are not read. Texts are dealt to shards by their place in the input, so another split deals
    them differently, to as many shards.
    """
    scratch = Scratch(docs.sparkSession, "masked-lm")
    rows = docs.select(long_id(F.col(doc_id)).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    counts = scratch.keep(word_counts(rows.select("text")), "counts")
    vocabulary = frequent_words(counts)
    encoded, shards = in_shards(
        rows.mapInArrow(_encode(vocabulary), "doc_id long, hash long, slots binary, listed double, rare array<struct<word:binary,c:long>>")
        .withColumn("row", F.monotonically_increasing_id()), counts.agg(F.sum("c")).first()[0] or 0)
    encoded = scratch.keep(encoded, "encoded")
    values = train(encoded, vocabulary.slots, max(ROUNDS, math.ceil(math.sqrt(shards))), scratch)
    scored = encoded.select("row", "doc_id", "slots", "listed").mapInArrow(
        _score(vocabulary.slots, values), "row long, doc_id long, n_words long, of_slots double")
    inside = (
        encoded.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.c").alias("n"))
        .join(word_shares(counts, vocabulary), "word").groupBy("row").agg(F.sum(F.col("n") * F.col("log_share")).alias("of_words"))
    )
    return (
        scored.join(inside, "row", "left")
        .select("doc_id", "n_words", (F.col("of_slots") + F.coalesce("of_words", F.lit(0.0))).alias("log_likelihood"))
        .withColumn("mean_log_likelihood", F.try_divide("log_likelihood", F.col("n_words").cast("double")))
    )
