"""Toxicity by a factorization machine over hashed terms.

z = w0 + sum of w[t] + sum over pairs of <v[t], v[u]> over the distinct terms of a text; the
pair term learns combinations that no sum of single weights can. Linear weights are learned by
follow-the-regularised-leader with an L1 term, for terms that go with the label by themselves.
Factors belong to those terms and to the terms of pairs: pairs of any terms, neutral alone, that
are found in toxic texts far more often than the linear weights explain. They start from the
leading eigenvectors of these excesses and are fitted by AdaGrad with the rest. The fit sees at
most TRAIN_ROWS labelled documents; every text is scored whole.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from finmart.llm.tables import long_id, small_batches

#: Labelled documents used for the fit, the ones of least hash.
TRAIN_ROWS = 20_000
TERM_BITS = 18
FACTORS = 8
EPOCHS = 12
BATCH = 64
#: Terms seen in fewer training documents stay at zero.
LEAST_DOCUMENTS = 2
RATE, L1, L2 = 0.5, 0.5, 1e-3
#: A pair of terms needs so many toxic training texts that the linear weights miss; longer texts
#: than this (distinct terms) are no evidence for a pair, as any two terms meet in them.
PAIR_DOCUMENTS, PAIR_TERMS = 5, 1500
PAIR_SLOTS = 1 << 22
PAIR_BLOCK = 512
BANDS, BAND_ROWS = 6, 8
#: Slots of training documents scored at once: the factors of all of them would fill the task.
SCORE_SLOTS = 1 << 16
SEED = 7
CUTOFF = 0.3
#: Terms remembered per worker process; only saves time.
REMEMBERED = 100_000

#: ASCII letters in lower case and digits stay, bytes of other scripts too; the rest separates.
_FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))


def held_out(doc_id: Column) -> Column:
    """Rows whose crc32(doc_id as text) mod 4 is 2; NULL ids are not."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


class Terms:
    """Slots of the distinct terms of a text; slot 0 is the constant."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def slots(self, raw: bytes | None) -> np.ndarray:
        known, found = self.known, [0]
        for term in set(raw.translate(_FOLD).split()) if raw else ():
            slot = known.get(term)
            if slot is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                slot = known[term] = 1 + zlib.crc32(term) % ((1 << TERM_BITS) - 1)
            found.append(slot)
        return np.unique(np.array(found, dtype=np.int64))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    terms = Terms()
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1),
             pa.array([terms.slots(t.as_py()).astype(np.int32) for t in batch.column(2)], pa.list_(pa.int32()))],
            names=["doc_id", "toxic", "slots"])


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The machine fitted on the rows of the only partition, pickled."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held).sort_by("doc_id")
    del held
    machine = FactorizationMachine()
    machine.fit([s.values.to_numpy() for s in rows["slots"]], rows["toxic"].to_numpy().astype(np.float32))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(machine)], pa.binary())], names=["machine"])


def one_of_copies(documents: list[np.ndarray]) -> np.ndarray:
    """Indices of documents without the near copies of earlier ones, by banded minhashes of their
    terms: a label repeated over copies of one text is one observation, not many."""
    random = np.random.default_rng(SEED)
    factors = random.integers(1, 1 << 62, BANDS * BAND_ROWS, dtype=np.uint64) | np.uint64(1)
    seen: list[set[bytes]] = [set() for _ in range(BANDS)]
    kept = []
    for i, slots in enumerate(documents):
        least = ((slots[:, None].astype(np.uint64) + np.uint64(1)) * factors >> np.uint64(20)).min(axis=0)
        bands = [band.tobytes() for band in least.reshape(BANDS, BAND_ROWS)]
        if not any(band in known for band, known in zip(bands, seen)):
            kept.append(i)
        for band, known in zip(bands, seen):
            known.add(band)
    return np.array(kept, dtype=np.int64)


def screened_slots(documents: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Which terms have a linear weight: they go with the label more than the best of as many
    unrelated terms would.

    Log-likelihood ratio of term and label over documents, against 2 ln(terms): long texts
    hold thousands of neutral terms whose small weights would drown the telling ones.
    """
    size, n, toxic = 1 << TERM_BITS, len(documents), float(labels.sum())
    both = np.bincount(np.concatenate([d for d, y in zip(documents, labels) if y] or [np.zeros(0, np.int64)]), minlength=size)
    seen = np.bincount(np.concatenate(documents), minlength=size)
    cells = np.stack([both, seen - both, toxic - both, n - toxic - (seen - both)]).astype(np.float64)
    expected = np.stack([seen * toxic, seen * (n - toxic), (n - seen) * toxic, (n - seen) * (n - toxic)]) / n
    ratio = 2 * np.where(cells > 0, cells * np.log(np.where(cells > 0, cells, 1) / np.where(expected > 0, expected, 1)), 0).sum(axis=0)
    tried = seen >= LEAST_DOCUMENTS
    return tried & (ratio > 2 * np.log(max(2, np.count_nonzero(tried))))


def _pairs_of(documents: list[np.ndarray], terms: int) -> Iterator[np.ndarray]:
    """Codes ``low * terms + high`` of all pairs of the terms of each document."""
    for slots in documents:
        low, high = np.triu_indices(len(slots), 1)
        yield slots[low] * terms + slots[high]


def telling_pairs(documents: list[np.ndarray], labels: np.ndarray, expected: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of slots in more toxic documents than ``expected`` has it, and how much more (log ratio).

    Evidence are toxic documents with less than even odds so far. Over all documents with the
    pair, toxic ones are compared with the sum of ``expected``, raised by what either term exceeds
    it alone; twice the log-likelihood ratio has to pass 2 ln(pairs).
    """
    nothing = np.empty((0, 2), dtype=np.int64), np.empty(0)
    missed = [d[d > 0] for d, y, p in zip(documents, labels, expected) if y and p < 0.5]
    missed = [d for d in missed if len(d) <= PAIR_TERMS]
    if not missed:
        return nothing
    slots, seen = np.unique(np.concatenate(missed), return_counts=True)
    slots = slots[seen >= PAIR_DOCUMENTS]
    t = len(slots)
    missed = [np.searchsorted(slots, d[np.isin(d, slots)]) for d in missed]
    table = np.zeros(PAIR_SLOTS, dtype=np.int32)  # counts by a hash: too high at worst
    for codes in _pairs_of(missed, t):
        np.add.at(table, codes % PAIR_SLOTS, 1)
    codes = [c[table[c % PAIR_SLOTS] >= PAIR_DOCUMENTS] for c in _pairs_of(missed, t)]
    codes, counts = np.unique(np.concatenate(codes), return_counts=True) if codes else (np.empty(0, np.int64),) * 2
    codes = codes[counts >= PAIR_DOCUMENTS]
    if not len(codes):
        return nothing
    inside = [np.flatnonzero(np.isin(slots, d, assume_unique=True)) for d in documents]
    has = np.zeros((t, -(-len(documents) // 8)), dtype=np.uint8)
    at = np.repeat(np.arange(len(documents)), [len(d) for d in inside])
    flat = np.concatenate(inside)
    np.bitwise_or.at(has, (flat, at >> 3), (128 >> (at & 7)).astype(np.uint8))
    alone = np.bincount(flat, weights=labels[at], minlength=t) / np.maximum(np.bincount(flat, weights=expected[at], minlength=t), 1e-3)
    alone = np.maximum(alone, 1.0)
    sums = np.stack([labels.astype(np.float32), expected.astype(np.float32)], axis=1)
    found, excess = [], []
    for begin in range(0, len(codes), PAIR_BLOCK):
        block = codes[begin:begin + PAIR_BLOCK]
        both = np.unpackbits(has[block // t] & has[block % t], axis=1, count=len(documents))
        toxic, foreseen = np.maximum(both.astype(np.float32) @ sums, 1e-3).T
        foreseen = foreseen * np.maximum(alone[block // t], alone[block % t])
        ratio = 2 * (toxic * np.log(toxic / foreseen) - (toxic - foreseen))
        good = (toxic > foreseen) & (ratio > 2 * np.log(len(codes) + 1))
        found.append(block[good])
        excess.append(np.log(toxic / foreseen)[good])
    found = np.concatenate(found)
    return np.stack((slots[found // t], slots[found % t]), axis=1), np.concatenate(excess)


def blocks_of(documents: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Consecutive documents of at most SCORE_SLOTS slots together, or one longer document."""
    block, held = [], 0
    for slots in documents:
        if block and held + len(slots) > SCORE_SLOTS:
            yield block
            block, held = [], 0
        block.append(slots)
        held += len(slots)
    if block:
        yield block


class FactorizationMachine:
    def __init__(self) -> None:
        size = 1 << TERM_BITS
        self.bias = 0.0
        self.w = np.zeros(size, dtype=np.float32)
        self.v = np.zeros((size, FACTORS), dtype=np.float32)

    def __getstate__(self) -> tuple:
        """Few terms have weights: only their rows are sent."""
        used = np.flatnonzero((self.w != 0) | self.v.any(axis=1))
        return self.bias, used, self.w[used], self.v[used]

    def __setstate__(self, state: tuple) -> None:
        self.__init__()
        self.bias, used, w, v = state
        self.w[used], self.v[used] = w, v

    def raw_scores(self, slots: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """z of documents laid end to end, and the factor sums of each."""
        v = self.v[slots]
        sums = np.add.reduceat(v, starts, axis=0)
        squares = np.add.reduceat(np.einsum("ij,ij->i", v, v), starts)
        z = self.bias + np.add.reduceat(self.w[slots], starts) + 0.5 * (np.einsum("ij,ij->i", sums, sums) - squares)
        return z, sums

    def fit(self, documents: list[np.ndarray], labels: np.ndarray) -> None:
        """``documents`` hold distinct slots each; never empty, as slot 0 is always in."""
        if not documents:
            return
        kept = one_of_copies(documents)
        documents, labels = [documents[i] for i in kept], labels[kept]
        share = (labels.sum() + 1) / (len(labels) + 2)
        self.bias = float(np.log(share / (1 - share)))  # so that neutral terms start without a pull
        linear = screened_slots(documents, labels)
        linear[0] = True
        self._descend([d[linear[d]] for d in documents], labels, linear)
        expected = np.concatenate([self.expected(block) for block in blocks_of(documents)])
        pairs, excess = telling_pairs(documents, labels, expected)
        usable = linear.copy()
        usable[pairs] = True
        self.w[:] = 0
        self.v[usable] = np.random.default_rng(SEED).normal(0, 0.01, (int(usable.sum()), FACTORS))
        self._start_pairs(pairs, excess)
        self.v[0] = 0
        self._descend([d[usable[d]] for d in documents], labels, linear)

    def _start_pairs(self, pairs: np.ndarray, excess: np.ndarray) -> None:
        """Adds the leading eigenvectors of the excesses to the factors of their terms."""
        terms, place = np.unique(pairs, return_inverse=True)
        if not len(terms):
            return
        place = place.reshape(pairs.shape)
        strength = np.zeros((len(terms), len(terms)))
        strength[place[:, 0], place[:, 1]] = strength[place[:, 1], place[:, 0]] = np.minimum(excess, 4.0)
        values, vectors = np.linalg.eigh(strength)
        top = np.argsort(values)[::-1][:FACTORS]
        top = top[values[top] > 0]
        self.v[terms, :len(top)] += (vectors[:, top] * np.sqrt(values[top])).astype(np.float32)

    def _descend(self, documents: list[np.ndarray], labels: np.ndarray, linear: np.ndarray) -> None:
        """Fits the weights of the ``linear`` terms, and the factors that are not zero."""
        random = np.random.default_rng(SEED)
        lead, seen, seen_v = np.zeros_like(self.w), np.zeros_like(self.w), np.full_like(self.v, 1e-2)
        factors = self.v.any(axis=1)
        for _ in range(EPOCHS):
            order = random.permutation(len(documents))
            for at in range(0, len(order), BATCH):
                chosen = order[at:at + BATCH]
                slots = np.concatenate([documents[i] for i in chosen])
                lengths = np.array([len(documents[i]) for i in chosen])
                starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
                z, sums = self.raw_scores(slots, starts)
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[chosen]).astype(np.float32)
                owner = np.repeat(np.arange(len(chosen)), lengths)
                terms, place = np.unique(slots, return_inverse=True)
                grad = np.bincount(place, weights=error[owner], minlength=len(terms)).astype(np.float32)
                grad[~linear[terms]] = 0
                step = (np.sqrt(seen[terms] + grad * grad) - np.sqrt(seen[terms])) / RATE
                lead[terms] += grad - step * self.w[terms]
                seen[terms] += grad * grad
                strength = np.where(terms == 0, 0.0, L1)
                pull = np.sign(lead[terms]) * strength - lead[terms]
                self.w[terms] = np.where(np.abs(lead[terms]) <= strength, 0, pull / ((1 + np.sqrt(seen[terms])) / RATE + L2))
                if not factors.any():
                    continue
                each = error[owner, None] * (sums[owner] - self.v[slots])
                grad_v = np.stack([np.bincount(place, weights=each[:, f], minlength=len(terms)) for f in range(FACTORS)], axis=1)
                grad_v = (grad_v + L2 * self.v[terms]).astype(np.float32)
                grad_v[~factors[terms]] = 0
                seen_v[terms] += grad_v * grad_v
                self.v[terms] -= RATE * 0.1 * grad_v / np.sqrt(seen_v[terms])

    def expected(self, documents: list[np.ndarray]) -> np.ndarray:
        starts = np.cumsum([0] + [len(d) for d in documents[:-1]])
        return 1 / (1 + np.exp(-np.clip(self.raw_scores(np.concatenate(documents), starts)[0], -30, 30)))

    def probability(self, slots: np.ndarray) -> float:
        z, _ = self.raw_scores(slots, np.zeros(1, dtype=np.int64))
        return float(1 / (1 + np.exp(-np.clip(float(z[0]), -30, 30))))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> FactorizationMachine:
    """Machine fitted on labelled documents that are not held out.

    Labels with a NULL id or NULL mark are skipped; an id with several labels counts as toxic
    if one says so. At most TRAIN_ROWS ids are broadcast to find their texts; the slots of at most
    as many documents are fitted in one task, and only weights that are not zero reach the driver.
    """
    key = long_id(F.col("doc_id"))
    marks = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(key.alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    )
    texts = docs.select(long_id(F.col(doc_id)).alias("doc_id"), _raw(text).alias("text"))
    # a repeated id may bring more rows than labels: the bound holds for the rows that are fitted
    rows = (
        texts.join(F.broadcast(marks), "doc_id").select("doc_id", "toxic", "text")
        .mapInArrow(_features, "doc_id long, toxic int, slots array<int>")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "slots").limit(TRAIN_ROWS)
    )
    fitted = rows.mapInArrow(_fitted, "machine binary").collect()  # one row, none without documents
    return pickle.loads(fitted[0]["machine"]) if fitted else FactorizationMachine()


def scorer(machine: FactorizationMachine):
    """Column function: score of a binary text; NULL and empty texts get the constant's."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = Terms()
        for texts in batches:
            yield pd.Series([machine.probability(terms.slots(text)) for text in texts], dtype="float64")

    return score


def _raw(text: str) -> Column:
    return F.col(text).cast("string").cast("binary")


def toxicity_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    A NULL or empty text scores the constant of the machine. NULL ids are scored and not held
    out, repeated rows score alike, without labels every score is 0.5. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    score = scorer(train(docs, labels, doc_id, text))
    scored = docs.select(long_id(F.col(doc_id)).alias("doc_id"), score(_raw(text)).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= CUTOFF).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` scored below CUTOFF, with all their columns.

    NULL and empty texts score the constant of the machine; NULL and repeated ids are scored row by
    row; without labels all rows stay, and an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    return docs.where(scorer(train(docs, labels, doc_id, text))(_raw(text)) < CUTOFF)
