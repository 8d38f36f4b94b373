"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read in segments of SEGMENT bytes. In every segment one recurrent layer runs forward
and one backward from a zero state; at each byte both states give a distribution over the
languages, and a document's distribution is the mean over all of its bytes. Every byte of the
whole text is labelled. The network is trained in numpy by backpropagation through time, on
segments of a bounded sample of documents; the label of a segment's bytes is its document's.

Update of a layer: z = s(a_z), r = s(a_r), c = tanh(x_c + r * (h U_c)), h' = h + z * (c - h), where
a byte's inputs are rows of a table and s(a) = (1 + tanh(a / 2)) / 2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from finmart.llm.byte_bpe import read_text
from finmart.llm.tables import long_id
from finmart.llm.toxicity import held_out

#: Documents used for training, those of least hash, and segments taken from each of them.
TRAIN_ROWS = 2_000
TRAIN_SEGMENTS = 3
SEGMENT = 64
HIDDEN = 8
EPOCHS = 6
BATCH = 128
RATE = 0.02
SEED = 11
#: Segments labelled at once; bounds the memory of a task whatever a text's length.
WIDTH = 2048
NO_LANGUAGE = "und"

_LETTER = regex.compile(r"\p{L}")
_PAD = 256


class Layer:
    """One direction: input rows of a byte for (z, r, c), recurrent weights, no bias (the rows hold it)."""

    def __init__(self, random: np.random.Generator):
        self.rows = random.normal(0, 0.3, (_PAD + 1, 3 * HIDDEN)).astype(np.float32)
        self.u = random.normal(0, 0.5 / np.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN)).astype(np.float32)

    def run(self, steps: np.ndarray) -> np.ndarray:
        """States (T, HIDDEN, N) for bytes (T, N); one row per unit keeps every step contiguous."""
        k, (t, n) = HIDDEN, steps.shape
        # halves of the logistic functions are folded into the weights
        fold = np.repeat(np.float32([0.5, 0.5, 1.0]), k)[:, None]
        table = np.ascontiguousarray(self.rows.T * fold)
        u = np.ascontiguousarray(self.u.T * np.float32(0.5))
        states = np.empty((t, k, n), dtype=np.float32)
        h = np.zeros((k, n), dtype=np.float32)
        x, a = np.empty((3 * k, n), dtype=np.float32), np.empty((3 * k, n), dtype=np.float32)
        gates, c = a[:2 * k], a[2 * k:]
        for i in range(t):
            np.take(table, steps[i], axis=1, out=x, mode="clip")
            np.matmul(u, h, out=a)
            gates += x[:2 * k]
            np.tanh(gates, out=gates)
            gates += 1.0
            c *= gates[k:]
            c += x[2 * k:]
            np.tanh(c, out=c)
            c -= h
            gates[:k] *= 0.5
            c *= gates[:k]
            h = np.add(h, c, out=states[i])
        return states

    def gradients(self, steps: np.ndarray, states: np.ndarray, pull: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of rows and weights, given (T, N, HIDDEN) states and their gradients."""
        t, n = steps.shape
        k = HIDDEN
        g_rows, g_u = np.zeros_like(self.rows), np.zeros_like(self.u)
        back = np.zeros((n, k), dtype=np.float32)
        for i in range(t - 1, -1, -1):
            before = states[i - 1] if i else np.zeros((n, k), dtype=np.float32)
            x, a = self.rows[steps[i]], before @ self.u
            z = 0.5 * (1 + np.tanh(0.5 * (a[:, :k] + x[:, :k])))
            r = 0.5 * (1 + np.tanh(0.5 * (a[:, k:2 * k] + x[:, k:2 * k])))
            c = np.tanh(x[:, 2 * k:] + r * a[:, 2 * k:])
            d = pull[i] + back
            d_c = d * z * (1 - c * c)
            d_z = d * (c - before) * z * (1 - z)
            d_r = d_c * a[:, 2 * k:] * r * (1 - r)
            inputs = np.concatenate((d_z, d_r, d_c), axis=1)
            inner = np.concatenate((d_z, d_r, d_c * r), axis=1)
            np.add.at(g_rows, steps[i], inputs)
            g_u += before.T @ inner
            back = d * (1 - z) + inner @ self.u.T
        return g_rows, g_u


class ByteTagger:
    def __init__(self, languages: list[str]):
        random = np.random.default_rng(SEED)
        self.languages = languages
        self.ahead, self.back = Layer(random), Layer(random)
        self.out = random.normal(0, 0.3, (2 * HIDDEN, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), dtype=np.float32)

    def label(self, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(T, languages, N) probabilities and both layers' states for segments (N, T) of bytes or pads."""
        steps = np.ascontiguousarray(segments.T)
        ahead, back = self.ahead.run(steps), self.back.run(steps[::-1])[::-1]
        found = np.matmul(self.out[:HIDDEN].T, ahead)
        found += np.matmul(self.out[HIDDEN:].T, back)
        found += self.bias[:, None]
        np.clip(found, -40, 40, out=found)
        np.exp(found, out=found)
        found /= found.sum(axis=1, keepdims=True)
        return found, ahead, back

    def fit(self, segments: np.ndarray, labels: np.ndarray) -> None:
        random = np.random.default_rng(SEED)
        weights = [self.ahead.rows, self.ahead.u, self.back.rows, self.back.u, self.out, self.bias]
        first, second, count = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        for epoch in range(EPOCHS):
            order = random.permutation(len(segments))
            rate = RATE * (1 - 0.9 * epoch / EPOCHS)
            for at in range(0, len(order), BATCH):
                chosen = order[at:at + BATCH]
                steps = np.ascontiguousarray(segments[chosen].T)
                real = (steps != _PAD)[:, :, None]
                error, ahead, back = (x.transpose(0, 2, 1) for x in self.label(segments[chosen]))
                error = np.ascontiguousarray(error)
                error[:, np.arange(len(chosen)), labels[chosen]] -= 1
                error *= real / max(1, real.sum())
                grads_ahead = self.ahead.gradients(steps, ahead, error @ self.out[:HIDDEN].T)
                grads_back = self.back.gradients(steps[::-1], back[::-1], (error @ self.out[HIDDEN:].T)[::-1])
                flat = error.reshape(-1, error.shape[2])
                g_out = np.concatenate((ahead.reshape(-1, HIDDEN).T @ flat, back.reshape(-1, HIDDEN).T @ flat))
                count += 1
                for w, g, m, v in zip(weights, (*grads_ahead, *grads_back, g_out, flat.sum(axis=0)), first, second):
                    g = np.clip(g, -1, 1)
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.99**count)) + 1e-6)

    def pool(self, texts: list[bytes]) -> np.ndarray:
        """Mean distribution over all bytes of each text; texts are never empty."""
        totals = np.zeros((len(texts), len(self.languages)))
        lengths = np.array([len(t) for t in texts])
        for segments, owners in segment_blocks(texts):
            found, _, _ = self.label(segments)
            found *= (segments.T != _PAD)[:, None, :]
            np.add.at(totals, owners, found.sum(axis=0).T)
        return totals / lengths[:, None]


def cut(text: bytes) -> np.ndarray:
    """Segments (N, SEGMENT) of one text, the last one padded."""
    n = max(1, -(-len(text) // SEGMENT))
    out = np.full(n * SEGMENT, _PAD, dtype=np.int16)
    out[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    return out.reshape(n, SEGMENT)


def segment_blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All segments of all texts in blocks of WIDTH, with the index of their text."""
    held, owners, size = [], [], 0
    for i, text in enumerate(texts):
        segments = cut(text)
        for at in range(0, len(segments), WIDTH):
            part = segments[at:at + WIDTH]
            held.append(part)
            owners.append(np.full(len(part), i))
            size += len(part)
            if size >= WIDTH:
                yield np.concatenate(held), np.concatenate(owners)
                held, owners, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(owners)


def _sample_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to TRAIN_SEGMENTS segments spread evenly over each whole text."""
    for batch in batches:
        rows = []
        for key, lang, text in zip(*(batch.column(i) for i in range(3))):
            raw = text.as_py()
            if raw:
                segments = cut(raw)
                for i in sorted({int((j + 0.5) * len(segments) / TRAIN_SEGMENTS) for j in range(TRAIN_SEGMENTS)}):
                    rows.append((key.as_py(), lang.as_py(), segments[i].tobytes()))
        keys, langs, parts = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(langs, pa.string()), pa.array(parts, pa.binary())],
            names=["doc_id", "lang", "segment"])


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> ByteTagger | None:
    """Tagger fitted on a bounded sample of rows with a language that are not held out.

    At most TRAIN_ROWS ids are broadcast to find their texts; only segments of SEGMENT bytes
    reach the driver. None if no row has a language.
    """
    rows = docs.select(
        long_id(F.col(doc_id)).alias("doc_id"), F.col(lang).cast("string").alias("lang"),
        F.col(text).cast("string").cast("binary").alias("text"))
    usable = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = (
        usable.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit("language sample")), "doc_id").limit(TRAIN_ROWS))
    sample = (
        usable.join(F.broadcast(chosen), "doc_id").select("doc_id", "lang", "text")
        .mapInArrow(_sample_segments, "doc_id long, lang string, segment binary").toArrow()
        .sort_by([("doc_id", "ascending"), ("lang", "ascending"), ("segment", "ascending")])
    ).slice(0, TRAIN_ROWS * TRAIN_SEGMENTS)
    if not len(sample):
        return None
    languages = sorted(set(sample["lang"].to_pylist()))
    index = {name: i for i, name in enumerate(languages)}
    tagger = ByteTagger(languages)
    segments = np.stack([np.frombuffer(s, dtype=np.int16) for s in sample["segment"].to_pylist()])
    tagger.fit(segments, np.array([index[name] for name in sample["lang"].to_pylist()]))
    return tagger


def _predict(tagger: ByteTagger | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [read_text(t) for t in batch.column(1)]
            names, scores = [NO_LANGUAGE] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if tagger is not None and _LETTER.search(t)]
            if known:
                pooled = tagger.pool([texts[i].encode("utf-8", "surrogatepass") for i in known])
                for i, row in zip(known, pooled):
                    best = int(row.argmax())  # of equal ones the first by name
                    names[i], scores[i] = tagger.languages[best], float(min(1.0, row[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return run


def language_predictions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row of ``docs``.

    ``score`` is the pooled probability of the predicted language. A NULL text and one without
    a letter are ``und`` with score 0, as is everything if no language can be learned. NULL ids
    are predicted and not held out; repeated rows are predicted alike. Other columns are not read.
    """
    tagger = train(docs, doc_id, text, lang)
    found = docs.select(
        long_id(F.col(doc_id)).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text")
    ).mapInArrow(_predict(tagger), "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
