"""Byte-level BPE by monoid tree reduction: encode halves, join them at their border.

Two joins are used, both exact:

* Text: a text is split into matches of a pattern. The matches of two halves are joined by
  scanning again from the last match of the left half that later characters cannot change,
  until a match ends where one of the right half ends; nothing after that can differ.
* Pieces: a long match is encoded in halves. The tokens next to the border are encoded again
  in a window that doubles until the tokens at both of its ends are compatible with their
  neighbours outside. A sequence whose neighbours are all compatible (two tokens are, if
  their joined bytes encode to just them) is the encoding, because the first merge across a
  token border would also happen in that pair alone.

Decoding concatenates bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, functions as F

from finmart.llm.tables import long_id, small_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Leaves of the tree over characters, over bytes of one match, and over token ids.
LEAF_CHARS = 4096
LEAF_BYTES = 48
LEAF_IDS = 4096
#: Matches and pairs remembered while a partition is worked on, in two generations; only saves time.
REMEMBERED = 120_000
NO_RANK = 1 << 60
#: Characters a match may look at from its start, and past its end, in the pattern.
LOOK_FROM_START = 3
LOOK_PAST_END = 1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe:
    """Encoder and decoder for one table of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.pattern = regex.compile(pattern)
        self.fits: dict[tuple[int, int], bool] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def forget(self) -> None:
        """Drops what was remembered; a reused worker process holds only the vocabulary."""
        self.young, self.old, self.fits = {}, {}, {}

    # pieces

    def merge(self, piece: bytes) -> list[int]:
        """Merges the adjacent pair of least rank, leftmost first, until none has a rank."""
        n, ranks, rank_of = len(piece), self.ranks, self.ranks.get
        if n > LEAF_BYTES:
            return self._merge_long(piece)
        borders = list(range(n + 1))
        pairs = [rank_of(piece[i:i + 2], NO_RANK) for i in range(n - 1)]
        while pairs:
            least = min(pairs)
            if least == NO_RANK:
                break
            i = pairs.index(least)
            del borders[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank_of(piece[borders[i]:borders[i + 2]], NO_RANK)
            if i:
                pairs[i - 1] = rank_of(piece[borders[i - 1]:borders[i + 1]], NO_RANK)
        return [ranks[piece[i:j]] for i, j in zip(borders, borders[1:])]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same by a heap over linked parts, for windows that had to grow."""
        n, ranks = len(piece), self.ranks
        after, before, end, alive = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                rank = ranks.get(piece[i:end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, stop = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            alive[j], end[i], after[i] = False, stop, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]

    def compatible(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            known = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
            if len(self.fits) >= REMEMBERED:
                self.fits.clear()
            self.fits[left, right] = known
        return known

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the joined bytes of two encodings."""
        if not left or not right:
            return left + right
        reach = 1
        while True:
            a, b = max(0, len(left) - reach), min(len(right), reach)
            window = self.merge(self.decode_tokens(left[a:] + right[:b]))
            if (a == 0 or self.compatible(left[a - 1], window[0])) and (
                    b == len(right) or self.compatible(window[-1], right[b])):
                return left[:a] + window + right[b:]
            reach *= 2

    def encode_bytes(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF_BYTES:
            return self.merge(piece)
        half = len(piece) // 2
        return self.join_tokens(self.encode_bytes(piece[:half]), self.encode_bytes(piece[half:]))

    def encode_match(self, match: str) -> bytes:
        """Token ids of one match as packed 32-bit integers."""
        piece = match.encode("utf-8")
        whole = self.ranks.get(piece)
        return array("i", [whole] if whole is not None else self.encode_bytes(piece)).tobytes()

    # texts

    def matches(self, text: str, start: int = 0, stop: int | None = None) -> list[str]:
        """Matches of ``text[start:stop]`` by the tree."""
        stop = len(text) if stop is None else stop
        if stop - start <= LEAF_CHARS:
            return self.pattern.findall(text[start:stop])
        half = (start + stop) // 2
        return self.join_matches(self.matches(text, start, half), self.matches(text, half, stop))

    def join_matches(self, left: list[str], right: list[str]) -> list[str]:
        tail, i = 0, len(left)
        # tail: characters of the left half from match i on; stable matches stay as they are
        while i and (tail < LOOK_PAST_END or tail + len(left[i - 1]) < LOOK_FROM_START):
            i -= 1
            tail += len(left[i])
        reach = 4
        while True:
            window = "".join(left[i:]) + "".join(right[:reach])
            ends, at = {}, tail
            for k, match in enumerate(right[:reach]):
                at += len(match)
                ends[at] = k + 1
            found, at = [], 0
            for match in self.pattern.findall(window):
                found.append(match)
                at += len(match)
                # decided by what lies inside the window, or by the end of the text
                inside = reach >= len(right) or at + max(LOOK_PAST_END, LOOK_FROM_START) <= len(window)
                if at in ends and inside:
                    return left[:i] + found + right[ends[at]:]
            if reach >= len(right):
                return left[:i] + found
            reach *= 2

    def encode(self, text: str) -> np.ndarray:
        young, old, matches = self.young, self.old, self.matches(text)
        out = list(map(young.get, matches))
        if None in out:
            for i, ids in enumerate(out):
                if ids is not None:
                    continue
                match = matches[i]
                ids = young.get(match) or old.get(match) or self.encode_match(match)
                if len(match) <= LEAF_BYTES:
                    young[match] = ids
                out[i] = ids
        if len(young) > REMEMBERED:
            self.old, self.young = young, {}
        return np.frombuffer(b"".join(out), dtype=np.int32)

    def decode_tokens(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode_tokens(ids[:half]) + self.decode_tokens(ids[half:])


_CODERS: dict[str, ByteBpe] = {}


def _coder(path: str) -> ByteBpe:
    """One coder per worker process and vocabulary."""
    if path not in _CODERS:
        _CODERS[path] = ByteBpe(read_ranks(path))
    return _CODERS[path]


def read_text(value: pa.Scalar) -> str:
    """Text of a binary cell; NULL is empty, bytes that are no UTF-8 become U+FFFD."""
    raw = value.as_py()
    return raw.decode("utf-8", "replace") if raw else ""


def _encode(path: str, with_decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for batch in batches:
            rows, held = [], 0
            for key, text in zip(batch.column(0), batch.column(1)):
                ids = coder.encode(read_text(text))
                rows.append((key.as_py(), ids, coder.decode_tokens(ids.tolist()) if with_decoded else None))
                held += len(ids)
                if held > 1 << 20:  # bounds what one Arrow batch holds
                    yield _encoded(rows)
                    rows, held = [], 0
            if rows:
                yield _encoded(rows)
        coder.forget()

    return run


def _encoded(rows: list[tuple]) -> pa.RecordBatch:
    keys, ids, decoded = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())],
        names=["doc_id", "ids", "decoded"],
    )


def encode_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     vocabulary: str | None = None, with_decoded: bool = False) -> DataFrame:
    """``(doc_id, ids array<int>, decoded binary)`` for every row of ``docs``.

    ``ids`` are those of an ordinary encoding without special tokens; a NULL or empty text has
    none. ``decoded`` holds the bytes that the ids decode to, or NULL unless ``with_decoded``.
    NULL ids and repeated rows are kept as they are; other columns are not read.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    small_batches(docs.sparkSession)
    return docs.select(
        long_id(F.col(doc_id)).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text")
    ).mapInArrow(_encode(path, with_decoded), "doc_id long, ids array<int>, decoded binary")


def decode_documents(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, decoded binary)`` from ``(doc_id, ids)``; NULL ids decode to no bytes."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for batch in batches:
            decoded = [coder.decode_tokens(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and hashes of an encoding that carries its decoded bytes."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
