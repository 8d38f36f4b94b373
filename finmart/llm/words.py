"""Word spans and fingerprints of whole buffers of text, and bitmaps that prune before a shuffle.

Fingerprints name words only where a collision costs work, or where two independent ones have
to agree. A bitmap has a fixed size: it never loses a member, and lets more through as it fills.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from finmart.llm.shingles import mix

_BASE = 0x9E3779B97F4A7C15
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
#: 2 MB, whatever the size of the data.
BITMAP_BITS = 24
#: Bytes of text laid end to end before numpy works on them; one longer text is a buffer of its own.
BUFFER_BYTES = 1 << 20


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def fold_table(separates: Callable[[int], int | None]) -> bytes:
    """Byte table: A-Z in lower case, and what ``separates`` answers for the bytes it knows."""
    return bytes(
        kept if (kept := separates(b)) is not None else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
    )


def spans(buffer: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are no separators."""
    edges = np.flatnonzero(np.diff(separator.astype(np.int8), prepend=np.int8(1), append=np.int8(1)))
    return edges[::2], edges[1::2]


def word_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the words ``buffer[starts[i]:ends[i]]``."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    sizes = ends - starts
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    inside = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    values = buffer[inside + np.repeat(starts, sizes)].astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(values * powers(int(sizes.max()))[inside], first)
    return mix(sums + sizes.astype(np.uint64) * _LENGTH)


def gram_sums(words: np.ndarray, width: int) -> np.ndarray:
    """Sums of ``width`` consecutive fingerprints weighted by place; mix them before use as names."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = words[:n].copy()
    for place, weight in enumerate(powers(width)[1:], 1):
        total += words[place:place + n] * weight
    return total


def buffers(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of a batch, ``BUFFER_BYTES`` at a time: first row and texts; NULL is empty."""
    first, held, size = 0, [], 0
    for at, value in enumerate(batch.column(column)):
        held.append(value.as_py() or b"")
        size += len(held[-1])
        if size >= BUFFER_BYTES:
            yield first, held
            first, held, size = at + 1, [], 0
    if held:
        yield first, held


def bitmap_of(hashes: DataFrame) -> np.ndarray:
    """Bits of the leading ``BITMAP_BITS`` bits of the only column, packed into 64-bit words.

    What reaches the driver is the bitmap: at most ``2 ** BITMAP_BITS / 64`` rows.
    """
    slot = F.shiftrightunsigned(F.col(hashes.columns[0]), 64 - BITMAP_BITS)
    found = (
        hashes.select(F.shiftrightunsigned(slot, 6).alias("word"), F.expr("1L").alias("one"), slot.alias("slot"))
        .select("word", F.call_function("shiftleft", F.col("one"), F.col("slot").bitwiseAND(63).cast("int")).alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    packed = np.zeros((1 << BITMAP_BITS) // 64, dtype=np.uint64)
    if found.num_rows:
        packed[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return packed


def in_bitmap(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> np.uint64(64 - BITMAP_BITS)
    return (packed[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
