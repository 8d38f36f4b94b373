"""Words and word shingles of whole texts as 64-bit fingerprints, computed per document with numpy.

A word is a run of bytes other than ASCII white space (space, tab to carriage return), which
is what ``bytes.split()`` yields; A-Z are lower-cased. A shingle is five consecutive words; a
text of fewer words is one shingle. Fingerprints are polynomial hashes modulo 2**64 with a
final mix, so two different shingles of one pair of sets meet with a chance near
(sizes multiplied) / 2**64.
"""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 16
_SPACE = 0x20


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_BLOCK, int(_BASE))
_INVERSE = _powers(_BLOCK, pow(int(_BASE), -1, 1 << 64))
_POWER_STEP = int(_POWER[-1]) * int(_BASE) % (1 << 64)
_INVERSE_STEP = pow(_POWER_STEP, -1, 1 << 64)


def _power_range(n: int, table: np.ndarray, step: int) -> np.ndarray:
    """Powers 0..n-1 of the base, longer texts block by block."""
    if n <= _BLOCK:
        return table[:n]
    steps = _powers(-(-n // _BLOCK), step)
    return (steps[:, None] * table[None, :]).reshape(-1)[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle fingerprints (uint64); empty without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    found = window_hashes(words, width)
    found.sort()
    fresh = np.empty(len(found), dtype=bool)
    fresh[0] = True
    np.not_equal(found[1:], found[:-1], out=fresh[1:])
    return found[fresh]


def set_fingerprint(hashes: np.ndarray) -> int:
    """Signed 64-bit name of a set of shingles; equal sets have equal names."""
    total = int(np.add.reduce(mix(hashes ^ np.uint64(0xA0761D6478BD642F)))) + len(hashes) * 0x2545F4914F6CDD1D
    value = int(mix(np.array([total % (1 << 64)], dtype=np.uint64))[0])
    return value - (1 << 64) if value >= 1 << 63 else value


def window_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Fingerprints of all windows of ``width`` words, in order and with repeats."""
    joined = np.frombuffer(b" ".join(words), dtype=np.uint8)
    n = len(joined)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * _power_range(n, _POWER, _POWER_STEP), out=sums[1:])
    gaps = np.flatnonzero(joined == _SPACE)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [n]))
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    value = (sums[ends] - sums[starts]) * _power_range(n, _INVERSE, _INVERSE_STEP)[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
