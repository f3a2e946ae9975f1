"""Words of Arrow string columns as 64-bit hashes, computed over the UTF-8 bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are hashed in pieces of about so many bytes, cut at blanks, so memory doesn't follow the longest text.
PIECE = 1 << 18
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += 32
#: The byte's term in a hash, as a table for bytes.translate; 255 is in no UTF-8 text.
TERM = bytes((int(x) + 1) % 256 for x in LOWER)
INK = bytes(int(not x) for x in BLANK)
FACTOR = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(FACTOR, -1, 1 << 64)

_powers: dict[int, np.ndarray] = {}


def powers(n: int, factor: int = FACTOR) -> np.ndarray:
    """The powers of factor from 0 on, n of them at least."""
    if factor not in _powers or len(_powers[factor]) < n:
        out = np.full(max(n, 256), factor, np.uint64)
        out[0] = 1
        _powers[factor] = np.multiply.accumulate(out)
    return _powers[factor]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash of two whole numbers."""
    return mix(mix(a.astype(np.int64).view(np.uint64)) + b.astype(np.int64).view(np.uint64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each text begins; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return data, at - at[0]


def parts(column: pa.Array, most: int = 1 << 19) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of a column in parts of about so many bytes; a longer text is alone."""
    _, cuts = utf8(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(cuts, cuts[lo] + most, "right")) - 1)
        yield lo, column.slice(lo, hi - lo)
        lo = hi


def pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(data):
        end, step = min(at + PIECE, len(data)), 64
        while end < len(data):
            blanks = np.flatnonzero(BLANK[data[end : end + step]])
            if len(blanks):
                end += int(blanks[0])
                break
            end, step = min(end + step, len(data)), 2 * step
        yield at, end
        at = end


def word_hashes(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start byte, hash) of every word: a longest run of bytes without ASCII blanks that no cut crosses. A-Z count as a-z.

    A word's hash is the sum of (byte + 1) * FACTOR ** place, mixed. The sums run over a whole piece and are brought back
    to the word's start by the inverse of FACTOR, which is odd and so has one.
    """
    starts, hashes = [], []
    for lo, hi in pieces(data):
        part = data[lo:hi]
        raw = part.tobytes()
        ink = np.frombuffer(bytearray(raw.translate(INK)), bool)
        first = ink.copy()
        first[1:] &= ~ink[:-1]
        here = cuts[np.searchsorted(cuts, lo) : np.searchsorted(cuts, hi)] - lo
        first[here] = ink[here]
        start = np.flatnonzero(first)
        if not len(start):
            continue
        last = ink.copy()
        last[:-1] &= ~ink[1:] | first[1:]
        end = np.flatnonzero(last) + 1
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(np.frombuffer(raw.translate(TERM), np.uint8) * powers(len(part))[: len(part)], out=total[1:])
        hashes.append(mix((total[end] - total[start]) * powers(len(part), INVERSE)[start]))
        starts.append(start + lo)
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def owner(starts: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Words before each cut: the words of text i are those from out[i] to out[i + 1]."""
    return np.searchsorted(starts, cuts)
