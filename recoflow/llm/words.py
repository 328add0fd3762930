"""Words of Arrow text columns as numpy arrays, without Python objects per word.

A word is a run of bytes that a 256-entry table marks; UTF-8 bytes from 0x80 up
are always marked, so a table over ASCII decides. Only A-Z are lower-cased.
Hashes are 64 bits wide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACED = np.ones(256, bool)          # words [^\x20\x09-\x0D]+
SPACED[[32, *range(9, 14)]] = False
LETTERS = np.zeros(256, bool)        # words [0-9A-Za-z\x80-\xff]+ of lower-cased text
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 places where its rows begin; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def slices(at: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Runs of rows with about ``size`` bytes; a longer row is a run of its own."""
    out, first = [], 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        out.append((first, last))
        first = last
    return out


def spans(data: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word of rows at[0]..at[-1] begins and ends, and each row's first word."""
    low = int(at[0])
    inside = table[data[low:int(at[-1])]]
    rows = at - low
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cut = rows[(rows > 0) & (rows < len(inside))]
    begin[cut] = inside[cut]
    end[cut - 1] = inside[cut - 1]
    begins = np.flatnonzero(begin)
    return begins + low, np.flatnonzero(end) + 1 + low, np.searchsorted(begins, rows)


def hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word, A-Z as a-z if ``lower``: its 8-byte pieces folded one after the other."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    low = int(begins[0])
    text = data[low:int(ends[-1])]
    text = np.concatenate([_LOWER[text] if lower else text, np.zeros(8, np.uint8)])
    pieces = np.ndarray(len(text) - 7, "<u8", text, strides=(1,))
    at, left = begins - low, ends - begins
    got = _piece(pieces, at, left) * _BASE
    live = np.flatnonzero(left > 8)
    step = 8
    while len(live):
        got[live] = mix(got[live]) + _piece(pieces, at[live] + step, left[live] - step) * _BASE
        step += 8
        live = live[left[live] > step]
    return mix(got + left.astype(np.uint64))


def _piece(pieces: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    return pieces[at] & _MASKS[np.minimum(left, 8)]


def grams(hashed: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of n words (its whole word row if shorter), and where rows begin."""
    factors = [np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64)) for k in range(n)]
    count = np.diff(first)
    total = len(hashed)
    padded = np.concatenate([hashed, np.zeros(n, np.uint64)])
    every = padded[:total] * factors[0]
    for k in range(1, n):
        every += padded[k:total + k] * factors[k]
    full = np.ones(total, bool)
    for k in range(1, n):                       # the last n - 1 places of a row begin no full run
        full[np.maximum(first[1:] - k, first[:-1])[count > 0]] = False
    short = np.flatnonzero((count > 0) & (count < n))
    part = np.zeros(len(short), np.uint64)
    for k in range(n - 1):
        part += np.where(count[short] > k, padded[first[short] + k] * factors[k], 0).astype(np.uint64)
    every[first[short]] = part
    full[first[short]] = True
    made = np.where(count >= n, count - n + 1, (count > 0).astype(count.dtype))
    return mix(every[full]), np.concatenate([[0], np.cumsum(made)])
