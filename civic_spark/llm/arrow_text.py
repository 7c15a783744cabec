"""Whole texts as Arrow buffers: bytes, words and 64-bit word hashes, vectorised with numpy.

A text column arrives as one byte buffer and offsets, so words of a whole batch are found and hashed without a Python
string per word.  Work arrays are bounded by ``CHUNK`` bytes of text: short texts are packed together, a longer text
is hashed in segments cut at separators.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20

#: Odd multipliers of the polynomial and of the finaliser (splitmix64).
BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_table(separators: bytes) -> np.ndarray:
    """True for every byte that belongs to a word."""
    t = np.ones(256, dtype=bool)
    t[list(separators)] = False
    return t


#: Words `[^\x20\x09-\x0D]+`.
SPACE_WORDS = word_table(b" \t\n\x0b\x0c\r")
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing A-Z).
ALNUM_WORDS = word_table(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: Lower-cases A-Z and nothing else.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


class _Powers:
    """Powers of BASE modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            inverse = pow(BASE, -1, 1 << 64)
            self.up = _powers(BASE, n)
            self.down = _powers(inverse, n)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


POWERS = _Powers()


def text_buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and n + 1 offsets (int64); a null has no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def words_at(buf: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in a byte buffer."""
    inside = np.zeros(len(buf) + 2, dtype=np.int8)
    inside[1:-1] = table[buf]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: differences of one running polynomial, shifted back to position 0."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    POWERS.upto(len(buf) + 1)
    run = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * POWERS.up[:len(buf)], out=run[1:])
    return mix((run[ends] - run[starts]) * POWERS.down[starts] + (ends - starts).astype(np.uint64))


def _long_text(buf: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, segment by segment; a segment ends at a separator (or goes on until one)."""
    out, at = [], 0
    while at < len(buf):
        end = min(at + CHUNK, len(buf))
        if end < len(buf):
            inside = np.flatnonzero(~table[buf[at:end]])
            if len(inside):
                end = at + int(inside[-1]) + 1
            else:
                rest = np.flatnonzero(~table[buf[end:]])
                end = end + int(rest[0]) + 1 if len(rest) else len(buf)
        part = buf[at:end]
        out.append(hash_words(part, *words_at(part, table)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def hashed_texts(col: pa.Array, table: np.ndarray, lower: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of its words in order) for every row of a string column, in row order."""
    data, at = text_buffers(col)
    n, row = len(at) - 1, 0
    while row < n:
        last = max(row + 1, int(np.searchsorted(at, at[row] + CHUNK, side="right")) - 1)
        last = min(last, n)
        buf = data[at[row]:at[last]]
        buf = LOWER[buf] if lower else buf
        if last == row + 1 and len(buf) > CHUNK:
            yield row, _long_text(buf, table)
            row = last
            continue
        own = at[row:last + 1] - at[row]
        # A separator between texts keeps their words apart.
        gap = np.zeros(len(buf) + (last - row), dtype=np.uint8)
        gap[:] = 0x20
        place = np.arange(len(buf)) + np.repeat(np.arange(last - row), np.diff(own))
        gap[place] = buf
        starts, ends = words_at(gap, table)
        hashes = hash_words(gap, starts, ends)
        cut = np.searchsorted(starts, own + np.arange(last - row + 1))
        for k in range(last - row):
            yield row + k, hashes[cut[k]:cut[k + 1]]
        row = last


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words; with fewer words, of the whole sequence."""
    if not len(words):
        return words
    width = min(size, len(words))
    n = len(words) - width + 1
    acc = np.full(n, np.uint64(width), dtype=np.uint64)
    for k in range(width):
        acc = acc * np.uint64(BASE) + words[k:k + n]
    return np.unique(mix(acc))
