"""Vectorised word hashing over Arrow string columns.

Works on the UTF-8 bytes of a batch, a bounded slice at a time: word borders come from a
256-entry byte class, each word's 64-bit hash is a polynomial over a fixed random byte table
(one ``reduceat`` per slice). Multi-byte characters are never split, because every byte of
theirs has the same class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 19
_MULT = U64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective); wraps on purpose."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_TABLE = mix64((np.arange(1, 257, dtype=U64)) * U64(0xD1342543DE82EF95))


def byte_class(separators: bytes) -> np.ndarray:
    """True for the bytes that belong to words."""
    out = np.ones(256, dtype=bool)
    out[list(separators)] = False
    return out


#: words ``[^\x20\x09-\x0D]+``
SPACED = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing A-Z)
ALNUM_LOWER = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))

_IDENTITY = np.arange(256, dtype=np.uint8)
_LOWER = _IDENTITY.copy()
_LOWER[0x41:0x5B] += 32


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def run_hashes(raw: np.ndarray, mask: np.ndarray, first: np.ndarray, table: np.ndarray):
    """Hashes, first bytes and lengths of runs of bytes: ``mask`` marks the bytes that belong to
    runs, ``first`` the ones that begin a run."""
    at = np.flatnonzero(mask)
    if not len(at):
        return np.zeros(0, U64), at, at
    begin = np.flatnonzero(first[at])                          # index among the marked bytes
    lengths = np.diff(np.append(begin, len(at)))
    pos = np.arange(len(at)) - np.repeat(begin, lengths)
    power = np.multiply.accumulate(np.full(int(lengths.max()), _MULT, dtype=U64))
    sums = np.add.reduceat(table[raw[at]] * power[pos], begin)
    return mix64(sums + lengths.astype(U64) * U64(0xA0761D6478BD642F)), at[begin], lengths


def _hash_slice(raw: np.ndarray, starts_of_docs: np.ndarray, table: np.ndarray, in_word: np.ndarray):
    """Hashes and first bytes of the words of one slice; documents also break words."""
    mask = in_word[raw]
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    inside = starts_of_docs[starts_of_docs < len(raw)]
    first[inside] = mask[inside]
    return run_hashes(raw, mask, first, table)[:2]


def hashed_words(column: pa.Array, in_word: np.ndarray, lower: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(i, j, hashes, counts)`` for consecutive documents ``i..j-1`` of the column:
    their word hashes one after the other and the number of words of each. Slices hold about
    ``SLICE_BYTES`` bytes; a longer document is hashed piecewise, cut at separators."""
    data, off = string_buffers(column)
    fold = _LOWER if lower else _IDENTITY
    table = BYTE_TABLE[fold]
    word = in_word[fold]
    n, i = len(off) - 1, 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + SLICE_BYTES, side="right")) - 1
        if j <= i:                                             # one long document
            parts, a, end = [], int(off[i]), int(off[i + 1])
            while a < end:
                b = min(end, a + SLICE_BYTES)
                while b < end and word[data[b]] and word[data[b - 1]]:
                    b += 1                                     # never inside a word
                parts.append(_hash_slice(data[a:b], np.zeros(0, np.int64), table, word)[0])
                a = b
            h = np.concatenate(parts) if parts else np.zeros(0, U64)
            yield i, i + 1, h, np.array([len(h)], dtype=np.int64)
            i += 1
            continue
        j = min(j, n)
        starts = off[i:j + 1] - off[i]
        h, at = _hash_slice(data[off[i]:off[j]], starts[:-1], table, word)
        yield i, j, h, np.diff(np.searchsorted(at, starts, side="left"))
        i = j


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, dtype=U64)
    for x in range(k):
        out = out * U64(0xD6E8FEB86659FD93) + words[x:x + n]
    return mix64(out + U64(k))
