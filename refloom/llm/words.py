"""Vectorised tokenising and hashing of whole Arrow string columns.

Words are maximal runs of bytes outside a separator set, after A-Z became a-z.
Both separator sets are ASCII, so working on UTF-8 bytes equals working on code
points. A word's hash is a polynomial over its bytes modulo 2**64, taken from
prefix sums, so that no Python code runs per word; memory is bounded by blocks.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: True for bytes of words: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ and [^\x20\x09-\x0D]+ of lower-cased text.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
NONSPACE = np.ones(256, dtype=bool)
NONSPACE[0x09:0x0E] = NONSPACE[0x20] = False

CHUNK_BYTES = 1 << 19
BLOCK_BYTES = 1 << 18
_LIBC = ctypes.CDLL(None)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


class Words(NamedTuple):
    """Words of some documents; those of document d are ptr[d]:ptr[d + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    ptr: np.ndarray
    hashes: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables() -> list[np.ndarray]:
    """Powers of the base and of its inverse, for one block."""
    if not _powers:
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(BLOCK_BYTES + 1, b, dtype=np.uint64)
            p[0] = 1
            _powers.append(np.cumprod(p, dtype=np.uint64))
    return _powers


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word data[start:end]."""
    out = np.empty(len(starts), dtype=np.uint64)
    up, down = _tables()
    i = 0
    while i < len(starts):
        a = starts[i]
        j = int(np.searchsorted(ends, a + BLOCK_BYTES, side="right"))
        if j <= i:  # one word longer than a block
            out[i] = int.from_bytes(hashlib.blake2b(data[a : ends[i]].tobytes(), digest_size=8).digest(), "little")
            i += 1
            continue
        piece = data[a : ends[j - 1]]
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[: len(piece)], out=sums[1:])
        s = starts[i:j] - a
        out[i:j] = mix((sums[ends[i:j] - a] - sums[s]) * down[s])
        i = j
    return out


def word_hash(word: str) -> int:
    """Hash of one lower-case word, as in hash_words."""
    b = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(hash_words(b, np.array([0]), np.array([len(b)]))[0])


def split_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Words of the documents data[offsets[d]:offsets[d + 1]]."""
    data = LOWER[data]
    w = is_word[data]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before, after = np.zeros(len(w), dtype=bool), np.zeros(len(w), dtype=bool)
    before[1:] = w[:-1]
    after[:-1] = w[1:]
    before[inner] = False
    after[inner - 1] = False
    starts, ends = np.flatnonzero(w & ~before), np.flatnonzero(w & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets), hash_words(data, starts, ends))


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def word_chunks(column: pa.Array, is_word: np.ndarray) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) over the column, in chunks of bounded bytes (a longer text alone)."""
    if not len(column):
        return
    data, offsets = string_parts(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1)
        j = min(j, n)
        yield i, j, split_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], is_word)
        i = j
    give_back()


def give_back() -> None:
    """Return freed memory to the system, since workers are kept between stages."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


_PLACE = np.array([pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(16)], dtype=np.uint64)


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of equally long columns of hashes, in which order counts."""
    acc = np.zeros_like(parts[0])
    for k, p in enumerate(parts):
        acc = acc + p * _PLACE[k]
    return mix(acc)


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a document's word shingles; fewer words make one shingle, none makes none."""
    if len(hashes) == 0:
        return hashes
    if len(hashes) < width:
        return combine([hashes[k : k + 1] for k in range(len(hashes))])
    m = len(hashes) - width + 1
    return np.unique(combine([hashes[k : k + m] for k in range(width)]))
