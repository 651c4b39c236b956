"""Words and word hashes of whole Arrow text columns, with numpy on the UTF-8 buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; A-Z are lower-cased. Null texts count as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at a time; a longer document is taken alone.
SLICE_BYTES = 1_000_000
#: Bytes of a span from which on it is hashed by itself.
LONG = 128

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_CODE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """The splitmix64 finaliser."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES), base, dtype=np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


@dataclass
class Slice:
    """Some documents of a batch: rows first to last, their bytes, and where each starts (one more entry than rows)."""

    first: int
    last: int
    data: np.ndarray
    at: np.ndarray


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The documents of a text column, in runs of about `size` bytes."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        at = offsets[first : last + 1]
        yield Slice(first, last, whole[at[0] : at[-1]], at - at[0])
        first = last


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and its document's index in the slice."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    ink = ~SPACE[data]
    start, end = ink.copy(), ink.copy()
    start[1:] &= ~ink[:-1]
    end[:-1] &= ~ink[1:]
    cuts = at[(at > 0) & (at < len(data))]
    start[cuts] = ink[cuts]
    end[cuts - 1] = ink[cuts - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of the lower-cased bytes: a polynomial over random codes, from prefix sums.

    Modulo a power of two, a polynomial takes some patterns of a thousand letters for each other; spans of LONG bytes and
    more have a cryptographic hash instead."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_CODE[LOWER[data]] * _power(_BASE, n), out=sums[1:])
        out = mix((sums[ends] - sums[starts]) * _power(_INVERSE, n + 1)[starts])
    for i in np.flatnonzero(ends - starts >= LONG):
        out[i] = int.from_bytes(hashlib.blake2b(LOWER[data[starts[i] : ends[i]]].tobytes(), digest_size=8).digest(), "little")
    return out


def shingles(word: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of k words and their documents, by document; a document of fewer words is one shingle."""
    n = len(word)
    with np.errstate(over="ignore"):
        factor = [np.uint64((0xD6E8FEB86659FD93 * (2 * i + 1)) & (1 << 64) - 1) for i in range(k)]
        full = max(0, n - k + 1)
        total = np.zeros(full, dtype=np.uint64)
        for i in range(k):
            total += word[i : full + i] * factor[i]
        keep = doc[:full] == doc[k - 1 :] if full else np.zeros(0, bool)
        out, of = mix(total[keep], 1), doc[:full][keep]
        count = np.bincount(doc, minlength=int(doc[-1]) + 1 if n else 0)
        short = np.flatnonzero((count > 0) & (count < k))
        if len(short):
            first = np.searchsorted(doc, short)
            own = np.zeros(len(short), dtype=np.uint64)
            for i in range(k - 1):
                has = count[short] > i
                own[has] += word[first[has] + i] * factor[i]
            out, of = np.concatenate([out, mix(own, 2)]), np.concatenate([of, short])
            order = np.argsort(of, kind="stable")
            out, of = out[order], of[order]
    return out, of


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of each document of a column."""
    for part in slices(column):
        starts, ends, doc = words(part.data, part.at)
        values, of = shingles(hashes(part.data, starts, ends), doc, k)
        edges = np.searchsorted(of, np.arange(part.last - part.first + 1))
        for i in range(part.last - part.first):
            yield part.first + i, np.unique(values[edges[i] : edges[i + 1]])
