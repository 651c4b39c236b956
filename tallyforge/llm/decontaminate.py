"""Benchmark decontamination by CGK embeddings and bit-sampling LSH over item-sized windows of documents.

Symbols are words without case, marks or white space; letters of scripts that don't space words are symbols each. A document is
contaminated by an item of L words if some passage of it is within edit distance L // 5 of the whole item, counted in words.
Items of fewer than five words, where no edit is allowed, are looked up by a hash of their words. Longer ones are grouped by
length; a window has the length of its group's shortest item and starts at any word.

1. Each edit touches two pairs of neighbouring words at most, so a window within reach of an item has all but twice that many
   of its pairs from the benchmark. Running sums leave out the windows that don't, at no risk.
2. The CGK random walk maps a window and an item's head to strings of three times the length, copying a symbol at each step
   and going on to the next one by a random bit of the symbol: strings near in edit distance get near in Hamming distance.
   Keys of a few sampled positions, over several walks and samples of each, are looked up among the items' keys.
3. Window and item that share a key are verified by exact edit distance.

The benchmark is a query set against all documents: it is sent in blocks of bounded size, one pass for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import SPACE, hashes, mix, slices, words
from .workers import tidy

#: Edits allowed: one in so many words of the item. Items of fewer words than LEAST are looked up exactly.
ONE_IN, LEAST = 5, 5
#: Walks, samples of each, positions of a sample. With a fifth of the words edited a key agrees about one time in three.
WALKS, SAMPLES, POSITIONS = 5, 8, 4
#: Lengths of a group span at most this ratio. Items in a block, and windows embedded at a time.
RATIO, ITEMS_A_BLOCK, BYTES_A_BLOCK, WINDOWS = 1.2, 20_000, 32_000_000, 50_000

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_INK = np.zeros(256, bool)
_INK[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def symbols(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of each word of a slice: lower case, ASCII letters, digits and other bytes from 128 on only."""
    plain = _PLAIN[data]
    keep = _INK[plain] | SPACE[data]
    moved = np.concatenate([[0], np.cumsum(keep)])
    plain, at = plain[keep], moved[at]
    # kana and Chinese (three bytes from 0xE3 to 0xE9), Thai and its neighbours (0xE0, 0xB8 to 0xBE): letters apart
    second = np.append(plain[1:], np.uint8(0))
    apart = np.flatnonzero((plain >= 0xE3) & (plain <= 0xE9) | (plain == 0xE0) & (second >= 0xB8) & (second <= 0xBE))
    if len(apart):
        gaps = np.sort(np.concatenate([apart, apart + 3]))
        plain, at = np.insert(plain, gaps, 32), at + np.searchsorted(gaps, at)
    starts, ends, doc = words(plain, at)
    return hashes(plain, starts, ends), doc


def runs_of(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of n words of one document, and where it starts."""
    starts = np.arange(max(0, len(h) - n + 1))
    starts = starts[doc[starts] == doc[starts + n - 1]]
    out = np.full(len(starts), n, np.uint64)
    for i in range(n):
        out = mix(out ^ h[starts + i], 700 + i)
    return out, starts


def pairs_of(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hash of each word and the next one; the last word of a document has 0."""
    out = np.zeros(len(h), np.uint64)
    with np.errstate(over="ignore"):
        out[:-1] = mix(h[:-1] * np.uint64(3) ^ h[1:], 5)
    out[:-1][doc[1:] != doc[:-1]] = 0
    return out


class Members:
    """A set of hashes; a table of bits answers most lookups."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = np.unique(values)
        self.bits = np.uint64((1 << max(16, min(24, 6 + int(len(self.values)).bit_length()))) - 1)
        self.table = np.zeros(int(self.bits) + 1, bool)
        self.table[(self.values & self.bits).astype(np.int64)] = True

    def has(self, h: np.ndarray) -> np.ndarray:
        out = self.table[(h & self.bits).view(np.int64)]
        hit = np.flatnonzero(out)
        if len(hit):
            out[hit] = self.values[np.minimum(np.searchsorted(self.values, h[hit]), len(self.values) - 1)] == h[hit]
        return out


def edits(length: np.ndarray | int):
    return length // ONE_IN


class Walks:
    """Keys of strings of n symbols, from rows of a symbol array."""

    def __init__(self, n: int) -> None:
        self.n, rng = n, np.random.default_rng(1000 + n)
        self.samples = [[np.sort(rng.choice(2 * n, min(POSITIONS, 2 * n), replace=False)) for _ in range(SAMPLES)] for _ in range(WALKS)]

    def keys(self, flat: np.ndarray, start: np.ndarray) -> Iterator[np.ndarray]:
        """One array of keys for each walk and sample, of the strings flat[start : start + n]."""
        end = start + self.n
        for w, samples in enumerate(self.samples):
            total = [np.zeros(len(start), np.uint64) for _ in samples]
            at = start.copy()
            wanted = {int(p) for s in samples for p in s}
            with np.errstate(over="ignore"):
                for step in range(max(wanted) + 1):
                    now = np.where(at < end, flat[np.minimum(at, len(flat) - 1)], np.uint64(0))
                    code = mix(now, 1 + w * 4096 + step)
                    if step in wanted:
                        for i, s in enumerate(samples):
                            if step in s:
                                total[i] = mix(total[i] ^ now, step)
                    at = at + (code & np.uint64(1)).astype(np.int64)
            yield from (mix(t, 9000 + w * SAMPLES + i) for i, t in enumerate(total))


def distances(items: np.ndarray, lengths: np.ndarray, texts: np.ndarray, spare: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of each item (rows, padded) to a prefix of its text (rows, padded), and that prefix's length.

    spare: words of each text. Distances over `most` may be too large."""
    n, width = texts.shape
    j = np.arange(width + 1)
    row = np.broadcast_to(j, (n, width + 1)).astype(np.int32).copy()
    best, at = np.full(n, 1 << 20, np.int32), np.zeros(n, np.int32)
    big = np.int32(1 << 20)
    for i in range(1, items.shape[1] + 1):
        low, high = max(1, i - most), min(width, i + most)
        new = np.full_like(row, big)
        if i <= most:
            new[:, 0] = i
        same = texts[:, low - 1 : high] == items[:, i - 1 : i]
        new[:, low : high + 1] = np.minimum(row[:, low - 1 : high] + ~same, row[:, low : high + 1] + 1)
        for c in range(low, high + 1):
            np.minimum(new[:, c], new[:, c - 1] + 1, out=new[:, c])
        row = new
        done = np.flatnonzero(lengths == i)
        if len(done):
            ends = np.where(j[None, :] <= spare[done][:, None], row[done], big)
            at[done] = ends.argmin(axis=1)
            best[done] = ends[np.arange(len(done)), at[done]]
    return best, at


class Benchmark:
    """The items of one block: symbols, keys by group of length, and pairs of neighbouring words."""

    def __init__(self, ids: list[int], texts: list[str]) -> None:
        self.ids = np.array(ids, np.int64)
        own: list[np.ndarray] = []
        pairs = [np.zeros(0, np.uint64)]
        for part in slices(pa.array(texts, pa.string())):
            h, doc = symbols(part.data, part.at)
            edge = np.searchsorted(doc, np.arange(part.last - part.first + 1))
            pairs.append(pairs_of(h, doc))
            own += [h[edge[i] : edge[i + 1]] for i in range(part.last - part.first)]
        self.items = own
        pairs = np.concatenate(pairs)
        self.pairs = Members(pairs[pairs > 0])
        lengths = np.array([len(x) for x in own], np.int64)
        self.groups, self.short = [], []
        for n in range(1, LEAST):
            which = np.flatnonzero(lengths == n)
            if len(which):
                keys, _ = runs_of(np.concatenate([own[i] for i in which]), np.repeat(which, n), n)
                order = np.argsort(keys, kind="stable")
                self.short.append((n, keys[order], which[order]))
        rest = np.unique(lengths[lengths >= LEAST])
        while len(rest):
            n = int(rest[0])
            inside = rest[rest <= n * RATIO]
            rest = rest[len(inside) :]
            which = np.flatnonzero(np.isin(lengths, inside))
            walks, heads = Walks(n), np.concatenate([own[i][:n] for i in which])
            keys = np.stack(list(walks.keys(heads, np.arange(len(which)) * n)))
            key = keys.ravel()
            order = np.argsort(key, kind="stable")
            self.groups.append((n, int(edits(inside[-1])), walks, key[order], np.tile(which, len(keys))[order]))

    def found(self, h: np.ndarray, doc: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(document, item) to (distance, first word, words) of its best passage."""
        out: dict[tuple[int, int], tuple[int, int, int]] = {}
        if not len(h):
            return out
        for n, keys, which in self.short:
            run, starts = runs_of(h, doc, n)
            low, high = np.searchsorted(keys, run, "left"), np.searchsorted(keys, run, "right")
            for i in np.flatnonzero(high > low)[::-1]:
                out.update({(int(doc[starts[i]]), int(item)): (0, int(starts[i]), n) for item in which[low[i] : high[i]]})
        if not self.groups:
            return out
        sums = np.concatenate([[0], np.cumsum(self.pairs.has(pairs_of(h, doc)), dtype=np.int32)])
        first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        ends = np.repeat(np.append(first[1:], len(doc)), np.diff(np.append(first, len(doc))))
        for n, most, walks, key, which in self.groups:
            last = np.minimum(np.arange(len(h)) + n, ends) - 1
            starts = np.flatnonzero(sums[last] - sums[:-1] >= n - 1 - 2 * most)
            for low in range(0, len(starts), WINDOWS):
                self._group(h, doc, ends, starts[low : low + WINDOWS], n, most, walks, key, which, out)
        return out

    def _group(self, h, doc, ends, starts, n, most, walks, key, which, out) -> None:
        pairs = []
        # a window that its document's end cuts short is padded as a walk at its end is
        own = np.where(np.arange(n)[None, :] < (ends[starts] - starts)[:, None], h[np.minimum(starts[:, None] + np.arange(n), len(h) - 1)], np.uint64(0))
        for k in walks.keys(own.ravel(), np.arange(len(starts)) * n):
            a, b = np.searchsorted(key, k, "left"), np.searchsorted(key, k, "right")
            hit = np.flatnonzero(b > a)
            for i in hit[b[hit] - a[hit] == 1], hit[b[hit] - a[hit] > 1]:
                many = b[i] - a[i]
                at = np.repeat(i, many)
                place = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(a[i], many)
                pairs.append(at * np.int64(len(self.items)) + which[place])
        if not pairs:
            return
        pair = np.unique(np.concatenate(pairs))
        for low in range(0, len(pair), WINDOWS):
            at, item = np.divmod(pair[low : low + WINDOWS], len(self.items))
            start = starts[at]
            lengths = np.array([len(self.items[i]) for i in item])
            wide = int(lengths.max())
            items = np.zeros((len(item), wide), np.uint64)
            for row, i in enumerate(item):
                items[row, : lengths[row]] = self.items[i]
            width = wide + most
            spare = np.minimum(ends[start] - start, width)
            texts = np.where(np.arange(width)[None, :] < spare[:, None], h[np.minimum(start[:, None] + np.arange(width), len(h) - 1)], np.uint64(0))
            far, length = distances(items, lengths, texts, spare, most)
            for row in np.flatnonzero(far <= edits(lengths)):
                name, new = (int(doc[start[row]]), int(item[row])), (int(far[row]), int(start[row]), int(length[row]))
                out[name] = min(out.get(name, new), new)


def _matches(bench):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Benchmark = bench.value
        for batch in batches:
            rows, ids = [], batch.column(0).to_pylist()
            for part in slices(batch.column(1)):
                h, doc = symbols(part.data, part.at)
                begin = np.searchsorted(doc, np.arange(part.last - part.first))
                for (d, i), (far, start, length) in sorted(items.found(h, doc).items()):
                    rows.append((ids[part.first + d], int(items.ids[i]), start - int(begin[d]), length, len(items.items[i]), far))
            names = ["doc_id", "item_id", "start_word", "words", "item_words", "distance"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(6)], names)

    return tidy(run)


def _blocks(benchmark: DataFrame) -> Iterator:
    """The items in broadcast blocks of bounded numbers and bytes."""
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(n // ITEMS_A_BLOCK, size // BYTES_A_BLOCK) + 1
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Benchmark([r[0] for r in rows], [r[1] for r in rows]))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item that it has: doc_id, item_id, start_word, words, item_words, distance.

    Null and empty texts have nothing; null and empty items are not looked for. Equal items each get rows. Rows that repeat an
    id each get rows; ties of passages go to the first. Very long texts are searched whole. Extra columns are ignored; an empty
    table on either side gives no rows.
    """
    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for bench in _blocks(benchmark):
        found = bare.mapInArrow(_matches(bench), "doc_id long, item_id long, start_word long, words long, item_words long, distance long")
        out = found if out is None else out.unionByName(found)
    return out


def _without(bench, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                some = batch.slice(low, 1000)
                clean_rows = np.ones(some.num_rows, bool)
                for part in slices(some.column(column)):
                    clean_rows[[part.first + d for d, _ in bench.value.found(*symbols(part.data, part.at))]] = False
                yield some.filter(pa.array(clean_rows))

    return tidy(run)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that a benchmark item contaminates, each row judged by its own text; nothing is joined."""
    for bench in _blocks(benchmark):
        docs = docs.mapInArrow(_without(bench, docs.columns.index("text")), docs.schema)
    return docs
