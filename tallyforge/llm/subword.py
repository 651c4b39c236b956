"""Subword ids of whole texts by a public tokenizer file, word by word, with numpy and a bounded cache in each worker.

The tokenizer must treat white space as a separator that no token spans (as `word_bpe_49k.json` does): then the ids of a
text are those of its words in turn. Words end at ASCII white space; the tokenizer itself sees to any other. Words of Latin
letters, with a few marks behind them, are merged here, many at a time; all others go through the tokenizer. Words are known
by a hash of their bytes, A-Z in lower case, and are not told apart otherwise.
"""

from __future__ import annotations

import hashlib
import json
import os
from array import array

import numpy as np
import pyarrow as pa

from .text import LOWER, hashes, slices, words

#: Words that a worker keeps at most; beyond, its cache is emptied, which costs time only. About 40 bytes each.
KEPT = 600_000
#: Words on which the short way to a word's ids is tried before it is used.
PROBES = ["É", "Über", "a", "the", "word.", "heitung", "straße", "été,", "año", "naïve", "Ñandú!", "ÿ", "ofthstthor", "x" * 31, "a***", "is'", "été?!", "b..."]
VOCABULARY = "word_bpe_49k.json"
#: Marks of ASCII, and how many of them behind a word's letters are set apart here.
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
MOST_MARKS = 4
#: Bytes of the longest word that is merged here, and widths of the batches.
WIDTHS = [6, 10, 14, 20, 32]
_NONE = np.int32(1 << 30)

#: Byte-level vocabularies write a byte that doesn't print as the next letter from 256 on.
_BYTE_LETTERS = {b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
for _byte in range(256):
    if _byte not in _BYTE_LETTERS:
        _BYTE_LETTERS[_byte] = chr(256 + _byte - sum(b < _byte for b in [*range(33, 127), *range(161, 173), *range(174, 256)]))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Table:
    """Open addressing: non-negative values by 64-bit keys, for whole arrays; a key of 0 is kept as 1."""

    def __init__(self, bits: int) -> None:
        self.keys, self.values, self.count = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32), 0

    def _at(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - len(self.keys).bit_length())).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        keys = np.maximum(keys, np.uint64(1))
        at = self._at(keys)
        own = self.keys[at]
        out = np.where(own == keys, self.values[at], np.int32(-1))
        rest = np.flatnonzero((own != keys) & (own != 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & (len(self.keys) - 1)
            own = self.keys[at[rest]]
            hit = own == keys[rest]
            out[rest[hit]] = self.values[at[rest[hit]]]
            rest = rest[~hit & (own != 0)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """New keys, none twice."""
        if 2 * (self.count + len(keys)) > len(self.keys):
            old = self.keys > 0
            held = self.keys[old], self.values[old]
            self.__init__(int(2 * (self.count + len(keys))).bit_length() + 1)
            self.put(*held)
        self.count += len(keys)
        keys = np.maximum(keys, np.uint64(1))
        at = self._at(keys)
        while len(keys):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[free]
            won = free & (self.keys[at] == keys)
            self.values[at[won]] = values[won]
            keys, values, at = keys[~won], values[~won], (at[~won] + 1) & (len(self.keys) - 1)


class Merges:
    """Byte-pair merging of many words at a time: the pair of least rank first, the leftmost of equal ones."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str) -> None:
        self.size = max(vocab.values()) + 1
        self.first, self.last = (np.array([vocab[_BYTE_LETTERS[b] + end] for b in range(256)], np.int32) for end in ("", suffix))
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        keys = np.array([vocab[a] * self.size + vocab[b] + 1 for a, b in pairs], np.uint64)
        _, own = np.unique(keys, return_index=True)
        self.ranks = Table(18)
        self.ranks.put(keys[own], own.astype(np.int32))
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = self.ranks.find((a.astype(np.int64) * self.size + b + 1).view(np.uint64).ravel()).reshape(a.shape)
        return np.where(found < 0, _NONE, found)

    def ids(self, letters: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """letters: bytes (width, words), length: bytes of each word -> ids (width, words) and their number."""
        width, n = letters.shape
        place, which = np.arange(width)[:, None], np.arange(n)
        now = self.first[letters]
        now[length - 1, which] = self.last[letters[length - 1, which]]
        rank = np.full((width, n), _NONE)
        if width > 1:
            rank[:-1] = np.where(place[:-1] < length - 1, self.rank(now[:-1], now[1:]), _NONE)
        out, count = now.copy(), length.astype(np.int64)
        while len(which):
            best = rank.argmin(axis=0)
            low = rank[best, np.arange(len(which))]
            live = low < _NONE
            if not live.all():
                out[: len(now), which[~live]] = now[:, ~live]
                now, rank, which, best, low = now[:, live], rank[:, live], which[live], best[live], low[live]
                if not len(which):
                    break
            k, after = np.arange(len(which)), place[: len(now) - 1] > best
            now, rank = np.where(after, now[1:], now[:-1]), np.where(after, rank[1:], rank[:-1])
            now[best, k] = self.merged[low]
            count[which] -= 1
            left, right = np.flatnonzero(best > 0), np.flatnonzero(best < count[which] - 1)
            rank[best, k] = _NONE
            rank[best[right], right] = self.rank(now[best[right], right], now[best[right] + 1, right])
            rank[best[left] - 1, left] = self.rank(now[best[left] - 1, left], now[best[left], left])
        return out, count


class Subwords:
    """Encoder of a vocabulary file; ids are little-endian unsigned 16-bit, or 32-bit where the vocabulary needs them."""

    _by_path: dict[str, Subwords] = {}

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.kept = KEPT
        self.merges: Merges | None = None
        self.marks: dict[int, list[int]] = {}
        model = json.loads(self.tokenizer.to_str())["model"]
        try:
            self.merges = Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        except (KeyError, ValueError):  # not a byte-level vocabulary of merges
            self.merges = None
        self.forget()
        if self.merges:
            short = self.encode(pa.array(PROBES))
            full = [self.tokenizer.encode(p, add_special_tokens=False).ids for p in PROBES]
            if [x.tolist() for x in np.split(*_cuts(short))] != full:
                self.merges = None
            self.forget()

    @classmethod
    def of(cls, path: str) -> Subwords:
        """The worker's encoder of this file."""
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def forget(self) -> None:
        """Empty the cache, for the memory of what comes next."""
        self.slots, self.used, self.held = Table(12), 0, 0
        self.first, self.many, self.pool = np.zeros(4096, np.int64), np.zeros(4096, np.int32), np.zeros(16_384, self.dtype)

    @classmethod
    def forget_all(cls) -> None:
        """Empty the caches of all of the worker's encoders."""
        for coder in cls._by_path.values():
            coder.forget()

    def _marks(self, mark: int) -> list[int]:
        if mark not in self.marks:
            text = mark.to_bytes(8, "little").rstrip(b"\0").decode()
            self.marks[mark] = self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.marks[mark]

    def _full(self, some: list[bytes]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in some], add_special_tokens=False)]

    def _keep(self, keys: np.ndarray, many: np.ndarray, ids: np.ndarray) -> None:
        """Words by their hashes, the number of their ids, and these in turn."""
        self.slots.put(keys, np.arange(self.held, self.held + len(keys), dtype=np.int32))
        if self.held + len(keys) > len(self.first):
            more = 2 * (self.held + len(keys))
            self.first, self.many = (np.concatenate([x[: self.held], np.zeros(more - self.held, x.dtype)]) for x in (self.first, self.many))
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(self.used + 2 * len(ids), self.dtype)])
        own = slice(self.held, self.held + len(keys))
        self.first[own], self.many[own] = self.used + np.cumsum(many) - many, many
        self.pool[self.used : self.used + len(ids)] = ids
        self.held, self.used = self.held + len(keys), self.used + len(ids)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> None:
        length = ends - starts
        slow = np.ones(len(keys), bool)
        for least, width in zip([0, *WIDTHS[:-1]], WIDTHS if self.merges else [], strict=False):
            which = np.flatnonzero((length > least) & (length <= width))
            if not len(which):
                continue
            n, place = length[which], np.arange(width)[:, None]
            inside = place < n
            letters = np.where(inside, LOWER[data[np.minimum(starts[which] + place, len(data) - 1)]], 0)
            # marks behind the letters are a token's text of their own
            stem = ((inside & ~_MARK[letters]) * (place + 1)).max(axis=0)
            tail = np.zeros(len(n), np.int64)
            for i in range(MOST_MARKS):
                at = stem + i
                tail += np.where(at < n, letters[np.minimum(at, width - 1), np.arange(len(n))].astype(np.int64) << 8 * i, 0)
            n = np.where((stem > 0) & (n - stem <= MOST_MARKS), stem, n)
            tail = np.where(n < length[which], tail, 0)
            letters = np.where(place < n, letters, 0)
            # a-z, or a letter of the Latin-1 supplement: 0xC3 and a byte of 0x80 to 0xBF but for two signs
            lead = letters == 0xC3
            behind = np.vstack([np.zeros((1, len(n)), bool), lead[:-1]])
            ahead = np.vstack([letters[1:], np.zeros((1, len(n)), letters.dtype)])
            second = (letters >= 0x80) & (letters <= 0xBF) & (letters != 0x97) & (letters != 0xB7)
            good = (place >= n) | (letters >= 97) & (letters <= 122) | lead & (ahead >= 0x80) & (ahead <= 0xBF) | behind & second
            fine = good.all(axis=0)
            which, n, tail, letters, behind = which[fine], n[fine], tail[fine], letters[:, fine], behind[:, fine]
            if not len(which):
                continue
            letters = np.where(behind & (letters < 0x9F), letters + 0x20, letters).astype(np.uint8)
            ids, count = self.merges.ids(letters, n)
            ids = np.vstack([ids, np.zeros((2 * MOST_MARKS, len(n)), ids.dtype)])
            for mark in np.unique(tail[tail > 0]):
                last = np.flatnonzero(tail == mark)
                for one in self._marks(int(mark)):
                    ids[count[last], last] = one
                    count[last] += 1
            slow[which] = False
            self._keep(keys[which], count, ids.T[(np.arange(len(ids))[:, None] < count).T])
        rest = np.flatnonzero(slow)
        for low in range(0, len(rest), 50_000):
            some = rest[low : low + 50_000]
            ids = self._full([data[starts[i] : ends[i]].tobytes() for i in some])
            self._keep(keys[some], np.array([len(x) // self.dtype.itemsize for x in ids], np.int64), np.frombuffer(b"".join(ids), self.dtype))

    def encode(self, column: pa.Array, end: int | None = None, keys: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column in turn, each with `end` behind it if given, and where each text's begin (one more
        entry than texts). Nulls count as empty. keys, if given, gets (words' hashes, their rows) of each slice."""
        out, sizes = [], [np.zeros(0, np.int64)]
        for piece in slices(column):
            if self.held > self.kept:
                self.forget()
            starts, ends, doc = words(piece.data, piece.at)
            h = hashes(piece.data, starts, ends)
            if keys is not None:
                keys.append((h, piece.first + doc))
            odd = np.flatnonzero((piece.data[:-1] == 60) & (piece.data[1:] == 124))  # special tokens are told by case
            if len(odd):
                odd = np.unique(np.searchsorted(starts, odd, "right") - 1)
                h = h.copy()
                h[odd] = [int.from_bytes(hashlib.blake2b(piece.data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little") for i in odd]
            slot = self.slots.find(h)
            miss = np.flatnonzero(slot < 0)
            if len(miss):
                new, first = np.unique(h[miss], return_index=True)
                at = miss[first]
                self._learn(piece.data, starts[at], ends[at], new)
                slot[miss] = self.slots.find(h[miss])
            many = self.many[slot].astype(np.int64)
            n = piece.last - piece.first
            size = np.bincount(doc, many, n).astype(np.int64)
            # an end takes the place behind its text
            before = np.cumsum(many) - many
            whole = np.empty(int(many.sum()) + n * (end is not None), self.dtype)
            at = np.arange(int(many.sum()))
            ids = self.pool[np.repeat(self.first[slot] - before, many) + at]
            if end is None:
                whole = ids
            else:
                whole[at + np.repeat(np.arange(n), size)] = ids
                size += 1
                whole[np.cumsum(size) - 1] = end
            out.append(whole)
            sizes.append(size)
        edges = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)
        return (np.concatenate(out) if out else np.zeros(0, self.dtype)), edges


def _cuts(found: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return found[0], found[1][1:-1]


def as_binary(ids: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Arrow binary values, one for each text, of ids as Subwords.encode gives them."""
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer((edges * ids.dtype.itemsize).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(ids))]).cast(pa.binary())


def from_binary(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The opposite of as_binary."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, dtype), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat.view(dtype) if at[0] % np.dtype(dtype).itemsize == 0 else np.frombuffer(flat.tobytes(), dtype), (at - at[0]) // np.dtype(dtype).itemsize
