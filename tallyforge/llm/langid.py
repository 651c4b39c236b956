"""Language identification by a linear-chain conditional random field over words.

A word's features are its affixes, character n-grams and itself (the lexicon), hashed into one table of weights for each
language. Transitions between the languages of neighbouring words are learned too, on blocks of which some are spliced from
two languages as code-switched text is. Forward-backward over blocks of words gives each word's marginals; their mean over
the words with letters is the document's score of a language. Fitted on a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sample import bucket, sampled
from .text import LOWER, SPACE, hashes, mix, slices, words
from .workers import tidy

#: Labelled documents of a language that are fitted on, about; with many languages fewer, so that all have DOCS, but LEAST each.
DOCS_A_LANGUAGE, DOCS, LEAST = 300, 19_200, 20
#: Bytes of their texts in all, about.
BYTES = 100_000_000
#: Bits of each hashed family of features, and the most languages that have as many (beyond, fewer bits bound the memory);
#: words in a block.
BITS, WIDE, BLOCK = 16, 64, 32
PASSES, RATE, SPLICED = 3, 0.3, 0.2
#: Scores of bytes held at a time, about.
SCORES = 1_500_000
FAMILIES = 6  # bigrams, trigrams, words, prefixes, suffixes of 3, suffixes of 4

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Words:
    """Words of a slice and their features: byte n-grams by position, and word features by word."""

    def __init__(self, data: np.ndarray, at: np.ndarray, bits: int = BITS) -> None:
        self.bits = bits
        self.starts, self.ends, self.doc = words(data, at)
        n = len(self.starts)
        low = LOWER[data].astype(np.int64)
        lengths = self.ends - self.starts
        # every word with a mark before and behind it
        first = np.zeros(n, np.int64)
        np.cumsum(lengths[:-1] + 2, out=first[1:])
        self.first = first
        size = int(first[-1] + lengths[-1] + 2) if n else 0
        out = np.zeros(size, np.int64)
        inside = np.ones(size, bool)
        inside[first] = inside[first + lengths + 1] = False
        out[inside] = low[~SPACE[data]]
        two = out[:-1] << 8 | out[1:]
        self.two = np.append(two, 0)
        self.three = np.append(((self.two[:-2] << 8 | out[2:]) * 40503 & 0xFFFFFF) >> (24 - bits), (0, 0)) if size else two
        if bits < BITS:
            self.two = (self.two * 40503 & 0xFFFF) >> (16 - bits)
        ends = first + lengths + 1
        self.edge = np.concatenate([ends, ends - 1])  # n-grams from here on belong to no word
        whole = hashes(data, self.starts, self.ends)
        near = hashes(data, self.starts, np.minimum(self.starts + 3, self.ends))
        last3, last4 = (hashes(data, np.maximum(self.ends - k, self.starts), self.ends) for k in (3, 4))
        self.by_word = [(mix(h, 30 + i) >> np.uint64(64 - bits)).astype(np.int64) for i, h in enumerate((whole, near, last3, last4))]
        ink = np.zeros(len(data) + 1, np.int64)
        np.cumsum(LETTER[data], out=ink[1:])
        self.letters = ink[self.ends] > ink[self.starts]

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        """(words, languages) scores. weights: (families, 2**bits, languages)."""
        if not len(self.starts):
            return np.zeros((0, weights.shape[2]), np.float32)
        total = weights[0][self.two]
        total[self.edge[: len(self.starts)]] = 0
        three = weights[1][self.three]
        three[self.edge] = 0
        total += three
        out = np.add.reduceat(total, self.first, axis=0)
        for i, h in enumerate(self.by_word):
            out += weights[2 + i][h]
        return out

    def slope(self, off: np.ndarray, k: int) -> np.ndarray:
        """The gradient of the weights for off, d loss / d emission."""
        out = np.zeros((FAMILIES, 1 << self.bits, k), np.float32)
        sizes = np.diff(np.append(self.first, len(self.two)))
        for j in range(k):
            spread = np.repeat(off[:, j], sizes)
            spread[self.edge[: len(self.starts)]] = 0
            out[0, :, j] = np.bincount(self.two, spread, 1 << self.bits)
            spread[self.edge] = 0
            out[1, :, j] = np.bincount(self.three, spread, 1 << self.bits)
            for i, h in enumerate(self.by_word):
                out[2 + i, :, j] = np.bincount(h, off[:, j], 1 << self.bits)
        return out


def bits_for(k: int) -> int:
    """Bits of a family for k languages: all of BITS up to WIDE languages, then fewer."""
    return BITS - max(0, min(8, (-(-k // WIDE) - 1).bit_length()))


def in_blocks(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Block and place of each word, and the number of blocks; a block has words of one document only."""
    n = len(doc)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    new = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    own = np.arange(n) - np.repeat(new, np.diff(np.append(new, n)))
    opens = own % BLOCK == 0
    return np.cumsum(opens) - 1, own % BLOCK, int(opens.sum())


def forward_backward(scores: np.ndarray, mask: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (blocks, places, k) and expected transitions (k, k) of blocks of scores; mask: places with a word."""
    n, t, k = scores.shape
    p = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(moves - moves.max())
    ahead, back = np.empty_like(p), np.ones_like(p)
    now = p[:, 0] / p[:, 0].sum(axis=1, keepdims=True)
    ahead[:, 0] = now
    for i in range(1, t):
        now = (now @ step) * p[:, i]
        now /= now.sum(axis=1, keepdims=True)
        ahead[:, i] = now
    pair = np.zeros((k, k))
    for i in range(t - 2, -1, -1):
        after = p[:, i + 1] * back[:, i + 1]
        b = after @ step.T
        b /= b.sum(axis=1, keepdims=True)
        live = mask[:, i + 1]
        back[:, i] = np.where(live[:, None], b, 1.0)
        joint = ahead[:, i][live].T @ (after[live] / np.maximum(1e-30, np.einsum("ni,ij,nj->n", ahead[:, i][live], step, after[live]))[:, None])
        pair += joint * step
    both = ahead * back
    both /= both.sum(axis=2, keepdims=True)
    return both, pair


def marginals(found: Words, weights: np.ndarray, moves: np.ndarray) -> np.ndarray:
    block, place, n = in_blocks(found.doc)
    k = len(moves)
    if not n:
        return np.zeros((0, k), np.float32)
    scores, mask = np.zeros((n, BLOCK, k), np.float32), np.zeros((n, BLOCK), bool)
    scores[block, place] = found.emissions(weights)
    mask[block, place] = True
    return _marginals_only(scores, mask, moves.astype(np.float32))[block, place]


def _marginals_only(scores: np.ndarray, mask: np.ndarray, moves: np.ndarray) -> np.ndarray:
    p = np.ascontiguousarray(np.exp(scores - scores.max(axis=2, keepdims=True)).transpose(1, 0, 2))
    step = np.exp(moves - moves.max())
    t = len(p)
    ahead = np.empty_like(p)
    now = ahead[0] = p[0]
    for i in range(1, t):
        now = (now @ step) * p[i]
        now /= now.sum(axis=1, keepdims=True)
        ahead[i] = now
    back = np.ones_like(p[0])
    for i in range(t - 2, -1, -1):
        b = (p[i + 1] * back) @ step.T
        b /= b.sum(axis=1, keepdims=True)
        back = np.where(mask[:, i + 1, None], b, np.float32(1))
        ahead[i] *= back
    ahead /= ahead.sum(axis=2, keepdims=True)
    return ahead.transpose(1, 0, 2)


def fit(texts: list[str], labels: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (families, 2**bits, k) and transitions (k, k) by AdaGrad on the conditional likelihood."""
    rng = np.random.default_rng(5)
    column = pa.array([texts[i] for i in rng.permutation(len(texts))])
    gold = np.array([labels[i] for i in np.random.default_rng(5).permutation(len(texts))])
    bits = bits_for(k)
    weights, moves = np.zeros((FAMILIES, 1 << bits, k), np.float32), np.zeros((k, k))
    square, square_moves = np.full_like(weights, 1e-6), np.full((k, k), 1e-6)
    for _ in range(PASSES):
        for low in range(0, len(column), 64):
            for part in slices(column.slice(low, 64)):
                found = Words(part.data, part.at, bits)
                if not len(found.doc):
                    continue
                block, place, n = in_blocks(found.doc)
                y_block = gold[low + part.first + found.doc]
                # spliced blocks: the second half of some blocks changes places with that of others
                other = np.arange(n)
                chosen = np.flatnonzero(rng.random(n) < SPLICED)
                other[chosen] = rng.permutation(chosen)
                to = np.where(place >= BLOCK // 2, other[block], block)
                scores, mask, y = np.zeros((n, BLOCK, k)), np.zeros((n, BLOCK), bool), np.full((n, BLOCK), -1)
                scores[to, place] = found.emissions(weights)
                mask[to, place], y[to, place] = True, y_block
                # a spliced half may follow a short block: its first half then has gaps, which are scored as unknown words
                full = np.maximum.accumulate(mask[:, ::-1], axis=1)[:, ::-1]
                both, pair = forward_backward(scores, full, moves)
                off = both[to, place].astype(np.float32)
                off[np.arange(len(off)), y_block] -= 1
                known = mask[:, 1:] & mask[:, :-1]
                seen = np.zeros((k, k))
                np.add.at(seen, (y[:, :-1][known], y[:, 1:][known]), 1)
                slope = found.slope(off / len(off), k) + 1e-7 * weights
                square += slope**2
                weights -= RATE * slope / np.sqrt(square)
                turn = (pair * (seen.sum() / max(1e-9, pair.sum())) - seen) / max(1.0, seen.sum())
                square_moves += turn**2
                moves -= RATE * turn / np.sqrt(square_moves)
    return weights, moves


def told(column: pa.Array, weights: np.ndarray, moves: np.ndarray, names: list[str]) -> tuple[list[str], list[float], list[int]]:
    """Language, score and switches of each text of a column."""
    best, score, turns = ["und"] * len(column), [0.0] * len(column), [0] * len(column)
    for part in slices(column, max(20_000, SCORES // max(1, len(names)))):  # a score for each byte and language
        found = Words(part.data, part.at, bits_for(len(names)))
        n = part.last - part.first
        both = marginals(found, weights, moves) if names else np.zeros((len(found.doc), 1))
        ink = found.letters
        doc = found.doc[ink]
        count = np.bincount(doc, minlength=n)
        mean = np.stack([np.bincount(doc, both[ink, j], n) for j in range(both.shape[1])], 1) / np.maximum(1, count)[:, None]
        top = both[ink].argmax(axis=1) if len(doc) else np.zeros(0, int)
        change = np.bincount(doc[1:][(top[1:] != top[:-1]) & (doc[1:] == doc[:-1])], minlength=n) if len(doc) else count
        plain = np.concatenate([[0], np.cumsum(LETTER[part.data] & (part.data < 128))])
        for i in np.flatnonzero(count) if names else ():
            a, b = part.at[i], part.at[i + 1]
            if plain[b] == plain[a] and not any(c.isalpha() for c in bytes(part.data[a:b]).decode()):
                continue
            j = int(mean[i].argmax())
            at = part.first + int(i)
            best[at], score[at], turns[at] = names[j], min(1.0, float(mean[i, j])), int(change[i])
    return best, score, turns


def learned(docs: DataFrame, holdout: int):
    """Languages by name and the broadcast model: a fixed number of weights for each."""
    known = docs.where((bucket("doc_id", holdout) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    names = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    most = max(LEAST, min(DOCS_A_LANGUAGE, DOCS // max(1, len(names))))
    rows = sampled(known, "lang", "doc_id", most, BYTES // max(1, len(names))).select("doc_id", "lang", "text").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    place = {name: i for i, name in enumerate(names)}
    weights, moves = fit([r["text"] for r in rows], [place[r["lang"]] for r in rows], len(names)) if names else (np.zeros((FAMILIES, 1 << BITS, 1), np.float32), np.zeros((1, 1)))
    return names, docs.sparkSession.sparkContext.broadcast((weights, moves))


def identified(docs: DataFrame, holdout: int = 5) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, lang_pred, score, n_switches (changes of language between words).

    Fitted on rows with a text and a lang whose crc32(doc_id) mod `holdout` isn't 0. A null text or one without letters is
    `und` with score 0; so is every text if nothing could be learned. Repeated rows each get a row; ties go to the language
    that is first by name.
    """
    names, model = learned(docs, holdout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score, turns = told(batch.column(2), *model.value, names)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best), pa.array(score), pa.array(turns, pa.int64())], ["doc_id", "held_out", "lang_pred", "score", "n_switches"])

    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (bucket("doc_id", holdout) == 0).alias("held_out"), "text")
    return bare.mapInArrow(tidy(run), "doc_id long, held_out boolean, lang_pred string, score double, n_switches long")


def known_language(docs: DataFrame, least: float = 0.35, holdout: int = 5) -> DataFrame:
    """docs whose language is told with a score of `least` or more; the rows pass by as they are, without a join."""
    names, model = learned(docs, holdout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                some = batch.slice(low, 1000)
                best, score, _ = told(some.column("text"), *model.value, names)
                yield some.filter(pa.array([b != "und" and s >= least for b, s in zip(best, score, strict=True)]))

    return docs.mapInArrow(tidy(run), docs.schema)
