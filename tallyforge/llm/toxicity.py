"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a document: densities of a lexicon's words and stems, how near second-person words they stand, rates of capitals,
punctuation and obfuscation, and length. The lexicon is learned on the labelled sample: words and stems that toxic documents
have and clean ones hardly ever. Words are compared in a plain form, without marks inside and with look-alike digits and
signs put back to letters. Fitted on a bounded sample of labelled documents; the trees are grown on a part of it and
calibrated on the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sample import SPAN, bucket, sampled
from .text import LOWER, SPACE, hashes, slices, words
from .workers import tidy

#: Labelled documents of each label that are fitted on, about.
DOCS_A_LABEL = 4_000
#: Bytes of their texts in all, about.
BYTES = 64_000_000
#: Trees, their depth, shrinkage, bins of a feature, and the share that calibrates.
TREES, DEPTH, SHRINK, BINS, CALIBRATE = 60, 3, 0.2, 32, 0.3
#: Look-alikes of letters.
ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
#: Words that address the reader.
SECOND_PERSON = ["you", "your", "yours", "youre", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "sie", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "ti", "tus", "usted", "ustedes", "vosotros", "vuestro"]
#: Insults, as a start of the lexicon.
INSULTS = ["idiot", "idiots", "moron", "morons", "stupid", "dumb", "scum", "trash", "worthless", "pathetic", "loser", "losers", "disgusting", "clown", "imbecile", "jerk", "bastard", "filth", "vermin", "dummkopf", "trottel", "abschaum", "connard", "abruti", "imbécile", "estúpido", "idiota", "basura", "payaso"]
STEMS = (4, 5, 0)  # first bytes of a word; 0: the whole word
NEAR = 4

_PLAIN = LOWER.copy()
for _a, _b in ALIKE.items():
    _PLAIN[ord(_a)] = ord(_b)
_WORD = np.zeros(256, bool)
_WORD[[*range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ODD = np.zeros(256, bool)
_ODD[[ord(c) for c in "0123456789@$*#"]] = True


def _hash(words_: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words_).encode(), np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]))
    return np.sort(hashes(data, starts, ends))


_YOU = _hash(SECOND_PERSON)


def _in(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


class Plain:
    """The words of a slice in plain form: hashes of stems and of whole words, and documents."""

    def __init__(self, data: np.ndarray, at: np.ndarray) -> None:
        plain = _PLAIN[data]
        keep = _WORD[plain] | SPACE[data]
        moved = np.concatenate([[0], np.cumsum(keep)])
        self.data, self.at = plain[keep], moved[at]
        self.starts, self.ends, self.doc = words(self.data, self.at)

    def stems(self, length: int) -> np.ndarray:
        ends = np.minimum(self.ends, self.starts + length) if length else self.ends
        return hashes(self.data, self.starts, ends)


def lexicon(texts: list[str], toxic: np.ndarray) -> list[np.ndarray]:
    """For each kind of stem, the sorted hashes of those that tell: in at least 3 places of toxic documents and one for 200 of
    them, and in at most a 50th as many, by document, of clean ones. Places after the same word count once, so copies don't
    add up. Whole words of INSULTS are always among them."""
    out = []
    column = pa.array(texts)
    for length in STEMS:
        found: list[np.ndarray] = []
        for part in slices(column):
            plain = Plain(part.data, part.at)
            h, before = plain.stems(length), np.zeros(len(plain.doc), np.uint64)
            before[1:] = np.where(plain.doc[1:] == plain.doc[:-1], plain.stems(0)[:-1], np.uint64(0))
            found.append(np.unique(np.stack([h, before, toxic[plain.doc + part.first].astype(np.uint64)], 1), axis=0))
        places = np.unique(np.concatenate(found), axis=0)
        names, inverse = np.unique(places[:, 0], return_inverse=True)
        yes, no = np.bincount(inverse, places[:, 2], len(names)), np.bincount(inverse, 1 - places[:, 2].astype(float), len(names))
        n_yes, n_no = max(1, toxic.sum()), max(1, (1 - toxic).sum())
        told = names[(yes >= 3) & (yes >= n_yes / 200) & (no / n_no * 50 <= yes / n_yes)]
        out.append(told if length else np.union1d(told, _hash(INSULTS)))
    return out


def features(column: pa.Array, lex: list[np.ndarray]) -> np.ndarray:
    """(documents, features)."""
    out = np.zeros((len(column), 11))
    for part in slices(column):
        n = part.last - part.first
        data, at = part.data, part.at
        plain = Plain(data, at)
        hit = np.zeros(len(plain.doc), bool)
        per = []
        for length, known in zip(STEMS, lex, strict=True):
            own = _in(known, plain.stems(length))
            hit |= own
            per.append(np.bincount(plain.doc[own], minlength=n))
        you = np.flatnonzero(_in(_YOU, plain.stems(0)))
        where = np.flatnonzero(hit)
        near = np.zeros(len(where), bool)
        if len(you) and len(where):
            for side in (np.searchsorted(you, where) - 1, np.minimum(np.searchsorted(you, where), len(you) - 1)):
                y = you[np.maximum(side, 0)]
                near |= (np.abs(y - where) <= NEAR) & (plain.doc[y] == plain.doc[where])
        count = np.maximum(1, np.bincount(plain.doc, minlength=n))
        hits = np.bincount(plain.doc[where], minlength=n)
        total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[at])
        chars, letters = np.maximum(1, np.diff(at)), np.maximum(1, total(_LETTER[data]))
        odd = np.zeros(len(data), bool)
        if len(data) > 2:
            odd[1:-1] = _ODD[data[1:-1]] & _LETTER[data[:-2]] & _LETTER[data[2:]]
        alone = plain.doc[(plain.ends - plain.starts) == 1]
        rows = [
            hits / count, np.minimum(hits, 5), *(np.minimum(x, 5) for x in per), np.bincount(plain.doc[where[near]], minlength=n) / np.maximum(1, hits),
            total(_UPPER[data]) / letters, total(data == 33) / chars, total((data == 33) | (data == 63)) / chars, total(odd) / letters, np.bincount(alone, minlength=n) / count,
        ]
        out[part.first : part.last] = np.stack(rows, 1)
    return out


def boost(x: np.ndarray, y: np.ndarray) -> tuple[list[np.ndarray], float, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Bin edges of each feature, the first logit, and trees (feature, bin, leaf values) for log loss, from histograms."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = binning(x, edges)
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(rate / (1 - rate)))
    logit, trees = np.full(len(y), start), []
    nodes = (1 << DEPTH) - 1
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logit))
        g, h = y - p, p * (1 - p) + 1e-6
        feature, cut, at = np.zeros(nodes, int), np.full(nodes, BINS), np.zeros(len(y), int)
        for depth in range(DEPTH):
            first, width = (1 << depth) - 1, 1 << depth
            best, own = np.full(width, 1e-6), at - first
            for f in range(x.shape[1]):
                key = own * BINS + binned[:, f]
                gs, hs = (np.bincount(key, w, width * BINS).reshape(width, BINS).cumsum(1) for w in (g, h))
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                top = gain.argmax(1)
                value = gain[np.arange(width), top]
                for node in np.flatnonzero(value > best):
                    best[node], feature[first + node], cut[first + node] = value[node], f, top[node]
            at = 2 * at + 1 + (binned[np.arange(len(y)), feature[at]] > cut[at])
        leaf = at - nodes
        values = SHRINK * np.bincount(leaf, g, 1 << DEPTH) / (np.bincount(leaf, h, 1 << DEPTH) + 1)
        trees.append((feature, cut, values))
        logit += values[leaf]
    return edges, start, trees


def binning(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)


def logits(x: np.ndarray, model) -> np.ndarray:
    edges, start, trees = model
    binned, out = binning(x, edges), np.full(len(x), start)
    row = np.arange(len(x))
    for feature, cut, values in trees:
        at = np.zeros(len(x), int)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (binned[row, feature[at]] > cut[at])
        out += values[at - len(feature)]
    return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing step fit of y on x, by pooling adjacent violators; ties of x are pooled first."""
    names, inverse, n = np.unique(x, return_inverse=True, return_counts=True)
    mean = np.bincount(inverse, y) / n
    pools: list[list[float]] = []
    for k, (m, w) in enumerate(zip(mean, n, strict=True)):
        pools.append([m, float(w), k])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2]])
    return np.array([names[int(p[2])] for p in pools]), np.array([p[0] for p in pools])


def fit(texts: list[str], toxic: np.ndarray):
    """Lexicon, trees and knots. Every third or so document of the sample calibrates."""
    part = np.random.default_rng(3).random(len(texts)) < CALIBRATE
    if not part.any() or part.all() or len(set(toxic[part])) < 2:
        part = np.zeros(len(texts), bool)
    grow = [t for t, p in zip(texts, part, strict=True) if not p]
    lex = lexicon(grow, toxic[~part])
    x = features(pa.array(texts), lex)
    trees = boost(x[~part], toxic[~part].astype(float))
    held = part if part.any() else ~part
    return lex, trees, isotonic(logits(x[held], trees), toxic[held].astype(float))


def scored(docs: DataFrame, labels: DataFrame, holdout: int = 3, least: float = 0.7) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted (score of `least` or more).

    Fitted on labelled rows whose crc32(doc_id) mod `holdout` isn't 1; a document that has several labels counts as toxic if
    one says so; null labels don't count. Null texts are empty ones and are scored too. With one label only, or none, every
    score is the rate of toxic ones (0 without labels). Very long texts are read whole. Repeated rows each get a row; extra
    columns are ignored; an empty table gives no rows.
    """
    known = labels.where((bucket("doc_id", holdout) != 1) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = sampled(known, "toxic", "doc_id", DOCS_A_LABEL)  # a bounded number of ids
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > BYTES:  # long documents: fewer of them
        texts = texts.where(F.pmod(F.xxhash64("doc_id", F.lit("bytes")), F.lit(SPAN)) < SPAN * BYTES // size)
    rows = texts.orderBy(F.xxhash64("doc_id"), "doc_id", "text").collect()
    toxic = np.array([int(r["toxic"] > 0) for r in rows], int)
    constant = float(toxic.mean()) if len(toxic) else 0.0
    model = fit([r["text"] or "" for r in rows], toxic) if 0 < constant < 1 else None
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.full(batch.num_rows, constant)
            if sent.value is not None:
                lex, trees, (knots, values) = sent.value
                raw = logits(features(batch.column(2), lex), trees)
                score = values[np.maximum(0, np.searchsorted(knots, raw, "right") - 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= least).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (bucket("doc_id", holdout) == 1).alias("held_out"), "text")
    return bare.mapInArrow(tidy(run), "doc_id long, held_out boolean, score double, predicted int")
