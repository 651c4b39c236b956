"""Exact BM25 top-k search: inverted indexes with dynamic pruning of blocks by their maxima, run per shard and merged exactly with
global statistics. Block-max WAND's test is applied to each query and block in turn, not to cursors that move over postings.

Terms are words as in text.py; a query's weights are its term counts. Queries are sent in blocks of bounded size. For each
block one pass counts the document frequencies of its terms over all documents; a second pass turns every run of documents
into a shard with an inverted index of these terms, weighted with the global statistics. In a shard:

* documents are laid out by their main frequent word and length, and blocks of them keep the largest weight of each term;
* the rare terms of a batch of queries are summed over their postings; the scores of the documents that this puts first, and
  what the task has found before, give a lower bound of the k-th score;
* a query skips a block if the block's largest sum and its maxima of the frequent terms can't reach that bound;
* in a block that is left to some queries of a batch, the frequent terms are added for these with one matrix product, and
  documents that reach the bound (pivots) are scored in full.

All but the last step takes a whole batch at a time, so that what is spent grows with postings, not with calls.

Full scores add a query's terms in one order, so equal documents have equal scores everywhere; ties go to the lesser id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import hashes, slices, words
from .workers import tidy

K1, B = 1.2, 0.75
#: Queries sent at a time; documents and distinct words of a shard at most; documents in a block of an index.
QUERIES_A_BLOCK, BYTES_A_BLOCK, DOCS_A_SHARD, WORDS_A_SHARD, BLOCK = 16_384, 64_000_000, 16_384, 8_000_000, 64
#: Frequent terms of a group of like documents, kept as columns; groups of a shard, and documents of one at least, about.
FREQUENT, GROUPS, DOCS_A_GROUP = 512, 8, 1_000
#: Queries in a batch; blocks in a matrix product; postings summed at a time; relative error that single precision may have.
BATCH, TILE, POSTINGS, SLACK = 128, 8, 250_000, 1e-4


def counted_slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of runs of documents: the first row, and of its documents in turn the sorted distinct word hashes, their counts, where
    each document's begin (one more entry than documents), and the words of each document."""
    for part in slices(column):
        starts, ends, doc = words(part.data, part.at)
        h = hashes(part.data, starts, ends)
        edge = np.searchsorted(doc, np.arange(part.last - part.first + 1))
        for low, high in pairwise(edge.tolist()):
            h[low:high].sort()
        new = np.append(True, h[1:] != h[:-1]) if len(h) else np.zeros(0, bool)
        new[edge[:-1][np.diff(edge) > 0]] = True
        at = np.flatnonzero(new)
        yield part.first, h[at], np.diff(np.append(at, len(h))), np.searchsorted(at, edge), np.diff(edge)


def counted_terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Row, sorted distinct word hashes, their counts, and words of each document."""
    for first, h, n, edge, lengths in counted_slices(column):
        for i, (low, high) in enumerate(pairwise(edge.tolist())):
            yield first + i, h[low:high], n[low:high], int(lengths[i])


class Queries:
    """A block of queries: their vocabulary, and the terms and counts of each."""

    def __init__(self, ids: list[int], texts: list[str]) -> None:
        self.ids = ids
        found = [(h, n.astype(np.uint32), edge) for _, h, n, edge, _ in counted_slices(pa.array(texts, pa.large_string()))]
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *[h for h, _, _ in found]]))
        self._terms = np.concatenate([np.zeros(0, np.int32), *[np.searchsorted(self.vocabulary, h).astype(np.int32) for h, _, _ in found]])
        self._counts = np.concatenate([np.zeros(0, np.uint32), *[n for _, n, _ in found]])
        self._edge = np.append(0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *[np.diff(edge) for _, _, edge in found]])))

    def __getitem__(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        """The terms and counts of a query."""
        own = slice(self._edge[q], self._edge[q + 1])
        return self._terms[own], self._counts[own]

    def by_main_term(self, idf: np.ndarray) -> list[int]:
        """The queries in the order of their main term among the most frequent ones, so that neighbours are alike."""
        rank = np.full(len(idf), -1)
        rank[np.argsort(idf, kind="stable")[:64]] = np.arange(min(64, len(idf)))
        own = rank[self._terms] >= 0
        most = [max(zip(c, r, strict=True), default=(0, -1)) for c, r in ((self[q][1][own[low:high]].tolist(), rank[self[q][0][own[low:high]]].tolist()) for q, (low, high) in enumerate(pairwise(self._edge.tolist())))]
        many = np.diff(self._edge)
        return sorted(range(len(self.ids)), key=lambda q: (most[q][1], many[q], q))

    def known(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are in the vocabulary, and where."""
        at = np.minimum(np.searchsorted(self.vocabulary, h), max(0, len(self.vocabulary) - 1))
        return (self.vocabulary[at] == h if len(self.vocabulary) else np.zeros(len(h), bool)), at


def _frequencies(sent):
    """A partition's document frequencies by term; documents and words as the cells -1 and -2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = sent.value
        df, docs, size = np.zeros(len(queries.vocabulary), np.int64), 0, 0
        for batch in batches:
            for _, h, _, _, lengths in counted_slices(batch.column(0)):
                docs, size = docs + len(lengths), size + int(lengths.sum())
                if len(df):
                    has, at = queries.known(h)
                    df += np.bincount(at[has], minlength=len(df))
        cells = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(cells, (-1, -2))), pa.array(np.append(df[cells], (docs, size)))], ["cell", "n"])

    return tidy(run)


class Shard:
    """The inverted index of some documents over a block's vocabulary."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, idf: np.ndarray, average: float) -> None:
        n, v = len(ids), len(idf)
        often = np.argsort(-np.bincount(term, minlength=v), kind="stable")[:64]
        main = np.full(v, -1)
        main[often] = np.arange(len(often))
        top = main[term]
        has = np.flatnonzero(top >= 0)
        best = has[np.lexsort((tf[has], doc[has]))]
        kind = np.full(n, -1)
        kind[doc[best]] = top[best]
        order = np.lexsort((ids, lengths, kind))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.ids, doc = ids[order], place[doc]
        norm = K1 * (1 - B + B * lengths[order] / average)
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[doc])
        order = np.argsort(doc * v + term)  # a term occurs once in a document
        self.own_term, self.own_weight, self.own = term[order], weight[order], np.searchsorted(doc[order], np.arange(n + 1))
        order = np.argsort(term.astype(np.int64) * n + doc)
        term, self.doc, self.weight = term[order], doc[order], weight[order]
        self.start = np.searchsorted(term, np.arange(v + 1))
        many = np.diff(self.start)
        dense = np.argsort(-many, kind="stable")[:FREQUENT]
        self.column = np.full(v, -1, np.int32)
        self.column[dense] = np.arange(len(dense))
        own = self.column[term]
        blocks = -(-n // BLOCK)
        self.dense = np.zeros((blocks * BLOCK, FREQUENT), np.float32)
        self.dense[self.doc[own >= 0], own[own >= 0]] = self.weight[own >= 0]
        self.block_most = self.dense.reshape(blocks, BLOCK, FREQUENT).max(axis=1)
        self.share = (many / n).astype(np.float32)
        self.asked = self.skipped = 0  # pairs of a query and a block

    def _rare(self, terms: np.ndarray, counts: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
        """Sums of the terms that aren't columns, by query and document. of: the query of each term, in order."""
        places = len(self.dense)
        out = np.zeros((size, places), np.float32)
        low = self.start[terms]
        many = self.start[terms + 1] - low
        use = np.flatnonzero((self.column[terms] < 0) & (many > 0))
        low, many, counts, of = low[use], many[use], counts[use], of[use]
        ahead = np.append(0, np.cumsum(many))
        edge = np.searchsorted(of, np.arange(size + 1))
        first = 0
        while first < size:
            last = max(first + 1, int(np.searchsorted(ahead[edge], ahead[edge[first]] + POSTINGS, "right")) - 1)
            own = slice(edge[first], edge[last])
            n = many[own]
            at = np.arange(ahead[edge[last]] - ahead[edge[first]])
            at += np.repeat(low[own] - (ahead[:-1][own] - ahead[edge[first]]), n)
            place = self.doc[at]
            place += np.repeat((of[own] - first) * places, n)
            weight = self.weight[at]
            weight *= np.repeat(counts[own].astype(np.float64), n)
            out[first:last] = np.bincount(place, weight, (last - first) * places).reshape(-1, places)
            first = last
        return out

    def full(self, docs: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Scores of documents over all terms of a query."""
        each = np.zeros((len(docs), len(terms)))
        for row, low, high in zip(each, self.own[docs].tolist(), self.own[docs + 1].tolist(), strict=True):
            if high > low:
                own = self.own_term[low:high]
                at = np.minimum(np.searchsorted(own, terms), high - low - 1)
                np.multiply(self.own_weight[low:high][at], own[at] == terms, out=row)
        return (each * counts).sum(axis=1)

    def search(self, batch: list[tuple[np.ndarray, np.ndarray]], k: int, found: list[list[tuple[float, int]]]) -> None:
        """Put the best k of each query's found, (-score, id), and this shard's documents that share a term into found."""
        n, size = len(self.ids), len(batch)
        of = np.repeat(np.arange(size), [len(terms) for terms, _ in batch])
        terms, counts = (np.concatenate([x[i] for x in batch]) for i in (0, 1))
        column = self.column[terms]
        weights = np.zeros((size, FREQUENT), np.float32)
        weights[of[column >= 0], column[column >= 0]] = counts[column >= 0]
        partial = self._rare(terms, counts, of, size)
        most = partial.reshape(size, -1, BLOCK).max(axis=2)
        least = np.zeros(size)
        if n >= k:
            # the k first are in the k blocks with the largest maxima
            blocks = np.argpartition(-most, min(k, most.shape[1]) - 1, axis=1)[:, :k]
            inside = (blocks[:, :, None] * BLOCK + np.arange(BLOCK)).reshape(size, -1)
            sums = np.where(inside < n, np.take_along_axis(partial, inside, 1), -1)
            first = np.argpartition(-sums, k - 1, axis=1)[:, :k]
            likely = np.take_along_axis(inside, first, 1)
            scores = np.matmul(self.dense[likely], weights[:, :, None])[:, :, 0] + np.take_along_axis(sums, first, 1)
            least = np.where((likely < n).all(axis=1), (1 - SLACK) * scores.min(axis=1), 0)
        least = (1 - SLACK) * np.maximum(least, [-best[k - 1][0] if len(best) >= k else 0 for best in found])
        alive = weights @ self.block_most.T + most >= least[:, None]
        self.asked, self.skipped = self.asked + alive.size, self.skipped + alive.size - int(alive.sum())
        least = np.maximum(least, 1e-9)
        tiles: list[tuple[np.ndarray, int, np.ndarray]] = []
        most[:] = 0
        for block in range(0, alive.shape[1], TILE):
            live = np.flatnonzero(alive[:, block : block + TILE].any(axis=1))
            if len(live):
                own = slice(block * BLOCK, (block + TILE) * BLOCK)
                score = weights[live] @ self.dense[own].T
                score += partial[live, own]
                most[live, block : block + TILE] = score.reshape(len(live), -1, BLOCK).max(axis=2)
                tiles.append((live, block * BLOCK, score))
        if not tiles:
            return
        if most.shape[1] > k:  # so many blocks have a document each that reaches this
            least = np.maximum(least, (1 - 2 * SLACK) * -np.partition(-most, k - 1, axis=1)[:, k - 1])
        pivots: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for live, first, score in tiles:
            q, row = np.divmod(np.flatnonzero(score >= least[live, None]), score.shape[1])
            pivots.append((live[q], row + first, score[q, row]))
        q, row, score = (np.concatenate([x[i] for x in pivots]) for i in range(3))
        order = np.lexsort((-score, q))
        q, row, score = q[order], row[order], score[order]
        edge = np.searchsorted(q, np.arange(size + 1))
        many = np.diff(edge) > k
        reach = np.zeros(size)
        reach[many] = score[edge[:-1][many] + k - 1]
        keep = (score >= (1 - 2 * SLACK) * reach[q]) & (row < n)
        q, row = q[keep], row[keep]
        edge = np.searchsorted(q, np.arange(size + 1)).tolist()
        for i, (terms, counts) in enumerate(batch):
            for low in range(edge[i], edge[i + 1], 2048):
                some = row[low : min(low + 2048, edge[i + 1])]
                found[i] = found[i] + [(-s, j) for s, j in zip(self.full(some, terms, counts).tolist(), self.ids[some].tolist(), strict=True) if s > 0]
            found[i] = sorted(found[i])[:k]


def likenesses(term: np.ndarray, doc: np.ndarray, n: int, v: int) -> np.ndarray:
    """A group of like documents for each of n, by which of the 64 most frequent terms they hold: a few steps of k-means from
    documents that lie apart."""
    often = np.argsort(-np.bincount(term, minlength=v), kind="stable")[:64]
    place = np.full(v, -1)
    place[often] = np.arange(len(often))
    place = place[term]
    held = np.zeros((n, 64), np.float32)
    held[doc[place >= 0], place[place >= 0]] = 1
    held /= np.maximum(1, np.sqrt(held.sum(axis=1, keepdims=True)))
    many = min(GROUPS, n // DOCS_A_GROUP + 1)
    centre = held.mean(axis=0, keepdims=True)
    for _ in range(many - 1):
        centre = np.append(centre, held[[(held @ centre.T).max(axis=1).argmin()]], axis=0)
    for _ in range(6):
        group = (held @ centre.T - (centre**2).sum(axis=1) / 2).argmax(axis=1)
        for g in range(many):
            if (group == g).any():
                centre[g] = held[group == g].mean(axis=0)
    return group


class Groups:
    """Documents as an index for each group of like ones, so that each has the frequent terms of its own as columns. Terms that
    the documents hold have numbers of their own; all others share the last one, which has no postings."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, idf: np.ndarray, average: float) -> None:
        held = np.flatnonzero(np.bincount(term, minlength=len(idf)))
        self.number = np.full(len(idf), len(held), np.int32)
        self.number[held] = np.arange(len(held))
        term, idf = self.number[term], np.append(idf[held], 0.0)
        group = likenesses(term, doc, len(ids), len(idf))
        self.shards = []
        for g in np.unique(group):
            docs, own = np.flatnonzero(group == g), np.flatnonzero(group[doc] == g)
            place = np.cumsum(group == g) - 1
            self.shards.append(Shard(ids[docs], lengths[docs], term[own], place[doc[own]], tf[own], idf, average))

    def search(self, batch: list[tuple[np.ndarray, np.ndarray]], k: int, found: list[list[tuple[float, int]]]) -> None:
        """As Shard.search, the group that shares most with the batch first: what it finds spares work in the others."""
        batch = [(self.number[terms], counts) for terms, counts in batch]
        terms, counts = np.concatenate([x[0] for x in batch]), np.concatenate([x[1] for x in batch]).astype(np.float32)
        for shard in sorted(self.shards, key=lambda x: -float(x.share[terms] @ counts)):
            shard.search(batch, k, found)


def _searched(sent, statistics, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = sent.value
        idf, average = statistics.value
        found: list[list[tuple[float, int]]] = [[] for _ in queries.ids]
        like = queries.by_main_term(idf)
        ids: list[int] = []
        lengths: list[int] = []
        terms: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        sizes: list[int] = []
        held = 0

        def shard() -> None:
            nonlocal held
            own_ids, own_lengths, term, doc, tf = np.array(ids, np.int64), np.array(lengths, np.float64), np.concatenate(terms), np.repeat(np.arange(len(ids)), sizes), np.concatenate(counts).astype(np.float64)
            for x in (ids, lengths, terms, counts, sizes):
                x.clear()
            held = 0
            index = Groups(own_ids, own_lengths, term, doc, tf, idf, average)
            del term, doc, tf
            for low in range(0, len(like), BATCH):
                some = like[low : low + BATCH]
                own = [found[q] for q in some]
                index.search([queries[q] for q in some], k, own)
                for q, best in zip(some, own, strict=True):
                    found[q] = best

        for batch in batches if len(idf) else ():
            names = batch.column(0).to_pylist()
            for first, h, n, edge, own in counted_slices(batch.column(1)):
                has, at = queries.known(h)
                at, n, edge = at[has].astype(np.int32), n[has].astype(np.uint32), np.append(0, np.cumsum(has))[edge].tolist()
                for i, (low, high) in enumerate(pairwise(edge)):
                    if names[first + i] is None:
                        continue
                    ids.append(names[first + i])
                    lengths.append(int(own[i]))
                    terms.append(at[low:high])
                    counts.append(n[low:high])
                    sizes.append(high - low)
                    held += high - low
                    if len(ids) >= DOCS_A_SHARD or held >= WORDS_A_SHARD:
                        shard()
        if ids:
            shard()
        rows = [(queries.ids[q], q, i, -s) for q, own in enumerate(found) for s, i in own]
        kinds = [("query_id", pa.int64()), ("query_row", pa.int64()), ("doc_id", pa.int64()), ("score", pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], [n for n, _ in kinds])

    return tidy(run)


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents (doc_id, text) of each query (query_id, text): query_id, doc_id, score, rank from 1.

    Documents that share no term with a query aren't listed, so a null or empty query has no rows, and few matches give
    fewer than k. Ties go to the lesser doc_id; rows that repeat a doc_id each take a rank; null ids are left out. Repeated
    queries are searched each, with k rows each. Very long texts count whole. Extra columns are ignored; an empty table on
    either side gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    queries = queries.where(F.col("query_id").isNotNull() & F.col("text").isNotNull()).select(F.col("query_id").cast("long").alias("query_id"), "text")
    n, size = queries.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(n // QUERIES_A_BLOCK, size // BYTES_A_BLOCK) + 1
    out = None
    for block in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).orderBy("query_id", "text").collect()
        held = Queries([r[0] for r in rows], [r[1] for r in rows])
        sent = spark.sparkContext.broadcast(held)
        cells = docs.select("text").mapInArrow(_frequencies(sent), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        cell, n = cells.column("cell").to_numpy(), cells.column("n").to_numpy()
        df = np.zeros(len(held.vocabulary))
        df[cell[cell >= 0]] = n[cell >= 0]
        total, size = n[cell == -1].sum(), n[cell == -2].sum()
        statistics = spark.sparkContext.broadcast((np.log1p((total - df + 0.5) / (df + 0.5)), max(1.0, size / max(1, total))))
        found = docs.mapInArrow(_searched(sent, statistics, k), "query_id long, query_row long, doc_id long, score double").withColumn("query_block", F.lit(block))
        out = found if out is None else out.unionByName(found)
    best = F.row_number().over(Window.partitionBy("query_block", "query_row").orderBy(F.col("score").desc(), "doc_id"))
    return out.withColumn("rank", best).where(F.col("rank") <= k).drop("query_block", "query_row")
