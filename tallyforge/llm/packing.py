"""Packing of documents into sequences by lexical retrieval.

Documents are laid out by their words: a signature of several weighted minima over their subword ids (late ids of a
vocabulary of merges are rare words and weigh more) orders all rows, so that documents which share rare words lie near each
other, copies side by side. Runs of this order are the shards of a BM25 inverted index with the statistics of all documents.
A seed document opens a window; its unused neighbours in the shard, ranked by all of the seed's ids, fill it greedily. The
document that doesn't fit is cut, and its rest is the seed of the next window. A window that a shard leaves open is filled on
by the next shard of the task, so a task pads one window at most. Work and memory grow with the documents, not their square.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import saved
from .subword import KEPT, Subwords, as_binary, from_binary, vocabulary_path
from .text import mix
from .workers import tidy

WINDOW, END = 2048, 1
#: Documents and ids of a shard, at most (a longer document is a shard of its own); ids of a task, and tasks at most.
DOCS_A_SHARD, IDS_A_SHARD, IDS_A_TASK, TASKS = 2048, 4_000_000, 8_000_000, 50_000
#: Minima of a signature. BM25. Neighbours that are sorted at first.
MINIMA, K1, B, FEW = 4, 1.2, 0.75, 16


def signatures(flat: np.ndarray, edges: np.ndarray, size: int) -> np.ndarray:
    """(documents, MINIMA): for each of several hashes, the id with the least exponential draw at a rate of its weight."""
    weight = np.maximum(1e-3, np.log2(np.maximum(1, np.arange(size) / 512))) ** 2
    out = np.zeros((len(edges) - 1, MINIMA), np.int32)
    full = np.flatnonzero(np.diff(edges))
    if not len(full):
        return out
    for k in range(MINIMA):
        draw = (mix(np.arange(size, dtype=np.uint64), 400 + k) >> np.uint64(11)).astype(np.float64) / (1 << 53)
        order = np.argsort(-np.log1p(-draw) / weight, kind="stable")
        rank = np.empty(size, np.int32)
        rank[order] = np.arange(size, dtype=np.int32)
        least = np.minimum.reduceat(rank[flat], edges[full])
        out[full, k] = (mix(order[least].astype(np.uint64), 500 + k) >> np.uint64(33)).astype(np.int32)
    return out


def _encoded(path: str, kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Subwords.of(path)
        coder.kept = kept
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                some = batch.slice(low, 500)
                flat, edges = coder.encode(some.column(1), END)
                keys = signatures(flat, edges, coder.size)
                columns = [some.column(0), as_binary(flat, edges), pa.array(np.diff(edges)), *[pa.array(np.ascontiguousarray(keys[:, k])) for k in range(MINIMA)]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n", *[f"m{k}" for k in range(MINIMA)]])
        coder.forget()

    return tidy(run)


def _terms(flat: np.ndarray, edges: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, id and count of every distinct id of every document, in this order."""
    doc = np.repeat(np.arange(len(edges) - 1, dtype=np.int64), np.diff(edges))
    cell, count = np.unique(doc * size + flat, return_counts=True)
    return *np.divmod(cell, size), count


def _frequencies(size: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                flat, edges = from_binary(batch.column(0).slice(low, 500), dtype)
                df += np.bincount(_terms(flat, edges, size)[1], minlength=size)
                n, total = n + len(edges) - 1, total + len(flat)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *at], pa.int32()), pa.array([n, total, *df[at]], pa.int64())], ["cell", "n"])

    return tidy(run)


def similarities(flat: np.ndarray, edges: np.ndarray, whole: tuple[int, float, np.ndarray]) -> np.ndarray:
    """(seeds, documents): BM25 of every document of a shard for all distinct ids of every other. whole: number, mean length
    and document frequencies of all documents. Frequent ids of the shard go by a matrix product, the others by postings."""
    total, mean, df = whole
    n, size = len(edges) - 1, len(df)
    doc, term, count = _terms(flat, edges, size)
    norm = K1 * (1 - B + B * np.diff(edges) / max(1.0, mean))
    weight = (np.log1p((total - df + 0.5) / (df + 0.5))[term] * (count * (K1 + 1) / (count + norm[doc]))).astype(np.float32)
    here = np.bincount(term, minlength=size)
    often = here > max(16, n // 16)
    column = np.cumsum(often) - 1
    own = often[term]
    dense = np.zeros((n, int(often.sum())), np.float32)
    dense[doc[own], column[term[own]]] = weight[own]
    out = (dense > 0).astype(np.float32) @ dense.T
    doc, term, weight = doc[~own], term[~own], weight[~own]
    order = np.argsort(term, kind="stable")
    doc, term, weight = doc[order], term[order], weight[order]
    cells, values = [], []
    for step in range(1, max(16, n // 16)):
        same = np.flatnonzero(term[step:] == term[:-step])
        if not len(same):
            break
        cells += [doc[same] * n + doc[same + step], doc[same + step] * n + doc[same]]
        values += [weight[same + step], weight[same]]
    if cells:
        out += np.bincount(np.concatenate(cells), np.concatenate(values), n * n).reshape(n, n).astype(np.float32)
    return out


class Filler:
    """Fills windows shard by shard: (document, start, length, sequence, offset) of every piece."""

    def __init__(self, window: int) -> None:
        self.window, self.sequence, self.offset = window, 0, 0

    def shard(self, lengths: list[int], score: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """lengths: ids of each document; score: the rank of each document for each seed, best highest; ties go to the first."""
        used, at = np.zeros(len(lengths), bool), 0
        queue: Iterator[int] = iter(())
        seeded = False

        def ranked(row: np.ndarray) -> Iterator[int]:
            """Unused documents, best first; the first few are sorted before the rest, which is seldom asked for."""
            free = np.flatnonzero(~used)
            row = -row[free]
            if len(free) > 4 * FEW:
                head = np.flatnonzero(row <= np.partition(row, FEW)[FEW])
                yield from free[head[np.argsort(row[head], kind="stable")]].tolist()
            yield from free[np.argsort(row, kind="stable")].tolist()

        while True:
            now = next((d for d in queue if not used[d]), None)
            if now is None:
                seeded = False
                while at < len(lengths) and used[at]:
                    at += 1
                if at == len(lengths):
                    return
                now = at
            used[now] = True
            start, opens = 0, not seeded
            while start < lengths[now]:
                length = min(self.window - self.offset, lengths[now] - start)
                yield now, start, length, self.sequence, self.offset
                start, self.offset = start + length, self.offset + length
                if self.offset == self.window:
                    self.sequence, self.offset, opens = self.sequence + 1, 0, True
            if self.offset == 0:  # the next window opens with the first unused document
                queue, seeded = iter(()), False
            elif opens:  # the first document of a window, or the rest of one, is its seed
                queue, seeded = ranked(score[now]), True


def _packed(size: int, dtype: str, whole, window: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filler, part = Filler(window), TaskContext.get().partitionId() << 32
        names: list = []
        texts: list[np.ndarray] = []
        held = 0

        def shard() -> pa.RecordBatch:
            edges, flat = np.cumsum([0, *(len(x) for x in texts)]), np.concatenate(texts)
            score = similarities(flat, edges, whole.value)
            pieces = list(filler.shard([len(x) for x in texts], score))
            own = [texts[d][start : start + length] for d, start, length, _, _ in pieces]
            doc, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*pieces, strict=True))
            out = [pa.array([names[d] for d in doc], pa.int64()), pa.array(start), pa.array(length), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in own], pa.int64())]
            out += [pa.array(np.diff(edges)[doc]), pa.array(part + sequence), pa.array(offset)]
            columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if keep_ids:
                out.append(pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(out, columns + ["ids"] * keep_ids)

        for batch in batches:
            flat, edges = from_binary(batch.column(1), dtype)
            for i, name in enumerate(batch.column(0).to_pylist()):
                names.append(name)
                texts.append(flat[edges[i] : edges[i + 1]])
                held += len(texts[-1])
                if len(names) == DOCS_A_SHARD or held >= IDS_A_SHARD:
                    yield shard()
                    names, texts, held = [], [], 0
        if names:
            yield shard()

    return tidy(run)


def packed(docs: DataFrame, window: int = WINDOW, path: str | None = None, keep_ids: bool = False, kept_words: int = KEPT) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    Every id of every document, the end id included, is in one piece. A null or empty text is its end id alone; a text longer
    than a window is cut over several. Rows that repeat an id or a text are packed each; null ids are kept; ties go by a
    number of the row. Extra columns are ignored; an empty table gives no rows. kept_words trades a worker's memory for time.
    """
    path, spark = path or vocabulary_path(), docs.sparkSession
    size, dtype = Subwords.of(path).size, Subwords.of(path).dtype.str
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    minima = [f"m{k}" for k in range(MINIMA)]
    ids = docs.mapInArrow(_encoded(path, kept_words), "doc_id long, ids binary, n long, " + ", ".join(f"{m} int" for m in minima))
    ids = saved(ids.withColumn("tie", F.xxhash64("doc_id", F.monotonically_increasing_id())), "packing-ids")
    df, counts = np.zeros(size, np.int64), {-2: 0, -1: 0}
    for cell, n in ids.select("ids").mapInArrow(_frequencies(size, dtype), "cell int, n long").groupBy("cell").agg(F.sum("n")).collect():  # a vocabulary's cells at most
        if cell < 0:
            counts[cell] = n
        else:
            df[cell] = n
    whole = spark.sparkContext.broadcast((counts[-2], counts[-1] / max(1, counts[-2]), df))
    parts = int(min(TASKS, counts[-1] // IDS_A_TASK + 1))
    laid = ids.repartitionByRange(parts, *minima, "tie").sortWithinPartitions(*minima, "tie").select("doc_id", "ids")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * keep_ids
    return laid.mapInArrow(_packed(size, dtype, whole, window, keep_ids), schema)
