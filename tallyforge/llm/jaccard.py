"""N-gram Jaccard self-join by multiple-global-order filtering.

The set of a document holds the hashes of its distinct k-word shingles (with fewer words, the whole sequence as one; none
without words). Two documents are linked when 100 * |intersection| >= percent * |union|. Empty sets link with nothing.

1. Documents with equal sets form a class; one member stands for it, so copies are never paired.
2. Document frequencies over classes: every class sends its shingles once per task, packed in blobs, to the task of their
   hash range. A class keeps only shingles that another class has too. Linked classes share at least t*n shingles, so a
   class with fewer shared ones is out.
3. Global orders: rare first (by the frequency's power of two), ties by one permutation of the hashes for each order.
   Linked classes share a shingle of their prefixes under each order. The first order's prefixes span a bipartite graph
   whose components, found by contraction, hold all links; no pairs are made for that.
4. A component is cut into blocks of bounded size, and pairs of blocks are dealt by hash. There, candidates must share
   prefix shingles under all orders; the intersection of these filters is verified by exact set sizes with matrix
   products, and each pair of blocks returns a spanning forest and link counts, never its pairs.
5. The components of these edges are the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .store import dropped, saved
from .text import mix, shingle_sets
from .workers import tidy, tidy_group

ORDERS = 3
#: Shingles that one task counts, classes and shared shingles in a block, and columns of a matrix product. They bound memory only.
TOKENS_A_TASK, CLASSES_A_BLOCK, TOKENS_A_BLOCK, COLUMNS = 2_000_000, 128, 1_000_000, 32_768
STAR_PARTS = 16


def _least_share(n: np.ndarray, percent: int) -> np.ndarray:
    """The fewest shingles that a set of n shares with any linked one."""
    return -(-n * percent // 100)


def _class_id(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ids = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, own in shingle_sets(batch.column(1), k):
                n[i] = len(own)
                ids[i] = _class_id(own) if len(own) else 0
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2), pa.array(n), pa.array(ids, mask=n == 0)], ["doc_id", "code", "n_shingles", "class"])

    return tidy(run)


def _spread(k: int, buckets: int):
    """Each class's shingles, packed by hash range: ids and sizes of the classes, shingles of each, low 48 bits of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()

        def packed(found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            ids, sizes = np.array([x for x, _ in found], np.int64), np.array([len(y) for _, y in found], np.int64)
            tokens = np.concatenate([y for _, y in found])
            of = np.repeat(np.arange(len(found)), sizes)
            to = ((tokens >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            tokens, of, to = tokens[order], of[order], to[order]
            edges = np.searchsorted(to, np.arange(buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(edges)):
                own, part = of[edges[b] : edges[b + 1]], tokens[edges[b] : edges[b + 1]]
                which, counts = np.unique(own, return_counts=True)
                rows.append((int(b), ids[which].tobytes(), sizes[which].astype(np.int32).tobytes(), counts.astype(np.int32).tobytes(), part.view(np.uint8).reshape(-1, 8)[:, :7].tobytes()))
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate([pa.int32(), *[pa.binary()] * 4])], ["bucket", "ids", "sizes", "counts", "tokens"])

        found: list[tuple[int, np.ndarray]] = []
        held = 0
        for batch in batches:
            for _, own in shingle_sets(batch.column(0), k):
                if len(own) and (name := _class_id(own)) not in seen:
                    if len(seen) >= 1_000_000:  # forgetting only sends a class again
                        seen.clear()
                    seen.add(name)
                    found.append((name, own))
                    held += len(own)
                    if held >= TOKENS_A_TASK:
                        yield packed(found)
                        found, held = [], 0
        if found:
            yield packed(found)

    return tidy(run)


def _joined(table: pa.Table, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=dtype)


def _shared(parts: int):
    """From one hash range: the shingles that several classes have, packed by the class's part."""

    def run(table: pa.Table) -> pa.Table:
        ids, sizes, counts = _joined(table, "ids", np.int64), _joined(table, "sizes", np.int32), _joined(table, "counts", np.int32)
        raw = np.zeros((int(counts.sum()), 8), np.uint8)
        raw[:, :7] = _joined(table, "tokens", np.uint8).reshape(-1, 7)
        tokens = raw.view(np.uint64).ravel()
        tokens = tokens | (np.uint64(int(table.column("bucket")[0].as_py()) % 128) << np.uint64(56))
        of = np.repeat(np.arange(len(ids)), counts)
        order = np.argsort(tokens, kind="stable")
        tokens, of = tokens[order], of[order]
        same = tokens[1:] == tokens[:-1]
        several = np.zeros(len(tokens), bool)
        several[1:] |= same
        several[:-1] |= same
        tokens, of = tokens[several], of[several]
        owner = ids[of]
        order = np.lexsort((owner, tokens))
        tokens, owner, size = tokens[order], owner[order], sizes[of[order]]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])  # a class that several tasks have sent
        tokens, owner, size = tokens[new], owner[new], size[new]
        _, inverse, count = np.unique(tokens, return_inverse=True, return_counts=True)
        df = count[inverse]
        keep = df >= 2
        tokens, owner, size, level = tokens[keep], owner[keep], size[keep], np.log2(df[keep]).astype(np.uint8)
        to = (mix(owner.view(np.uint64), 7) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        edges = np.searchsorted(to[order], np.arange(parts + 1))
        rows = []
        for p in np.flatnonzero(np.diff(edges)):
            at = order[edges[p] : edges[p + 1]]
            at = at[np.argsort(owner[at], kind="stable")]
            which, first, counts = np.unique(owner[at], return_index=True, return_counts=True)
            rows.append((int(p), which.tobytes(), size[at][first].tobytes(), counts.astype(np.int32).tobytes(), tokens[at].tobytes(), level[at].tobytes()))
        return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate([("part", pa.int32()), *[(c, pa.binary()) for c in ("ids", "sizes", "counts", "tokens", "levels")]])})

    return tidy_group(run)


def _prefix(tokens: np.ndarray, levels: np.ndarray, length: int, order: int) -> np.ndarray:
    return tokens[np.lexsort((mix(tokens, 100 + order), levels))[:length]]


def _survivors(percent: int):
    """Classes that share enough, with the first order's prefix."""

    def run(table: pa.Table) -> pa.Table:
        counts = _joined(table, "counts", np.int32)
        ids, sizes = (np.repeat(_joined(table, c, t), counts) for c, t in (("ids", np.int64), ("sizes", np.int32)))
        tokens, levels = _joined(table, "tokens", np.uint64), _joined(table, "levels", np.uint8)
        order = np.argsort(ids, kind="stable")
        ids, sizes, tokens, levels = ids[order], sizes[order], tokens[order], levels[order]
        names, first, count = np.unique(ids, return_index=True, return_counts=True)
        n = sizes[first].astype(np.int64)
        spare = count - _least_share(n, percent)
        rows = []
        for i in np.flatnonzero(spare >= 0):
            own, level = tokens[first[i] : first[i] + count[i]], levels[first[i] : first[i] + count[i]]
            rows.append((int(names[i]), int(n[i]), int(count[i]), own.tobytes(), level.tobytes(), _prefix(own, level, int(spare[i]) + 1, 0).view(np.int64)))
        kinds = [("class", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("tokens", pa.binary()), ("levels", pa.binary()), ("prefix", pa.list_(pa.int64()))]
        return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(kinds)})

    return tidy_group(run)


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, with bounded columns at a time."""
    every = np.concatenate([*left, *right])
    _, column = np.unique(every, return_inverse=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    total = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (low, low + COLUMNS))
        ones = np.zeros((len(left) + len(right), min(COLUMNS, int(column[-1]) + 1 - low)), np.float32)
        ones[row[a:b], column[a:b] - low] = 1
        total += ones[: len(left)] @ ones[len(left) :].T
    return total.astype(np.int64)


def _verified(percent: int):
    def pairs(one: list[dict], two: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        n = [np.array([r["n"] for r in side], np.int64) for side in (one, two)]
        may = (100 * n[0][:, None] >= percent * n[1][None, :]) & (100 * n[1][None, :] >= percent * n[0][:, None])
        for order in range(ORDERS):
            fronts = [[_prefix(r["tokens"], r["levels"], len(r["tokens"]) - int(_least_share(r["n"], percent)) + 1, order) for r in side] for side in (one, two)]
            if not may.any():
                break
            may &= _common(*fronts) > 0
        if may.any():
            inside = _common([r["tokens"] for r in one], [r["tokens"] for r in two])
            may &= 100 * inside >= percent * (n[0][:, None] + n[1][None, :] - inside)
        return np.nonzero(may)

    def run(table: pa.Table) -> pa.Table:
        keys = [table.column(c).to_numpy() for c in ("label", "low", "high")]
        order = np.lexsort(keys[::-1])
        change = np.flatnonzero(np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)) + 1
        out: list[tuple[int, int, int]] = []
        for rows in np.split(order, change):
            block = table.take(pa.array(rows)).to_pylist()
            for r in block:
                r["tokens"], r["levels"] = np.frombuffer(r["tokens"], np.uint64), np.frombuffer(r["levels"], np.uint8)
            low, high = block[0]["low"], block[0]["high"]
            one, two = [r for r in block if r["own"] == low], [r for r in block if r["own"] == high]
            if not one or not two:
                continue
            if low == high:
                i, j = pairs(one, one)
                i, j = i[i < j], j[i < j]
            else:
                i, j = pairs(one, two)
            every = one if low == high else one + two
            j = j if low == high else j + len(one)
            up, links = list(range(len(every))), [0] * len(every)

            def top(x: int, up: list[int] = up) -> int:
                while up[x] != x:
                    up[x] = up[up[x]]
                    x = up[x]
                return x

            for a, b in zip(i.tolist(), j.tolist(), strict=True):
                links[a] += every[b]["copies"]
                links[b] += every[a]["copies"]
                a, b = top(a), top(b)
                up[max(a, b)] = min(a, b)
            out += [(every[x]["class"], every[top(x)]["class"], links[x]) for x in range(len(every)) if links[x]]
        return pa.table({n: pa.array([r[i] for r in out], pa.int64()) for i, n in enumerate(("a", "b", "links"))})

    return tidy_group(run)


def _linked(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """docs(doc_id, text) -> doc_id, code (of the text), n_shingles, class of each row; and for each class component_id, n_links
    and the component's first row, `head`, by id (null last) and code."""
    docs = docs.withColumn("code", F.xxhash64(F.coalesce("text", F.lit(""))))
    sets = saved(docs.select("doc_id", "text", "code").mapInArrow(_sets(k), "doc_id long, code long, n_shingles long, class long"), "sets", small=True)
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = parts = int(min(32_768, max(1, total // TOKENS_A_TASK + 1)))
    # a bucket is the top bits of the hash: 7 bytes of it and the bucket's number name a shingle
    head = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "code")).alias("head")
    classes = sets.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"), head, F.count(F.lit(1)).alias("copies"))
    spread = docs.select("text").mapInArrow(_spread(k, buckets), "bucket int, ids binary, sizes binary, counts binary, tokens binary")
    shared = spread.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_shared(parts), "part int, ids binary, sizes binary, counts binary, tokens binary, levels binary")
    near = saved(shared.repartition(parts, "part").groupBy("part").applyInArrow(_survivors(percent), "class long, n long, shared long, tokens binary, levels binary, prefix array<long>"), "near")

    # stars in two steps, so that a shingle of very many classes is several tasks' work: each class to the least of its part of
    # the shingle's classes, and these to the least of all
    by_token = near.select("class", F.explode("prefix").alias("token")).withColumn("part", F.pmod(F.xxhash64("class"), F.lit(STAR_PARTS)))
    parts_least = by_token.groupBy("token", "part").agg(F.min("class").alias("b"), F.max("class").alias("most"))
    least = parts_least.groupBy("token").agg(F.min("b").alias("top"), F.max("b").alias("last")).where("top < last").select("token", "top")
    inner = by_token.join(parts_least.where("b < most").select("token", "part", "b"), ["token", "part"]).where("class <> b").select(F.col("class").alias("a"), "b")
    outer = parts_least.join(least, "token").where("b <> top").select(F.col("b").alias("a"), F.col("top").alias("b"))
    coarse = saved(components(inner.unionByName(outer)), "coarse", small=True)
    inside = near.select("class", "n", "shared", "tokens", "levels").join(coarse.withColumnRenamed("node", "class"), "class").join(classes.select("class", "copies"), "class")
    of_label = near.select("class", "shared").join(coarse.withColumnRenamed("node", "class"), "class").groupBy("label").agg(F.count(F.lit(1)).alias("m"), F.sum("shared").alias("t"))
    blocks = F.greatest(F.ceil(F.col("m") / CLASSES_A_BLOCK), F.ceil(F.col("t") / TOKENS_A_BLOCK)).cast("int")
    cut = inside.join(of_label.select("label", blocks.alias("blocks")), "label").withColumn("own", F.pmod(F.xxhash64("class"), "blocks").cast("int"))
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    bins = max(12, parts * 2)
    dealt = dealt.select("class", "n", "copies", "tokens", "levels", "label", "own", "low", "high", F.pmod(F.xxhash64("label", "low", "high"), F.lit(bins)).alias("bin"))
    edges = saved(dealt.repartition(bins, "bin").groupBy("bin").applyInArrow(_verified(percent), "a long, b long, links long"), "links", small=True)

    joined = components(edges.select("a", "b")).withColumnRenamed("node", "class")
    linked = edges.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    labelled = classes.join(joined, "class", "left").withColumn("label", F.coalesce("label", "class"))
    ends = labelled.groupBy("label").agg(F.min("least").alias("component_id"), F.min("head").alias("head"))
    named = labelled.drop("head").join(ends, "label").join(linked, "class", "left").select("class", "component_id", "head", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    named = saved(named, "named", small=True)
    dropped(near, coarse, edges)
    return sets, named


def jaccard_components(docs: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id (least id reachable by links), n_links (linked documents).

    A null or empty text has n_shingles 0, no links, and its own id as component. Equal sets are linked. Rows that repeat an
    id each get a row. A null id is passed through; its own component_id is the least id of its component, null if that has
    none. Very long texts are taken whole; an empty table gives no rows. Extra columns are ignored, whatever their names.
    """
    sets, named = _linked(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), k, percent)
    out = sets.where("class is not null").join(named, "class").select("doc_id", "n_shingles", "component_id", "n_links")
    alone = sets.where("class is null")  # not joined: null keys would meet in one task
    return out.unionByName(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component: that of the least id (null last), then of the least hash of the text; of rows that
    repeat an id and a text any one. Rows without words are linked with nothing and all stay. All columns stay as they are."""
    sets, named = _linked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), k, percent)
    rows = sets.where("class is not null").join(named.select("class", F.col("head.doc_id").alias("head_id"), F.col("head.code").alias("head_code")), "class")
    first = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("code") == F.col("head_code"))
    gone = rows.where(~first).select(F.col("doc_id").alias("gone_id"), F.col("code").alias("gone_code")).distinct()
    again = rows.where(first).groupBy(F.col("doc_id").alias("gone_id"), F.col("code").alias("gone_code")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    id_, code = F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit("")))
    same = lambda other: id_.eqNullSafe(other["gone_id"]) & (code == other["gone_code"])
    again = saved(again, "again", small=True)
    out = docs.join(gone.unionByName(again), same(gone), "left_anti")
    if again.isEmpty():
        return out
    repeated = docs.join(again, same(again), "left_semi").withColumns({"tallyforge_id": id_, "tallyforge_code": code})
    return out.unionByName(repeated.dropDuplicates(["tallyforge_id", "tallyforge_code"]).drop("tallyforge_id", "tallyforge_code"))
