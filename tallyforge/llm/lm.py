"""Language-model scoring with a small causal self-attention model, beside an exact unigram baseline.

The model works on subword ids of a public vocabulary. Ids before the one that is scored count by GROUPS groups (frequent
ids have their own, others share one by shape); the scored id belongs to one of CLASSES classes (frequent ids have their own,
others are clustered by the groups that they follow). The probability of an id is that of its class given the ids before,
times that of the id in its class given the last group. The class comes from a softmax of scores by the last group plus the
output of a causal attention head with relative positions. Documents are cut into windows that overlap by CONTEXT ids, so
that each id is scored once, with at least that much context, by batched attention with masks.

All counts (ids, pairs of group and id, words of the baseline) cover all training documents. The attention head is trained in every
partition on every window of every training document, each document in one of two rounds, and the partitions' parameters
are averaged between rounds; so training, too, grows with the corpus, and what the driver gets is of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sample import bucket
from .store import dropped, saved
from .subword import Subwords, as_binary, from_binary, vocabulary_path
from .text import hashes, slices, words
from .workers import tidy, tidy_group

CLASSES, CLUSTERS = 96, 40
GROUPS, SHAPES = 256, 32
#: How much an id's share of its class weighs beside counts after one group, in occurrences.
SMOOTH = 3.0
#: Ids that a window scores, ids before them that it also sees, width of the head.
STRIDE, CONTEXT, WIDTH = 24, 8, 16
#: Windows taken at a time for scoring, and worked on at a time, so that their arrays stay in a core's cache.
BATCH, BLOCK = 240, 48
#: Rounds of averaging, each over its share of the documents; windows in a step; step size.
ROUNDS, STEP_WINDOWS, RATE = 2, 96, 0.02
#: Distinct words of documents that are sent at a time and counted in a task.
TOKENS_A_TASK = 2_000_000
#: Words whose ids a worker keeps from task to task while texts are encoded; about 80 bytes each at most. The next pass drops them.
KEPT_WORDS = 1_200_000
_END = np.uint64(0x5DEECE66D1234567)


# The baseline: exact counts of words.


def _word_blocks(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, serial = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def packed() -> pa.RecordBatch:
            nonlocal serial
            block = (part << 24) + serial
            serial += 1
            tokens, train, *head = (np.concatenate([x[i] for x in held]) for i in range(3, 8))
            docs = len(tokens)
            base = np.cumsum([0, *(len(x[3]) for x in held)])
            # the end of each text is a word of its own
            h = np.concatenate([*(x[0] for x in held), np.full(docs, _END)])
            n = np.concatenate([*(x[1] for x in held), np.ones(docs, np.int64)]).astype(np.int32)
            doc = np.concatenate([*(x[2] + at for x, at in zip(held, base[:-1], strict=True)), np.arange(docs)]).astype(np.int32)
            to = ((h >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)).astype(np.uint16)
            order = np.argsort(to, kind="stable")
            h, n, doc, edges = h[order], n[order], doc[order], np.searchsorted(to[order], np.arange(buckets + 1))
            rows = []
            for b in range(buckets):
                cut = slice(edges[b], edges[b + 1])
                first = b == block % buckets
                if first or edges[b + 1] > edges[b]:
                    rows.append((b, block, docs, h[cut].tobytes(), n[cut].tobytes(), doc[cut].tobytes(), train.tobytes(), b"".join(x.tobytes() for x in (*head, tokens)) if first else None))
            kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["bucket", "block", "docs", "h", "n", "doc", "train", "head"])

        for batch in batches:
            ids, null = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int8)
            codes, train = batch.column(1).to_numpy(), (~batch.column(2).to_numpy(zero_copy_only=False)).astype(np.int8)
            for piece in slices(batch.column(3)):
                starts, ends, doc = words(piece.data, piece.at)
                h = hashes(piece.data, starts, ends)
                edge = np.searchsorted(doc, np.arange(piece.last - piece.first + 1))
                for low, high in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    h[low:high].sort()
                first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))[: len(h)])
                own = slice(piece.first, piece.last)
                held.append((h[first], np.diff(first, append=len(h)), doc[first], np.diff(edge) + 1, train[own], ids[own], null[own], codes[own]))
                size += len(first) + piece.last - piece.first
                if size >= TOKENS_A_TASK:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    return tidy(run)


def _word_sums(table: pa.Table) -> pa.Table:
    """From one hash range: each block's sums of log10(c + 0.5) and of known tokens by document; N and V of the range."""
    cols = {c: table.column(c).to_pylist() for c in table.column_names}
    h, n = (np.frombuffer(b"".join(cols[c]), t) for c, t in (("h", np.uint64), ("n", np.int32)))
    train = np.concatenate([np.frombuffer(t, np.int8)[np.frombuffer(d, np.int32)] for t, d in zip(cols["train"], cols["doc"], strict=True)])
    _, inverse = np.unique(h, return_inverse=True)
    c = np.bincount(inverse, n * train) if len(h) else np.zeros(0)
    value, known = n * np.log10(c + 0.5)[inverse], n * (c > 0)[inverse]
    rows, at = [], 0
    for block, docs, doc, head in zip(cols["block"], cols["docs"], cols["doc"], cols["head"], strict=True):
        d = np.frombuffer(doc, np.int32)
        cut = slice(at, at + len(d))
        at += len(d)
        rows.append((block, np.bincount(d, value[cut], docs).tobytes(), np.bincount(d, known[cut], docs).astype(np.int32).tobytes(), head, 0, 0))
    rows.append((None, None, None, None, int(c.sum()), int((c > 0).sum())))
    kinds = [("block", pa.int64()), ("sums", pa.binary()), ("known", pa.binary()), ("head", pa.binary()), ("total", pa.int64()), ("distinct", pa.int64())]
    return pa.table({name: pa.array([r[i] for r in rows], k) for i, (name, k) in enumerate(kinds)})


def _word_docs(table: pa.Table) -> pa.Table:
    head = next(x for x in table.column("head").to_pylist() if x is not None)
    n = len(head) // 25
    ids, null, code, tokens = np.frombuffer(head, np.int64, n), np.frombuffer(head, np.int8, n, 8 * n) > 0, np.frombuffer(head, np.int64, n, 9 * n), np.frombuffer(head, np.int64, n, 17 * n)
    sums = np.sum([np.frombuffer(x, np.float64) for x in table.column("sums").to_pylist()], axis=0)
    known = np.sum([np.frombuffer(x, np.int32) for x in table.column("known").to_pylist()], axis=0).astype(np.int64)
    return pa.table({"doc_id": pa.array(ids, mask=null), "code": pa.array(code), "n_tokens": pa.array(tokens), "n_known": pa.array(known), "sums": pa.array(sums)})


def baseline(docs: DataFrame) -> DataFrame:
    """docs(doc_id, code, held_out, text) -> doc_id, code, n_tokens, n_known, train_tokens, base_score."""
    pairs = max(1, docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0) // 10  # about the distinct words of all documents
    buckets = int(min(32_768, pairs // TOKENS_A_TASK + 1))
    spread = docs.mapInArrow(_word_blocks(buckets), "bucket int, block long, docs int, h binary, n binary, doc binary, train binary, head binary")
    sums = saved(spread.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(tidy_group(_word_sums), "block long, sums binary, known binary, head binary, total long, distinct long"), "words")
    total, distinct = sums.agg(F.sum("total"), F.sum("distinct")).first()
    total, distinct = total or 0, distinct or 0
    each = sums.where("block is not null").groupBy("block").applyInArrow(_word_docs, "doc_id long, code long, n_tokens long, n_known long, sums double")
    return each.select("doc_id", "code", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), (F.col("sums") - F.col("n_tokens") * F.log10(F.lit(total + 0.5 * (distinct + 1)))).alias("base_score"))


# The model.


def _encoded(path: str):
    """Each text's ids; behind them, a row without a text that has the partition's counts of ids in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Subwords.of(path)
        coder.kept = KEPT_WORDS
        total = np.zeros(coder.size + 1, np.int64)
        names = ["doc_id", "code", "held_out", "ids", "counts"]
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                some = batch.slice(low, 500)
                flat, edges = coder.encode(some.column(3))
                train = ~some.column(2).to_numpy(zero_copy_only=False)
                total += np.bincount(flat[np.repeat(train, np.diff(edges))], minlength=len(total))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), some.column(2), as_binary(flat, edges), pa.nulls(some.num_rows, pa.binary())], names)
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip([None, None, None, None, total.tobytes()], kinds, strict=True)], names)

    return tidy(run)


def _counted(size: int, cells):
    """A partition's counts of size cells, as rows of those that occur. cells: adds what some values of a column hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Subwords.forget_all()
        total = np.zeros(size, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                cells(total, batch.column(0).slice(low, 500))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["cell", "n"])

    return tidy(run)


def _total(rows: DataFrame, size: int, cells) -> np.ndarray:
    """Counts over all rows of one column; at most `size` cells reach the driver."""
    out = np.zeros(size, np.float32)
    found = rows.mapInArrow(_counted(size, cells), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out


def group_of(counts: np.ndarray, path: str) -> np.ndarray:
    """The group of each id; the last id, one past the vocabulary, is the end."""
    tokenizer, size = Subwords.of(path).tokenizer, len(counts) - 1
    out = np.zeros(size + 1, np.int64)
    vowels = set("aeiouyáéíóúäöüàèùâêîôûã")
    for i in range(size):
        name = tokenizer.id_to_token(i) or ""
        bare = name.removesuffix("</w>")
        out[i] = (name != bare) | (min(len(bare), 4) - 1 if bare else 0) << 1 | (not bare.isascii()) << 3 | (bare[:1] in vowels) << 4
    own = GROUPS - SHAPES - 1
    out[np.argsort(-counts[:size], kind="stable")[:own]] = SHAPES + np.arange(own)
    out[size] = GROUPS - 1
    return out


def class_of(pairs: np.ndarray) -> np.ndarray:
    """The class of each id, from counts of (group before, id)."""
    counts = pairs.sum(axis=0)
    size = len(counts) - 1
    out = np.zeros(size + 1, np.int64)
    shares = np.sqrt(pairs / np.maximum(1, counts)).astype(np.float32).T
    order = np.argsort(-counts[:size], kind="stable")
    own = CLASSES - CLUSTERS - 1
    rest = order[own:]
    centre = shares[rest[:CLUSTERS]].copy()
    for _ in range(8):
        near = (shares[rest] @ centre.T - (centre**2).sum(axis=1) / 2).argmax(axis=1)
        for k in range(CLUSTERS):
            inside = rest[near == k]
            if counts[inside].sum():
                centre[k] = (counts[inside, None] * shares[inside]).sum(axis=0) / counts[inside].sum()
    out[rest] = near
    out[order[:own]] = CLUSTERS + np.arange(own)
    out[size] = CLASSES - 1
    return out


def tables(pairs: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log shares of classes after each group (natural), and of ids within their class after it (base 10, flat)."""
    by_class = np.zeros((GROUPS, CLASSES))
    for k in range(CLASSES):
        by_class[:, k] = pairs[:, classes == k].sum(axis=1)
    total = by_class.sum(axis=0)
    prior = (total + 0.5) / (total + 0.5).sum()
    two = np.log((by_class + SMOOTH * prior) / (by_class.sum(axis=1, keepdims=True) + SMOOTH))
    members, counts = np.bincount(classes, minlength=CLASSES), pairs.sum(axis=0)
    share = (counts + 0.1) / (total[classes] + 0.1 * members[classes])
    inside = np.log10((pairs + SMOOTH * share) / (by_class[:, classes] + SMOOTH))
    return two.astype(np.float32), inside.astype(np.float16).ravel()


def between_ends(flat: np.ndarray, edges: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' ids with an end before and behind each, and where each begins."""
    n = np.diff(edges)
    first = edges[:-1] + 2 * np.arange(len(n))
    out = np.full(len(flat) + 2 * len(n), end, np.int64)
    out[np.arange(len(flat)) + np.repeat(2 * np.arange(len(n)) + 1, n)] = flat
    return out, np.append(first, len(out))


class Windows:
    """Windows over documents: the groups of inputs (windows, CONTEXT + STRIDE), classes of targets, and masks."""

    def __init__(self, flat: np.ndarray, edges: np.ndarray, classes: np.ndarray, groups: np.ndarray) -> None:
        """flat, edges: as between_ends gives them."""
        first, lengths = edges[:-1], np.diff(edges) - 1  # ids to score
        many = -(-lengths // STRIDE)
        self.doc = np.repeat(np.arange(len(first)), many)
        block = np.arange(len(self.doc)) - np.repeat(np.cumsum(many) - many, many)
        # room before the first text and behind the last one, so that no window leaves the arrays
        self.start = first[self.doc] + block * STRIDE + CONTEXT
        self.begin, self.end = first[self.doc] + CONTEXT, first[self.doc] + lengths[self.doc] + CONTEXT
        self.flat, self.group = (np.concatenate([np.zeros(CONTEXT, x.dtype), x[flat], np.zeros(STRIDE + 1, x.dtype)]) for x in (classes, groups))

    def take(self, which) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, whether they are seen, groups before the targets, targets, whether they count. What isn't seen or doesn't
        count is of another text."""
        at = self.start[which][:, None] + _PLACES
        seen = (at >= self.begin[which][:, None]) & (at < self.end[which][:, None])
        x, to = self.group[at], at[:, CONTEXT:] + 1
        return x, seen, x[:, CONTEXT:], self.flat[to], to <= self.end[which][:, None]


_PLACES = np.arange(-CONTEXT, STRIDE)
_BACK = np.arange(STRIDE)[:, None] + CONTEXT - np.arange(CONTEXT + STRIDE)[None, :]
_CAUSAL = np.where(_BACK >= 0, 0, -1000).astype(np.float32)
_BACK = np.maximum(_BACK, 0)
#: Of queries, keys beside values, relative positions, and classes.
SHAPES_OF = {"q": (GROUPS, WIDTH), "kv": (GROUPS, 2 * WIDTH), "r": (CONTEXT + STRIDE,), "w": (WIDTH, CLASSES)}
PARAMETERS = sum(int(np.prod(s)) for s in SHAPES_OF.values())


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES_OF.items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape).astype(np.float32, copy=False)
        at += n
    return out


def start() -> np.ndarray:
    rng = np.random.default_rng(11)
    return np.concatenate([(rng.normal(0, 0.3, s) if name in ("q", "kv") else rng.normal(0, 0.02, s) if name == "w" else np.zeros(s)).ravel() for name, s in SHAPES_OF.items()]).astype(np.float32)


#: Scores of the attention are held within these bounds, by what is at a place and by how far it is, so that sums stay finite.
MOST, MOST_BY_PLACE = 40.0, 10.0
_KEYS, _ONES, _SIDES = np.ones(CONTEXT + STRIDE, np.float32), np.ones(CLASSES, np.float32), np.ones(WIDTH, np.float32)
_FIRST = np.arange(BLOCK * STRIDE) * CLASSES


def ready(m: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Parameters with what all blocks of windows need of them."""
    scaled = m["q"] * np.float32(WIDTH**-0.5)
    longest = (np.square(scaled) @ _SIDES).max() * (np.square(m["kv"][:, :WIDTH]) @ _SIDES).max()
    bias = np.clip(m["r"], -MOST_BY_PLACE, MOST_BY_PLACE).take(_BACK) + _CAUSAL
    return m | {"scaled": scaled, "bias": bias, "high": longest > MOST**2, "back": np.ascontiguousarray(m["w"].T)}


def roomy(n: int, step: int = 0) -> dict[str, np.ndarray]:
    """Arrays for n windows at a time of a step of so many."""
    shapes = {"q": (STRIDE, WIDTH), "kv": (CONTEXT + STRIDE, 2 * WIDTH), "s": (STRIDE, CONTEXT + STRIDE), "ds": (STRIDE, CONTEXT + STRIDE), "h": (STRIDE, WIDTH), "z": (STRIDE, CLASSES), "after": (STRIDE, CLASSES)}
    return {name: np.empty((n, *shape), np.float32) for name, shape in shapes.items()} | {"kvq": np.zeros((step, CONTEXT + STRIDE, 3 * WIDTH), np.float32)}


def forward(m: dict[str, np.ndarray], two: np.ndarray, x: np.ndarray, seen: np.ndarray, g: np.ndarray, room: dict[str, np.ndarray] | None = None):
    """Log odds (not normalised) of the next classes and what the backward pass needs. m: parameters, at best ready(); room: arrays to
    work in, for reuse."""
    n = len(x)
    m, room = m if "bias" in m else ready(m), room or roomy(n)
    q, kv, s, h, z, after = (room[name][:n] for name in ("q", "kv", "s", "h", "z", "after"))
    m["scaled"].take(g, axis=0, out=q, mode="clip")
    m["kv"].take(x, axis=0, out=kv, mode="clip")
    k, v = kv[:, :, :WIDTH], kv[:, :, WIDTH:]
    np.matmul(q, k.transpose(0, 2, 1), out=s)
    if m["high"]:
        np.clip(s, -MOST, MOST, out=s)
    s += m["bias"]
    np.exp(s, out=s)
    for i in np.flatnonzero(~(seen[:, 0] & seen[:, -1])):  # a text's places lie in one run
        s[i] *= seen[i]
    # repeated, as numpy is slow where it does so itself along short rows
    share = np.repeat(1 / (s.reshape(-1, CONTEXT + STRIDE) @ _KEYS), WIDTH).reshape(n, STRIDE, WIDTH)
    np.matmul(s, v, out=h)
    h *= share
    np.matmul(h, m["w"], out=z)  # window by window: the library is quicker with small products than with one long one
    two.take(g, axis=0, out=after, mode="clip")
    z += after
    return z, (q, k, v, s, share, h)


def log_probs(m: dict[str, np.ndarray], two: np.ndarray, windows: Windows) -> np.ndarray:
    """Sum of the natural logs of the class probabilities in each window."""
    out, room, m = np.empty(len(windows.doc)), roomy(BLOCK), ready(m)
    for low in range(0, len(out), BATCH):
        x, seen, g, y, counts = windows.take(slice(low, low + BATCH))
        for at in range(0, len(x), BLOCK):
            own = slice(at, at + BLOCK)
            z, _ = forward(m, two, x[own], seen[own], g[own], room)
            odds = z.ravel().take(_FIRST[: len(z) * STRIDE] + y[own].ravel())
            np.exp(z, out=z)
            odds -= np.log(z.reshape(-1, CLASSES) @ _ONES)
            out[low + at : low + at + len(z)] = (odds.reshape(-1, STRIDE) * counts[own]).sum(axis=1)
    return out


def by_group(index: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of rows (an even number of columns) by their group. Two columns go as one complex number, as reduceat takes as long for
    each column, whatever it holds."""
    order = np.argsort(index, kind="stable")
    index = index.take(order)
    first = np.flatnonzero(np.append(True, index[1:] != index[:-1]))
    out = np.zeros((GROUPS, rows.shape[1]), np.float32)
    out[index[first]] = np.add.reduceat(rows.take(order, axis=0).view(np.complex64), first, axis=0).view(np.float32)
    return out


def gradient(m: dict[str, np.ndarray], two: np.ndarray, x, seen, g, y, counts, room: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """Of the mean loss of the ids that count, by all parameters in turn."""
    m, room = ready(m), room or roomy(BLOCK, len(x))
    kvq = room["kvq"][: len(x)]  # inputs that only are context have no queries: zeros
    weight = counts * np.float32(1 / max(1, np.count_nonzero(counts)))
    dw, dr = np.zeros((WIDTH, CLASSES), np.float32), np.zeros(STRIDE * (CONTEXT + STRIDE), np.float32)
    for low in range(0, len(x), BLOCK):
        own = slice(low, low + BLOCK)
        z, (q, k, v, s, share, h) = forward(m, two, x[own], seen[own], g[own], room)
        n, wide = len(z), z.reshape(-1, CLASSES)
        np.exp(z, out=z)
        # the slope of an id's loss is (z - whole at its class) / whole: the division is left to what is narrower
        whole = wide @ _ONES
        flat = z.reshape(-1)
        flat[_FIRST[: len(whole)] + y[own].ravel()] -= whole
        part = np.repeat(weight[own].ravel() / whole, WIDTH).reshape(n, STRIDE, WIDTH)
        dw += np.matmul((h * part).transpose(0, 2, 1), z).sum(axis=0)
        dh = np.matmul(z, m["back"])
        dh *= part
        dh *= share  # s isn't divided by its sums
        ds = np.matmul(dh, v.transpose(0, 2, 1), out=room["ds"][:n])
        ds -= ((dh * h).reshape(-1, WIDTH) @ _SIDES).reshape(n, STRIDE, 1)
        ds *= s
        dr += np.ones(n, np.float32) @ ds.reshape(n, -1)
        np.matmul(ds.transpose(0, 2, 1), q, out=kvq[own, :, :WIDTH])  # q is scaled already
        np.matmul(s.transpose(0, 2, 1), dh, out=kvq[own, :, WIDTH : 2 * WIDTH])
        np.matmul(ds, k, out=kvq[own, CONTEXT:, 2 * WIDTH :])
    sums = by_group(x.ravel(), kvq.reshape(-1, 3 * WIDTH))
    dr = np.bincount(_BACK.ravel(), dr, CONTEXT + STRIDE)
    return np.concatenate([(sums[:, 2 * WIDTH :] * np.float32(WIDTH**-0.5)).ravel(), sums[:, : 2 * WIDTH].ravel(), dr.astype(np.float32), dw.ravel()])


def _trained(dtype: str, model):
    """A partition's parameters after a pass over its training windows, times their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, groups, two, begun = model.value
        flat, first, second, steps, used, room = begun.copy(), np.zeros(PARAMETERS, np.float32), np.zeros(PARAMETERS, np.float32), 0, 0, roomy(BLOCK, STEP_WINDOWS)
        m = unpacked(flat)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                found = Windows(*between_ends(*from_binary(batch.column(0).slice(low, 500), dtype), len(classes) - 1), classes, groups)
                # a step has windows of many documents
                order = np.random.default_rng(steps).permutation(len(found.doc))
                for at in range(0, len(order), STEP_WINDOWS):
                    g = gradient(m, two, *found.take(order[at : at + STEP_WINDOWS]), room)
                    steps += 1
                    first += np.float32(0.1) * (g - first)
                    second += np.float32(0.01) * (g * g - second)
                    flat -= np.float32(RATE / (1 - 0.9**steps)) * first / (np.sqrt(second / np.float32(1 - 0.99**steps)) + np.float32(1e-8))
                used += len(order)
        cells = np.arange(PARAMETERS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.append(flat.astype(np.float64), 1.0) * used)], ["cell", "value"])

    return tidy(run)


def _scored(dtype: str, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, groups, inside, two, parameters = model.value
        size, m = len(classes), unpacked(parameters)
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                some = batch.slice(low, 200)
                ids, own = from_binary(some.column(2), dtype)
                flat, edges = between_ends(ids, own, size - 1)
                found = Windows(flat, edges, classes, groups)
                within = inside[groups[flat[:-1]].astype(np.int64) * size + flat[1:]].astype(np.float64)
                within[edges[1:-1] - 1] = 0  # from one text to the next
                total = np.bincount(found.doc, log_probs(m, two, found), some.num_rows) / np.log(10)
                total += np.add.reduceat(within, edges[:-1])
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(total), pa.array(np.diff(own))], ["doc_id", "code", "score", "n_subwords"])

    return tidy(run)


def model_scores(docs: DataFrame, path: str) -> DataFrame:
    """docs(doc_id, code, held_out, text) -> doc_id, code, score, n_subwords."""
    spark, size, dtype = docs.sparkSession, Subwords.of(path).size, Subwords.of(path).dtype.str
    table = saved(docs.mapInArrow(_encoded(path), "doc_id long, code long, held_out boolean, ids binary, counts binary"), "ids")
    ids = table.where("counts is null")
    train = ids.where("not held_out")

    def summed(total: np.ndarray, column: pa.Array) -> None:
        for blob in column.to_pylist():
            total += np.frombuffer(blob, np.int64)

    groups = group_of(_total(table.where("counts is not null").select("counts"), size + 1, summed), path)

    def pairs(total: np.ndarray, column: pa.Array) -> None:
        flat, edges = between_ends(*from_binary(column, dtype), size)
        inner = np.ones(len(flat), bool)
        inner[edges[1:] - 1] = False  # not from one text to the next
        inner = np.flatnonzero(inner)
        np.add.at(total, groups[flat[inner]].astype(np.int64) * (size + 1) + flat[inner + 1], 1)

    many = _total(train.select("ids"), GROUPS * (size + 1), pairs).reshape(GROUPS, size + 1)
    classes = class_of(many)
    two, inside = tables(many, classes)
    classes, groups = classes.astype(np.uint8), groups.astype(np.uint8)
    del many
    flat = start()
    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast((classes, groups, two, flat))
        rows = train.where(F.pmod(F.xxhash64("code"), F.lit(ROUNDS)) == turn).select("ids").mapInArrow(_trained(dtype, sent), "cell long, value double").groupBy("cell").agg(F.sum("value")).collect()
        mean = np.zeros(PARAMETERS + 1)
        for cell, value in rows:
            mean[cell] = value
        if mean[-1]:
            flat = (mean[:-1] / mean[-1]).astype(np.float32)
    sent = spark.sparkContext.broadcast((classes, groups, inside, two, flat))
    out = saved(ids.select("doc_id", "code", "ids").mapInArrow(_scored(dtype, sent), "doc_id long, code long, score double, n_subwords long"), "scores", small=True)
    dropped(table)
    return out


def scored(docs: DataFrame, path: str | None = None, holdout: int = 5) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_subwords.

    Learned from rows whose crc32(doc_id) mod `holdout` isn't 1. A null text is an empty one: its end alone. Repeated rows
    each get a row; an empty table gives none; without training rows counts are 0 and the model is uniform over pairs.
    """
    path = path or vocabulary_path()
    text = F.coalesce("text", F.lit(""))
    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("code"), (bucket("doc_id", holdout) == 1).alias("held_out"), text.alias("text"))
    scores = model_scores(bare, path).groupBy(F.col("doc_id").alias("id"), F.col("code").alias("of")).agg(F.min("score").alias("score"), F.min("n_subwords").alias("n_subwords"))
    base = baseline(bare)
    joined = base.join(scores, base["doc_id"].eqNullSafe(scores["id"]) & (base["code"] == scores["of"]))
    return joined.select("doc_id", (bucket("doc_id", holdout) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_subwords")
