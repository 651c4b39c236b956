"""What keeps the corpus operators within their limits on larger tables."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import hilbert, lm, subword, topk


def test_one_pass_over_the_documents_for_many_queries(spark, monkeypatch):
    passes = []
    plain = topk._searched
    monkeypatch.setattr(topk, "_searched", lambda *a: passes.append(1) or plain(*a))
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 50, F.lit(" x"), F.col("id") % 7).alias("text"))
    rows = topk.top_k(docs.where("doc_id < 300"), docs.withColumnRenamed("doc_id", "query_id"), 3)
    assert len(passes) == 1
    got = rows.groupBy("query_id").count().agg(F.count(F.lit(1)), F.min("count"), F.max("count")).first()
    assert tuple(got) == (6000, 3, 3)


@pytest.mark.parametrize("postings", [1, 500, 10**9])
def test_groups_find_what_full_scores_do(monkeypatch, postings):
    monkeypatch.setattr(topk, "FREQUENT", 8)
    monkeypatch.setattr(topk, "DOCS_A_GROUP", 100)
    monkeypatch.setattr(topk, "POSTINGS", postings)
    rng = np.random.default_rng(5)
    n, v = 900, 300
    rows = []
    for d in range(n):
        low = 100 * (d % 3)  # three languages that share few words
        own = sorted({*(low + (rng.pareto(0.7, int(rng.integers(0, 40))) * 3).astype(int) % 100).tolist(), *rng.integers(0, v, int(rng.integers(0, 3))).tolist()}) if d % 10 else rows[d - 1][0] if d else []
        rows.append((own, rng.integers(1, 5, len(own)).astype(float) if d % 10 or not d else rows[d - 1][1]))
    lengths = np.array([c.sum() for _, c in rows])
    lengths[10::10] = lengths[9:-1:10]  # every tenth document is a copy of the one before
    term, doc, tf = np.array([t for own, _ in rows for t in own], np.int32), np.repeat(np.arange(n), [len(own) for own, _ in rows]), np.concatenate([c for _, c in rows])
    idf = np.linspace(3, 0.2, v)
    index = topk.Groups(np.arange(n), lengths, term, doc, tf, idf, lengths.mean())
    assert len(index.shards) > 1 and sum(len(s.ids) for s in index.shards) == n
    batch = [(np.array(rows[d][0], np.int32), rows[d][1].astype(np.uint32)) for d in range(0, n, 7)] + [(np.zeros(0, np.int32), np.zeros(0, np.uint32))]
    found = [[] for _ in batch]
    index.search(batch, 10, found)
    norm = topk.K1 * (1 - topk.B + topk.B * lengths / lengths.mean())
    weight = np.zeros((n, v))
    weight[doc, term] = idf[term] * tf * (topk.K1 + 1) / (tf + norm[doc])
    for (terms, counts), best in zip(batch, found, strict=True):
        score = (weight[:, terms] * counts).sum(axis=1)
        want = sorted((-round(s, 9), i) for i, s in enumerate(score.tolist()) if s > 0)[:10]
        assert [(round(s, 9), i) for s, i in best] == want


def test_cuts_are_those_of_all_rows(spark):
    rows = spark.range(40_000).select(
        F.format_string("s%06d", F.col("id") * 7919 % 40_000).alias("source"),
        F.when(F.col("id") % 3 == 0, F.lit("")).when(F.col("id") % 3 == 1, F.lit("é")).otherwise(F.concat(F.lit("z"), F.col("id") % 100)).alias("lang"),
    )
    got = hilbert.cuts(rows, ["source", "lang"], "source")
    assert got["source"] == ["s%06d" % (40_000 * i // 16) for i in range(1, 16)]
    plain = sorted("" if i % 3 == 0 else "é" if i % 3 == 1 else f"z{i % 100}" for i in range(40_000))
    assert got["lang"] == [plain[40_000 * i // 16] for i in range(1, 16)]
    assert hilbert.cuts(rows.limit(0), ["source", "lang"], "source") == {"source": [], "lang": []}


def test_sums_by_group_are_plain_sums():
    rng = np.random.default_rng(9)
    index, rows = rng.choice([0, 3, 3, 3, 200, lm.GROUPS - 1], 5000).astype(np.uint8), rng.normal(size=(5000, 6)).astype(np.float32)
    want = np.zeros((lm.GROUPS, 6))
    np.add.at(want, index, rows)
    assert np.allclose(lm.by_group(index, rows), want, atol=1e-3)


def test_no_id_ahead_is_seen_however_it_scores():
    m = {k: v.copy() for k, v in lm.unpacked(lm.start()).items()}
    m["q"][:], m["kv"][:, : lm.WIDTH] = 1, 0
    m["kv"][7, : lm.WIDTH] = 11.5  # a score of 46
    x = np.arange(20, 20 + lm.CONTEXT + lm.STRIDE, dtype=np.uint8)[None, :].repeat(2, axis=0)
    x[0, -1] = 7
    z, _ = lm.forward(m, np.zeros((lm.GROUPS, lm.CLASSES), np.float32), x, np.ones(x.shape, bool), x[:, lm.CONTEXT :])
    assert np.allclose(z[0, :-1], z[1, :-1], atol=1e-6) and not np.allclose(z[0, -1], z[1, -1], atol=1e-3)


def test_words_are_learned_once_by_a_worker(monkeypatch):
    coder, learned = subword.Subwords.of(subword.vocabulary_path()), []
    monkeypatch.setattr(coder, "_learn", lambda *a, f=coder._learn: learned.append(len(a[3])) or f(*a))
    monkeypatch.setattr(coder, "kept", coder.kept)
    coder.forget()
    rows = pa.record_batch({"doc_id": pa.array([1]), "code": pa.array([1]), "held_out": pa.array([False]), "text": pa.array(["some words of a text"])})
    first, second = (list(lm._encoded(subword.vocabulary_path())(iter([rows]))) for _ in range(2))
    assert learned == [5] and first[0].column(3) == second[0].column(3)
    list(lm._counted(1, lambda total, column: None)(iter([])))  # the next pass
    assert coder.held == 0


def test_blocks_of_words_are_plain_counts(monkeypatch):
    import pyspark

    monkeypatch.setattr(pyspark, "TaskContext", type("Task", (), {"get": classmethod(lambda cls: cls), "partitionId": staticmethod(lambda: 1)}))
    texts = ["b a b", None, "", "a", "b  c\tA"]
    rows = pa.record_batch({"doc_id": pa.array([3, None, 5, 6, 6]), "code": pa.array(range(5)), "held_out": pa.array([False, False, True, False, True]), "text": pa.array(texts)})
    (block,) = lm._word_blocks(1)(iter([rows]))
    n, doc = (np.frombuffer(block.column(c)[0].as_py(), np.int32) for c in ("n", "doc"))
    assert sorted(zip(doc.tolist(), n.tolist(), strict=True)) == [(0, 1), (0, 1), (0, 2), (1, 1), (2, 1), (3, 1), (3, 1), (4, 1), (4, 1), (4, 1), (4, 1)]
    assert list(block.column("train")[0].as_py()) == [1, 1, 0, 1, 0]
    assert list(lm._word_blocks(1)(iter([rows.slice(0, 0)]))) == []
