"""Similarity join, decontamination, packing, search, and the pipeline."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tallyforge.llm import decontaminate, graph, jaccard, packing, subword, topk

DOCS = "doc_id long, text string, lang string, source string, class string, label long"
RNG = np.random.default_rng(9)
VOCABULARY = ["w%d" % i for i in range(400)]


def prose(n):
    return " ".join(RNG.choice(VOCABULARY, n))


def edited(text, n):
    words = text.split()
    for at in RNG.choice(len(words), n, replace=False):
        words[at] = "e%d" % RNG.integers(1 << 30)
    return " ".join(words)


def table(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "en", "s", "x", 1) for i, t in zip(ids or range(len(texts)), texts, strict=True)], DOCS)


def sets(texts, k):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        out.append({tuple(w[a : a + k]) for a in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    return out


def brute_components(texts, k, percent):
    own, up, links = sets(texts, k), list(range(len(texts))), Counter()

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(own)):
        for j in range(i):
            if own[i] and own[j] and 100 * len(own[i] & own[j]) >= percent * len(own[i] | own[j]):
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return [len(s) for s in own], [top(i) for i in range(len(own))], links


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_components_against_all_pairs(spark, k, percent):
    base = [prose(n) for n in (3, 30, 80, 200)]
    texts = [t for b in base for t in [b, b.upper(), *[edited(b, int(RNG.integers(0, 6))) for _ in range(12) if len(b) > 60]]]
    chain = [prose(120)]
    for _ in range(12):
        chain.append(edited(chain[-1], 1))
    texts += chain + [f"{base[2]} {prose(60)}" for _ in range(5)] + ["one", "one two", "ONE two", "one two three", "", None, "\n\t"] + [prose(50) for _ in range(40)]
    sizes, tops, links = brute_components(texts, k, percent)
    rows = {r.doc_id: r for r in jaccard.jaccard_components(table(spark, texts), k, percent).collect()}
    assert len(rows) == len(texts)
    assert [rows[i].n_shingles for i in range(len(texts))] == sizes
    assert [rows[i].component_id for i in range(len(texts))] == tops
    assert all(rows[i].n_links == links[i] for i in range(len(texts)))


def test_components_over_several_blocks(spark, monkeypatch):
    base = prose(150)
    texts = [edited(base, 1) for _ in range(300)] + [base]
    found = jaccard.jaccard_components(table(spark, texts), 3, 90)
    assert {r.component_id for r in found.collect()} == {0}
    assert {r.n_links for r in found.where("doc_id = 300").collect()} == {300}


def test_join_of_odd_rows(spark):
    same = prose(40)
    rows = table(spark, [same, same, same, None], [5, 5, None, None])
    got = sorted(((r.doc_id, r.component_id) for r in jaccard.jaccard_components(rows, 3, 90).collect()), key=repr)
    assert got == sorted([(5, 5), (5, 5), (None, 5), (None, None)], key=repr)
    assert jaccard.jaccard_components(table(spark, []), 3, 90).count() == 0
    long = prose(150)
    odd = table(spark, [long, long, long, edited(long, 1), long, prose(60), "", None, "", long], [3, 3, None, 4, None, 4, None, 5, 5, 3])
    kept = sorted(((r.doc_id, r.text) for r in jaccard.one_of_each(odd).collect()), key=repr)
    assert len(kept) == 5 and [t for i, t in kept if i == 3] == [long] and {(None, ""), (5, None), (5, "")} <= set(kept) and sum(i == 4 for i, _ in kept) == 1
    kept = jaccard.one_of_each(table(spark, [long, edited(long, 1), prose(40)], [9, 3, 4]))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")] and {r.doc_id for r in kept.collect()} == {3, 4}


def test_graph_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)] + [(200, 200 + i) for i in range(1, 50)]
    rows = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    by = defaultdict(set)
    for r in rows:
        by[r.label].add(r.node)
    assert sorted(map(sorted, by.values())) == [list(range(61)), [100, 101], list(range(200, 250))]


def test_decontamination_recall_and_precision(spark):
    items = [prose(int(n)) for n in RNG.integers(8, 60, 40)]
    texts, truth = [], set()
    for n in range(300):
        k = int(RNG.integers(0, 40))
        words = items[k].split()
        for _ in range(int(RNG.integers(0, len(words) // 5 + 1))):
            at = int(RNG.integers(0, len(words)))
            words[at : at + 1] = [[], ["n1"], ["n2", words[at]]][int(RNG.integers(0, 3))]
        texts.append(f"{prose(20)} {' '.join(words).title()}! {prose(20)}")
        truth.add((n, k))
    texts += [prose(200) for _ in range(100)] + [None, "", items[3][: len(items[3]) // 2]]
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (92, "two words")], "item_id long, text string")
    found = decontaminate.contaminated(table(spark, texts), bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(got & truth) >= 0.95 * len(truth)
    assert all(r.distance <= r.item_words // 5 for r in found) and max(d for d, _ in got) < 300
    clean = decontaminate.clean(table(spark, texts), bench)
    assert clean.count() == len(texts) - len({d for d, _ in got}) and len(clean.columns) == 6
    assert decontaminate.contaminated(table(spark, texts), bench.where("item_id > 89")).count() == 0


def levenshtein_prefix(item, text):
    row = list(range(len(text) + 1))
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_edit_distances_against_the_plain_recursion():
    for _ in range(40):
        item = RNG.integers(1, 6, int(RNG.integers(5, 15))).astype(np.uint64)
        text = RNG.integers(1, 6, 20).astype(np.uint64)
        far, length = decontaminate.distances(item[None], np.array([len(item)]), text[None], np.array([20]), 20)
        assert far[0] == levenshtein_prefix(item.tolist(), text.tolist())


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(subword.vocabulary_path())
    texts = [prose(int(n)) for n in RNG.integers(1, 900, 60)] + [None, "", "Ünïcode, 12 ab's <|endoftext|> É", prose(9000)]
    rows = packing.packed(table(spark, texts, [*range(62), None, 63]), keep_ids=True).collect()
    want = {i if i != 62 else None: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length and r.doc_tokens == len(want[r.doc_id])
        pieces[r.doc_id].append((r.start, r.ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {i: [x for _, ids in sorted(own) for x in ids] for i, own in pieces.items()} == want
    for own in sequences.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert sum(sum(n for _, n in own) < 2048 for own in sequences.values()) == 1
    assert packing.packed(table(spark, [])).count() == 0


def brute_scores(docs, whole):
    n, mean, df = whole
    out = np.zeros((len(docs), len(docs)))
    for i, q in enumerate(docs):
        for j, d in enumerate(docs):
            for t in set(q.tolist()):
                tf = int((d == t).sum())
                out[i, j] += np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
    return out


def brute_fill(lengths, score, window):
    """The greedy rule in plain words: (document, start, length, sequence, offset)."""
    left, out, sequence, offset, order = set(range(len(lengths))), [], 0, 0, []
    while left:
        order = [d for d in order if d in left]
        seeded, now = bool(order), order[0] if order else min(left)
        left.discard(now)
        start, opens = 0, not seeded
        while start < lengths[now]:
            n = min(window - offset, lengths[now] - start)
            out.append((now, start, n, sequence, offset))
            start, offset = start + n, offset + n
            if offset == window:
                sequence, offset, opens = sequence + 1, 0, True
        if offset == 0:
            order = []
        elif opens:
            order = sorted(left, key=lambda d: (-score[now, d], d))
    return out


def test_neighbours_and_filling_against_plain_rules():
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 60, int(n)) for n in rng.integers(1, 90, 90)]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=60)
    whole = (90, float(np.mean([len(d) for d in docs])), df)
    some = docs[20:]
    edges, lengths = np.cumsum([0, *map(len, some)]), [len(d) for d in some]
    score = packing.similarities(np.concatenate(some), edges, whole)
    assert np.allclose(score, brute_scores(some, whole), rtol=1e-4)
    assert list(packing.Filler(100).shard(lengths, score)) == brute_fill(lengths, score, 100)


def test_neighbours_share_a_window_and_the_next_shard_goes_on():
    alike = [np.concatenate([np.repeat(1000 + 4 * t + np.arange(4), 5), RNG.integers(0, 50, 40)]) for t in range(8) for _ in range(4)]
    order = [int(i) for i in RNG.permutation(32)]
    placed, filler, pieces = defaultdict(set), packing.Filler(240), []
    docs = [alike[i] for i in order]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=2000)
    edges, lengths = np.cumsum([0, *map(len, docs)]), [len(d) for d in docs]
    score = packing.similarities(np.concatenate(docs), edges, (32, 60.0, df))
    for turn in range(2):
        for d, start, length, sequence, offset in filler.shard(lengths, score):
            placed[turn, sequence].add(order[d] // 4)
            pieces.append((sequence, offset, length))
    assert np.mean([len(s) for s in placed.values()]) < 1.7
    assert sorted(pieces) == pieces and sum(n for _, _, n in pieces) == 2 * sum(lengths)  # no gap between the shards


def test_signatures_order_like_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "DOCS_A_SHARD", 12)
    rng = np.random.default_rng(3)
    own = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(60)) for t in range(12)]
    ids = [int(i) for i in rng.permutation(60)]
    texts = [own[i % 12] for i in ids] + [None, prose(900), own[0]]
    rows = packing.packed(table(spark, texts, [*ids, None, 60, 0]), window=1024, keep_ids=True).collect()
    pieces, sequences, alike = defaultdict(list), defaultdict(list), defaultdict(set)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
        alike[r.doc_id % 12 if r.doc_id is not None and r.doc_id < 60 else None].add(r.sequence_id)
    assert set(pieces) == {*range(61), None} and sum(n for _, n, _ in pieces[0]) == 2 * pieces[0][0][2]
    assert sum(sum(n for _, n in p) < 1024 for p in sequences.values()) <= 1
    assert np.mean([len(alike[t]) for t in range(12)]) < 2.5


def test_subwords_are_those_of_the_tokenizer():
    coder = subword.Subwords.of(subword.vocabulary_path())
    texts = ["Straße ÀÉ÷× naïve. x'S <|endoftext|> <|ENDOFTEXT|> a.b, ab,, 12 ﬁ", None, "", "e\u0301 E\u0301x", "ÿÿ! " * 3, "a" * 40, prose(300), "日本 слово ab\u00a0cd", "\x00 \x7f"]
    flat, edges = coder.encode(pa.array(texts), 1)
    assert [flat[a:b].tolist() for a, b in zip(edges, edges[1:])] == [[*coder.tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    assert all((a == b).all() for a, b in zip(subword.from_binary(subword.as_binary(flat, edges), coder.dtype), (flat, edges)))


def test_long_patterns_have_hashes_of_their_own():
    one, two = "a", "b"
    for _ in range(12):
        one, two = one + two, two + one
    from tallyforge.llm import text

    data = np.frombuffer(f"{one} {two}".encode(), np.uint8)
    starts, ends, _ = text.words(data, np.array([0, len(data)]))
    assert len(set(text.hashes(data, starts, ends).tolist())) == 2


def test_search_against_full_scores(spark, monkeypatch):
    texts = [prose(int(n)) for n in RNG.integers(5, 200, 230)]
    texts += [texts[0]] * 15 + [None, "", "rare unique words", texts[3].upper()]
    docs = table(spark, texts)
    asked = spark.createDataFrame([(0, texts[0]), (1, texts[3]), (2, "unique nowhere"), (3, None), (4, ""), (5, "nowhere")], "query_id long, text string")
    rows = topk.top_k(docs, asked, 10).collect()
    words = [Counter((t or "").lower().split()) for t in texts]
    n, average = len(texts), np.mean([sum(w.values()) for w in words])
    df = Counter(w for own in words for w in own)
    for q, text in ((0, texts[0]), (1, texts[3]), (2, "unique nowhere")):
        score = {}
        for i, own in enumerate(words):
            s = sum(c * np.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * own[w] * 2.2 / (own[w] + 1.2 * (0.25 + 0.75 * sum(own.values()) / average)) for w, c in Counter(text.lower().split()).items() if own[w])
            if s > 0:
                score[i] = s
        want = sorted(score, key=lambda i: (-round(score[i], 9), i))[:10]
        got = sorted((r for r in rows if r.query_id == q), key=lambda r: r["rank"])
        assert [r.doc_id for r in got] == want
        assert np.allclose([r.score for r in got], [score[i] for i in want])
    assert {r.query_id for r in rows} == {0, 1, 2}


def test_pipeline_stages(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    from tallyforge.llm.store import saved

    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        docs = saved(stage(spark, docs, data), name)
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    last = pipeline.STAGES[-1][1](spark, docs, data)
    assert last.select("doc_id").distinct().count() == before
    assert [n for n, _ in pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]
