"""Language identification, toxicity and language-model scores."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyforge.llm import langid, lm, toxicity

DOCS = "doc_id long, text string, lang string, source string, score double"
RNG = np.random.default_rng(2)
SOUNDS = {"en": ["th", "er", "ing", "and", "wh"], "de": ["sch", "ung", "ei", "ch", "ü"], "fr": ["eau", "oi", "é", "que", "ç"]}


def sentence(lang, n):
    return " ".join("".join(RNG.choice(SOUNDS[lang], RNG.integers(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    return [(i, sentence(lang, 40), lang, "s", None) for i, lang in enumerate(list(SOUNDS) * 60)]


def test_languages_on_held_out_rows(spark, corpus):
    rows = [*corpus, (900, None, "en", "s", None), (901, "", "en", "s", None), (902, "12 -- !!", "de", "s", None), (903, sentence("de", 20), None, None, None), (0, corpus[0][1], "en", "s", None), (904, f"{sentence('en', 30)} {sentence('fr', 20)}", "en", "s", None)]
    out = langid.identified(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    assert all(got[i].lang_pred == lang for i, _, lang, _, _ in corpus)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 902))
    assert got[903].lang_pred == "de" and 0 < got[903].score <= 1
    assert got[904].n_switches >= 1
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)


def test_no_language_is_left_out(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [f"a{i:02d}" for i in range(69)] + ["zh"]
    own = {n: [letters[i % 26] + letters[i // 26] + letters[(i * 7) % 26], letters[(i * 5) % 26] + letters[i // 26] * 2] for i, n in enumerate(names)}
    rows = [(i, " ".join(RNG.choice(own[names[i % 70]], 8)), names[i % 70], "s", None) for i in range(70 * 7)]
    out = langid.identified(spark.createDataFrame(rows, DOCS)).collect()
    right = {r.doc_id for r in out if r.lang_pred == names[r.doc_id % 70]}
    assert len(right) > 0.9 * len(rows) and {i for i in range(len(rows)) if i % 70 == 69} <= right


def test_labels_of_the_row_itself_do_not_count(spark, corpus):
    wrong = [(i, t, "fr" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, s, x) for i, t, lang, s, x in corpus]
    a = {r.doc_id: r.score for r in langid.identified(spark.createDataFrame(corpus, DOCS)).collect()}
    b = {r.doc_id: r.score for r in langid.identified(spark.createDataFrame(wrong, DOCS)).collect()}
    assert a == b


def test_language_without_anything_to_learn(spark):
    out = langid.identified(spark.createDataFrame([(1, "some words", None, None, None)], DOCS)).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)]
    assert langid.identified(spark.createDataFrame([], DOCS)).count() == 0


def test_known_language_keeps_rows_as_they_are(spark, corpus):
    rows = [*corpus[:30], (None, corpus[1][1], None, None, 2.5), (50, "???", "en", "s", None)]
    out = langid.known_language(spark.createDataFrame(rows, DOCS))
    assert out.columns == ["doc_id", "text", "lang", "source", "score"]
    assert out.count() == 31 and out.where("text = '???'").count() == 0


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    scores, moves = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3))
    both, pair = langid.forward_backward(scores, np.ones((1, 4), bool), moves)
    total, want = 0.0, np.zeros((4, 3))
    for path in np.ndindex(3, 3, 3, 3):
        p = math.exp(sum(scores[0, i, s] for i, s in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += p
        for i, s in enumerate(path):
            want[i, s] += p
    assert np.allclose(both[0], want / total) and np.isclose(pair.sum(), 3)
    assert np.allclose(langid._marginals_only(scores.astype(np.float32), np.ones((1, 4), bool), moves.astype(np.float32))[0], want / total, atol=1e-5)


def test_toxicity_on_held_out_rows(spark):
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = sentence("en", 40).split()
        if toxic:
            words[int(RNG.integers(1, 39))] = ["zargon", "zargons", "grublok!"][i % 3]
        rows.append((i, " ".join(words), "en", "s", None))
        labels.append((i, int(toxic)))
    rows += [(1000, None, "en", "s", None), (1001, "", None, None, None), (1002, "you z4rgon", "en", "s", None)]
    labels += [(3, None), (4000, 1), (0, 1)]
    out = toxicity.scored(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(out) == len(rows)
    held = [r for r in out if r.held_out and r.doc_id < 600]
    assert all(r.predicted == int(r.doc_id % 5 == 0) for r in held)
    assert {r.doc_id: r.predicted for r in out if r.doc_id >= 1000} == {1000: 0, 1001: 0, 1002: 1}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s", None)], DOCS)
    assert [r.score for r in toxicity.scored(docs, spark.createDataFrame([], "doc_id long, toxic int")).collect()] == [0.0]


def test_isotonic_is_monotone():
    x, y = np.array([1, 1, 2, 3, 4, 5.0]), np.array([0, 1, 0, 1, 1, 1.0])
    knots, values = toxicity.isotonic(x, y)
    assert (np.diff(values) > 0).all() and values[-1] == 1 and knots[0] == 1


def test_baseline_and_model(spark):
    rows = [(i, sentence("en", 30).replace("th", "Th"), "en", "s", None) for i in range(120)] + [(500, None, None, None, None), (501, "", None, None, None), (5, "same id", None, None, None), (5, "same id", None, None, None), (None, "no id", None, None, None)]
    out = lm.scored(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == len(rows)
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()), None]
    train = Counter(w for i, t, *_ in rows if zlib.crc32((str(i) if i is not None else "").encode()) % 5 != 1 for w in tokens(t))
    total, distinct = sum(train.values()), len(train)
    text = {(i, t or "") for i, t, *_ in rows}
    for r in out:
        own = [tokens(t) for i, t in text if i == r.doc_id and len(tokens(t)) == r.n_tokens][0]
        assert r.train_tokens == total and r.n_known == sum(train[w] > 0 for w in own)
        assert r.base_score == pytest.approx(sum(math.log10((train[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own))
        assert r.score < 0
    assert lm.scored(spark.createDataFrame([], DOCS)).count() == 0


def windows(docs, classes, groups):
    """Windows over documents that have an end on either side."""
    return lm.Windows(np.concatenate(docs), np.cumsum([0, *map(len, docs)]), classes, groups)


def test_each_id_is_scored_once_with_causal_masks():
    rng = np.random.default_rng(1)
    classes, groups = rng.integers(0, lm.CLASSES, 60), rng.integers(0, lm.GROUPS, 60)
    docs = [np.concatenate([[59], rng.integers(0, 59, n), [59]]) for n in (0, 1, 23, 24, 25, 130)]
    two, m = rng.normal(size=(lm.GROUPS, lm.CLASSES)).astype(np.float32), lm.unpacked(lm.start())
    found = windows(docs, classes, groups)
    x, seen, g, y, counts = found.take(np.arange(len(found.doc)))
    assert np.bincount(found.doc, counts.sum(axis=1)).tolist() == [len(d) - 1 for d in docs]
    whole = lm.log_probs(m, two, found)
    longer = windows([np.concatenate([docs[5][:-1], docs[5]])], classes, groups)
    assert np.allclose(lm.log_probs(m, two, longer)[:5], whole[found.doc == 5][:5], atol=1e-3)
    z, _ = lm.forward(m, two, x, seen, g)
    assert np.isfinite(z).all() and np.isfinite(lm.gradient(m, two, x, seen, g, y, counts)).all()


def test_gradient_against_differences():
    rng = np.random.default_rng(4)
    docs = [np.concatenate([[59], rng.integers(0, 59, 40), [59]])]
    classes, groups = rng.integers(0, lm.CLASSES, 60), rng.integers(0, lm.GROUPS, 60)
    two = rng.normal(size=(lm.GROUPS, lm.CLASSES)).astype(np.float32)
    flat = lm.start() * 2
    take = windows(docs, classes, groups)
    part = take.take(np.arange(len(take.doc)))
    g = lm.gradient(lm.unpacked(flat), two, *part)
    loss = lambda f: -lm.log_probs(lm.unpacked(f), two, take).sum() / part[-1].sum()
    for at in np.argsort(-np.abs(g))[:8]:
        step = np.zeros(len(flat), np.float32)
        step[at] = 0.05
        assert (loss(flat + step) - loss(flat - step)) / 0.1 == pytest.approx(g[at], rel=0.1, abs=2e-4)


def test_all_windows_train():
    from tallyforge.llm import subword

    path = subword.vocabulary_path()
    size, dtype = subword.Subwords.of(path).size, subword.Subwords.of(path).dtype
    classes, groups = np.zeros(size + 1, np.uint8), np.zeros(size + 1, np.uint8)
    lengths = [0, 3, 23, 24, 25, 130, 7]
    ids = [RNG.integers(0, 500, n).astype(dtype).tobytes() for n in lengths]
    model = type("Sent", (), {"value": (classes, groups, np.zeros((lm.GROUPS, lm.CLASSES), np.float32), lm.start())})
    want = sum(-(-(n + 1) // lm.STRIDE) for n in lengths)
    (out,) = lm._trained(dtype.str, model)([pa.record_batch({"ids": pa.array(ids, pa.binary())})])
    assert out.column(1)[-1].as_py() == want


def test_attention_tells_groups_apart():
    classes, groups = np.zeros(lm.GROUPS, np.int64), np.arange(lm.GROUPS)
    found = windows([np.arange(10, 40)], classes, groups)
    x, seen, *_ = found.take(np.arange(len(found.doc)))
    assert set(x[seen]) == set(range(10, 39)) and all(len(lm.unpacked(lm.start())[c]) == lm.GROUPS for c in ("q", "kv"))


def test_model_beats_shuffled_letters(spark):
    rows = [(i, sentence("en", 60), "en", "s", None) for i in range(300)]
    unseen = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 5 == 1)
    out = lm.scored(spark.createDataFrame([*rows, (unseen, "xq zvk " * 30, None, None, None)], DOCS)).collect()
    rate = {r.doc_id: r.score / r.n_subwords for r in out}
    assert rate[unseen] < np.mean([v for k, v in rate.items() if k < 300])


def test_words_of_arrow_slices():
    from tallyforge.llm.text import hashes, shingle_sets, slices, words

    texts = pa.array(["pad", "A b\tc", None, "", " a  B c\x0b", "b c", "é A b c"])[1:]
    (part,) = slices(texts)
    starts, ends, doc = words(part.data, part.at)
    assert doc.tolist() == [0, 0, 0, 3, 3, 3, 4, 4, 5, 5, 5, 5]
    h = hashes(part.data, starts, ends)
    assert h[:3].tolist() == h[3:6].tolist() == h[9:12].tolist() and h[6:8].tolist() == h[1:3].tolist()
    sets = dict(shingle_sets(texts, 3))
    assert [len(sets[i]) for i in range(6)] == [1, 0, 0, 1, 1, 2] and sets[0] == sets[3] and sets[0] in sets[5]
