"""Sharding, URL filters and personal data."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tallyforge.llm import hilbert, pii, urls

DOCS = "doc_id long, text string, lang string, source string, curve long"


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 3)])
def test_hilbert_curve_visits_neighbours(spark, dims, bits):
    names = ["a", "b", "c"][:dims]
    cells = spark.createDataFrame(list(itertools.product(range(1 << bits), repeat=dims)), ", ".join(f"{n} int" for n in names))
    rows = cells.withColumn("h", hilbert.hilbert_index(names, bits)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(1 << bits * dims))
    at = np.array([[r[n] for n in names] for r in rows])
    assert (np.abs(np.diff(at, axis=0)).sum(axis=1) == 1).all()


def test_shards_with_nulls_repeats_and_a_hot_source(spark):
    rows = [(i, "é" * (i % 50), "en", "hot" if i % 3 else f"s{i}", 1) for i in range(203)] + [(7, None, None, None, None), (7, None, None, None, None), (None, "", "de", "x", 0)]
    out = hilbert.hilbert_shards(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == 206
    sizes = [sum(r.shard == s for r in out) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(8):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    assert all(r.law == "rows" and r.grown_shard is None for r in out)
    one = next(r for r in out if r.doc_id == 49)
    assert (one.size, one.text_crc32) == (len("é" * 49) * 2 + 1, zlib.crc32(("é" * 49).encode()))
    assert hilbert.hilbert_shards(spark.createDataFrame([], DOCS)).count() == 0


def test_url_rules_and_list(spark):
    pages = [(1, "http://X.Example.com/en/7a"), (2, "http://example.com/en/6"), (3, "https://a.net/de/8"), (4, "https://a.example.net/de/8#x"), (5, "ftp://b.org/es/"), (6, "none"), (7, None), (8, "http://bad.io/x/?utm_a=1&b=2&a=1#f"), (9, "http://www.BAD.io:80/x?a=1&b=2"), (10, "http://bad.io/x?a=1"), (9, "http://www.BAD.io:80/x?a=1&b=2"), (11, "http://notexample.com?q"), (12, "://")]
    listed = spark.createDataFrame([("bad.io/x?a=1&b=2",), (None,), ("bad.io/x?a=1&b=2",)], "canonical string")
    rows = urls.filter_urls(spark.createDataFrame(pages, "page_id long, url string"), listed).collect()
    assert len(rows) == len(pages)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert got[1] == ("x.example.com", "/en/7a", "example.com/en/7", "allow") and got[2][2:] == ("com/en/", "block") and got[3][2:] == ("net/de/", "allow") and got[4][2:] == ("example.net/de/8", "block")
    assert got[5][2:] == ("org/es/", "block") and got[6] == got[7] == got[12] == ("", "", None, "allow")
    assert got[8][2:] == got[9][2:] == (None, "block") and got[10][2:] == (None, "allow") and got[11] == ("notexample.com", "", None, "allow")


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(500).selectExpr("concat('u', id) AS canonical")
    table = urls.bloom(keys, 64)
    assert table.count() <= 64
    from pyspark.sql import functions as F

    lost = keys.withColumns({"block": urls._block(F.col("canonical"), 64), "mask": urls._mask(F.col("canonical"))}).join(table, "block", "left").where("word is null or (word & mask) <> mask")
    assert lost.count() == 0


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            each = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            fine = {"email": lambda: True, "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")), "card": lambda d=digits, e=each: 16 <= len(d) <= 19 and sum(x // 10 + x % 10 for x in e) % 10 == 0, "phone": lambda d=digits: 8 <= len(d) <= 15}[kind]()
            if fine:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


TRICKY = ["a@b.c_x@d.e.", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (2) 3-4-5.6 7890-", "é😀 a.b@c-d.e 300.1.1.1 0001.002.3.4", "", "x" * 60_000, "9" * 60_000, ".a" * 30_000, "a@b.c " * 2_000, "a@b.c-@d.e.f", "+12 +123-456-789 012"]


def test_base_spans_against_regular_expressions(spark):
    rng = np.random.default_rng(3)
    texts = TRICKY + ["".join(rng.choice(list("ab1234567.@+- ()é5"), 80)) for _ in range(300)]
    rows = pii.find_pii(spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string")).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        want = brute((*texts, "")[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), texts[r.doc_id][:80]
        assert set(want.split(",")) - {""} <= set(r.spans.split(","))
        assert r.n_email == want.count("email:") and r.n_card == want.count("card:")


def test_em_tells_good_labelers():
    right, p = pii.em({(0, 1, 1, 1, 1, 1): 50.0, (0, -1, -1, -1, 0, -1): 50.0, (0, 1, 1, -1, 0, 1): 5.0})
    assert right[1] > 0.9 and p[(0, 1, 1, 1, 1, 1)] > 0.9 and p[(0, -1, -1, -1, 0, -1)] < 0.1


def test_redaction_keeps_all_columns_and_rows(spark):
    rows = [(1, "mail a@b.co, 1.2.3.4!", "en", 5), (1, "mail a@b.co, 1.2.3.4!", "en", 5), (2, None, None, None), (None, "clean", "de", 7)]
    out = pii.redacted(spark.createDataFrame(rows, "doc_id long, text string, email string, n_chars long"))
    assert out.columns == ["doc_id", "text", "email", "n_chars"]
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == sorted([(1, "mail [EMAIL], [IP]!", "en", 19), (1, "mail [EMAIL], [IP]!", "en", 19), (2, None, None, None), (None, "clean", "de", 7)], key=repr)


@given(st.lists(st.integers(0, 9), min_size=1, max_size=19))
def test_em_is_a_probability(digits):
    _, p = pii.em({(0, *([d % 3 - 1] * 5)): d + 1.0 for d in digits})
    assert all(0 <= x <= 1 for x in p.values())
