"""Every query with an oracle against DuckDB over the smallest tables."""

import importlib.util
import os

import duckdb
import pytest

from tallyforge.operators import scoring
from tallyforge.plans.catalog import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    if name in ORACLES:
        out = duck.execute(ORACLES[name])
        names = [d[0] for d in out.description]
        assert sorted(names) == columns
        assert got == sorted((tuple(row[names.index(c)] for c in columns) for row in out.fetchall()), key=repr)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert entry.entry(spark).count() > 0
    if importlib.util.find_spec("tallyforge.llm") is None:
        assert "pipeline" not in entry.queries()


def test_mcnemar():
    assert scoring.mcnemar_p(0, 0) == 1.0
    assert scoring.mcnemar_p(1, 9) == pytest.approx(22 / 1024)


def test_exact_bootstrap_is_seeded():
    pairs = [([i % 2, 1], [1, 1]) for i in range(20)]
    assert scoring.exact_bootstrap(pairs, 5, 10) == scoring.exact_bootstrap(pairs, 5, 10)
    assert all(0 <= x <= 1 for x in scoring.exact_bootstrap(pairs, 5, 10)[0])


def test_bootstrap_covers_the_change(spark):
    names = [f"{m}_{p}" for m in scoring.METRICS for p in ("num", "den")]
    base = spark.createDataFrame([(str(i), *([0, 1] * 5)) for i in range(30)], ["example_id", *names])
    better = spark.createDataFrame([(str(i), *([1, 1] * 5)) for i in range(30)], ["example_id", *names])
    assert all(r.lower == r.upper == 1.0 for r in scoring.bootstrap(base, better, 20, "s").collect())


def test_bootstrap_against_brute_force(spark):
    import hashlib

    import numpy as np

    names = [f"{m}_{p}" for m in scoring.METRICS for p in ("num", "den")]
    table = {k: [[(i * (7 + k) + j * j) % (3 + j % 2) % 2, 1] for i in range(12) for j in range(5)] for k in (0, 1)}
    sides = [np.array(table[k]).reshape(12, 10) for k in (0, 1)]
    base, other = (spark.createDataFrame([(f"{i:02d}", *map(int, r)) for i, r in enumerate(side)], ["example_id", *names]) for side in sides)
    draws = np.array([[int(hashlib.md5(f"s1:{r}:{i}".encode()).hexdigest()[:8], 16) % 12 for i in range(12)] for r in range(2000)])
    got = {r.metric: (r.lower, r.upper) for r in scoring.bootstrap(base, other, 2000, "s1").collect()}
    assert set(got) == set(scoring.METRICS)
    for j, metric in enumerate(scoring.METRICS):
        rate = [side[draws][:, :, 2 * j].sum(axis=1) / side[draws][:, :, 2 * j + 1].sum(axis=1) for side in sides]
        assert got[metric] == pytest.approx(tuple(np.quantile(rate[1] - rate[0], [0.025, 0.975])))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_registered_bootstraps_are_whole(spark, monkeypatch):
    asked, real = [], scoring.bootstrap
    monkeypatch.setattr(scoring, "bootstrap", lambda a, b, n, *rest: asked.append(n) or real(a, b, n, *rest))
    assert {r.metric for r in QUERIES["paired_bootstrap_full"](spark, DATA).collect()} == set(scoring.METRICS)
    assert {"metric", "lower", "upper", "language"} == set(QUERIES["comparison_intervals"](spark, DATA).columns)
    assert asked == [2000, 2000]


def test_translation_audit_by_length_of_the_text(spark, tmp_path):
    texts = ["a", None, "b", "ein großes Maß " * 132 + "ß fünf " + "x" * 4, "é", "c", None, "d", "x" * 1994, "ß" * 1994 + " \u0131\ufb01", None, "\u0130stanbul"]
    spark.createDataFrame([(i, t, "src1") for i, t in enumerate(texts)], "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(map(tuple, QUERIES["translation_audit"](spark, str(tmp_path)).collect())) == sorted(con.execute(ORACLES["translation_audit"]).fetchall())


def test_mcnemar_of_many_pairs():
    from fractions import Fraction

    for first, second in ((700, 801), (1200, 1200), (0, 1500), (2000, 1000), (20_000, 20_400)):
        n, term, tail = first + second, 1, 1
        for i in range(min(first, second)):
            term = term * (n - i) // (i + 1)
            tail += term
        assert scoring.mcnemar_p(first, second) == float(min(Fraction(1), Fraction(2 * tail, 2**n)))
    assert scoring.mcnemar_p(250_000, 251_000) == pytest.approx(0.158, abs=0.001)


@pytest.mark.parametrize("prefix", ["s1:0:", "s1:1999:", "é:", "", "x" * 52])
def test_codes_are_md5(prefix):
    import hashlib

    import numpy as np

    from tallyforge.functions.draws import codes

    for n in (0, 1, 10, 101, 10_000, 20_011):
        got = [x for _, own in codes(prefix, n, 5000) for x in own.tolist()]
        assert got == [int(hashlib.md5(f"{prefix}{i}".encode()).hexdigest()[:8], 16) for i in range(n)]
    assert [first for first, _ in codes(prefix, 30_000, 15_000)] == [0, 20_000]
    assert all(own.dtype == np.uint32 for _, own in codes(prefix, 5))


def _components(spark, n, salt):
    names = [f"{m}_{p}" for m in scoring.METRICS for p in ("num", "den")]
    columns = [f"cast(pmod(xxhash64(id, {salt}, {i}), {2 + i % 3}) + {i % 2} as long) AS {c}" for i, c in enumerate(names)]
    return spark.range(n).selectExpr("concat('e', id) AS example_id", "if(id % 5 < 2, 'en', if(id = 3, null, 'fr')) AS language", *columns)


def test_bootstrap_counts_as_the_join_does(spark, monkeypatch):
    one, other = _components(spark, 300, 1), _components(spark, 290, 2)
    rows = lambda *keys: sorted(map(tuple, scoring.bootstrap(one, other, 50, "s", *keys).collect()))
    counted = rows(), rows("language")
    monkeypatch.setattr(scoring, "PAIRS_SENT", 0)
    assert counted == (rows(), rows("language")) and len(counted[0]) == 5 and len(counted[1]) == 10


def test_draws_are_no_rows(spark):
    import time

    began = time.time()
    assert scoring.bootstrap(_components(spark, 30_000, 1).select("*"), _components(spark, 30_000, 2), 2000, "s").count() == 5
    assert time.time() - began < 60
