"""Validation, deduplication, splits and pairing on small tables."""

import pytest

from tallyforge.operators import prepare

TOOLS, ANSWERS = '[{"name":"f","description":"","parameters":{}}]', '[{"name":"f","arguments":{}}]'
RAW = "ordinal long, source_id string, language string, query string, tools string, answers string"


def test_first_failing_rule_wins(spark):
    rows = [(1, None, "x", ""), (2, "hello", "", ""), (3, "  hi  ", TOOLS, ANSWERS), (4, "hello there", "x", "y"), (5, "hello there", TOOLS, "[]"), (6, "hello there", TOOLS, ANSWERS), (7, "HELLO  there ", TOOLS, ANSWERS)]
    df = spark.createDataFrame([(o, f"s{o}", "en", q, t, a) for o, q, t, a in rows], RAW)
    got = {r.ordinal: r.reason for r in prepare.deduplicated(prepare.validated(df, 5, 20), "language").collect()}
    assert got == {1: "missing_query", 2: "missing_tools", 3: "query_too_short", 4: "invalid_tools_json", 5: "invalid_answer_shape", 6: None, 7: "duplicate_query"}


def test_drop_counts_are_zero_filled(spark):
    df = prepare.validated(spark.createDataFrame([], RAW), 1, 9)
    counts = prepare.drop_counts(df, spark.createDataFrame([("en",)], "language string")).collect()
    assert len(counts) == len(prepare.REASONS) and all(r.n == 0 for r in counts)


@pytest.mark.parametrize("seed", [1, 2, 7, 42])
def test_split_sizes_and_determinism(spark, seed):
    df = spark.range(100).selectExpr("concat('e', id) AS example_id")
    one = prepare.split(df, seed, {"train": 50, "validation": 20, "test": 10}).orderBy("example_id").collect()
    assert one == prepare.split(df.repartition(7), seed, {"train": 50, "validation": 20, "test": 10}).orderBy("example_id").collect()
    assert sorted(r.split for r in one) == ["test"] * 10 + ["train"] * 50 + ["validation"] * 20


def test_pairing_rejected_rows_do_not_take_their_root(spark):
    roots = spark.createDataFrame([("a", "train", "q1", TOOLS, ANSWERS), ("b", "test", "q2", TOOLS, ANSWERS)], "example_id string, split string, query_sha256 string, tools string, answers string")
    pairs = [(1, "1", None, "x", TOOLS, ANSWERS), (2, "2", "a", "y", "[]", ANSWERS), (3, "3", "a", "z", TOOLS, ANSWERS), (4, "4", "a", "w", TOOLS, "[]"), (5, "5", "b", "q1", TOOLS, ANSWERS), (6, "6", "b", "v", TOOLS, "[]")]
    df = spark.createDataFrame(pairs, "ordinal long, example_id string, source_example_id string, query_sha256 string, tools string, answers string")
    got = {r.ordinal: r.reason for r in prepare.paired(df, roots).collect()}
    assert got == {1: "missing_source_example", 2: "pair_tools_mismatch", 3: None, 4: "duplicate_source_example", 5: "cross_split_duplicate", 6: "pair_answers_mismatch"}


def test_require_fails_closed(spark):
    with pytest.raises(ValueError, match="no rows"):
        prepare.require(spark.range(1), "no rows wanted")
    prepare.require(spark.range(0), "fine")
