"""Payload scans, retries, rendered comparisons, journals and run evidence on small cases."""

from pyspark.sql import functions as F

from tallyforge.functions import payloads
from tallyforge.operators import evidence, journals, prompts, reports, requests, review, scoring, secrets


def test_payloads():
    assert payloads.findings('{"a_token": {"b": ["sk-abcdefghijklmnopqrstuv"]}, "tokens": 1}', []) == [("a_token", "sensitive_key"), ("a_token.b[0]", "secret_value")]
    assert payloads.findings("not json", []) is None
    assert payloads.without_fields('{"x": {"k": 1}, "k": [2]}', ["k"]) == '{"k":"[redacted]","x":{"k":"[redacted]"}}'
    assert payloads.tool_context('[{"name":"a"},{"name":"a"}]', "a") is None
    assert payloads.tool_context('[{"name":"a","description":"' + "x" * 9000 + '"}]', "a") is None


def test_retries_take_only_what_was_turned_down(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "yy"), ("c", "zzz")], "source_id string, query string")
    translate = lambda df: df.withColumn("output", F.concat("query", F.coalesce("feedback", F.lit(""))))
    judge = lambda df: df.withColumn("reason", F.when(F.length("output") < 3, F.lit("!")))
    accepted, dropped = requests.retried(rows, translate, judge, 2)
    assert {(r.source_id, r.attempt) for r in accepted.collect()} == {("c", 1), ("b", 2)}
    assert [(r.source_id, r.reason) for r in dropped.collect()] == [("a", "!")]


def test_rendered_comparison(spark):
    names = [f"{m}_{p}" for m in scoring.METRICS for p in ("num", "den")]
    rows = [(kind, lang, f"{lang}{i}", *([int(kind == "adapter" or i % 2), 1] * 5)) for kind in ("base", "adapter") for lang in ("en", "fr") for i in range(8)]
    page = reports.rendered("Run", reports.compared(spark.createDataFrame(rows, ["model_kind", "language", "example_id", *names]), "base", "adapter", "en", 5))
    assert "| all | full_call_exact_match | +0.5000 |" in page and "| base | fr | argument_f1 | +0.0000 |" in page


def test_journal_faults(spark):
    events = spark.createDataFrame([(1, "s", 1, 1, "resource_unavailable"), (2, "s", 1, 2, "response"), (3, "s", 1, 3, "response"), (4, "t", 2, 1, "request_error")], "ordinal long, source_id string, attempt long, call_attempt long, event string")
    got = {(r.source_id, r.attempt): (r.calls, r.state, r.broken) for r in journals.ledger(events).collect()}
    assert got == {("s", 1): (3, "resolved", True), ("t", 2): (1, "unresolved", False)}
    assert [r.source_id for r in journals.attempt_gaps(events).collect()] == ["t"]


def test_prices_round_up(spark):
    rows = spark.createDataFrame([(1, 0, 1, "flex"), (300_000, 0, 10, "default")], "input_tokens long, cached_tokens long, output_tokens long, tier string")
    got = [f"{r.cost_usd:f}" for r in journals.priced(rows, "0.001", "0", "0.001").orderBy("input_tokens").collect()]
    assert got == ["0.000000001", "0.000600015"]


def test_labels_and_batches(spark):
    rows = spark.createDataFrame([([1, 2], [1, 2, 3, 4]), ([1, 9], [1, 2, 3]), ([1], [1])], "p array<int>, f array<int>")
    assert [r[0] for r in rows.select(prompts.completion_labels(F.col("p"), F.col("f"))).collect()] == [[-100, -100, 3, 4], None, None]
    batch = spark.createDataFrame([("a", [1, 2, 3, 4], [-100, -100, -100, 4]), ("a", [1], [1])], "b string, ids array<int>, labels array<int>")
    got = {tuple(r.ids): (r.labels, r.attention_mask) for r in prompts.collated(batch, 3, "b").collect()}
    assert got == {(1, 2, 3): (None, [1, 1, 1]), (1, 0, 0): ([1, -100, -100], [1, 0, 0])}


def test_merkle_digest_depends_on_order(spark):
    rows = spark.range(10).selectExpr("id", "sha2(cast(id as string), 256) AS d")
    one = prompts.merkle_digest(rows, "d", "id", 3).first()
    assert one.n == 10 and one == prompts.merkle_digest(rows.repartition(5), "d", "id", 3).first() != prompts.merkle_digest(rows.selectExpr("9 - id AS id", "d"), "d", "id", 3).first()


def test_deciles_are_not_ntile(spark):
    rows = spark.range(23).selectExpr("id", "id div 2 AS n")
    got = [r.decile for r in review.length_decile(rows, "n", "id").orderBy("id").collect()]
    assert got == [min(10, i * 10 // 23 + 1) for i in range(23)]


def test_balanced_choice_and_reviews(spark):
    rows = [{"example_id": str(i), "a": i % 2, "b": i % 3} for i in range(60)]
    chosen = review.balanced(rows, ["a", "b"], 12)
    assert len(set(chosen)) == 12 and sum(int(i) % 2 for i in chosen) == 6
    reviews = spark.createDataFrame([("1", "pass", "fail", True, False, ""), ("2", "pass", "pass", False, True, None), ("3", "pass", "pass", True, False, "n")], "example_id string, x string, y string, critical boolean, passes boolean, notes string")
    assert {(r.example_id, r.fault) for r in review.inconsistent(reviews, ["x", "y"]).collect()} == {("1", "notes_missing"), ("3", "critical_flag")}


def test_secrets(spark):
    rows = spark.createDataFrame([(1, "a\nghp_abcdefghijklmnopqrst here hunter2hunter2\n/home/u/x")], "k long, text string")
    got = {(r.line, r.kind) for r in secrets.line_findings(rows, "k", ["hunter2hunter2"], "/home/u").collect()}
    assert got == {(2, "secret_value"), (2, "sensitive_env_value"), (3, "home_path")}
    text = rows.select(secrets.redacted(F.col("text"), ["hunter2hunter2"], "/home/u")).first()[0]
    assert text == "a\n[redacted] here [redacted]\n~/x"


def test_training_evidence(spark):
    rows = spark.createDataFrame([("r", 1, 10, None), ("r", 2, 5, 7), ("r", 3, 20, 8)], "run string, step long, tokens_seen long, peak_memory long")
    assert tuple(evidence.training_summary(rows, "run", "step").first()) == ("r", 20, 1, 8, 2)
    assert [r.peak_memory for r in evidence.last_row_memory(rows, "run", "step", "peak_memory").orderBy("step").collect()] == [None, None, 8]
