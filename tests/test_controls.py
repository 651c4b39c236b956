"""Selection, tokenizer rules, review, journals, hooks for models, and a run's documents on small cases."""

import io
import json
import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tallyforge import cli
from tallyforge.control import config, reports, runs
from tallyforge.errors import ConfigError, EvaluationError, InputError, InvariantError, SecurityError
from tallyforge.functions import payloads
from tallyforge.operators import cohorts, evidence, generation, journals, prepare, prompts, review, scoring, secrets, tokenization
from tallyforge.sources import records

SIZES = {"train": 5, "validation": 2, "test": 2}


@pytest.mark.parametrize("runs_of", [3, 100_000])
def test_shuffled_split_is_pythons(spark, monkeypatch, runs_of):
    real = prepare.numbered
    monkeypatch.setattr(prepare, "numbered", lambda rows, order="ordinal": real(rows, order, runs_of))
    ids = [f"e{i}" for i in range(23)]
    df = spark.createDataFrame([(i * i + 5, x) for i, x in enumerate(ids)], "ordinal long, example_id string").repartition(5)
    shuffled = list(ids)
    random.Random(42).shuffle(shuffled)
    got = {r.example_id: r.split for r in prepare.shuffled_split(df, 42, SIZES).collect()}
    assert got == dict(zip(shuffled[:9], ["train"] * 5 + ["validation"] * 2 + ["test"] * 2, strict=True))
    with pytest.raises(InputError, match="need 9, got 3"):
        prepare.shuffled_split(df.limit(3), 42, SIZES)
    with pytest.raises(InputError, match="need 9, got 3"):
        prepare.split(df.limit(3), 42, SIZES)


def test_exports_are_shuffled_as_python_does(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(12)], "doc_id long, text string")
    order = list(range(12))
    random.Random(3).shuffle(order)
    assert {r.query for r in records.exported(df, {"id": "doc_id", "query": "text"}, "d", 3, 4, "doc_id").collect()} == {f"t{i}" for i in order[:4]}


def test_selection(spark):
    rows = spark.createDataFrame([(i, f"s{i}", "en" if i % 2 else "fr", "test") for i in range(8)], "ordinal long, source_id string, language string, split string")
    ids = spark.createDataFrame([("s5",), ("s2",), ("s7",), ("s5",)], "example_id string")
    assert [r.source_id for r in cohorts.selected(rows, cohorts.selected_ids(ids), limit=2).collect()] == ["s2", "s5"]
    with pytest.raises(InputError):
        cohorts.selected_ids(ids.limit(0))
    assert cohorts.languages_kept(rows, ["en"])[1] == {"en": 4}
    with pytest.raises(InputError, match="he"):
        cohorts.languages_kept(rows, ["en", "he"])
    with pytest.raises(InputError):
        cohorts.test_slices(rows.where("split = 'x'"), ["en"])
    assert cohorts.smoke_sizes({"train": 900, "validation": 3, "test": 50}) == {"train": 100, "validation": 3, "test": 20}
    with pytest.raises(InputError):
        cohorts.split_of(spark.createDataFrame([("a", "train"), ("a", "test")], "example_id string, split string"))


COMPONENTS = ", ".join(f"{m}_{p} long" for m in scoring.METRICS for p in ("num", "den"))
SCORED = "ordinal long, example_id string, source_example_id string, language string, prompt_sha256 string, decoding string, gold_name string, gold_arguments string, " + COMPONENTS


def scored(spark, right, gold="g", pairs=range(1, 6)):
    row = lambda o, i, s, x, y: (o, i, s, x, f"p{i}", "{}", "f", gold if s else "g", *(n * z for m in scoring.METRICS for n in (y, 1) for z in [1 + (m == "argument_f1")]))
    rows = [row(i, f"e{i}", None, "en", 1) for i in range(8)] + [row(20 + i, f"f{i}", f"e{i}", "fr", int(i in right)) for i in pairs]
    return spark.createDataFrame(rows, SCORED)


def test_matched_slices(spark):
    m = cohorts.matched(scored(spark, {1, 2, 3}), "en", "fr", 20)
    assert (m.pairs, m.reference, m.target, m.coverage) == (5, 8, 5, 5 / 8)
    assert {r.metric: round(r.gap, 9) for r in m.gaps.collect()} == dict.fromkeys(scoring.METRICS, -0.4)
    assert all(r.lower <= -0.4 <= r.upper for r in m.intervals.collect())
    with pytest.raises(InvariantError, match="other_gold"):
        cohorts.matched(scored(spark, {1}, gold="h"), "en", "fr", 20)
    with pytest.raises(EvaluationError, match="missing_root"):
        cohorts.matched(scored(spark, {1}, pairs=[9]), "en", "fr", 20)


def test_evaluations_and_comparisons(spark):
    identity = {"model_identity": "m", "config_sha256": "c", "split": "test", "test_split_sha256": "t"}
    one, other = (reports.evaluation(scored(spark, right), "en", ["en", "fr"], identity, {"fr": 10.0}, 2, 20) for right in ({1}, {1, 2, 3}))
    assert one["slices"]["fr"]["gpu_seconds_per_success"]["value"] == 20.0 and one["paired_slices"]["fr"]["coverage"] == 5 / 8
    change = reports.comparison(one, other)
    assert change["slices"]["fr"]["full_call_exact_match"] == pytest.approx(0.4) and change["gap_changes"]["fr"]["argument_f1"] == pytest.approx(0.4)
    with pytest.raises(EvaluationError, match="model_identity"):
        reports.comparison(one, {**other, "model_identity": "x"})
    arms = {"base": scored(spark, {1}).where("language = 'fr'"), "plain": scored(spark, {1, 2}).where("language = 'fr'"), "new": scored(spark, {1, 2, 3, 4, 5}).where("language = 'fr'")}
    found = reports.experiment(arms, "base", "new", 50)
    assert found["identity"]["examples"] == 5 and found["against"]["base"]["mcnemar"]["candidate_only"] == 4 and found["claims"]["uplift"]
    with pytest.raises(EvaluationError, match="differ"):
        reports.experiment({**arms, "plain": arms["plain"].limit(2)}, "base", "new", 50)
    shown = reports.released(scored(spark, {1, 2}), "salt")
    whole = reports.evaluation(scored(spark, {1, 2}), "en", ["en", "fr"], identity, None, 1, 20)
    assert reports.release_problems(shown, whole) == [] and "example_id" not in shown.columns
    whole["overall"]["argument_f1"]["numerator"] += 1
    assert reports.release_problems(shown, whole) == ["all.argument_f1"]
    cost = reports.cost(None, {"available": False}, None, None, {"a": one, "b": other})
    assert not cost["currency"]["available"] and cost["inference"]["a"]["fr"]["value"] == 20.0


def test_provenance(spark):
    rows = spark.createDataFrame([(0, "a", "train"), (1, "b", "test")], "ordinal long, example_id string, split string")
    manifests = [{"stage": "prepare", "status": "succeeded", "config_sha256": "c", "run_id": "r"}]
    assert reports.provenance(rows, rows, rows, {"train": 1, "test": 1}, manifests)["complete"]
    off = reports.provenance(rows, rows.limit(1), rows, {"train": 2, "test": 1}, [{**manifests[0], "status": "failed"}])
    assert {p.split(":")[0] for p in off["problems"]} == {"not_formatted", "unknown_tokens", "size", "prepare is failed"}


def test_tokenizer_rules(spark):
    said = lambda *roles: [{"role": r, "content": "x"} for r in roles]
    rows = spark.createDataFrame([(said("system", "user"),), (said("user", "user"),), (said("system"),)], "m array<struct<role:string,content:string>>")
    assert [r[0] for r in rows.select(tokenization.user_query(F.col("m"))).collect()] == ["x", None, None]
    for bad in ((1.0, 0.0), (float("nan"), 1.0), (float("inf"), 1.0)):
        with pytest.raises(Exception, match="ratio"):
            spark.createDataFrame([bad], "a double, b double").select(tokenization.finite_ratio(F.col("a"), F.col("b"), "ratio")).collect()
    with pytest.raises(Exception, match="finite"):
        spark.createDataFrame([(float("nan"),)], "a double").select(tokenization.finite(F.col("a"), "x")).collect()


def counted(spark):
    rows = [("a", "en", None, "train", 4), ("b", "en", None, "test", 10), ("c", "fr", "a", "train", 6), ("d", "fr", "b", "test", 30)]
    return spark.createDataFrame([(*r[:4], *([r[4]] * 7), r[4] > 20) for r in rows], "example_id string, language string, source_example_id string, split string, " + ", ".join(f"{c} long" for c in prompts.COUNTS) + ", over_budget boolean")


def test_reconciled_finds_what_was_changed(spark):
    rows = tokenization.records(counted(spark), "en")
    told = tokenization.paired_summary(rows, "en")
    assert tokenization.reconciled(rows, told, "en").count() == 0
    wrong = told.withColumn("paired_total", F.when((F.col("split") == "test") & (F.col("name") == "full_tokens"), 31).otherwise(F.col("paired_total")))
    wrong = wrong.withColumn("ratio", F.when((F.col("split") == "train") & (F.col("name") == "query_tokens"), 9.0).otherwise(F.col("ratio"))).where("split is not null or name <> 'prompt_tokens'")
    assert {(r.split, r.name, r.fault) for r in tokenization.reconciled(rows, wrong, "en").collect()} == {("test", "full_tokens", "totals"), ("train", "query_tokens", "ratio"), (None, "prompt_tokens", "missing")}


def brute_balanced(candidates, dimensions, size, seed, namespace):
    target = {d: {v: size * sum(c[d] == v for c in candidates) / len(candidates) for v in {c[d] for c in candidates}} for d in dimensions}
    left, chosen = list(candidates), []
    while len(chosen) < size:
        score = lambda c: sum(max(target[d][c[d]] - sum(x[d] == c[d] for x in chosen), 0.0) / max(target[d][c[d]], 1.0) for d in dimensions)
        most = max(map(score, left))
        best = min((c for c in left if score(c) > most - 1e-12), key=lambda c: review._tie(seed, namespace, c["example_id"]))
        left.remove(best)
        chosen.append(best)
    return [c["example_id"] for c in chosen]


def test_review_sample_against_the_plain_rule(spark):
    rng = random.Random(5)
    rows = [{"example_id": f"e{i}", "split": rng.choice(["train", "test"]), "decile": str(rng.randrange(4)), "spans": str(rng.randrange(3)), "action": rng.choice("ab"), "verbs": ["pay"] if i % 7 == 0 else []} for i in range(120)]
    df = spark.createDataFrame([(*[r[d] for d in ("example_id", *review.DIMENSIONS)], r["verbs"], "q") for r in rows], "example_id string, split string, decile string, spans string, action string, verbs array<string>, query string")
    want = [*brute_balanced([r for r in rows if r["verbs"]], review.DIMENSIONS, 8, 3, "high-risk"), *brute_balanced([r for r in rows if not r["verbs"]], review.DIMENSIONS, 22, 3, "ordinary")]
    got = review.review_sample(df, 3, 30, 8)
    assert set(got) == set(want) and got == sorted(got, key=lambda i: review._tie(3, "ordered-sample", i))
    assert review.balanced([r for r in rows if r["verbs"]], review.DIMENSIONS, 8, 3, "high-risk") == want[:8]
    assert review.risk_quotas(3, 500) == (3, 197) and review.risk_quotas(100, 150) == (50, 150) and review.risk_quotas(100, 500) == (40, 160)
    with pytest.raises(InputError):
        review.review_sample(df, 3, 500, 8)
    locked = review.template(df, 3, 30, 8)
    reviews = spark.createDataFrame([(i, "pass", False, True, None) for i in got], "example_id string, meaning string, critical boolean, passes boolean, notes string")
    assert review.validated(locked, df, reviews, ["meaning"]) == []
    worse = reviews.withColumn("meaning", F.when(F.col("example_id") == got[0], "fail").otherwise(F.col("meaning")))
    assert set(review.validated({**locked, "sample_sha256": "x"}, df, worse.where(F.col("example_id") != got[1]), ["meaning"])) == {"sample_sha256 differs", f"{got[1]} isn't reviewed once", f"{got[0]}: critical_flag", "1 critical errors"}


def test_journal_evidence(spark, tmp_path):
    kinds = "ordinal long, source_id string, attempt long, call_attempt long, event string, request_sha256 string, request_bytes long, requested_model string, requested_tier string, returned_model string, returned_tier string, completed string, refused boolean, status string, replayable boolean, replay_source string, retry_scheduled boolean, backoff_seconds int, input_tokens long, cached_input_tokens long, output_tokens long, reasoning_output_tokens long, total_tokens long, body_sha256 string"
    wait = lambda o, s, k, again: (o, s, 1, k, "resource_unavailable", "r" + s, 9, "m", "flex", None, None, None, False, None, False, None, again, journals.BACKOFF[k - 1] if again else None, None, None, None, None, None, None)
    answer = lambda o, s, k: (o, s, 1, k, "response", "r" + s, 9, "m", "flex", "m", "flex", "x", False, "completed", True, None, False, None, 100, 10, 5, 0, 105, "b")
    events = spark.createDataFrame([wait(1, "a", 1, True), answer(2, "a", 2), wait(3, "b", 1, True), wait(4, "c", 1, False), (5, "d", 1, 1, "replay", "ra", 9, "m", "flex", None, None, None, False, None, False, "durable_journal", False, None, None, None, None, None, None, None)], kinds)
    assert {(r.source_id, r.state) for r in journals.availability(events).collect()} == {("a", "resolved"), ("b", "pending"), ("c", "unresolved")}
    assert [(r.ordinal, r.fault) for r in journals.backoff_faults(events).collect()] == [(4, "schedule")]
    total = journals.aggregated(events)
    row = total.first()
    assert (row.records, row.responses, row.error_records, row.usage_complete) == (5, 1, 1, False) and journals.evidence_faults(total).count() == 0
    assert journals.provider_evidence(total, "1", "0.1", "2").first().unavailable == "usage_incomplete"
    fine = journals.provider_evidence(journals.aggregated(events.where("source_id in ('a', 'd')")), "1", "0.1", "2").first()
    assert fine.unavailable is None and float(fine.list_price_usd) == pytest.approx((90 + 1 + 10) / 2 / 1e6)
    assert journals.journal_faults(events).count() == 0
    broken = events.withColumn("request_bytes", F.when(F.col("ordinal") == 2, 8).otherwise(F.col("request_bytes"))).withColumn("call_attempt", F.when(F.col("ordinal") == 2, 3).otherwise(F.col("call_attempt")))
    assert {(r.fault, r.key) for r in journals.journal_faults(broken).collect()} == {("body_size", "ra"), ("call_order", "2")}
    for _ in range(2):
        journals.appended(events, str(tmp_path / "journal"))
    assert spark.read.parquet(str(tmp_path / "journal")).count() == 10


def test_models_are_called_once_a_row(spark):
    calls = spark.sparkContext.accumulator(0)

    def model():
        def answer(prompt, settings):
            calls.add(1)
            return '{"name": "f", "arguments": {}}' if prompt == "p1" else "x"

        return answer

    ticks = iter(range(1000))
    rows = spark.createDataFrame([(i, f"e{i}", "en", f"p{i}", "h") for i in range(3)], "ordinal long, example_id string, language string, prompt_text string, prompt_sha256 string").coalesce(1)
    out = generation.generated(rows, model, generation.decoding(0.0, False, 8), lambda: float(next(ticks))).collect()
    assert [(r.status, r.seconds) for r in sorted(out)] == [("no_json", 1.0), ("ok", 1.0), ("no_json", 1.0)] and calls.value == 4  # one to warm up
    told = generation.generation_telemetry(spark.createDataFrame([("en", 1.0), ("en", 3.0), ("fr", 2.0)], "language string, seconds double"), "H100:4")
    assert told["slices"]["en"] == {"examples": 2, "elapsed_seconds": 4.0, "seconds_per_example": 2.0} and told["gpu_count"] == 4 and told["total"]["elapsed_seconds"] == 6.0
    for wrong in ((0.5, False, 8), (0.0, True, 8), (0.0, False, 0), (0.0, False, True)):
        with pytest.raises(EvaluationError):
            generation.decoding(*wrong)
    stages = generation.Stages(["a", "b"])
    stages.add("a", lambda s, made: 1)
    with pytest.raises(InputError, match="b"):
        stages.run(spark)
    stages.add("b", lambda s, made: made["a"] + 1)
    heard = []
    assert stages.run(spark, lambda name, seconds: heard.append(name)) == {"a": 1, "b": 2} and heard == ["a", "b"]
    with pytest.raises(InputError):
        stages.add("c", None)


def test_uniform_values(spark):
    rows = spark.createDataFrame([("a",), ("a",)], "x string")
    assert evidence.uniform(rows, "x") == "a"
    with pytest.raises(InvariantError):
        evidence.uniform(rows.union(spark.createDataFrame([("b",)], "x string")), "x")


def test_scans(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("MY_SECRET", "hunter2hunter2")
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.json").write_text('{"eos_token": "x", "deep": [{"password": "p"}], "hf_abcdefghijklmnopqrstuv": 1}')
    (tmp_path / "sub" / "b.md").write_text("one two hunter2hunter2\r\nghp_abcdefghijklmnopqrstuv")
    (tmp_path / "c.bin").write_text("hf_abcdefghijklmnopqrstuv")
    found = secrets.tree_findings(spark, tmp_path.as_uri())
    got = {(r.file.rpartition("/")[2], r.location, r.kind) for r in found.collect()}
    assert got == {("a.json", "deep[0].password", "sensitive_key"), ("a.json", "hf_abcdefghijklmnopqrstuv::<key>", "secret_value"), ("b.md", "line 2", "sensitive_env_value"), ("b.md", "line 3", "secret_value")}
    with pytest.raises(SecurityError, match="sensitive_key in"):
        secrets.require_publishable(found)
    assert payloads.scanned("x/tokenizer.json", '{"model": {"vocab": {"password": 1}}}', [], "") == []
    rows = spark.createDataFrame([(1, "a\r\nhf_abcdefghijklmnopqrstuv\n")], "k long, text string")
    assert [(r.line, r.kind) for r in secrets.line_findings(rows, "k").collect()] == [(2, "secret_value")]
    keys = spark.createDataFrame([("eos_token",), ("api_key",), ("total_tokens",)], "k string")
    assert [r[0] for r in keys.select(secrets.is_sensitive_key(F.col("k"))).collect()] == [False, True, False]


def test_contexts_of_tools():
    made = lambda parameters: json.loads(payloads.tool_context(json.dumps([{"name": "a", "description": "d", "parameters": parameters}]), "a") or "null")
    assert made({"type": "object"})["parameters"] == [] and made({})["parameters"] == []
    assert made({"properties": {"x": {"type": ["string", "null"]}, "b": {}}})["parameters"] == [{"name": "b", "type": "unspecified", "description": ""}, {"name": "x", "type": "null | string", "description": ""}]
    assert made({"x": {"type": 5}}) is None and made({"x": 1}) is None and made({"properties": []}) is None and made({"x": {"description": 1}}) is None


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("schema_version: tallyforge.config.v1\ndataset: {dataset_id: x, dataset_revision: r}\ndata: {n_train: 900}\n")
    loaded = config.load(path)
    assert loaded.root.language == "en" and loaded.smoke().data.n_train == 100 and loaded.digest() == config.load(path).digest()
    for text, error in (("a: 1\na: 2\n", "ValueError|Repeated"), ("nope: 1\n", "unknown"), ("data: {n_train: x}\n", "type"), ("train: {languages: [he]}\n", "languages"), ("- 1\n", "mapping")):
        path.write_text(text)
        with pytest.raises(ConfigError, match=error):
            config.load(path)
    path.write_text("name: hf_abcdefghijklmnopqrstuv\n")
    with pytest.raises(SecurityError):
        config.load(path)


def test_runs(tmp_path):
    run = runs.Run.reserve(config.Config(), tmp_path, "r1", fresh=True)
    with pytest.raises(InputError, match="exists"):
        runs.Run.reserve(config.Config(), tmp_path, "r1", fresh=True)
    run.record("prepare", ["x"], 1, [], [], note=1)
    run.record("train", ["x"], 1, [], [], error=InputError("bad hf_abcdefghijklmnopqrstuv"))
    whole = records.read_json(run.folder / "manifest.json", runs.MANIFEST)
    assert whole["status"] == "failed" and set(whole["stages"]) == {"prepare", "train"}
    assert records.read_json(run.folder / "manifest.train.json")["error_message"] == "bad [redacted]"
    run.timed("train", 1.23456, "L40S")
    assert run.timed("eval", 2, "L40S", 700)["stages"] == {"train": {"elapsed_seconds": 1.235}, "eval": {"elapsed_seconds": 2}} and run.runtime()["cost_source"] == "unavailable"
    console = io.StringIO()
    log = runs.Logger(run.folder / "logs", "r1", "train", console, lambda: datetime(2026, 1, 2, tzinfo=UTC))
    log.log("info", "start", "sk-abcdefghijklmnopqrstuv", n=1, text="ghp_abcdefghijklmnopqrstuv")
    assert runs.read_log(log.path)[0]["message"] == "[redacted]" and console.getvalue() == "[info] train:start [redacted]\n"
    with pytest.raises(InvariantError):
        log.log("info", "x", "y", n=float("nan"))
    log.path.write_text('{"a": 1}\n')
    with pytest.raises(InvariantError):
        runs.read_log(log.path)
    sent = []
    assert runs.tracked("t", [{"step": 5, "loss": 0.5, "ok": True}, {"name": "x"}], lambda v, s: sent.append((v, s))) == 1 and sent == [({"t/step": 5, "t/loss": 0.5}, 5)] and runs.tracked("t", [{"a": 1}], None) == 0
    assert runs.run_of("/x/runs/r9/data") == "r9" and runs.run_of("/x") is None and runs.run_id(datetime(2026, 1, 2, tzinfo=UTC), True).startswith("smoke-20260102T000000Z-")


def test_trees_and_gates(spark, tmp_path):
    (tmp_path / "t" / "b").mkdir(parents=True)
    (tmp_path / "t" / "b" / "x.json").write_text("{}")
    (tmp_path / "t" / "a.txt").write_text("hi")
    before, digest = runs.tree_manifest(tmp_path / "t"), runs.tree_digest(tmp_path / "t")
    assert [f["path"] for f in before["files"]] == ["a.txt", "b/x.json"] and before["total_bytes"] == 4
    told = reports.preflight(spark, tmp_path / "t", {"extra": lambda: None}, before)
    assert told["status"] == "pass" and told["gates"]["extra"]["status"] == "skip" and told["gates"]["certified_tree"]["status"] == "pass"
    (tmp_path / "t" / "a.txt").write_text("hf_abcdefghijklmnopqrstuv")
    told = reports.preflight(spark, tmp_path / "t", {}, before)
    assert {n for n, g in told["gates"].items() if g["status"] == "fail"} == {"no_secrets", "certified_tree"} and runs.tree_digest(tmp_path / "t") != digest
    (tmp_path / "t" / "link").symlink_to(tmp_path / "t" / "a.txt")
    with pytest.raises(InputError, match="link"):
        runs.tree_digest(tmp_path / "t")


def test_documents_and_lines(spark, tmp_path):
    with pytest.raises(InputError, match="exists"):
        for _ in range(2):
            records.write_small(tmp_path / "x.json", {"a": 1}, exclusive=True)
    with pytest.raises(InputError, match="outside"):
        records.reference(tmp_path / "x.json", tmp_path / "sub", "k")
    rows = spark.createDataFrame([(2, "b"), (1, "a")], "ordinal long, x string")
    records.write_one(rows, tmp_path / "one.jsonl")
    assert (tmp_path / "one.jsonl").read_text() == '{"x":"a"}\n{"x":"b"}\n'
    (tmp_path / "p.jsonl").write_text('{"source_id":"a","v":1}\n{"source_id":"a","v":2}\n{"source_id":"b","v"')
    assert [(r.source_id, r.v) for r in records.read_progress(spark, str(tmp_path / "p.jsonl"), "source_id string, v long").collect()] == [("a", 2)]
    (tmp_path / "p.jsonl").write_text('{"source_id":"a","v"\n{"source_id":"b","v":1}\n')
    with pytest.raises(InputError, match="not_json"):
        records.read_progress(spark, str(tmp_path / "p.jsonl"), "source_id string, v long")
    (tmp_path / "l.jsonl").write_text('{"a":1,"a":2}\n\n{"a":3}\n')
    assert [r.a for r in records.read_lenient(spark, str(tmp_path / "l.jsonl"), "a long").orderBy("ordinal").collect()] == [2, 3]
    (tmp_path / "l.jsonl").write_text("[1]\n")
    with pytest.raises(InputError):
        records.read_lenient(spark, str(tmp_path / "l.jsonl"), "a long")
    made = runs.write_outputs(rows, tmp_path / "out", "fr", {"rows": 2})
    assert [f["path"] for f in made["files"]] == ["rows.fr.jsonl", "summary.json"]


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "c.json").write_text('{"name": "x"}')
    assert cli.main(["config-validate", "--config", str(tmp_path / "c.json")]) == 0
    assert "config_sha256" in capsys.readouterr().out
    assert cli.main(["config-validate", "--config", str(tmp_path / "none.json")]) == 2
    assert "TF201" in capsys.readouterr().err
    tools, answers = '[{"name":"f","description":"","parameters":{}}]', '[{"name":"f","arguments":{}}]'
    lines = [{"schema_version": "v1", "source_id": f"s{i}", "query": f"call number {i}", "tools": tools, "answers": answers, "source_revision": "r"} for i in range(30)]
    (tmp_path / "rows.jsonl").write_text("\n".join(map(json.dumps, lines)))
    (tmp_path / "c.json").write_text('{"data": {"n_train": 20, "n_validation": 5, "n_test": 5}}')
    assert cli.main(["data-prepare", "--config", str(tmp_path / "c.json"), "--input", str(tmp_path / "rows.jsonl"), "--out", str(tmp_path / "data")]) == 0
    assert json.loads(capsys.readouterr().out)["dropped"]["duplicate_query"] == 0 and spark.read.parquet(str(tmp_path / "data" / "prepared")).count() == 30
    assert cli.main(["format-build", "--input", str(tmp_path / "data" / "prepared"), "--out", str(tmp_path / "formatted"), "--system", "Call."]) == 0
    assert spark.read.parquet(str(tmp_path / "formatted")).where("full_text like '%call number%'").count() == 30


def test_draws_are_verified():
    import numpy as np

    pairs = [([i % 2, 1] * 3 + [2 * (i % 2), 2] + [i % 2, 1], [1, 1] * 3 + [2, 2] + [1, 1]) for i in range(12)]
    told = dict(zip(scoring.METRICS, [list(np.quantile(m, [0.025, 0.975])) for m in scoring.exact_bootstrap(pairs, 7, 50)], strict=True))
    assert scoring.verified_bootstrap(pairs, 7, told, 50) == []
    assert scoring.verified_bootstrap(pairs, 7, told | {"argument_f1": [0.0, 0.0]}, 50) == ["argument_f1"] and len(scoring.verified_bootstrap(pairs, 8, told, 50)) > 0
    assert scoring.stable_seed(2**63 - 1, "x") == (scoring.stable_seed(0, "x") - 1) % 2**63


def test_requests_of_families(spark):
    from tallyforge.operators import requests

    rows = spark.createDataFrame([("find abc now", ["abc"], '{"n":1}', 'lost "abc"')], "q string, s array<string>, c string, f string")
    (messages,) = rows.select(requests.conversation(F.col("q"), F.col("s"), "he", F.col("c"), F.col("f")).alias("m")).first()
    assert [m.role for m in messages] == ["system", "user"] and "abc" not in messages[0].content
    assert json.loads(messages[1].content) == {"semantic_context": {"n": 1}, "source_text": "find __KEEP_0000__ now"}
    digests = {requests.contract_sha256("m", i, "fr", 9) for i in ("seq2seq", "plain", "instruction")}
    assert len(digests) == 3
    with pytest.raises(InputError):
        requests.contract_sha256("m", "x", "fr", 9)


def test_budgets_go_by_runs(spark, monkeypatch):
    from decimal import Decimal

    rows = spark.createDataFrame([(i * 3, Decimal(i % 5), Decimal(2)) for i in range(40)], "batch long, observed_usd decimal(38,9), bound_usd decimal(38,9)")
    whole = {r.batch: r.spent_before for r in journals.admitted(rows, "50").collect()}
    monkeypatch.setattr(journals, "BATCHES_A_RUN", 4)
    assert {r.batch: r.spent_before for r in journals.admitted(rows, "50").collect()} == whole == {i * 3: sum(Decimal(k % 5) for k in range(i)) for i in range(40)}


def test_files_are_identified(spark, tmp_path):
    import hashlib

    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.bin").write_bytes(b"abc")
    (row,) = records.file_identities(spark, (tmp_path).as_uri()).collect()
    assert (row.path.rpartition("/")[2], row.bytes, row.sha256) == ("x.bin", 3, hashlib.sha256(b"abc").hexdigest())
