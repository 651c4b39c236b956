"""Reports of a run: evaluations, comparisons behind an identity gate, experiments of several arms, cost evidence, provenance, and
release gates. What reaches the driver has a few rows for each slice, arm or metric."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.errors import EvaluationError, InvariantError
from tallyforge.operators import cohorts, evidence, prompts, scoring
from tallyforge.operators.secrets import require_publishable, tree_findings

from .runs import listed, tree_manifest

#: Fields that two evaluations must share to be compared.
IDENTITY = ["model_identity", "config_sha256", "split", "test_split_sha256", "parser_version", "decoding"]
PARSER = "balanced-span-v1"


def _metrics(scored: DataFrame) -> dict:
    """language (all: overall) to metric to numerator, denominator and value."""
    out: dict = {}
    for r in scoring.metrics(scored).collect():
        out.setdefault(r["language"] or "all", {})[r["metric"]] = {"numerator": r["numerator"], "denominator": r["denominator"], "value": r["value"]}
    return out


def evaluation(scored: DataFrame, root: str, slices: list[str], identity: dict, elapsed: dict[str, float] | None = None, gpus: int = 1, replicates: int = 2000) -> dict:
    """The report of one model's scored generations: ordinal, example_id, source_example_id, language, prompt_sha256, decoding,
    gold_name, gold_arguments, components. identity: model_identity, config_sha256, split and test_split_sha256."""
    kept = cohorts.test_slices(scored.withColumn("split", F.lit("test")), slices).drop("split")
    decoding = evidence.uniform(kept, "decoding")
    measured = _metrics(kept)
    digests = {r["language"]: {"examples": r["n"], "prompt_set_sha256": r["digest"]} for r in prompts.ordered_digest(kept, "prompt_sha256", "language").collect()}
    report = {**identity, "parser_version": PARSER, "decoding": decoding, "overall": measured["all"], "slices": {s: digests[s] | {"metrics": measured[s]} for s in slices}, "paired_slices": {}}
    for language in slices:
        if language != root and root in slices:
            m = cohorts.matched(kept, root, language, replicates, str(scoring.stable_seed(42, f"language-gap:{root}:{language}")))
            sides: dict = {"reference": {}, "target": {}}
            for r in m.metrics.collect():
                sides[r["side"]][r["metric"]] = r["value"]
            report["paired_slices"][language] = {"pairs": m.pairs, "coverage": m.coverage, "pair_set_sha256": m.digest, **sides, "gaps": {r["metric"]: r["gap"] for r in m.gaps.collect()}, "gap_ci95": {r["metric"]: [r["lower"], r["upper"]] for r in m.intervals.collect()}}
    for language, seconds in (elapsed or {}).items():
        wins = measured[language]["full_call_exact_match"]["numerator"]
        report["slices"][language]["gpu_seconds_per_success"] = {"available": wins > 0, "value": round(seconds * gpus / wins, 6) if wins else None, "reason": None if wins else "zero_full_call_exact_successes"}
    return report


def gate(one: dict, other: dict) -> list[str]:
    """What keeps two evaluations from being compared: identity fields, slices, their prompts, pairs, or metrics that differ."""
    out = scoring.gate(one, other, IDENTITY)
    if set(one["slices"]) != set(other["slices"]):
        return [*out, "slices"]
    for s in sorted(one["slices"]):
        out += [f"{s}.{f}" for f in ("examples", "prompt_set_sha256") if one["slices"][s][f] != other["slices"][s][f]]
        out += [f"{s}.metrics"] * (set(one["slices"][s]["metrics"]) != set(other["slices"][s]["metrics"]))
    pairs = lambda r: {k: v["pair_set_sha256"] for k, v in r["paired_slices"].items()}
    return out + ["paired_slices"] * (pairs(one) != pairs(other))


def comparison(one: dict, other: dict, intervals: dict | None = None) -> dict:
    """Changes of metrics by slice and overall, and of the gaps of matched slices; a closed gate is an error."""
    closed = gate(one, other)
    if closed:
        raise EvaluationError(f"the evaluations can't be compared: {', '.join(closed)}", "Evaluate both models on the same formatted split.")
    change = lambda a, b: {m: b[m]["value"] - a[m]["value"] for m in a}
    gaps = {k: {m: other["paired_slices"][k]["gaps"][m] - v["gaps"][m] for m in v["gaps"]} for k, v in one["paired_slices"].items()}
    return {"overall": change(one["overall"], other["overall"]), "slices": {s: change(one["slices"][s]["metrics"], other["slices"][s]["metrics"]) for s in one["slices"]}, "gap_changes": gaps, "intervals": intervals or {}}


def shared_identity(arms: dict[str, DataFrame]) -> dict:
    """The ordered ids' digest, prompts' digest and number of rows that all arms (scored generations) must share."""
    found = {}
    for name, rows in arms.items():
        if rows.groupBy("example_id").count().where("count > 1").limit(1).collect():
            raise InvariantError(f"{name}: repeated ids")
        (ids,), (texts,) = cohorts.id_digest(rows).collect(), prompts.ordered_digest(rows, "prompt_sha256").collect()
        found[name] = {"examples": ids["n"], "ids_sha256": ids["digest"], "prompts_sha256": texts["digest"]}
    first = next(iter(found.values()))
    off = [n for n, v in found.items() if v != first]
    if off or not first["examples"]:
        raise EvaluationError(f"arms differ in their cohorts: {', '.join(off) or 'no rows'}")
    return first


def experiment(arms: dict[str, DataFrame], reference: str, candidate: str, replicates: int = 2000, seed: str = "1") -> dict:
    """Several arms over one cohort: metrics of each, the candidate against every other arm by intervals, exact McNemar tests and
    claims (uplift over the reference; no loss against the rest)."""
    report = {"identity": shared_identity(arms), "arms": {n: _metrics(rows)["all"] for n, rows in arms.items()}, "against": {}}
    for name, rows in arms.items():
        if name != candidate:
            counts = scoring.discordant(rows, arms[candidate]).first()
            claimed = {r["metric"]: {"interval": [r["lower"], r["upper"]], "uplift": r["uplift"], "non_inferior": r["non_inferior"]} for r in scoring.claims(scoring.bootstrap(rows, arms[candidate], replicates, seed)).collect()}
            report["against"][name] = {"metrics": claimed, "mcnemar": {**counts.asDict(), "p_value": scoring.mcnemar_p(counts["reference_only"], counts["candidate_only"])}}
    own = report["against"][reference]["metrics"]["full_call_exact_match"]
    report["claims"] = {"uplift": own["uplift"], "non_inferior_to_all": all(v["metrics"]["full_call_exact_match"]["non_inferior"] for v in report["against"].values())}
    return report


def cost(workload: dict | None, runtime: dict, tokens_seen: int | None, adapter: dict | None, evaluations: dict[str, dict]) -> dict:
    """Bounded evidence of what a run cost: what was measured, or why it is unavailable; never a price that nobody saw."""
    none = lambda why: {"available": False, "value": None, "reason": why}
    seconds = runtime.get("stages", {}).get("train", {}).get("elapsed_seconds") if runtime.get("available") else None
    out = {
        "training_tokens": {"available": True, **workload} if workload else none("no_tokenizer_report"),
        "train_seconds": {"available": True, "value": seconds} if seconds is not None else none("train_stage_not_timed"),
        "throughput": {"available": True, "value": tokens_seen / seconds} if tokens_seen and seconds else none("tokens_seen_or_positive_elapsed_unavailable"),
        "adapter_storage": {"available": True, **adapter} if adapter else none("no_adapter_files"),
        "peak_gpu_memory_mb": {"available": True, "value": runtime["peak_gpu_memory_mb"]} if runtime.get("peak_gpu_memory_mb") else none("peak_gpu_memory_not_recorded"),
        "currency": {"available": True, "value": runtime["observed_cost_usd"]} if runtime.get("observed_cost_usd") is not None else none("no_observed_cost"),
    }
    arms = {n: {s: v.get("gpu_seconds_per_success", none("not_timed")) for s, v in e["slices"].items()} for n, e in evaluations.items()}
    prompts_of = {n: {s: v["prompt_set_sha256"] for s, v in e["slices"].items()} for n, e in evaluations.items()}
    same = len({str(sorted(p.items())) for p in prompts_of.values()}) <= 1
    return out | {"inference": arms if same else none("arms_have_other_prompts")}


def provenance(prepared: DataFrame, formatted: DataFrame, tokenized: DataFrame, expected: dict[str, int], manifests: list[dict]) -> dict:
    """Whether a run's artifacts are one full cohort by succeeded stages of one configuration; problems are listed."""
    problems = [f"{r['problem']}: {r['key']}" for r in cohorts.cohort_identity(prepared, formatted, tokenized, expected).limit(20).collect()]
    problems += [f"{m['stage']} is {m['status']}" for m in manifests if m["status"] != "succeeded"]
    problems += ["stages differ in their configuration"] * (len({m["config_sha256"] for m in manifests}) > 1)
    problems += [f"{m['run_id']} is a smoke run" for m in manifests[:1] if m["run_id"].startswith("smoke-")]
    (ids,) = cohorts.id_digest(prepared).collect()
    return {"complete": not problems, "problems": problems, "rows": ids["n"], "ids_sha256": ids["digest"]}


def released(scored: DataFrame, salt: str) -> DataFrame:
    """The rows that a release shows: a salted digest of the id, the slice, and components; no text, call or name."""
    names = [f"{m}_{p}" for m in scoring.METRICS for p in ("num", "den")]
    return scored.select("ordinal", F.sha2(F.concat(F.lit(salt + "\0"), "example_id"), 256).alias("row_id"), "language", *names)


def release_problems(rows: DataFrame, report: dict) -> list[str]:
    """Laws that released rows break, and reported metrics that their sums don't give again."""
    problems = [f"{r['example_id']}: {r['fault']}" for r in evidence.component_faults(rows.withColumnRenamed("row_id", "example_id")).limit(20).collect()]
    again = _metrics(rows)
    told = {"all": report["overall"]} | {s: v["metrics"] for s, v in report["slices"].items()}
    return problems + [f"{s}.{m}" for s, own in told.items() for m, v in own.items() if {k: again.get(s, {}).get(m, {}).get(k) for k in ("numerator", "denominator")} != {k: v[k] for k in ("numerator", "denominator")}]


def preflight(spark, folder: str | Path, gates: dict[str, Callable[[], bool | None]], certified: dict | None = None) -> dict:
    """Named gates with pass, fail or skip (None): those given, and that a tree holds no secrets, no links and no files but the
    certified ones. A failure of any fails the release."""
    folder = Path(folder)

    def clean() -> bool:
        require_publishable(tree_findings(spark, folder.resolve().as_uri()))
        return True

    every = {"no_links": lambda: bool(listed(folder)) or True, "no_secrets": clean, "certified_tree": lambda: None if certified is None else tree_manifest(folder)["sha256"] == certified["sha256"], **gates}
    results = {}
    for name, check in every.items():
        try:
            told = check()
        except Exception as error:
            results[name] = {"status": "fail", "detail": type(error).__name__}
        else:
            results[name] = {"status": "skip" if told is None else "pass" if told else "fail", "detail": ""}
    return {"status": "fail" if any(r["status"] == "fail" for r in results.values()) else "pass", "gates": results, "tree": tree_manifest(folder) if results["no_links"]["status"] == "pass" else None}


def config_digest(selection: dict) -> str:
    """sha256 of the part of a configuration that decides which rows are selected."""
    import json

    return hashlib.sha256(json.dumps(selection, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
