"""Command line: thin entry points over the library. `python -m tallyforge.cli --help`."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyforge.control import config as configs
from tallyforge.control import reports, runs
from tallyforge.errors import EngineError
from tallyforge.operators import cohorts, prepare, prompts, scoring, secrets, tokenization
from tallyforge.sources import records

COMMANDS: dict[str, tuple] = {}


def command(name: str, *options: str):
    """Register a command; options end with ? where they may be left out."""

    def add(function):
        COMMANDS[name] = (function, options)
        return function

    return add


def _spark() -> SparkSession:
    return SparkSession.builder.appName("tallyforge").getOrCreate()


def _read(spark: SparkSession, path: str):
    return spark.read.parquet(path)


@command("config-validate", "config")
def config_validate(o):
    return {"config_sha256": configs.load(o.config).digest()}


@command("config-resolve", "config", "out")
def config_resolve(o):
    Path(o.out).write_text(configs.load(o.config).resolved(), encoding="utf-8")
    return {"out": o.out}


@command("data-export", "input", "out", "dataset", "limit?", "seed?")
def data_export(o):
    """Rows of a table as raw JSON lines."""
    rows = _read(_spark(), o.input)
    names = {c: c for c in rows.columns}
    records.write_lines(records.exported(rows, names, o.dataset, int(o.seed or 42), int(o.limit) if o.limit else None).withColumn("ordinal", F.monotonically_increasing_id()), o.out)
    return {"out": o.out}


@command("data-prepare", "config", "input", "out")
def data_prepare(o):
    """Validated, deduplicated and split rows of the root source, and the counts of what was dropped."""
    config, spark = configs.load(o.config), _spark()
    raw, faults = records.read_raw(spark, o.input)
    prepare.require(faults, "the raw rows are faulty")
    rows = prepare.deduplicated(prepare.validated(raw.withColumn("language", F.lit(config.root.language)), config.data.min_query_chars, config.data.max_query_chars), "language").persist()
    done = prepare.shuffled_split(rows.where("reason is null").withColumn("example_id", F.col("source_id")), config.data.seed, config.data.sizes)
    done.write.mode("error").parquet(f"{o.out}/prepared")
    counts = {r["reason"]: r["n"] for r in prepare.drop_counts(rows, rows.select("language")).collect()}
    return {"dropped": counts, "splits": config.data.sizes}


@command("data-pair", "config", "input", "roots", "out")
def data_pair(o):
    config, spark = configs.load(o.config), _spark()
    raw, faults = records.read_raw(spark, o.input, paired=True)
    prepare.require(faults, "the paired rows are faulty")
    done = prepare.pair_result(raw, _read(spark, o.roots), config.data.min_query_chars, config.data.max_query_chars)
    done.write.mode("error").parquet(o.out)
    return {r["reason"] or "kept": r["count"] for r in done.groupBy("reason").count().collect()}


@command("data-select", "input", "prepared", "out", "limit?")
def data_select(o):
    spark = _spark()
    ids = cohorts.selected_ids(_read(spark, o.prepared))
    cohorts.selected(_read(spark, o.input), ids, limit=int(o.limit) if o.limit else None).write.mode("error").parquet(o.out)
    return {"out": o.out}


@command("format-build", "input", "out", "system")
def format_build(o):
    rows = _read(_spark(), o.input)
    made = prompts.rendered(rows.withColumn("messages", prompts.messages(F.col("query"), F.col("tools_json"), F.col("calls_json"), o.system)))
    made.write.mode("error").parquet(o.out)
    return {"out": o.out}


@command("analyze-tokens", "config", "input", "out")
def analyze_tokens(o):
    """Token records and summaries of formatted rows, by words."""
    config, rows = configs.load(o.config), _read(_spark(), o.input)
    languages = [s.language for s in config.datasets]
    prepare.require(tokenization.record_faults(rows, config.root.language, languages), "the formatted rows are faulty")
    counted = tokenization.records(prompts.token_counts(rows, config.train.max_sequence_length), config.root.language)
    counted.write.mode("error").parquet(f"{o.out}/records")
    tokenization.summary(counted).write.mode("error").parquet(f"{o.out}/summary")
    return {"out": o.out}


@command("eval-score", "input", "out")
def eval_score(o):
    scoring.scored(prepare.spread(_read(_spark(), o.input))).write.mode("error").parquet(o.out)
    return {"out": o.out}


@command("report-evaluate", "config", "input", "model", "out")
def report_evaluate(o):
    config, rows = configs.load(o.config), _read(_spark(), o.input)
    (ids,) = cohorts.id_digest(rows).collect()
    identity = {"model_identity": o.model, "config_sha256": config.digest(), "split": "test", "test_split_sha256": ids["digest"]}
    report = reports.evaluation(rows, config.root.language, list(config.eval.slices), identity)
    records.write_small(o.out, report)
    return {"out": o.out}


@command("report-compare", "one", "other", "out")
def report_compare(o):
    records.write_small(o.out, reports.comparison(records.read_json(o.one), records.read_json(o.other)))
    return {"out": o.out}


@command("release-scan", "folder")
def release_scan(o):
    secrets.require_publishable(secrets.tree_findings(_spark(), Path(o.folder).resolve().as_uri()))
    return {"findings": 0}


@command("release-preflight", "folder", "certified?")
def release_preflight(o):
    found = reports.preflight(_spark(), o.folder, {}, records.read_json(o.certified) if o.certified else None)
    if found["status"] == "fail":
        raise EngineError(f"gates failed: {', '.join(n for n, g in found['gates'].items() if g['status'] == 'fail')}")
    return found


@command("run-reserve", "config", "base", "id?")
def run_reserve(o):
    run = runs.Run.reserve(configs.load(o.config), o.base, o.id, fresh=True)
    return {"run_id": run.id, "folder": str(run.folder)}


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tallyforge")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, (function, options) in COMMANDS.items():
        one = sub.add_parser(name, help=function.__doc__)
        for option in options:
            one.add_argument(f"--{option.rstrip('?')}", required=not option.endswith("?"))
    chosen = parser.parse_args(arguments)
    try:
        print(json.dumps(COMMANDS[chosen.command][0](chosen), sort_keys=True, default=str))
    except EngineError as error:
        print(error.shown(), file=sys.stderr)
        return error.exit_code
    return 0


if __name__ == "__main__":
    sys.exit(main())
