"""Hooks for models: generation with telemetry, templates, encoders and translators that callers bring, served requests, and the
registry of a run's stages.

A model is made once in each task by a factory and called on rows in order; the clock is given, so tests can count."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.errors import EvaluationError, InputError
from tallyforge.functions.calls import canonical_json, gold_target_fault, parse_call

#: Stages of a run, in their order.
STAGES = ["prepare", "format", "analyze", "evaluate_base", "train", "evaluate_adapter", "compare"]


def decoding(temperature: float, sampled: bool, most_new_tokens: int) -> dict:
    """The settings of an evaluation, which must be deterministic; nothing is made to fit."""
    if temperature != 0.0 or sampled:
        raise EvaluationError("evaluation needs temperature 0.0 and no sampling", "Set the temperature to 0.0 and sampling to false.")
    if not isinstance(most_new_tokens, int) or isinstance(most_new_tokens, bool) or most_new_tokens <= 0:
        raise EvaluationError("the budget of new tokens must be a positive whole number")
    return {"temperature": 0.0, "do_sample": False, "max_new_tokens": most_new_tokens}


def generated(prompts: DataFrame, model: Callable[[], Callable[[str, dict], str]], settings: dict, clock: Callable[[], float] = time.monotonic) -> DataFrame:
    """prompts (ordinal, example_id, language, prompt_text, prompt_sha256) with raw_text, seconds, decoding and the parsed call.

    model() gives the function of a prompt and the settings; its first call, on the first prompt, is not timed."""
    kept = ["ordinal", "example_id", "language", "prompt_text", "prompt_sha256"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer, warm = model(), False
        for part in parts:
            rows = part.sort_values("ordinal").reset_index(drop=True)
            texts, seconds = [], []
            for prompt in rows["prompt_text"]:
                if not warm:
                    answer(prompt, settings)
                    warm = True
                began = clock()
                texts.append(answer(prompt, settings))
                seconds.append(clock() - began)
            yield rows.assign(raw_text=texts, seconds=seconds)

    schema = "ordinal long, example_id string, language string, prompt_text string, prompt_sha256 string, raw_text string, seconds double"
    rows = prompts.select(*kept).mapInPandas(run, schema)
    settled = ",".join(f'"{k}":{str(v).lower()}' for k, v in sorted(settings.items()))
    rows = rows.withColumns({"decoding": F.lit("{" + settled + "}"), "call": parse_call("raw_text")})
    return rows.select("*", "call.status", "call.name", "call.arguments").drop("call")


def generation_telemetry(rows: DataFrame, label: str) -> dict:
    """Seconds by slice and in all, from the rows' own, with the GPUs that a label names."""
    if rows.where(F.isnan("seconds") | (F.col("seconds") < 0)).limit(1).collect():
        raise EvaluationError("a call has no measurable time")
    by = {r["language"]: {"examples": r["n"], "elapsed_seconds": round(r["t"], 6), "seconds_per_example": round(r["t"] / r["n"], 6)} for r in rows.groupBy("language").agg(F.count(F.lit(1)).alias("n"), F.sum("seconds").alias("t")).collect()}
    n, total = sum(s["examples"] for s in by.values()), math.fsum(s["elapsed_seconds"] for s in by.values())
    count = label.rpartition(":")[2] if ":" in label else ""
    return {"slices": by, "total": {"examples": n, "elapsed_seconds": round(total, 6), "seconds_per_example": round(total / n, 6) if n else None}, "gpu_label": label, "gpu_count": int(count) if count.isdigit() else 1}


def templated(rows: DataFrame, renderer: Callable[[], Callable[[list[dict], bool], str]]) -> DataFrame:
    """rows (messages) with prompt_text, full_text, target_text and prompt_sha256 by a chat template that the caller brings.

    renderer() gives the function of messages and whether an answer is asked for. The prompt must be a prefix of the whole, and
    the target part of the rest; otherwise the query fails."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        render = renderer()
        for part in parts:
            whole = [[dict(m) if isinstance(m, dict) else m.asDict() for m in messages] for messages in part["messages"]]
            yield part.assign(prompt_text=[render(m[:-1], True) for m in whole], full_text=[render(m, False) for m in whole], target_text=[m[-1]["content"] for m in whole]).drop(columns=["messages"])

    columns = [f for f in rows.schema.fields if f.name != "messages"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in columns] + ["prompt_text string", "full_text string", "target_text string"])
    out = rows.select(*[f.name for f in columns], "messages").mapInPandas(run, schema)
    rest = F.substring("full_text", F.length("prompt_text") + 1, F.length("full_text"))
    fine = F.startswith("full_text", F.col("prompt_text")) & F.contains(rest, F.col("target_text"))
    return out.withColumn("full_text", F.when(fine, F.col("full_text")).otherwise(F.raise_error(F.lit("the template breaks the prompt's prefix or the target")))).withColumn("prompt_sha256", F.sha2("prompt_text", 256))


def encoded(rows: DataFrame, encoder: Callable[[], Callable[[str], list[int]]], *columns: str) -> DataFrame:
    """rows with `<column>_ids` of each text column by an encoder that the caller brings; an empty list for a text that isn't
    empty fails the query."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder()
        for part in parts:
            yield part.assign(**{f"{c}_ids": [None if t is None else list(encode(t)) for t in part[c]] for c in columns})

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + [f"{c}_ids array<int>" for c in columns])
    out = rows.mapInPandas(run, schema)
    return out.withColumns({f"{c}_ids": F.when((F.length(c) > 0) & (F.size(f"{c}_ids") == 0), F.raise_error(F.lit(f"{c}: a text encoded to no tokens")).cast("array<int>")).otherwise(F.col(f"{c}_ids")) for c in columns})


def translated_back(rows: DataFrame, model: Callable[[], Callable[[list[str]], list[str]]], column: str, out: str, batch: int = 64) -> DataFrame:
    """rows with the column `out`: a translator's answers, in batches, as many as texts and in their order."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        translate = model()
        for part in parts:
            texts = part[column].tolist()
            answers = [a for low in range(0, len(texts), batch) for a in translate(texts[low : low + batch])]
            if len(answers) != len(texts):
                raise EvaluationError("the translator must return one text for each")
            yield part.assign(**{out: answers})

    return rows.mapInPandas(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + [f"{out} string"]))


def target_faults(rows: DataFrame, column: str = "target_text") -> DataFrame:
    """example_id, fault: targets that aren't a canonical list of calls with a name and arguments alone."""
    return rows.select("example_id", gold_target_fault(column).alias("fault")).where("fault <> ''")


#: Roles of a served conversation.
ROLES = ["system", "user", "assistant", "tool"]


def served(requests: DataFrame) -> DataFrame:
    """requests (request_id, messages of role and content, tools as JSON) with `fault` (null: fine), the last user message and the
    canonical tools."""
    from tallyforge.functions.calls import parse_tools

    users = F.filter("messages", lambda m: m["role"] == "user")
    tools = parse_tools("tools")
    why = (
        F.when(F.coalesce(F.size("messages"), F.lit(0)) <= 0, "no_messages")
        .when(F.exists("messages", lambda m: ~m["role"].isin(ROLES)), "unknown_role")
        .when(F.exists("messages", lambda m: m["content"].isNull()), "no_content")
        .when(F.size(users) == 0, "no_user_message")
        .when(F.col("own.reason").isNotNull(), F.col("own.reason"))
    )
    return requests.withColumn("own", tools).withColumns({"fault": why, "query": F.try_element_at(users, F.lit(-1))["content"], "tools_json": F.col("own.tools")}).drop("own")


def responses(rows: DataFrame) -> DataFrame:
    """rows (request_id, raw_text) as answers: the raw text with its parse status and, where there is one, the call."""
    return rows.withColumn("call", parse_call("raw_text")).select("request_id", "raw_text", "call.status", "call.name", "call.arguments")


class Stages:
    """A run's stages by name: each takes the session and a dict of what earlier ones made, and returns what it makes."""

    def __init__(self, order: list[str] | None = None) -> None:
        self.order, self.functions = order or STAGES, {}

    def add(self, name: str, function: Callable) -> None:
        if name not in self.order:
            raise InputError(f"unknown stage {name}", f"One of {', '.join(self.order)}.")
        self.functions[name] = function

    def run(self, spark, record: Callable[[str, float], None] | None = None, clock: Callable[[], float] = time.monotonic) -> dict:
        """All stages in order; record(name, seconds) hears of each that succeeds. A missing stage is an error before any runs."""
        missing = [s for s in self.order if s not in self.functions]
        if missing:
            raise InputError(f"no function for stages {', '.join(missing)}")
        made: dict = {}
        for name in self.order:
            began = clock()
            made[name] = self.functions[name](spark, made)
            if record:
                record(name, clock() - began)
        return made


def canonical_messages(messages: Column) -> Column:
    """Messages as canonical JSON: the fixture template."""
    return canonical_json(F.to_json(messages))
