"""Translation requests: prompts, digests, context budgets, responses, and retries."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.errors import InputError
from tallyforge.functions.calls import canonical
from tallyforge.functions.spans import mask_spans


def prompt(query: Column, spans: Column, target: str, feedback: Column | None = None) -> Column:
    """What a translator is told: the target, the spans to keep, why the last try was turned down, and the request."""
    keep = F.when(F.size(spans) > 0, F.concat(F.lit("Keep: "), F.array_join(spans, " | "), F.lit("\n"))).otherwise(F.lit(""))
    again = F.coalesce(F.concat(F.lit("Last time: "), feedback, F.lit("\n")), F.lit("")) if feedback is not None else F.lit("")
    return F.concat(F.lit(f"Translate into {target}.\n"), keep, again, F.lit("Request: "), query)


def request_sha256(model: Column, text: Column) -> Column:
    return F.sha2(F.concat_ws("\n", model, text), 256)


def seq2seq_input(query: Column, code: str) -> Column:
    """A seq2seq translator's input: the target's tag and the raw query; spans are only audited afterwards."""
    return F.concat(F.lit(f"<2{code}> "), query)


def conversation(query: Column, spans: Column, code: str, context: Column | None = None, feedback: Column | None = None) -> Column:
    """Messages of a chat translator, with the spans masked in the query and in the feedback: a plain translator gets the text
    with its languages; with a tool's context an instruction and a payload of untrusted data. A missing context is null."""
    said = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    masked = mask_spans(query, spans)
    if context is None:
        plain = F.to_json(F.struct(F.lit("en").alias("source_lang_code"), F.lit(code).alias("target_lang_code"), masked.alias("text"), F.lit("text").alias("type")))
        return F.array(said("user", plain))
    marks = F.array_join(F.transform(spans, lambda s, i: F.format_string("__KEEP_%04d__", i)), ", ")
    told = F.coalesce(F.concat(F.lit(" Last time: "), mask_spans(feedback, spans)), F.lit("")) if feedback is not None else F.lit("")
    system = F.concat(F.lit(f"Translate the source text into {code}. Keep: "), marks, F.lit("."), told)
    payload = F.concat(F.lit('{"semantic_context":'), context, F.lit(',"source_text":'), F.to_json(F.array(masked)).substr(F.lit(2), F.length(F.to_json(F.array(masked))) - 2), F.lit("}"))
    return F.when(context.isNotNull(), F.array(said("system", system), said("user", payload)))


def contract_sha256(model: str, interface: str, code: str, budget: int) -> str:
    """Identity of what a model family is asked: its interface, target, template and token budget."""
    templates = {"seq2seq": f"<2{code}> {{query}}", "plain": "text with languages", "instruction": "system and payload"}
    if interface not in templates:
        raise InputError(f"unknown interface {interface}", f"One of {', '.join(sorted(templates))}.")
    text = canonical({"model": model, "interface": interface, "template": templates[interface], "target": code, "max_new_tokens": budget, "placeholders": "__KEEP_0000__" if interface != "seq2seq" else None})
    return hashlib.sha256(text.encode()).hexdigest()


def within_context(rows: DataFrame, tokens: str, output: int, limit: int) -> DataFrame:
    """rows with `state`: generate, or not_generated where the prompt and the output don't fit; every row keeps its place."""
    return rows.withColumn("state", F.when(F.col(tokens) + output <= limit, "generate").otherwise("not_generated"))


def classified(responses: DataFrame) -> DataFrame:
    """responses (status, error, requested_model, returned_model, text) with `state`: error, mismatch, incomplete or complete."""
    state = (
        F.when(F.col("error").isNotNull() | (F.col("status") == "failed"), "error")
        .when(~F.col("returned_model").startswith(F.col("requested_model")), "mismatch")
        .when((F.col("status") != "completed") | (F.length(F.trim(F.coalesce("text", F.lit("")))) == 0), "incomplete")
        .otherwise("complete")
    )
    return responses.withColumn("state", state)


def retried(rows: DataFrame, translate, judge, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """(accepted, dropped) after at most `most` rounds. translate(rows with feedback) adds output; judge adds reason, null for
    accepted. Each round only takes the rows that the one before turned down. Rounds are checkpointed where the session names a
    folder for it (so a translator is never asked again), else persisted until the session's clearCache()."""
    pending, accepted = rows.withColumn("feedback", F.lit(None).cast("string")), None
    durable = rows.sparkSession.sparkContext.getCheckpointDir() is not None
    for attempt in range(1, most + 1):
        done = judge(translate(pending)).withColumn("attempt", F.lit(attempt))
        done = done.checkpoint() if durable else done.persist()
        good = done.where("reason is null")
        accepted = good if accepted is None else accepted.unionByName(good)
        pending = done.where("reason is not null")
        if attempt < most:
            pending = pending.withColumn("feedback", F.col("reason")).drop("output", "reason", "attempt")
    return accepted, pending
