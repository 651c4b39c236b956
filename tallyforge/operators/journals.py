"""Append-only journals: latest records, replay and coalescing, attempt ledgers, usage, list prices and budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Batches of a budget that are summed in one task, about.
BATCHES_A_RUN = 10_000


def latest(records: DataFrame, key: str = "source_id", order: str = "ordinal") -> DataFrame:
    """The last record of each key, by aggregation: a key with most records is no single task's."""
    fields = [c for c in records.columns if c != key]
    last = records.groupBy(key).agg(F.max_by(F.struct(*fields), order).alias("r"))
    return last.select(key, *[F.col(f"r.{c}").alias(c) for c in fields])


def reusable(rows: DataFrame, journal: DataFrame, judge=None) -> DataFrame:
    """rows (source_id, source_query_sha256, source_row_sha256, identity) with their latest outcome where all digests agree;
    others are pending (null outcome). judge(rows) gives the rows with `reason`: an outcome that isn't accepted now is pending."""
    digests = ["source_query_sha256", "source_row_sha256", "identity"]
    last = latest(journal).select("source_id", *[F.col(c).alias(f"j_{c}") for c in digests], F.col("outcome").alias("j_outcome"))
    same = F.col("j_outcome").isNotNull()
    for c in digests:
        same = same & F.equal_null(c, f"j_{c}")
    out = rows.join(last, "source_id", "left").withColumn("outcome", F.when(same, F.col("j_outcome"))).drop("j_outcome", *[f"j_{c}" for c in digests])
    if judge is None:
        return out
    return judge(out).withColumn("outcome", F.when(F.col("reason").isNull(), F.col("outcome"))).drop("reason")


def resumed(selected: DataFrame, progress: DataFrame) -> DataFrame:
    """selected (ordinal, source_id) with the fields of each one's last progress record, in their order; null where there is none."""
    return selected.join(latest(progress.withColumnRenamed("ordinal", "progress_ordinal"), "source_id", "progress_ordinal"), "source_id", "left").orderBy("ordinal")


def replays(events: DataFrame) -> DataFrame:
    """request_sha256, body_sha256, versions: the first replayable response of each request; versions over 1 is a conflict."""
    found = events.where("event = 'response' AND replayable")
    return found.groupBy("request_sha256").agg(F.min_by("body_sha256", "ordinal").alias("body_sha256"), F.count_distinct("body_sha256").alias("versions"))


def coalesced(requests: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests to make: distinct hashes without a replay; every request with `served`: replay or call)."""
    todo = requests.select("request_sha256").distinct().join(cache, "request_sha256", "left_anti")
    hit = cache.select("request_sha256", F.lit(True).alias("hit"))
    return todo, requests.join(hit, "request_sha256", "left").withColumn("served", F.when(F.col("hit"), "replay").otherwise("call")).drop("hit")


def attempt_gaps(events: DataFrame) -> DataFrame:
    """source_id, attempts, last: sources whose attempts aren't 1 to last."""
    seen = events.groupBy("source_id").agg(F.count_distinct("attempt").alias("attempts"), F.max("attempt").alias("last"), F.min("attempt").alias("first"))
    return seen.where("attempts <> last OR first <> 1").drop("first")


def ledger(events: DataFrame) -> DataFrame:
    """source_id, attempt, calls, state, broken: the calls of each attempt in order. The last event tells the state; broken if
    calls aren't numbered from 1 on or one follows a response."""
    w = Window.partitionBy("source_id", "attempt").orderBy("ordinal")
    rows = events.withColumns({"own": F.row_number().over(w), "before": F.lag("event").over(w)})
    wrong = (F.col("call_attempt") != F.col("own")) | F.coalesce(F.col("before") == "response", F.lit(False))
    out = rows.groupBy("source_id", "attempt").agg(F.count(F.lit(1)).alias("calls"), F.max_by("event", "ordinal").alias("last"), F.max(wrong).alias("broken"))
    state = F.when(F.col("last") == "response", "resolved").when(F.col("last") == "resource_unavailable", "pending").otherwise("unresolved")
    return out.select("source_id", "attempt", "calls", state.alias("state"), "broken")


def usage(events: DataFrame) -> DataFrame:
    """One row of counters and token sums over the events."""
    counts = {"responses": "event = 'response'", "replays": "event = 'replay'", "errors": "event = 'request_error'", "unavailable": "event = 'resource_unavailable'", "retries": "retry_scheduled"}
    sums = ["input_tokens", "cached_tokens", "output_tokens", "reasoning_tokens", "total_tokens"]
    return events.agg(
        F.count(F.lit(1)).alias("events"), *[F.count_if(F.expr(c)).alias(n) for n, c in counts.items()], F.count_distinct("source_id").alias("sources"), F.count_distinct("request_sha256").alias("requests"),
        F.count_distinct("returned_model").alias("models"), F.max("body_bytes").alias("most_bytes"), *[F.sum(c).alias(c) for c in sums],
    )


def usage_faults(events: DataFrame) -> DataFrame:
    """ordinal, fault: token counts that contradict each other."""
    why = (
        F.when(F.col("total_tokens") != F.col("input_tokens") + F.col("output_tokens"), "total")
        .when(F.col("cached_tokens") > F.col("input_tokens"), "cached")
        .when(F.col("reasoning_tokens") > F.col("output_tokens"), "reasoning")
    )
    return events.select("ordinal", why.alias("fault")).where("fault is not null")


def priced(events: DataFrame, input_usd: str, cached_usd: str, output_usd: str, long_from: int = 272_000) -> DataFrame:
    """events with cost_usd, decimal with 9 places, rounded up: list prices a million tokens; the flex tier halves, an input of
    more than long_from doubles the input's and raises the output's price by half."""
    per = lambda p: F.lit(p).cast("decimal(18,9)")
    tokens = lambda c: F.col(c).cast("decimal(18,0)")
    long_ = F.col("input_tokens") > long_from
    into = (tokens("input_tokens") - tokens("cached_tokens")) * per(input_usd) + tokens("cached_tokens") * per(cached_usd)
    out = tokens("output_tokens") * per(output_usd)
    whole = (into.cast("decimal(30,9)") * F.when(long_, 2).otherwise(1).cast("decimal(2,0)")).cast("decimal(32,9)") + (out.cast("decimal(30,9)") * F.when(long_, F.lit("1.5")).otherwise(F.lit("1.0")).cast("decimal(2,1)")).cast("decimal(32,9)")
    flex = F.when(F.col("tier") == "flex", F.lit("0.5")).otherwise(F.lit("1.0")).cast("decimal(2,1)")
    nano = F.ceil((whole.cast("decimal(28,9)") * flex).cast("decimal(30,10)") * F.lit(1000).cast("decimal(4,0)"))
    return events.withColumn("cost_usd", (nano.cast("decimal(28,0)") / F.lit(1_000_000_000).cast("decimal(10,0)")).cast("decimal(38,9)"))


def admitted(batches: DataFrame, limit: str) -> DataFrame:
    """batches (batch, bound_usd, observed_usd) with spent_before and `admitted`: what was spent before and the batch's bound
    stay within the limit. The running sum in the order of batches (whole numbers) goes by runs of them, so that no task holds
    them all."""
    low, high, n = batches.agg(F.min("batch"), F.max("batch"), F.count(F.lit(1))).first()
    width = max(1, ((high or 0) - (low or 0) + 1) * BATCHES_A_RUN // max(1, n))
    rows = batches.withColumn("run", F.floor((F.col("batch") - F.lit(low or 0)) / F.lit(width)))
    runs = rows.groupBy("run").agg(F.sum("observed_usd").alias("run_usd"))
    ahead = runs.select("run", F.coalesce(F.sum("run_usd").over(Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead_usd"))
    own = F.sum("observed_usd").over(Window.partitionBy("run").orderBy("batch").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("own_usd", F.coalesce(own, F.lit(0))).join(ahead, "run")
    before = (F.col("ahead_usd") + F.col("own_usd")).cast("decimal(38,9)")
    return rows.withColumn("spent_before", before).drop("run", "ahead_usd", "own_usd").withColumn("admitted", F.col("spent_before") + F.col("bound_usd") <= F.lit(limit).cast("decimal(38,9)"))


def outcomes(records: DataFrame, reasons: list[str]) -> DataFrame:
    """reason (null: accepted), rows, attempts, retried over the latest record of each source, every reason listed."""
    last = latest(records)
    found = last.groupBy("dropped").agg(F.count(F.lit(1)).alias("rows"), F.sum("attempt").alias("attempts"), F.count_if(F.expr("attempt > 1")).alias("retried"))
    every = records.sparkSession.range(1).select(F.explode(F.array(F.lit(None).cast("string"), *[F.lit(r) for r in reasons])).alias("reason"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "attempts", "retried")]
    return every.join(found, every["reason"].eqNullSafe(found["dropped"]), "left").select("reason", *zero)


#: Seconds to wait before each further call while a provider has no room.
BACKOFF = [1, 2, 4, 8, 16]
#: Counters of a journal, in the order of reports.
COUNTERS = [
    "records", "responses", "replayable_responses", "replays", "durable_journal_replays", "batch_coalesced_replays", "request_errors", "resource_unavailable_events", "resolved_resource_unavailable_events", "pending_resource_unavailable_events",
    "unresolved_resource_unavailable_events", "provider_error_responses", "error_records", "model_mismatch_responses", "service_tier_mismatch_responses", "refusal_responses", "incomplete_responses", "responses_missing_usage",
]
USAGE = ["input_tokens", "cached_input_tokens", "output_tokens", "reasoning_output_tokens", "total_tokens"]


def availability(events: DataFrame) -> DataFrame:
    """source_id, attempt, waits, state: events without room of each source attempt, and what became of them: resolved by a
    response, pending while a retry is scheduled, else unresolved."""
    calls = events.where("event in ('response', 'request_error', 'resource_unavailable')")
    by = calls.groupBy("source_id", "attempt").agg(F.count_if(F.expr("event = 'resource_unavailable'")).alias("waits"), F.max_by("event", "ordinal").alias("last"), F.max_by("retry_scheduled", "ordinal").alias("scheduled"))
    state = F.when(F.col("last") == "response", "resolved").when((F.col("last") == "resource_unavailable") & F.col("scheduled"), "pending").otherwise("unresolved")
    return by.where("waits > 0").select("source_id", "attempt", "waits", state.alias("state"))


def backoff_faults(events: DataFrame) -> DataFrame:
    """ordinal, fault: waits that the ledger of seconds doesn't allow: call k of a source attempt waits BACKOFF[k - 1] seconds and
    is tried again; behind the last of these nothing is scheduled."""
    due = F.element_at(F.array(*[F.lit(x) for x in BACKOFF]), F.least(F.col("call_attempt"), F.lit(len(BACKOFF))).cast("int"))
    again = F.col("call_attempt") <= len(BACKOFF)
    why = F.when(F.col("retry_scheduled") != again, "schedule").when(~F.col("backoff_seconds").eqNullSafe(F.when(again, due)), "seconds")
    return events.where("event = 'resource_unavailable'").select("ordinal", why.alias("fault")).where("fault is not null")


def aggregated(events: DataFrame) -> DataFrame:
    """One row: all COUNTERS, the USAGE sums, distinct identities, largest sizes and whether usage is complete.

    events: ordinal, source_id, attempt, event, request_sha256, request_bytes, requested_model, requested_tier, returned_model,
    returned_tier, completed (null: no completion), refused, status, replayable, replay_source, retry_scheduled and USAGE."""
    response, wrong_model, wrong_tier = F.col("event") == "response", F.col("returned_model") != F.col("requested_model"), F.col("returned_tier") != F.col("requested_tier")
    no_completion = F.col("completed").isNull()
    missing = F.greatest(*[F.col(c).isNull().cast("int") for c in USAGE]) == 1
    counts = {
        "records": F.lit(True), "responses": response, "replayable_responses": response & F.col("replayable"), "replays": F.col("event") == "replay",
        "durable_journal_replays": (F.col("event") == "replay") & (F.col("replay_source") == "durable_journal"), "batch_coalesced_replays": (F.col("event") == "replay") & (F.col("replay_source") == "batch_coalesced"),
        "request_errors": F.col("event") == "request_error", "resource_unavailable_events": F.col("event") == "resource_unavailable", "provider_error_responses": response & no_completion,
        "wrong": response & (no_completion | wrong_model | wrong_tier), "model_mismatch_responses": response & wrong_model, "service_tier_mismatch_responses": response & wrong_tier, "refusal_responses": response & F.col("refused"),
        "incomplete_responses": response & (F.col("status") == "incomplete"), "responses_missing_usage": response & missing,
    }
    sums = [F.coalesce(F.sum(F.when(response, F.col(c))), F.lit(0)).alias(c) for c in USAGE]
    distinct = lambda column, name: F.array_sort(F.collect_set(column)).alias(name)  # noqa: E731  a few identities
    total = events.agg(
        *[F.count_if(c).alias(n) for n, c in counts.items()], *sums, F.approx_count_distinct("request_sha256").alias("about_requests"), F.count_distinct("request_sha256").alias("unique_requests"), F.count_distinct("source_id", "attempt").alias("unique_source_attempts"),
        distinct(F.col("requested_model"), "requested_models"), distinct(F.col("requested_tier"), "requested_tiers"), distinct(F.when(response, F.col("returned_model")), "returned_models"), distinct(F.when(response, F.col("returned_tier")), "returned_tiers"),
        F.coalesce(F.max("request_bytes"), F.lit(0)).alias("most_request_bytes"), F.coalesce(F.max(F.when(response, F.col("input_tokens"))), F.lit(0)).alias("most_input_tokens"),
    ).drop("about_requests")
    waits = availability(events).agg(*[F.coalesce(F.sum(F.when(F.col("state") == s, F.col("waits"))), F.lit(0)).alias(f"{s}_resource_unavailable_events") for s in ("resolved", "pending", "unresolved")])
    out = total.join(F.broadcast(waits))  # one row each
    out = out.withColumn("error_records", F.col("wrong") + F.col("request_errors") + F.col("unresolved_resource_unavailable_events"))
    whole = (F.col("request_errors") + F.col("model_mismatch_responses") + F.col("service_tier_mismatch_responses") + F.col("responses_missing_usage") + F.col("unresolved_resource_unavailable_events")) == 0
    rest = ["unique_requests", "unique_source_attempts", "requested_models", "requested_tiers", "returned_models", "returned_tiers", "most_request_bytes", "most_input_tokens"]
    return out.withColumn("usage_complete", whole).select(*[F.col(c).cast("long").alias(c) for c in COUNTERS], *USAGE, *rest, "usage_complete")


def journal_faults(events: DataFrame) -> DataFrame:
    """fault, key: what makes a journal unfit as evidence: several requests of a source attempt, several sizes of a request's
    body, attempts with gaps, calls out of order or behind a last one, several replayable answers to a request, replays without
    one before them, and more than one requested model or tier."""
    rule = lambda name, rows, key: rows.select(F.lit(name).alias("fault"), F.col(key).cast("string").alias("key"))
    several = lambda keys, column: events.groupBy(*keys).agg(F.min(column).alias("a"), F.max(column).alias("b")).where("a <> b")
    calls = events.where("event in ('response', 'request_error', 'resource_unavailable')")
    w = Window.partitionBy("source_id", "attempt").orderBy("ordinal")
    order = calls.withColumns({"own": F.row_number().over(w), "before": F.lag("event").over(w), "scheduled_before": F.lag("retry_scheduled").over(w)})
    ended = F.col("before").isNotNull() & ~((F.col("before") == "resource_unavailable") & F.coalesce("scheduled_before", F.lit(False)))
    first = events.where("event = 'response' AND replayable").groupBy("request_sha256").agg(F.min("ordinal").alias("first"))
    early = events.where("event = 'replay'").join(first, "request_sha256", "left").where("first is null or first > ordinal")
    out = rule("several_requests", several(["source_id", "attempt"], "request_sha256"), "source_id")
    for more in (
        rule("body_size", several(["request_sha256"], "request_bytes"), "request_sha256"),
        rule("attempt_gap", attempt_gaps(events), "source_id"),
        rule("call_order", order.where((F.col("call_attempt") != F.col("own")) | ended), "ordinal"),
        rule("conflict", replays(events).where("versions > 1"), "request_sha256"),
        rule("replay_without_response", early, "ordinal"),
        rule("several_models", several([], "requested_model"), "a"),
        rule("several_tiers", several([], "requested_tier"), "a"),
    ):
        out = out.unionByName(more)
    return out


def provider_evidence(total: DataFrame, input_usd: str, cached_usd: str, output_usd: str, long_from: int = 272_000) -> DataFrame:
    """The content-free projection of aggregated(): counters, usage, and the exact list price as text with 9 places, or why there
    is none: usage_incomplete, several_tiers, long_context or no_responses."""
    why = (
        F.when(F.col("responses") == 0, "no_responses")
        .when(F.size("requested_tiers") != 1, "several_tiers")
        .when(~F.col("usage_complete"), "usage_incomplete")
        .when(F.col("most_input_tokens") > long_from, "long_context")
    )
    rows = total.withColumn("unavailable", why).withColumns({"tier": F.element_at("requested_tiers", 1), "cached_tokens": F.col("cached_input_tokens")})
    # every request is below the long-context price, so sums are priced as one event
    cost = priced(rows, input_usd, cached_usd, output_usd, 1 << 62)
    return cost.withColumn("list_price_usd", F.when(F.col("unavailable").isNull(), F.col("cost_usd").cast("string"))).drop("tier", "cached_tokens", "cost_usd")


def evidence_faults(total: DataFrame) -> DataFrame:
    """fault: laws that a summary's counters and usage must keep."""
    laws = {
        "records": "records <> responses + replays + request_errors + resource_unavailable_events", "replays": "replays <> durable_journal_replays + batch_coalesced_replays",
        "responses": "greatest(replayable_responses, provider_error_responses, model_mismatch_responses, service_tier_mismatch_responses, refusal_responses, incomplete_responses, responses_missing_usage) > responses",
        "availability": "resource_unavailable_events <> resolved_resource_unavailable_events + pending_resource_unavailable_events + unresolved_resource_unavailable_events",
        "errors": "error_records <> request_errors + responses - replayable_responses + unresolved_resource_unavailable_events", "cached": "cached_input_tokens > input_tokens", "reasoning": "reasoning_output_tokens > output_tokens", "total": "total_tokens <> input_tokens + output_tokens",
        "requests": "unique_requests > records", "attempts": "unique_source_attempts > records or (records > 0 and unique_source_attempts = 0)",
    }
    found = F.filter(F.array(*[F.when(F.expr(c), F.lit(n)) for n, c in laws.items()]), lambda x: x.isNotNull())
    return total.select(F.explode(found).alias("fault"))


def appended(events: DataFrame, path: str) -> None:
    """Add events to a journal folder; a failed job adds nothing that readers see."""
    events.write.mode("append").parquet(path)
