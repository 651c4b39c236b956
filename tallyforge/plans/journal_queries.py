"""Queries of provider journals, their evidence, telemetry and storage, with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators import evidence, journals

from . import fixtures as fx
from .queries import query

#: A provider's journal: each user is a source, three events of it one attempt, with waits, answers, replays and errors, and some
#: faults of each kind.
PROVIDER = """SELECT ordinal, source_id, attempt, call_attempt, CASE WHEN kind = 9 AND call_attempt < 3 THEN 'resource_unavailable' WHEN kind = 8 AND call_attempt = 3 THEN 'request_error' WHEN kind = 7 THEN 'replay' ELSE 'response' END AS event,
  concat('r', CAST(event_id % 701 AS STRING)) AS request_sha256, event_id % 701 + 100 AS request_bytes, 'm-1' AS requested_model, 'flex' AS requested_tier, CASE WHEN event_id % 97 = 0 THEN 'm-2' ELSE 'm-1' END AS returned_model,
  CASE WHEN event_id % 89 = 0 THEN 'default' ELSE 'flex' END AS returned_tier, CASE WHEN event_id % 13 = 0 THEN CAST(NULL AS STRING) ELSE 'text' END AS completed, event_id % 31 = 0 AS refused, CASE WHEN event_id % 37 = 0 THEN 'incomplete' ELSE 'completed' END AS status,
  event_id % 13 <> 0 AND event_id % 97 <> 0 AND event_id % 89 <> 0 AS replayable, CASE WHEN event_id % 2 = 0 THEN 'durable_journal' ELSE 'batch_coalesced' END AS replay_source, kind = 9 AND call_attempt < 3 AND event_id % 41 <> 0 AS retry_scheduled,
  CASE WHEN event_id % 43 = 0 THEN 7 WHEN kind = 9 AND call_attempt < 3 THEN call_attempt END AS backoff_seconds, CASE WHEN event_id % 211 <> 0 THEN event_id % 1001 END AS input_tokens, event_id % 1001 % 97 AS cached_input_tokens, event_id % 211 AS output_tokens,
  event_id % 211 % 13 AS reasoning_output_tokens, event_id % 1001 + event_id % 211 AS total_tokens, concat('b', CAST(event_id % 5 AS STRING)) AS body_sha256
  FROM (SELECT event_id AS ordinal, event_id, concat('s', CAST(user_id AS STRING)) AS source_id, CAST(ceil(place / 3.0) AS BIGINT) AS attempt, CAST((place - 1) % 3 + 1 AS BIGINT) AS call_attempt, (user_id + CAST(ceil(place / 3.0) AS BIGINT)) % 10 AS kind
  FROM (SELECT event_id, CAST(user_id AS BIGINT) AS user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM @events) AS placed) AS numbered"""
_P = f"p AS ({fx.plain(PROVIDER)})"
_CALLS = "c AS (SELECT * FROM p WHERE event IN ('response', 'request_error', 'resource_unavailable')), w AS (SELECT source_id, attempt, count(*) FILTER (event = 'resource_unavailable') AS waits, arg_max(event, ordinal) AS last, arg_max(retry_scheduled, ordinal) AS again FROM c GROUP BY 1, 2)"
_STATE = "CASE WHEN last = 'response' THEN 'resolved' WHEN last = 'resource_unavailable' AND again THEN 'pending' ELSE 'unresolved' END"


def _provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.view(spark, sf_dir, PROVIDER)


@query(f"WITH {_P}, {_CALLS} SELECT source_id, attempt, waits, {_STATE} AS state FROM w WHERE waits > 0")
def availability_states(spark, sf_dir):
    return journals.availability(_provider(spark, sf_dir))


@query(f"WITH {_P} SELECT ordinal, CASE WHEN NOT retry_scheduled THEN 'schedule' ELSE 'seconds' END AS fault FROM p WHERE event = 'resource_unavailable' AND (NOT retry_scheduled OR backoff_seconds IS DISTINCT FROM [1, 2, 4, 8, 16][call_attempt])")
def backoff_faults(spark, sf_dir):
    return journals.backoff_faults(_provider(spark, sf_dir))


_MISSING = "(input_tokens IS NULL OR cached_input_tokens IS NULL OR output_tokens IS NULL OR reasoning_output_tokens IS NULL OR total_tokens IS NULL)"
_TOTALS = f"""{_P}, {_CALLS}, v AS (SELECT {_STATE} AS state, sum(waits) AS n FROM w WHERE waits > 0 GROUP BY 1), z AS (SELECT count(*) AS records, count(*) FILTER (event = 'response') AS responses, count(*) FILTER (event = 'response' AND replayable) AS replayable_responses, count(*) FILTER (event = 'replay') AS replays,
  count(*) FILTER (event = 'replay' AND replay_source = 'durable_journal') AS durable_journal_replays, count(*) FILTER (event = 'replay' AND replay_source <> 'durable_journal') AS batch_coalesced_replays, count(*) FILTER (event = 'request_error') AS request_errors, count(*) FILTER (event = 'resource_unavailable') AS resource_unavailable_events,
  count(*) FILTER (event = 'response' AND completed IS NULL) AS provider_error_responses, count(*) FILTER (event = 'response' AND (completed IS NULL OR returned_model <> requested_model OR returned_tier <> requested_tier)) AS wrong, count(*) FILTER (event = 'response' AND returned_model <> requested_model) AS model_mismatch_responses,
  count(*) FILTER (event = 'response' AND returned_tier <> requested_tier) AS service_tier_mismatch_responses, count(*) FILTER (event = 'response' AND refused) AS refusal_responses, count(*) FILTER (event = 'response' AND status = 'incomplete') AS incomplete_responses, count(*) FILTER (event = 'response' AND {_MISSING}) AS responses_missing_usage,
  CAST(sum(input_tokens) FILTER (event = 'response') AS BIGINT) AS input_tokens, CAST(sum(cached_input_tokens) FILTER (event = 'response') AS BIGINT) AS cached_input_tokens, CAST(sum(output_tokens) FILTER (event = 'response') AS BIGINT) AS output_tokens, CAST(sum(reasoning_output_tokens) FILTER (event = 'response') AS BIGINT) AS reasoning_output_tokens,
  CAST(sum(total_tokens) FILTER (event = 'response') AS BIGINT) AS total_tokens, count(DISTINCT request_sha256) AS unique_requests, max(request_bytes) AS most_request_bytes, max(input_tokens) FILTER (event = 'response') AS most_input_tokens,
  list_sort(list_distinct(list(returned_model) FILTER (event = 'response'))) AS returned_models FROM p)"""
_STATES = ", ".join(f"CAST(coalesce((SELECT n FROM v WHERE state = '{s}'), 0) AS BIGINT) AS {s}_resource_unavailable_events" for s in ("resolved", "pending", "unresolved"))


@query(f"""WITH {_TOTALS} SELECT * EXCLUDE (wrong, returned_models), array_to_string(returned_models, ',') AS returned_models, {_STATES}, CAST(wrong + request_errors + coalesce((SELECT n FROM v WHERE state = 'unresolved'), 0) AS BIGINT) AS error_records, (SELECT count(*) FROM (SELECT DISTINCT source_id, attempt FROM p)) AS unique_source_attempts FROM z""")
def provider_totals(spark, sf_dir):
    """All counters, usage and identities of a provider's journal."""
    rows = journals.aggregated(_provider(spark, sf_dir))
    return rows.withColumn("returned_models", F.array_join("returned_models", ",")).drop("requested_models", "requested_tiers", "returned_tiers", "usage_complete")


@query(
    f"""WITH {_P}, k AS (SELECT *, row_number() OVER q AS own, lag(event) OVER q AS before, lag(retry_scheduled) OVER q AS again FROM p WHERE event IN ('response', 'request_error', 'resource_unavailable') WINDOW q AS (PARTITION BY source_id, attempt ORDER BY ordinal)),
  f AS (SELECT request_sha256, min(ordinal) AS first, count(DISTINCT body_sha256) AS n FROM p WHERE event = 'response' AND replayable GROUP BY 1)
  SELECT 'several_requests' AS fault, source_id AS key FROM p GROUP BY source_id, attempt HAVING min(request_sha256) <> max(request_sha256) UNION ALL SELECT 'body_size', request_sha256 FROM p GROUP BY request_sha256 HAVING min(request_bytes) <> max(request_bytes)
  UNION ALL SELECT 'call_order', CAST(ordinal AS VARCHAR) FROM k WHERE call_attempt <> own OR (before IS NOT NULL AND NOT (before = 'resource_unavailable' AND again)) UNION ALL SELECT 'conflict', request_sha256 FROM f WHERE n > 1
  UNION ALL SELECT 'replay_without_response', CAST(ordinal AS VARCHAR) FROM p LEFT JOIN f USING (request_sha256) WHERE event = 'replay' AND (first IS NULL OR first > ordinal)"""
)
def journal_faults(spark, sf_dir):
    return journals.journal_faults(_provider(spark, sf_dir))


#: The same journal with whole usage: no other model or tier, no missing counts, no errors, all waits resolved.
WHOLE = f"SELECT * FROM ({PROVIDER}) AS whole WHERE event IN ('response', 'replay') AND returned_model = 'm-1' AND returned_tier = 'flex' AND input_tokens IS NOT NULL"


@query(
    f"""WITH p AS ({fx.plain(WHOLE)}), s AS (SELECT sum(input_tokens) AS i, sum(cached_input_tokens) AS c, sum(output_tokens) AS o FROM p WHERE event = 'response')
  SELECT (SELECT count(*) FROM p) AS records, CAST(NULL AS VARCHAR) AS unavailable, CAST(ceil(((i - c) * 1250 + c * 125 + o * 10000) * 0.5) AS BIGINT) AS nano_usd FROM s"""
)
def provider_evidence(spark, sf_dir):
    """The content-free projection of a journal with its exact list price."""
    rows = journals.provider_evidence(journals.aggregated(fx.view(spark, sf_dir, WHOLE)), "1.25", "0.125", "10")
    return rows.select("records", "unavailable", (F.col("list_price_usd").cast("decimal(38,9)") * 1_000_000_000).cast("bigint").alias("nano_usd"))


@query("SELECT 'usage_incomplete' AS unavailable, CAST(NULL AS VARCHAR) AS list_price_usd")
def provider_evidence_withheld(spark, sf_dir):
    return journals.provider_evidence(journals.aggregated(_provider(spark, sf_dir)), "1.25", "0.125", "10").select("unavailable", "list_price_usd")


@query(f"WITH {_TOTALS} SELECT unnest(list_filter([CASE WHEN cached_input_tokens > input_tokens THEN 'cached' END, CASE WHEN total_tokens <> input_tokens + output_tokens THEN 'total' END, CASE WHEN wrong <> responses - replayable_responses THEN 'errors' END], lambda x: x IS NOT NULL)) AS fault FROM z")
def provider_evidence_faults(spark, sf_dir):
    return journals.evidence_faults(journals.aggregated(_provider(spark, sf_dir)))


# Telemetry and storage.

SLICES = """SELECT c_mktsegment AS slice, count(*) + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS examples, CAST(sum(c_custkey) AS DOUBLE) AS elapsed, CAST(sum(c_custkey) AS DOUBLE) / count(*) + CASE WHEN c_mktsegment = 'FURNITURE' THEN 0.1 ELSE 0.0 END AS each FROM @customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY c_mktsegment"""


@query(
    """WITH c AS (SELECT c_mktsegment AS slice, count(*) AS n, CAST(sum(c_custkey) AS DOUBLE) AS t FROM customer GROUP BY 1) SELECT CASE slice WHEN 'MACHINERY' THEN 'slice_set' WHEN 'BUILDING' THEN 'examples' ELSE 'each' END AS fault, slice FROM c WHERE slice IN ('MACHINERY', 'BUILDING', 'FURNITURE')
  UNION ALL SELECT 'total_examples', CAST(NULL AS VARCHAR)"""
)
def telemetry_faults(spark, sf_dir):
    """Recorded timings that contradict the generations: a slice is missing, one has a wrong count, one a wrong mean."""
    slices = fx.view(spark, sf_dir, SLICES)
    counts = fx.view(spark, sf_dir, "SELECT c_mktsegment AS slice, count(*) AS examples FROM @customer GROUP BY c_mktsegment")
    total = slices.agg((F.sum("examples") + 5).alias("examples"), F.sum("elapsed").alias("elapsed")).withColumn("each", F.col("elapsed") / F.col("examples"))
    return evidence.telemetry_faults(slices, total, counts)


@query("""WITH r AS (SELECT l_orderkey AS run, CASE WHEN l_orderkey % 5 = 0 THEN 0 ELSE CAST(sum(l_quantity) AS BIGINT) END AS tokens_seen, CAST(sum(l_partkey) AS BIGINT) AS elapsed FROM lineitem GROUP BY l_orderkey)
  SELECT run, CASE WHEN tokens_seen > 0 AND elapsed > 0 THEN tokens_seen / elapsed END AS tokens_per_second, elapsed * 4 / 3600 AS gpu_hours, CASE WHEN tokens_seen = 0 OR elapsed = 0 THEN 'tokens_seen_or_positive_elapsed_unavailable' END AS unavailable FROM r""")
def run_throughput(spark, sf_dir):
    rows = fx.view(spark, sf_dir, "SELECT l_orderkey AS run, CASE WHEN l_orderkey % 5 = 0 THEN 0 ELSE CAST(sum(l_quantity) AS BIGINT) END AS tokens_seen, CAST(sum(l_partkey) AS BIGINT) AS elapsed, 4 AS gpus FROM @lineitem GROUP BY l_orderkey")
    return evidence.throughput(rows).select("run", "tokens_per_second", "gpu_hours", "unavailable")


_FILE = "concat('adapter/', CASE p_partkey % 4 WHEN 0 THEN 'adapter_model.safetensors' WHEN 1 THEN concat('adapter_model-0000', CAST(p_partkey % 9 AS {0}), '-of-00009.bin') WHEN 2 THEN 'config.json' ELSE 'xadapter_model.bin' END)"


@query("SELECT CAST(sum(p_size) AS BIGINT) AS bytes, count(*) AS files, CAST(sum(p_size) FILTER (p_partkey % 4 < 2) AS BIGINT) AS tensor_bytes, count(*) FILTER (p_partkey % 4 < 2) AS tensor_files FROM part")
def adapter_storage(spark, sf_dir):
    return evidence.adapter_storage(fx.view(spark, sf_dir, f"SELECT {_FILE.format('STRING')} AS path, CAST(p_size AS BIGINT) AS bytes FROM @part"))


@query("SELECT concat('out/', CAST(p_partkey AS VARCHAR)) AS path, CASE WHEN p_partkey % 10 = 3 THEN 'other' ELSE 'one' END AS side FROM part WHERE p_partkey % 10 IN (3, 4)")
def output_set_difference(spark, sf_dir):
    rows = fx.view(spark, sf_dir, "SELECT p_partkey, concat('out/', CAST(p_partkey AS STRING)) AS path FROM @part")
    return evidence.file_set_difference(rows.where("p_partkey % 10 <> 3"), rows.where("p_partkey % 10 <> 4"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'smoke' ELSE 'full' END AS class, CASE WHEN o_orderkey % 4 = 1 THEN NULL ELSE epoch(CAST(o_orderdate AS TIMESTAMP)) END AS seconds FROM orders")
def run_classes(spark, sf_dir):
    """The class of a run by its id, and its strict UTC time."""
    rows = fx.view(spark, sf_dir, "SELECT o_orderkey, concat(CASE WHEN o_orderkey % 3 = 0 THEN 'smoke-' ELSE '' END, CAST(o_orderkey AS STRING)) AS run_id, concat(date_format(o_orderdate, 'yyyy-MM-dd'), CASE WHEN o_orderkey % 4 = 1 THEN ' 00:00:00' ELSE 'T00:00:00Z' END) AS at FROM @orders")
    return rows.select("o_orderkey", evidence.evidence_class(F.col("run_id")).alias("class"), F.unix_timestamp(evidence.utc_time(F.col("at"))).cast("double").alias("seconds"))


@query("SELECT l_orderkey AS run, l_linenumber AS step, CAST(l_extendedprice AS DOUBLE) AS loss, CASE WHEN l_linenumber = max(l_linenumber) OVER (PARTITION BY l_orderkey) THEN CAST(l_tax * 100 AS BIGINT) END AS peak_memory FROM lineitem")
def training_metrics(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("l_orderkey AS run", "l_linenumber AS step", "cast(l_extendedprice as double) AS loss", "cast(l_tax * 100 as bigint) AS peak_memory")
    return evidence.training_metrics(rows, "run", "step").select("run", "step", "loss", "peak_memory")
