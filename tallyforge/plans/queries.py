"""Queries over the driver's tables for the engine's operators, and DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import audits, calls, payloads, spans
from tallyforge.operators import evidence, journals, prepare, prompts, reports, requests, review, scoring, secrets
from tallyforge.sources import records

from . import fixtures as fx

LEAST, MOST = 5, 4000
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function under its name, with its oracle; {NAME} in the oracle is a fixture."""

    def add(function):
        QUERIES[function.__name__] = function
        if oracle:
            text = oracle
            for name in ("RAW", "ROOTS", "PAIRS", "GENERATIONS", "JOURNAL"):
                text = text.replace("{" + name + "}", fx.plain(getattr(fx, name)))
            ORACLES[function.__name__] = text
        return function

    return add


# Validation, deduplication, splits, pairing.

NORMAL = r"trim(regexp_replace(replace(lower(query), 'ß', 'ss'), '\s+', ' ', 'g'))"
REASON = f"""CASE WHEN query IS NULL OR trim(query, ' ' || chr(10)) = '' THEN 'missing_query' WHEN trim(tools) = '' THEN 'missing_tools' WHEN trim(answers) = '' THEN 'missing_answers'
  WHEN length(trim(query, ' ' || chr(10))) < {LEAST} THEN 'query_too_short' WHEN length(trim(query, ' ' || chr(10))) > {MOST} THEN 'query_too_long'
  WHEN ordinal % 20 = 5 THEN 'invalid_tools_json' WHEN ordinal % 20 IN (6, 11) THEN 'invalid_tool_shape' WHEN ordinal % 20 = 7 THEN 'invalid_answers_json'
  WHEN ordinal % 20 IN (8, 10, 12) THEN 'invalid_answer_shape' WHEN ordinal % 20 = 9 THEN 'multi_call_answer' END"""
DIGESTED = f"""raw AS ({{RAW}}), judged AS (SELECT *, {REASON} AS fault, sha256({NORMAL}) AS digest FROM raw),
  firsts AS (SELECT language AS l, digest AS d, min(ordinal) AS o FROM judged WHERE fault IS NULL GROUP BY ALL),
  final AS (SELECT j.*, CASE WHEN fault IS NULL AND ordinal > o THEN 'duplicate_query' ELSE fault END AS reason FROM judged j LEFT JOIN firsts ON l = language AND d = digest)"""


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.validated(fx.view(spark, sf_dir, fx.RAW), LEAST, MOST)


@query(f"WITH raw AS ({{RAW}}) SELECT ordinal, {REASON} AS reason FROM raw")
def validate_rows(spark, sf_dir):
    return _validated(spark, sf_dir).select("ordinal", "reason")


@query(f"WITH raw AS ({{RAW}}) SELECT ordinal, source_id FROM raw WHERE query IS NOT NULL AND length(query) BETWEEN {LEAST} AND {MOST}")
def coarse_filter(spark, sf_dir):
    return prepare.coarse(fx.view(spark, sf_dir, fx.RAW), LEAST, MOST).select("ordinal", "source_id")


@query(f"SELECT doc_id, sha256({NORMAL}) AS digest FROM (SELECT doc_id, text AS query FROM documents)")
def query_digest(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.sha2(calls.normalize_query("text"), 256).alias("digest"))


@query(f"WITH {DIGESTED} SELECT ordinal, reason FROM final")
def dedupe_first_wins(spark, sf_dir):
    return prepare.deduplicated(_validated(spark, sf_dir), "language").select("ordinal", "reason")


_REASONS = ", ".join(f"('{r}')" for r in prepare.REASONS)


@query(f"""WITH {DIGESTED} SELECT language, r.reason, CAST(count(final.reason) AS BIGINT) AS n FROM (SELECT DISTINCT language FROM raw) CROSS JOIN (VALUES {_REASONS}) r(reason)
  LEFT JOIN final USING (language, reason) GROUP BY language, r.reason""")
def drop_summary(spark, sf_dir):
    rows = prepare.deduplicated(_validated(spark, sf_dir), "language")
    return prepare.drop_counts(rows, fx.view(spark, sf_dir, fx.RAW).select("language"))


@query(f"""WITH {DIGESTED} SELECT source_id AS example_id, CASE WHEN k <= 40 THEN 'train' WHEN k <= 48 THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT source_id, row_number() OVER (ORDER BY sha256('42:' || source_id), source_id) AS k FROM final WHERE reason IS NULL) WHERE k <= 56""")
def seeded_split(spark, sf_dir):
    rows = prepare.deduplicated(_validated(spark, sf_dir), "language").where("reason is null").withColumn("example_id", F.col("source_id"))
    return prepare.split(rows, 42, {"train": 40, "validation": 8, "test": 8}).select("example_id", "split")


PAIRED = """roots AS ({ROOTS}), pairs AS ({PAIRS}), by_text AS (SELECT query_sha256 AS q, min(split) AS text_split FROM roots GROUP BY ALL),
  j AS (SELECT p.*, r.split AS root_split, CASE WHEN r.split IS NULL THEN 'missing_source_example' WHEN p.tools <> r.tools THEN 'pair_tools_mismatch' WHEN p.answers <> r.answers THEN 'pair_answers_mismatch'
    WHEN text_split <> r.split THEN 'cross_split_duplicate' END AS fault FROM pairs p LEFT JOIN roots r ON r.example_id = p.source_example_id LEFT JOIN by_text ON q = p.query_sha256),
  t AS (SELECT *, min(ordinal) FILTER (fault IS NULL) OVER (PARTITION BY source_example_id) AS taken FROM j),
  done AS (SELECT *, CASE WHEN coalesce(fault, '') <> 'missing_source_example' AND ordinal > taken THEN 'duplicate_source_example' ELSE fault END AS reason FROM t)"""


def _paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.paired(fx.view(spark, sf_dir, fx.PAIRS), fx.view(spark, sf_dir, fx.ROOTS))


@query(f"WITH {PAIRED} SELECT ordinal, example_id, root_split AS split, reason FROM done")
def pair_translations(spark, sf_dir):
    return _paired(spark, sf_dir).select("ordinal", "example_id", "split", "reason")


@query(f"WITH {PAIRED} SELECT reason, CAST(count(*) AS BIGINT) AS n FROM done GROUP BY reason")
def pair_drop_counts(spark, sf_dir):
    return _paired(spark, sf_dir).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["ordinal", "example_id", "language", "source_example_id", "split", "query_sha256"]
    return prepare.all_examples(fx.view(spark, sf_dir, fx.ROOTS).select(columns), _paired(spark, sf_dir))


EXAMPLES = f"{PAIRED}, ex AS (SELECT ordinal, example_id, language, source_example_id, split, query_sha256 FROM roots UNION ALL SELECT ordinal, example_id, language, source_example_id, root_split, query_sha256 FROM done)"


@query(f"""WITH {EXAMPLES} SELECT 'duplicate_id' AS violation, example_id AS key FROM ex GROUP BY example_id HAVING count(*) > 1
  UNION ALL SELECT 'digest_in_two_splits', query_sha256 FROM ex GROUP BY query_sha256 HAVING min(split) <> max(split)
  UNION ALL SELECT 'pair_in_other_split', e.example_id FROM ex e JOIN roots r ON r.example_id = e.source_example_id WHERE e.split <> r.split""")
def split_leaks(spark, sf_dir):
    return prepare.leaks(_examples(spark, sf_dir))


@query(f"WITH {EXAMPLES} SELECT l AS language, s AS split FROM (VALUES ('en'), ('fr'), ('he')) a(l), (VALUES ('train'), ('validation'), ('test')) b(s) WHERE NOT EXISTS (SELECT 1 FROM ex WHERE language = l AND split = s)")
def uncovered_cells(spark, sf_dir):
    return prepare.uncovered(_examples(spark, sf_dir).where("split is not null"), spark.createDataFrame([("en",), ("fr",), ("he",)], "language string"))


@query(f"WITH {EXAMPLES} SELECT example_id, CAST(CASE language WHEN 'en' THEN 0 ELSE 1 END AS INT) AS language_rank, row_number() OVER (PARTITION BY language ORDER BY coalesce(source_example_id, example_id), ordinal) AS place FROM ex")
def canonical_order(spark, sf_dir):
    return prepare.placed(_examples(spark, sf_dir), ["en", "fr"]).select("example_id", "language_rank", "place")


@query("SELECT concat('documents:', CAST(doc_id AS VARCHAR)) AS source_id, text AS query FROM documents ORDER BY sha256(concat('7:documents:', CAST(doc_id AS VARCHAR))), 1 LIMIT 200")
def export_seeded_limit(spark, sf_dir):
    return records.exported(spark.read.parquet(f"{sf_dir}/documents.parquet"), {"id": "doc_id", "query": "text"}, "documents", 7, 200)


@query("SELECT count(*) AS rows_one, count(*) FILTER (o.doc_id IS NULL) AS only_one FROM documents d LEFT JOIN labels o USING (doc_id)")
def cohort_difference(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet").select("doc_id") for t in ("documents", "labels"))
    side = evidence.cohort_difference(docs, labels)
    return docs.agg(F.count(F.lit(1)).alias("rows_one")).join(side.where("side = 'one'").agg(F.count(F.lit(1)).alias("only_one")))


# Prompts, digests, tokens, labels.

SYSTEM = " Call one tool. "
PROMPTS = """p AS (SELECT doc_id AS ordinal, lang AS language, CASE WHEN doc_id % 10 = 9 THEN 'test' ELSE 'train' END AS split, text AS query,
  concat('<|system|>', chr(10), 'Call one tool.', chr(10), chr(10), 'Available tools:', chr(10), '[{"name":"lookup"}]', chr(10), '<|user|>', chr(10), text, chr(10), '<|assistant|>', chr(10)) AS prompt,
  concat('[{"arguments":{"lang":"', lang, '"},"name":"lookup"}]') AS target FROM documents)"""


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.selectExpr("doc_id AS ordinal", "concat('doc:', doc_id) AS example_id", "lang AS language", "CASE WHEN doc_id % 10 = 9 THEN 'test' ELSE 'train' END AS split", "text AS query")
    gold = F.concat(F.lit('[{"name":"lookup","arguments":{"lang":"'), "language", F.lit('"}}]'))
    return prompts.rendered(rows.withColumn("messages", prompts.messages(F.col("query"), calls.canonical_json(F.lit('[{"name": "lookup"}]')), calls.canonical_json(gold), SYSTEM)))


@query(f"WITH {PROMPTS} SELECT ordinal, sha256(prompt) AS prompt_sha256, target AS target_text, CAST(length(prompt) AS INT) AS prompt_chars FROM p")
def format_prompts(spark, sf_dir):
    return _prompts(spark, sf_dir).select("ordinal", "prompt_sha256", "target_text", F.length("prompt_text").alias("prompt_chars"))


@query(f"WITH {PROMPTS} SELECT language, count(*) AS n, sha256(string_agg(sha256(prompt), chr(10) ORDER BY ordinal)) AS digest FROM p GROUP BY language")
def prompt_set_digest(spark, sf_dir):
    return prompts.ordered_digest(_prompts(spark, sf_dir), "prompt_sha256", "language")


@query("SELECT count(*) AS n, sha256(concat(string_agg(concat('{\"id\":', CAST(doc_id AS VARCHAR), ',\"source\":\"', source, '\"}'), chr(10) ORDER BY doc_id), chr(10))) AS digest FROM documents")
def published_rows_identity(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id AS ordinal", "to_json(struct(doc_id AS id, source)) AS line")
    return prompts.ordered_digest(rows, "line", closed=True)


def _words(text: str) -> str:
    return rf"CAST(len(regexp_extract_all({text}, '\S+')) AS BIGINT)"


TOKENS = PROMPTS + f""", t AS (SELECT *, length(query) AS query_chars, strlen(query) AS query_bytes, {_words('query')} AS query_words, {_words('query')} AS query_tokens,
  {_words('prompt')} AS prompt_tokens, {_words('target')} AS target_tokens, {_words("concat(prompt, target, chr(10))")} AS full_tokens FROM p)"""
COUNTED = "CAST({0} AS BIGINT) AS {0}"


@query(f"WITH {TOKENS} SELECT ordinal, {', '.join(COUNTED.format(c) for c in prompts.COUNTS)}, full_tokens > 2000 AS over_budget FROM t")
def token_counts(spark, sf_dir):
    return prompts.token_counts(_prompts(spark, sf_dir), 2000).select("ordinal", *prompts.COUNTS, "over_budget")


@query(f"""WITH {TOKENS} SELECT language, split, count(*) AS examples, CAST(sum(full_tokens) AS BIGINT) AS total, quantile_disc(full_tokens, 0.5) AS p50, quantile_disc(full_tokens, 0.95) AS p95, quantile_disc(full_tokens, 0.99) AS p99,
  max(full_tokens) AS most, count(*) FILTER (full_tokens > 2000) AS over_budget FROM t GROUP BY GROUPING SETS ((language, split), (language))""")
def token_summary(spark, sf_dir):
    return prompts.count_summary(prompts.token_counts(_prompts(spark, sf_dir), 2000))


@query(f"WITH {TOKENS} SELECT language, count(*) AS n FROM t WHERE full_tokens > 2000 GROUP BY language")
def budget_gate(spark, sf_dir):
    return prompts.token_counts(_prompts(spark, sf_dir), 2000).where("over_budget").groupBy("language").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {TOKENS} SELECT count(*) AS examples, CAST(sum(full_tokens) AS BIGINT) AS epoch_tokens, CAST(sum(full_tokens) FILTER (language = 'en') AS BIGINT) AS root_epoch_tokens, CAST(sum(full_tokens) * 2 AS BIGINT) AS tokens,
  CAST((sum(full_tokens) - sum(full_tokens) FILTER (language = 'en')) * 2 AS BIGINT) AS added_tokens, sum(full_tokens) / sum(full_tokens) FILTER (language = 'en') AS multiplier FROM t WHERE split = 'train'""")
def training_workload(spark, sf_dir):
    return prompts.workload(prompts.token_counts(_prompts(spark, sf_dir), 2000), "en", 2)


PAIR_TOKENS = f"""WITH c AS (SELECT conv_id, role, {_words('text')} AS full_tokens, concat(role, CAST(conv_id AS VARCHAR), '.', CAST(turn AS VARCHAR)) AS example_id, concat('user', CAST(conv_id AS VARCHAR), '.', CAST(turn - 1 AS VARCHAR)) AS source FROM conversations)"""


@query(f"""{PAIR_TOKENS} SELECT c.role AS language, (SELECT count(*) FROM c WHERE role = 'user') AS roots, count(*) AS pairs, CAST(sum(r.full_tokens) AS BIGINT) AS root_tokens, CAST(sum(c.full_tokens) AS BIGINT) AS pair_tokens,
  sum(c.full_tokens) / sum(r.full_tokens) AS ratio FROM c JOIN c r ON r.example_id = c.source WHERE c.role <> 'user' GROUP BY c.role""")
def paired_token_ratio(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr("role AS language", "concat(role, conv_id, '.', turn) AS example_id", "concat('user', conv_id, '.', turn - 1) AS source_example_id", r"cast(size(filter(split(text, '\\s+'), w -> w <> '')) as bigint) AS full_tokens")
    return prompts.paired_tokens(rows, "user")


@query("""SELECT doc_id, CAST(n AS INT) AS masked, CAST(2 * n AS INT) AS labels FROM (SELECT doc_id, n_chars % 50 + 1 AS n FROM documents)""")
def completion_labels(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "sequence(1, cast(n_chars % 50 + 1 as int)) AS prompt").withColumn("full", F.concat("prompt", "prompt"))
    rows = rows.withColumn("made", prompts.completion_labels(F.col("prompt"), F.col("full")))
    return rows.select("doc_id", F.size(F.filter("made", lambda x: x == -100)).alias("masked"), F.size("made").alias("labels"))


@query("""WITH d AS (SELECT doc_id, source, least(40, n_chars % 60 + 1) AS n FROM documents) SELECT doc_id, CAST(max(n) OVER (PARTITION BY source) AS INT) AS width, CAST(n AS INT) AS live FROM d""")
def collated_batches(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "source", "sequence(1, cast(n_chars % 60 + 1 as int)) AS ids").withColumn("labels", F.col("ids"))
    return prompts.collated(rows, 40, "source").select("doc_id", F.size("ids").alias("width"), F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("live"))


# Scores.

PARSED = "CASE WHEN kind = 6 THEN 'no_json' WHEN kind = 7 THEN 'invalid_json' WHEN kind = 8 THEN 'invalid_shape' ELSE 'ok' END"
SCORED = f"""g AS ({{GENERATIONS}}), s AS (SELECT *, CAST(kind NOT IN (6, 7, 8) AS BIGINT) AS ok, CAST(kind NOT IN (3, 6, 7, 8) AS BIGINT) AS named, CAST(kind IN (0, 1, 2, 3) AS BIGINT) AS args, CAST(kind IN (0, 1, 2) AS BIGINT) AS whole,
  CAST(2 * CASE WHEN kind IN (6, 7, 8) THEN 0 WHEN kind = 4 THEN 3 WHEN kind = 9 THEN 2 ELSE 4 END AS BIGINT) AS f1, CAST(4 + CASE WHEN kind IN (6, 7, 8) THEN 0 WHEN kind = 4 THEN 3 WHEN kind = 5 THEN 5 ELSE 4 END AS BIGINT) AS f1_den FROM g)"""


def _scored(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    rows = fx.view(spark, sf_dir, fx.GENERATIONS)
    return scoring.scored(prepare.spread(rows if kind is None else rows.where(F.col("model_kind") == kind)))


@query(f"WITH g AS ({{GENERATIONS}}) SELECT ordinal, model_kind, {PARSED} AS status, CASE WHEN {PARSED} = 'ok' THEN CASE WHEN kind = 3 THEN 'other' ELSE 'lookup' END END AS name FROM g")
def parse_tool_calls(spark, sf_dir):
    return scoring.parsed(fx.view(spark, sf_dir, fx.GENERATIONS)).select("ordinal", "model_kind", "status", "name")


@query(f"""WITH {SCORED}, m AS (SELECT model_kind, language, unnest(['valid_json_rate', 'function_name_accuracy', 'argument_exact_match', 'argument_f1', 'full_call_exact_match']) AS metric, unnest([ok, named, args, f1, whole]) AS num, unnest([1, 1, 1, f1_den, 1]) AS den FROM s)
  SELECT model_kind, language, metric, CAST(sum(num) AS BIGINT) AS numerator, CAST(sum(den) AS BIGINT) AS denominator, sum(num) / sum(den) AS value FROM m GROUP BY GROUPING SETS ((model_kind, language, metric), (model_kind, metric))""")
def score_metrics(spark, sf_dir):
    return scoring.metrics(_scored(spark, sf_dir), "model_kind")


@query(f"WITH {SCORED} SELECT ordinal, model_kind, f1 AS f1_num, f1_den, whole AS full_num FROM s")
def score_components(spark, sf_dir):
    return _scored(spark, sf_dir).select("ordinal", "model_kind", F.col("argument_f1_num").alias("f1_num"), F.col("argument_f1_den").alias("f1_den"), F.col("full_call_exact_match_num").alias("full_num"))


def _kinds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _scored(spark, sf_dir, "base"), _scored(spark, sf_dir, "adapter")


@query(f"WITH {SCORED} SELECT count(*) AS pairs, count(*) FILTER (a.whole = 1 AND b.whole = 0) AS reference_only, count(*) FILTER (a.whole = 0 AND b.whole = 1) AS candidate_only FROM s a JOIN s b USING (example_id) WHERE a.model_kind = 'base' AND b.model_kind = 'adapter'")
def mcnemar_counts(spark, sf_dir):
    return scoring.discordant(*_kinds(spark, sf_dir))


@query(f"""WITH {SCORED}, p AS (SELECT row_number() OVER (ORDER BY a.example_id) - 1 AS place, a.whole AS rw, b.whole AS cw, a.f1 AS rf, a.f1_den AS rd, b.f1 AS cf, b.f1_den AS cd FROM s a JOIN s b USING (example_id) WHERE a.model_kind = 'base' AND b.model_kind = 'adapter'),
  d AS (SELECT r, CAST(('0x' || substr(md5(concat('s1:', CAST(r AS VARCHAR), ':', CAST(i AS VARCHAR))), 1, 8)) AS BIGINT) % (SELECT count(*) FROM p) AS place FROM range(40) a(r), (SELECT place AS i FROM p)),
  t AS (SELECT r, sum(cw) / count(*) - sum(rw) / count(*) AS whole, sum(cf) / sum(cd) - sum(rf) / sum(rd) AS f1 FROM d JOIN p USING (place) GROUP BY r)
  SELECT 'full_call_exact_match' AS metric, quantile_cont(whole, 0.025) AS lower, quantile_cont(whole, 0.975) AS upper FROM t UNION ALL SELECT 'argument_f1', quantile_cont(f1, 0.025), quantile_cont(f1, 0.975) FROM t""")
def paired_bootstrap(spark, sf_dir):
    base, adapter = _kinds(spark, sf_dir)
    return scoring.bootstrap(base, adapter, 40, "s1").where(F.col("metric").isin("full_call_exact_match", "argument_f1"))


@query()
def paired_bootstrap_full(spark, sf_dir):
    """All metrics with the reference's 2,000 resamples; paired_bootstrap is the small case that SQL checks."""
    base, adapter = _kinds(spark, sf_dir)
    return scoring.bootstrap(base, adapter, 2000, "s1")


@query(f"WITH {SCORED}, v AS (SELECT language, model_kind, sum(whole) / count(*) AS value FROM s GROUP BY ALL) SELECT a.language, b.value - a.value AS delta FROM v a JOIN v b USING (language) WHERE a.model_kind = 'base' AND b.model_kind = 'adapter'")
def adapter_deltas(spark, sf_dir):
    measured = scoring.metrics(_scored(spark, sf_dir), "model_kind")
    return scoring.deltas(measured, "base", "adapter").where("metric = 'full_call_exact_match' and language is not null").select("language", "delta")


@query(f"WITH {SCORED}, v AS (SELECT language, model_kind, sum(whole) / count(*) AS value FROM s GROUP BY ALL) SELECT a.model_kind, a.language, a.value - b.value AS gap FROM v a JOIN v b USING (model_kind) WHERE a.language <> 'en' AND b.language = 'en'")
def language_gaps(spark, sf_dir):
    return scoring.gaps(scoring.metrics(_scored(spark, sf_dir), "model_kind"), "en", "model_kind").where("metric = 'full_call_exact_match'").select("model_kind", "language", "gap")


@query("""SELECT concat('doc:', CAST(doc_id AS VARCHAR)) AS example_id, CASE doc_id % 30 WHEN 1 THEN 'no_generation' WHEN 2 THEN 'prompt_differs' ELSE 'unknown_example' END AS problem FROM documents WHERE doc_id % 30 IN (1, 2, 3)""")
def unmatched_generations(spark, sf_dir):
    rows = fx.view(spark, sf_dir, fx.GENERATIONS)
    own = rows.where("model_kind = 'base' AND ordinal % 30 <> 1").withColumn("prompt_sha256", F.expr("if(ordinal % 30 = 2, 'x', prompt_sha256)"))
    return scoring.unmatched(own, rows.where("model_kind = 'adapter' AND ordinal % 30 <> 3"))


@query("""SELECT concat('doc:', CAST(doc_id AS VARCHAR)) AS example_id, CASE doc_id % 30 WHEN 1 THEN 'f1_range' WHEN 2 THEN 'full_without_parts' ELSE 'match_without_json' END AS fault FROM documents, range(2) WHERE doc_id % 30 IN (1, 2, 3)""")
def component_laws(spark, sf_dir):
    planted = {"argument_f1_num": "if(ordinal % 30 = 1, argument_f1_den + 2, argument_f1_num)", "full_call_exact_match_num": "CASE ordinal % 30 WHEN 2 THEN 1 WHEN 3 THEN 0 ELSE full_call_exact_match_num END", "function_name_accuracy_num": "CASE ordinal % 30 WHEN 2 THEN 0 WHEN 3 THEN 1 ELSE function_name_accuracy_num END", "valid_json_rate_num": "if(ordinal % 30 = 3, 0, valid_json_rate_num)"}
    return evidence.component_faults(_scored(spark, sf_dir).withColumns({c: F.expr(e) for c, e in planted.items()}))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def flatten_arguments(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", calls.flatten_arguments("props").alias("pairs"))
    return rows.select("event_id", F.element_at("pairs", "k").cast("bigint").alias("k"))


# Journals.


@query("WITH j AS ({JOURNAL}) SELECT source_id, max(ordinal) AS ordinal, arg_max(event, ordinal) AS event FROM j GROUP BY source_id")
def latest_records(spark, sf_dir):
    return journals.latest(fx.view(spark, sf_dir, fx.JOURNAL)).select("source_id", "ordinal", "event")


@query("WITH j AS ({JOURNAL}) SELECT source_id, count(DISTINCT attempt) AS attempts, max(attempt) AS last FROM j GROUP BY source_id HAVING count(DISTINCT attempt) <> max(attempt) OR min(attempt) <> 1")
def attempt_gaps(spark, sf_dir):
    return journals.attempt_gaps(fx.view(spark, sf_dir, fx.JOURNAL))


@query("""WITH j AS (SELECT *, row_number() OVER w AS own, lag(event) OVER w AS before FROM ({JOURNAL}) WINDOW w AS (PARTITION BY source_id, attempt ORDER BY ordinal))
  SELECT source_id, attempt, count(*) AS calls, CASE arg_max(event, ordinal) WHEN 'response' THEN 'resolved' WHEN 'resource_unavailable' THEN 'pending' ELSE 'unresolved' END AS state, bool_or(coalesce(before = 'response', false)) AS broken FROM j GROUP BY source_id, attempt""")
def call_ledger(spark, sf_dir):
    rows = fx.view(spark, sf_dir, fx.JOURNAL).selectExpr("*", "row_number() over (partition by source_id, attempt order by ordinal) AS call_attempt")
    return journals.ledger(rows)


@query("""WITH j AS ({JOURNAL}) SELECT count(*) AS events, count(*) FILTER (event = 'response') AS responses, count(*) FILTER (event = 'replay') AS replays, count(*) FILTER (event = 'request_error') AS errors,
  count(*) FILTER (event = 'resource_unavailable') AS unavailable, count(*) FILTER (retry_scheduled) AS retries, count(DISTINCT source_id) AS sources, count(DISTINCT request_sha256) AS requests, count(DISTINCT returned_model) AS models,
  max(body_bytes) AS most_bytes, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(cached_tokens) AS BIGINT) AS cached_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(reasoning_tokens) AS BIGINT) AS reasoning_tokens, CAST(sum(total_tokens) AS BIGINT) AS total_tokens FROM j""")
def journal_usage(spark, sf_dir):
    return journals.usage(fx.view(spark, sf_dir, fx.JOURNAL))


@query("""WITH j AS ({JOURNAL}) SELECT ordinal, CASE WHEN total_tokens <> input_tokens + output_tokens THEN 'total' WHEN cached_tokens > input_tokens THEN 'cached' ELSE 'reasoning' END AS fault FROM j
  WHERE total_tokens <> input_tokens + output_tokens OR cached_tokens > input_tokens OR reasoning_tokens > output_tokens""")
def usage_faults(spark, sf_dir):
    return journals.usage_faults(fx.view(spark, sf_dir, fx.JOURNAL))


@query("WITH j AS ({JOURNAL}) SELECT request_sha256, arg_min(body_sha256, ordinal) AS body_sha256, count(DISTINCT body_sha256) AS versions FROM j WHERE event = 'response' AND replayable GROUP BY request_sha256")
def replay_cache(spark, sf_dir):
    return journals.replays(fx.view(spark, sf_dir, fx.JOURNAL))


@query("""WITH j AS ({JOURNAL}), c AS (SELECT DISTINCT request_sha256 FROM j WHERE event = 'response' AND replayable)
  SELECT ordinal, CASE WHEN request_sha256 IN (SELECT request_sha256 FROM c) THEN 'replay' ELSE 'call' END AS served FROM j""")
def coalesced_requests(spark, sf_dir):
    rows = fx.view(spark, sf_dir, fx.JOURNAL)
    return journals.coalesced(rows, journals.replays(rows))[1].select("ordinal", "served")


#: Cost in thousandths of a millionth of a dollar, in whole numbers.
NANO = """CAST(ceil(((input_tokens - cached_tokens) * 1250 + cached_tokens * 125) * CASE WHEN input_tokens > 272000 THEN 2.0 ELSE 1.0 END * CASE tier WHEN 'flex' THEN 0.5 ELSE 1.0 END
  + output_tokens * 10000 * CASE WHEN input_tokens > 272000 THEN 1.5 ELSE 1.0 END * CASE tier WHEN 'flex' THEN 0.5 ELSE 1.0 END) AS BIGINT)"""


@query(f"WITH j AS ({{JOURNAL}}) SELECT ordinal, {NANO} AS nano_usd FROM j")
def list_prices(spark, sf_dir):
    rows = journals.priced(fx.view(spark, sf_dir, fx.JOURNAL), "1.25", "0.125", "10")
    return rows.select("ordinal", (F.col("cost_usd") * 1_000_000_000).cast("bigint").alias("nano_usd"))


@query("""WITH b AS (SELECT CAST(user_id AS BIGINT) AS batch, count(*) AS n FROM events GROUP BY user_id), r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM b)
  SELECT batch, CAST(spent AS BIGINT) AS spent_before, spent + 2 * n <= 5000 AS admitted FROM r""")
def running_budget(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy(F.col("user_id").alias("batch")).agg(F.count(F.lit(1)).cast("decimal(38,9)").alias("observed_usd"))
    return journals.admitted(rows.withColumn("bound_usd", (F.col("observed_usd") * 2).cast("decimal(38,9)")), "5000").select("batch", F.col("spent_before").cast("bigint"), "admitted")


_DROPS = ", ".join(f"('{r}')" for r in [*audits.DROPS])


@query(f"""WITH j AS ({{JOURNAL}}), l AS (SELECT source_id, arg_max(dropped, ordinal) FILTER (dropped IS NOT NULL) AS some, max(ordinal) AS o FROM j GROUP BY source_id), k AS (SELECT j.* FROM j JOIN l ON l.o = j.ordinal)
  SELECT r AS reason, count(k.ordinal) AS rows, CAST(coalesce(sum(k.attempt), 0) AS BIGINT) AS attempts, count(*) FILTER (k.attempt > 1) AS retried FROM (VALUES (NULL), {_DROPS}) v(r) LEFT JOIN k ON k.dropped IS NOT DISTINCT FROM r GROUP BY r""")
def translation_outcomes(spark, sf_dir):
    return journals.outcomes(fx.view(spark, sf_dir, fx.JOURNAL), audits.DROPS)


# Review.


@query("SELECT doc_id, least(10, (row_number() OVER (ORDER BY n_chars, doc_id) - 1) * 10 // count(*) OVER () + 1) AS decile FROM documents")
def length_deciles(spark, sf_dir):
    return review.length_decile(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "n_chars"), "n_chars", "doc_id").select("doc_id", "decile")


_VERBS = "|".join(review.HIGH_RISK_VERBS)


@query(rf"SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text), '\b({_VERBS})\b', 1))), ',') AS verbs FROM documents")
def risk_verbs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.array_join(review.risk_verbs(F.col("text")), ",").alias("verbs"))


@query("SELECT 'lang' AS dimension, lang AS stratum, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source")
def strata_counts(spark, sf_dir):
    return review.strata_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), "lang", "source")


@query("""WITH d AS (SELECT concat('doc:', CAST(doc_id AS VARCHAR)) AS example_id, doc_id % 25 = 0 AS risky FROM documents), o AS (SELECT *, sha256(concat('review|7|', example_id)) AS h FROM d),
  k AS (SELECT *, row_number() OVER (PARTITION BY risky ORDER BY h, example_id) AS place FROM o), c AS (SELECT *, CASE WHEN risky AND place <= 20 THEN 0 WHEN NOT risky THEN 1 ELSE 2 END AS class FROM k)
  SELECT example_id, risky FROM c ORDER BY class, h, example_id LIMIT 100""")
def quota_sample(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("concat('doc:', doc_id) AS example_id", "doc_id % 25 = 0 AS risky")
    return review.quota_sample(rows, 100, 20, "review", 7).select("example_id", "risky")


@query("SELECT count(*) AS reviewed, count(*) FILTER (quality = 1 AND toxic = 0) AS passes, count(*) FILTER (NOT (quality = 1 AND toxic = 0)) AS critical FROM labels")
def review_decisions(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("if(quality = 1, 'pass', 'fail') AS meaning", "if(toxic = 0, 'pass', 'fail') AS tone")
    return review.decisions(rows, ["meaning", "tone"])


# Secrets, spans, audits.

SECRET = "concat(text, CASE doc_id % 9 WHEN 0 THEN ' hf_abcdefghijklmnopqrstuvwxyz' WHEN 1 THEN concat(chr(10), 'sk-abcdefghij-klmnopqrstuv') ELSE '' END)"


@query(f"SELECT doc_id, sha256(regexp_replace(regexp_replace({SECRET}, 'hf_[A-Za-z0-9]{{20,}}', '[redacted]', 'g'), 'sk-[A-Za-z0-9_-]{{20,}}', '[redacted]', 'g')) AS digest FROM documents")
def redact_secrets(spark, sf_dir):
    rows = fx.view(spark, sf_dir, f"SELECT doc_id, {SECRET} AS text FROM @documents")
    return rows.select("doc_id", F.sha2(secrets.redacted(F.col("text")), 256).alias("digest"))


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split({SECRET}, chr(10))) AS line, generate_subscripts(string_split({SECRET}, chr(10)), 1) AS n FROM documents)
  SELECT doc_id, CAST(n AS INT) AS line, 'secret_value' AS kind FROM l WHERE regexp_matches(line, 'hf_[A-Za-z0-9]{{20,}}|sk-[A-Za-z0-9_-]{{20,}}|ghp_[A-Za-z0-9]{{20,}}|xox[baprs]-[A-Za-z0-9-]{{10,}}')""")
def secret_lines(spark, sf_dir):
    return secrets.line_findings(fx.view(spark, sf_dir, f"SELECT doc_id, {SECRET} AS text FROM @documents"), "doc_id")


KEYS = "SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN concat(lang, '_token') WHEN 1 THEN 'eos_token' WHEN 2 THEN concat('API_KEY_', source) WHEN 3 THEN concat(source, 'token') WHEN 4 THEN 'password' WHEN 5 THEN 'total_tokens' WHEN 6 THEN concat('Secret_', lang) ELSE source END AS key FROM @documents"


@query(f"SELECT doc_id, regexp_matches(key, '(?i)(^|_)(token|secret|password|api_key|apikey)(_|$)') AND key <> 'eos_token' AS sensitive FROM ({fx.plain(KEYS)})")
def sensitive_keys(spark, sf_dir):
    return fx.view(spark, sf_dir, KEYS).select("doc_id", secrets.is_sensitive_key(F.col("key")).alias("sensitive"))


@query("SELECT doc_id, concat('\"', lang, ' ', CAST(n_chars AS VARCHAR), '\"|', source) AS spans, concat('find __KEEP_0000__ in __KEEP_0001__ ', CAST(doc_id AS VARCHAR), 'x') AS masked FROM documents")
def protected_spans(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", """concat('find "', lang, ' ', n_chars, '" in ', source, ' ', doc_id, 'x') AS query""", """concat('[{"name":"f","arguments":{"a":"', lang, ' ', n_chars, '","b":"', source, '"}}]') AS calls""")
    rows = rows.withColumn("spans", spans.protected_spans("query", "calls"))
    return rows.select("doc_id", F.array_join("spans", "|").alias("spans"), spans.mask_spans("query", "spans").alias("masked"))


@query("""SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'empty_output' WHEN doc_id % 6 = 1 THEN 'missing_protected_span' WHEN doc_id % 6 = 2 AND length(text) + 3 + length(source) > 2000 THEN 'output_too_long' WHEN doc_id % 6 = 2 THEN NULL
  WHEN doc_id % 6 = 3 AND length(text) + 1 + length(source) > 2000 THEN 'output_too_long' WHEN doc_id % 6 = 3 THEN 'untranslated_output' WHEN doc_id % 6 = 4 THEN 'unsafe_bidi_control' ELSE NULL END AS reason FROM documents""")
def translation_audit(spark, sf_dir):
    # words whose capitals have other letters or another length (ß: SS) stay as they are, so an output is as long as its text
    big = "array_join(transform(split(text, '(?<= )'), w -> CASE WHEN length(upper(w)) = length(w) AND lower(upper(w)) = lower(w) THEN upper(w) ELSE w END), '')"
    rows = fx.view(spark, sf_dir, f"SELECT doc_id, concat(text, ' ', source) AS query, source, CASE doc_id % 6 WHEN 0 THEN '  ' WHEN 1 THEN 'rien' WHEN 2 THEN concat(text, ' : ', source) WHEN 3 THEN concat({big}, ' ', source) WHEN 4 THEN concat('‪', source) ELSE concat('dans ', source) END AS output FROM (SELECT doc_id, coalesce(text, '') AS text, source FROM (SELECT doc_id, coalesce(text, '') AS text, source FROM @documents))")
    judged = audits.audit("query", "output", F.array("source"), F.lit("fr"))
    return rows.select("doc_id", judged.alias("a")).select("doc_id", "a.reason")


# Runs.


@query("SELECT l_orderkey AS run, l_linenumber AS step, CASE WHEN l_linenumber = max(l_linenumber) OVER (PARTITION BY l_orderkey) THEN CAST(l_tax * 100 AS BIGINT) END AS memory FROM lineitem")
def last_row_memory(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("l_orderkey AS run", "l_linenumber AS step", "cast(l_tax * 100 as bigint) AS memory")
    return evidence.last_row_memory(rows, "run", "step", "memory").select("run", "step", "memory")


@query("""WITH h AS (SELECT l_orderkey AS run, (l_linenumber * 1000000 + l_partkey) * 10000 + l_suppkey AS step, CAST(l_quantity AS BIGINT) AS tokens_seen FROM lineitem), w AS (SELECT *, max(tokens_seen) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM h WHERE tokens_seen > 0)
, p AS (SELECT l_orderkey AS run, arg_max(CAST(l_tax * 100 AS BIGINT), (l_linenumber * 1000000 + l_partkey) * 10000 + l_suppkey) AS peak_memory, count(DISTINCT CAST(l_tax * 100 AS BIGINT)) AS peaks FROM lineitem GROUP BY l_orderkey)
  SELECT run, max(tokens_seen) AS tokens_seen, count(*) FILTER (tokens_seen < before) AS falls, any_value(peak_memory) AS peak_memory, any_value(peaks) AS peaks FROM w JOIN p USING (run) GROUP BY run""")
def training_summary(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("l_orderkey AS run", "(l_linenumber * 1000000 + l_partkey) * 10000 + l_suppkey AS step", "cast(l_quantity as bigint) AS tokens_seen", "cast(l_tax * 100 as bigint) AS peak_memory")
    return evidence.training_summary(rows, "run", "step").where("tokens_seen is not null")


@query("SELECT c_mktsegment AS slice, count(*) AS examples, CAST(sum(c_custkey) AS BIGINT) AS elapsed, sum(c_custkey) / count(*) AS each FROM customer GROUP BY GROUPING SETS ((c_mktsegment), ())")
def telemetry_slices(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("c_mktsegment AS slice", "cast(c_custkey as bigint) AS elapsed")
    return evidence.telemetry(rows, "slice")


@query("SELECT c_mktsegment AS slice, CASE WHEN count(*) FILTER (c_custkey % 50 = 0) > 0 THEN sum(c_custkey) * 4 / count(*) FILTER (c_custkey % 50 = 0) END AS gpu_seconds FROM customer GROUP BY c_mktsegment")
def seconds_per_success(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").groupBy(F.col("c_mktsegment").alias("slice")).agg(F.sum(F.col("c_custkey").cast("bigint")).alias("t"), F.count_if(F.expr("c_custkey % 50 = 0")).alias("wins"))
    return rows.select("slice", evidence.seconds_per_success(F.col("t"), F.lit(4), F.col("wins")).alias("gpu_seconds"))


@query("SELECT doc_id, CAST(CASE doc_id % 3 WHEN 0 THEN doc_id % 8 + 1 ELSE 1 END AS INT) AS gpus FROM documents")
def gpu_labels(spark, sf_dir):
    rows = fx.view(spark, sf_dir, "SELECT doc_id, concat(source, CASE doc_id % 3 WHEN 0 THEN concat(':', CAST(doc_id % 8 + 1 AS STRING)) WHEN 1 THEN ':x' ELSE '' END) AS label FROM @documents")
    return rows.select("doc_id", evidence.gpu_count(F.col("label")).alias("gpus"))


# Requests and payloads.


@query("""SELECT doc_id, concat('{"a":[{"api_key":"[redacted]"},1.0],"lang":"', lang, '"}') AS redacted FROM documents""")
def redact_json_fields(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", """concat('{"lang": "', lang, '", "a": [{"api_key": "', source, '"}, 1.0]}') AS payload""")
    return rows.select("doc_id", payloads.redact_fields("payload", F.array(F.lit("api_key"))).alias("redacted"))


@query("""SELECT doc_id, 'user_token' AS path, 'sensitive_key' AS kind FROM documents UNION ALL SELECT doc_id, 'x[1].note', 'secret_value' FROM documents WHERE doc_id % 3 = 0""")
def json_secret_findings(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", """concat('{"user_token": 1, "eos_token": 2, "x": [0, {"note": "', if(doc_id % 3 = 0, 'hf_abcdefghijklmnopqrstuv', lang), '"}]}') AS payload""")
    return rows.select("doc_id", F.explode(payloads.json_findings("payload", F.array(F.lit("eos_token")))).alias("f")).select("doc_id", "f.path", "f.kind")


@query(r"""SELECT doc_id, concat('{"description":"find in ', source, '","name":"lookup","parameters":[{"description":"a \u0026 b","name":"lang","type":"string"},{"description":"","name":"n","type":"unspecified"}]}') AS context FROM documents""")
def semantic_context(spark, sf_dir):
    tools = """concat('[{"name":"lookup","description":"find in ', source, '","parameters":{"n":{},"lang":{"type":"string","description":"a & b","default":1}}},{"name":"other"}]') AS tools"""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", tools).select("doc_id", payloads.semantic_context("tools", F.lit("lookup")).alias("context"))


@query("""WITH p AS (SELECT doc_id, concat('Translate into French.', chr(10), CASE WHEN doc_id % 2 = 0 THEN concat('Keep: ', source, ' | ', lang, chr(10)) ELSE '' END, CASE WHEN doc_id % 3 = 0 THEN concat('Last time: empty_output', chr(10)) ELSE '' END, 'Request: ', text) AS prompt FROM documents)
  SELECT doc_id, sha256(concat('m1', chr(10), prompt)) AS request_sha256, CASE WHEN length(prompt) + 100 <= 4096 THEN 'generate' ELSE 'not_generated' END AS state FROM p""")
def translation_requests(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spans_ = F.when(F.col("doc_id") % 2 == 0, F.array("source", "lang")).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("prompt", requests.prompt(F.col("text"), spans_, "French", F.when(F.col("doc_id") % 3 == 0, F.lit("empty_output"))))
    rows = requests.within_context(rows.withColumn("tokens", F.length("prompt")), "tokens", 100, 4096)
    return rows.select("doc_id", requests.request_sha256(F.lit("m1"), F.col("prompt")).alias("request_sha256"), "state")


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'error' ELSE CASE WHEN event_id % 7 = 0 THEN 'mismatch' WHEN event_id % 5 = 0 OR event_id % 11 = 0 THEN 'incomplete' ELSE 'complete' END END AS state FROM events""")
def response_states(spark, sf_dir):
    rows = fx.view(spark, sf_dir, """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'incomplete' ELSE 'completed' END AS status, CASE event_type WHEN 'click' THEN 'refused' END AS error, 'm1' AS requested_model,
      CASE WHEN event_id % 7 = 0 THEN 'other' ELSE 'm1-2026' END AS returned_model, CASE WHEN event_id % 11 = 0 THEN ' ' ELSE 'text' END AS text FROM @events""")
    return requests.classified(rows).select("event_id", "state")


@query(f"WITH {SCORED}, v AS (SELECT language, model_kind, sum(f1) / sum(f1_den) AS value FROM s GROUP BY GROUPING SETS ((language, model_kind), (model_kind))) SELECT a.language, b.value - a.value AS delta FROM v a JOIN v b ON a.language IS NOT DISTINCT FROM b.language WHERE a.model_kind = 'base' AND b.model_kind = 'adapter'")
def comparison_report(spark, sf_dir):
    return reports.compared(_scored(spark, sf_dir), "base", "adapter", "en", 20).deltas.where("metric = 'argument_f1'").select("language", "delta")


@query()
def comparison_intervals(spark, sf_dir):
    """Intervals of each language with the default of 2,000 resamples; comparison_report is the small case that SQL checks."""
    return reports.compared(_scored(spark, sf_dir), "base", "adapter", "en").intervals


# Statistics of the pairs, and small contracts.


@query()
def mcnemar_test(spark, sf_dir):
    """Discordant pairs with the exact two-sided p-value; a test compares it with the binomial tail."""
    found = scoring.discordant(*_kinds(spark, sf_dir)).first()
    return spark.createDataFrame([(found["reference_only"], found["candidate_only"], scoring.mcnemar_p(found["reference_only"], found["candidate_only"]))], "reference_only long, candidate_only long, p_value double")


@query()
def claim_gates(spark, sf_dir):
    """Intervals of 2,000 resamples with the claims that they allow."""
    return scoring.claims(scoring.bootstrap(*_kinds(spark, sf_dir), 2000, "s1"))


@query("SELECT doc_id, concat('{\"a\":\"', lang, ' \\u0026 \\u003cb\\u003e\",\"n\":1.0}') AS safe FROM documents")
def html_safe_json(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", """concat('{"n": 1.0, "a": "', lang, ' & <b>"}') AS payload""")
    return rows.select("doc_id", calls.html_safe_json("payload").alias("safe"))


@query("""SELECT doc_id, concat('<2fr> ', text) AS seq2seq, CASE WHEN doc_id % 2 = 0 THEN 2 END AS messages, concat('{"source_lang_code":"en","target_lang_code":"fr","text":"x __KEEP_0000__ y","type":"text"}') AS plain FROM documents""")
def translator_inputs(spark, sf_dir):
    """Inputs of three families of translators."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns({"query": F.concat(F.lit("x "), "source", F.lit(" y")), "spans": F.array("source")})
    context = F.when(F.col("doc_id") % 2 == 0, F.lit('{"name":"f"}'))
    chat = requests.conversation(F.col("query"), F.col("spans"), "fr", context, F.concat(F.lit("lost "), "source"))
    plain = requests.conversation(F.col("query"), F.col("spans"), "fr")
    return rows.select("doc_id", requests.seq2seq_input(F.col("text"), "fr").alias("seq2seq"), F.when(chat.isNotNull(), F.size(chat)).alias("messages"), plain[0]["content"].alias("plain"))


@query("""WITH j AS ({JOURNAL}), l AS (SELECT source_id, max(ordinal) AS last, arg_max(event, ordinal) AS event FROM j GROUP BY source_id), s AS (SELECT event_id AS ordinal, concat('s', CAST(event_id AS VARCHAR)) AS source_id FROM events WHERE event_id % 2 = 0)
  SELECT s.ordinal, s.source_id, l.last AS progress_ordinal, l.event FROM s LEFT JOIN l USING (source_id)""")
def resumed_rows(spark, sf_dir):
    """Selected rows with the last record of their progress."""
    rows = fx.view(spark, sf_dir, "SELECT event_id AS ordinal, concat('s', CAST(event_id AS STRING)) AS source_id FROM @events WHERE event_id % 2 = 0")
    return journals.resumed(rows, fx.view(spark, sf_dir, fx.JOURNAL).select("ordinal", "source_id", "event")).select("ordinal", "source_id", "progress_ordinal", "event")


@query("""SELECT source_id, CASE WHEN n % 4 = 0 AND n % 3 <> 0 THEN 'done' END AS outcome FROM (SELECT DISTINCT concat('s', CAST(user_id AS VARCHAR)) AS source_id, CAST(user_id AS BIGINT) AS n FROM events)""")
def reusable_outcomes(spark, sf_dir):
    """Outcomes of a journal that may be used again: same digests, and the audit still passes."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("cast(user_id as bigint) AS n").distinct().selectExpr("concat('s', n) AS source_id", "n", "'q' AS source_query_sha256", "'r' AS source_row_sha256", "'i' AS identity")
    journal = rows.selectExpr("source_id", "n AS ordinal", "if(n % 4 = 0, 'q', 'other') AS source_query_sha256", "source_row_sha256", "identity", "'done' AS outcome")
    return journals.reusable(rows, journal, lambda df: df.withColumn("reason", F.when(F.col("n") % 3 == 0, F.lit("untranslated_output")))).select("source_id", "outcome")


@query("SELECT * FROM (VALUES ('fr', 'French', CAST(NULL AS VARCHAR), 0.0::DOUBLE, true), ('he', 'Hebrew', 'HEBREW', 0.5::DOUBLE, false)) t(code, name, script, least_share, decimal_comma)")
def translation_targets(spark, sf_dir):
    return spark.createDataFrame([(t.code, t.name, t.script, t.least_share, t.decimal_comma) for t in audits.TARGETS.values()], "code string, name string, script string, least_share double, decimal_comma boolean")
