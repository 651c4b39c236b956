"""Queries of selection, matched pairs, tokenizer reports, review, and hooks for models, with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import audits, payloads, spans
from tallyforge.operators import cohorts, generation, prepare, prompts, review, scoring, secrets, tokenization
from tallyforge.sources import records

from . import fixtures as fx
from .queries import DIGESTED, LEAST, MOST, SCORED, query


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# Splits and selection.


@query()
def shuffled_split(spark, sf_dir):
    """The split by Python's seeded shuffle; SQL has no such generator, so a test compares it with the plain rule."""
    rows = prepare.deduplicated(prepare.validated(fx.view(spark, sf_dir, fx.RAW), LEAST, MOST), "language").where("reason is null").withColumn("example_id", F.col("source_id"))
    return prepare.shuffled_split(rows, 42, {"train": 40, "validation": 8, "test": 8}).select("example_id", "split", "split_place")


@query()
def export_shuffled(spark, sf_dir):
    return records.exported(_docs(spark, sf_dir), {"id": "doc_id", "query": "text"}, "documents", 7, 150, "doc_id")


@query(
    f"""WITH {DIGESTED.replace('PARTITION BY language', 'PARTITION BY 1').replace('language AS l, digest AS d', "1 AS l, digest AS d").replace('ON l = language AND d = digest', 'ON d = digest')}, roots AS ({{ROOTS}}),
  p AS (SELECT ordinal, source_id AS example_id, CASE WHEN ordinal % 3 = 0 THEN NULL ELSE concat('doc:', CAST(ordinal % 50 AS VARCHAR)) END AS source_example_id, digest, reason, tools, answers FROM final),
  t AS (SELECT query_sha256 AS q, min(split) AS text_split FROM roots GROUP BY ALL),
  j AS (SELECT p.*, r.split AS root_split, CASE WHEN r.split IS NULL THEN 'missing_source_example' WHEN p.tools <> r.tools THEN 'pair_tools_mismatch' WHEN p.answers <> r.answers THEN 'pair_answers_mismatch' WHEN text_split <> r.split THEN 'cross_split_duplicate' END AS fault
    FROM p LEFT JOIN roots r ON r.example_id = p.source_example_id LEFT JOIN t ON q = p.digest WHERE p.reason IS NULL),
  k AS (SELECT *, min(ordinal) FILTER (fault IS NULL) OVER (PARTITION BY source_example_id) AS taken FROM j)
  SELECT ordinal, root_split AS split, CASE WHEN coalesce(fault, '') <> 'missing_source_example' AND ordinal > taken THEN 'duplicate_source_example' ELSE fault END AS reason FROM k UNION ALL SELECT ordinal, NULL, reason FROM p WHERE reason IS NOT NULL"""
)
def pair_result(spark, sf_dir):
    """Raw translations validated, deduplicated and paired in one go."""
    rows = fx.view(spark, sf_dir, fx.RAW).withColumn("source_example_id", F.when(F.col("ordinal") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("doc:"), (F.col("ordinal") % 50).cast("string"))))
    return prepare.pair_result(rows, fx.view(spark, sf_dir, fx.ROOTS), LEAST, MOST).select("ordinal", "split", "reason")


@query("WITH roots AS ({ROOTS}), raw AS ({RAW}) SELECT ordinal, source_id FROM raw WHERE source_id IN (SELECT example_id FROM roots WHERE split <> 'train') ORDER BY ordinal LIMIT 150")
def selected_rows(spark, sf_dir):
    """The first rows, in input order, whose ids the evaluation splits hold."""
    ids = cohorts.selected_ids(fx.view(spark, sf_dir, fx.ROOTS).where("split <> 'train'"))
    return cohorts.selected(fx.view(spark, sf_dir, fx.RAW), ids, limit=150).select("ordinal", "source_id")


@query("SELECT lang AS language, count(*) AS n FROM documents WHERE lang IN ('en', 'fr') GROUP BY lang")
def training_languages(spark, sf_dir):
    rows, _ = cohorts.languages_kept(_docs(spark, sf_dir).withColumnRenamed("lang", "language"), ["en", "fr"])
    return rows.groupBy("language").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH c AS (SELECT unnest(['en', 'he', 'xx']) AS language), d AS (SELECT DISTINCT lang AS language FROM documents)
  SELECT language, 'missing' AS problem FROM c WHERE language NOT IN (SELECT language FROM d) UNION ALL SELECT language, 'unexpected' FROM d WHERE language NOT IN (SELECT language FROM c)""")
def language_difference(spark, sf_dir):
    return cohorts.language_difference(["en", "he", "xx"], _docs(spark, sf_dir).select(F.col("lang").alias("language")))


@query("WITH roots AS ({ROOTS}) SELECT d.lang AS language, count(*) AS n FROM roots r JOIN documents d ON r.ordinal = d.doc_id WHERE r.split = 'test' AND d.lang IN ('en', 'de') GROUP BY d.lang")
def test_slice_sizes(spark, sf_dir):
    rows = fx.view(spark, sf_dir, fx.ROOTS).drop("language").join(_docs(spark, sf_dir).select(F.col("doc_id").alias("ordinal"), F.col("lang").alias("language")), "ordinal")
    return cohorts.test_slices(rows, ["en", "de"]).groupBy("language").agg(F.count(F.lit(1)).alias("n"))


@query("WITH roots AS ({ROOTS}) SELECT example_id AS id, split FROM roots WHERE split IS NOT NULL")
def root_splits(spark, sf_dir):
    return cohorts.split_of(fx.view(spark, sf_dir, fx.ROOTS))


@query("""SELECT concat(s, '-', CAST(i AS VARCHAR), CASE l WHEN 'en' THEN '' ELSE '-fr' END) AS example_id, l AS language, CASE l WHEN 'fr' THEN concat(s, '-', CAST(i AS VARCHAR)) END AS source_example_id, s AS split
  FROM (VALUES ('train', 40), ('validation', 5), ('test', 7)) z(s, n), (VALUES ('en'), ('fr')) y(l), range(1, 41) x(i) WHERE i <= n""")
def fixture_examples(spark, sf_dir):
    return cohorts.fixture_examples(spark, {"train": 40, "validation": 5, "test": 7}, ["en", "fr"]).select("example_id", "language", "source_example_id", "split")


# Matched pairs.

#: Roots and translations of two in three of them, with each fault of a pairing in a hundredth of the rows if asked for.
PAIRING = """SELECT doc_id * 2 AS ordinal, concat('doc:', CAST(doc_id AS STRING)) AS example_id, CAST(NULL AS STRING) AS source_example_id, 'en' AS language, sha2(text, 256) AS prompt_sha256, concat(lang, ' ', source) AS gold FROM @documents
  UNION ALL SELECT doc_id * 2 + 1, concat('doc:', CAST(doc_id AS STRING), ':fr'), CASE doc_id % 40 WHEN 1 THEN NULL WHEN 2 THEN 'doc:none' WHEN 4 THEN concat('doc:', CAST(doc_id + 1 AS STRING)) ELSE concat('doc:', CAST(doc_id AS STRING)) END,
  'fr', sha2(concat(text, ' fr'), 256) AS prompt_sha256, CASE WHEN doc_id % 40 = 7 THEN 'other' WHEN doc_id % 40 = 4 THEN 'none' ELSE concat(lang, ' ', source) END FROM @documents WHERE doc_id % 3 <> 0"""
SOUND = "doc_id % 40 NOT IN (1, 2, 4, 7)"


def _pairing(spark: SparkSession, sf_dir: str, sound: bool) -> tuple[DataFrame, DataFrame]:
    rows = fx.view(spark, sf_dir, PAIRING)
    targets = rows.where("language = 'fr'")
    return (targets.where(f"NOT (ordinal - 1) div 2 % 40 IN (1, 2, 4, 7)") if sound else targets), rows.where("language = 'en'")  # noqa: F541


@query(
    f"""WITH r AS ({fx.plain(PAIRING)}), t AS (SELECT * FROM r WHERE language = 'fr'), o AS (SELECT example_id AS i, gold AS g FROM r WHERE language = 'en'), f AS (SELECT source_example_id AS s, min(example_id) AS first, count(*) AS n FROM t WHERE source_example_id IS NOT NULL GROUP BY 1)
  SELECT example_id, 'unpaired' AS fault FROM t WHERE source_example_id IS NULL UNION ALL SELECT example_id, 'missing_root' FROM t WHERE source_example_id IS NOT NULL AND source_example_id NOT IN (SELECT i FROM o)
  UNION ALL SELECT example_id, 'other_gold' FROM t JOIN o ON i = source_example_id WHERE gold <> g UNION ALL SELECT example_id, 'repeated_root' FROM t JOIN f ON s = source_example_id WHERE n > 1 AND example_id <> first"""
)
def pairing_faults(spark, sf_dir):
    return cohorts.pair_faults(*_pairing(spark, sf_dir, False))


@query(
    f"""WITH r AS ({fx.plain(PAIRING)}), t AS (SELECT * FROM r WHERE language = 'fr' AND NOT ((ordinal - 1) // 2) % 40 IN (1, 2, 4, 7)), o AS (SELECT * FROM r WHERE language = 'en')
  SELECT count(*) AS n, sha256(string_agg(concat('{{"reference_example_id":"', o.example_id, '","reference_prompt_sha256":"', o.prompt_sha256, '","target_example_id":"', t.example_id, '","target_prompt_sha256":"', t.prompt_sha256, '"}}'), chr(10) ORDER BY t.ordinal)) AS digest FROM t JOIN o ON o.example_id = t.source_example_id"""
)
def pair_set_digest(spark, sf_dir):
    return cohorts.pair_set_digest(*_pairing(spark, sf_dir, True))


@query(
    f"""WITH r AS ({fx.plain(PAIRING)}), o AS (SELECT example_id, row_number() OVER (ORDER BY ordinal) - 1 AS place FROM r WHERE language = 'en'), t AS (SELECT * FROM r WHERE language = 'fr' AND NOT ((ordinal - 1) // 2) % 40 IN (1, 2, 4, 7))
  SELECT 'ids' AS what, count(*) AS n, sha256(string_agg(example_id, chr(10) ORDER BY ordinal)) AS digest FROM t UNION ALL SELECT 'places', count(*), sha256(concat('[', string_agg(CAST(place AS VARCHAR), ',' ORDER BY t.ordinal), ']')) FROM t JOIN o ON o.example_id = t.source_example_id"""
)
def order_digests(spark, sf_dir):
    """Digests of the targets' ids in order, and of the places of their roots."""
    targets, roots = _pairing(spark, sf_dir, True)
    places = cohorts.index_digest(cohorts.root_places(targets, roots))
    return cohorts.id_digest(targets).withColumn("what", F.lit("ids")).unionByName(places.withColumn("what", F.lit("places"))).select("what", "n", "digest")


def _matched(spark: SparkSession, sf_dir: str):
    rows = scoring.scored(prepare.spread(fx.view(spark, sf_dir, fx.GENERATIONS)))
    roots = rows.where("model_kind = 'base'").withColumns({"language": F.lit("en"), "source_example_id": F.lit(None).cast("string")})
    own = rows.where("model_kind = 'adapter' AND ordinal % 3 <> 0").withColumns({"language": F.lit("fr"), "source_example_id": F.col("example_id"), "example_id": F.concat("example_id", F.lit(":fr"))})
    return cohorts.matched(roots.unionByName(own), "en", "fr", 50)


@query(
    f"""WITH {SCORED}, b AS (SELECT a.* , c.ok AS tok, c.named AS tnamed, c.args AS targs, c.f1 AS tf1, c.f1_den AS tf1d, c.whole AS twhole FROM s a JOIN s c USING (example_id) WHERE a.model_kind = 'base' AND c.model_kind = 'adapter' AND a.ordinal % 3 <> 0),
  v AS (SELECT unnest(['valid_json_rate', 'function_name_accuracy', 'argument_exact_match', 'argument_f1', 'full_call_exact_match']) AS metric, unnest([sum(ok) / count(*), sum(named) / count(*), sum(args) / count(*), sum(f1) / sum(f1_den), sum(whole) / count(*)]) AS reference,
    unnest([sum(tok) / count(*), sum(tnamed) / count(*), sum(targs) / count(*), sum(tf1) / sum(tf1d), sum(twhole) / count(*)]) AS target FROM b)
  SELECT metric, round(reference, 9) AS reference, round(target, 9) AS target, round(target - reference, 9) AS gap FROM v"""
)
def matched_slice(spark, sf_dir):
    """Metrics of a language and of its roots on the matched pairs alone, and their gaps."""
    m = _matched(spark, sf_dir)
    side = lambda name: F.round(F.max(F.when(F.col("side") == name, F.col("value"))), 9).alias(name)
    return m.metrics.groupBy("metric").agg(side("reference"), side("target")).join(m.gaps.select("metric", F.round("gap", 9).alias("gap")), "metric")


@query()
def matched_intervals(spark, sf_dir):
    return _matched(spark, sf_dir).intervals


@query("""SELECT doc_id, sha256(concat('{"doc_id":', CAST(doc_id AS VARCHAR), ',"lang":"', lang, '","source":"', source, '"}')) AS digest FROM documents""")
def row_digests(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", cohorts.row_digest("source", "lang", "doc_id").alias("digest"))


@query("""SELECT count(*) AS n, sha256(concat(string_agg(concat('{"lang":"', lang, '","n_chars":', CAST(n_chars AS VARCHAR), ',"source":"', source, '"}'), chr(10) ORDER BY doc_id), chr(10))) AS digest FROM documents""")
def full_rows_identity(spark, sf_dir):
    return cohorts.rows_identity(_docs(spark, sf_dir).withColumn("ordinal", F.col("doc_id")), "source", "lang", "n_chars")


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def raw_query_digests(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("digest"))


@query("""WITH roots AS ({ROOTS}), p AS (SELECT example_id, split FROM roots WHERE ordinal % 50 <> 1), f AS (SELECT example_id, CASE WHEN ordinal % 50 = 2 THEN 'train' ELSE split END AS split FROM roots WHERE ordinal % 50 <> 3), t AS (SELECT example_id FROM roots WHERE ordinal % 50 NOT IN (3, 4))
  SELECT 'not_formatted' AS problem, example_id AS key FROM (SELECT * FROM p EXCEPT SELECT * FROM f) UNION ALL SELECT 'not_prepared', example_id FROM (SELECT * FROM f EXCEPT SELECT * FROM p) UNION ALL SELECT 'not_tokenized', example_id FROM (SELECT example_id FROM f EXCEPT SELECT * FROM t)
  UNION ALL SELECT 'unknown_tokens', example_id FROM (SELECT * FROM t EXCEPT SELECT example_id FROM f) UNION ALL SELECT 'size', s FROM (VALUES ('train', 3), ('validation', 5), ('test', 0)) w(s, n) WHERE n <> (SELECT count(*) FROM p WHERE split = s)""")
def cohort_identity(spark, sf_dir):
    rows = fx.view(spark, sf_dir, fx.ROOTS)
    formatted = rows.where("ordinal % 50 <> 3").withColumn("split", F.expr("CASE WHEN ordinal % 50 = 2 THEN 'train' ELSE split END"))
    return cohorts.cohort_identity(rows.where("ordinal % 50 <> 1"), formatted, rows.where("ordinal % 50 NOT IN (3, 4)"), {"train": 3, "validation": 5})


# Tokenizer reports.

SYSTEM = "Call one tool."
TAX = """SELECT doc_id * 2 AS ordinal, concat('doc:', CAST(doc_id AS STRING)) AS example_id, 'en' AS language, CAST(NULL AS STRING) AS source_example_id, CASE WHEN doc_id % 10 = 8 THEN 'validation' WHEN doc_id % 10 = 9 THEN 'test' ELSE 'train' END AS split, text AS query FROM @documents
  UNION ALL SELECT doc_id * 2 + 1, concat('doc:', CAST(doc_id AS STRING), ':fr'), 'fr', concat('doc:', CAST(doc_id AS STRING)), CASE WHEN doc_id % 10 = 8 THEN 'validation' WHEN doc_id % 10 = 9 THEN 'test' ELSE 'train' END, concat(text, ' encore un mot ', source) FROM @documents WHERE doc_id % 4 <> 0"""
_COUNT = r"CAST(len(regexp_extract_all({0}, '\S+')) AS BIGINT)"
COUNTED = f"""x AS ({fx.plain(TAX)}), y AS (SELECT *, concat('<|system|>', chr(10), 'Call one tool.', chr(10), chr(10), 'Available tools:', chr(10), '[]', chr(10), '<|user|>', chr(10), query, chr(10), '<|assistant|>', chr(10)) AS prompt FROM x),
  c AS (SELECT ordinal, example_id, language, source_example_id, split, CAST(length(query) AS BIGINT) AS query_chars, CAST(strlen(query) AS BIGINT) AS query_bytes, {_COUNT.format('query')} AS query_words, {_COUNT.format('query')} AS query_tokens, {_COUNT.format('prompt')} AS prompt_tokens, CAST(1 AS BIGINT) AS target_tokens,
    {_COUNT.format("concat(prompt, '[] ')")} AS full_tokens FROM y)"""
_NAMES = "['query_chars', 'query_bytes', 'query_words', 'query_tokens', 'prompt_tokens', 'target_tokens', 'full_tokens']"
_VALUES = "[query_chars, query_bytes, query_words, query_tokens, prompt_tokens, target_tokens, full_tokens]"


def _tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.view(spark, sf_dir, TAX).withColumn("messages", prompts.messages(F.col("query"), F.lit("[]"), F.lit("[]"), SYSTEM))
    return prompts.token_counts(prompts.rendered(rows), 1500)


@query(
    f"""WITH {COUNTED}, u AS (SELECT language, split, unnest({_NAMES}) AS name, unnest({_VALUES}) AS value FROM c)
  SELECT language, split, name, count(*) AS examples, CAST(sum(value) AS BIGINT) AS total, sum(value) / count(*) AS mean, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99, max(value) AS most FROM u GROUP BY GROUPING SETS ((language, split, name), (language, name))"""
)
def token_report(spark, sf_dir):
    """All seven counts by language and split."""
    return tokenization.summary(_tax(spark, sf_dir))


@query(
    f"""WITH {COUNTED} SELECT language, split, count(*) AS examples, count(*) FILTER (full_tokens > 1500) AS over_budget, sum(query_tokens) / sum(query_chars) AS tokens_per_character, sum(query_tokens) / sum(query_bytes) AS tokens_per_byte, sum(query_tokens) / sum(query_words) AS tokens_per_word
  FROM c GROUP BY GROUPING SETS ((language, split), (language))"""
)
def token_rates(spark, sf_dir):
    return tokenization.rates(_tax(spark, sf_dir))


@query(
    f"""WITH {COUNTED}, r AS (SELECT * FROM c WHERE language = 'en') SELECT c.example_id, coalesce(c.source_example_id, c.example_id) AS root_example_id, CASE c.language WHEN 'fr' THEN c.full_tokens / r.full_tokens END AS full_tokens_ratio, CASE c.language WHEN 'fr' THEN c.query_bytes / r.query_bytes END AS query_bytes_ratio
  FROM c LEFT JOIN r ON r.example_id = coalesce(c.source_example_id, c.example_id)"""
)
def token_records(spark, sf_dir):
    return tokenization.records(_tax(spark, sf_dir), "en").select("example_id", "root_example_id", "full_tokens_ratio", "query_bytes_ratio")


@query(
    f"""WITH {COUNTED}, n AS (SELECT example_id, language, source_example_id, split, unnest({_NAMES}) AS name, unnest({_VALUES}) AS value FROM c), p AS (SELECT a.split, a.name, a.value, b.value AS root FROM n a JOIN n b ON b.example_id = a.source_example_id AND b.name = a.name WHERE a.language = 'fr'),
  g AS (SELECT split, name, count(*) AS pairs, sum(value) AS v, sum(root) AS r, quantile_disc(value / root, 0.5) AS p50, quantile_disc(value / root, 0.95) AS p95, max(value / root) AS most FROM p GROUP BY GROUPING SETS ((split, name), (name))), o AS (SELECT split, count(*) AS roots FROM c WHERE language = 'en' GROUP BY GROUPING SETS ((split), ()))
  SELECT 'fr' AS language, g.split, name, pairs, roots, pairs / roots AS coverage, CAST(v AS BIGINT) AS paired_total, CAST(r AS BIGINT) AS root_total, v / r AS ratio, p50, p95, most FROM g JOIN o ON o.split IS NOT DISTINCT FROM g.split"""
)
def token_pairs(spark, sf_dir):
    """Coverage, totals and ratios of translations against their roots, for all seven counts."""
    return tokenization.paired_summary(tokenization.records(_tax(spark, sf_dir), "en"), "en")


@query()
def token_reconciliation(spark, sf_dir):
    """Cells of a stored report that its records don't give again; a test plants the errors."""
    rows = tokenization.records(_tax(spark, sf_dir), "en").persist()
    told = tokenization.paired_summary(rows, "en").withColumn("paired_total", F.when((F.col("split") == "test") & (F.col("name") == "full_tokens"), F.col("paired_total") + 1).otherwise(F.col("paired_total")))
    return tokenization.reconciled(rows, told, "en")


@query(
    f"""WITH r AS ({fx.plain(PAIRING)}), e AS (SELECT *, CASE WHEN (ordinal // 2) % 10 = 9 THEN 'test' ELSE 'train' END AS split FROM r), o AS (SELECT * FROM e WHERE language = 'en'), t AS (SELECT * FROM e WHERE language = 'fr')
  SELECT 'missing_root_split' AS rule, 'validation' AS key UNION ALL SELECT 'missing_language', 'he' UNION ALL SELECT 'pair_without_root', example_id FROM t WHERE source_example_id IS NULL UNION ALL SELECT 'missing_root', example_id FROM t WHERE source_example_id NOT IN (SELECT example_id FROM o)
  UNION ALL SELECT 'other_split', t.example_id FROM t JOIN o ON o.example_id = t.source_example_id WHERE t.split <> o.split UNION ALL SELECT 'other_target', t.example_id FROM t JOIN o ON o.example_id = t.source_example_id WHERE t.gold <> o.gold
  UNION ALL SELECT 'duplicate_pair', concat('fr:', source_example_id) FROM t WHERE source_example_id IS NOT NULL GROUP BY source_example_id HAVING count(*) > 1"""
)
def tokenizer_faults(spark, sf_dir):
    """Breaches of the rules of formatted examples: a table without a validation split and without one of its languages."""
    rows = fx.view(spark, sf_dir, PAIRING).withColumns({"split": F.expr("CASE WHEN (ordinal div 2) % 10 = 9 THEN 'test' ELSE 'train' END"), "target_text": F.col("gold")})
    return tokenization.record_faults(rows, "en", ["en", "fr", "he"])


@query("SELECT conv_id, CASE WHEN count(*) FILTER (role = 'user') = 1 THEN max(text) FILTER (role = 'user') END AS query FROM conversations WHERE turn < 3 GROUP BY conv_id")
def user_queries(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").where("turn < 3").groupBy("conv_id").agg(F.collect_list(F.struct("role", F.col("text").alias("content"))).alias("messages"))
    return rows.select("conv_id", tokenization.user_query(F.col("messages")).alias("query"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS ratio FROM lineitem")
def finite_ratios(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rows.select("l_orderkey", "l_linenumber", tokenization.finite_ratio(tokenization.finite(F.col("l_extendedprice"), "price"), F.col("l_quantity").cast("double"), "price").alias("ratio"))


# Review.

REVIEWED = """SELECT doc_id AS ordinal, concat('doc:', CAST(doc_id AS STRING), ':fr') AS source_id, CASE WHEN doc_id % 60 = 1 THEN 'doc:none' ELSE concat('doc:', CAST(doc_id AS STRING)) END AS source_example_id, '[]' AS tools,
  CASE WHEN doc_id % 60 = 2 THEN '[]' ELSE concat('[{"name":"', lang, '","arguments":{"a":"', source, '"}}]') END AS answers FROM @documents"""
REVIEW_ROOTS = """SELECT concat('doc:', CAST(doc_id AS STRING)) AS source_id, concat(text, ' ', source) AS query, '[]' AS tools, concat('[{"name":"', lang, '","arguments":{"a":"', source, '"}}]') AS answers FROM @documents"""


def _candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    splits = cohorts.split_of(fx.view(spark, sf_dir, fx.ROOTS).where("ordinal % 60 <> 3"))
    return review.joined(fx.view(spark, sf_dir, REVIEWED), fx.view(spark, sf_dir, REVIEW_ROOTS), splits)


@query(f"""WITH p AS ({fx.plain(REVIEWED)}) SELECT CASE ordinal % 60 WHEN 1 THEN 'missing_root' WHEN 2 THEN 'changed_gold' ELSE 'missing_split' END AS fault, source_id AS key FROM p WHERE ordinal % 60 IN (1, 2, 3)
  UNION ALL SELECT 'duplicate_root_of_pair', source_example_id FROM p GROUP BY source_example_id HAVING count(*) > 1""")
def review_faults(spark, sf_dir):
    return _candidates(spark, sf_dir)[1]


@query(
    f"""WITH roots AS ({{ROOTS}}), p AS ({fx.plain(REVIEWED)}), q AS ({fx.plain(REVIEW_ROOTS)}), j AS (SELECT p.source_id AS example_id, q.source_id AS root, q.query, r.split, p.answers FROM p JOIN q ON q.source_id = p.source_example_id AND q.answers = p.answers JOIN roots r ON r.example_id = q.source_id AND r.ordinal % 60 <> 3)
  SELECT example_id, split, CAST(least(10, (row_number() OVER (ORDER BY length(query), root) - 1) * 10 // count(*) OVER () + 1) AS VARCHAR) AS decile, json_extract_string(answers, '$[0].name') AS action FROM j"""
)
def review_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir)[0].select("example_id", "split", "decile", "action")


@query()
def review_sample(spark, sf_dir):
    """A balanced review sample in its order; greedy, so a test compares it with the plain rule."""
    chosen = review.review_sample(_candidates(spark, sf_dir)[0], 7, 100, 20)
    return spark.createDataFrame(list(enumerate(chosen)), "place long, example_id string")


# Outputs of models.

WRAPPED = """CASE doc_id % 4 WHEN 0 THEN concat('```text', chr(10), lang, chr(10), '```') WHEN 1 THEN concat('"', source, '"') WHEN 2 THEN concat(' Translation: ', source) ELSE concat('"', lang, '" or "', source, '"') END"""


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN source WHEN 2 THEN source ELSE concat('\"', lang, '\" or \"', source, '\"') END AS text FROM documents")
def unwrapped_outputs(spark, sf_dir):
    return fx.view(spark, sf_dir, f"SELECT doc_id, {WRAPPED} AS text FROM @documents").select("doc_id", audits.unwrap(F.col("text")).alias("text"))


@query("SELECT doc_id, concat('x ', CAST(n_chars AS VARCHAR), CASE WHEN doc_id % 2 = 0 THEN '.5' ELSE ',25' END, ' y') AS text FROM documents")
def restored_points(spark, sf_dir):
    rows = fx.view(spark, sf_dir, "SELECT doc_id, concat('x ', CAST(n_chars AS STRING), CASE WHEN doc_id % 2 = 0 THEN ',5' ELSE ',25' END, ' y') AS text, concat(CAST(n_chars AS STRING), '.5') AS span FROM @documents")
    return rows.select("doc_id", audits.restore_points(F.col("text"), F.array("span")).alias("text"))


@query("""SELECT doc_id, regexp_matches(concat(' ', text, ' '), concat('[^0-9A-Za-z_]', lang, '[^0-9A-Za-z_]')) AS present FROM documents""")
def spans_present(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", spans.span_present(F.col("text"), F.col("lang")).alias("present"))


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'empty_output' WHEN 1 THEN 'missing_protected_span' WHEN 2 THEN 'wrong_script' WHEN 3 THEN 'malformed_spacing' ELSE 'untranslated_output' END AS reason FROM documents""")
def rejection_categories(spark, sf_dir):
    told = "CASE doc_id % 5 WHEN 0 THEN 'the output was empty' WHEN 1 THEN concat('missing protected spans: ', source) WHEN 2 THEN 'the output has letters of a foreign script' WHEN 3 THEN 'the output lacks word boundaries' ELSE 'the output equals its source' END"
    return fx.view(spark, sf_dir, f"SELECT doc_id, {told} AS text FROM @documents").select("doc_id", audits.category(F.col("text")).alias("reason"))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'bidi_control' WHEN 1 THEN 'replacement_character' WHEN 2 THEN 'control' END AS fault FROM documents""")
def unsafe_outputs(spark, sf_dir):
    rows = _docs(spark, sf_dir).withColumn("output", F.concat("lang", F.when(F.col("doc_id") % 4 == 0, F.lit("‮")).when(F.col("doc_id") % 4 == 1, F.lit("�")).when(F.col("doc_id") % 4 == 2, F.lit("\x07")).otherwise(F.lit("\n"))))
    return rows.select("doc_id", audits.unsafe_text(F.col("output")).alias("fault"))


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN source END AS translation FROM documents""")
def assistant_payloads(spark, sf_dir):
    rows = _docs(spark, sf_dir).selectExpr("doc_id", """CASE doc_id % 3 WHEN 0 THEN concat('{"translation": "', source, '"}') WHEN 1 THEN concat('{"translation": "a", "translation": "', source, '"}') ELSE concat('{"translation": "', source, '", "note": 1}') END AS raw""")
    return rows.select("doc_id", payloads.parse_assistant_payload("raw").alias("translation"))


@query("""SELECT concat('doc:', CAST(doc_id AS VARCHAR)) AS example_id, CASE doc_id % 4 WHEN 0 THEN 'invalid_json' WHEN 1 THEN 'invalid_shape' ELSE 'not_canonical' END AS fault FROM documents WHERE doc_id % 4 < 3""")
def gold_target_faults(spark, sf_dir):
    text = """CASE doc_id % 4 WHEN 0 THEN '[{' WHEN 1 THEN '[]' WHEN 2 THEN concat('[{"name": "', lang, '", "arguments": {}}]') ELSE concat('[{"arguments":{},"name":"', lang, '"}]') END AS target_text"""
    return generation.target_faults(_docs(spark, sf_dir).selectExpr("concat('doc:', doc_id) AS example_id", text))


@query("""WITH roots AS ({ROOTS}) SELECT r.example_id, CASE d.doc_id % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'no_json' ELSE 'invalid_shape' END AS status, CASE d.doc_id % 3 WHEN 0 THEN d.lang END AS name, '{"do_sample":false,"max_new_tokens":64,"temperature":0.0}' AS decoding FROM roots r JOIN documents d ON d.doc_id = r.ordinal WHERE r.split = 'test'""")
def generated_answers(spark, sf_dir):
    """A model's answers by a stub that reads the prompt, parsed."""

    def model():
        def answer(prompt: str, settings: dict) -> str:
            number, language = prompt.split(" ")
            return [f'{{"name": "{language}", "arguments": {{}}}}', "none", "[]"][int(number) % 3]

        return answer

    rows = fx.view(spark, sf_dir, fx.ROOTS).where("split = 'test'").drop("language").join(_docs(spark, sf_dir).select(F.col("doc_id").alias("ordinal"), F.col("lang").alias("language")), "ordinal")
    asked = rows.withColumn("prompt_text", F.concat_ws(" ", "ordinal", "language")).withColumn("prompt_sha256", F.sha2("prompt_text", 256))
    return generation.generated(asked, model, generation.decoding(0.0, False, 64), lambda: 0.0).select("example_id", "status", "name", "decoding")


@query("SELECT doc_id, sha256(concat('S:', lang, chr(10), 'U:', text, chr(10), 'A:')) AS prompt_sha256, CAST(length(concat('S:', lang, chr(10), 'U:', text, chr(10), 'A:', source, chr(10))) AS INT) AS chars FROM documents")
def templated_prompts(spark, sf_dir):
    """Prompts by a chat template that the caller brings."""

    def renderer():
        return lambda messages, ask: "\n".join(f"{m['role'][0].upper()}:{m['content']}" for m in messages) + ("\nA:" if ask else "\n")

    said = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    rows = _docs(spark, sf_dir).select("doc_id", F.array(said("system", "lang"), said("user", "text"), said("assistant", "source")).alias("messages"))
    return generation.templated(rows, renderer).select("doc_id", "prompt_sha256", F.length("full_text").alias("chars"))


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS INT) AS n FROM documents")
def encoded_texts(spark, sf_dir):
    rows = generation.encoded(_docs(spark, sf_dir).select("doc_id", "text"), lambda: lambda text: [len(w) for w in text.split()] or [0], "text")
    return rows.select("doc_id", F.size("text_ids").alias("n"))


@query("SELECT doc_id, reverse(source) AS back FROM documents")
def translated_back(spark, sf_dir):
    return generation.translated_back(_docs(spark, sf_dir).select("doc_id", "source"), lambda: lambda texts: [t[::-1] for t in texts], "source", "back").select("doc_id", "back")


@query("""WITH c AS (SELECT conv_id, list(role ORDER BY turn) AS roles, max_by(text, turn) FILTER (role = 'user') AS query FROM conversations WHERE turn > 0 GROUP BY conv_id)
  SELECT conv_id, CASE WHEN len(list_filter(roles, lambda r: r NOT IN ('system', 'user', 'assistant', 'tool'))) > 0 THEN 'unknown_role' WHEN query IS NULL THEN 'no_user_message' WHEN conv_id % 7 = 0 THEN 'invalid_tool_shape' END AS fault, query FROM c""")
def served_requests(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").where("turn > 0").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("own"))
    rows = rows.select("conv_id", F.transform("own", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"), F.when(F.col("conv_id") % 7 == 0, F.lit("{}")).otherwise(F.lit("[]")).alias("tools"))
    return generation.served(rows).select("conv_id", "fault", "query")


# Scans.

FILES = """SELECT concat('d', CAST(doc_id AS STRING), CASE doc_id % 3 WHEN 0 THEN '.md' WHEN 1 THEN '.json' ELSE '.jsonl' END) AS file, CASE doc_id % 3 WHEN 0 THEN concat(lang, chr(10), 'hf_abcdefghijklmnopqrstuv', chr(10)) WHEN 1 THEN concat('{"x": [{"api_key": "', source, '"}, "ghp_abcdefghijklmnopqrstuv"]}')
  ELSE concat('{"eos_token": 1}', chr(10), chr(10), '{"a": 1, "a": "sk-abcdefghijklmnopqrstuv"}') END AS text FROM @documents"""


@query("""SELECT concat('d', CAST(doc_id AS VARCHAR), s) AS file, l AS location, k AS kind FROM documents JOIN (VALUES (0, '.md', 'line 2', 'secret_value'), (1, '.json', 'x[0].api_key', 'sensitive_key'), (1, '.json', 'x[1]', 'secret_value'), (2, '.jsonl', '3: <json-object>', 'duplicate_key'), (2, '.jsonl', '3: line 1', 'secret_value')) v(c, s, l, k) ON c = doc_id % 3""")
def file_findings(spark, sf_dir):
    return secrets.file_findings(fx.view(spark, sf_dir, FILES))
