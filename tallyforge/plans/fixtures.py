"""Inputs made of the driver's tables by SQL that Spark and DuckDB read alike. @name stands for a table.

Every row and the whole text of a table is used; doc_id classes only choose which rule a row meets."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TOOLS = """concat('[{"name":"lookup","description":"find in ', source, '","parameters":{"lang":{"type":"string"}}}]')"""
ANSWERS = """concat('[{"name":"lookup","arguments":{"n":', CAST(n_chars AS STRING), ',"lang":"', lang, '"}}]')"""

#: Raw rows with every reason to drop one, by doc_id % 20.
RAW = f"""
SELECT doc_id AS ordinal, concat('doc:', CAST(doc_id AS STRING)) AS source_id, lang AS language, CAST(NULL AS STRING) AS source_example_id, 'r1' AS source_revision,
  CASE doc_id % 20 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 4 THEN 'hi' ELSE text END AS query,
  CASE doc_id % 20 WHEN 2 THEN '' WHEN 5 THEN 'not json' WHEN 6 THEN '{{"name":"lookup"}}' WHEN 11 THEN '[{{"name":"","description":"d","parameters":{{}}}}]' ELSE {TOOLS} END AS tools,
  CASE doc_id % 20 WHEN 3 THEN ' ' WHEN 7 THEN '[1' WHEN 8 THEN '[]' WHEN 9 THEN '[{{"name":"a","arguments":{{}}}},{{"name":"b","arguments":{{}}}}]'
    WHEN 10 THEN '[{{"name":"a"}},{{"name":"b","arguments":{{}}}}]' WHEN 12 THEN '[{{"name":"lookup","arguments":[]}}]' ELSE {ANSWERS} END AS answers
FROM @documents"""

#: Selected roots: every document, in a split by doc_id.
ROOTS = f"""
SELECT doc_id AS ordinal, concat('doc:', CAST(doc_id AS STRING)) AS example_id, 'en' AS language, CAST(NULL AS STRING) AS source_example_id,
  CASE WHEN doc_id % 10 = 8 THEN 'validation' WHEN doc_id % 10 = 9 THEN 'test' ELSE 'train' END AS split,
  sha2(concat('root ', CAST(doc_id AS STRING)), 256) AS query_sha256, {TOOLS} AS tools, {ANSWERS} AS answers
FROM @documents"""

#: Translations of the roots with each fault, by doc_id % 12.
PAIRS = f"""
SELECT doc_id * 2 + k AS ordinal, concat('doc:', CAST(doc_id AS STRING), ':fr', CAST(k AS STRING)) AS example_id, 'fr' AS language,
  CASE doc_id % 12 WHEN 1 THEN 'doc:none' ELSE concat('doc:', CAST(doc_id AS STRING)) END AS source_example_id,
  CASE WHEN doc_id % 12 = 5 AND k = 0 THEN sha2(concat('root ', CAST(doc_id + 1 AS STRING)), 256) ELSE sha2(concat('pair ', CAST(doc_id AS STRING), CAST(k AS STRING)), 256) END AS query_sha256,
  CASE WHEN doc_id % 12 = 2 AND k = 0 THEN '[]' ELSE {TOOLS} END AS tools,
  CASE WHEN doc_id % 12 = 3 OR (doc_id % 12 = 4 AND k = 1) THEN '[]' ELSE {ANSWERS} END AS answers
FROM @documents, (SELECT 0 AS k UNION ALL SELECT 1 AS k) AS two"""

GOLD = """concat('{"lang":"', lang, '","n":', CAST(n_chars AS STRING), ',"tags":["a","b"]}')"""
CALL = f"""concat('{{"name": "lookup", "arguments": ', {GOLD}, '}}')"""

#: Generations of two models by (doc_id * 7 + model) % 10; the prompt digest stands for the prompt.
GENERATIONS = f"""
SELECT doc_id AS ordinal, concat('doc:', CAST(doc_id AS STRING)) AS example_id, lang AS language, model_kind, sha2(text, 256) AS prompt_sha256,
  'lookup' AS gold_name, {GOLD} AS gold_arguments, (doc_id * 7 + m * (1 + doc_id % 3)) % 10 AS kind,
  CASE (doc_id * 7 + m * (1 + doc_id % 3)) % 10 WHEN 0 THEN {CALL} WHEN 1 THEN concat('Sure: ', {CALL}, ' done ]') WHEN 2 THEN concat('[', {CALL}, ']')
    WHEN 3 THEN concat('{{"name": "other", "arguments": ', {GOLD}, '}}') WHEN 4 THEN concat('{{"arguments": {{"lang":"', lang, '","tags":["a","b"]}}, "name": "lookup"}}')
    WHEN 5 THEN concat('{{"name": "lookup", "arguments": {{"x": {{}}, "tags":["a","b"], "n":', CAST(n_chars AS STRING), ', "lang":"', lang, '"}}}}')
    WHEN 6 THEN 'no call here' WHEN 7 THEN '{{"name": "lookup"' WHEN 8 THEN '[]' ELSE concat('{{"name": "lookup", "arguments": {{"lang":"', lang, '","n":', CAST(n_chars AS STRING), ',"tags":["b","a"]}}}}') END AS raw_text
FROM @documents, (SELECT 0 AS m, 'base' AS model_kind UNION ALL SELECT 1 AS m, 'adapter' AS model_kind) AS models"""

#: Journal events: user is the source, day the attempt, in event order.
JOURNAL = """
SELECT event_id AS ordinal, concat('s', CAST(user_id AS STRING)) AS source_id,
  CASE event_type WHEN 'purchase' THEN 'response' WHEN 'click' THEN 'replay' WHEN 'view' THEN 'resource_unavailable' ELSE 'request_error' END AS event,
  CASE WHEN user_id % 9 = 4 THEN event_id % 3 + 2 ELSE event_id % 3 + 1 END AS attempt, concat('r', CAST(event_id % 701 AS STRING)) AS request_sha256, concat('b', CAST(event_id % 5 AS STRING)) AS body_sha256,
  event_id % 4 <> 0 AS replayable, event_id % 11 = 0 AS retry_scheduled, concat('m', CAST(event_id % 2 AS STRING)) AS returned_model,
  CASE WHEN event_id % 2 = 0 THEN 'flex' ELSE 'default' END AS tier, event_id % 4096 AS body_bytes,
  event_id % 300001 AS input_tokens, event_id % 300001 % 97 AS cached_tokens, event_id % 211 AS output_tokens, event_id % 13 AS reasoning_tokens,
  event_id % 300001 + event_id % 211 + CASE WHEN event_id % 499 = 0 THEN 1 ELSE 0 END AS total_tokens,
  CASE WHEN event_id % 3 = 0 THEN 'wrong_script' WHEN event_id % 7 = 0 THEN 'empty_output' END AS dropped
FROM @events"""


def tables(sql: str, sf_dir: str) -> str:
    """The SQL with each @name as a Parquet path for Spark."""
    return re.sub(r"@(\w+)", lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", sql)


def plain(sql: str) -> str:
    """The SQL with each @name as a view's name, and digests as DuckDB spells them."""
    return re.sub(r"sha2\((.*?), 256\)(?=\)| (?:AS|ELSE|END))", r"sha256(\1)", re.sub(r"@(\w+)", r"\1", sql))


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(tables(sql, sf_dir))
