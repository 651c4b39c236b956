"""Queries opN_<name> over a directory of tables, with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import documents


def op1_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm import scored

    return scored(documents(spark, sf_dir))


def op2_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identified

    return identified(documents(spark, sf_dir))


def op3_toxicity_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import scored

    return scored(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_components

    return jaccard_components(documents(spark, sf_dir), 3, 90)


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urls import filter_urls, listed_by_host

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return filter_urls(pages, listed_by_host(pages))


def op6_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import packed

    return packed(documents(spark, sf_dir))


def op7_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k

    docs = documents(spark, sf_dir)
    asked = docs.where(F.col("doc_id") % 100 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return top_k(docs, asked)


def op8_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contaminated

    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_pii

    return find_pii(documents(spark, sf_dir))


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hilbert import hilbert_shards

    return hilbert_shards(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS t FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) >= 3 THEN list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]) WHEN len(t) > 0 THEN [array_to_string(t, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 90 * (a.n + b.n - i)),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
c AS (SELECT x, min(y) AS y FROM r GROUP BY x), k AS (SELECT x, count(*) AS k FROM l GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.y, d.doc_id)) AS component_id, coalesce(k.k, 0) AS n_links
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.x = d.doc_id LEFT JOIN k ON k.x = d.doc_id"""


def _url_sql() -> str:
    from .urls import RULES, TRACKING

    by_length = sorted(RULES, key=lambda r: (-len(r[1]), r[1]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}')" for _, r in by_length for h, _, p in [r.partition("/")]]
    rule = " ".join(f"WHEN {f} THEN '{r}'" for f, (_, r) in zip(fits, by_length, strict=True))
    ruled = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _) in zip(fits, by_length, strict=True))
    return rf"""
WITH a AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)),
b AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS tail FROM a),
c AS (SELECT *, regexp_extract(tail, '^[^?#]*') AS path, list_sort(list_filter(string_split(regexp_extract(tail, '^[^?#]*\?([^#]*)', 1), '&'), lambda p: NOT regexp_matches(p, '{TRACKING}'))) AS kept FROM b),
d AS (SELECT *, CASE WHEN strpos(url, '://') > 0 THEN regexp_replace(host, '^www\.|:(80|443)?$', '', 'g') || regexp_replace(path, '/+$', '') || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical FROM c),
l AS (SELECT DISTINCT canonical FROM d WHERE regexp_matches(host, '(^|\.)(spam|cheap|casino|adult)'))
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {ruled} WHEN canonical IN (SELECT canonical FROM l WHERE canonical IS NOT NULL) THEN 'block' ELSE 'allow' END AS verdict FROM d"""


ORACLES = {"op4_ngram_jaccard_join": JACCARD_SQL, "op5_url_filters": _url_sql()}
