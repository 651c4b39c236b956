"""Tokenizer reports: records of formatted examples against their roots, summaries by language and split, and their rules.

Rules fail closed: `record_faults` lists every breach, and `prepare.require` raises on the first. Percentiles are by nearest rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.errors import InvariantError

from .prepare import SPLITS
from .prompts import COUNTS

#: Token counts whose ratios are checked again against their records.
TOKEN_COUNTS = ["query_tokens", "prompt_tokens", "target_tokens", "full_tokens"]


def user_query(messages: Column) -> Column:
    """The content of the one user message; null if there are none or several, or it is empty."""
    own = F.filter(messages, lambda m: m["role"] == "user")
    return F.when((F.size(own) == 1) & (F.length(own[0]["content"]) > 0), own[0]["content"])


def finite_ratio(numerator: Column, denominator: Column, context: str) -> Column:
    """The quotient; a denominator of 0 or less, or a value that isn't finite, fails the query."""
    value = numerator.cast("double") / F.nullif(denominator, F.lit(0))
    bad = (denominator <= 0) | F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(bad, F.raise_error(F.lit(f"{context}: the ratio isn't finite or has no positive denominator")).cast("double")).otherwise(value)


def finite(column: Column, context: str) -> Column:
    """The number as a double; NaN and infinity fail the query."""
    value = column.cast("double")
    return F.when(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), F.raise_error(F.lit(f"{context}: not a finite number")).cast("double")).otherwise(value)


def record_faults(examples: DataFrame, root: str, languages: list[str]) -> DataFrame:
    """rule, key: every breach of the pairing rules by formatted examples (example_id, language, source_example_id, split,
    target_text): repeated ids, unknown languages, roots that name a root, pairs that don't, pairs without a root, in another
    split, repeated, or with another target; and splits without a root or languages without a pair."""
    is_root = F.col("language") == root
    rule = lambda name, rows, key="example_id": rows.select(F.lit(name).alias("rule"), F.col(key).cast("string").alias("key"))
    twice = examples.groupBy("example_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    roots = examples.where(is_root & F.col("source_example_id").isNull()).groupBy(F.col("example_id").alias("root_id")).agg(F.min("split").alias("root_split"), F.min("target_text").alias("root_target"))
    pairs = examples.where(~is_root & F.col("source_example_id").isNotNull())
    joined = pairs.join(roots, F.col("source_example_id") == F.col("root_id"), "left")
    repeated = pairs.groupBy("language", "source_example_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("key", F.concat_ws(":", "language", "source_example_id"))
    cells = examples.sparkSession.createDataFrame([("missing_root_split", root, s) for s in SPLITS] + [("missing_language", x, None) for x in languages if x != root], "rule string, language string, split string")
    seen = examples.where(is_root).select("language", "split").distinct().unionByName(examples.where(~is_root).select("language", F.lit(None).cast("string").alias("split")).distinct())
    empty = cells.join(seen, (cells["language"] == seen["language"]) & cells["split"].eqNullSafe(seen["split"]), "left_anti")
    out = [
        rule("duplicate_id", twice), rule("unknown_language", examples.where(~F.col("language").isin(languages))), rule("root_names_a_root", examples.where(is_root & F.col("source_example_id").isNotNull())),
        rule("pair_without_root", examples.where(~is_root & F.col("source_example_id").isNull())), rule("missing_root", joined.where("root_id is null")), rule("other_split", joined.where("split <> root_split")),
        rule("duplicate_pair", repeated, "key"), rule("other_target", joined.where("target_text <> root_target")), empty.select("rule", F.coalesce("split", "language").alias("key")),
    ]
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def records(counted: DataFrame, root: str) -> DataFrame:
    """counted (example_id, language, split, source_example_id, COUNTS, over_budget) with root_example_id and `<count>_ratio` to
    the root's count, null for roots."""
    rows = counted.withColumn("root_example_id", F.coalesce("source_example_id", "example_id"))
    roots = rows.where(F.col("language") == root).select(F.col("example_id").alias("root_key"), *[F.col(c).alias(f"root_{c}") for c in COUNTS])
    joined = rows.join(roots, F.col("root_example_id") == F.col("root_key"), "left")
    ratios = {f"{c}_ratio": F.when(F.col("language") != root, finite_ratio(F.col(c), F.col(f"root_{c}"), c)) for c in COUNTS}
    return joined.withColumns(ratios).drop("root_key", *[f"root_{c}" for c in COUNTS])


def _unpivoted(rows: DataFrame, keys: list[str], columns: list[str], more: dict[str, str] | None = None) -> DataFrame:
    """keys, name, value (and further columns by name pattern) of several columns as rows."""
    fields = lambda c: [F.lit(c).alias("name"), F.col(c).alias("value"), *[F.col(p.format(c)).alias(a) for a, p in (more or {}).items()]]
    return rows.select(*keys, F.explode(F.array(*[F.struct(*fields(c)) for c in columns])).alias("u")).select(*keys, "u.*")


def _rank(p: float, column: str, name: str) -> Column:
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {column})").alias(name)


def summary(counted: DataFrame) -> DataFrame:
    """language, split (null: all), name of a count, examples, total, mean, p50, p95, p99, most: all seven COUNTS."""
    rows = _unpivoted(counted, ["language", "split"], COUNTS)
    own = [F.count(F.lit(1)).alias("examples"), F.sum("value").alias("total"), (F.sum("value") / F.count(F.lit(1))).alias("mean")]
    ranks = [_rank(0.5, "value", "p50"), _rank(0.95, "value", "p95"), _rank(0.99, "value", "p99"), F.max("value").alias("most")]
    return rows.groupingSets([["language", "split", "name"], ["language", "name"]], "language", "split", "name").agg(*own, *ranks)


def rates(counted: DataFrame) -> DataFrame:
    """language, split (null: all), examples, over_budget, and tokens of queries by character, byte and word."""
    total = counted.groupingSets([["language", "split"], ["language"]], "language", "split").agg(F.count(F.lit(1)).alias("examples"), F.count_if("over_budget").alias("over_budget"), *[F.sum(c).alias(c) for c in COUNTS[:4]])
    by = {"tokens_per_character": "query_chars", "tokens_per_byte": "query_bytes", "tokens_per_word": "query_words"}
    return total.select("language", "split", "examples", "over_budget", *[finite_ratio(F.col("query_tokens"), F.col(c), n).alias(n) for n, c in by.items()])


def paired_summary(recorded: DataFrame, root: str) -> DataFrame:
    """language, split (null: all), name, pairs, roots, coverage, paired_total, root_total, ratio, p50, p95, most of the pairs'
    ratios. recorded: as records() gives it."""
    sets = [["language", "split", "name"], ["language", "name"]]
    pairs = _unpivoted(recorded.where(F.col("language") != root), ["language", "split"], COUNTS, {"share": "{}_ratio"})
    total = pairs.groupingSets(sets, "language", "split", "name").agg(F.count(F.lit(1)).alias("pairs"), F.sum("value").alias("paired_total"), F.sum(F.col("value") / F.col("share")).alias("root_sum"), _rank(0.5, "share", "p50"), _rank(0.95, "share", "p95"), F.max("share").alias("most"))
    roots = recorded.where(F.col("language") == root).groupingSets([["split"], []], "split").agg(F.count(F.lit(1)).alias("roots"))
    root_total = F.round("root_sum").cast("long")
    joined = total.join(F.broadcast(roots.withColumnRenamed("split", "root_split")), F.col("split").eqNullSafe(F.col("root_split")))  # a row for each split
    return joined.select("language", "split", "name", "pairs", "roots", finite_ratio(F.col("pairs"), F.col("roots"), "coverage").alias("coverage"), "paired_total", root_total.alias("root_total"), finite_ratio(F.col("paired_total"), root_total, "totals").alias("ratio"), "p50", "p95", "most")


def reconciled(recorded: DataFrame, reported: DataFrame, root: str, tolerance: float = 1e-12) -> DataFrame:
    """Cells of a stored report (language, split, name, pairs, roots, paired_total, root_total, ratio) that the records don't
    give again, with what is wrong: missing, unknown, coverage, totals or ratio."""
    own = paired_summary(recorded, root).where(F.col("name").isin(TOKEN_COUNTS)).select("language", "split", "name", *[F.col(c).alias(f"own_{c}") for c in ("pairs", "roots", "paired_total", "root_total", "ratio")])
    other = reported.where(F.col("name").isin(TOKEN_COUNTS)).select(F.col("language").alias("r_language"), F.col("split").alias("r_split"), F.col("name").alias("r_name"), "pairs", "roots", "paired_total", "root_total", "ratio")
    joined = own.join(other, (F.col("language") == F.col("r_language")) & F.col("split").eqNullSafe(F.col("r_split")) & (F.col("name") == F.col("r_name")), "full_outer")
    differs = lambda *cs: F.greatest(*[(F.col(f"own_{c}") != F.col(c)).cast("int") for c in cs]) == 1
    why = (
        F.when(F.col("r_name").isNull(), "missing")
        .when(F.col("name").isNull(), "unknown")
        .when(differs("pairs", "roots"), "coverage")
        .when(differs("paired_total", "root_total"), "totals")
        .when(F.abs(F.col("own_ratio") - F.col("ratio")) > tolerance, "ratio")
    )
    return joined.select(F.coalesce("language", "r_language").alias("language"), F.coalesce("split", "r_split").alias("split"), F.coalesce("name", "r_name").alias("name"), why.alias("fault")).where("fault is not null")


def canonical_order(rows: DataFrame, languages: list[str]) -> DataFrame:
    """rows sorted by split, root, language in configuration order, and id."""
    unknown = [x for x in SPLITS if not x]
    if unknown or len(set(languages)) < len(languages):
        raise InvariantError("languages must be distinct")
    rank = lambda column, names: F.array_position(F.array(*[F.lit(n) for n in names]), F.col(column))
    return rows.orderBy(rank("split", SPLITS), F.coalesce("source_example_id", "example_id"), rank("language", languages), "example_id")
