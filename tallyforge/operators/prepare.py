"""Validation with counted drop reasons, first-wins deduplication, splits, pairing of translations, and leakage checks."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.errors import InputError
from tallyforge.functions.calls import SPACES, normalize_query, parse_rows

#: Every drop reason, in the order of reports.
REASONS = [
    "missing_query", "missing_tools", "missing_answers", "query_too_short", "query_too_long", "invalid_tools_json", "invalid_tool_shape", "invalid_answers_json",
    "invalid_answer_shape", "multi_call_answer", "duplicate_query", "missing_source_example", "duplicate_source_example", "pair_tools_mismatch", "pair_answers_mismatch", "cross_split_duplicate",
]
SPLITS = ["train", "validation", "test"]
SMALL = 64 << 20
_ASCII_SPACE = r"[\t-\r\x1c-\x1f ]+"


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def normalized(text: Column) -> Column:
    """Case folded, with single spaces: built-in functions where the text is ASCII, Python's rules for the rest."""
    plain = F.octet_length(text) == F.length(text)
    native = F.btrim(F.regexp_replace(F.lower(text), _ASCII_SPACE, " "))
    return F.when(plain, native).otherwise(normalize_query(F.when(~plain, text)))


def spread(rows: DataFrame) -> DataFrame:
    """rows over all cores, where the optimiser takes them for less than SMALL bytes a core, as a small file is one task's;
    larger sources stay as they are. Nothing is run for it."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows.repartition(cores) if size < SMALL * cores else rows


def coarse(rows: DataFrame, least: int, most: int) -> DataFrame:
    """Rows whose needed fields are there and whose query, not stripped, has an admitted length; nothing is counted."""
    return rows.dropna(subset=["query", "tools", "answers"]).where(F.length("query").between(least, most))


def validated(rows: DataFrame, least: int, most: int) -> DataFrame:
    """rows with `reason` (null: valid), `clean_query`, `query_sha256`, canonical `tools_json` and `calls_json`.

    The first failing rule is the reason. JSON is only parsed for rows that the cheap rules leave, both columns in one go."""
    blank = lambda c: F.col(c).isNull() | (F.length(stripped(F.col(c))) == 0)
    rows = spread(rows).withColumn("clean_query", stripped(F.col("query")))
    cheap = (
        F.when(F.coalesce(F.length("clean_query"), F.lit(0)) == 0, "missing_query")
        .when(blank("tools"), "missing_tools")
        .when(blank("answers"), "missing_answers")
        .when(F.length("clean_query") < least, "query_too_short")
        .when(F.length("clean_query") > most, "query_too_long")
    )
    rows = rows.withColumn("cheap", cheap)
    live = F.col("cheap").isNull()
    rows = rows.withColumn("parsed", parse_rows(F.when(live, F.col("tools")), F.when(live, F.col("answers"))))
    rows = rows.withColumn("reason", F.coalesce("cheap", "parsed.reason"))
    rows = rows.withColumn("query_sha256", F.sha2(normalized(F.when(F.col("reason").isNull(), F.col("query"))), 256))
    return rows.withColumns({"tools_json": F.col("parsed.tools"), "calls_json": F.col("parsed.calls")}).drop("cheap", "parsed")


def deduplicated(rows: DataFrame, *keys: str) -> DataFrame:
    """Valid rows that repeat the digest of an earlier one (by ordinal; within keys) get the reason duplicate_query.

    Only digests that repeat are joined, and invalid rows keep keys of their own, so neither meets in one task."""
    valid = rows.where("reason is null")
    named = [F.col(k).alias(f"first_{k}") for k in keys]
    first = valid.groupBy(*named, F.col("query_sha256").alias("first_digest")).agg(F.min("ordinal").alias("first_ordinal"), F.count(F.lit(1)).alias("first_n")).where("first_n > 1").drop("first_n")
    key = F.coalesce("query_sha256", F.concat(F.lit("-"), F.col("ordinal").cast("string")))
    on = F.col("first_key") == F.col("first_digest")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"first_{k}"))
    joined = rows.withColumn("first_key", key).join(first, on, "left").drop("first_key", "first_digest", *[f"first_{k}" for k in keys])
    return joined.withColumn("reason", F.when(F.col("reason").isNull() & (F.col("ordinal") > F.col("first_ordinal")), "duplicate_query").otherwise(F.col("reason"))).drop("first_ordinal")


def drop_counts(rows: DataFrame, languages: DataFrame) -> DataFrame:
    """language, reason, n over all reasons, zeros included."""
    every = languages.select("language").distinct().withColumn("reason", F.explode(F.array(*[F.lit(r) for r in REASONS])))
    counts = rows.where("reason is not null").groupBy("language", "reason").agg(F.count(F.lit(1)).alias("n"))
    return every.join(counts, ["language", "reason"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def _cut(place: Column, sizes: dict[str, int]) -> Column:
    name = F.lit(None).cast("string")
    for s in reversed(SPLITS):
        name = F.when(place <= sum(sizes[x] for x in SPLITS[: SPLITS.index(s) + 1]), F.lit(s)).otherwise(name)
    return name


def _enough(found: int, sizes: dict[str, int]) -> None:
    if found < sum(sizes.values()):
        raise InputError(f"insufficient valid rows: need {sum(sizes.values())}, got {found}", "Lower the split sizes or provide more valid rows.")


def split(examples: DataFrame, seed: int, sizes: dict[str, int]) -> DataFrame:
    """Rows of examples with `split`: the first by a hash of seed and id, cut at the sizes in order; the rest stay unused. Too
    few rows are an error.

    The sizes are configuration, so the ordered top is bounded, kept, and only it is numbered."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("example_id")), 256)
    top = examples.withColumn("split_hash", order).orderBy("split_hash", "example_id").limit(sum(sizes.values())).persist()
    _enough(top.count(), sizes)
    place = F.row_number().over(Window.orderBy("split_hash", "example_id"))
    return top.withColumn("split_place", place).withColumn("split", _cut(F.col("split_place"), sizes)).drop("split_hash", "split_place")


def numbered(rows: DataFrame, order: str = "ordinal", rows_a_run: int = 100_000) -> DataFrame:
    """rows with `place`, gapless from 0 in the order of a distinct whole number, without a sort of all rows in one task: runs of
    the number are counted and summed up, and rows are numbered within a run."""
    low, high, n = rows.agg(F.min(order), F.max(order), F.count(F.lit(1))).first()
    if not n:
        return rows.withColumn("place", F.lit(0).cast("long"))
    width = max(1, (high - low + 1) * rows_a_run // n)
    run = F.floor((F.col(order) - F.lit(low)) / F.lit(width)).alias("run")
    counts = rows.groupBy(run).agg(F.count(F.lit(1)).alias("run_n"))
    ahead = counts.select("run", (F.sum("run_n").over(Window.orderBy("run")) - F.col("run_n")).alias("run_ahead"))
    own = rows.withColumn("run", run).withColumn("run_place", F.row_number().over(Window.partitionBy("run").orderBy(order)) - 1)
    return own.join(ahead, "run").withColumn("place", F.col("run_ahead") + F.col("run_place")).drop("run", "run_ahead", "run_place")


def shuffled_split(examples: DataFrame, seed: int, sizes: dict[str, int]) -> DataFrame:
    """The split by Python's seeded shuffle of the rows in input order: rows with `split` and `split_place`, from 0.

    The permutation depends on the number of rows and the seed alone; it is drawn on the driver (8 bytes a row), and only the
    chosen places leave it."""
    n = examples.count()
    _enough(n, sizes)
    order = list(range(n))
    random.Random(seed).shuffle(order)
    taken = [(place, i) for i, place in enumerate(order[: sum(sizes.values())])]
    laid = examples.sparkSession.createDataFrame(taken, "place long, split_place long")
    return numbered(examples).join(laid, "place").withColumn("split", _cut(F.col("split_place") + 1, sizes)).drop("place")


def paired(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Valid pairs with `reason` and the root's `split`.

    pairs: ordinal, example_id, source_example_id, query_sha256, tools, answers. roots: the selected ones, example_id, split,
    query_sha256, tools, answers. The order of rules is missing root, duplicate, tools, answers, cross-split duplicate; only a
    pair without any other fault takes its root, so later pairs of that root are duplicates, whatever else they lack. The first
    pair of a root is found by aggregation, and rows without a root keep keys of their own."""
    own = roots.select(F.col("example_id").alias("root_key"), F.col("split").alias("root_split"), F.col("tools").alias("root_tools"), F.col("answers").alias("root_answers"))
    same_text = roots.groupBy(F.col("query_sha256").alias("text_key")).agg(F.min("split").alias("text_split"))
    alone = F.concat(F.lit("\0"), F.col("ordinal").cast("string"))
    rows = pairs.withColumn("pair_key", F.coalesce("source_example_id", alone)).join(own, F.col("pair_key") == F.col("root_key"), "left").drop("root_key")
    rows = rows.join(same_text, F.col("query_sha256") == F.col("text_key"), "left").drop("text_key")
    fault = (
        F.when(F.col("root_split").isNull(), "missing_source_example")
        .when(F.col("tools") != F.col("root_tools"), "pair_tools_mismatch")
        .when(F.col("answers") != F.col("root_answers"), "pair_answers_mismatch")
        .when(F.col("text_split") != F.col("root_split"), "cross_split_duplicate")
    )
    rows = rows.withColumn("fault", fault).withColumn("taken_key", F.when(F.col("root_split").isNotNull(), F.col("pair_key")).otherwise(alone))
    taken = rows.where("fault is null").groupBy(F.col("taken_key").alias("first_key")).agg(F.min("ordinal").alias("taken"))
    rows = rows.join(taken, F.col("taken_key") == F.col("first_key"), "left")
    late = F.col("root_split").isNotNull() & (F.col("ordinal") > F.col("taken"))
    out = rows.withColumn("reason", F.when(late, "duplicate_source_example").otherwise(F.col("fault"))).withColumnRenamed("root_split", "split")
    return out.drop("fault", "taken", "first_key", "taken_key", "pair_key", "root_tools", "root_answers", "text_split")


def pair_result(raw: DataFrame, roots: DataFrame, least: int, most: int) -> DataFrame:
    """Raw translated rows (ordinal, source_id, source_example_id, query, tools, answers) with `reason` and `split`: validated,
    deduplicated by their own digests, then paired with the selected roots (example_id, split, query_sha256, raw tools and
    answers)."""
    rows = deduplicated(validated(raw, least, most)).withColumn("example_id", F.col("source_id"))
    kept = paired(rows.where("reason is null").drop("reason"), roots)
    gone = rows.where("reason is not null").withColumn("split", F.lit(None).cast("string"))
    return kept.select("ordinal", "example_id", "source_example_id", "query_sha256", "split", "reason").unionByName(gone.select("ordinal", "example_id", "source_example_id", "query_sha256", "split", "reason"))


def all_examples(*frames: DataFrame) -> DataFrame:
    """The rows of several splits or languages, by the columns that the first has."""
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more.select(out.columns))
    return out


def placed(examples: DataFrame, languages: list[str]) -> DataFrame:
    """examples with language_rank (in configuration order, from 0) and `place` within their language: roots and their
    translations in the order of the root's id, then of the ordinal."""
    rank = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("language")).cast("int") - 1
    order = Window.partitionBy("language").orderBy(F.coalesce("source_example_id", "example_id"), "ordinal")
    return examples.withColumns({"language_rank": rank, "place": F.row_number().over(order)})


def leaks(examples: DataFrame) -> DataFrame:
    """Violations over the examples of all languages: ids used twice, digests in two splits, pairs outside their root's split."""
    twice = examples.groupBy("example_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("duplicate_id").alias("violation"), F.col("example_id").alias("key"))
    crossed = examples.groupBy("query_sha256").agg(F.min("split").alias("a"), F.max("split").alias("b")).where("a <> b").select(F.lit("digest_in_two_splits").alias("violation"), F.col("query_sha256").alias("key"))
    roots = examples.where("source_example_id is null").select(F.col("example_id").alias("source_example_id"), F.col("split").alias("root_split"))
    strayed = examples.join(roots, "source_example_id").where("split <> root_split").select(F.lit("pair_in_other_split").alias("violation"), F.col("example_id").alias("key"))
    return twice.unionByName(crossed).unionByName(strayed)


def uncovered(examples: DataFrame, languages: DataFrame) -> DataFrame:
    """Cells of language and split without an example. languages is configuration: a few rows."""
    every = languages.withColumn("split", F.explode(F.array(*[F.lit(s) for s in SPLITS])))
    return every.join(examples.select("language", "split"), ["language", "split"], "left_anti")


def require(problems: DataFrame, message: str) -> None:
    """Fail closed: raise if there is any row."""
    found = problems.limit(3).collect()
    if found:
        raise InputError(f"{message}: {[r.asDict() for r in found]}")
