"""Cohorts: which rows of a source are used, matched pairs of a language with its roots, and digests of their order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.errors import EvaluationError, InputError, InvariantError

from . import scoring
from .prepare import SPLITS, require
from .prompts import ordered_digest

#: Split sizes that a smoke run keeps at most.
SMOKE = {"train": 100, "validation": 20, "test": 20}


# Selection.


def selected_ids(prepared: DataFrame) -> DataFrame:
    """The distinct example ids of prepared rows; none is an error."""
    found = prepared.select("example_id").distinct()
    if found.isEmpty():
        raise InputError("no prepared examples found", "Point the selection at a folder with prepared splits.")
    return found


def selected(rows: DataFrame, ids: DataFrame, key: str = "source_id", limit: int | None = None) -> DataFrame:
    """rows whose key is among the ids, in input order (`ordinal`); with a limit the first ones. The limit is configuration."""
    kept = rows.join(ids.select(F.col("example_id").alias("selected_id")).distinct(), F.col(key) == F.col("selected_id"), "left_semi")
    return kept.orderBy("ordinal").limit(limit) if limit is not None else kept


def languages_kept(rows: DataFrame, languages: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """Rows of the configured languages and their counts; a language without rows is an error."""
    kept = rows.where(F.col("language").isin(languages))
    counts = dict.fromkeys(languages, 0) | {r[0]: r[1] for r in kept.groupBy("language").count().collect()}
    empty = sorted(x for x, n in counts.items() if not n)
    if empty:
        raise InputError(f"no rows for the configured languages {', '.join(empty)}", "Prepare and format data for every configured language.")
    return kept, counts


def language_difference(configured: list[str], provided: DataFrame) -> DataFrame:
    """language, problem: languages that are missing from what is provided, or not configured."""
    spark = provided.sparkSession
    want = spark.createDataFrame([(x,) for x in configured], "language string")
    have = provided.select("language").distinct()
    missing = want.join(have, "language", "left_anti").withColumn("problem", F.lit("missing"))
    return missing.unionByName(have.join(want, "language", "left_anti").withColumn("problem", F.lit("unexpected")))


def test_slices(examples: DataFrame, slices: list[str]) -> DataFrame:
    """Rows of the test split in the configured slices; an empty split or slice is an error."""
    test = examples.where("split = 'test'")
    if test.isEmpty():
        raise InputError("the formatted test split is empty", "Format a test split that has rows.")
    return languages_kept(test, slices)[0]


def smoke_sizes(sizes: dict[str, int]) -> dict[str, int]:
    """Split sizes of a smoke run: the configured ones, cut at SMOKE."""
    return {s: min(n, SMOKE[s]) for s, n in sizes.items()}


def split_of(splits: DataFrame) -> DataFrame:
    """id, split of selected rows, each id once."""
    out = splits.where("split is not null").select(F.col("example_id").alias("id"), "split")
    require(out.groupBy("id").agg(F.count_distinct("split").alias("n")).where("n > 1"), "ids in several splits")
    return out.distinct()


def fixture_examples(spark, sizes: dict[str, int], languages: list[str]) -> DataFrame:
    """Synthetic prepared rows: every language has each split's number of requests, translations linked to their roots."""
    cells = spark.createDataFrame([(s, n, x, i) for s, n in sizes.items() for i, x in enumerate(languages)], "split string, n int, language string, rank int")
    rows = cells.where("n > 0").withColumn("number", F.explode(F.expr("sequence(1, n)")))
    root = F.concat_ws("-", "split", "number")
    id_ = F.when(F.col("rank") == 0, root).otherwise(F.concat_ws("-", root, F.col("language")))
    query = F.format_string("[%s] %s request %d: what is the weather in Paris?", "language", "split", "number")
    return rows.select(id_.alias("example_id"), F.concat(F.lit("fixture:"), id_).alias("source_id"), "language", F.when(F.col("rank") > 0, root).alias("source_example_id"), query.alias("query"), "split")


# Matched pairs.


def pair_faults(targets: DataFrame, roots: DataFrame) -> DataFrame:
    """example_id, fault: targets without a root's id, with the root of another, with a root that isn't there, or another gold.

    targets: example_id, source_example_id, gold. roots: example_id, gold."""
    own = roots.select(F.col("example_id").alias("root_id"), F.col("gold").alias("root_gold"))
    named = targets.where("source_example_id is not null")
    joined = named.join(own, F.col("source_example_id") == F.col("root_id"), "left")
    fault = joined.select("example_id", F.when(F.col("root_id").isNull(), "missing_root").when(F.col("gold") != F.col("root_gold"), "other_gold").alias("fault")).where("fault is not null")
    again = named.groupBy("source_example_id").agg(F.count(F.lit(1)).alias("n"), F.min("example_id").alias("first")).where("n > 1")
    repeated = named.join(again, "source_example_id").where("example_id <> first").select("example_id", F.lit("repeated_root").alias("fault"))
    return fault.unionByName(repeated).unionByName(targets.where("source_example_id is null").select("example_id", F.lit("unpaired").alias("fault")))


def pair_set_digest(targets: DataFrame, roots: DataFrame) -> DataFrame:
    """n, digest over both identities and prompts of each pair, as canonical JSON lines in the targets' order."""
    own = roots.select(F.col("example_id").alias("root_id"), F.col("prompt_sha256").alias("root_prompt"))
    rows = targets.join(own, F.col("source_example_id") == F.col("root_id"))
    line = F.to_json(F.struct(F.col("root_id").alias("reference_example_id"), F.col("root_prompt").alias("reference_prompt_sha256"), F.col("example_id").alias("target_example_id"), F.col("prompt_sha256").alias("target_prompt_sha256")))
    return ordered_digest(rows.withColumn("line", line), "line")


def root_places(targets: DataFrame, roots: DataFrame) -> DataFrame:
    """ordinal (of the target), root_place: the place of its root among the roots, from 0 in their order."""
    from .prepare import numbered

    placed = numbered(roots.select("ordinal", "example_id")).select(F.col("example_id").alias("root_id"), F.col("place").alias("root_place"))
    return targets.join(placed, F.col("source_example_id") == F.col("root_id")).select("ordinal", "root_place")


def id_digest(rows: DataFrame, column: str = "example_id") -> DataFrame:
    """n, digest of the ids joined by newlines in order."""
    return ordered_digest(rows, column)


def index_digest(rows: DataFrame, column: str = "root_place") -> DataFrame:
    """n, digest of a JSON list of whole numbers in order."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct(F.col("ordinal").alias("o"), F.col(column).cast("string").alias("t")))), lambda x: x["t"])
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sha2(F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")), 256).alias("digest"))


@dataclass
class Matched:
    """A language against the roots that its rows were made from: numbers of pairs and of both slices, metrics of either side on
    the pairs alone, gaps by metric, and intervals of these."""

    pairs: int
    reference: int
    target: int
    metrics: DataFrame
    gaps: DataFrame
    intervals: DataFrame
    digest: str

    @property
    def coverage(self) -> float:
        return self.pairs / self.reference


def matched(scored: DataFrame, root: str, language: str, replicates: int = 2000, seed: str = "1") -> Matched:
    """scored: ordinal, example_id, source_example_id, language, prompt_sha256, gold_name, gold_arguments and components. Faults
    of the pairing are errors."""
    rows = scored.withColumn("gold", F.concat_ws("\0", "gold_name", "gold_arguments"))
    roots, targets = rows.where(F.col("language") == root), rows.where(F.col("language") == language)
    faults = pair_faults(targets, roots).limit(1).collect()
    if faults:
        raise (InvariantError if faults[0]["fault"] == "other_gold" else EvaluationError)(f"slice {language}: {faults[0]['fault']} at {faults[0]['example_id']}")
    sums = [f"{m}_{p}" for m in scoring.METRICS for p in ("num", "den")]
    theirs = targets.select(F.col("source_example_id").alias("example_id"), *sums)
    ours = roots.join(theirs.select("example_id"), "example_id", "left_semi").select("example_id", *sums)
    both = ours.withColumn("side", F.lit("reference")).unionByName(theirs.withColumn("side", F.lit("target"))).withColumn("language", F.lit(language))
    measured = scoring.metrics(both, "side").where("language is not null").drop("language")
    gap = lambda side: F.max(F.when(F.col("side") == side, F.col("value")))
    gaps = measured.groupBy("metric").agg((gap("target") - gap("reference")).alias("gap"))
    (digest,) = pair_set_digest(targets, roots).collect()
    return Matched(digest["n"], roots.count(), targets.count(), measured, gaps, scoring.bootstrap(ours, theirs, replicates, seed), digest["digest"])


# Identity of full rows.


def row_digest(*columns: str, json: Column | None = None) -> Column:
    """sha256 of a row as canonical JSON with letters as they are."""
    from tallyforge.functions.calls import canonical_unicode

    whole = json if json is not None else F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})
    return F.sha2(canonical_unicode(whole), 256)


def rows_identity(rows: DataFrame, *columns: str) -> DataFrame:
    """n, digest of full rows as canonical JSON lines with letters as they are, one newline behind each, in order."""
    from tallyforge.functions.calls import canonical_unicode

    line = canonical_unicode(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}))
    return ordered_digest(rows.withColumn("line", line), "line", closed=True)


def cohort_identity(prepared: DataFrame, formatted: DataFrame, tokenized: DataFrame, expected: dict[str, int]) -> DataFrame:
    """problem, key: why three artifacts aren't one cohort. Prepared and formatted rows (ordinal, example_id, split) must agree
    in ids, splits and order; the token records in ids; and the splits' sizes with the expected ones."""
    one, two = (d.select("example_id", "split", "ordinal") for d in (prepared, formatted))
    other = lambda a, b, name: a.exceptAll(b).select(F.lit(name).alias("problem"), F.col("example_id").alias("key"))
    out = other(one, two, "not_formatted").unionByName(other(two, one, "not_prepared"))
    ids = [d.select("example_id") for d in (formatted, tokenized)]
    out = out.unionByName(other(ids[0], ids[1], "not_tokenized")).unionByName(other(ids[1], ids[0], "unknown_tokens"))
    want = prepared.sparkSession.createDataFrame([(s, expected.get(s, 0)) for s in SPLITS], "split string, want long")
    sizes = want.join(prepared.groupBy("split").agg(F.count(F.lit(1)).alias("n")), "split", "left").where(F.coalesce("n", F.lit(0)) != F.col("want"))
    return out.unionByName(sizes.select(F.lit("size").alias("problem"), F.col("split").alias("key")))
