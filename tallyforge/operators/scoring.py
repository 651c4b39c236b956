"""Scores of generations as additive components, metrics by slice and overall, paired statistics and the comparison gate."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import comb, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.calls import flatten_arguments, parse_call, score_call
from tallyforge.functions.draws import codes

METRICS = ["valid_json_rate", "function_name_accuracy", "argument_exact_match", "argument_f1", "full_call_exact_match"]


def parsed(generations: DataFrame) -> DataFrame:
    """generations with status, name and canonical arguments of raw_text."""
    return generations.withColumn("call", parse_call("raw_text")).select("*", "call.status", "call.name", "call.arguments").drop("call")


def components(rows: DataFrame) -> DataFrame:
    """rows (status, name, arguments, gold_name, gold_arguments) with `<metric>_num` and `<metric>_den`.

    Arguments are canonical JSON. Failures add their gold pairs only; sums of these columns are the metrics."""
    rows = rows.withColumns({"own_pairs": flatten_arguments(F.when(F.col("status") == "ok", F.col("arguments"))), "gold_pairs": flatten_arguments("gold_arguments")})
    own, gold = F.coalesce(F.map_entries("own_pairs"), F.array().cast("array<struct<key:string,value:string>>")), F.map_entries("gold_pairs")
    ok = F.col("status") == "ok"
    name, args = ok & F.equal_null("name", "gold_name"), ok & F.equal_null("arguments", "gold_arguments")
    one = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    out = {"valid_json_rate": one(ok), "function_name_accuracy": one(name), "argument_exact_match": one(args), "full_call_exact_match": one(name & args)}
    columns = {f"{m}_num": c for m, c in out.items()} | {f"{m}_den": F.lit(1).cast("long") for m in out}
    columns["argument_f1_num"] = (2 * F.size(F.array_intersect(own, gold))).cast("long")
    columns["argument_f1_den"] = (F.size(own) + F.size(gold)).cast("long")
    return rows.withColumns(columns).drop("own_pairs", "gold_pairs")


def scored(generations: DataFrame) -> DataFrame:
    """generations (raw_text, gold_name, gold_arguments) with status, name, arguments and the components: as components(parsed()),
    by one pass of the parser instead of three."""
    rows = generations.withColumn("call", score_call("raw_text", "gold_name", "gold_arguments"))
    one = F.lit(1).cast("long")
    columns = {"status": F.col("call.status"), "name": F.col("call.name"), "arguments": F.col("call.arguments")}
    for m, field in (("valid_json_rate", "valid"), ("function_name_accuracy", "named"), ("argument_exact_match", "args"), ("full_call_exact_match", "whole")):
        columns |= {f"{m}_num": F.col(f"call.{field}"), f"{m}_den": one}
    columns |= {"argument_f1_num": F.col("call.f1_num"), "argument_f1_den": F.col("call.f1_den")}
    return rows.withColumns(columns).drop("call")


def value(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def metrics(scored: DataFrame, *keys: str) -> DataFrame:
    """keys, language (null: all), metric, numerator, denominator, value. Overall pools the examples; it is no mean of slices."""
    sums = [F.sum(f"{m}_{part}").alias(f"{m}_{part}") for m in METRICS for part in ("num", "den")]
    sets = [[*keys, "language"], [*keys]]
    total = scored.groupingSets(sets, *keys, "language").agg(*sums)
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"{m}_num").alias("numerator"), F.col(f"{m}_den").alias("denominator")) for m in METRICS]))
    return total.select(*keys, "language", rows.alias("m")).select(*keys, "language", "m.*").withColumn("value", value(F.col("numerator"), F.col("denominator")))


def unmatched(generations: DataFrame, formatted: DataFrame) -> DataFrame:
    """Why a join of generations to examples isn't sound: unknown ids, examples without one, prompts that differ."""
    a, b = generations.select("example_id", F.col("prompt_sha256").alias("own")), formatted.select("example_id", "prompt_sha256")
    joined = a.join(b, "example_id", "full_outer")
    why = F.when(F.col("prompt_sha256").isNull(), "unknown_example").when(F.col("own").isNull(), "no_generation").when(F.col("own") != F.col("prompt_sha256"), "prompt_differs")
    return joined.select("example_id", why.alias("problem")).where("problem is not null")


def discordant(reference: DataFrame, candidate: DataFrame) -> DataFrame:
    """One row: pairs, and full calls that only one of two scored cohorts has right; joined on example_id."""
    a = reference.select("example_id", F.col("full_call_exact_match_num").alias("a"))
    b = candidate.select("example_id", F.col("full_call_exact_match_num").alias("b"))
    return a.join(b, "example_id").agg(F.count(F.lit(1)).alias("pairs"), F.count_if(F.expr("a = 1 and b = 0")).alias("reference_only"), F.count_if(F.expr("a = 0 and b = 1")).alias("candidate_only"))


#: Bits that the p-value of many pairs is worked out with; factors of a binomial coefficient that are taken at a time.
BITS, FACTORS = 384, 64


def mcnemar_p(first: int, second: int) -> float:
    """Exact two-sided p-value: the doubled lower tail of a fair binomial, at most 1, rounded to a double.

    With many pairs the tail is its last term times one plus the ratios of the terms before it, in whole numbers of BITS bits:
    the time goes with the pairs, and less than one in 2**300 is lost on the way."""
    n, k = first + second, min(first, second)
    if n <= 1000:
        return float(min(Fraction(1), Fraction(2 * sum(comb(n, i) for i in range(k + 1)), 2**n)))
    last, shift = 1 << BITS, -BITS
    for i in range(0, k, FACTORS):
        m = min(FACTORS, k - i)
        last = last * prod(range(n - k + i + 1, n - k + i + m + 1)) // prod(range(i + 1, i + m + 1))
        cut = last.bit_length() - BITS
        last, shift = last >> cut, shift + cut
    ratio = total = 1 << BITS
    for i in range(k):
        ratio = ratio * (k - i) // (n - k + 1 + i)
        if not ratio:
            break
        total += ratio
    return float(min(Fraction(1), Fraction(2 * last * total, 1 << n + BITS - shift)))


#: Pairs whose kinds are sent to all executors at most, four bytes each, and kinds; beyond either the draws are joined with the pairs.
PAIRS_SENT, KINDS_SENT, DRAWN_AT_ONCE = 16_000_000, 100_000, 1 << 20


def bootstrap(reference: DataFrame, candidate: DataFrame, replicates: int, seed: str, *keys: str) -> DataFrame:
    """keys, metric, lower, upper: percentile intervals (95 %) of candidate minus reference over resampled pairs.

    Replicate r draws for each place i of a cohort the pair at md5(seed, r, i) modulo its size, so draws need no random
    state and are the same on any cluster. A pair counts by the kind of its components, of which there are few: executors
    get the kind at each place and count the kinds of a replicate's draws, so that no draw is a row. Cohorts with more pairs
    or kinds than can be sent join counts of draws with the pairs' components instead; the result is the same."""
    both = lambda df, tag: df.select(*keys, "example_id", *[F.coalesce(F.col(f"{m}_{p}").cast("long"), F.lit(0)).alias(f"{tag}_{m}_{p}") for m in METRICS for p in ("num", "den")])
    pairs = both(reference, "r").join(both(candidate, "c"), [*keys, "example_id"]).persist()
    pairs = _placed(pairs, keys).persist()
    parts = [f"{t}_{m}_{p}" for t in "rc" for m in METRICS for p in ("num", "den")]
    kinds = pairs.select(*parts).distinct().limit(KINDS_SENT + 1).toArrow()
    few = kinds.num_rows <= KINDS_SENT and pairs.count() <= PAIRS_SENT
    total = _counted(pairs, kinds, replicates, seed, keys, parts) if few else _joined(pairs, replicates, seed, keys, parts)
    change = lambda m: value(F.col(f"c_{m}_num"), F.col(f"c_{m}_den")) - value(F.col(f"r_{m}_num"), F.col(f"r_{m}_den"))
    rows = total.select(*keys, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), change(m).alias("change")) for m in METRICS])).alias("m")).select(*keys, "m.*")
    return rows.groupBy(*keys, "metric").agg(F.percentile("change", 0.025).alias("lower"), F.percentile("change", 0.975).alias("upper"))


def _joined(pairs: DataFrame, replicates: int, seed: str, keys: tuple[str, ...], parts: list[str]) -> DataFrame:
    """keys, replicate and the sums of parts over its draws, as a join of counts with the pairs; no cohort is collected."""
    size = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    # each pair stands for one draw of every replicate: draws are as spread as the pairs, and none is made in one task
    draws = pairs.select(*keys, F.col("place").alias("i")).join(size, list(keys)) if keys else pairs.select(F.col("place").alias("i")).join(F.broadcast(size))
    draws = draws.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    code = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "replicate", "i").cast("binary")), 1, 8), 16, 10).cast("long")
    times = draws.withColumn("place", F.pmod(code, "size").cast("long")).groupBy(*keys, "replicate", "place").agg(F.count(F.lit(1)).alias("times"))
    return times.join(pairs, [*keys, "place"]).groupBy(*keys, "replicate").agg(*[F.sum(F.col("times") * F.col(c)).alias(c) for c in parts])


def _counted(pairs: DataFrame, kinds: pa.Table, replicates: int, seed: str, keys: tuple[str, ...], parts: list[str]) -> DataFrame:
    """As _joined(), for kinds (the distinct components) and pairs that can be sent."""
    spark = pairs.sparkSession
    named = spark.createDataFrame(kinds.append_column("kind", pa.array(np.arange(kinds.num_rows, dtype=np.int32)))).select(F.concat_ws(",", *parts).alias("components"), "kind")
    groups = [list(r) for r in pairs.select(*keys).distinct().collect()] if keys else [[]]
    groups = spark.createDataFrame([(*g, i) for i, g in enumerate(groups)], ", ".join([*[f"`{k}` {pairs.schema[k].dataType.simpleString()}" for k in keys], "cohort int"]))
    told = pairs.select(*keys, "place", F.concat_ws(",", *parts).alias("components")).join(F.broadcast(named), "components")
    told = told.join(F.broadcast(groups), list(keys)) if keys else told.withColumn("cohort", F.lit(0))
    told = told.select("cohort", F.col("place").cast("int").alias("place"), "kind").toArrow()
    cohort, place, kind = (told.column(c).to_numpy() for c in ("cohort", "place", "kind"))
    at = {}
    for g in np.unique(cohort).tolist():
        own = cohort == g
        at[g] = np.empty(int(own.sum()), np.int32)
        at[g][place[own]] = kind[own]
    sent = spark.sparkContext.broadcast((at, np.stack([kinds.column(c).to_numpy() for c in parts], axis=1) if len(kinds) else np.zeros((0, len(parts)), np.int64)))

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, table = sent.value
        most = max(map(len, at.values()), default=0)
        for batch in batches:
            rows = []
            for r in batch.column(0).to_pylist():
                counts = {g: np.zeros(len(table), np.int64) for g in at}
                for first, code in codes(f"{seed}:{r}:", most, DRAWN_AT_ONCE):
                    for g, own in at.items():
                        if first < len(own):
                            counts[g] += np.bincount(own[code[: len(own) - first] % np.uint32(len(own))], minlength=len(table))
                rows += [(g, r, *(n @ table).tolist()) for g, n in counts.items()]
            kinds_ = [pa.int32(), pa.int64(), *[pa.int64()] * len(parts)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(kinds_)], ["cohort", "replicate", *parts])

    spread = spark.range(0, replicates, 1, max(1, min(replicates, 4 * spark.sparkContext.defaultParallelism)))
    total = spread.mapInArrow(drawn, ", ".join(["cohort int", "replicate long", *[f"{c} long" for c in parts]]))
    return total.join(F.broadcast(groups), "cohort").drop("cohort") if keys else total.drop("cohort")


def _placed(pairs: DataFrame, keys: tuple[str, ...], rows_a_run: int = 50_000) -> DataFrame:
    """pairs with `place`, from 0 in the order of example_id within keys: ids are cut into ranges, which are counted and summed
    up, so that no cohort is sorted in one task."""
    n = pairs.count()
    if n <= rows_a_run:
        return pairs.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("example_id") if keys else Window.orderBy("example_id")) - 1)
    laid = pairs.repartitionByRange(n // rows_a_run + 1, *keys, "example_id").withColumn("run", F.spark_partition_id()).persist()
    counts = laid.groupBy(*keys, "run").agg(F.count(F.lit(1)).alias("run_n"))
    ahead = counts.withColumn("ahead", F.sum("run_n").over(Window.partitionBy(*keys).orderBy("run")) - F.col("run_n")).drop("run_n")
    own = laid.withColumn("own", F.row_number().over(Window.partitionBy(*keys, "run").orderBy("example_id")) - 1)
    return own.join(ahead, [*keys, "run"]).withColumn("place", F.col("ahead") + F.col("own")).drop("run", "ahead", "own")


def exact_bootstrap(components: list[tuple[list[int], list[int]]], seed: int, replicates: int) -> list[list[float]]:
    """Changes of each metric over replicates drawn by Python's seeded generator, for a cohort small enough to report on.

    components: for each pair, its reference and candidate columns num, den for each metric in turn."""
    import random

    import numpy as np

    rng, n = random.Random(seed), len(components)
    table = np.array([r + c for r, c in components], np.int64)
    half = table.shape[1] // 2
    out = []
    for _ in range(replicates):
        counts = np.bincount([rng.randrange(n) for _ in range(n)], minlength=n) @ table
        rate = lambda x: [int(x[i]) / int(x[i + 1]) if x[i + 1] else 0.0 for i in range(0, half, 2)]
        out.append([b - a for a, b in zip(rate(counts[:half]), rate(counts[half:]), strict=True)])
    return [list(m) for m in zip(*out, strict=True)]


def verified_bootstrap(components: list[tuple[list[int], list[int]]], seed: int, reported: dict[str, list[float]], replicates: int = 2000, tolerance: float = 1e-12) -> list[str]:
    """Metrics whose reported intervals the same draws don't give again."""
    import numpy as np

    again = dict(zip(METRICS, exact_bootstrap(components, seed, replicates), strict=True))
    return [m for m in METRICS if not np.allclose(np.quantile(again[m], [0.025, 0.975]), reported.get(m, [np.nan, np.nan]), rtol=0, atol=tolerance)]


def stable_seed(base: int, name: str) -> int:
    import hashlib

    return (base + int.from_bytes(hashlib.sha256(name.encode()).digest()[:8], "big")) % 2**63


def deltas(measured: DataFrame, reference: str, candidate: str, key: str = "model_kind") -> DataFrame:
    """language, metric, delta: candidate minus reference."""
    return measured.groupBy("language", "metric").agg((F.max(F.when(F.col(key) == candidate, F.col("value"))) - F.max(F.when(F.col(key) == reference, F.col("value")))).alias("delta"))


def gaps(measured: DataFrame, root: str, *keys: str) -> DataFrame:
    """keys, language, metric, gap to the root language's value."""
    base = measured.where(F.col("language") == root).select(*keys, "metric", F.col("value").alias("root_value"))
    return measured.where(F.col("language").isNotNull() & (F.col("language") != root)).join(base, [*keys, "metric"]).select(*keys, "language", "metric", (F.col("value") - F.col("root_value")).alias("gap"))


def claims(intervals: DataFrame) -> DataFrame:
    """Intervals with uplift (lower bound above 0) and non-inferiority (lower bound of -0.01 or more)."""
    return intervals.withColumns({"uplift": F.col("lower") > 0, "non_inferior": F.col("lower") >= -0.01})


def gate(one: dict, other: dict, fields: list[str]) -> list[str]:
    """Identity fields of two reports that differ; a comparison needs none."""
    return [f for f in fields if one.get(f) != other.get(f)]
