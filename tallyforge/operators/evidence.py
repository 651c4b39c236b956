"""Run evidence: training metrics, telemetry, cost, cohort identity and released rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.errors import InvariantError


def last_row_memory(history: DataFrame, run: str, order: str, memory: str) -> DataFrame:
    """history with the peak memory on each run's last row only; rows without a step are left out."""
    rows = history.where(F.col("step").isNotNull())
    last = rows.groupBy(run).agg(F.max(order).alias("last_order"))
    return rows.join(last, run).withColumn(memory, F.when(F.col(order) == F.col("last_order"), F.col(memory))).drop("last_order")


def training_summary(history: DataFrame, run: str, order: str) -> DataFrame:
    """run, tokens_seen (most), falls (positive counts below an earlier one's), peak_memory (last), peaks (distinct)."""
    positive = history.where("tokens_seen > 0").withColumn("before", F.max("tokens_seen").over(Window.partitionBy(run).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)))
    seen = positive.groupBy(run).agg(F.max("tokens_seen").alias("tokens_seen"), F.count_if(F.expr("tokens_seen < before")).alias("falls"))
    peak = history.where("peak_memory is not null").groupBy(run).agg(F.max_by("peak_memory", order).alias("peak_memory"), F.count_distinct("peak_memory").alias("peaks"))
    return seen.join(peak, run, "full_outer")


def training_metrics(history: DataFrame, run: str, order: str) -> DataFrame:
    """Trainer history as metrics: rows with a step, numbers that must be finite (else the query fails), the peak memory on each
    run's last row only."""
    from .tokenization import finite

    rows = last_row_memory(history, run, order, "peak_memory")
    numbers = [c for c, kind in rows.dtypes if kind in ("double", "float")]
    return rows.withColumns({c: finite(F.col(c), c) for c in numbers})


def uniform(rows: DataFrame, column: str) -> str:
    """The one distinct value of a column; several are an error."""
    found = rows.groupBy(column).count().limit(2).collect()
    if len(found) != 1:
        raise InvariantError(f"{column} has {len(found) or 'no'} values where one is needed", "Generate the whole split with one configuration.")
    return found[0][0]


def telemetry_faults(slices: DataFrame, total: DataFrame, counts: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """fault, slice: recorded timing that contradicts itself or the generations. slices and counts have slice and examples,
    slices also elapsed and each; total is one row of examples, elapsed and each."""
    joined = slices.join(counts.select("slice", F.col("examples").alias("counted")), "slice", "full_outer")
    why = (
        F.when(F.col("examples").isNull() | F.col("counted").isNull(), "slice_set")
        .when((F.col("examples") != F.col("counted")) | (F.col("examples") <= 0), "examples")
        .when((F.col("elapsed") < 0) | F.isnan(F.col("elapsed").cast("double")), "elapsed")
        .when(F.abs(F.col("each") - F.col("elapsed") / F.col("examples")) > tolerance, "each")
    )
    sums = slices.agg(F.sum("examples").alias("n"), F.sum("elapsed").alias("t"), F.count(F.lit(1)).alias("k"))
    whole = (
        F.when(F.col("n") != F.col("examples"), "total_examples")
        .when(F.abs(F.col("t") - F.col("elapsed")) > (F.col("k") + 1) * tolerance, "total_elapsed")
        .when(F.abs(F.col("each") - F.col("elapsed") / F.col("examples")) > tolerance, "total_each")
    )
    own = joined.select(why.alias("fault"), "slice").unionByName(total.join(F.broadcast(sums)).select(whole.alias("fault"), F.lit(None).cast("string").alias("slice")))  # one row each
    return own.where("fault is not null")


def throughput(runs: DataFrame) -> DataFrame:
    """runs (tokens_seen, elapsed, gpus) with tokens_per_second, gpu_hours, and why there is no rate."""
    known = (F.col("tokens_seen") > 0) & (F.col("elapsed") > 0)
    return runs.withColumns({"tokens_per_second": F.when(known, F.col("tokens_seen") / F.col("elapsed")), "gpu_hours": F.col("elapsed") * F.col("gpus") / 3600, "unavailable": F.when(~F.coalesce(known, F.lit(False)), "tokens_seen_or_positive_elapsed_unavailable")})


#: Names of files that hold an adapter's tensors.
TENSORS = r"^adapter_model(-[0-9]{5}-of-[0-9]{5})?\.(safetensors|bin)$"


def adapter_storage(files: DataFrame) -> DataFrame:
    """One row over files (path, bytes): all bytes and files, and those of tensors alone."""
    tensor = F.regexp_extract("path", r"([^/]*)$", 1).rlike(TENSORS)
    return files.agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum(F.when(tensor, F.col("bytes"))), F.lit(0)).alias("tensor_bytes"), F.count_if(tensor).alias("tensor_files"))


def file_set_difference(listed: DataFrame, found: DataFrame) -> DataFrame:
    """path, side: outputs that a manifest lists and no file has, or the other way round."""
    return cohort_difference(listed.select("path"), found.select("path"))


def evidence_class(run_id: Column) -> Column:
    return F.when(run_id.startswith("smoke-"), "smoke").otherwise("full")


def utc_time(text: Column) -> Column:
    """A strict UTC timestamp as a time; null for anything else."""
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?(Z|\+00:00)$"), F.try_to_timestamp(text))


def telemetry(rows: DataFrame, *keys: str) -> DataFrame:
    """keys, examples, elapsed, each: seconds by slice and for all (null)."""
    out = rows.groupingSets([list(keys), []], *keys).agg(F.count(F.lit(1)).alias("examples"), F.sum("elapsed").alias("elapsed"))
    return out.withColumn("each", F.col("elapsed") / F.col("examples"))


def gpu_count(label: Column) -> Column:
    found = F.regexp_extract(label, ":([0-9]+)$", 1)
    return F.when(found == "", 1).otherwise(F.when(found != "", found).cast("int"))


def seconds_per_success(elapsed: Column, gpus: Column, successes: Column) -> Column:
    return F.when(successes > 0, elapsed * gpus / successes)


def cohort_difference(one: DataFrame, other: DataFrame) -> DataFrame:
    """Rows that only one of two cohorts has, with repeats, and its side."""
    return one.exceptAll(other).withColumn("side", F.lit("one")).unionByName(other.exceptAll(one).withColumn("side", F.lit("other")))


def component_faults(scored: DataFrame) -> DataFrame:
    """example_id, fault: released components that contradict the metrics' laws."""
    why = (
        F.when((F.col("argument_f1_num") > F.col("argument_f1_den")) | (F.col("argument_f1_num") % 2 != 0), "f1_range")
        .when(F.col("full_call_exact_match_num") > F.least("function_name_accuracy_num", "argument_exact_match_num"), "full_without_parts")
        .when(F.greatest("function_name_accuracy_num", "argument_exact_match_num") > F.col("valid_json_rate_num"), "match_without_json")
    )
    return scored.select("example_id", why.alias("fault")).where("fault is not null")
