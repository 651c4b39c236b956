"""Prompts, ordered digests, training labels, and token accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COUNTS = ["query_chars", "query_bytes", "query_words", "query_tokens", "prompt_tokens", "target_tokens", "full_tokens"]


def messages(query: Column, tools_json: Column, calls_json: Column, system: str) -> Column:
    """system (policy and canonical tools), user (the raw query) and assistant (canonical calls)."""
    said = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(said("system", F.concat(F.lit(system.strip() + "\n\nAvailable tools:\n"), tools_json)), said("user", query), said("assistant", calls_json))


def rendered(rows: DataFrame, begin: str = "<|", end: str = "|>") -> DataFrame:
    """rows (messages) with prompt_text, target_text, full_text and prompt_sha256, by a stub template; the prompt is a prefix
    of the full text."""
    turn = lambda m: F.concat(F.lit(begin), m["role"], F.lit(end + "\n"), m["content"], F.lit("\n"))
    head = F.array_join(F.transform(F.slice("messages", 1, 2), turn), "")
    prompt = F.concat(head, F.lit(f"{begin}assistant{end}\n"))
    target = F.col("messages")[2]["content"]
    return rows.withColumns({"prompt_text": prompt, "target_text": target, "full_text": F.concat(prompt, target, F.lit("\n"))}).withColumn("prompt_sha256", F.sha2("prompt_text", 256))


def ordered_digest(rows: DataFrame, text: str, *keys: str, order: str = "ordinal", closed: bool = False) -> DataFrame:
    """keys, n, digest: sha256 of the texts joined by newlines in the order of a column (closed: one after each text too).

    A digest over an order is sequential by nature: each group's texts meet in one task. Use digests of rows as texts."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))), lambda x: x["t"]), "\n")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sha2(F.concat(joined, F.lit("\n" * closed)), 256).alias("digest"))


def merkle_digest(rows: DataFrame, digest: str, order: str, rows_a_leaf: int = 100_000) -> DataFrame:
    """n, digest over row digests of any number, in the order of a gapless number: leaves of a fixed length, then their
    digests. Not the value of ordered_digest."""
    leaves = ordered_digest(rows.withColumn("leaf", F.floor(F.col(order) / rows_a_leaf)), digest, "leaf", order=order)
    return leaves.agg(F.sum("n").alias("n"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("leaf", "digest"))), lambda x: x["digest"]), "\n"), 256).alias("digest"))


def token_counts(rows: DataFrame, budget: int, tokens=lambda c: F.size(F.filter(F.split(c, r"\s+"), lambda w: w != ""))) -> DataFrame:
    """rows (query, prompt_text, target_text, full_text) with the seven COUNTS and over_budget. tokens: text column to count;
    by default words at white space."""
    words = F.size(F.filter(F.split("query", r"\s+"), lambda w: w != ""))
    counts = [F.length("query"), F.octet_length("query"), words, tokens(F.col("query")), tokens(F.col("prompt_text")), tokens(F.col("target_text")), tokens(F.col("full_text"))]
    return rows.withColumns({n: c.cast("long") for n, c in zip(COUNTS, counts, strict=True)}).withColumn("over_budget", F.col("full_tokens") > budget)


def count_summary(counted: DataFrame, count: str = "full_tokens") -> DataFrame:
    """language, split (null: all), examples, total, p50, p95, p99, most, over_budget: nearest-rank percentiles."""
    rank = lambda p, name: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {count})").alias(name)
    return counted.groupingSets([["language", "split"], ["language"]], "language", "split").agg(
        F.count(F.lit(1)).alias("examples"), F.sum(count).alias("total"), rank(0.5, "p50"), rank(0.95, "p95"), rank(0.99, "p99"), F.max(count).alias("most"), F.count_if("over_budget").alias("over_budget")
    )


def paired_tokens(counted: DataFrame, root: str) -> DataFrame:
    """language, roots, pairs, root_tokens, pair_tokens, ratio: translations against their roots."""
    roots = counted.where(F.col("language") == root).select(F.col("example_id").alias("source_example_id"), F.col("full_tokens").alias("root_full"))
    total = roots.agg(F.count(F.lit(1)).alias("roots"))  # one row
    pairs = counted.where(F.col("language") != root).join(roots, "source_example_id")
    sums = pairs.groupBy("language").agg(F.count(F.lit(1)).alias("pairs"), F.sum("root_full").alias("root_tokens"), F.sum("full_tokens").alias("pair_tokens"))
    return sums.join(F.broadcast(total)).withColumn("ratio", F.col("pair_tokens") / F.col("root_tokens"))


def workload(counted: DataFrame, root: str, epochs: int) -> DataFrame:
    """One row: training examples and tokens, those of the root language alone, their difference and multiplier."""
    train = counted.where("split = 'train'")
    own = F.when(F.col("language") == root, F.col("full_tokens"))
    out = train.agg(F.count(F.lit(1)).alias("examples"), F.sum("full_tokens").alias("epoch_tokens"), F.sum(own).alias("root_epoch_tokens"))
    return out.withColumns({"tokens": F.col("epoch_tokens") * epochs, "added_tokens": (F.col("epoch_tokens") - F.col("root_epoch_tokens")) * epochs, "multiplier": F.col("epoch_tokens") / F.col("root_epoch_tokens")})


def completion_labels(prompt: Column, full: Column, ignore: int = -100) -> Column:
    """Labels of full's ids with the prompt's masked; null unless the prompt is a proper prefix."""
    n = F.size(prompt)
    fits = (F.slice(full, 1, n) == prompt) & (F.size(full) > n)
    return F.when(fits, F.concat(F.array_repeat(F.lit(ignore).cast("int"), n), F.slice(full, n + 1, F.greatest(F.lit(1), F.size(full) - n))))


def collated(rows: DataFrame, most: int, batch: str, pad: int = 0, ignore: int = -100) -> DataFrame:
    """rows (ids, labels) cut to `most` ids and padded on the right to their batch's longest, with attention_mask; rows whose
    labels are all masked after the cut are null, which is an error to raise before training."""
    rows = rows.withColumns({"ids": F.slice("ids", 1, most), "labels": F.slice("labels", 1, most)})
    wide = F.max(F.size("ids")).over(Window.partitionBy(batch))
    rows = rows.withColumn("wide", wide)
    more = F.col("wide") - F.size("ids")
    left = F.exists("labels", lambda x: x != ignore)
    filled = {"ids": F.concat("ids", F.array_repeat(F.lit(pad).cast("int"), more)), "labels": F.when(left, F.concat("labels", F.array_repeat(F.lit(ignore).cast("int"), more))), "attention_mask": F.concat(F.array_repeat(F.lit(1), F.size("ids")), F.array_repeat(F.lit(0), more))}
    return rows.withColumns(filled).drop("wide")
