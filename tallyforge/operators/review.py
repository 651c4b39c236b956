"""Review samples: strata, stable order, selection under quotas, and decisions."""

from __future__ import annotations

import hashlib
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.errors import InputError

#: Verbs that mark a request as risky to misread.
HIGH_RISK_VERBS = ["book", "cancel", "charge", "close", "delete", "deposit", "draw", "issue", "open", "order", "pay", "post", "refund", "remove", "reserve", "return", "schedule", "send", "set", "ship", "transfer", "withdraw"]


def risk_verbs(query: Column) -> Column:
    """Sorted distinct verbs of HIGH_RISK_VERBS that the query has as whole words."""
    pattern = r"\b(" + "|".join(HIGH_RISK_VERBS) + r")\b"
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(query), F.lit(pattern), F.lit(1))))


def stable_hash(namespace: str, seed: int, key: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(namespace), F.lit(str(seed)), key), 256)


def length_decile(rows: DataFrame, length: str, key: str) -> DataFrame:
    """rows with decile: min(10, rank * 10 // n + 1), rank from 0 by (length, key).

    The rank within one length is numbered by key; lengths are counted and summed up, so no single sort holds all rows."""
    counts = rows.groupBy(length).agg(F.count(F.lit(1)).alias("decile_own"))
    ahead = counts.withColumns({"decile_ahead": F.sum("decile_own").over(Window.orderBy(length)) - F.col("decile_own"), "decile_all": F.sum("decile_own").over(Window.partitionBy())})
    rank = lambda place: F.least(F.lit(10), F.floor(place * 10 / F.col("decile_all")) + 1).cast("long")
    ahead = ahead.withColumns({"decile_low": rank(F.col("decile_ahead")), "decile_high": rank(F.col("decile_ahead") + F.col("decile_own") - 1)})
    laid = rows.join(ahead, length)
    # only lengths that a cut goes through need their rows in order, and these are at most nine
    sure = laid.where("decile_low = decile_high").withColumn("decile", F.col("decile_low"))
    place = F.row_number().over(Window.partitionBy(length).orderBy(key)) - 1
    torn = laid.where("decile_low < decile_high").withColumn("decile", rank(F.col("decile_ahead") + place))
    return sure.unionByName(torn).drop("decile_own", "decile_ahead", "decile_all", "decile_low", "decile_high")


def strata_counts(rows: DataFrame, *dimensions: str) -> DataFrame:
    """dimension, stratum, n for each of several columns."""
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("stratum")) for d in dimensions]))
    return rows.select(pairs.alias("p")).groupBy("p.dimension", "p.stratum").agg(F.count(F.lit(1)).alias("n"))


def quota_sample(rows: DataFrame, size: int, most_risky: int, namespace: str, seed: int) -> DataFrame:
    """A sample of `size` rows: up to most_risky of the risky ones (`risky`), the rest ordinary ones, and risky ones again where
    these run short; in the order of a stable hash of example_id. Only the first rows of either kind are ever sorted."""
    rows = rows.withColumn("order_hash", stable_hash(namespace, seed, F.col("example_id")))
    first = lambda risky: rows.where(F.col("risky") == risky).orderBy("order_hash", "example_id").limit(size)
    both = first(True).unionByName(first(False))  # at most twice the size
    both = both.withColumn("place", F.row_number().over(Window.partitionBy("risky").orderBy("order_hash", "example_id")))
    both = both.withColumn("class", F.when(F.col("risky") & (F.col("place") <= most_risky), 0).when(~F.col("risky"), 1).otherwise(2))
    return both.orderBy("class", "order_hash", "example_id").limit(size).drop("class", "place")


#: Size of a review sample, and how many of it are risky.
SAMPLE, MOST_RISKY = 200, 40
DIMENSIONS = ["split", "decile", "spans", "action"]


def joined(pairs: DataFrame, roots: DataFrame, splits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates, faults). Candidates: example_id, source_example_id, query (of the root), split, decile, spans, action, verbs.

    pairs: source_id, source_example_id, tools, answers. roots: source_id, query, tools, answers. splits: id, split. A fault is a
    repeated id on either side, a pair without a root or split, or other tools or answers; with one there is no review."""
    from tallyforge.functions.spans import protected_spans

    own = roots.select(F.col("source_id").alias("root_id"), "query", F.col("tools").alias("root_tools"), F.col("answers").alias("root_answers"))
    rows = pairs.join(own, F.col("source_example_id") == F.col("root_id"), "left").join(splits.select(F.col("id").alias("split_id"), "split"), F.col("source_example_id") == F.col("split_id"), "left")
    why = F.when(F.col("root_id").isNull(), "missing_root").when(F.col("split").isNull(), "missing_split").when((F.col("tools") != F.col("root_tools")) | (F.col("answers") != F.col("root_answers")), "changed_gold")
    twice = lambda df, column, name: df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit(name).alias("fault"), F.col(column).alias("key"))
    faults = rows.select(why.alias("fault"), F.col("source_id").alias("key")).where("fault is not null")
    faults = faults.unionByName(twice(pairs, "source_id", "duplicate_pair")).unionByName(twice(pairs, "source_example_id", "duplicate_root_of_pair")).unionByName(twice(roots, "source_id", "duplicate_root"))
    fine = rows.where(why.isNull()).withColumn("query_chars", F.length("query"))
    placed = length_decile(fine, "query_chars", "root_id")
    action = F.get_json_object("answers", "$[0].name")
    out = placed.select(F.col("source_id").alias("example_id"), "source_example_id", "query", "split", F.col("decile").cast("string").alias("decile"), F.size(protected_spans("query", "answers")).cast("string").alias("spans"), action.alias("action"), risk_verbs(F.col("query")).alias("verbs"))
    return out, faults


def _tie(seed: int, namespace: str, key: str) -> str:
    return hashlib.sha256("\0".join(["review", namespace, str(seed), key]).encode()).hexdigest()


def balanced(candidates: list[dict], dimensions: list[str], size: int, seed: int = 0, namespace: str = "sample") -> list[str]:
    """Ids of a bounded candidate list, chosen one by one: each time the one whose strata lack most of their share of the sample,
    in parts of that share (or of one, if it is less), ties to the least hash. As many candidates as asked for are all taken.

    Rows of one combination of strata lack the same, so the least hash of each is compared: time goes with combinations."""
    if size > len(candidates):
        raise ValueError("more rows are asked for than there are")
    if size == len(candidates):
        return [c["example_id"] for c in candidates]
    target = {d: {v: size * n / len(candidates) for v, n in Counter(c[d] for c in candidates).items()} for d in dimensions}
    taken: dict[str, Counter] = {d: Counter() for d in dimensions}
    cells: dict[tuple, list[tuple[str, str]]] = {}
    for c in candidates:
        cells.setdefault(tuple(c[d] for d in dimensions), []).append((_tie(seed, namespace, c["example_id"]), c["example_id"]))
    for own in cells.values():
        own.sort(reverse=True)
    chosen: list[str] = []
    for _ in range(size):
        lack = {cell: sum(max(target[d][v] - taken[d][v], 0.0) / max(target[d][v], 1.0) for d, v in zip(dimensions, cell, strict=True)) for cell in cells}
        most = max(lack.values())
        best = min((cell for cell, x in lack.items() if x == most), key=lambda cell: cells[cell][-1])
        chosen.append(cells[best].pop()[1])
        if not cells[best]:
            del cells[best]
        for d, v in zip(dimensions, best, strict=True):
            taken[d][v] += 1
    return chosen


def risk_quotas(risky: int, ordinary: int, size: int = SAMPLE, most_risky: int = MOST_RISKY) -> tuple[int, int]:
    """Rows of either kind in a sample; where ordinary ones run short, risky ones take their places."""
    high = min(most_risky, risky)
    rest = size - high
    return (high + rest - ordinary, ordinary) if ordinary < rest else (high, rest)


def review_sample(candidates: DataFrame, seed: int, size: int = SAMPLE, most_risky: int = MOST_RISKY) -> list[str]:
    """Ids of the review sample in its stable order: balanced over DIMENSIONS within the risky and the ordinary candidates.

    The greedy choice needs only each combination's few least hashes: these are taken by a window in Spark, so what the driver
    gets is bounded by combinations times the sample's size, not by the candidates."""
    rows = candidates.withColumn("risky", F.size("verbs") > 0)
    counts = {r["risky"]: r["count"] for r in rows.groupBy("risky").count().collect()}
    if sum(counts.values()) < size:
        raise InputError(f"a review needs at least {size} accepted pairs, got {sum(counts.values())}")
    quotas = dict(zip((True, False), risk_quotas(counts.get(True, 0), counts.get(False, 0), size, most_risky), strict=True))
    chosen: list[str] = []
    for risky, namespace in ((True, "high-risk"), (False, "ordinary")):
        own = rows.where(F.col("risky") == risky)
        if quotas[risky] == counts.get(risky, 0):
            chosen += [r[0] for r in own.select("example_id").collect()]
        elif quotas[risky]:
            chosen += _balanced_cells(own, quotas[risky], seed, namespace)
    return sorted(chosen, key=lambda i: _tie(seed, "ordered-sample", i))


def _balanced_cells(rows: DataFrame, size: int, seed: int, namespace: str) -> list[str]:
    """As balanced(), from the least hashes of each combination of strata and the strata's counts."""
    tie = F.sha2(F.concat_ws("\0", F.lit("review"), F.lit(namespace), F.lit(str(seed)), F.col("example_id")), 256)
    ranked = rows.withColumn("tie", tie).withColumn("place", F.row_number().over(Window.partitionBy(*DIMENSIONS).orderBy("tie"))).where(F.col("place") <= size)
    kept = [r.asDict() for r in ranked.select("example_id", "tie", *DIMENSIONS).collect()]
    share = rows.groupBy(*DIMENSIONS).count().collect()
    total = sum(r["count"] for r in share)
    target: dict[str, Counter] = {d: Counter() for d in DIMENSIONS}
    for r in share:
        for d in DIMENSIONS:
            target[d][r[d]] += size * r["count"] / total
    taken: dict[str, Counter] = {d: Counter() for d in DIMENSIONS}
    cells: dict[tuple, list[tuple[str, str]]] = {}
    for r in kept:
        cells.setdefault(tuple(r[d] for d in DIMENSIONS), []).append((r["tie"], r["example_id"]))
    for own in cells.values():
        own.sort(reverse=True)
    chosen: list[str] = []
    for _ in range(size):
        lack = {cell: sum(max(target[d][v] - taken[d][v], 0.0) / max(target[d][v], 1.0) for d, v in zip(DIMENSIONS, cell, strict=True)) for cell in cells}
        most = max(lack.values())
        best = min((cell for cell, x in lack.items() if x > most - 1e-9), key=lambda cell: cells[cell][-1])
        chosen.append(cells[best].pop()[1])
        if not cells[best]:
            del cells[best]
        for d, v in zip(DIMENSIONS, best, strict=True):
            taken[d][v] += 1
    return chosen


def template(candidates: DataFrame, seed: int, size: int = SAMPLE, most_risky: int = MOST_RISKY) -> dict:
    """A locked review: the sample's ids in order with the digest of each row, strata of all candidates and of the sample."""
    chosen = review_sample(candidates, seed, size, most_risky)
    digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(candidates.columns)])), 256)
    laid = candidates.sparkSession.createDataFrame(list(enumerate(chosen)), "place long, example_id string")
    rows = candidates.join(F.broadcast(laid), "example_id")
    strata = lambda df: {(r["dimension"], r["stratum"]): r["n"] for r in strata_counts(df.withColumn("risky", (F.size("verbs") > 0).cast("string")), *DIMENSIONS, "risky").collect()}
    listed = [r.asDict() for r in rows.select("place", "example_id", digest.alias("row_sha256")).orderBy("place").collect()]
    whole = hashlib.sha256("\n".join(r["row_sha256"] for r in listed).encode()).hexdigest()
    return {"seed": seed, "size": size, "most_risky": most_risky, "rows": listed, "sample_sha256": whole, "strata": strata(candidates), "sample_strata": strata(rows)}


def validated(locked: dict, candidates: DataFrame, reviews: DataFrame, rubric: list[str]) -> list[str]:
    """Problems of a finished review: the sample, its digests and strata are made again and compared, every sampled row must have
    one consistent review, and none may be critical."""
    fresh = template(candidates, locked["seed"], locked["size"], locked["most_risky"])
    problems = [f"{field} differs" for field in ("rows", "sample_sha256", "strata", "sample_strata") if fresh[field] != locked[field]]
    ids = [r["example_id"] for r in locked["rows"]]
    found = Counter(r[0] for r in reviews.select("example_id").collect())  # as many rows as the sample has
    problems += [f"{i} isn't reviewed once" for i in ids if found[i] != 1] + [f"{i} isn't in the sample" for i in sorted(set(found) - set(ids))]
    problems += [f"{r['example_id']}: {r['fault']}" for r in inconsistent(reviews, rubric).collect()]
    critical = decisions(reviews, rubric).first()["critical"]
    return problems + ([f"{critical} critical errors"] if critical else [])


def decisions(reviews: DataFrame, rubric: list[str]) -> DataFrame:
    """One row: reviewed, passes and critical errors. A review is critical if any rubric item fails."""
    failed = F.exists(F.array(*[F.col(c) for c in rubric]), lambda x: x == "fail")
    return reviews.agg(F.count(F.lit(1)).alias("reviewed"), F.count_if(~failed).alias("passes"), F.count_if(failed).alias("critical"))


def inconsistent(reviews: DataFrame, rubric: list[str]) -> DataFrame:
    """example_id, fault: a pass with a failed item, a critical review without one, or a critical one without notes."""
    failed = F.exists(F.array(*[F.col(c) for c in rubric]), lambda x: x == "fail")
    why = F.when(F.col("critical") != failed, "critical_flag").when(F.col("passes") == F.col("critical"), "passes_flag").when(F.col("critical") & (F.length(F.coalesce("notes", F.lit(""))) == 0), "notes_missing")
    return reviews.select("example_id", why.alias("fault")).where("fault is not null")
