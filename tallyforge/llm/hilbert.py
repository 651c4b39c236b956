"""Sharding by a Hilbert curve over metadata, with DataFrame functions only.

Each dimension is quantised to the same number of bits, the cell's index on the curve orders the rows, and equal runs of
this order are the shards: files then cover small boxes of all dimensions, so filters on any of them skip files. Within a
cell rows go by a hash of the id. Shard sizes differ by at most one row (law `rows`).

The global rank needs no global sort: rows are counted by cell and hash slice, the counts are summed up, and rows are only
numbered within a slice. The number of slices follows the row count, so a cell with most rows is still cut small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import dropped, saved

#: Rows expected in a slice of one cell, even if all rows fall into that cell.
ROWS_A_SLICE = 4_000


def hilbert_index(columns: list[str], bits: int) -> Column:
    """The index on the Hilbert curve of a cell whose coordinates are the named columns of 0 to 2**bits - 1."""
    n = len(columns)
    full = (1 << n) - 1
    gray = lambda i: i ^ i >> 1
    ones = lambda i: ((i ^ (i + 1)).bit_length() - 1)  # noqa: E731  trailing set bits
    entry = ",".join(str(gray(2 * ((w - 1) // 2)) if w else 0) for w in range(full + 1))
    turn = ",".join(str(0 if not w else ones(w if w % 2 else w - 1) % n) for w in range(full + 1))
    level = " | ".join(f"shiftleft(shiftright(cell[{k}], i) & 1, {k})" for k in range(n))
    right = f"((shiftright(v, (s.d + 1) % {n}) | shiftleft(v, {n} - (s.d + 1) % {n})) & {full})"
    left = f"((shiftleft(v, (s.d + 1) % {n}) | shiftright(v, {n} - (s.d + 1) % {n})) & {full})"
    undo = " ^ ".join(f"shiftright(v, {k})" for k in range(n))
    let = lambda value, body: f"transform(array({value}), v -> {body})[0]"
    step = (
        f"transform(array({let(let(f'({level}) ^ s.e', right), undo)}), w -> "
        f"named_struct('e', s.e ^ {let(f'array({entry})[w]', left)}, 'd', (s.d + array({turn})[w] + 1) % {n}, 'h', shiftleft(s.h, {n}) | cast(w as bigint)))[0]"
    )
    sql = f"aggregate(sequence({bits - 1}, 0, -1), named_struct('e', 0, 'd', 0, 'h', 0L), (s, i) -> {step}, s -> s.h)"
    return F.expr(f"transform(array(array({', '.join(f'cast({c} as int)' for c in columns)})), cell -> {sql})[0]")


def with_curve(rows: DataFrame, dims: list[Column], bits: int = 4) -> DataFrame:
    """rows with `curve`, the Hilbert index of the quantised dims (values of 0 to 2**bits - 1; null counts as 0)."""
    named = {f"hilbert_{k}": F.coalesce(c, F.lit(0)) for k, c in enumerate(dims)}
    return rows.withColumns(named).withColumn("curve", hilbert_index(list(named), bits)).drop(*named)


#: Letters of a value of a text dimension that count.
LETTERS = 64


def cuts(rows: DataFrame, columns: list[str], key: str | None = None, parts: int = 16) -> dict[str, list[str]]:
    """For each column, the values that cut all its rows in the order of the values into `parts` of like size: those at the places
    rows * i // parts. key isn't used any more, as all rows are counted.

    Distinct values are counted, dealt to partitions by ranges, and the partitions' sums tell which of them hold a cut; only the
    cuts and these sums reach the driver."""
    each = F.explode(F.array(*[F.struct(F.lit(j).alias("of"), F.coalesce(F.left(F.col(c), F.lit(LETTERS)), F.lit("")).alias("value")) for j, c in enumerate(columns)]))
    counts = rows.select(each.alias("x")).groupBy("x.of", "x.value").agg(F.count(F.lit(1)).alias("n"))
    values = saved(counts.repartitionByRange("of", "value").withColumn("part", F.spark_partition_id()), "values")
    sums = values.groupBy("part").agg(F.sum("n")).orderBy("part").collect()
    total = sum(n for _, n in sums) // len(columns)  # of each column, in turn
    places = [total * j + total * i // parts for j in range(len(columns)) for i in range(1, parts)] if total else []
    out, before = {c: [] for c in columns}, 0
    within: list[tuple[int, int]] = []
    for part, n in sums:
        within += [(part, place - before) for place in places if before <= place < before + n]
        before += n
    window = Window.partitionBy("part").orderBy("of", "value")
    held = values.where(F.col("part").isin(sorted({part for part, _ in within}))).withColumn("upto", F.sum("n").over(window))
    hit = F.filter(
        F.array(*[F.struct(F.lit(part).alias("part"), F.lit(place).cast("long").alias("place")) for part, place in within]),
        lambda x: (x["part"] == F.col("part")) & (x["place"] < F.col("upto")) & (x["place"] >= F.col("upto") - F.col("n")),
    )
    found = held.select("of", "value", F.size(hit).alias("cuts")).where("cuts > 0").orderBy("of", "value").collect() if within else []
    for j, value, n in found:
        out[columns[j]] += [value] * n
    dropped(values)
    return out


def text_dims(found: dict[str, list[str]], size: str = "size") -> list[Column]:
    """Cells of the columns that cuts() was asked for, in the order of their values, and of a size by its power of two: 4 bits
    each."""
    cell = lambda c, at: F.size(F.filter(F.array(*[F.lit(x) for x in at]), lambda x: x <= F.left(F.col(c), F.lit(LETTERS)))) if at else F.lit(0)
    return [*[cell(c, at) for c, at in found.items()], F.least(F.length(F.bin(F.col(size))) - 1, F.lit(15))]


def ranked(rows: DataFrame, id_col: str) -> tuple[DataFrame, int]:
    """rows (with `curve`) with `rank`, gapless from 0 in the order of curve and then a hash of the id and a number of the row, so
    that repeated and null ids are spread too; and their number."""
    rows = saved(rows.withColumn("code", F.xxhash64(F.col(id_col), F.monotonically_increasing_id())), "cells", small=True)
    total = rows.count()
    slices = total // ROWS_A_SLICE + 1
    rows = rows.withColumn("slice", F.pmod(F.col("code"), F.lit(slices)))
    counts = rows.groupBy("curve", "slice").agg(F.count(F.lit(1)).alias("n"))
    in_cell = counts.withColumn("before", F.sum("n").over(Window.partitionBy("curve").orderBy("slice")) - F.col("n"))
    cells = counts.groupBy("curve").agg(F.sum("n").alias("m"))  # at most 2**(bits * dims) rows
    cells = cells.select("curve", (F.sum("m").over(Window.orderBy("curve")) - F.col("m")).alias("ahead"))
    starts = in_cell.join(F.broadcast(cells), "curve").select("curve", "slice", (F.col("before") + F.col("ahead")).alias("start"))
    order = Window.partitionBy("curve", "slice").orderBy("code")
    return rows.withColumn("own", F.row_number().over(order)).join(starts, ["curve", "slice"]).withColumn("rank", F.col("start") + F.col("own") - 1).drop("code", "slice", "own", "start"), total


def hilbert_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """One row for each row of docs: doc_id, size (UTF-8 bytes plus 1), text_crc32, law, shard, slot, grown_shard (null), curve.

    A null text has size 1 and the CRC of no bytes; very long texts count whole. A null lang or source counts as the empty text.
    Repeated rows and null ids each get a slot. Extra columns are ignored, whatever their names; an empty table gives no rows.
    """
    bare = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.lower(F.coalesce("lang", F.lit(""))).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    dims = text_dims(cuts(bare, ["lang", "source"]))
    rows, total = ranked(with_curve(bare, dims).drop("lang", "source"), "doc_id")
    shard = F.expr(f"(rank * {shards}) div {max(1, total)}")
    rows = rows.withColumn("shard", shard)
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"), (F.col("rank") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_sharded(docs: DataFrame, path: str, files: int) -> None:
    """Write docs with all columns as about `files` files along the curve, each sorted by it, so that filters on lang, source or
    length skip files by their statistics.

    Nulls count as empty values; repeated rows and null ids stay; extra columns stay whatever their names, `curve` and `size`
    included. Rows of one cell go by a hash of the id and a number of the row, so a hot cell takes several files."""
    own = {name: f"{name}_of_layout" for name in ("lang", "source", "size", "curve", "tie")}
    while set(own.values()) & set(docs.columns):
        own = {name: f"{value}_" for name, value in own.items()}
    laid = docs.withColumns({own["lang"]: F.lower(F.coalesce("lang", F.lit(""))), own["source"]: F.coalesce("source", F.lit("")), own["size"]: F.coalesce(F.octet_length("text"), F.lit(0)) + 1, own["tie"]: F.xxhash64("doc_id", F.monotonically_increasing_id())})
    dims = text_dims(cuts(laid, [own["lang"], own["source"]]), own["size"])
    kept = [F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(docs.columns)]
    laid = with_curve(laid.select(*kept, *[F.col(c) for c in own.values() if c != own["curve"]]), dims)
    laid = laid.repartitionByRange(files, "curve", own["tie"]).sortWithinPartitions("curve", own["tie"])
    laid.select(*[F.col(f"kept_{i}").alias(c) for i, c in enumerate(docs.columns)]).write.parquet(path)
