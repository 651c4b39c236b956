"""Bounded samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 1 << 30


def bucket(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def sampled(rows: DataFrame, label: str, id_col: str, most: int, most_bytes: int | None = None) -> DataFrame:
    """About `most` rows of each label, and about `most_bytes` of their column `text` if given, by a hash of the id; all rows
    where a label has fewer.

    The counts take one aggregation; the share of each label then is a filter that runs in the scan.
    """
    size = F.lit(0) if most_bytes is None else F.coalesce(F.sum(F.octet_length("text")), F.lit(0))
    counts = rows.groupBy(label).agg(F.count(F.lit(1)), size).collect()
    share = F.lit(0)
    for value, n, size in counts:
        share = F.when(F.col(label) == F.lit(value), F.lit(min(SPAN, SPAN * most // n + 1, SPAN * most_bytes // size + 1 if size else SPAN))).otherwise(share)
    return rows.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(SPAN)) < share)
