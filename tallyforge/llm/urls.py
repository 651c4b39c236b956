"""URL filtering, with DataFrame functions only: rules on hosts and paths, and a list of unwanted URLs.

A blocked Bloom filter of the listed canonical URLs (one 64-bit word a block, several bits in it) lets possible hits pass;
an exact hash join with the list removes its false positives. The filter always has as many blocks as the list needs: up to
MAX_BLOCKS it is broadcast, beyond that its blocks are dealt out and the pages meet them by an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Blocks of a filter that is broadcast at most (1 MB as rows), bits that a URL sets in its block, bits of the filter for a listed URL.
MAX_BLOCKS, BITS_SET, BITS_A_URL = 65_536, 5, 16
SALTS = 16
#: (verdict, host and path): fits the host and its subdomains where the URL's path starts with the rule's.
RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def with_parts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """pages with host, path and canonical (null without ://).

    canonical: host without `www.` and default ports, path without trailing slashes, and the sorted parameters other than
    tracking ones; scheme and fragment are dropped.
    """
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.locate("://", url)
    rows = pages.withColumn("rest", F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit("")))
    host = F.regexp_extract("rest", r"^[^/?#]*", 0)
    rows = rows.withColumns({"host": F.translate(host, UPPER, LOWER), "tail": F.substring("rest", F.length(host) + 1, F.length("rest"))})
    rows = rows.withColumns({"path": F.regexp_extract("tail", r"^[^?#]*", 0), "query": F.regexp_extract("tail", r"^[^?#]*\?([^#]*)", 1)})
    kept = F.array_sort(F.filter(F.split("query", "&"), lambda p: ~p.rlike(TRACKING)))
    name = F.regexp_replace("host", r"^www\.|:(80|443)?$", "")
    whole = F.concat(name, F.regexp_replace("path", "/+$", ""), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))
    return rows.withColumn("canonical", F.when(at > 0, whole)).drop("rest", "tail", "query")


#: Parameters that don't tell pages apart, and empty ones.
TRACKING = r"^$|^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def rule_for(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule of host and path, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, path = text.partition("/")
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith("/" + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _mask(url: Column) -> Column:
    code = F.xxhash64(url, F.lit("bits"))
    one = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(code, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS_SET)]
    out = one[0]
    for x in one[1:]:
        out = out.bitwiseOR(x)
    return out


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks).cast("long"))


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """block, word: the blocked Bloom filter of the distinct urls of listed, a row for each block that has any."""
    return listed.groupBy(_block(F.col("canonical"), blocks).alias("block")).agg(F.bit_or(_mask(F.col("canonical"))).alias("word"))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row for each page: page_id, host, path, rule, verdict. listed has a column `canonical`, nulls and repeats allowed.

    The longest fitting rule gives the verdict; without one, `block` if the canonical URL is listed, else `allow`. A null url
    or one without :// has an empty host and path, no rule, and is allowed. Repeated rows each get a row. Very long urls count
    whole; extra columns are ignored; an empty table gives no rows, an empty list blocks nothing.
    """
    pages = with_parts(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")))
    listed = saved(listed.where("canonical is not null").select("canonical").distinct(), "listed", small=True)
    blocks = listed.count() * BITS_A_URL // 64 + 1
    table = bloom(listed, blocks)
    rule, verdict = rule_for(rules)
    pages = pages.withColumns({"rule": rule, "ruled": verdict, "block": _block(F.col("canonical"), blocks), "mask": _mask(F.col("canonical"))})
    open_ = pages.join(F.broadcast(table) if blocks <= MAX_BLOCKS else table.hint("merge"), "block", "left")
    maybe = F.col("ruled").isNull() & F.coalesce(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))
    # passed urls are dealt by salt too, so that one url on very many pages isn't one task's; others need no join and keep no key
    passed = open_.withColumns({"key": F.when(maybe, F.col("canonical")), "salt": F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")})
    salted = listed.select(F.col("canonical").alias("key"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("hit"))
    out = lambda rows, hit: rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(hit, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
    sure = out(passed.where("key is null"), F.lit(False))
    checked = out(passed.where("key is not null").join(salted.hint("merge"), ["key", "salt"], "left"), F.coalesce("hit", F.lit(False)))
    return sure.unionByName(checked)


def listed_by_host(pages: DataFrame, words: str = "spam|cheap|casino|adult") -> DataFrame:
    """A list to filter by where a corpus has none: canonical URLs on hosts with a label that starts with one of the words."""
    return with_parts(pages.select("url")).where(F.col("host").rlike(rf"(^|\.)({words})")).select("canonical")
