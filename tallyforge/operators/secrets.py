"""Secrets in texts and keys: predicates, redaction and findings, with built-in functions."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.errors import SecurityError
from tallyforge.functions.payloads import PUBLIC_KEYS, document_findings

#: Token patterns, and keys that name secrets.
TOKENS = [r"hf_[A-Za-z0-9]{20,}", r"sk-[A-Za-z0-9\-_]{20,}", r"ghp_[A-Za-z0-9]{20,}", r"xox[baprs]-[A-Za-z0-9\-]{10,}"]
SENSITIVE_KEY = r"(?i)(^|_)(token|secret|password|api_key|apikey)(_|$)"
PLACEHOLDER = "[redacted]"
#: Parts of the names of environment variables that hold secrets, and the shortest value that counts.
ENV_MARKERS, LEAST_ENV = ["TOKEN", "KEY", "SECRET", "PASSWORD"], 8
#: What ends a line.
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def has_token(text: Column) -> Column:
    return text.rlike("|".join(TOKENS))


def is_token(text: Column) -> Column:
    return F.trim(text).rlike("^(" + "|".join(TOKENS) + ")$")


def is_sensitive_key(key: Column, allowed: list[str] | None = None) -> Column:
    return key.rlike(SENSITIVE_KEY) & ~key.isin(PUBLIC_KEYS if allowed is None else allowed)


def env_values() -> list[str]:
    """Values of environment variables whose names say that they are secret."""
    return [v for n, v in os.environ.items() if len(v) >= LEAST_ENV and any(m in n.upper() for m in ENV_MARKERS)]


def redacted(text: Column, values: list[str] | None = None, home: str = "") -> Column:
    """text without token-like values, the given secret values (8 or more characters) and the home directory."""
    for pattern in TOKENS:
        text = F.regexp_replace(text, pattern, PLACEHOLDER)
    for value in values or []:
        if len(value) >= 8:
            text = F.replace(text, F.lit(value), F.lit(PLACEHOLDER))
    return F.replace(text, F.lit(home), F.lit("~")) if len(home) > 1 else text


def line_findings(texts: DataFrame, key: str, values: list[str] | None = None, home: str = "") -> DataFrame:
    """key, line (from 1), kind: one finding of each kind for a line."""
    lines = F.split("text", LINE_ENDS)
    lines = F.when(F.element_at(lines, -1) == "", F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(1)))).otherwise(lines)  # an end of line ends the text
    rows = texts.select(key, F.posexplode(lines).alias("at", "content"))
    kinds = [F.when(has_token(F.col("content")), F.lit("secret_value"))]
    kinds += [F.when(F.contains("content", F.lit(v)), F.lit("sensitive_env_value")) for v in values or []]
    kinds += [F.when(F.contains("content", F.lit(home)), F.lit("home_path"))] if len(home) > 1 else []
    return rows.select(key, (F.col("at") + 1).alias("line"), F.explode(F.array_compact(F.array(*kinds))).alias("kind"))


#: Suffixes of files that are read.
SCANNED = ["json", "jsonl", "md", "txt", "yaml", "yml"]


def file_findings(files: DataFrame, values: list[str] | None = None, home: str = "") -> DataFrame:
    """file, location, kind over files (file, text): JSON by its paths, JSON lines by line and path, other text by line. JSON with
    repeated keys is a finding itself and is read as text too."""
    values = values if values is not None else []
    found = document_findings("file", "text", F.array(*[F.lit(v) for v in values]).cast("array<string>"), F.lit(home))
    return files.select("file", F.explode(found).alias("f")).select("file", "f.location", "f.kind")


def tree_findings(spark: SparkSession, root: str, values: list[str] | None = None, home: str = "") -> DataFrame:
    """Findings of all files with a known suffix below a folder, by a distributed scan."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    rows = rows.where(F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).isin(SCANNED))
    return file_findings(rows.select(F.col("path").alias("file"), F.decode("content", "UTF-8").alias("text")), values if values is not None else env_values(), home)


def require_publishable(findings: DataFrame) -> None:
    """Fail closed; the first finding in order of files is named, never its value."""
    first = findings.orderBy("file", "location", "kind").limit(1).collect()
    if first:
        raise SecurityError(f"{findings.count()} findings; first: {first[0]['kind']} in {first[0]['file']} at {first[0]['location']}", "Remove or redact the flagged values.")
