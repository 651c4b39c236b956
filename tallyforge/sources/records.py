"""JSON-lines sources and sinks with explicit order, schema versions, and duplicate keys refused."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.errors import ExternalError, InputError, SchemaError
from tallyforge.functions.calls import _over, canonical_json

RAW = "schema_version string, source_id string, query string, tools string, answers string, source_revision string, source_example_id string"


def _fault(line: str) -> str | None:
    class Repeated(Exception):
        pass

    def once(pairs: list[tuple[str, object]]) -> dict:
        if len(dict(pairs)) < len(pairs):
            raise Repeated
        return dict(pairs)

    try:
        value = json.loads(line, object_pairs_hook=once)
    except Repeated:
        return "duplicate_key"
    except ValueError:
        return "not_json"
    return None if isinstance(value, dict) else "not_object"


line_fault = _over("string", _fault)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """ordinal, value: non-blank lines in file order. The ordinal is file name order, then place: exact for files that one
    task reads (wholetext splits are avoided by maxPartitionBytes over the file size), monotone for larger ones."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.withColumn("ordinal", F.monotonically_increasing_id())


def read_records(spark: SparkSession, path: str, schema: str, versions: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(records with ordinal, faults with ordinal and fault): strict reading; require(faults) fails closed."""
    lines = read_lines(spark, path).withColumn("fault", line_fault("value"))
    records = lines.where("fault is null").select("ordinal", F.from_json("value", schema).alias("r")).select("ordinal", "r.*")
    faults = lines.where("fault is not null").select("ordinal", "fault")
    if versions is not None:
        faults = faults.unionByName(records.where(~F.coalesce(F.col("schema_version").isin(versions), F.lit(False))).select("ordinal", F.lit("schema_version").alias("fault")))
    return records, faults


def read_lenient(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines without a schema version or a rule on repeated keys; blank lines are skipped, other values than objects fail."""
    lines = spark.read.text(path).where(F.trim("value") != "").withColumn("ordinal", F.monotonically_increasing_id())
    wrong = lines.where(~F.ltrim("value").startswith("{")).limit(1).collect()
    if wrong:
        raise InputError(f"{path}: line {wrong[0]['ordinal'] + 1} isn't a JSON object")
    return lines.select("ordinal", F.from_json("value", schema).alias("r")).select("ordinal", "r.*") if schema else spark.read.json(path)


def read_json(path: str | Path, version: str | None = None) -> dict:
    """One JSON object of a small file; repeated keys, other values and another schema version fail."""
    text = Path(path).read_text(encoding="utf-8")
    fault = _fault(text)
    if fault:
        raise SchemaError(f"{path}: {fault}")
    value = json.loads(text)
    if version is not None and value.get("schema_version") != version:
        raise SchemaError(f"{path}: expected {version}")
    return value


def read_progress(spark: SparkSession, path: str, schema: str, key: str = "source_id") -> DataFrame:
    """The last record of each key of a checkpoint file; only its last line may be cut short, any other bad line fails."""
    from tallyforge.operators.journals import latest

    lines = read_lines(spark, path).withColumn("fault", line_fault("value"))
    last = lines.agg(F.max("ordinal")).first()[0]
    bad = lines.where(F.col("fault").isNotNull() & (F.col("ordinal") != last)).limit(1).collect()
    if bad:
        raise InputError(f"{path}: line at {bad[0]['ordinal']}: {bad[0]['fault']}")
    return latest(lines.where("fault is null").select("ordinal", F.from_json("value", schema).alias("r")).select("ordinal", "r.*"), key)


def read_raw(spark: SparkSession, path: str, paired: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, faults). Values of other types are taken as text, as a JSON reader with a text column gives them."""
    records, faults = read_records(spark, path, RAW)
    needed = ["source_id", "query", "tools", "answers", "source_revision"] + ["source_example_id"] * paired
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c in needed])
    return records, faults.unionByName(records.select("ordinal", missing.alias("fault")).where("fault is not null"))


def paired_path(path: str, language: str) -> str:
    """rows.jsonl to rows.<language>.jsonl."""
    head, dot, tail = path.rpartition(".")
    return f"{head}.{language}{dot}{tail}"


def write_lines(rows: DataFrame, path: str, order: str = "ordinal") -> None:
    """Rows as canonical JSON lines, sorted; one file for each range of the order."""
    columns = [c for c in rows.columns if c != order]
    rows.repartitionByRange(order).sortWithinPartitions(order).select(canonical_json(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})).alias("value")).write.text(path)


def write_one(rows: DataFrame, path: str | Path, order: str = "ordinal") -> str:
    """As write_lines, but into one file with a newline behind each row, for outputs that a person opens; its sha256."""
    import hashlib

    columns = [c for c in rows.columns if c != order]
    lines = rows.orderBy(order).select(canonical_json(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})).alias("value"))
    digest, temp = hashlib.sha256(), Path(f"{path}.part")
    with temp.open("wb") as out:
        for r in lines.toLocalIterator():  # a partition at a time
            digest.update(line := r["value"].encode() + b"\n")
            out.write(line)
        out.flush()
        os.fsync(out.fileno())
    os.replace(temp, path)
    return digest.hexdigest()


def exported(rows: DataFrame, names: dict[str, str], dataset: str, seed: int, limit: int | None, order: str | None = None) -> DataFrame:
    """Rows with canonical names; with a limit, the first ones by a hash of seed and id, or, with an order, by Python's seeded
    shuffle of the rows in that order."""
    if limit is not None and order is not None:
        import random

        from tallyforge.operators.prepare import numbered

        places = list(range(rows.count()))
        random.Random(seed).shuffle(places)
        laid = rows.sparkSession.createDataFrame([(p, i) for i, p in enumerate(places[:limit])], "place long, export_place long")
        rows, limit = numbered(rows, order).join(laid, "place").drop("place", "export_place"), None
    out = rows.select(*[F.col(own).alias(name) for name, own in names.items()]).withColumn("source_id", F.concat(F.lit(f"{dataset}:"), F.col("id").cast("string"))).drop("id")
    if limit is None:
        return out
    return out.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), "source_id"), 256), "source_id").limit(limit)


def write_small(path: str | Path, payload: dict, exclusive: bool = False) -> str:
    """Replace a small JSON document at once; its sha256 is returned. What was written is read again and compared. exclusive: a
    document that is there already is an error, also if another writer comes first."""
    import hashlib

    data = json.dumps(payload, sort_keys=True, indent=2).encode() + b"\n"
    path = Path(path)
    handle, temp = tempfile.mkstemp(dir=path.parent)
    with os.fdopen(handle, "wb") as out:
        out.write(data)
        out.flush()
        os.fsync(out.fileno())
    if Path(temp).read_bytes() != data:
        os.unlink(temp)
        raise ExternalError(f"{path}: what was written differs")
    if exclusive:
        try:
            os.link(temp, path)
        except FileExistsError as error:
            raise InputError(f"{path} exists already") from error
        finally:
            os.unlink(temp)
    else:
        os.replace(temp, path)
    return hashlib.sha256(data).hexdigest()


def reference(path: str | Path, root: str | Path, kind: str, version: str = "") -> dict:
    """path below a root, kind, schema version, bytes and sha256 of a small file; a path outside the root fails."""
    import hashlib

    path, root = Path(path).resolve(), Path(root).resolve()
    if not path.is_relative_to(root):
        raise InputError(f"{path} lies outside {root}")
    data = path.read_bytes()
    return {"path": path.relative_to(root).as_posix(), "kind": kind, "schema_version": version, "bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()}


def file_identities(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256 of every file below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
