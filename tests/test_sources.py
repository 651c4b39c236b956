"""JSON-lines sources, streams and small sinks."""

import json

from tallyforge.sources import records
from tallyforge.streaming import progress


def test_strict_reading(spark, tmp_path):
    good = {"schema_version": "v1", "source_id": "a", "query": "q", "tools": "[]", "answers": "[]", "source_revision": "r"}
    lines = [json.dumps(good), "", '{"a": 1, "a": 2}', "[1]", "{", json.dumps({**good, "schema_version": "v0"}), json.dumps({**good, "query": None})]
    (tmp_path / "rows.jsonl").write_text("\n".join(lines))
    rows, faults = records.read_records(spark, str(tmp_path / "rows.jsonl"), records.RAW, ["v1"])
    assert rows.count() == 3
    assert sorted(r.fault for r in faults.collect()) == ["duplicate_key", "not_json", "not_object", "schema_version"]
    _, raw = records.read_raw(spark, str(tmp_path / "rows.jsonl"))
    assert "missing_query" in {r.fault for r in raw.collect()}
    assert records.paired_path("x/rows.jsonl", "fr") == "x/rows.fr.jsonl"


def test_lines_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b", None), (1, "a", 5)], "ordinal long, x string, n long")
    records.write_lines(rows, str(tmp_path / "out"))
    text = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(text) == ['{"n":5,"x":"a"}', '{"n":null,"x":"b"}']


def test_small_document(tmp_path):
    assert records.write_small(tmp_path / "m.json", {"b": 1, "a": 2}) == records.write_small(tmp_path / "m.json", {"a": 2, "b": 1})


def test_merged_stream_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"s{i % 3}", i * 10) for i in range(12)], "ordinal long, source_id string, v long")
    for i in range(3):
        rows.where(f"ordinal % 3 = {i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    query = progress.merged(progress.stream(spark, str(tmp_path / "in"), rows.schema), str(tmp_path / "state"), str(tmp_path / "check"))
    query.awaitTermination(120)
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "state").iterdir() if p.name.startswith("version="))
    got = {(r.source_id, r.v) for r in spark.read.parquet(str(tmp_path / "state" / f"version={last}")).collect()}
    assert got == {("s0", 90), ("s1", 100), ("s2", 110)}


def test_translated_stream(spark, tmp_path):
    spark.createDataFrame([("a", "x"), ("b", "y")], "source_id string, query string").write.parquet(str(tmp_path / "in"))
    query = progress.translated(progress.stream(spark, str(tmp_path / "in"), "source_id string, query string"), lambda texts: [t.upper() for t in texts], 1, str(tmp_path / "out"), str(tmp_path / "c"))
    query.awaitTermination(120)
    assert {r.output for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"X", "Y"}
