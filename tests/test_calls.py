"""Case tables of parsing, canonical form, spans and audits."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyforge.functions import audits, spans
from tallyforge.functions.calls import balanced, call_of, canonical, flattened, gold_of, normalized, tools_of


@pytest.mark.parametrize(
    ("text", "status"),
    [
        ('{"name": "f", "arguments": {}}', "ok"), ('so: [{"name": "f", "arguments": {"a": "]"}}] ok', "ok"), ("none", "no_json"), ("{", "invalid_json"), ('{"a": ]}', "invalid_json"), ("{'name': 1}", "invalid_json"),
        ("[]", "invalid_shape"), ('[{"name": "f", "arguments": {}}, 1]', "invalid_shape"), ('{"name": "", "arguments": {}}', "invalid_shape"), ('{"name": "f", "arguments": {}, "x": 1}', "invalid_shape"), ('{"name": "f", "arguments": []}', "invalid_shape"),
        ('{x} {"name": "f", "arguments": {}}', "invalid_json"), ('{"name": "f', "invalid_json"),
    ],
)
def test_call_status(text, status):
    assert call_of(text)[0] == status


def test_balanced_skips_brackets_in_strings():
    assert balanced(r'a {"x": "}\"{"} b') == r'{"x": "}\"{"}'


@pytest.mark.parametrize(("text", "reason"), [("x", "invalid_answers_json"), ("[]", "invalid_answer_shape"), ('[{"name":"a"},{"name":"b","arguments":{}}]', "invalid_answer_shape"), ('[{"name":"a","arguments":{}},{"name":"b","arguments":{}}]', "multi_call_answer"), ('[{"name":"a","arguments":{}}]', None)])
def test_gold(text, reason):
    assert gold_of(text)[0] == reason


def test_tools():
    assert tools_of("[]") == (None, "[]")
    assert tools_of("{}")[0] == tools_of('[{"name":"","description":"","parameters":{}}]')[0] == "invalid_tool_shape"
    assert tools_of("[")[0] == "invalid_tools_json"


def test_flattened():
    assert flattened({"a": {"b": [1, 1.0, True]}, "c": [], "d": None}) == {"a.b[0]": "1", "a.b[1]": "1.0", "a.b[2]": "true", "c": "[]", "d": "null"}
    assert flattened({}) == {"<root>": "{}"}


@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(), x, max_size=3), max_leaves=8))
def test_calls_round_trip(value):
    text = f"pre {canonical({'name': 'f', 'arguments': {'v': value}})} post"
    assert call_of(text) == ("ok", "f", canonical({"v": value}))


@given(st.text())
def test_normalized_is_stable(text):
    assert normalized(normalized(text)) == normalized(text)


def test_protected_spans():
    calls = '[{"name":"find_fare","arguments":{"code":" QZX","n":0.5,"ok":true,"at":[8.5,9],"list":"a1, b2"}}]'
    query = "use find_fare for ' QZX' at 0.5, from [8:30, 9] and a1 then b2"
    assert set(spans.protected(query, calls)) == {"find_fare", "' QZX'", "0.5", "[8:30, 9]", "a1", "b2", "9"}
    kept = spans.protected(query, calls)
    assert spans.restored(spans.masked(query, kept), kept) == query


def test_groups_discard_broken_ones():
    assert spans.groups("[1, {2}] x [3 } [4]") == ["{2}", "[1, {2}]", "[4]"]


@pytest.mark.parametrize(
    ("source", "output", "kept", "code", "reason"),
    [
        ("find the cat", "", [], "fr", "empty_output"), ("find the cat", "trouve X", ["cat"], "fr", "missing_protected_span"), ("find the cat", "find  THE cat", [], "fr", "untranslated_output"), ("find the cat", "le �", [], "fr", "untranslated_output"),
        ("find the cat", "a‮b", [], "fr", "unsafe_bidi_control"), ("find the cat", "x" * 2001, [], "fr", "output_too_long"), ("find the cat", "le chat", [], "fr", None), ("find the cat", "מצא את החתול", [], "he", None), ("find the cat", "מצאcat", [], "he", "malformed_spacing"),
        ("find the cat", "le chat noir", [], "he", "wrong_script"), ("find the cat", "найди", [], "he", "wrong_script"), ("find the cat", "מצא </user", [], "he", "prompt_leakage"), ("find the little cat now", "מצאאתהחתולהקטןעכשיו", [], "he", "malformed_spacing"),
    ],
)
def test_audit(spark, source, output, kept, code, reason):
    rows = spark.createDataFrame([(source, output, kept, code)], "source string, output string, spans array<string>, code string")
    assert rows.select(audits.audit(*(F.col(c) for c in rows.columns)).alias("a")).select("a.reason").first()[0] == reason


def test_output_repairs(spark):
    texts = ['```text\n"Translation: x"\n```', '"a" and "b"', " « y » ", "``` a b\nc```", "plain", '"']
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(audits.unwrap(F.col("t"))).collect()]
    assert got == ["x", '"a" and "b"', "y", "a b\nc", "plain", '"']
    rows = spark.createDataFrame([("0,5 et 10,55", ["0.5"]), ("0,5 et 0.5", ["0.5"]), ("1,2", ["x.y", "1.2"])], "t string, s array<string>")
    assert [r[0] for r in rows.select(audits.restore_points(F.col("t"), F.col("s"))).collect()] == ["0.5 et 10,55", "0,5 et 0.5", "1.2"]
    encoded = "×©×ľ"
    assert audits.byte_letters("plain text") == "plain text" and audits.byte_letters(encoded) != ""
