"""Tool calls as JSON text: canonical form, shape rules, extraction from generated text, and additive score components.

Canonical JSON (sorted keys, compact, ASCII) is the equality of arguments: number spellings, booleans and list order count,
key order doesn't. Python's parser decides what is JSON, in Arrow batches; everything around it is built-in functions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import functions as F

#: First bracket, then whole strings or single brackets; a quote that opens no whole string ends the search.
_OPENING = re.compile(r"[\[{]")
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|["\[\]{}]', re.DOTALL)
_PARTNER = {"]": "[", "}": "{"}
#: White space as Python strips it.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def canonical(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def loads(text: str) -> tuple[bool, Any]:
    try:
        return True, json.loads(text)
    except (ValueError, RecursionError):
        return False, None


def _named(item: Any, *fields: tuple[str, type]) -> bool:
    return isinstance(item, dict) and isinstance(item.get("name"), str) and item["name"] != "" and all(isinstance(item.get(f), t) for f, t in fields)


def tools_of(text: str) -> tuple[str | None, str | None]:
    """(reason, canonical tools): a list, perhaps empty, of named tools with a description and parameters."""
    fine, value = loads(text)
    if not fine:
        return "invalid_tools_json", None
    if not isinstance(value, list) or not all(_named(t, ("description", str), ("parameters", dict)) for t in value):
        return "invalid_tool_shape", None
    return None, canonical([{f: t[f] for f in ("name", "description", "parameters")} for t in value])


def gold_of(text: str) -> tuple[str | None, str | None]:
    """(reason, canonical calls): exactly one named call; a wrong shape counts before a wrong number."""
    fine, value = loads(text)
    if not fine:
        return "invalid_answers_json", None
    if not isinstance(value, list) or not value or not all(_named(c, ("arguments", dict)) for c in value):
        return "invalid_answer_shape", None
    if len(value) > 1:
        return "multi_call_answer", None
    return None, canonical([{f: value[0][f] for f in ("name", "arguments")}])


def balanced(text: str) -> str | None:
    """The group that the first bracket opens, if it closes properly."""
    first = _OPENING.search(text)
    if first is None:
        return None
    open_: list[str] = []
    for token in _TOKEN.finditer(text, first.start()):
        sign = token.group()
        if sign == '"':
            return None
        if sign in "[{":
            open_.append(sign)
        elif sign in _PARTNER:
            if not open_ or open_.pop() != _PARTNER[sign]:
                return None
            if not open_:
                return text[first.start() : token.end()]
    return None


def call_of(text: str) -> tuple[str, str | None, str | None]:
    """(status, name, canonical arguments) of generated text."""
    group = balanced(text)
    if group is None:
        return ("invalid_json" if _OPENING.search(text) else "no_json"), None, None
    fine, value = loads(group)
    if not fine:
        return "invalid_json", None, None
    if isinstance(value, list):
        value = value[0] if len(value) == 1 else None
    if not _named(value, ("arguments", dict)) or len(value) != 2:
        return "invalid_shape", None, None
    return "ok", value["name"], canonical(value["arguments"])


def flattened(value: Any) -> dict[str, str]:
    """Path to canonical leaf; empty containers are leaves, an empty root is `<root>`, the last of equal paths wins."""
    out: dict[str, str] = {}
    todo = [("", value)]
    while todo:
        path, item = todo.pop()
        if item and isinstance(item, dict):
            todo += [(f"{path}.{k}" if path else str(k), v) for k, v in reversed(item.items())]
        elif item and isinstance(item, list):
            todo += [(f"{path}[{i}]", v) for i, v in reversed(list(enumerate(item)))]
        else:
            out[path or "<root>"] = canonical(item)
    return out


def _over(kind: str, function, n: int = 1, once: bool = False):
    """A scalar pandas UDF of row-wise Python over n columns, made when first called; a null argument gives null. once: filters
    on what depends on it are not pushed below it, which would run it again, and before rows are spread."""
    names = [f.split(":")[0] for f in kind.removeprefix("struct<").rstrip(">").split(",")] if kind.startswith("struct") else None

    def made():
        def values(columns: tuple[pd.Series, ...]):
            rows = [None if any(x is None for x in row) else function(*row) for row in zip(*columns, strict=True)]
            return pd.DataFrame([r or (None,) * len(names) for r in rows], columns=names, dtype=object) if names else pd.Series(rows, dtype=object)

        def one(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for part in parts:
                yield values((part,))

        def one_row(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for part in parts:
                yield values((part,))

        def many(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for part in parts:
                yield values(part)

        def many_row(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            for part in parts:
                yield values(part)

        udf = F.pandas_udf({(1, False): one, (1, True): one_row}.get((n, bool(names)), many_row if names else many), kind)
        return udf.asNondeterministic() if once else udf

    return lambda *columns: made()(*columns)


def normalized(query: str) -> str:
    return " ".join(query.casefold().split())


def canonical_text(text: str) -> str | None:
    fine, value = loads(text)
    return canonical(value) if fine else None


def leaf_pairs(text: str) -> dict[str, str] | None:
    fine, value = loads(text)
    return flattened(value) if fine else None


def unicode_text(text: str) -> str | None:
    """Canonical JSON with letters as they are."""
    fine, value = loads(text)
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) if fine else None


def target_fault(text: str) -> str:
    """What keeps a text from being a canonical list of gold calls; empty if nothing does."""
    fine, value = loads(text)
    if not fine:
        return "invalid_json"
    if not isinstance(value, list) or not value or not all(_named(c, ("arguments", dict)) and len(c) == 2 for c in value):
        return "invalid_shape"
    return "" if canonical(value) == text else "not_canonical"


def html_safe(text: str) -> str | None:
    out = canonical_text(text)
    return out and out.replace("&", "\\u0026").replace("<", "\\u003c").replace(">", "\\u003e")


normalize_query = _over("string", normalized)
canonical_json = _over("string", canonical_text)
canonical_unicode = _over("string", unicode_text)
gold_target_fault = _over("string", target_fault)
html_safe_json = _over("string", html_safe)
parse_tools = _over("struct<reason:string,tools:string>", tools_of)
parse_gold = _over("struct<reason:string,calls:string>", gold_of)



def row_of(tools: str, answers: str) -> tuple[str | None, str | None, str | None]:
    """(reason, canonical tools, canonical calls) of a raw row's two JSON columns, the tools' faults first."""
    reason, own = tools_of(tools)
    if reason:
        return reason, None, None
    reason, calls = gold_of(answers)
    return reason, own, calls


def scores_of(raw: str, gold_name: str, gold_arguments: str) -> tuple:
    """Status, name, canonical arguments and the score components of generated text against a gold call."""
    status, name, arguments = call_of(raw)
    gold = flattened(json.loads(gold_arguments))
    own = flattened(json.loads(arguments)) if status == "ok" else {}
    ok, named, args = status == "ok", status == "ok" and name == gold_name, status == "ok" and arguments == canonical(json.loads(gold_arguments))
    return status, name, arguments, int(ok), int(named), int(args), int(named and args), 2 * len(own.items() & gold.items()), len(own) + len(gold)


parse_rows = _over("struct<reason:string,tools:string,calls:string>", row_of, 2, once=True)
score_call = _over("struct<status:string,name:string,arguments:string,valid:long,named:long,args:long,whole:long,f1_num:long,f1_den:long>", scores_of, 3, once=True)
parse_call = _over("struct<status:string,name:string,arguments:string>", call_of)
flatten_arguments = _over("map<string,string>", leaf_pairs)
