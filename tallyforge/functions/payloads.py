"""JSON documents: fields to redact, findings by path, and what a translator may know about a tool."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

from tallyforge.errors import InputError

from .calls import _over, canonical, loads

#: As in operators.secrets.
_TOKEN = re.compile(r"hf_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9\-_]{20,}|ghp_[A-Za-z0-9]{20,}|xox[baprs]-[A-Za-z0-9\-]{10,}")
_KEY = re.compile(r"(^|_)(token|secret|password|api_key|apikey)(_|$)", re.IGNORECASE)
MOST_CHARS = 8192
#: Keys that look like secrets and are public settings.
PUBLIC_KEYS = [
    "dedupe_key", "query_column", "tools_column", "answers_column", "redact_fields", "target_modules", "cached_input_tokens", "client_tokenizer_budget", "eos_token_id", "input_token_overhead_per_request", "input_tokens",
    "long_context_threshold_input_tokens", "max_new_tokens", "max_output_tokens", "max_response_input_tokens", "max_source_tokens", "output_tokens", "bos_token", "eos_token", "pad_token", "reasoning_output_tokens",
    "standard_usd_per_million_tokens", "token_budget", "tokenizer_adapter", "tokenizer_required", "total_tokens", "trainable_token_indices", "unk_token",
]


def without_fields(text: str, fields: list[str]) -> str | None:
    """The document with the values of the named keys replaced, anywhere in it; null if it isn't JSON."""
    hidden = set(fields)

    def walk(value: Any) -> Any:
        if isinstance(value, dict):
            return {k: "[redacted]" if k in hidden else walk(v) for k, v in value.items()}
        return [walk(v) for v in value] if isinstance(value, list) else value

    fine, value = loads(text)
    return canonical(walk(value)) if fine else None


class Repeated(ValueError):
    """A JSON object has a key twice."""


def once(pairs: list[tuple[str, Any]]) -> dict:
    if len(dict(pairs)) < len(pairs):
        raise Repeated
    return dict(pairs)


def _told(text: str, values: list[str], home: str) -> Iterator[str]:
    """Kinds of what one text gives away."""
    if _TOKEN.search(text):
        yield "secret_value"
    yield from ("sensitive_env_value" for v in values if v in text)
    if len(home) > 1 and home in text:
        yield "home_path"


def findings(text: str, allowed: list[str], values: list[str] | None = None, home: str = "", vocabulary: bool = False) -> list[tuple[str, str]] | None:
    """(path, kind) in document order: first keys that name secrets, then texts that hold token-like values, values of the
    environment or the home folder; a key's own text is at its path and `::<key>`. With vocabulary, the words of `model.vocab`
    aren't taken for names of fields. Null where the text isn't JSON; repeated keys raise."""
    keys: list[tuple[str, str]] = []
    texts: list[tuple[str, str]] = []

    def visit(value: Any, path: str, named: bool) -> None:
        if isinstance(value, dict):
            words = vocabulary and path == "model.vocab" and all(isinstance(v, int) for v in value.values())
            for key, inner in value.items():
                at = f"{path}.{key}" if path else key
                if named and not words and _KEY.search(key) and key not in allowed:
                    keys.append((at, "sensitive_key"))
                texts.extend((f"{at}::<key>", kind) for kind in _told(key, values or [], home))
                visit(inner, at, named)
        elif isinstance(value, list):
            for i, inner in enumerate(value):
                visit(inner, f"{path}[{i}]", named)
        elif isinstance(value, str):
            texts.extend((path or "<root>", kind) for kind in _told(value, values or [], home))

    try:
        value = json.loads(text, object_pairs_hook=once)
    except Repeated:
        raise
    except (ValueError, RecursionError):
        return None
    visit(value, "", True)
    return keys + texts


def scanned(file: str, text: str, values: list[str], home: str) -> list[dict[str, str]]:
    """(location, kind) of one file, by its suffix."""
    suffix = file.rpartition(".")[2].lower()

    def lines(text: str) -> Iterator[tuple[str, str]]:
        for n, line in enumerate(text.splitlines(), 1):
            yield from ((f"line {n}", kind) for kind in _told(line, values, home))

    def document(text: str) -> Iterator[tuple[str, str]]:
        try:
            found = findings(text, PUBLIC_KEYS, values, home, file.rpartition("/")[2] == "tokenizer.json")
        except Repeated:
            yield "<json-object>", "duplicate_key"
            found = None
        yield from lines(text) if found is None else found

    if suffix == "json":
        out = list(document(text))
    elif suffix == "jsonl":
        out = [(f"{n}: {at}", kind) for n, line in enumerate(text.splitlines(), 1) if line.strip() for at, kind in document(line.strip())]
    else:
        out = list(lines(text))
    return [{"location": at, "kind": kind} for at, kind in out]


def assistant_payload(text: str) -> str | None:
    """The translation in a strict envelope, an object of `translation` alone; null for anything else or repeated keys."""
    try:
        value = json.loads(text, object_pairs_hook=once)
    except (ValueError, RecursionError):
        return None
    return value["translation"] if isinstance(value, dict) and list(value) == ["translation"] and isinstance(value["translation"], str) else None


def _parameters(given: dict) -> list[dict[str, str]]:
    """Names, types and descriptions of a tool's parameters, in either of both layouts; anything malformed raises."""
    if "properties" in given:
        inner = given["properties"]
    elif all(isinstance(v, dict) for v in given.values()):
        inner = given
    else:
        inner = {} if given.get("type") == "object" else None
    if not isinstance(inner, dict):
        raise InputError("the tool has an unsupported parameter schema")
    out = []
    for name, value in sorted(inner.items()):
        kind, text = (value.get("type", "unspecified"), value.get("description", "")) if isinstance(value, dict) else (None, None)
        if isinstance(kind, list) and kind and all(isinstance(k, str) and k for k in kind):
            kind = " | ".join(sorted(set(kind)))
        if not isinstance(kind, str) or not kind or not isinstance(text, str):
            raise InputError(f"parameter {name!r} is malformed")
        out.append({"name": name, "type": kind, "description": text})
    return out


def tool_context(tools: str, name: str) -> str | None:
    """Canonical JSON of the one tool of that name: name, description and its parameters' names, types and descriptions (a type
    that isn't given is `unspecified`); null if no tool or several have the name, if it is malformed, or too long."""
    fine, value = loads(tools)
    own = [t for t in value if isinstance(t, dict) and t.get("name") == name] if fine and isinstance(value, list) else []
    if len(own) != 1 or not isinstance(own[0].get("parameters"), dict):
        return None
    try:
        out = canonical({"name": name, "description": own[0].get("description", ""), "parameters": _parameters(own[0]["parameters"])})
    except InputError:
        return None
    out = out.replace("&", "\\u0026").replace("<", "\\u003c").replace(">", "\\u003e")
    return out if len(out) <= MOST_CHARS else None


def _listed(text: str, allowed: list[str]) -> list[dict[str, str]] | None:
    try:
        found = findings(text, allowed)
    except Repeated:
        return [{"path": "<json-object>", "kind": "duplicate_key"}]
    return None if found is None else [{"path": p, "kind": k} for p, k in found]


redact_fields = _over("string", lambda text, fields: without_fields(text, list(fields)), 2)
json_findings = _over("array<struct<path:string,kind:string>>", lambda text, allowed: _listed(text, list(allowed)), 2)
semantic_context = _over("string", tool_context, 2)
document_findings = _over("array<struct<location:string,kind:string>>", lambda file, text, values, home: scanned(file, text, list(values), home), 4)
parse_assistant_payload = _over("string", assistant_payload)
