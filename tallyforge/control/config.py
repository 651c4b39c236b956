"""Configuration: YAML or JSON with repeated keys refused, a closed model, no secrets, and a digest of what was resolved."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import asdict, dataclass, field, fields, replace
from pathlib import Path
from typing import Any

from tallyforge.errors import ConfigError, SecurityError
from tallyforge.functions.payloads import PUBLIC_KEYS, findings, once

VERSION, OLD_VERSION = "tallyforge.config.v2", "tallyforge.config.v1"
LANGUAGE = re.compile(r"[a-z]{2}")


@dataclass(frozen=True)
class Source:
    language: str = "en"
    dataset_id: str = ""
    dataset_revision: str = ""
    query_column: str = "query"
    tools_column: str = "tools"
    answers_column: str = "answers"
    source_id_column: str | None = None


@dataclass(frozen=True)
class Data:
    seed: int = 42
    n_train: int = 1000
    n_validation: int = 100
    n_test: int = 100
    min_query_chars: int = 1
    max_query_chars: int = 4000

    @property
    def sizes(self) -> dict[str, int]:
        return {"train": self.n_train, "validation": self.n_validation, "test": self.n_test}


@dataclass(frozen=True)
class Train:
    languages: tuple[str, ...] = ("en",)
    epochs: int = 1
    max_sequence_length: int = 4096


@dataclass(frozen=True)
class Eval:
    slices: tuple[str, ...] = ("en",)
    temperature: float = 0.0
    do_sample: bool = False
    max_new_tokens: int = 512


@dataclass(frozen=True)
class Config:
    schema_version: str = VERSION
    name: str = "run"
    artifact_root: str = "artifacts"
    gpu: str = "none"
    tracking: bool = False
    redact_fields: tuple[str, ...] = ()
    datasets: tuple[Source, ...] = (Source(),)
    data: Data = field(default_factory=Data)
    train: Train = field(default_factory=Train)
    eval: Eval = field(default_factory=Eval)

    @property
    def root(self) -> Source:
        return next(s for s in self.datasets if s.source_id_column is None)

    def resolved(self) -> str:
        return json.dumps(asdict(self), sort_keys=True, indent=2) + "\n"

    def digest(self) -> str:
        return hashlib.sha256(self.resolved().encode()).hexdigest()

    def smoke(self) -> Config:
        from tallyforge.operators.cohorts import smoke_sizes

        small = smoke_sizes(self.data.sizes)
        return replace(self, data=replace(self.data, n_train=small["train"], n_validation=small["validation"], n_test=small["test"]))


def _document(text: str, suffix: str) -> Any:
    if suffix == ".json":
        return json.loads(text, object_pairs_hook=once)
    import yaml

    class Strict(yaml.SafeLoader):
        pass

    def mapping(loader, node, deep=False):
        pairs = [(loader.construct_object(k, deep=True), loader.construct_object(v, deep=True)) for k, v in node.value]
        return once(pairs)

    Strict.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, mapping)
    return yaml.load(text, Loader=Strict)  # noqa: S506  a safe loader


def _made(kind: type, value: Any, path: str) -> Any:
    if not isinstance(value, dict):
        raise ConfigError(f"{path or 'config'} must be a mapping")
    known = {f.name: f for f in fields(kind)}
    unknown = sorted(set(value) - set(known))
    if unknown:
        raise ConfigError(f"unknown settings {', '.join(f'{path}{u}' for u in unknown)}")
    out = {}
    for name, given in value.items():
        default = known[name].default if known[name].default is not known[name].default_factory else None
        if name == "datasets":
            given = tuple(_made(Source, s, f"datasets[{i}].") for i, s in enumerate(given))
        elif name in ("data", "train", "eval"):
            given = _made({"data": Data, "train": Train, "eval": Eval}[name], given, f"{name}.")
        elif isinstance(given, list):
            given = tuple(given)
        elif isinstance(default, int | float | bool | str) and type(given) is not type(default) and not (isinstance(default, float) and type(given) is int):
            raise ConfigError(f"{path}{name} must be of type {type(default).__name__}")
        out[name] = given
    return kind(**out)


def upgraded(raw: dict) -> dict:
    """A document of the first version in the shape of the second: its one dataset becomes the English one."""
    out = {**raw, "schema_version": VERSION}
    if "dataset" in out and "datasets" not in out:
        out["datasets"] = [{**out.pop("dataset"), "language": "en"}]
    return out


def load(path: str | Path) -> Config:
    path = Path(path)
    if not path.exists():
        raise ConfigError(f"config file not found: {path}")
    try:
        raw = _document(path.read_text(encoding="utf-8"), path.suffix)
    except Exception as error:
        raise ConfigError(f"{path}: {type(error).__name__}", "Fix the syntax; keys must not repeat.") from error
    if not isinstance(raw, dict):
        raise ConfigError(f"{path} must hold a mapping")
    found = findings(json.dumps(raw, default=str), PUBLIC_KEYS)
    if found:
        raise SecurityError(f"config holds suspected secrets: {found[0][1]} at {found[0][0]}", "Give secrets by the environment.")
    config = _made(Config, upgraded(raw) if raw.get("schema_version") == OLD_VERSION else raw, "")
    if config.schema_version != VERSION:
        raise ConfigError(f"unknown schema version {config.schema_version}")
    languages = [s.language for s in config.datasets]
    if len(set(languages)) < len(languages) or not all(LANGUAGE.fullmatch(x) for x in languages):
        raise ConfigError("languages must be distinct two-letter codes")
    if sum(s.source_id_column is None for s in config.datasets) != 1:
        raise ConfigError("exactly one dataset must be the root")
    for name, asked in (("train.languages", config.train.languages), ("eval.slices", config.eval.slices)):
        if set(asked) - set(languages) or not asked:
            raise ConfigError(f"{name} must name configured languages")
    if min(config.data.sizes.values()) < 0 or config.data.min_query_chars > config.data.max_query_chars:
        raise ConfigError("sizes and lengths contradict each other")
    return config
