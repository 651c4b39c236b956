"""A run's folder: identity, logs, manifests, runtime, tracking and trees of files."""

from __future__ import annotations

import hashlib
import json
import math
import re
import subprocess
import sys
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path

from tallyforge.errors import EngineError, InputError, InvariantError
from tallyforge.functions.payloads import _TOKEN
from tallyforge.operators.secrets import PLACEHOLDER, env_values
from tallyforge.sources.records import read_json, reference, write_small

from .config import Config

LOG, MANIFEST, RUNTIME = "tallyforge.log_event.v1", "tallyforge.manifest.v1", "tallyforge.runtime_metadata.v1"


def run_id(now: datetime | None = None, smoke: bool = False) -> str:
    stamp = (now or datetime.now(UTC)).strftime("%Y%m%dT%H%M%SZ")
    return f"{'smoke-' * smoke}{stamp}-{uuid.uuid4().hex[:8]}"


def redacted(text: str) -> str:
    """A message without token-like values, secrets of the environment and the home folder."""
    text = _TOKEN.sub(PLACEHOLDER, text)
    for value in env_values():
        text = text.replace(value, PLACEHOLDER)
    home = Path.home().as_posix()
    return text.replace(home, "~") if len(home) > 1 else text


class Logger:
    """Log events of one stage as JSON lines, and short lines on the console."""

    def __init__(self, folder: Path, run: str, stage: str, console=None, now: Callable[[], datetime] = lambda: datetime.now(UTC)) -> None:
        self.path, self.run, self.stage, self.console, self.now = Path(folder) / f"{stage}.jsonl", run, stage, console or sys.stderr, now

    def log(self, level: str, event: str, message: str, **values) -> dict:
        for name, value in values.items():
            if isinstance(value, float) and not math.isfinite(value):
                raise InvariantError(f"log field {name} isn't a finite number")
        clean = {n: redacted(v) if isinstance(v, str) else v for n, v in values.items()}
        record = {"schema_version": LOG, "timestamp": self.now().isoformat(), "level": level, "run_id": self.run, "stage": self.stage, "event": event, "message": redacted(message), "fields": clean}
        self.path.parent.mkdir(parents=True, exist_ok=True)
        with self.path.open("a", encoding="utf-8") as out:
            out.write(json.dumps(record, sort_keys=True) + "\n")
        self.console.write(f"[{level}] {self.stage}:{event} {record['message']}\n")
        return record


def read_log(path: str | Path) -> list[dict]:
    out = []
    for n, line in enumerate(Path(path).read_text(encoding="utf-8").splitlines(), 1):
        if line.strip():
            record = json.loads(line)
            if not isinstance(record, dict) or record.get("schema_version") != LOG:
                raise InvariantError(f"{path}:{n} is no log event")
            out.append(record)
    return out


@dataclass(frozen=True)
class Run:
    id: str
    folder: Path
    root: Path
    config_sha256: str

    @classmethod
    def reserve(cls, config: Config, base: str | Path, id_: str | None = None, fresh: bool = False) -> Run:
        """Make a run's folder with its resolved configuration; fresh: one that is there already is an error, also if another
        process comes first."""
        id_ = id_ or run_id()
        root = Path(base) / config.artifact_root
        folder = root / "runs" / id_
        try:
            folder.mkdir(parents=True, exist_ok=not fresh)
        except FileExistsError as error:
            raise InputError(f"run folder exists already: {folder}", "Choose another run id.") from error
        (folder / "config.resolved.json").write_text(config.resolved(), encoding="utf-8")
        if not (folder / "manifest.json").exists():
            write_small(folder / "manifest.json", {"schema_version": MANIFEST, "run_id": id_, "status": "running", "stages": {}, "config": reference(folder / "config.resolved.json", root, "config")})
        return cls(id_, folder, root, config.digest())

    def record(self, stage: str, command: list[str], seed: int, inputs: list[dict], outputs: list[dict], error: Exception | None = None, **details) -> dict:
        """Write a stage's manifest and enter it in the run's."""
        manifest = {"schema_version": MANIFEST, "run_id": self.id, "stage": stage, "created_at": datetime.now(UTC).isoformat(), "git_commit": git_commit(), "config_sha256": self.config_sha256, "command": command, "seed": seed, "inputs": inputs, "outputs": outputs, "status": "failed" if error else "succeeded"}
        if error:
            manifest |= {"error_code": error.code if isinstance(error, EngineError) else "TF000", "error_message": redacted(str(error))}
        write_small(self.folder / f"manifest.{stage}.json", manifest | ({"details": details} if details else {}))
        whole = read_json(self.folder / "manifest.json", MANIFEST)
        whole["stages"][stage] = f"manifest.{stage}.json"
        whole["status"] = "failed" if error else whole["status"]
        write_small(self.folder / "manifest.json", whole)
        return manifest

    def timed(self, stage: str, seconds: float, gpu: str, peak_mb: int | None = None) -> dict:
        """Enter a stage's seconds in the run's metadata; a cost that nobody observed stays unavailable."""
        path = self.folder / "runtime_metadata.json"
        data = read_json(path, RUNTIME) if path.exists() else {"schema_version": RUNTIME, "run_id": self.id, "config_sha256": self.config_sha256, "stages": {}, "hardware": {"gpu": gpu, "source": "config"}, "peak_gpu_memory_mb": None, "observed_cost_usd": None, "cost_source": "unavailable"}
        data["stages"][stage] = {"elapsed_seconds": round(seconds, 3)}
        if peak_mb is not None:
            data["peak_gpu_memory_mb"] = peak_mb
        write_small(path, data)
        return data

    def runtime(self) -> dict:
        path = self.folder / "runtime_metadata.json"
        return {"available": True, **read_json(path, RUNTIME)} if path.exists() else {"available": False}


def run_of(path: str | Path) -> str | None:
    """The run's id in a path, if it has one."""
    found = re.search(r"/runs/([^/]+)/", Path(path).as_posix())
    return found[1] if found else None


def git_commit(folder: str | Path = ".") -> str:
    try:
        return subprocess.run(["git", "rev-parse", "HEAD"], cwd=folder, check=True, capture_output=True, text=True).stdout.strip()
    except (OSError, subprocess.CalledProcessError):
        return "unknown"


def tracked(stage: str, records: list[dict], tracker: Callable | None) -> int:
    """Send the numbers of records (not the truth values) to a tracker's log(values, step); none: nothing happens."""
    sent = 0
    for i, record in enumerate(records if tracker else []):
        values = {f"{stage}/{k}": v for k, v in record.items() if isinstance(v, int | float) and not isinstance(v, bool)}
        if values:
            tracker(values, record["step"] if isinstance(record.get("step"), int) else i)
            sent += 1
    return sent


# Trees of files.


def listed(folder: str | Path) -> list[dict]:
    """path, bytes and sha256 of every file below a folder, sorted by path; links are refused."""
    folder, out = Path(folder), []
    for path in sorted(folder.rglob("*"), key=lambda p: p.relative_to(folder).as_posix()):
        if path.is_symlink():
            raise InputError(f"{path} is a link")
        if path.is_file():
            data = path.read_bytes()
            out.append({"path": path.relative_to(folder).as_posix(), "bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()})
    return out


def tree_digest(folder: str | Path) -> str:
    """sha256 over each file's path, led by its length, and bytes, in the order of paths."""
    folder, digest = Path(folder), hashlib.sha256()
    for entry in listed(folder):
        name = entry["path"].encode()
        digest.update(len(name).to_bytes(8, "big") + name + entry["bytes"].to_bytes(8, "big"))
        digest.update((folder / entry["path"]).read_bytes())
    return digest.hexdigest()


def tree_manifest(folder: str | Path) -> dict:
    """Files, bytes and the digest of the canonical list of files."""
    files = listed(folder)
    text = json.dumps(files, sort_keys=True, separators=(",", ":"))
    return {"files": files, "file_count": len(files), "total_bytes": sum(f["bytes"] for f in files), "sha256": hashlib.sha256(text.encode()).hexdigest()}


def write_outputs(rows, folder: str | Path, language: str, summary: dict, order: str = "ordinal") -> dict:
    """A translation's rows as one file, its summary, and the publication's list of both."""
    from tallyforge.sources.records import write_one

    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    name = f"rows.{language}.jsonl"
    digest = write_one(rows, folder / name, order)
    write_small(folder / "summary.json", summary | {"rows_sha256": digest})
    manifest = {"files": [reference(folder / n, folder, k) for n, k in ((name, "paired_rows"), ("summary.json", "summary"))]}
    write_small(folder / "publication.json", manifest)
    return manifest
