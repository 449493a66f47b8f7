"""Runs and what they leave: checked tables, manifests, checksums, memoised derivations, summaries."""

from __future__ import annotations

import contextlib
import hashlib
import json
import math
import os
import time
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame

from terrace.sources.tables import require


def write_table(df: DataFrame, folder: str, name: str, required: list[str], order: list[str] | None = None) -> str:
    """Write a checked table; an existing one is never replaced. Returns its path."""
    path = f"{folder}/{name}.parquet"
    require(df, required)
    (df.sortWithinPartitions(*order) if order else df).write.mode("errorifexists").parquet(path)
    return path


def write_csv(df: DataFrame, folder: str, name: str) -> str:
    path = f"{folder}/{name}.csv"
    df.write.mode("errorifexists").option("header", True).option("quoteAll", True).csv(path)
    return path


def plain(value):
    """JSON for any result: numbers that are not finite become null, keys become strings."""
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [plain(v) for v in (sorted(value, key=str) if isinstance(value, set) else value)]
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return value if isinstance(value, (int, float, str, bool, type(None))) else str(value)


def canonical(value) -> str:
    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def digest(value) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def hash_file(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _replace(path: Path, text: str) -> None:
    part = path.with_name(path.name + ".part")
    part.write_text(text, encoding="utf-8")
    os.replace(part, path)


@dataclass
class RunManifest:
    """One run's record, replaced as a whole with every change; a run id is never used twice."""

    folder: Path
    run_id: str
    kind: str
    status: str = "in_progress"
    entries: list[dict] = field(default_factory=list)
    stages: list[dict] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.folder = Path(self.folder) / self.run_id
        self.folder.mkdir(parents=True, exist_ok=False)
        self._write()

    def _write(self) -> None:
        _replace(self.folder / "manifest.json", json.dumps(plain(asdict(self) | {"folder": str(self.folder)}), indent=1))

    def add(self, **entry) -> None:
        if self.status != "in_progress":
            raise ValueError(f"run {self.run_id} is {self.status}")
        self.entries.append(entry)
        self._write()

    def finish(self, status: str = "complete") -> None:
        self.status = status
        self._write()

    @contextlib.contextmanager
    def stage(self, name: str) -> Iterator[dict]:
        """Times a stage; a failure is recorded and raised again."""
        record = {"stage": name, "status": "ok"}
        began = time.monotonic()
        try:
            yield record
        except Exception as e:
            record |= {"status": "failed", "error": f"{type(e).__name__}: {e}"}
            self.status = "failed"
            raise
        finally:
            record["seconds"] = round(time.monotonic() - began, 3)
            self.stages.append(record)
            self._write()


def write_checksums(folder: Path) -> None:
    files = sorted(p for p in Path(folder).rglob("*") if p.is_file() and p.name != "SHA256SUMS")
    _replace(Path(folder) / "SHA256SUMS", "".join(f"{hash_file(p)}  {p.relative_to(folder)}\n" for p in files))


def tampered(folder: Path) -> list[str]:
    """Files that are missing or differ from the folder's checksums."""
    lines = [x.split("  ", 1) for x in (Path(folder) / "SHA256SUMS").read_text().splitlines()]
    return [name for want, name in lines if not (p := Path(folder) / name).is_file() or hash_file(p) != want]


def latest_run(folder: Path, kind: str) -> Path | None:
    """The newest complete run of a kind whose checksums hold."""
    for path in sorted(Path(folder).glob("*/manifest.json"), reverse=True):
        record = json.loads(path.read_text())
        if record["kind"] == kind and record["status"] == "complete" and (path.parent / "SHA256SUMS").exists() and not tampered(path.parent):
            return path.parent
    return None


def derive_or_reuse(out: Path, parent: str, parameters: dict, produce: Callable[[Path], None], validate: Callable[[Path], None]) -> bool:
    """Make a file from its parent unless it is there already from the same parent and parameters, unchanged. True if made."""
    out = Path(out)
    side = out.with_name(out.name + ".json")
    wanted = {"parent": parent, "parameters": plain(parameters)}
    if out.exists() and side.exists():
        held = json.loads(side.read_text())
        if {k: held.get(k) for k in wanted} == wanted and held.get("sha256") == hash_file(out):
            validate(out)
            return False
    part = out.with_name(out.name + ".part")
    produce(part)
    validate(part)
    os.replace(part, out)
    _replace(side, canonical(wanted | {"sha256": hash_file(out)}))
    return True


def markdown(df: DataFrame, limit: int = 200) -> str:
    """A short table as text for reports; one of more rows than ``limit`` is refused, not cut."""
    shown = lambda v: "" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v)
    rows = [[shown(v) for v in r] for r in df.limit(limit + 1).collect()]
    if len(rows) > limit:
        raise ValueError(f"over {limit} rows: summarise the table first")
    return "\n".join("| " + " | ".join(r) + " |" for r in [df.columns, ["---"] * len(df.columns), *rows])
