"""Strictly typed configuration, manifests, checksums and size estimates; driver-side."""

from __future__ import annotations

import dataclasses
import hashlib
import json
import os
from pathlib import Path
from typing import Any, get_type_hints

from plyforge.functions.identity import identity_of
from plyforge.sources.sinks import safe_name

#: What an estimate adds for what it doesn't know.
MARGIN = 1.30


class ConfigError(ValueError):
    pass


def read_document(path: str) -> dict[str, Any]:
    """A YAML or JSON mapping."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        import yaml

        value = yaml.safe_load(text)
    else:
        value = json.loads(text)
    if not isinstance(value, dict):
        raise ConfigError(f"{path} holds no mapping")
    return value


def typed(cls: type, values: dict[str, Any], where: str = ""):
    """``cls`` (a dataclass) from ``values``: unknown and missing keys and other types are errors; a
    boolean is no number; names that end in ``_path`` must be safe."""
    hints, names = get_type_hints(cls), {f.name: f for f in dataclasses.fields(cls)}
    if unknown := sorted(set(values) - set(names)):
        raise ConfigError(f"unknown keys {unknown} {where}".rstrip())
    out = {}
    for name, field in names.items():
        if name not in values:
            if field.default is dataclasses.MISSING and field.default_factory is dataclasses.MISSING:
                raise ConfigError(f"missing key {where}{name}")
            continue
        kind, value = hints[name], values[name]
        if dataclasses.is_dataclass(kind) and isinstance(value, dict):
            value = typed(kind, value, f"{where}{name}.")
        elif kind in (int, float, str, bool) and (type(value) is not kind and not (kind is float and type(value) is int)):
            raise ConfigError(f"{where}{name} must be {kind.__name__}")
        if name.endswith("_path"):
            try:
                safe_name(value)
            except ValueError as e:
                raise ConfigError(str(e)) from e
        out[name] = value
    return cls(**out)


def configuration_hash(config: Any) -> str:
    return identity_of(dataclasses.asdict(config))


def file_sha256(path: str, chunk: int = 1 << 20) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(chunk):
            digest.update(block)
    return digest.hexdigest()


def resolved_root(argument: str | None, variable: str, derived: list[str]) -> str:
    """An argument wins over the environment, that over the one directory that exists; several are an error."""
    if argument:
        return argument
    if value := os.environ.get(variable):
        return value
    found = [p for p in derived if os.path.isdir(p)]
    if len(found) != 1:
        raise ConfigError(f"{len(found)} directories fit; name one")
    return found[0]


def estimated_bytes(sample_bytes: int, sample_games: int, games: int, margin: float = MARGIN) -> int:
    """Size of ``games`` at the sample's bytes a game, with a margin, rounded up."""
    if sample_games <= 0:
        raise ValueError("the sample must have games")
    return -(-int(sample_bytes * games * margin) // sample_games)


def transformation_identity(files: dict[str, str]) -> str:
    """One hash for the texts of a transformation, by relative name."""
    return identity_of({safe_name(k): hashlib.sha256(v.encode()).hexdigest() for k, v in files.items()})


def provenance_problems(kind: str, counts: dict[str, int], parent: dict[str, int]) -> list[str]:
    """A full warehouse has its parent's counts, a sample doesn't exceed them."""
    if kind not in ("full", "sample"):
        return [f"unknown kind {kind}"]
    out = [f"{t} is not in the parent" for t in counts if t not in parent]
    for t in counts.keys() & parent.keys():
        if kind == "full" and counts[t] != parent[t]:
            out.append(f"{t} has {counts[t]} rows, its parent {parent[t]}")
        if kind == "sample" and counts[t] > parent[t]:
            out.append(f"sample {t} has more rows than its parent")
    return out
