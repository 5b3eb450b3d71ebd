"""Small configuration documents: license profiles, model registries, country settings. Read on the driver; they are dimensions of a few rows."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path


def load(path: str) -> dict:
    """A JSON document, or YAML where its parser is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        import yaml

        return yaml.safe_load(text) or {}
    return json.loads(text)


def registry(folder: str) -> dict[str, dict]:
    """Model entries of a folder by id; an id that occurs twice is an error."""
    out: dict[str, dict] = {}
    for p in sorted(Path(folder).iterdir()):
        if p.suffix not in (".json", ".yaml", ".yml"):
            continue
        found = load(str(p))
        for entry in found.get("models", [found]):
            if entry["id"] in out:
                raise ValueError(f"model id {entry['id']!r} occurs twice")
            out[entry["id"]] = entry
    return out


def resolve(entry: dict, env: dict[str, str] | None = None) -> dict:
    """An entry with ``${NAME}`` replaced from the environment; an unset name is an error. The key itself stays in the environment."""
    env = dict(os.environ) if env is None else env

    def one(value):
        if isinstance(value, str):
            return re.sub(r"\$\{(\w+)\}", lambda m: env[m[1]] if m[1] in env else _unset(m[1]), value)
        return {k: one(v) for k, v in value.items()} if isinstance(value, dict) else value

    return one(entry)


def _unset(name: str):
    raise KeyError(f"environment variable {name} isn't set")


def describe(entry: dict) -> dict:
    """An entry without anything that may be secret."""
    return {k: v for k, v in entry.items() if not re.search("key|secret|token$|password", k, re.I)}


def canonical_json(value) -> str:
    """Sorted keys, ASCII escapes and a space after separators: the form that digests of task rows are taken over."""
    return json.dumps(value, sort_keys=True)
