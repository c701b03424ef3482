"""Settings from a YAML file on the driver: templates are filled in, lists and defaults brought into one form."""

from __future__ import annotations

import os
import re
from pathlib import Path

DATA_DIR = "data"
_TEMPLATE = re.compile(r"\{(\w+)\}")


def filled(value: object, names: dict[str, str]) -> object:
    """value with {name} in its texts replaced, by the names given or else the environment; a text with an unknown name stays as it is."""
    if isinstance(value, dict):
        return {k: filled(v, names) for k, v in value.items()}
    if isinstance(value, list):
        return [filled(v, names) for v in value]
    if not isinstance(value, str):
        return value

    known = {n: names.get(n, os.environ.get(n)) for n in _TEMPLATE.findall(value)}
    return value if None in known.values() else _TEMPLATE.sub(lambda m: str(known[m[1]]), value)


def load(path: str | Path, **names: str) -> dict:
    """The settings of a file: templates filled in (its own top-level texts are names too), attributes given as a mapping made a list, data_dir set."""
    import yaml

    raw = yaml.safe_load(Path(path).read_text()) or {}
    if not isinstance(raw, dict):
        raise ValueError("settings must be a mapping")
    plain = {k: v for k, v in raw.items() if isinstance(v, str) and not _TEMPLATE.search(v)}
    out = filled(raw, plain | names)
    if isinstance(out.get("attributes"), dict):
        out["attributes"] = [{"name": k, **(v or {})} for k, v in out["attributes"].items()]
    out.setdefault("data_dir", DATA_DIR)
    return out
