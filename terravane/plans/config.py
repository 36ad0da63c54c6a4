"""Settings from a YAML file, and secrets from the environment or a .env file."""

from __future__ import annotations

import os
from collections.abc import Mapping
from pathlib import Path

from ..operators.discover import KeepRules
from ..operators.score import Pillar


def load_config(path: str) -> dict:
    import yaml

    return yaml.safe_load(Path(path).read_text("utf-8"))


def load_env(path: str = ".env") -> None:
    """KEY=value lines; quotes and comments are dropped, what is set already stays."""
    p = Path(path)
    for line in p.read_text("utf-8").splitlines() if p.exists() else ():
        line = line.strip()
        if line and not line.startswith("#") and "=" in line:
            k, v = line.split("=", 1)
            v = v.strip()
            v = v[1:-1] if len(v) > 1 and v[0] == v[-1] and v[0] in "'\"" else v.split(" #")[0].strip()
            os.environ.setdefault(k.strip(), v)


def pillars_of(cfg: Mapping) -> dict[str, Pillar]:
    return {k: Pillar(p.get("measures") or {}, p.get("weight") or 0, p.get("label", ""), p.get("tag", "")) for k, p in cfg["scoring"]["pillars"].items()}


def rules_of(cfg: Mapping) -> KeepRules:
    d = cfg["discover"]
    return KeepRules(tuple(d.get("never_market_types") or ()), d.get("market_name_prefix") or "", d.get("suspect_name") or "", d.get("market_name_words") or "", tuple(d.get("market_types") or ()), d.get("suspect_primary_type") or "")


def point_features(surroundings: Mapping) -> dict[str, list[str]]:
    """Features counted as map points: the extra ones, and all where the map is the main source."""
    return dict(surroundings.get("osm_filters") or {} if surroundings.get("source") == "osm" else {}) | dict(surroundings.get("osm_extra") or {})
