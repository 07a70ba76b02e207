"""Configuration: defaults, files that change them, and thresholds by tier."""

from __future__ import annotations

import os
from typing import Any

DEFAULTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "defaults.yml")


def _merged(base: dict[str, Any], over: dict[str, Any]) -> dict[str, Any]:
    out = dict(base)
    for key, value in over.items():
        if key not in base and base:
            raise KeyError(f"unknown setting {key}")
        nested = isinstance(value, dict) and isinstance(base.get(key), dict) and key != "thresholds"
        out[key] = _merged(base[key], value) if nested else {**base[key], **value} if key == "thresholds" else value
    return out


def load(path: str | None = None) -> dict[str, Any]:
    """The defaults, changed by the YAML file at ``path`` if one is given."""
    import yaml

    with open(DEFAULTS, encoding="utf-8") as file:
        config = yaml.safe_load(file)
    if path:
        with open(path, encoding="utf-8") as file:
            config = _merged(config, yaml.safe_load(file) or {})
    return config


def thresholds(config: dict[str, Any], tier: str) -> tuple[float, float]:
    """``(upper, lower)`` of a tier; ``lower`` may not be above ``upper``."""
    if tier not in config["thresholds"]:
        raise KeyError(f"no thresholds for tier {tier}: {sorted(config['thresholds'])}")
    both = config["thresholds"][tier]
    if both["lower"] > both["upper"]:
        raise ValueError(f"lower threshold of tier {tier} is above the upper one")
    return float(both["upper"]), float(both["lower"])


def save_params(path: str, rows: list[dict[str, Any]], tier: str, sample: int, seed: int) -> None:
    """Weights by field and level as YAML, with what they were estimated from."""
    import yaml

    table: dict[str, dict[str, dict[str, float]]] = {}
    for r in rows:
        table.setdefault(r["field"], {})[r["level"]] = {"m": r["m"], "u": r["u"], "weight": r["weight"]}
    with open(path, "w", encoding="utf-8") as file:
        yaml.safe_dump({"tier": tier, "non_match_sample": sample, "seed": seed, "fields": table}, file)


def load_params(path: str) -> dict[str, dict[str, float]]:
    """Weights by field and level, as ``matching.score_pairs`` takes them."""
    import yaml

    with open(path, encoding="utf-8") as file:
        fields = yaml.safe_load(file)["fields"]
    return {f: {level: float(x["weight"]) for level, x in levels.items()} for f, levels in fields.items()}
