"""Configuration files as the library's own settings. Keys that nothing reads are ignored."""

from __future__ import annotations

from ..operators.clean import CleanConfig
from ..plans.stages import RunConfig


def load(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def merged(base: dict, group: dict) -> dict:
    """base with group's keys, key by key in nested mappings; the group wins."""
    out = dict(base)
    for k, v in group.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def clean_config(spec: dict) -> CleanConfig:
    """general, html, unicode, dedup and refusal_filter of a cleaner file; groups and drops that are switched off are left out."""
    general, refusal = spec.get("general", {}), spec.get("refusal_filter", {})
    on = refusal.get("enabled", True)
    groups = {n: (float(g.get("weight", 1.0)), tuple(g.get("patterns", ()))) for n, g in refusal.get("pattern_groups", {}).items() if on and g.get("enabled", True)}
    drops = refusal.get("instant_drop_patterns", {})
    return CleanConfig(
        action=general.get("action", "drop"), threshold=float(general.get("score_threshold", 0.12)), min_length=int(general.get("min_doc_length", 80)), max_length=int(general.get("max_doc_length", 2_000_000)),
        html=spec.get("html", {}).get("enabled", True), nfkc=spec.get("unicode", {}).get("enabled", True), dedup=spec.get("dedup", {}).get("enabled", True),
        groups=groups, instant=tuple(drops.get("patterns", ())) if on and drops.get("enabled", True) else (),
    )


def domain_rules(spec: dict) -> tuple[tuple[str, float, str], ...]:
    return tuple((r["pattern"], float(r["weight"]), r.get("category", "")) for r in spec.get("domain_weights", ()))


def run_config(spec: dict, cleaner: dict | None = None) -> RunConfig:
    """The settings of a run from a pipeline file and a cleaner file."""
    dedup, weight, shard = spec.get("embed_dedup", {}), spec.get("weight", {}), spec.get("shard", {})
    return RunConfig(
        clean=clean_config(cleaner or {}), dedup_threshold=float(dedup.get("similarity_threshold", dedup.get("threshold", 0.92))), strategy=weight.get("strategy", "upsample"),
        val_fraction=float(shard.get("val_fraction", 0.005)), shard_size=int(shard.get("shard_size", 10_000_000)), seq_len=int(shard.get("sequence_length", 1024)), seed=int(shard.get("seed", 42)),
    )


def select_group(groups: list[dict], group_id: str) -> dict:
    """The group with this id; an unknown one is an error."""
    for g in groups:
        if g["id"] == group_id:
            return g
    raise KeyError(f"unknown dataset group {group_id!r}")
