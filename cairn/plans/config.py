"""Configuration of a batch run: defaults, then a mapping, a file, text and arguments, each over the one before."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields, is_dataclass
from typing import Any

import yaml

from cairn import schemas
from cairn.operators.annotate import QualityCriteria
from cairn.operators.split import SplitRules


def listed(value: Any) -> list[str]:
    """Items of a list, or of text with commas; empty items are none."""
    return [v for v in (value.split(",") if isinstance(value, str) else map(str, value)) if v]


@dataclass
class FlowConfig:
    """Which stages run, on how much at a time, and for which metrics and thresholds. Default values are fixed by the published procedure."""

    run_specific_stages: Any = ""
    skip_specific_stages: Any = ""
    make_entries_batch_size: int = 220
    make_ligands_batch_size: int = 100
    run_batch_searches_batch_size: int = 10_050
    make_batch_scores_batch_size: int = 90
    score_linked_structures_batch_size: int = 100
    force_update: bool = False
    cluster_metrics: list[str] = field(default_factory=lambda: list(schemas.METRICS))
    cluster_thresholds: list[int] = field(default_factory=lambda: list(schemas.THRESHOLDS))
    sub_databases: Any = "apo,pred"

    def __post_init__(self) -> None:
        self.run_specific_stages = listed(self.run_specific_stages)
        self.skip_specific_stages = listed(self.skip_specific_stages)
        self.sub_databases = listed(self.sub_databases)
        if unknown := [m for m in self.cluster_metrics if m not in (*schemas.METRICS, "tanimoto_similarity_max")]:
            raise ValueError(f"unknown metrics {unknown}")


@dataclass
class ScatterConfig:
    """What a run is kept to: entries by two-character code or by id."""

    two_char_codes: Any = ""
    pdb_ids: Any = ""

    def __post_init__(self) -> None:
        self.two_char_codes, self.pdb_ids = listed(self.two_char_codes), listed(self.pdb_ids)


@dataclass
class LinkConfig:
    """Criteria of links to other structures, all of which must hold, and how many are kept by system. Fixed by the published procedure."""

    num_per_system: int = 5
    filter_criteria: dict[str, int] = field(
        default_factory=lambda: {
            "pocket_fident": 95,
            "protein_fident_weighted_sum": 95,
            "protein_fident_qcov_weighted_sum": 80,
            "pocket_lddt": 20,
            "protein_lddt_weighted_sum": 20,
        }
    )


SECTIONS: dict[str, type] = {"flow": FlowConfig, "scatter": ScatterConfig, "quality": QualityCriteria, "links": LinkConfig, "split": SplitRules}


def arguments(args: Sequence[str]) -> dict[str, Any]:
    """Arguments ``section.name=value`` as a nested mapping; values are read as YAML, codes stay text."""
    found: dict[str, Any] = {}
    for arg in args:
        path, _, value = arg.partition("=")
        section, dot, name = path.partition(".")
        if not dot or not _:
            raise ValueError(f"an argument is section.name=value, not {arg!r}")
        found.setdefault(section, {})[name] = value if section == "scatter" else yaml.safe_load(value)
    return found


def _over(below: dict[str, Any], above: Mapping[str, Any] | None) -> dict[str, Any]:
    for key, value in (above or {}).items():
        below[key] = _over(dict(below[key]), value) if isinstance(value, Mapping) and isinstance(below.get(key), Mapping) else value
    return below


def load(config: Mapping[str, Any] | None = None, *, file: str | None = None, contents: str | None = None, args: Sequence[str] = ()) -> dict[str, Any]:
    """Sections by name, as dataclasses that check themselves. An unknown section or name is a ValueError."""
    merged: dict[str, Any] = {}
    _over(merged, config)
    if file is not None:
        with open(file, encoding="utf-8") as text:
            _over(merged, yaml.safe_load(text))
    if contents is not None:
        _over(merged, yaml.safe_load(contents))
    _over(merged, arguments(args))
    if unknown := sorted(set(merged) - set(SECTIONS)):
        raise ValueError(f"unknown sections {unknown}; use some of {sorted(SECTIONS)}")
    found = {}
    for name, kind in SECTIONS.items():
        values = dict(merged.get(name) or {})
        if unknown := sorted(set(values) - {f.name for f in fields(kind)}):
            raise ValueError(f"unknown settings {unknown} of {name}")
        found[name] = kind.of(values) if hasattr(kind, "of") else kind(**values)
    return found


def plain(config: Any) -> Any:
    """A configuration as mappings and lists, for hashing and writing."""
    if is_dataclass(config):
        return {f.name: plain(getattr(config, f.name)) for f in fields(config)}
    if isinstance(config, Mapping):
        return {k: plain(v) for k, v in config.items()}
    return [plain(v) for v in config] if isinstance(config, (list, tuple)) else config
