"""Stages of a batch run: which of them run, in what order, and what each is given."""

from __future__ import annotations

import functools
import hashlib
import json
import logging
import time
from collections.abc import Callable, Iterable, Sequence
from typing import Any

LOG = logging.getLogger("cairn")


def selected(stage: str, run: Sequence[str] = (), skip: Sequence[str] = ()) -> bool:
    """Whether a stage runs: if any are listed to run, those alone; else all but the skipped."""
    return stage in run if run else stage not in skip


def timed(function: Callable) -> Callable:
    """Log how long a call took; what it raises is raised on."""

    @functools.wraps(function)
    def call(*args, **kwargs):
        began = time.monotonic()
        try:
            return function(*args, **kwargs)
        finally:
            LOG.info("%s took %.2f s", function.__name__, time.monotonic() - began)

    return call


def run_stages(stages: Sequence[tuple[str, Callable[[Any], Any]]], value: Any, *, run: Sequence[str] = (), skip: Sequence[str] = ()) -> Any:
    """Hand ``value`` from stage to stage; a stage that isn't selected hands on what it got."""
    for name, stage in stages:
        if selected(name, run, skip):
            value = timed(stage)(value)
    return value


def batches(items: Iterable, *, size: int | None = None, number: int | None = None) -> list[list]:
    """Items in order, in batches of a size or in a number of batches."""
    items = list(items)
    if (size is None) == (number is None):
        raise ValueError("give a size or a number of batches")
    size = size or max(1, -(-len(items) // number))
    return [items[at : at + size] for at in range(0, len(items), size)]


def fingerprint(config: Any) -> str:
    """md5 of a configuration, whatever the order of its keys and lists."""

    def ordered(x: Any) -> Any:
        if isinstance(x, dict):
            return {k: ordered(x[k]) for k in sorted(x)}
        if isinstance(x, (list, tuple, set)):
            return sorted((ordered(v) for v in x), key=lambda v: json.dumps(v, sort_keys=True, default=str))
        return x

    return hashlib.md5(json.dumps(ordered(config), sort_keys=True, default=str).encode()).hexdigest()


#: The stages of a whole run, in order. Fixed names.
STAGES = (
    "download_rcsb_files",
    "download_alternative_datasets",
    "make_dbs",
    "make_entries",
    "structure_qc",
    "make_system_archives",
    "make_ligands",
    "compute_ligand_fingerprints",
    "make_ligand_scores",
    "make_sub_dbs",
    "run_batch_searches",
    "make_batch_scores",
    "collate_partitions",
    "make_mmp_index",
    "make_components_and_communities",
    "make_splits",
    "compute_ligand_leakage",
    "compute_protein_leakage",
    "make_links",
    "make_linked_structures",
    "score_linked_structures",
)
#: Pairs of sets that leakage is worked out for, and the metrics of proteins and ligands. Fixed names.
PAIRS = ("train_test", "train_val", "val_test", "train_posebusters")
LEAKAGE_METRICS = {
    "ligand": ("tanimoto_similarity_max",),
    "protein": (
        "pli_qcov",
        "pocket_qcov",
        "pocket_lddt",
        "protein_seqsim_weighted_sum",
        "protein_fident_weighted_sum",
        "protein_lddt_weighted_sum",
        "protein_lddt_qcov_weighted_sum",
    ),
}


def controlled(stage: Callable, *, run: Sequence[str] = (), skip: Sequence[str] = ()) -> Callable:
    """A stage that gives ``[[]]`` where it isn't selected. Parts named ``scatter_`` and ``join_`` go by the stage's name."""
    name = stage.__name__.removeprefix("scatter_").removeprefix("join_")

    @functools.wraps(stage)
    def call(*args, **kwargs):
        if not selected(name, run, skip):
            LOG.info("%s is skipped", name)
            return [[]]
        found = stage(*args, **kwargs)
        if isinstance(found, list):
            LOG.info("%s has %d chunks", stage.__name__, len(found))
        return found

    return call


def scattered(stage: Callable[[Any], Any], chunks: Sequence[Any], join: Callable[[list], Any] | None = None) -> Any:
    """A stage over its chunks, one after the other, and what ``join`` makes of the results; empty chunks are passed over."""
    found = [timed(stage)(chunk) for chunk in chunks if not (isinstance(chunk, (list, tuple)) and not chunk)]
    return join(found) if join else found


def scatter_entries(ids: Iterable[str], done: Iterable[str], *, size: int, force: bool = False) -> list[list[str]]:
    """Entry ids in order, in batches, without those that are done unless forced."""
    skip = set() if force else set(done)
    return batches(sorted(i for i in set(ids) if i not in skip), size=size)


def scatter_clusters(metrics: Sequence[str], thresholds: Sequence[int], done: Iterable[tuple[str, int]] = (), *, force: bool = True, most: int = 0) -> list[list[tuple[str, int]]]:
    """Metric and threshold, one of each to a chunk; ``most`` keeps to the first."""
    skip = set() if force else set(done)
    found = [[(m, t)] for m in metrics for t in thresholds if (m, t) not in skip]
    return found[:most] if most else found


def scatter_partitions() -> list[list[str]]:
    """The last characters of entry ids, and the kinds of targets that are one partition each."""
    return [[c] for c in "0123456789abcdefghijklmnopqrstuvwxyz"] + [["apo"], ["pred"]]


def scatter_splits(contents: dict[str, str]) -> list[list[tuple[Any, str]]]:
    """Split rules, read of YAML texts by path, one to a chunk; none give one empty chunk."""
    import yaml

    from cairn.operators.split import SplitRules

    return [[(SplitRules.of((yaml.safe_load(text) or {}).get("split", {})), path)] for path, text in sorted(contents.items())] or [[]]


def scatter_leakage(paths: Iterable[str], kind: str, *, only_first: bool = False) -> list[list[tuple[str, str, str]]]:
    """Split file, pair of sets and metric, one of each to a chunk; ``kind`` is ligand or protein."""
    found = [[(p, pair, m)] for p in sorted(paths) for pair in PAIRS for m in LEAKAGE_METRICS[kind]]
    return found[:1] if only_first else found


def retried(function: Callable, *, tries: int = 5, wait: Callable[[float], Any] = time.sleep) -> Callable:
    """Call again where it raises, up to ``tries`` times, after 1, 2, 4 … seconds; the last error is raised on."""

    @functools.wraps(function)
    def call(*args, **kwargs):
        for attempt in range(tries):
            try:
                return function(*args, **kwargs)
            except Exception:
                if attempt == tries - 1:
                    raise
                wait(2.0**attempt)

    return call
