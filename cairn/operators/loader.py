"""Batches of structures as padded arrays: featurizers, transforms and collation over any user-given functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAD = -100


def padded(array: np.ndarray, size: int | Sequence[int], dims: Sequence[int], value: float = 0) -> np.ndarray:
    """An array padded on the right of ``dims`` to ``size``, one for all of them or one each."""
    sizes = [size] * len(dims) if isinstance(size, int) else list(size)
    if len(sizes) != len(dims):
        raise ValueError(f"{len(sizes)} sizes for {len(dims)} dimensions")
    width = [(0, 0)] * array.ndim
    for dim, to in zip(dims, sizes):
        width[dim] = (0, max(0, to - array.shape[dim]))
    return np.pad(array, width, constant_values=value)


def pad_and_stack(arrays: Sequence[np.ndarray], *, dim: int = 0, dims: Sequence[int] | None = None, value: float = PAD) -> np.ndarray:
    """Arrays of as many dimensions, padded to the largest size of each (or of ``dims``) and stacked along a new dimension."""
    if len({a.ndim for a in arrays}) != 1:
        raise ValueError("arrays have different numbers of dimensions")
    dims = list(range(arrays[0].ndim)) if dims is None else list(dims)
    largest = np.array([a.shape for a in arrays]).max(axis=0) if arrays[0].ndim else np.array([])
    return np.stack([padded(a, [int(largest[d]) for d in dims], dims, value) for a in arrays], axis=dim)


def collated(rows: Sequence[dict[str, np.ndarray]], *, value: float = PAD) -> dict[str, np.ndarray]:
    """Features of several items as one array each."""
    return {name: pad_and_stack([np.asarray(r[name]) for r in rows], value=value) for name in rows[0]}


def transformed(atoms: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """An atom table after each step in turn."""
    for step in steps:
        atoms = atoms.transform(step)
    return atoms


def select_atoms(kinds: Sequence[str] = ("CA",), *, column: str = "atom", negate: bool = False) -> Callable[[DataFrame], DataFrame]:
    """A step that keeps atoms whose column is (not) among ``kinds``."""

    def step(atoms: DataFrame) -> DataFrame:
        held = F.col(column).isin(list(kinds))
        return atoms.where(~held if negate else held)

    return step


def default_features(elements: Sequence[str] = ("C", "N", "O", "P", "S", "other")) -> Callable[[dict[str, Any]], dict[str, list]]:
    """A featurizer of a system given as lists by atom: coordinates, CA coordinates, one-hot elements and a mask of resolved atoms."""

    def features(item: dict[str, Any]) -> dict[str, list]:
        xyz = [list(p) for p in zip(item["x"], item["y"], item["z"])]
        hot = [[int(e == k) for k in elements] for e in (e if e in elements else "other" for e in item["element"])]
        return {
            "coordinates": xyz,
            "calpha_coordinates": [p for p, a in zip(xyz, item["atom"]) if a == "CA"],
            "elements": hot,
            "atom_mask": [[1] if p[0] is not None else [0] for p in xyz],
        }

    return features


def featurized(atoms: DataFrame, featurizer: Callable[[dict[str, Any]], dict[str, list]], names: Sequence[str], *, by: str = "system_id", order: str = "serial") -> DataFrame:
    """Features of each system as arrays of arrays: ``by`` and ``names``. A system's atoms come in order, as lists by column.

    ``featurizer`` is any function of such a mapping; it runs in Arrow batches, one system at a time.
    """
    rest = [c for c in atoms.columns if c not in (by, order)]
    rows = F.array_sort(F.collect_list(F.struct(order, *rest)))
    lists = atoms.groupBy(by).agg(rows.alias("rows")).select(by, *[F.col("rows")[c].alias(c) for c in rest])

    def run(batches):
        import pandas as pd

        for batch in batches:
            found = [featurizer(row) for row in batch.to_dict("records")]
            yield pd.DataFrame({by: batch[by], **{n: [[[float(v) for v in p] for p in f[n]] for f in found] for n in names}})

    kind = atoms.schema[by].dataType.simpleString()
    return lists.mapInPandas(run, f"`{by}` {kind}, " + ", ".join(f"`{n}` array<array<double>>" for n in names))


def batches(features: DataFrame, *, size: int = 2, by: str = "system_id", shuffle: int | None = None, value: float = PAD, collate: Callable = collated) -> Iterator[tuple[list, dict[str, np.ndarray]]]:
    """Batches for training: ids and collated arrays. Rows come one partition at a time; ``shuffle`` is a seed of their order."""
    rows = features.orderBy(F.xxhash64(F.lit(shuffle), by) if shuffle is not None else by)
    names = [c for c in features.columns if c != by]
    held: list = []
    for row in rows.toLocalIterator():
        held.append(row)
        if len(held) == size:
            yield [r[by] for r in held], collate([{n: np.array(r[n], float) for n in names} for r in held], value=value)
            held = []
    if held:
        yield [r[by] for r in held], collate([{n: np.array(r[n], float) for n in names} for r in held], value=value)
