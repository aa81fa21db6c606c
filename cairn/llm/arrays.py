"""Counted keys as sorted hash arrays in files of the shared folder, memory-mapped by the workers that look them up.

Tasks send sorted, compressed runs of (key, count), one per shard; one task merges the runs of a shard and writes its
two arrays. A file appears under its name only when it is whole, and a task that runs again writes the same bytes, so
lost executors cost repeated work and nothing else.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterable, Iterator
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

#: Keys in one row of a run.
RUN = 16_384
#: Keys that a merging task gathers before it folds them together.
FOLD = 2_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit keys, so that shards are even."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _squeeze(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes(), 1)


def _restore(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys ascending and distinct, with the sums of their counts."""
    by = np.argsort(keys, kind="stable")
    keys, counts = keys[by], counts[by]
    if not len(keys):
        return keys, counts
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(counts, at)


def runs(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (shard, keys, counts) of distinct ascending keys."""
    by = np.argsort(shard, kind="stable")
    keys, counts, shard = keys[by], counts[by], shard[by]
    edge = np.flatnonzero(np.diff(shard)) + 1
    rows: list[tuple[int, bytes, bytes]] = []
    for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(keys)]):
        for at in range(lo, hi, RUN):
            part = keys[at : min(hi, at + RUN)]
            delta = np.concatenate([part[:1], np.diff(part)])
            rows.append((int(shard[lo]), _squeeze(delta), _squeeze(counts[at : at + len(part)].astype(np.int64))))
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], names=["shard", "keys", "counts"]
        )


RUN_SCHEMA = "shard int, keys binary, counts binary"


class Folder:
    """Array files under one URI. A store that isn't a mounted file system is read through a local copy of a file."""

    def __init__(self, uri: str):
        self.uri = uri
        parts = urlparse(uri)
        self.local = unquote(parts.path) if parts.scheme in ("", "file") else None

    def put(self, name: str, array: np.ndarray) -> None:
        if self.local is None:
            from pyarrow import fs

            store, path = fs.FileSystem.from_uri(self.uri)
            with store.open_output_stream(f"{path}/{name}.part") as out:
                out.write(np.ascontiguousarray(array).tobytes())
            store.move(f"{path}/{name}.part", f"{path}/{name}")
            return
        os.makedirs(self.local, exist_ok=True)
        with tempfile.NamedTemporaryFile(dir=self.local, delete=False) as out:
            np.ascontiguousarray(array).tofile(out)
        os.chmod(out.name, 0o644)
        os.replace(out.name, f"{self.local}/{name}")

    def get(self, name: str, kind: type) -> np.ndarray:
        return _mapped(self.uri, name, np.dtype(kind).str)


@lru_cache(maxsize=4096)
def _mapped(uri: str, name: str, kind: str) -> np.ndarray:
    folder = Folder(uri)
    if folder.local is not None:
        local = f"{folder.local}/{name}"
        return np.memmap(local, kind, "r") if os.path.getsize(local) else np.empty(0, kind)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    # The copy has no name: the system frees it with the last map of it.
    with tempfile.TemporaryFile() as copy, store.open_input_stream(f"{path}/{name}") as read:
        while piece := read.read(1 << 24):
            copy.write(piece)
        copy.flush()
        return np.memmap(copy, kind, "r") if copy.tell() else np.empty(0, kind)


def _merge(uri: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = Folder(uri)
        shard, held, size = None, [], 0

        def fold() -> tuple[np.ndarray, np.ndarray]:
            return summed(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))

        def close() -> pa.RecordBatch:
            keys, counts = fold()
            folder.put(f"{shard}.keys", keys)
            folder.put(f"{shard}.counts", counts)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([int(counts.sum())], pa.int64())],
                names=["shard", "keys", "total"],
            )

        for batch in batches:
            for number, keys, counts in zip(*(batch[c] for c in ("shard", "keys", "counts"))):
                if number.as_py() != shard:
                    if held:
                        yield close()
                    shard, held, size = number.as_py(), [], 0
                held.append((np.cumsum(_restore(keys.as_py(), np.uint64), dtype=np.uint64), _restore(counts.as_py(), np.int64)))
                size += len(held[-1][0])
                if size > FOLD:
                    held = [fold()]
                    size = 0
        if held:
            yield close()

    return run


class Counted:
    """Sorted key arrays with counts; ``sizes`` is rows by shard, a list as long as the number of shards."""

    def __init__(self, uri: str, sizes: list[int], total: int):
        self.folder, self.sizes, self.total = Folder(uri), sizes, total
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def __len__(self) -> int:
        return int(self.starts[-1])

    def shard(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        if not self.sizes[number]:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        return self.folder.get(f"{number}.keys", np.uint64), self.folder.get(f"{number}.counts", np.int64)

    def find(self, keys: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position (its place among all keys, or -1) and count (or 0) of each key."""
        place, count = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        by = np.lexsort((keys, shard))
        edge = np.flatnonzero(np.diff(shard[by])) + 1
        for at in np.split(by, edge):
            if not len(at):
                continue
            number = int(shard[at[0]])
            held, counts = self.shard(number)
            if not len(held):
                continue
            sought = keys[at]
            found = np.searchsorted(held, sought)
            found[found == len(held)] = 0
            hit = held[found] == sought
            place[at[hit]] = found[hit] + self.starts[number]
            count[at[hit]] = counts[found[hit]]
        return place, count


def merge(rows: DataFrame, uri: str, shards: int) -> Counted:
    """Merge the runs of :func:`runs` into files under ``uri``. Only sizes by shard come to the driver."""
    if Folder(uri).local:
        os.makedirs(Folder(uri).local, exist_ok=True)
    found = (
        rows.repartition(shards, "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_merge(uri), "shard int, keys long, total long")
        .collect()
    )
    sizes = [0] * shards
    for row in found:
        sizes[row["shard"]] = row["keys"]
    return Counted(uri, sizes, sum(row["total"] for row in found))
