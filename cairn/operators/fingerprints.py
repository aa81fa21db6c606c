"""Fingerprints in chunks, of which each two are compared as arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Fingerprints of a chunk of targets and of queries; queries and bits that are compared at a time.
TARGETS, QUERIES, ROWS, BITS = 4096, 1024, 128, 1024

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def chunks(prefix: str, most: int) -> Run:
    """A function of key, n and bits that gives rows of up to ``most`` keys, their n, their numbers of bits, and all bits."""

    def row(table: pa.Table) -> pa.RecordBatch:
        key, n, bits = (table[c].combine_chunks() for c in ("key", "n", "bits"))
        arrays = key, n, bits.value_lengths(), bits.flatten()
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(x)], x) for x in arrays], names=[f"{prefix} {c}" for c in ("key", "n", "size", "bits")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, held = [], 0
        for batch in batches:
            rest, held = [*rest, batch], held + batch.num_rows
            if held >= most:
                table = pa.Table.from_batches(rest)
                for k in range(0, held - most + 1, most):
                    yield row(table.slice(k, most))
                rest = table.slice(held // most * most).to_batches()
                held %= most
        if held:
            yield row(pa.Table.from_batches(rest))

    return run


def _dense(size: np.ndarray, bits: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Rows by fingerprint with 1 where it has the bit of the column."""
    at = np.minimum(np.searchsorted(columns, bits), len(columns) - 1)
    found = columns[at] == bits
    dense = np.zeros((len(size), len(columns)), np.float32)
    dense[np.repeat(np.arange(len(size)), size)[found], at[found]] = 1
    return dense


def nearest(most: int) -> Run:
    """A function of pairs of chunks that gives, by query, its ``most`` nearest of the target chunk that have a common bit: query, target, nq, nt, c."""

    def pair(q: tuple, t: tuple) -> Iterator[pa.RecordBatch]:
        (q_key, q_n, q_size, q_bits), (t_key, t_n, t_size, t_bits) = [(x[0], *(y.to_numpy(zero_copy_only=False) for y in x[1:])) for x in (q, t)]
        known, place = np.unique(t_key.to_numpy(zero_copy_only=False), return_inverse=True)
        own = q_key.to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        at = np.where(known[at] == own, at, -1)
        common = np.zeros((len(own), len(place)), np.float32)
        columns = np.unique(q_bits)
        for k in range(0, len(columns), BITS):
            common += _dense(q_size, q_bits, columns[k : k + BITS]) @ _dense(t_size, t_bits, columns[k : k + BITS]).T
        take = min(most, len(place))
        for k in range(0, len(own), ROWS):
            c = common[k : k + ROWS].astype(np.float64)
            score = np.trunc(np.rint(c / (q_n[k : k + ROWS, None] + t_n - c) * 100) / 100 * 100).astype(np.int64)
            score = score * len(known) + (len(known) - 1 - place)  # of equal ones the smallest target
            score[(c == 0) | (at[k : k + ROWS, None] == place)] = -1
            best = np.argpartition(score, len(place) - take, axis=1)[:, len(place) - take :]
            i, j = np.nonzero(np.take_along_axis(score, best, axis=1) >= 0)
            j = best[i, j]
            yield pa.RecordBatch.from_arrays(
                [q_key.take(pa.array(i + k)), t_key.take(pa.array(j)), pa.array(q_n[i + k]), pa.array(t_n[j]), pa.array(c[i, j].astype(np.int64))], names=["query", "target", "nq", "nt", "c"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from pair(*([batch[f"{side} {c}"][k].values for c in ("key", "n", "size", "bits")] for side in "qt"))

    return run
