"""SimHash near-deduplication by a binary trie self-join.

A document's signature holds one or more 64-bit words; a bit is set where over half of its shingle hashes have it set.
Signatures are cut into bands, and two documents are candidates when some band of theirs differs in at most ``budget``
bits. The self-join of a band walks the binary trie of its values with pairs of nodes, adds a differing bit where the
two nodes take different branches, and prunes a pair beyond the budget.

To deal the trie out, a band's bits are cut into blocks. Within the budget some blocks must agree, so for each choice
of agreeing blocks the bits are put in the order *those blocks, the rest*: the agreeing blocks are the path to a
subtrie, each subtrie is walked in one task, and every pair within the budget meets in at least one order. What a task
holds is distinct band values only: a group of copies is one vertex. A subtrie gives a spanning forest of its links,
never all pairs, and connectivity is the same.

Where a link needs more than a near band, three walks follow each other, each over what the one before left: the first
marks what meets a candidate at all; the second has the whole signatures, links what is surely similar and marks the
rows of pairs that may be; the third has the shingles of those rows and compares them exactly. Each doubtful pair is
compared in one subtrie only, the first in which it meets, and no pair is given up before it is decided.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import accumulate, chain, combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.memory import lean, small_batches
from cairn.llm.rows import matching, row_key
from cairn.operators.graph import connected_components
from cairn.session import Workspace

SEED = 42
#: Node pairs walked at a time, and bytes of whole subtries gathered for one walk; a worker holds some twenty times the latter.
FRONTIER, CHUNK = 50_000, 1 << 21
#: Values that a subtrie should hold at most: beyond it more blocks must agree, so that paths are longer.
SUBTRIE = 50_000
#: Signature pairs compared at a time; pairs of two groups of equal values beyond which these are searched by breadth.
CELLS, DENSE = 500_000, 4096


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of every shingle of ``size`` words, repeats included; of the whole text if it has fewer words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, white space 09-0D and 20
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends[: len(words) - size]]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[size - 1 :])), np.uint64, len(starts))


def signature(hashes: np.ndarray, words: int) -> np.ndarray:
    """``words`` 64-bit words; the first is the plain fingerprint, the others take mixed copies of the hashes."""
    if not len(hashes):
        return np.zeros(words, np.uint64)
    out = np.empty(words, np.uint64)
    for w in range(words):
        x = hashes
        if w:
            x = x + np.uint64((w * 0x9E3779B97F4A7C15) % 2**64)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(31))
        ones = np.zeros(64, np.int64)
        for at in range(0, len(x), 65_536):
            bits = np.unpackbits(x[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        out[w] = np.packbits(ones * 2 > len(x), bitorder="little").view(np.uint64)[0]
    return out


def _signatures(size: int, words: int, kept: list[str], distinct: bool):
    def hashes(text: str | None) -> np.ndarray:
        found = shingle_hashes(text or "", size)
        return np.unique(found) if distinct else found

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = [signature(hashes(t), words).view(np.int64) for t in batch["raw"].to_pylist()]
            flat = np.concatenate(sigs) if sigs else np.empty(0, np.int64)
            offsets = pa.array(np.arange(0, len(flat) + 1, words, dtype=np.int32))
            sig = pa.ListArray.from_arrays(offsets, pa.array(flat))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), sig], names=[*kept, "sig"])

    return run


def orders(bits: int, budget: int, spare: int) -> list[tuple[list[int], list[int]]]:
    """Bit orders (path bits, rest) such that values within ``budget`` agree on the path bits of at least one."""
    blocks = [b.tolist() for b in np.array_split(np.arange(bits), budget + spare)]
    found = []
    for same in combinations(range(len(blocks)), spare):
        path = [i for k in same for i in blocks[k]]
        found.append((path, [i for k, b in enumerate(blocks) if k not in same for i in b]))
    return found


def _gather(x: np.ndarray, bits: list[int]) -> np.ndarray:
    """The chosen bits of each value, joined in order; runs of neighbours move together."""
    out = np.zeros(len(x), np.uint64)
    at = 0
    while at < len(bits):
        n = 1
        while at + n < len(bits) and bits[at + n] == bits[at + n - 1] + 1:
            n += 1
        mask = np.uint64((1 << n) - 1)
        out |= ((x >> np.uint64(bits[at])) & mask) << np.uint64(at)
        at += n
    return out


@dataclass(frozen=True)
class Bands:
    """The bands of a signature, ``bits`` wide and ``stride`` apart within each word, and the orders of their bits.

    A tree is a band with an order; a path is the tree's number and then the agreeing bits.
    """

    bits: int
    budget: int
    spare: int
    stride: int
    words: int

    @cached_property
    def plan(self) -> list[tuple[list[int], list[int]]]:
        return orders(self.bits, self.budget, self.spare)

    @property
    def longest(self) -> int:
        return max(len(path) for path, _ in self.plan)

    @property
    def rest_bits(self) -> int:
        return max(len(rest) for _, rest in self.plan)

    def values(self, sig: np.ndarray) -> Iterator[np.ndarray]:
        """Each band of signatures (words by rows), in order."""
        for word in range(self.words):
            for at in range(0, 64 - self.bits + 1, self.stride):
                x = sig[word] >> np.uint64(at)
                yield x & np.uint64((1 << self.bits) - 1) if self.bits < 64 else x

    def first_tree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The first tree in which two signatures (words by rows each) meet; beyond all trees where they don't."""
        masks = [np.uint64(sum(1 << i for i in path)) for path, _ in self.plan]
        found = np.full(a.shape[1], len(masks) * len(range(0, 64 - self.bits + 1, self.stride)) * self.words)
        open_ = np.arange(a.shape[1])
        for number, x in enumerate(self.values(a ^ b)):
            near = np.bitwise_count(x[open_]) <= self.budget
            for k, mask in enumerate(masks):
                hit = open_[near & (x[open_] & mask == 0)]
                found[hit] = np.minimum(found[hit], number * len(masks) + k)
            open_ = open_[~near]
            if not len(open_):
                break
        return found


def _subtries(bands: Bands):
    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            v = batch["v"].to_numpy(zero_copy_only=False)
            for band, x in enumerate(bands.values(np.ascontiguousarray(_array(batch["sig"]).T))):
                for k, (path, rest) in enumerate(bands.plan):
                    tree = np.uint64((band * len(bands.plan) + k) << bands.longest)
                    columns = [(_gather(x, path) | tree).view(np.int64), _gather(x, rest).view(np.int64), v]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["path", "rest", "v"])

    return run


def trie_pairs(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, bits: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of values that share a subtrie and differ in at most ``budget`` bits.

    ``x``: values of ``bits`` bits, ascending and distinct within each subtrie ``[lo, hi)``.
    """
    zeros: dict[int, np.ndarray] = {}

    def split(bit: int, at: np.ndarray, to: np.ndarray) -> np.ndarray:
        if bit not in zeros:
            zeros[bit] = np.concatenate([[0], np.cumsum((x >> np.uint64(bit)) & np.uint64(1) == 0)])
        return at + zeros[bit][to] - zeros[bit][at]

    big = hi - lo > 1
    stack = [(bits - 1, lo[big], hi[big], lo[big], hi[big], np.zeros(big.sum(), np.int8))]
    while stack:
        bit, a, a2, b, b2, err = stack.pop()
        if len(a) > FRONTIER:
            for at in range(0, len(a), FRONTIER // 2):
                stack.append((bit, *(c[at : at + FRONTIER // 2] for c in (a, a2, b, b2, err))))
            continue
        single = (a2 - a == 1) & (b2 - b == 1)
        if single.any():
            i, j = a[single], b[single]
            near = (np.bitwise_count(x[i] ^ x[j]) <= budget) & (i != j)
            if near.any():
                yield i[near], j[near]
            a, a2, b, b2, err = (c[~single] for c in (a, a2, b, b2, err))
        if not len(a) or bit < 0:
            continue
        am, bm, other = split(bit, a, a2), split(bit, b, b2), a != b
        children = [
            (a, am, b, bm, err, None),
            (am, a2, bm, b2, err, None),
            (a, am, bm, b2, err + 1, None),
            (am, a2, b, bm, err + 1, other),
        ]
        grown = []
        for p, p2, q, q2, e, only in children:
            ok = (p2 > p) & (q2 > q) & (e <= budget)
            if only is not None:
                ok &= only
            grown.append(tuple(c[ok] for c in (p, p2, q, q2, e)))
        stack.append((bit - 1, *(np.concatenate(c) for c in zip(*grown))))


def spanning_forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of edges (a, b) that connect what all of them connect, earlier edges first."""
    label, chosen = np.arange(n), []
    edge = np.arange(len(a))
    while len(edge):
        ra, rb = label[a[edge]], label[b[edge]]
        open_ = ra != rb
        edge, ra, rb = edge[open_], ra[open_], rb[open_]
        if not len(edge):
            break
        first = np.full(n, len(a))
        np.minimum.at(first, ra, edge)
        np.minimum.at(first, rb, edge)
        pick = np.unique(first[first < len(a)])
        chosen.append(pick)
        pa_, pb = label[a[pick]], label[b[pick]]
        root = np.arange(n)
        while True:
            low = np.minimum(root[pa_], root[pb])
            if (root[pa_] == low).all() and (root[pb] == low).all():
                break
            np.minimum.at(root, pa_, low)
            np.minimum.at(root, pb, low)
        label = root[label]
    return np.sort(np.concatenate(chosen)) if chosen else np.empty(0, np.int64)


def _distinct(path: np.ndarray, rest: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, ...]:
    """The order of rows by subtrie, value and vertex; where each value begins, the values, and the subtries' bounds."""
    rest = rest.view(np.uint64)
    by = np.lexsort((v, rest, path))
    path, rest = path[by], rest[by]
    new = np.ones(len(by), bool)
    new[1:] = (path[1:] != path[:-1]) | (rest[1:] != rest[:-1])
    at = np.flatnonzero(new)
    tree = path[at]
    edge = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]]))
    return by, at, rest[at], edge, np.append(edge[1:], len(tree))


class _Forest:
    """Edges among ``n`` vertices, thinned to a spanning forest whenever many are held."""

    def __init__(self, n: int):
        self.n, self.held = n, 0
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.pairs.append((a, b))
        self.held += len(a)
        if self.held > 500_000:
            self.pairs, self.held = [self.edges()], 0

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.pairs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        a, b = (np.concatenate([p[k] for p in self.pairs]) for k in (0, 1))
        keep = spanning_forest(self.n, a, b)
        return a[keep], b[keep]


def _walk(path: np.ndarray, rest: np.ndarray, v: np.ndarray, bits: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Linking pairs of vertices among rows of whole subtries, where every candidate is a link."""
    by, at, x, lo, hi = _distinct(path, rest, v)
    v = v[by]
    owner = np.repeat(at, np.diff(np.append(at, len(v))))
    equal = owner != np.arange(len(v))
    forest = _Forest(len(x))
    for i, j in trie_pairs(x, lo, hi, bits, budget):
        forest.add(i, j)
    i, j = forest.edges()
    return np.concatenate([v[owner[equal]], v[at[i]]]), np.concatenate([v[equal], v[at[j]]])


def _meeting(path: np.ndarray, rest: np.ndarray, v: np.ndarray, bits: int, budget: int, own: np.ndarray) -> np.ndarray:
    """Positions of the rows that have a candidate in their subtrie; equal values, that meet in all orders, count where ``own`` holds."""
    by, at, x, lo, hi = _distinct(path, rest, v)
    size = np.diff(np.append(at, len(by)))
    meets = (size > 1) & own[by[at]]
    for i, j in trie_pairs(x, lo, hi, bits, budget):
        meets[i] = meets[j] = True
    return by[np.repeat(meets, size)]


def _differ(sig: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Bits in which signatures (words by rows) at p and q differ."""
    found = np.bitwise_count(sig[0][p] ^ sig[0][q]).astype(np.int32)
    for word in sig[1:]:
        found += np.bitwise_count(word[p] ^ word[q])
    return found


def _searched(sig: np.ndarray, a: np.ndarray, b: np.ndarray | None, within: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links between rows ``a`` and ``b``, or among ``a``: every row is compared with those not yet reached."""
    unseen = [a] if b is None else [a, b]
    while all(len(u) for u in unseen):
        todo = [(0, unseen[0][:1])]
        unseen[0] = unseen[0][1:]
        while todo:
            side, block = todo.pop()
            other = (side + 1) % len(unseen)
            while len(block) and len(unseen[other]):
                n = max(1, CELLS // len(unseen[other]))
                some, block, against = block[:n], block[n:], unseen[other]
                near = np.concatenate(
                    [_differ(sig, some[:, None], against[None, k : k + CELLS]) <= within for k in range(0, len(against), CELLS)], axis=1
                )
                hit = near.any(axis=0)
                if hit.any():
                    yield some[near[:, hit].argmax(axis=0)], against[hit]
                    todo.append((other, against[hit]))
                    unseen[other] = against[~hit]


def _checked(
    path: np.ndarray, rest: np.ndarray, v: np.ndarray, sig: np.ndarray, bits: int, budget: int, within: int
) -> tuple[np.ndarray, np.ndarray]:
    """Linking pairs of vertices among rows of whole subtries: candidates whose signatures differ in at most ``within`` bits."""
    by, at, x, lo, hi = _distinct(path, rest, v)
    v, sig = v[by], np.ascontiguousarray(sig[by].T)
    size = np.diff(np.append(at, len(v)))
    forest = _Forest(len(v))
    same = np.flatnonzero(size > 1)
    for i, j in chain([(same, same)], trie_pairs(x, lo, hi, bits, budget)):
        count = size[i] * size[j]
        for k in np.flatnonzero(count > DENSE):
            rows_i, rows_j = (np.arange(at[g], at[g] + size[g]) for g in (i[k], j[k]))
            for p, q in _searched(sig, rows_i, rows_j if i[k] != j[k] else None, within):
                forest.add(p, q)
        i, j, count = (c[count <= DENSE] for c in (i, j, count))
        total = np.cumsum(count)
        begin = 0
        while begin < len(i):
            end = max(begin + 1, int(np.searchsorted(total, total[begin] - count[begin] + CELLS, "right")))
            n, wide = count[begin:end], size[j[begin:end]]
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            p = np.repeat(at[i[begin:end]], n) + k // np.repeat(wide, n)
            q = np.repeat(at[j[begin:end]], n) + k % np.repeat(wide, n)
            near = (p != q) & (_differ(sig, p, q) <= within)
            forest.add(p[near], q[near])
            begin = end
    a, b = forest.edges()
    return v[a], v[b]


def _find(parent: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The root of each row."""
    root = parent[rows]
    while True:
        up = parent[root]
        if (up == root).all():
            return root
        root = up


def _open_pairs(i: np.ndarray, j: np.ndarray, at: np.ndarray, size: np.ndarray, parent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (p, q) of pairs of groups of equal values that aren't connected yet, in blocks.

    Of a large pair of groups only rows outside their largest class are paired with the others, since one of two rows
    of different classes is such a row.
    """
    count = size[i] * size[j]
    for k in np.flatnonzero(count > DENSE):
        rows = np.arange(at[i[k]], at[i[k]] + size[i[k]])
        if i[k] != j[k]:
            rows = np.concatenate([rows, np.arange(at[j[k]], at[j[k]] + size[j[k]])])
        in_i = rows < at[i[k]] + size[i[k]] if i[k] != j[k] else None
        root = _find(parent, rows)
        kinds, kind, many = np.unique(root, return_inverse=True, return_counts=True)
        odd = np.flatnonzero(kind != many.argmax())
        n = max(1, CELLS // len(rows))
        for begin in range(0, len(odd), n):
            a = odd[begin : begin + n]
            for cut in range(0, len(rows), CELLS):
                b = np.arange(cut, min(len(rows), cut + CELLS))
                differ = kind[a][:, None] != kind[b]
                if in_i is not None:
                    differ &= in_i[a][:, None] != in_i[b]
                p, q = np.nonzero(differ)
                if len(p):
                    yield rows[a[p]], rows[b[q]]
    i, j, count = (c[count <= DENSE] for c in (i, j, count))
    total = np.cumsum(count)
    begin = 0
    while begin < len(i):
        end = max(begin + 1, int(np.searchsorted(total, total[begin] - count[begin] + CELLS, "right")))
        n, wide = count[begin:end], size[j[begin:end]]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        p = np.repeat(at[i[begin:end]], n) + k // np.repeat(wide, n)
        q = np.repeat(at[j[begin:end]], n) + k % np.repeat(wide, n)
        differ = _find(parent, p) != _find(parent, q)
        if differ.any():
            yield p[differ], q[differ]
        begin = end


def _doubtful(
    path: np.ndarray, rest: np.ndarray, v: np.ndarray, sig: np.ndarray, bands: Bands, within: int, parent: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs, as positions in the given order, that aren't connected, differ in at most ``within`` bits, and meet here first.

    ``parent`` may be changed by the caller between blocks. Rows come ordered by path, rest and v; ``sig`` is words by rows.
    """
    _, at, x, lo, hi = _distinct(path, rest, v)
    size = np.diff(np.append(at, len(v)))
    same = np.flatnonzero(size > 1)
    for i, j in chain([(same, same)], trie_pairs(x, lo, hi, bands.rest_bits, bands.budget)):
        for p, q in _open_pairs(i, j, at, size, parent):
            near = (p != q) & (_differ(sig, p, q) <= within)
            p, q = p[near], q[near]
            if len(p):
                own = bands.first_tree(sig[:, p], sig[:, q]) == path[p] >> bands.longest
                if own.any():
                    yield p[own], q[own]


def _second(bands: Bands, sure: int, within: int):
    """Links of surely similar rows, and rows that have a doubtful pair, with the class that the sure links give them."""

    def walk(path: np.ndarray, rest: np.ndarray, v: np.ndarray, sig: np.ndarray) -> pa.RecordBatch:
        by = _distinct(path, rest, v)[0]
        path, rest, v, sig = (c[by] for c in (path, rest, v, sig))
        a, b = _checked(path, rest, np.arange(len(v)), sig, bands.rest_bits, bands.budget, sure)
        parent = _classes(len(v), a, b)
        marked = np.zeros(len(v), bool)
        for p, q in _doubtful(path, rest, v, np.ascontiguousarray(sig.T), bands, within, parent):
            marked[p] = marked[q] = True
        at = np.flatnonzero(marked)
        none = np.full(len(a), -1, np.int64)
        columns = [none, none, v[a], v[b]], [path[at], rest[at], v[at], v[parent[at]]]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*columns)], names=["path", "rest", "a", "b"])

    return _by_subtrie(lambda t: walk(*(_array(t[c]) for c in ("path", "rest", "v", "sig"))))


def _classes(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each of ``n`` rows the smallest that the edges reach."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            return label
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = _find(label, np.arange(n))


class _Sets:
    """Sets of shingle hashes by row, as arrays of numbers."""

    def __init__(self, column: pa.Array):
        self.length = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        kinds, flat = np.unique(column.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        self.flat, self.mark = flat.astype(np.int32), np.zeros(len(kinds), bool)
        self.start = np.cumsum(self.length) - self.length

    def similar(self, p: int, q: np.ndarray, similarity: float) -> np.ndarray:
        """Which of the rows ``q`` have at least that Jaccard similarity to row ``p``."""
        own = self.flat[self.start[p] : self.start[p] + self.length[p]]
        n = self.length[q]
        out = np.zeros(len(q), bool)
        fits = np.flatnonzero((np.minimum(n, len(own)) >= similarity * np.maximum(n, len(own)) - 1e-9) & (n > 0))
        if not len(fits):
            return out
        self.mark[own] = True
        total = np.cumsum(n[fits])
        begin = 0
        while begin < len(fits):
            end = max(begin + 1, int(np.searchsorted(total, total[begin] - n[fits[begin]] + 4 * CELLS, "right")))
            some = fits[begin:end]
            m = n[some]
            at = np.cumsum(m) - m
            k = np.arange(m.sum()) - np.repeat(at, m) + np.repeat(self.start[q[some]], m)
            common = np.add.reduceat(self.mark[self.flat[k]], at, dtype=np.int64)
            out[some] = common >= similarity * (m + len(own) - common) - 1e-9
            begin = end
        self.mark[own] = False
        return out


def _third(bands: Bands, within: int, similarity: float):
    """Links of doubtful pairs whose shingles agree."""

    def walk(t: pa.Table) -> pa.RecordBatch:
        path, rest, v, label, sig = (_array(t[c]) for c in ("path", "rest", "v", "label", "sig"))
        by = _distinct(path, rest, v)[0]
        path, rest, v, label, sig = (c[by] for c in (path, rest, v, label, sig))
        sets = _Sets(t["shingles"].combine_chunks().take(pa.array(by)))
        # Rows of one subtrie and one class are connected from the start.
        kinds = np.unique(np.stack([path, label]), axis=1, return_index=True, return_inverse=True)
        parent = kinds[1][kinds[2].reshape(-1)]
        links: list[tuple[int, int]] = []
        for p, q in _doubtful(path, rest, v, np.ascontiguousarray(sig.T), bands, within, parent):
            order = np.argsort(p, kind="stable")
            p, q = p[order], q[order]
            edge = np.flatnonzero(np.diff(p)) + 1
            for one, others in zip(p[np.concatenate([[0], edge])].tolist(), np.split(q, edge)):
                others = others[_find(parent, others) != _find(parent, np.array([one]))[0]]
                for other in others[sets.similar(one, others, similarity)].tolist():
                    a, b = _find(parent, np.array([one, other])).tolist()
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        links.append((one, other))
        a, b = (v[[pair[k] for pair in links]] if links else np.empty(0, np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return _by_subtrie(walk)


def _array(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The numbers of a column, or of arrays of equal length by rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(column), -1)
    return column.to_numpy(zero_copy_only=False)


def _by_subtrie(walk: Callable[[pa.Table], pa.RecordBatch]):
    """Walks over rows that come ordered by their column ``path``; each takes whole subtries."""

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            size += batch.nbytes
            if size < CHUNK or batch["path"][-1] == held[0]["path"][0]:
                continue
            whole = pa.Table.from_batches(held)
            path = _array(whole["path"])
            cut = int(np.searchsorted(path, path[-1]))
            yield walk(whole.slice(0, cut))
            held = whole.slice(cut).combine_chunks().to_batches()
            size = sum(b.nbytes for b in held)
        if held:
            yield walk(pa.Table.from_batches(held))

    return run


def _links(bands: Bands):
    """A spanning forest of the candidates, all of which are links."""

    def walk(t: pa.Table) -> pa.RecordBatch:
        a, b = _walk(*(_array(t[c]) for c in ("path", "rest", "v")), bands.rest_bits, bands.budget)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return _by_subtrie(walk)


def _candidates(bands: Bands):
    def walk(t: pa.Table) -> pa.RecordBatch:
        path, rest, v = (_array(t[c]) for c in ("path", "rest", "v"))
        at = _meeting(path, rest, v, bands.rest_bits, bands.budget, (path >> bands.longest) % len(bands.plan) == 0)
        return pa.RecordBatch.from_arrays([pa.array(c[at]) for c in (path, rest, v)], names=["path", "rest", "v"])

    return _by_subtrie(walk)


def _shingles(size: int):
    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                found = [np.unique(shingle_hashes(t or "", size)).view(np.int64) for t in part["raw"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["v"], pa.array(found, pa.list_(pa.int64()))], names=["v", "shingles"])

    return run


def _bands(n: int, bits: int, budget: int, stride: int, words: int, spare: int) -> Bands:
    """Bands whose subtries hold few of ``n`` values: ``spare`` blocks agree, or as many more as that takes."""
    while True:
        bands = Bands(bits, budget, spare, stride, words)
        if n >> min(len(path) for path, _ in bands.plan) <= SUBTRIE or budget + spare >= bits:
            return bands
        spare += 1


def _subtrie_rows(nodes: DataFrame, bands: Bands) -> DataFrame:
    found = nodes.select("v", "sig").mapInArrow(_subtries(bands), "path long, rest long, v long")
    return _dealt(found)


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("path").sortWithinPartitions("path")


def _roots(work: Workspace, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """Nodes with the root of their component."""
    reach = connected_components(links, src="a", dst="b")
    return nodes.join(reach.withColumnRenamed("node", "v"), "v", "left").select("sig", "low", "v", F.coalesce("component", "v").alias("root"))


def near_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, words: int = 1, band_bits: int = 64, budget: int = 2, spare: int = 2
) -> DataFrame:
    """One row per row of ``docs``: its id, ``signature`` (array of longs), ``component_id``.

    ``component_id`` is the smallest id that links reach, itself included. Texts are lower-cased in A-Z; words are runs
    of other than white space (09-0D, 20); a text of fewer than ``shingle`` words is one shingle, and one of no words,
    null included, has signature zero and is linked like any other. Documents link when a band of theirs differs in at
    most ``budget`` bits. A null id is above all others. An empty table gives an empty result. Other columns are
    ignored, whatever their names.
    """
    small_batches(docs.sparkSession)
    work = Workspace(docs.sparkSession, "simhash")
    base = docs.select(docs[id_col].alias("id"), F.monotonically_increasing_id().alias("rid"), docs[text_col].alias("raw"))
    shape = base.drop("raw").withColumn("sig", F.array(F.lit(0).cast("long"))).schema
    rows = work.save(base.mapInArrow(_signatures(shingle, words, ["id", "rid"], False), shape), "signatures")
    nodes = work.save(rows.groupBy("sig").agg(F.min("id").alias("low"), F.min("rid").alias("v")), "nodes")
    bands = _bands(nodes.count(), band_bits, budget, band_bits, words, spare)
    links = work.save(_subtrie_rows(nodes, bands).mapInArrow(_links(bands), "a long, b long").distinct(), "links")
    root = work.save(_roots(work, nodes, links), "roots")
    least = root.groupBy("root").agg(F.min("low").alias("component_id"))
    label = work.save(root.join(least, "root").select("sig", "component_id"), "labels")
    for done in (nodes, links, root):
        work.drop(done)
    return rows.join(label, "sig").select(F.col("id").alias(id_col), F.col("sig").alias("signature"), "component_id")


def near_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = 0.8,
    words: int = 8,
    band_bits: int = 32,
    budget: int = 2,
    stride: int = 16,
    doubt: float = 2.5,
) -> DataFrame:
    """The rows of ``docs`` without all but one of each group of near copies, with all their columns.

    Near copies share distinct five-word shingles with a similarity (Jaccard) of at least ``similarity``. Candidates
    differ in at most ``budget`` bits of some band of their signatures of ``words`` times 64 bits; bands are
    ``band_bits`` wide and ``stride`` apart. The whole signatures estimate the similarity: candidates that are ``doubt``
    standard errors above it are linked, those as far below it are not, and the shingles of those between are compared.
    Of a group the row with the smallest id stays, a null id being the largest; of rows that are alike in id and text
    one stays. Null texts are empty, and texts without words are near copies of each other. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    work = Workspace(spark, "near-dedup")
    # A row is known by its id and 128 bits of its text, so that rows needn't keep their order between readings.
    key = row_key(docs, id_col, text_col)
    keyed = docs.select(*[c.alias(n) for n, c in key.items()], docs[text_col].alias("raw"))
    base = keyed.withColumn("rid", F.monotonically_increasing_id())
    kept = ["i", "x", "y", "rid"]
    shape = base.select(*kept).withColumn("sig", F.array(F.lit(0).cast("long"))).schema
    rows = work.save(base.mapInArrow(_signatures(5, words, kept, True), shape), "signatures")
    nodes = work.save(rows.groupBy("sig").agg(F.min("i").alias("low"), F.min("rid").alias("v"), F.min_by(F.struct("i", "x", "y"), "rid").alias("key")), "nodes")
    bands = _bands(nodes.count(), band_bits, budget, stride, words, 1)
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    error = doubt * np.sqrt(words * 64 * share * (1 - share))
    sure, within = int(words * 64 * share - error), int(np.ceil(words * 64 * share + error))
    small = nodes.select("v", "sig")
    met = work.save(_subtrie_rows(nodes, bands).mapInArrow(_candidates(bands), "path long, rest long, v long"), "met")
    second = _dealt(met.join(small, "v")).mapInArrow(_second(bands, sure, within), "path long, rest long, a long, b long")
    second = work.save(second, "second")
    sure_links = second.where("path = -1").select("a", "b").distinct()
    doubtful = second.where("path >= 0").select("path", "rest", F.col("a").alias("v"), F.col("b").alias("label"))
    asked = work.save(nodes.join(doubtful.select("v").distinct(), "v", "left_semi").select("v", "key.*"), "asked")
    sets = matching(keyed, asked).select("v", "raw").mapInArrow(_shingles(5), "v long, shingles array<long>")
    sets = work.save(sets.groupBy("v").agg(F.first("shingles").alias("shingles")), "shingles")
    third = _dealt(doubtful.join(small, "v").join(sets, "v")).mapInArrow(_third(bands, within, similarity), "a long, b long")
    links = work.save(sure_links.union(third).distinct(), "links")
    root = work.save(_roots(work, nodes, links), "roots")
    member = rows.join(root.select("sig", "root"), "sig").select(*kept, "root")
    order = F.struct(F.col("i").isNull().alias("z"), F.col("i").alias("i"), F.col("rid").alias("r"))
    first = member.groupBy("root").agg(F.min(order)["r"].alias("rid")).select("rid", F.lit(True).alias("first"))
    flagged = member.join(first, "rid", "left").groupBy("i", "x", "y").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.coalesce("first", F.lit(False))).alias("stays"))
    flagged = work.save(flagged.where("n > 1 or not stays"), "flagged")
    for done in (rows, nodes, met, second, asked, sets, links, root):
        work.drop(done)
    found = matching(docs, flagged, key, how="left_anti")
    twins = flagged.where("stays")
    if not twins.isEmpty():
        whole = docs.select(*[c.alias(n) for n, c in key.items()], F.struct(*[docs[c] for c in docs.columns]).alias("row"))
        one = matching(whole, twins, how="left_semi").groupBy("i", "x", "y").agg(F.first("row").alias("row"))
        found = found.union(one.select("row.*"))
    return found
