import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from cairn.llm import simhash
from cairn.llm.simhash import Bands, _checked, _doubtful, _meeting, near_dedup, near_groups, shingle_hashes, signature, spanning_forest, trie_pairs


def plain_fingerprint(text, size):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(ids, prints, bits):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i, d in enumerate(ids):
        low[find(i)] = min(d, low.get(find(i), d))
    return [low[find(i)] for i in range(len(ids))]


def texts():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    base = [[rng.choice(words) for _ in range(rng.randint(60, 120))] for _ in range(8)]
    found = []
    for b in base:
        for _ in range(6):
            copy = list(b)
            copy[rng.randrange(len(copy))] = "new"
            found.append(" ".join(copy))
    return [*found, "", "one", "One two", "one two three four", None, "\t \n"]


def test_fingerprints_and_components_equal_brute_force(docs):
    rows = list(enumerate(texts()))
    found = {r.doc_id: r for r in near_groups(docs(*rows)).collect()}
    prints = [plain_fingerprint(t or "", 3) for _, t in rows]
    assert [found[i].signature[0] % 2**64 for i, _ in rows] == prints
    assert [found[i].component_id for i, _ in rows] == components([i for i, _ in rows], prints, 2)


def test_trie_finds_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**20, 40, dtype=np.uint64)
    x = np.unique(np.concatenate([base] + [base ^ np.uint64(1 << int(b)) for b in rng.integers(0, 20, 6)]))
    want = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if int(x[i] ^ x[j]).bit_count() <= 2}
    pairs = [p for i, j in trie_pairs(x, np.array([0]), np.array([len(x)]), 20, 2) for p in zip(i.tolist(), j.tolist())]
    assert set(pairs) == want and len(pairs) == len(want)


def test_spanning_forest_connects_the_same():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 50, (2, 80))
    kept = spanning_forest(50, a, b)

    def labels(at):
        label = list(range(50))
        for _ in range(50):
            for i, j in zip(a[at], b[at]):
                label[i] = label[j] = min(label[i], label[j])
        return label

    assert labels(kept) == labels(np.arange(80)) and len(kept) == 50 - len(set(labels(kept)))


def test_signature_words_differ_and_short_texts_are_one_shingle():
    hashes = shingle_hashes("a b c d e f g", 3)
    assert len(hashes) == 5 and len(set(signature(hashes, 4).tolist())) == 4
    assert shingle_hashes("A  b", 3).tolist() == [xxhash.xxh64_intdigest(b"a b", 42)]
    assert signature(shingle_hashes(" ", 3), 2).tolist() == [0, 0]


def test_hot_group_of_copies_and_repeated_rows(docs):
    rows = [(i, "the same text of several words here") for i in range(200)] + [(500, "quite another text that shares nothing at all")]
    found = near_groups(docs(*rows)).collect()
    assert {r.component_id for r in found if r.doc_id < 200} == {0} and len(found) == 201
    kept = near_dedup(docs(*rows, (0, "the same text of several words here")))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 500]
    assert kept.columns == docs().columns


def test_near_dedup_against_jaccard(docs):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(2000)]
    rows, near = [], []
    for k in range(30):
        base = [rng.choice(words) for _ in range(200)]
        copy = list(base)
        copy[50] = copy[120] = "changed"
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
        near.append(2 * k + 1)
    kept = {r.doc_id for r in near_dedup(docs(*rows)).collect()}
    assert all(2 * k in kept for k in range(30))  # the clean ones stay
    assert sum(i in kept for i in near) <= 1  # a similarity of 0.9: nearly all are found


def test_empty_and_null_ids(docs):
    assert near_groups(docs()).count() == 0 and near_dedup(docs()).count() == 0
    found = near_groups(docs((None, "a b c"), (4, "a b c"), (None, "z y x w v"))).collect()
    assert sorted(str(r.component_id) for r in found) == ["4", "4", "None"]


def family(n, rng):
    """Texts that share a passage below the similarity of 0.8, most with a copy above it."""
    words = [f"w{k}" for k in range(5000)]
    shared = [rng.choice(words) for _ in range(300)]
    rows = []
    for k in range(n):
        base = [*shared, *(rng.choice(words) for _ in range(rng.randint(60, 110)))]
        rows.append(base)
        if k % 3:
            copy = list(base)
            for _ in range(k % 5):
                copy[rng.randrange(300, len(copy))] = "changed"
            rows.append([*copy, "end"])
    rng.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


def jaccard(a, b):
    a, b = set(shingle_hashes(a, 5).tolist()), set(shingle_hashes(b, 5).tolist())
    return len(a & b) / len(a | b) if a | b else 1.0


def linked_by_brute_force(texts, similarity):
    """Components of pairs that meet in a band and are surely similar or, where that is in doubt, agree in their shingles."""
    sigs = np.array([signature(np.unique(shingle_hashes(t, 5)), 8) for t in texts])
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    error = 2.5 * np.sqrt(512 * share * (1 - share))
    sure, within = int(512 * share - error), int(np.ceil(512 * share + error))
    label, met, far = list(range(len(texts))), 0, 0

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            x = [int(a ^ b) for a, b in zip(sigs[i], sigs[j])]
            if any((w >> at & 0xFFFFFFFF).bit_count() <= 2 for w in x for at in (0, 16, 32)):
                met += 1
                whole = sum(w.bit_count() for w in x)
                if whole <= sure or whole <= within and jaccard(texts[i], texts[j]) >= similarity:
                    a, b = find(i), find(j)
                    label[max(a, b)] = min(a, b)
                else:
                    far += 1
    return [find(i) for i in range(len(texts))], met, far


def test_near_dedup_equals_brute_force_in_a_family_of_shared_passages(docs):
    rows = family(240, random.Random(12))
    texts = [t for _, t in rows]
    want, met, far = linked_by_brute_force(texts, 0.9)
    want_80, _, _ = linked_by_brute_force(texts, 0.8)
    kept = {r.doc_id for r in near_dedup(docs(*rows), similarity=0.9).collect()}
    kept_80 = {r.doc_id for r in near_dedup(docs(*rows)).collect()}
    assert met > 2 * len(rows) and far > met / 2 and 1 < len(set(want_80)) < len(set(want)) < len(rows)  # most candidates are no links
    assert kept == set(want) and kept_80 == set(want_80)


def test_near_dedup_finds_what_is_similar(docs):
    rng = random.Random(21)
    words = [f"w{k}" for k in range(3000)]
    rows, similar, other = [], [], []
    for k in range(150):
        base = [rng.choice(words) for _ in range(rng.randint(60, 400))]
        copy = list(base)
        for at in rng.sample(range(len(copy)), max(1, len(copy) // rng.choice([20, 25, 40, 50, 60, 80]))):
            copy[at] = "changed"
        pair = (" ".join(base), " ".join(copy))
        rows += [(2 * k, pair[0]), (2 * k + 1, pair[1])]
        (similar if jaccard(*pair) >= 0.8 else other).append(2 * k + 1)
    kept = {r.doc_id for r in near_dedup(docs(*rows)).collect()}
    assert len(similar) > 30 and len(other) > 30 and {2 * k for k in range(150)} <= kept
    assert sum(i in kept for i in similar) <= 0.1 * len(similar) and sum(i not in kept for i in other) <= 0.05 * len(other)


def test_a_failing_owner_of_an_equal_band_loses_no_link():
    """Values 0, 1 and 2 meet with equal bands; only 1 and 2 are similar."""
    rng = np.random.default_rng(5)
    bands = Bands(32, 2, 1, 16, 8)
    sig = rng.integers(0, 2**64, (1, 8), dtype=np.uint64).repeat(3, axis=0)
    sig[0, 1:] ^= rng.integers(0, 2**64, 7, dtype=np.uint64)
    sig[2, 5] ^= np.uint64(0xFFFF)  # 16 bits: sure; with the next word 80: in doubt
    path, rest = np.zeros(3, np.int64), np.zeros(3, np.int64)
    a, b = _checked(path, rest, np.arange(3), sig, bands.rest_bits, 2, 58)
    assert {(a[0], b[0])} in ({(1, 2)}, {(2, 1)})
    sig[2, 6] ^= np.uint64(2**64 - 1)
    pairs = [set(p) for x in _doubtful(path, rest, np.arange(3), np.ascontiguousarray(sig.T), bands, 98, np.arange(3)) for p in zip(*(c.tolist() for c in x))]
    assert pairs and all(p == {1, 2} for p in pairs)


@pytest.mark.parametrize("dense", [4096, 3])
def test_doubtful_pairs_equal_brute_force(monkeypatch, dense):
    monkeypatch.setattr(simhash, "DENSE", dense)
    rng = np.random.default_rng(6)
    bands = Bands(32, 2, 1, 16, 2)
    base = rng.integers(0, 2**64, (6, 2), dtype=np.uint64)
    sig = base[rng.integers(0, 6, 90)]
    for _ in range(5):
        sig[np.arange(90), rng.integers(0, 2, 90)] ^= np.uint64(1) << rng.integers(0, 64, 90, dtype=np.uint64)
    first = bands.first_tree(np.repeat(sig, 90, axis=0).T, np.tile(sig, (90, 1)).T).reshape(90, 90)
    assert all(first[i, i] == 0 for i in range(90))
    whole = np.bitwise_count(sig[:, None] ^ sig).sum(axis=2, dtype=int)
    label = rng.integers(0, 2, 90) * 89
    label[89] = 89
    label[0] = 0
    want = {(i, j) for i in range(90) for j in range(i) if first[i, j] < 12 * 1 + 6 and whole[i, j] <= 12 and label[i] != label[j]}
    rows = pa.RecordBatch.from_arrays([pa.array(np.arange(90)), pa.array(sig.view(np.int64).tolist())], names=["v", "sig"])
    trees = pa.Table.from_batches(simhash._subtries(bands)([rows]))
    path, rest, v = (trees[c].to_numpy() for c in ("path", "rest", "v"))
    by = np.lexsort((v, rest, path))
    path, rest, v = path[by], rest[by], v[by]
    # A row's places in all subtries are vertices of their own; those of one class are connected within a subtrie.
    at = np.unique(np.stack([path, label[v]]), axis=1, return_index=True, return_inverse=True)
    found = [(int(v[p]), int(v[q])) for ps, qs in _doubtful(path, rest, v, np.ascontiguousarray(sig[v].T), bands, 12, at[1][at[2].reshape(-1)]) for p, q in zip(ps, qs)]
    assert want and {(max(p), min(p)) for p in found} == want


def test_repeated_keys_and_odd_rows(docs):
    text = "a text of some words that is long enough for shingles of five words"
    rows = [(1, text), (1, text), (None, text + " end"), (None, ""), (7, None), (7, ""), (9, "\n\t"), (5, "one"), (6, "ONE"), (8, "x " * 9000 + text)]
    kept = near_dedup(docs(*rows))
    assert sorted((r.doc_id, (r.text or "")[:3]) for r in kept.collect()) == [(1, "a t"), (5, "one"), (7, ""), (8, "x x")]


def test_checked_walk_equals_brute_force(monkeypatch):
    rng = np.random.default_rng(8)
    n = 400
    path, v = rng.integers(0, 3, n), rng.permutation(n)
    rest = rng.choice(np.array([0, 1, 3, 7, 64, 960, 4000]), n).astype(np.int64)
    sig = rng.integers(0, 2**64, (40, 2), dtype=np.uint64)[rng.integers(0, 40, n)] ^ (np.uint64(1) << rng.integers(0, 64, (n, 2), dtype=np.uint64))
    near = (path[:, None] == path) & (np.bitwise_count(rest[:, None] ^ rest) <= 2)
    link = near & (np.bitwise_count(sig[:, None] ^ sig).sum(axis=2, dtype=int) <= 3)
    want = spanning_forest(n, *(v[k] for k in np.nonzero(link)))

    def labels(a, b):
        label = np.arange(n)
        for _ in range(n):
            np.minimum.at(label, a, label[b])
            np.minimum.at(label, b, label[a])
        return label.tolist()

    for dense, cells in ((4096, 500_000), (0, 64), (300, 1000)):
        monkeypatch.setattr("cairn.llm.simhash.DENSE", dense)
        monkeypatch.setattr("cairn.llm.simhash.CELLS", cells)
        a, b = _checked(path, rest, v, sig, 12, 2, 3)
        assert len(a) == len(want) and labels(a, b) == labels(*(v[k] for k in np.nonzero(link)))
    own = np.ones(n, bool)
    assert set(_meeting(path, rest, v, 12, 2, own).tolist()) == set(np.flatnonzero(near.sum(axis=1) > 1).tolist())


def test_a_walk_of_candidates_holds_little_and_marks_the_same_in_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    n, bands = 60_000, Bands(32, 2, 1, 16, 1)
    x = rng.integers(0, 2**63, n, dtype=np.uint64)
    x[: n // 4] = x[rng.integers(0, n, n // 4)] ^ (np.uint64(1) << rng.integers(0, 63, n // 4).astype(np.uint64))
    sig = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32)), pa.array(x.view(np.int64)))
    rows = pa.Table.from_batches(simhash._subtries(bands)([pa.RecordBatch.from_arrays([pa.array(np.arange(n)), sig], names=["v", "sig"])]))
    rows = rows.sort_by("path").combine_chunks()

    def marked() -> set[tuple[int, int]]:
        found = pa.Table.from_batches(simhash._candidates(bands)(rows.to_batches(10_000)))
        return set(zip(found["path"].to_pylist(), found["v"].to_pylist()))

    tracemalloc.start()
    for _ in simhash._candidates(bands)(rows.to_batches(10_000)):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    in_pieces = marked()
    monkeypatch.setattr(simhash, "CHUNK", 1 << 40)
    monkeypatch.setattr(simhash, "FRONTIER", 1 << 40)
    assert in_pieces and in_pieces == marked()
    assert peak < 50 << 20
