import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from cairn.llm.arrays import _restore, _squeeze, summed
from cairn.llm.kneser_ney import discounts, score, train

TRAIN = [(k, f"the cat {'sat' if k % 3 else 'ran'} on the {'mat' if k % 4 else 'road'} w{k} w{k % 7}") for k in range(40)] + [(90, None), (91, ""), (92, "The the THE")]


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def brute(rows):
    pairs = Counter(p for _, t in rows for p in zip([None, *tokens(t)], tokens(t)))
    lower = Counter(w for _, w in pairs)
    by_count = lambda c: [list(c.values()).count(k) for k in range(1, 5)]
    d, e = discounts(by_count(pairs)), discounts(by_count(lower))
    context = defaultdict(Counter)
    for (u, w), n in pairs.items():
        context[u][w] = n
    off = lambda n, t: t[min(n, 3) - 1] if n else 0
    spare = sum(off(n, e) for n in lower.values()) / len(pairs)

    def one(w):
        return max(lower[w] - off(lower[w], e), 0) / len(pairs) + spare / (len(lower) + 1)

    def two(u, w):
        if u not in context:
            return one(w)
        total = sum(context[u].values())
        return max(context[u][w] - off(context[u][w], d), 0) / total + sum(off(n, d) for n in context[u].values()) / total * one(w)

    return two, lower


def test_scores_equal_brute_force(docs):
    asked = TRAIN + [(100, "the cat flew on the mat"), (101, "all new words here"), (102, None)]
    model = train(docs(*TRAIN), shards=3)
    two, lower = brute(TRAIN)
    counts = Counter(w for _, t in TRAIN for w in tokens(t))
    assert model.tokens == sum(counts.values())
    for r in score(docs(*asked), model).collect():
        found = tokens(dict(asked)[r.doc_id])
        want = sum(math.log10(two(u, w)) for u, w in zip([None, *found], found))
        base = sum(math.log10((counts[w] + 1) / (model.tokens + len(counts) + 1)) for w in found)
        assert r.score == pytest.approx(want, rel=1e-9) and r.base_score == pytest.approx(base, rel=1e-9)
        assert (r.n_tokens, r.n_known) == (len(found), sum(w in counts for w in found))


def test_probabilities_sum_to_one():
    two, lower = brute(TRAIN)
    for u in (b"the", None, b"unseen"):
        assert sum(two(u, w) for w in lower) + two(u, b"never seen") == pytest.approx(1)


def test_empty_training_and_empty_table(docs):
    model = train(docs(), shards=2)
    r = score(docs((1, "a b")), model).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and math.isfinite(r.score)
    assert score(docs(), model).count() == 0


def test_arrays_round_trip():
    x = np.array([5, 2**40, 7, 5], np.uint64)
    assert _restore(_squeeze(x), np.uint64).tolist() == x.tolist()
    keys, counts = summed(x, np.array([1, 2, 3, 4]))
    assert keys.tolist() == [5, 7, 2**40] and counts.tolist() == [5, 3, 2]


def test_odd_rows_and_long_texts(spark):
    shape = "doc_id long, text string, id string, raw string, score double, n_tokens long"
    long = " ".join(f"w{k % 50}" for k in range(30_000))
    rows = [(1, "the cat", "x", "y", 0.5, 1), (1, "the cat", "x", "y", 0.5, 1), (None, "the mat", "x", "y", 0.5, 1), (None, None, "x", "y", None, 1), (2, long, "x", "y", 0.5, 1)]
    table = spark.createDataFrame(rows, shape)
    model = train(table)
    found = score(table, model).collect()
    assert sorted(str(r.doc_id) for r in found) == ["1", "1", "2", "None", "None"] and all(math.isfinite(r.score) for r in found)
    assert {r.n_tokens for r in found} == {1, 3, 30_001} and model.tokens == 30_001 + 3 * 3 + 1
    assert len({r.score for r in found if r.doc_id == 1}) == 1


def test_files_of_the_arrays_grow_with_the_text(docs, monkeypatch):
    monkeypatch.setattr("cairn.llm.kneser_ney.SHARD", 100)
    model = train(docs(*TRAIN))
    assert len(model.pairs.sizes) == -(-sum(len(t or "") for _, t in TRAIN) // 100) > 4
    one = {r.doc_id: r.score for r in score(docs(*TRAIN), train(docs(*TRAIN), shards=1)).collect()}
    assert {r.doc_id: r.score for r in score(docs(*TRAIN), model).collect()} == pytest.approx(one)


def test_a_store_that_is_not_mounted_is_read_through_a_copy(tmp_path, monkeypatch):
    from cairn.llm import arrays

    folder = arrays.Folder(f"file://{tmp_path}/far")
    folder.put("a", np.arange(5, dtype=np.int64))
    folder.put("none", np.empty(0))
    monkeypatch.setattr(arrays.Folder, "__init__", lambda self, uri: self.__dict__.update(uri=uri, local=None))
    arrays._mapped.cache_clear()
    assert arrays.Folder(f"file://{tmp_path}/far").get("a", np.int64).tolist() == [0, 1, 2, 3, 4]
    assert not len(arrays.Folder(f"file://{tmp_path}/far").get("none", np.float64))
    arrays._mapped.cache_clear()
