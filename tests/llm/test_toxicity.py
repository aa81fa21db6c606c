import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm.toxicity import Features, Settings, drop_toxic, fit, risk, risk_gradient, score, train

WORDS = [a + b + c for a in ("ka", "lo", "mi", "re") for b in ("na", "so", "ti") for c in ("b", "d", "g", "p")]


def text(rng, toxic):
    found = [rng.choice(WORDS) for _ in range(rng.randint(20, 80))]
    if toxic:
        for _ in range(rng.randint(1, 3)):
            found[rng.randrange(len(found))] = rng.choice(["Vilex", "grubb!", "vilexer"])
    return " ".join(found)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    return [(i, text(rng, i % 8 == 0), int(i % 8 == 0)) for i in range(800)]


def test_held_out_accuracy(corpus, docs, spark):
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus if i % 2], "doc_id long, toxic int").union(
        spark.createDataFrame([(i, y) for i, _, y in corpus if not i % 2], "doc_id long, toxic int")
    )
    table = docs(*[(i, t) for i, t, _ in corpus])
    model = train(table, labels, F.expr("doc % 5 <> 0"))
    found = {r.doc_id: r for r in score(table, model).collect()}
    held = [(i, y) for i, _, y in corpus if i % 5 == 0]
    right = sum((found[i].predicted == 1) == (y == 1) for i, y in held)
    assert right / len(held) > 0.95 and all(0 <= r.score <= 1 for r in found.values())
    left = {r.doc_id for r in drop_toxic(table, model).collect()}
    assert left == {i for i, r in found.items() if not r.predicted}
    assert drop_toxic(table, model).columns == table.columns


def test_never_learns_from_clean_labels(corpus):
    toxic = [t for _, t, y in corpus if y]
    model = fit(toxic, [t for _, t, _ in corpus], 1 / 8, Settings(steps=80, refit_steps=20))
    words = Features(frozenset(model.weights))
    assert model.score(words.of("vilex " + WORDS[0])) > model.score(words.of(WORDS[0]))


def test_defined_without_positives_and_for_odd_rows(docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    table = docs((1, None), (2, ""), (None, "a"), (2, ""), (3, "b " * 20_000))
    model = train(table, none, F.lit(True))
    found = score(table, model).collect()
    assert len(found) == 5 and len({r.score for r in found}) == 1 and all(r.predicted == 0 for r in found)
    assert score(docs(), model).count() == 0
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, toxic int")
    assert 0 <= score(table, train(table, odd, F.lit(True))).first().score <= 1


def test_the_fit_tries_all_features_within_its_bounds(monkeypatch):
    settings = Settings(steps=2, refit_steps=1)
    assert (settings.toxic_rows, settings.unlabelled_rows, settings.features) == (3000, 9000, 20_000)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c for a in letters[:20] for b in letters for c in letters[:24]]  # no beginnings besides the word
    tried = []
    monkeypatch.setattr("cairn.llm.toxicity._descend", lambda toxic, unlabelled, w, b, *rest: tried.append(len(w)) or (w, b))
    fit([" ".join(words)] * 3, [" ".join(words[:9]), None], 0.1, settings)
    assert tried == [len(words)] * 2 and len(words) > 12_000


def test_parts_of_a_matrix_change_nothing(corpus, monkeypatch):
    toxic, all_ = [t for _, t, y in corpus if y], [t for _, t, _ in corpus]
    settings = Settings(steps=40, refit_steps=10)
    whole = fit(toxic, all_, 1 / 8, settings)
    monkeypatch.setattr("cairn.llm.toxicity.ENTRIES", 50)
    parts = fit(toxic, all_, 1 / 8, settings)
    assert parts.weights == pytest.approx(whole.weights) and parts.bias == pytest.approx(whole.bias)


def side(matrix):
    return np.concatenate([np.flatnonzero(r) for r in matrix]), np.concatenate([[0], np.cumsum(matrix.sum(axis=1))])


def test_risk_and_gradient_by_their_definitions():
    rng = np.random.default_rng(7)
    toxic, unlabelled, prior = rng.integers(0, 2, (7, 5)), rng.integers(0, 2, (20, 5)), 0.2

    def parts(x):
        zp, zu = toxic @ x[:5] + x[5], unlabelled @ x[:5] + x[5]
        loss = lambda z, y: np.mean([np.log(1 + np.exp(-v if y else v)) for v in z])
        return prior * loss(zp, 1), loss(zu, 0) - prior * loss(zp, 0)

    signs = set()
    for scale in (0.3, 1.0, 6.0):
        for _ in range(12):
            x = rng.normal(0, scale, 6)
            if scale == 6.0:
                x = np.append(np.linalg.lstsq(np.vstack([toxic, unlabelled]), np.append(np.full(7, 20.0), np.full(20, -20.0)), rcond=None)[0], -4.0) * rng.uniform(0.5, 2)
            known, clean = parts(x)
            assert risk(side(toxic), side(unlabelled), x[:5], x[5], prior) == pytest.approx((known, clean))
            step = np.eye(6) * 1e-6
            slope = np.array([[(a - b) / 2e-6 for a, b in zip(parts(x + e), parts(x - e))] for e in step]).T
            want = -slope[1] if clean < 0 else slope[0] + slope[1]
            assert risk_gradient(side(toxic), side(unlabelled), x[:5], x[5], prior) == pytest.approx(want, abs=1e-6)
            signs.add(clean < 0)
    # Toxic texts that unlabelled ones never resemble: the estimate of the clean part falls below zero, and the sign turns.
    alone, rest = np.array([[1, 0]] * 5), np.array([[0, 1]] * 10)
    assert risk(side(alone), side(rest), np.array([5.0, -5.0]), 0.0, 0.4)[1] < 0
    g = risk_gradient(side(alone), side(rest), np.array([5.0, -5.0]), 0.0, 0.4)
    assert g[0] > 0  # a step goes down: the toxic feature loses weight
    assert False in signs
