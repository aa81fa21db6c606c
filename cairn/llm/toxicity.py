"""Toxicity classifier by non-negative positive-unlabelled learning.

A linear model over the presence of words and word beginnings is fitted to confirmed toxic texts and to unlabelled
ones, never to confirmed clean ones. The risk of an unlabelled text counts as that of a clean one; the share of it that
toxic texts of the class prior contribute is subtracted, and where that leaves the clean part of the risk below zero
the step goes the other way, so that the model doesn't learn to call known toxic texts clean. A penalty on absolute
weights keeps the model to few features, so that a long text doesn't add up noise.

The fit uses a bounded sample of rows (:class:`Settings`), the smallest by a hash of the id. Scoring covers all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.memory import lean, small_batches

LETTERS = re.compile(r"[^\W\d_]+")
#: Lengths of word beginnings that are features, besides the word; remembered words; texts at a time; entries of a matrix at a time.
BEGINNINGS, REMEMBERED, ROWS, ENTRIES = (4, 5, 6, 7, 8), 50_000, 256, 500_000


@dataclass(frozen=True)
class Settings:
    """Bounds of the sample and of the fit. A feature is tried if ``least`` toxic texts have it. The steps end
    before the weights have grown out, so the outputs are sharpened before the prior sets their bias."""

    toxic_rows: int = 3000
    unlabelled_rows: int = 9000
    features: int = 20_000
    least: int = 3
    steps: int = 250
    refit_steps: int = 80
    rate: float = 0.05
    penalty: float = 2e-4
    sharpen: float = 2.0
    seed: int = 17


class Features(dict):
    """Feature numbers of words, remembered: hashes of the word and of its beginnings, of those in ``only`` if it is given."""

    def __init__(self, only: frozenset[int] | None = None):
        self.only = only

    def __missing__(self, word: str) -> list[int]:
        names = [word, *(f"{word[:k]}*" for k in BEGINNINGS if len(word) > k)]
        found = [xxhash.xxh3_64_intdigest(n) for n in names]
        if self.only is not None:
            found = [f for f in found if f in self.only]
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found
        return found

    def of(self, text: str | None) -> set[int]:
        return {f for w in set(LETTERS.findall((text or "").lower())) for f in self[w]}


def _packed(found: set[int]) -> np.ndarray:
    return np.sort(np.fromiter(found, np.uint64, len(found)))


@dataclass
class Model:
    weights: dict[int, float]
    bias: float
    #: Log odds of the class prior, for texts without a feature that has a weight.
    prior: float

    def score(self, found: set[int]) -> float:
        z = self.bias + sum(self.weights[f] for f in sorted(found)) if found else self.prior
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


Side = tuple[np.ndarray, np.ndarray]  # a 0/1 matrix: columns row by row, and where each row begins, the end included


def _parts(side: Side) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows of a bounded number of entries at a time: their slice, the entries' columns and rows within the slice."""
    cols, starts = side
    at = 0
    while at < len(starts) - 1:
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + ENTRIES, "right")) - 1)
        yield slice(at, to), cols[starts[at] : starts[to]], np.repeat(np.arange(to - at), np.diff(starts[at : to + 1]))
        at = to


def _outputs(side: Side, w: np.ndarray, b: float) -> np.ndarray:
    return np.concatenate([np.bincount(rows, w[cols], at.stop - at.start) for at, cols, rows in _parts(side)]) + b


def risk(toxic: Side, unlabelled: Side, w: np.ndarray, b: float, prior: float) -> tuple[float, float]:
    """The two parts of the risk: toxic texts called clean, and clean texts called toxic as far as unlabelled ones tell.

    The second is the risk of unlabelled texts as clean ones, less the share that toxic texts of the prior have in it.
    It is an estimate, and below zero where the model fits the toxic texts too closely.
    """
    zp, zu = _outputs(toxic, w, b), _outputs(unlabelled, w, b)
    as_clean = float(np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean())
    return prior * float(np.logaddexp(0, -zp).mean()), as_clean


def risk_gradient(toxic: Side, unlabelled: Side, w: np.ndarray, b: float, prior: float) -> np.ndarray:
    """The way to go, by weight and then by bias: of the sum of both parts the slope, which steps go down; where the second is negative, against the slope of that one alone."""

    def gradient(side: Side, slope: np.ndarray) -> np.ndarray:
        found = np.zeros(len(w))
        for at, cols, rows in _parts(side):
            found += np.bincount(cols, slope[at][rows], len(w))
        return np.append(found, slope.sum()) / len(slope)

    zp, zu = _outputs(toxic, w, b), _outputs(unlabelled, w, b)
    as_clean = gradient(unlabelled, _sigmoid(zu)) - prior * gradient(toxic, _sigmoid(zp))
    if np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean() < 0:
        return -as_clean
    return as_clean - prior * gradient(toxic, _sigmoid(-zp))


def _descend(
    toxic: Side, unlabelled: Side, w: np.ndarray, b: float, prior: float, settings: Settings, steps: int, penalty: float
) -> tuple[np.ndarray, float]:
    """Proximal Adam on the non-negative risk; without a penalty, weights that are zero stay so."""
    free = np.append((w != 0) | (penalty > 0), True)
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        g = risk_gradient(toxic, unlabelled, w, b, prior)
        m = 0.9 * m + 0.1 * g * free
        v = 0.999 * v + 0.001 * (g * free) ** 2
        scale = settings.rate / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        move = scale * m / (1 - 0.9**step)
        w = w - move[:-1]
        b -= float(move[-1])
        if penalty:
            w = np.sign(w) * np.maximum(np.abs(w) - np.minimum(scale[:-1] * penalty, 1.0), 0)
    return w, b


def _prior_shift(z: np.ndarray, prior: float) -> float:
    """What to add to the outputs of unlabelled texts so that their mean score is the class prior."""
    low, high = -30.0, 30.0
    for _ in range(60):
        middle = (low + high) / 2
        if _sigmoid(z + middle).mean() < prior:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def fit(toxic: Iterable[str | None], unlabelled: Iterable[str | None], prior: float, settings: Settings = Settings()) -> Model:
    """Fit by full-batch proximal Adam on the non-negative risk with logistic loss, then set the bias by the prior.

    Without toxic or unlabelled texts, or with no feature of enough toxic texts, every score is the prior. Of the
    texts no more is held than the numbers of their features, of the unlabelled ones those that toxic ones have.
    """
    prior = min(max(prior, 1e-4), 0.9)
    odds = float(np.log(prior / (1 - prior)))
    flat = Model({}, odds, odds)
    numbers = Features()
    known = [_packed(numbers.of(t)) for t in toxic]
    numbers.clear()
    if not known:
        return flat
    names, in_toxic = np.unique(np.concatenate(known), return_counts=True)
    names, in_toxic = names[in_toxic >= settings.least], in_toxic[in_toxic >= settings.least]
    if not len(names):
        return flat

    def positions(found: np.ndarray) -> np.ndarray:
        at = np.searchsorted(names, found).astype(np.int32)
        at[at == len(names)] = 0
        return at[names[at] == found]

    known = [positions(found) for found in known]
    wanted = Features(frozenset(names.tolist()))
    other, in_all = [], np.zeros(len(names), np.int64)
    for t in unlabelled:
        other.append(positions(_packed(wanted.of(t))))
        in_all[other[-1]] += 1
    del wanted
    if not other:
        return flat
    # Most telling first: by how far the share among toxic texts exceeds that among all, in standard errors.
    p, u = in_toxic / len(known), (in_all + 0.5) / (len(other) + 1)
    gap = (p - u) / np.sqrt(u * (1 - np.minimum(u, 0.999)) / len(known))
    chosen = np.sort(np.lexsort((names, -gap))[: settings.features])
    column = np.full(len(names), -1, np.int32)
    column[chosen] = np.arange(len(chosen))
    names = names[chosen]

    def matrix(texts: list[np.ndarray]) -> Side:
        for k, found in enumerate(texts):
            texts[k] = column[found]
            texts[k] = texts[k][texts[k] >= 0]
        return np.concatenate(texts), np.concatenate([[0], np.cumsum([len(found) for found in texts])])

    toxic_side, all_side = matrix(known), matrix(other)
    del known, other
    w, b = _descend(toxic_side, all_side, np.zeros(len(names)), flat.bias, prior, settings, settings.steps, settings.penalty)
    # The penalty has chosen the features; their weights are then fitted without it.
    w, b = _descend(toxic_side, all_side, w, b, prior, settings, settings.refit_steps, 0.0)
    w, b = settings.sharpen * w, settings.sharpen * b
    b += _prior_shift(_outputs(all_side, w, b), prior)
    return Model({int(f): float(x) for f, x in zip(names, w) if x}, b, odds)


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    settings: Settings = Settings(),
) -> Model:
    """Fit to the rows of ``docs`` where ``usable``, an expression over the column ``doc``, holds.

    ``labels`` marks ids; of repeated marks of an id the largest counts, and a null mark is none. Confirmed toxic are
    the rows marked 1, the class prior is their share of the marked usable ids, and all usable rows are unlabelled.
    Without marks the prior is 0, and so every score is close to it. The rows marked toxic and the unlabelled ones that
    are fitted are bounded by ``settings``; the share is that of all marks.
    """
    marks = labels.select(labels[id_col].alias("doc"), labels[label_col].alias("mark")).where("doc is not null and mark is not null")
    marks = marks.where(usable).groupBy("doc").agg(F.max("mark").alias("mark"))
    share = marks.agg(F.avg((F.col("mark") == 1).cast("double")).alias("p")).first()["p"] or 0.0
    base = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("raw")).where(usable)
    draw = F.xxhash64(F.lit(settings.seed), "doc")

    def sample(rows: DataFrame, n: int) -> Iterator[str | None]:
        """Of the rows with the smallest draws; only numbers are ordered, and texts are read for the drawn rows alone."""
        last = rows.select(draw.alias("draw")).orderBy("draw").limit(n).agg(F.max("draw").alias("draw")).first()["draw"]
        if last is not None:
            for row in rows.where(draw <= last).limit(n).select("raw").toLocalIterator():
                yield row["raw"]

    toxic = base.join(marks.where("mark = 1").select("doc"), "doc", "left_semi")
    return fit(sample(toxic, settings.toxic_rows), sample(base, settings.unlabelled_rows), share, settings)


def _score(model: Model):
    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Features(frozenset(model.weights))
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                scores = [model.score(words.of(t)) for t in part["raw"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["doc"], pa.array(scores, pa.float64())], names=["doc", "score"])

    return run


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per row of ``docs``: id, ``score`` (0 to 1), ``predicted`` (1 from ``threshold`` on).

    The whole text counts; a null one is empty; a text without any feature that counts has
    the class prior as score. Repeated rows are scored each, a null
    id stays null, an empty table gives an empty result, other columns are ignored.
    """
    small_batches(docs.sparkSession)
    base = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("raw"))
    found = base.mapInArrow(_score(model), f"doc {base.schema['doc'].dataType.simpleString()}, score double")
    return found.select(F.col("doc").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` with a score below ``threshold``, with all their columns."""
    small_batches(docs.sparkSession)
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].alias("raw"))

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [s for part in _score(model)([pa.RecordBatch.from_arrays([batch["row"], batch["raw"]], names=["doc", "raw"])]) for s in part["score"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["row"].filter(pa.array([s < threshold for s in scores], pa.bool_()))], names=["row"])

    return row.mapInArrow(run, row.select("row").schema).select("row.*")
