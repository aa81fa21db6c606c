"""An interpolated modified Kneser-Ney bigram model, counted in Spark and scored from memory-mapped arrays.

Tokens are words and one end after each text. Counting goes in two passes over the training texts: word counts give
the vocabulary (a sorted array of word hashes, a word's place being its id), then pairs of ids give the bigrams. Two
aggregates over the bigram arrays give what each context and each continuation needs. Nothing but array sizes and the
counts of counts comes to the driver; a scoring worker maps the arrays into memory and reads the pages it needs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cairn.llm.arrays import RUN_SCHEMA, Counted, Folder, merge, mixed, runs, summed
from cairn.llm.memory import lean, small_batches
from cairn.session import Workspace

#: The end token; it holds white space, so no word equals it.
END = b"\n"
#: Distinct words and pairs that a counting task holds; words that a task remembers.
WORDS, PAIRS, REMEMBERED = 400_000, 4_000_000, 500_000
#: Texts handled at a time, and bytes of them beyond which fewer are.
ROWS, BYTES = 1024, 2_000_000
#: Ids in one file of the arrays by id.
PAGE = 1 << 20
#: Characters of training text for each file of the arrays, so that a task that merges one holds a bounded part.
SHARD = 1 << 25


def words(text: str | None) -> list[bytes]:
    """A-Z in lower case; runs of other than 09-0D and 20."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _hash(found: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in found), np.uint64, len(found))


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    for batch in batches:
        until = np.cumsum(pc.fill_null(pc.binary_length(batch["raw"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(batch):
            before = until[at - 1] if at else 0
            n = min(ROWS, max(1, int(np.searchsorted(until, before + BYTES, "right")) - at))
            part = batch.slice(at, n)
            yield part, [words(t) for t in part["raw"].to_pylist()]
            at += n


def _word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % shards


def _count_words(shards: int):
    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            keys, counts = summed(_hash(list(seen)), np.fromiter(seen.values(), np.int64, len(seen)))
            seen.clear()
            return runs(keys, counts, _word_shard(keys, shards))

        for part, texts in _texts(batches):
            seen.update(chain.from_iterable(texts))
            seen[END] += len(part)
            if len(seen) > WORDS:
                yield from flush()
        if seen:
            yield from flush()

    return run


class Ids:
    """Ids of words in a vocabulary; -1 for a word that isn't in it."""

    def __init__(self, vocabulary: Counted):
        self.vocabulary = vocabulary
        self.known: dict[bytes, int] = {}

    def of(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all tokens with each text's end, and where each text starts."""
        flat: list[bytes] = []
        for found in texts:
            flat += found
            flat.append(END)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set(flat).difference(self.known))
        if new:
            hashes = _hash(new)
            place, _ = self.vocabulary.find(hashes, _word_shard(hashes, len(self.vocabulary.sizes)))
            self.known.update(zip(new, place.tolist()))
        ids = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        starts = np.concatenate([[0], np.cumsum([len(f) + 1 for f in texts])])[:-1]
        return ids, starts


def _contexts(ids: np.ndarray, starts: np.ndarray, first: int) -> np.ndarray:
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[starts] = first
    return before


def _pair_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """By context and four bits of the continuation: a frequent context lies in many shards, a rare one in few."""
    return (mixed((keys >> np.uint64(32) << np.uint64(4)) | (keys & np.uint64(15))) >> np.uint64(20)).astype(np.int64) % shards


def _count_pairs(vocabulary: Counted, shards: int):
    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, size = Ids(vocabulary), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate(held)
            keys, counts = summed(keys, np.ones(len(keys), np.int64))
            return runs(keys, counts, _pair_shard(keys, shards))

        for _, texts in _texts(batches):
            token, starts = ids.of(texts)
            before = _contexts(token, starts, len(vocabulary))
            held.append((before.astype(np.uint64) << np.uint64(32)) | token.astype(np.uint64))
            size += len(token)
            if size > PAIRS:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return run


def _statistics(pairs: Counted):
    """By word id: as a context, its continuations seen once, twice and more often; as a continuation, its contexts."""

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch["id"].to_pylist():
                keys, counts = pairs.shard(number)
                if not len(keys):
                    continue
                context = (keys >> np.uint64(32)).astype(np.int64)
                at = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
                seen = [np.add.reduceat(x.astype(np.int64), at) for x in (counts == 1, counts == 2, counts > 2)]
                zero = np.zeros(len(at), np.int64)
                yield _stat_rows(context[at], *seen, zero)
                word, contexts = summed((keys & np.uint64(0xFFFFFFFF)).astype(np.int64), np.ones(len(keys), np.int64))
                zero = np.zeros(len(word), np.int64)
                yield _stat_rows(word, zero, zero, zero, contexts)
                few = np.bincount(np.minimum(counts, 5), minlength=6)[1:5]
                yield _stat_rows(np.array([-1]), *(few[k : k + 1] for k in range(4)))

    return run


STATISTICS = ["id", "once", "twice", "more", "contexts"]


def _stat_rows(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=STATISTICS)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """The three discounts from the numbers of n-grams seen once to four times; plain ones where those are too few."""
    if min(n) <= 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)]
    return tuple(d if 0 < d < k + 1 else (k + 1) / 2 for k, d in enumerate(found))


def _pages(uri: str, d: tuple, lower: tuple, total: int, size: int, totals: Counted, first_total: int):
    """Write the arrays by id: ``weight`` of a context's lower order, ``lower`` probability of a word."""

    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder, page, held = Folder(uri), None, []

        def close() -> pa.RecordBatch:
            n = min(PAGE, size + 1 - page * PAGE)
            ids, once, twice, more, contexts = (np.concatenate(c) for c in zip(*held))
            seen = context_totals(totals, ids, first_total)
            weight, low = np.ones(n), np.full(n, lower[3] / (size + 1))
            has = once + twice + more > 0
            left = d[0] * once + d[1] * twice + d[2] * more
            weight[ids[has] - page * PAGE] = left[has] / seen[has]
            word = contexts > 0
            less = contexts - np.choose(np.minimum(contexts, 3), [0.0, *lower[:3]])
            low[ids[word] - page * PAGE] += np.maximum(less[word], 0) / total
            folder.put(f"{page}.weight", weight)
            folder.put(f"{page}.lower", low)
            return pa.RecordBatch.from_arrays([pa.array([page], pa.int64())], names=["page"])

        for batch in batches:
            columns = [batch[c].to_numpy(zero_copy_only=False) for c in STATISTICS]
            pages = columns[0] // PAGE
            for number in np.unique(pages).tolist():
                if number != page:
                    if held:
                        yield close()
                    page, held = number, []
                held.append([c[pages == number] for c in columns])
        if held:
            yield close()

    return run


def context_totals(vocabulary: Counted, ids: np.ndarray, first_total: int) -> np.ndarray:
    """How often each id is a context: as often as it is a token (ends have no continuation and never ask)."""
    out = np.full(len(ids), first_total, np.float64)
    by = np.argsort(ids, kind="stable")
    edge = np.searchsorted(ids[by], vocabulary.starts)
    for number in np.flatnonzero(np.diff(edge)).tolist():
        at = by[edge[number] : edge[number + 1]]
        out[at] = vocabulary.shard(number)[1][ids[at] - vocabulary.starts[number]]
    return out


@dataclass
class Model:
    """A trained model; its arrays stay in the shared folder."""

    vocabulary: Counted
    pairs: Counted
    pages: str
    texts: int
    discounts: tuple
    unknown: float

    @property
    def tokens(self) -> int:
        return self.vocabulary.total

    def by_id(self, name: str, ids: np.ndarray) -> np.ndarray:
        out, folder = np.ones(len(ids)), Folder(self.pages)
        if not len(self.vocabulary):
            return out
        page = ids // PAGE
        for number in np.unique(page[ids >= 0]).tolist():
            at = np.flatnonzero((page == number) & (ids >= 0))
            out[at] = folder.get(f"{number}.{name}", np.float64)[ids[at] - number * PAGE]
        return out


def train(docs: DataFrame, *, text_col: str = "text", shards: int | None = None) -> Model:
    """Count ``docs`` and write the model. Null text is an empty one, which is an end; no rows give a uniform model.

    ``shards``: files of the arrays; None takes the session's number of shuffle partitions, or as many more as the
    length of all texts asks for.
    """
    spark = docs.sparkSession
    small_batches(spark)
    root = Workspace(spark, "kneser-ney").root
    raw = docs.select(docs[text_col].alias("raw"))
    if not shards:
        chars = raw.agg(F.sum(F.length("raw"))).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // SHARD))
    vocabulary = merge(raw.mapInArrow(_count_words(shards), RUN_SCHEMA), f"{root}/words", shards)
    if len(vocabulary) >= 2**32 - 1:
        raise ValueError(f"{len(vocabulary)} distinct words don't fit 32-bit ids")
    pairs = merge(raw.mapInArrow(_count_pairs(vocabulary, shards), RUN_SCHEMA), f"{root}/pairs", shards)
    end = _hash([END])
    _, texts = vocabulary.find(end, _word_shard(end, shards))
    sums = [F.sum(c).cast("long").alias(c) for c in STATISTICS[1:]]
    by_id = spark.range(shards, numPartitions=shards).mapInArrow(_statistics(pairs), ", ".join(f"{c} long" for c in STATISTICS)).groupBy("id").agg(*sums)
    work = Workspace(spark, "kneser-ney-sums")
    by_id = work.save(by_id, "by-id")
    top = by_id.where("id = -1").first()
    d = discounts([top[c] for c in STATISTICS[1:]] if top else [0] * 4)
    few = {r["contexts"]: r["n"] for r in by_id.where("id >= 0 and contexts between 1 and 4").groupBy("contexts").agg(F.count(F.lit(1)).alias("n")).collect()}
    lower = discounts([few.get(k, 0) for k in range(1, 5)])
    kinds = len(vocabulary)
    many = kinds - few.get(1, 0) - few.get(2, 0)
    total = len(pairs)
    spare = (lower[0] * few.get(1, 0) + lower[1] * few.get(2, 0) + lower[2] * many) / total if total else 1.0
    if Folder(f"{root}/pages").local:
        Folder(f"{root}/pages").put("written", np.empty(0))
    page = (F.col("id") / PAGE).cast("long")
    by_id.where("id >= 0").repartition(shards, page).sortWithinPartitions("id").mapInArrow(
        _pages(f"{root}/pages", d, (*lower, spare), total, kinds, vocabulary, int(texts[0])), "page long"
    ).collect()
    return Model(vocabulary, pairs, f"{root}/pages", int(texts[0]), d, spare / (kinds + 1))


def _score(model: Model, kind: pa.DataType):
    @lean
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, size, total = Ids(model.vocabulary), len(model.vocabulary), model.tokens
        d1, d2, d3 = model.discounts
        for part, texts in _texts(batches):
            token, starts = ids.of(texts)
            before = _contexts(token, starts, size)
            known, seen = token >= 0, before >= 0
            both = np.flatnonzero(known & seen)
            keys = (before[both].astype(np.uint64) << np.uint64(32)) | token[both].astype(np.uint64)
            count = np.zeros(len(token))
            count[both] = model.pairs.find(keys, _pair_shard(keys, len(model.pairs.sizes)))[1]
            lower = np.where(known, model.by_id("lower", token), model.unknown)
            p = np.where(seen, model.by_id("weight", before), 1.0) * lower
            counts = np.zeros(len(token))
            counts[known] = context_totals(model.vocabulary, token[known], model.texts)
            # A context is the token before, or the start of a text, of which there are as many as texts.
            as_context = _contexts(counts, starts, model.texts)
            hit = np.flatnonzero(count)
            less = count[hit] - np.choose(np.minimum(count[hit], 3).astype(int) - 1, [d1, d2, d3])
            p[hit] += np.maximum(less, 0) / as_context[hit]
            base = np.log10((counts + 1) / (total + size + 1))
            n = np.diff(np.append(starts, len(token)))
            columns = [n, np.add.reduceat(known.astype(np.int64), starts), np.add.reduceat(base, starts), np.add.reduceat(np.log10(p), starts)]
            yield pa.RecordBatch.from_arrays([part["id"].cast(kind), *map(pa.array, columns)], names=["id", "n_tokens", "n_known", "base_score", "score"])

    return run


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``perplexity``.

    ``score`` is the model's log10 probability of the text with its end, ``base_score`` that of add-one smoothed word
    counts. Null text counts as empty: one token, its end. Repeated rows are scored each; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    base = docs.select(docs[id_col].alias("id"), docs[text_col].alias("raw"))
    kind = base.schema["id"].dataType
    shape = f"id {kind.simpleString()}, n_tokens long, n_known long, base_score double, score double"
    found = base.mapInArrow(_score(model, to_arrow_type(kind)), shape)
    return found.select(
        F.col("id").alias(id_col),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
