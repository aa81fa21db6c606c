"""Benchmark decontamination by spaced-seed hashing, in DataFrame expressions only.

A mask keeps some of the tokens of a span and ignores the rest. Masked spans of every document and of every benchmark
item are hashed and joined; a hit names a document, an item and how far one is shifted against the other. At each such
shift the tokens are compared, and an overlap counts when some window of :data:`WINDOW` tokens of the item is matched
but for :data:`MISSES` substitutions, of which tokens beyond an end of the document are some. The two masks together
hit every such window, wherever the substitutions are: a clean span begins and ends with a kept token, so it lies
within the document. Nothing is lost by looking only around hits.

Items shorter than the window are compared whole, and those shorter than the masks have a mask of their own length
that ignores nothing.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.rows import bounded, matching, row_key
from cairn.session import Workspace

#: Kept positions of the masks. Of the ways to place two misses in thirteen tokens, each leaves one mask a clean span.
MASKS = ("101101011", "11100111")
WINDOW, MISSES = 13, 2
#: Items with fewer tokens than this have a mask of their own.
LEAST = min(map(len, MASKS))


def covered(size: int, misses: int) -> bool:
    """Whether the masks hit ``size`` tokens wherever ``misses`` of them are substituted."""
    spans = [{start + k for k, bit in enumerate(mask) if bit == "1"} for mask in MASKS for start in range(size - len(mask) + 1)]
    return all(any(not span & set(gone) for span in spans) for gone in combinations(range(size), misses))


def tokens(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(found, lambda w: w != ""), lambda w: F.xxhash64(w))


def seeds(words: Column, masks: tuple[str, ...]) -> Column:
    """Hashes of masked spans, by position and then by mask; null where a span goes beyond the end."""
    size, least = F.size(words), min(map(len, masks))

    def at(i: Column) -> Column:
        hashed = []
        for number, mask in enumerate(masks):
            kept = [F.get(words, i + k) for k, bit in enumerate(mask) if bit == "1"]
            hashed.append(F.when(i + len(mask) <= size, F.xxhash64(F.lit(number), *kept)))
        return F.array(*hashed)

    spans = F.transform(F.sequence(F.lit(0), size - least), at)
    return F.when(size >= least, F.flatten(spans)).otherwise(F.array().cast("array<long>"))


def _hits(rows: DataFrame, masks: tuple[str, ...], *keep: str) -> DataFrame:
    found = rows.select(*keep, F.posexplode(seeds(F.col("words"), masks)).alias("p", "seed")).where("seed is not null")
    number = len(masks)
    return found.select(*keep, "seed", (F.col("p") % number).alias("mask"), F.floor(F.col("p") / number).cast("int").alias("at"))


def _compared(words: Column, piece: Column, needed: Column) -> list[Column]:
    """Tokens of the item matched in all and in the best window, and those that an overlap needs."""
    # Positions of the item that the document doesn't reach are null, so they are misses.
    same = F.zip_with(words, piece, lambda a, b: F.when(a == b, 1).otherwise(0))
    width = F.least(F.lit(WINDOW), F.size(words))
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - width + 1),
        lambda k: F.aggregate(F.slice(same, k, width), F.lit(0), lambda s, n: s + n),
    )
    return [
        F.size(words).cast("long").alias("item_tokens"),
        F.aggregate(same, F.lit(0), lambda s, n: s + n).cast("long").alias("matched"),
        F.array_max(windows).cast("long").alias("window_matched"),
        needed.alias("needed"),
    ]


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    short_misses: int = 0,
) -> DataFrame:
    """One row per document and item that overlap: ids, ``item_tokens``, ``matched``, ``window_matched``.

    ``matched`` counts equal tokens over the whole item at one shift, ``window_matched`` those in the best window; each
    is the largest over the shifts that count. An item shorter than the window must be matched whole: one shorter than
    the masks exactly, another but for ``short_misses`` substitutions; a budget that the masks don't cover for the
    items there are is a ValueError. Items without tokens overlap nothing, as do null and empty texts. A null id is an
    id like any other; rows that repeat an id are one document, that has all their overlaps. Empty tables give an empty
    result. Only the two named columns of each table are read, whatever the others are called.
    """
    work = Workspace(docs.sparkSession, "overlaps")
    items = benchmark.select(benchmark[item_col].alias("item"), tokens(benchmark[item_text_col]).alias("words"))
    items = work.save(items.where(F.size("words") > 0).distinct().withColumn("no", F.monotonically_increasing_id()), "items")
    # At most twelve numbers.
    short = [r["n"] for r in items.select(F.size("words").alias("n")).where(F.col("n") < WINDOW).distinct().collect()]
    if uncovered := [n for n in short if n >= LEAST and not covered(n, short_misses)]:
        raise ValueError(f"the masks don't cover {short_misses} substitutions in items of {sorted(uncovered)} tokens")
    own = sorted(n for n in short if n < LEAST)
    masks = (*MASKS, *("1" * n for n in own))
    sought = _hits(items.withColumn("n", F.size("words")), masks, "no", "n").withColumnRenamed("at", "item_at")
    of_length = F.when(F.col("n") >= LEAST, F.col("mask") < len(MASKS)).otherwise(F.col("mask") == len(MASKS) + F.array_position(F.array(*map(F.lit, own or [0])), F.col("n")) - 1)
    sought = work.save(sought.where(of_length).drop("mask"), "seeds")
    key = row_key(docs, id_col, text_col)
    base = docs.select(*[c.alias(n) for n, c in key.items()], docs[text_col].alias("raw"))
    hit = _hits(base.select("i", "x", "y", tokens(F.col("raw")).alias("words")), masks, "i", "x", "y").join(bounded(sought), "seed")
    found = F.struct("no", (F.col("at") - F.col("item_at")).alias("shift"), "n")
    hit = work.save(hit.groupBy("i", "x", "y").agg(F.collect_set(found).alias("found")), "hits")
    # Only numbers have been moved so far; texts with hits are read again, and of their tokens what is to be compared goes on.
    near = matching(base, hit).select("i", tokens(F.col("raw")).alias("words"), "found")

    def piece(f: Column) -> Column:
        reached = F.transform(F.sequence(F.lit(0), f["n"] - 1), lambda j: F.get(F.col("words"), j + f["shift"]))
        return F.struct(f["no"].alias("no"), reached.alias("piece"))

    near = near.select("i", F.inline(F.transform("found", piece)))
    size = items.agg(F.sum(F.size("words"))).first()[0] or 0
    near = near.join(bounded(items, rows=size // 3), "no")
    n = F.size("words")
    needed = F.when(n < LEAST, n).when(n < WINDOW, n - short_misses).otherwise(WINDOW - MISSES)
    checked = near.select("i", "item", *_compared(F.col("words"), F.col("piece"), needed))
    return (
        checked.where("window_matched >= needed")
        .groupBy("i", "item", "item_tokens")
        .agg(F.max("matched").alias("matched"), F.max("window_matched").alias("window_matched"))
        .select(F.col("i").alias(id_col), F.col("item").alias(item_col), "item_tokens", "matched", "window_matched")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **columns: str) -> DataFrame:
    """The rows of ``docs`` that overlap no item, with all their columns."""
    leaked = overlaps(docs, benchmark, id_col=id_col, **columns).select(F.col(id_col).alias("leaked id")).distinct()
    leaked = bounded(Workspace(docs.sparkSession, "decontaminate").save(leaked, "leaked"))
    return docs.join(leaked, docs[id_col].eqNullSafe(leaked["leaked id"]), "left_anti")
