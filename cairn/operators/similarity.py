"""Similarity operators: overlaps, orientation, roll-ups, fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.scalars import best_of, half_even_percent, truncated_percent
from cairn.operators import fingerprints as fingerprints_
from cairn.operators import sets
from cairn.session import Workspace

#: Keys of at most so many items are met by pairs of their items, whose number grows with the square; larger ones by single items.
PAIRED = 32
#: Pairs of keys of at most so many that they are broadcast to where their items are.
MET = 1 << 18


def multiset_overlap_edges(
    items: DataFrame, *, key: str, item: str, min_score: int = 0, between: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Similarity of every two keys that share an item: ``query``, ``target``, ``pli_qcov``, ``pli_unique_qcov``.

    ``pli_qcov`` is the share of the query's items, with repeats, that the target has as often; ``pli_unique_qcov``
    the share of its kinds of items; both from 0 to 100, rounded half to even. Keys meet by an equi-join on the item,
    each two of them once; counts are summed on the map side, both directions are made of the sum, and keys without a
    shared item cost nothing. ``between``, two one-column tables of keys, keeps to pairs with one key in each, and only
    those are joined. A ``min_score`` over 50 without ``between`` meets few pairs but those that reach it.
    """
    if min_score > 50 and between is None:
        return _close_edges(items.select(F.col(key).alias("key"), F.col(item).alias("item")).where("key is not null and item is not null"), min_score)
    counts = items.where(F.col(item).isNotNull()).groupBy(key, item).agg(F.count(F.lit(1)).alias("n"))
    a = counts.select(F.col(key).alias("a"), F.col(item).alias("i"), F.col("n").alias("na"))
    b = counts.select(F.col(key).alias("b"), F.col(item).alias("i"), F.col("n").alias("nb"))
    sizes = counts.groupBy(key).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    distinct = F.col("a") < F.col("b")
    if between is not None:
        left, right = (t.select(F.col(t.columns[0]).alias(n)).distinct() for t, n in zip(between, ("a", "b")))
        a, b, distinct = a.join(left, "a", "left_semi"), b.join(right, "b", "left_semi"), F.col("a") != F.col("b")
    shared = a.join(b, "i").where(distinct).groupBy("a", "b").agg(F.sum(F.least("na", "nb")).alias("common"), F.count(F.lit(1)).alias("common_kinds"))
    for side in ("a", "b"):
        own = sizes.select(F.col(key).alias(side), F.col("total").alias(f"total_{side}"), F.col("kinds").alias(f"kinds_{side}"))
        shared = shared.join(own, side)

    def direction(query: str, target: str) -> Column:
        return F.struct(
            F.col(query).alias("query"),
            F.col(target).alias("target"),
            half_even_percent(F.col("common") / F.col(f"total_{query}")).cast("int").alias("pli_qcov"),
            half_even_percent(F.col("common_kinds") / F.col(f"kinds_{query}")).cast("int").alias("pli_unique_qcov"),
        )

    both = F.array(direction("a", "b"), direction("b", "a"))
    if min_score:
        both = F.filter(both, lambda e: e["pli_qcov"] >= min_score)
    found = shared.select(F.inline(both))
    return found.distinct() if between is not None else found  # a pair within both tables is met from either side


def _close_edges(items: DataFrame, least: int) -> DataFrame:
    """The edges whose ``pli_qcov`` is at least ``least``, over 50; ``items`` has key and item, neither null.

    A query of one item is met by whatever has that item, and all of that are edges. Any other shares at least two
    items with its targets, repeats counted: if it has n and needs c, any n - c + 2 of them hold two of the common ones.
    So pairs of those are joined with the pairs of each target's items, by hash, and what meets is compared exactly.
    Pairs with a key of over :data:`PAIRED` items are joined by single items.
    """
    work = Workspace(items.sparkSession, "overlap")
    kinds_of = {c: items.schema[c].dataType.simpleString() for c in ("key", "item")}
    rows = items.select("key", "item", F.xxhash64("item").alias("hash")).repartition("key").sortWithinPartitions("key", "item")
    every = rows.mapInArrow(sets.gathered(PAIRED), f"key {kinds_of['key']}, items array<{kinds_of['item']}>, tokens array<bigint>")
    every = work.save(every.withColumn("n", F.size("items")), "held")
    large = every.where("items is null").select("key")
    some_large = not large.isEmpty()
    held = every.where("items is not null")

    one = held.where("n = 1").select(F.col("key").alias("query"), F.element_at("items", 1).alias("item"))
    kinds = held.select(F.col("key").alias("target"), F.explode(F.array_distinct("items")).alias("item"))
    found = one.join(kinds, "item").where("query <> target").select("query", "target", F.lit(100).alias("pli_qcov"), F.lit(100).alias("pli_unique_qcov"))

    def pairs(name: str, of: int = 0) -> DataFrame:
        return held.where("n > 1").select("key", "n", "tokens").mapInArrow(sets.token_pairs(name, of), f"{name} {kinds_of['key']}, pair bigint")

    met = work.save(pairs("query", least).join(pairs("target"), "pair").where("query <> target").select("query", "target").distinct(), "met")
    few_met = met.count() <= MET
    met = F.broadcast(met) if few_met else met
    for side in ("query", "target"):
        few = met.join(held.select(F.col("key").alias(side), F.col("items").alias(f"{side} items")), side)
        met = F.broadcast(few) if few_met and side == "query" else few

    def numbered(name: str) -> Column:
        return F.transform(name, lambda x, i: F.struct(x.alias("x"), (i + 1 - F.array_position(name, x)).alias("k")))

    common = F.size(F.array_intersect(numbered("query items"), numbered("target items"))) / F.size("query items")
    common_kinds = F.size(F.array_intersect("query items", "target items")) / F.size(F.array_distinct("query items"))
    scores = [half_even_percent(x).cast("int").alias(name) for x, name in ((common, "pli_qcov"), (common_kinds, "pli_unique_qcov"))]
    found = found.union(met.select("query", "target", *scores).where(F.col("pli_qcov") >= least))
    if some_large:
        keys = items.select("key")
        found = found.union(multiset_overlap_edges(items, key="key", item="item", min_score=least, between=(large, keys)))
    return found


def oriented(edges: DataFrame, queries: DataFrame, targets: DataFrame, *, query: str = "query", target: str = "target") -> DataFrame:
    """Edges between the two sets of ids, turned so that the member of ``targets`` is the query.

    ``queries`` and ``targets`` are one-column tables of distinct ids. An edge of two members of both sets appears
    once in each direction that it is stored in.
    """
    a = queries.select(F.col(queries.columns[0]).alias("a")).distinct()
    b = targets.select(F.col(targets.columns[0]).alias("b")).distinct()
    forward = edges.join(a, F.col(query) == F.col("a"), "left_semi").join(b, F.col(target) == F.col("b"), "left_semi")
    backward = edges.join(b, F.col(query) == F.col("b"), "left_semi").join(a, F.col(target) == F.col("a"), "left_semi")
    rest = [c for c in edges.columns if c not in (query, target)]
    turned = forward.select(F.col(target).alias(query), F.col(query).alias(target), *rest)
    return turned.unionByName(backward.select(query, target, *rest))


def best_match(edges: DataFrame, *, by: str = "query", other: str = "target", score: str) -> DataFrame:
    """The edge with the highest score by ``by``; of equal ones that with the smallest ``other``."""
    rest = F.struct(*[c for c in edges.columns if c != by])
    best = F.min_by(rest, F.struct((-F.col(score).cast("double")).alias("s"), F.col(other).alias("o")))
    return edges.where(F.col(score).isNotNull()).groupBy(by).agg(best.alias("best row")).select(by, "`best row`.*")


def cross_similarity(edges: DataFrame, queries: DataFrame, targets: DataFrame, *, query: str = "query", target: str = "target", score: str) -> DataFrame:
    """For each member of ``targets`` its most similar member of ``queries``, in either direction of the score."""
    return best_match(oriented(edges, queries, targets, query=query, target=target), by=query, other=target, score=score)


def multi_metric(scores: DataFrame, criteria: dict[str, float], *, keys: Sequence[str] = ("query", "target"), metric: str = "metric", score: str = "similarity") -> DataFrame:
    """Pairs that reach every metric's threshold, a column by metric. Rows that reach none are never shuffled."""
    some = F.lit(False)
    for name, least in criteria.items():
        some = some | ((F.col(metric) == name) & (F.col(score) >= least))
    wide = scores.where(some).groupBy(*keys).pivot(metric, list(criteria)).agg(F.max(score))
    for name, least in criteria.items():
        wide = wide.where(F.col(f"`{name}`") >= least)
    return wide


def select_links(
    scores: DataFrame, criteria: dict[str, float], ranking: DataFrame, *, most: int = 5, ascending: bool = True
) -> DataFrame:
    """Links of systems to structures of other entries that meet all criteria: reference_system_id, id, the metrics, sort_score, rank.

    ``scores`` has query_system, target_system, metric and similarity; ``ranking`` target_id (what stands before the first
    ``_`` of a target) and sort_score, a resolution (ascending) or confidence (descending). Targets without a score are
    left out; of each system the ``most`` best stay, equal ones by id.
    """
    wide = multi_metric(scores, criteria, keys=("query_system", "target_system"))
    wide = wide.where(F.left("query_system", F.lit(4)) != F.left("target_system", F.lit(4)))
    rows = wide.withColumn("target_id", F.substring_index("target_system", "_", 1)).join(ranking.where("sort_score is not null"), "target_id")
    order = [F.asc("sort_score") if ascending else F.desc("sort_score"), F.asc("target_system")]
    rank = F.row_number().over(Window.partitionBy("query_system").orderBy(*order))
    found = rows.withColumn("rank", rank).where(F.col("rank") <= most)
    return found.withColumnsRenamed({"query_system": "reference_system_id", "target_system": "id"}).drop("target_id")


def melt(df: DataFrame, metrics: Sequence[str], *, keys: Sequence[str], metric: str = "metric", value: str = "similarity") -> DataFrame:
    """A row by metric with its percent, rounded half to even; null scores give none."""
    rows = F.array(*[F.struct(F.lit(m).alias(metric), half_even_percent(F.col(m)).cast("int").alias(value)) for m in metrics])
    return df.select(*keys, F.inline(rows)).where(F.col(value).isNotNull())


def means_in_order(df: DataFrame, values: Sequence[str], *, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The mean of each of ``values`` by ``keys``, added up in an order, since sums of binary fractions depend on it. Nulls are left out.

    The rows of a group stream through one task and may spill; they aren't held.
    """
    so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumns({f"sum of {v}": F.sum(v).over(so_far) for v in values})
    at = F.struct(*order)
    return rows.groupBy(*keys).agg(*[(F.max_by(f"sum of {v}", at) / F.nullif(F.count(v), F.lit(0))).alias(v) for v in values])


def combine_sources(left: DataFrame, right: DataFrame, *, keys: Sequence[str], score: str, names: tuple[str, str]) -> DataFrame:
    """The better of two searches' scores and which gave it."""
    a = left.select(*keys, F.col(score).alias("a"))
    b = right.select(*keys, F.col(score).alias("b"))
    value, source = best_of({names[0]: F.col("a"), names[1]: F.col("b")})
    return a.join(b, list(keys), "full_outer").select(*keys, value.alias(score), source.alias("source"))


def chain_rollup(pairs: DataFrame, *, keys: Sequence[str], score: str, length: str, size: str) -> DataFrame:
    """Scores of chain pairs by system pair: ``_max``; ``_weighted_max``, of the pair with the largest score × length;
    ``_weighted_sum`` over ``size``, the system's length. Pairs are one mapping, each chain at most once.
    """
    weight = F.col(score) * F.col(length)
    return pairs.groupBy(*keys).agg(
        F.max(score).alias(f"{score}_max"),
        F.max(F.struct(weight.alias("w"), F.col(score).alias("s")))["s"].alias(f"{score}_weighted_max"),
        (F.sum(weight) / F.max(size)).alias(f"{score}_weighted_sum"),
    )


def greedy_mapping(pairs: DataFrame, *, keys: Sequence[str], left: str, right: str, score: str) -> DataFrame:
    """One-to-one chain mapping by system pair: again and again the best pair of chains that are both still free.

    Equal scores go by ``left``, then ``right``; scores that aren't positive map nothing. Columns: keys, left, right,
    score. A group is the chain pairs of two systems, so it is bounded by their numbers of chains.
    """
    pairs = pairs.where((F.col(score) > 0) & F.col(left).isNotNull() & F.col(right).isNotNull())
    one = F.struct((-F.col(score)).alias("s"), F.col(left).alias("l"), F.col(right).alias("r"))
    grouped = pairs.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("pairs"))
    kind = grouped.schema["pairs"].dataType.simpleString()

    def choose(kept: Column, p: Column) -> Column:
        taken = F.exists(kept, lambda k: (k["l"] == p["l"]) | (k["r"] == p["r"]))
        return F.when(taken, kept).otherwise(F.array_append(kept, p))

    chosen = F.aggregate("pairs", F.array().cast(kind), choose)
    found = grouped.select(*keys, F.inline(chosen))
    return found.select(*keys, F.col("l").alias(left), F.col("r").alias(right), (-F.col("s")).alias(score))


def bit_sets(vectors: DataFrame, *, key: str, vector: str) -> DataFrame:
    """Positions of the positive entries of each vector."""
    bits = F.filter(F.transform(vector, lambda x, i: F.when(x > 0, i)), lambda i: i.isNotNull())
    return vectors.select(F.col(key).alias("key"), bits.alias("bits"))


def tanimoto_top_k(fingerprints: DataFrame, queries: DataFrame, *, k: int, key: str = "key", bits: str = "bits") -> DataFrame:
    """The ``k`` fingerprints most similar to each query: ``query``, ``target``, ``similarity`` (cut to whole percent).

    Both tables have an id, once, and the array of its set bits. They are written in chunks, and every two chunks are
    compared as arrays, which gives ``k`` rows by query and chunk of targets; no pair of fingerprints is a row before that.
    Pairs without a common bit don't count. Equal ones go by target; a query is not its own target.
    """
    work = Workspace(fingerprints.sparkSession, "fingerprints")

    def packed(df: DataFrame, side: str, most: int) -> DataFrame:
        rows = df.select(F.col(key).alias("key"), F.size(bits).alias("n"), F.array_compact(bits).alias("bits")).where("key is not null and n > 0")
        kinds = {"key": rows.schema["key"].dataType.simpleString(), "n": "int", "size": "int", "bits": rows.schema["bits"].dataType.elementType.simpleString()}
        parts = rows.count() // most + 1
        return work.save(rows.repartition(parts).mapInArrow(fingerprints_.chunks(side, most), ", ".join(f"`{side} {c}` array<{t}>" for c, t in kinds.items())), "chunks")

    t, q = packed(fingerprints, "t", fingerprints_.TARGETS), packed(queries, "q", fingerprints_.QUERIES)
    names = [f"{name} {x.schema[f'{side} key'].dataType.elementType.simpleString()}" for name, side, x in (("query", "q", q), ("target", "t", t))]
    common = t.crossJoin(q).mapInArrow(fingerprints_.nearest(k), ", ".join([*names, "nq int, nt int, c bigint"]))
    score = truncated_percent(F.col("c") / (F.col("nq") + F.col("nt") - F.col("c"))).alias("similarity")
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), "target")
    ranked = common.select("query", "target", score).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k)


def aligned_positions(alignments: DataFrame, *, keys: Sequence[str], query: str, target: str, query_start: str, target_start: str) -> DataFrame:
    """Residue pairs of gapped alignments: ``query_pos`` and ``target_pos``, gaps taking no position."""
    rows = alignments.select(*keys, F.col(query_start).alias("q0"), F.col(target_start).alias("t0"), F.col(query).alias("qs"), F.col(target).alias("ts"))
    at = F.sequence(F.lit(1), F.length("qs"))
    pieces = F.transform(
        at,
        lambda i: F.struct(
            F.substring("qs", i, F.lit(1)).alias("query_residue"),
            F.substring("ts", i, F.lit(1)).alias("target_residue"),
            (F.col("q0") + F.length(F.regexp_replace(F.substring("qs", F.lit(1), i - 1), "-", ""))).alias("query_pos"),
            (F.col("t0") + F.length(F.regexp_replace(F.substring("ts", F.lit(1), i - 1), "-", ""))).alias("target_pos"),
        ),
    )
    return rows.select(*keys, F.inline(pieces)).where("query_residue <> '-' and target_residue <> '-'")


def pocket_scores(aligned: DataFrame, query_pocket: DataFrame, target_pocket: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Pocket scores of aligned residues: over the query's pocket, and (``_qcov``) over residues in both pockets.

    ``aligned`` has keys, ``query_pos``, ``target_pos``, ``same`` (0/1) and ``lddt``; the pockets have a system and a
    position, under the names of the keys (query, target) and of the positions.
    """
    q, t = keys
    in_query = aligned.join(query_pocket.distinct(), [q, "query_pos"], "left_semi")
    size = query_pocket.distinct().groupBy(q).agg(F.count(F.lit(1)).alias("n"))
    both = target_pocket.distinct().withColumn("in_both", F.lit(True))
    rows = in_query.join(both, [t, "target_pos"], "left").join(size, q)
    shared = F.coalesce("in_both", F.lit(False))

    def share(value: Column, name: str) -> Column:
        return (F.sum(value.cast("double")) / F.max("n")).alias(name)

    return rows.groupBy(q, t).agg(
        share(F.col("lddt"), "pocket_lddt"),
        share(F.col("same"), "pocket_fident"),
        share(F.when(shared, 1).otherwise(0), "pocket_qcov"),
        share(F.when(shared, F.col("lddt")).otherwise(0), "pocket_lddt_qcov"),
        share(F.when(shared, F.col("same")).otherwise(0), "pocket_fident_qcov"),
    )
