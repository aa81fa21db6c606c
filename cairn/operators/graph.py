"""Graph operators on edge tables: components, strong components, degree, k-hop neighbours."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.operators import moves
from cairn.operators.ordered import numbered_rows
from cairn.session import Workspace

#: Links of a component, or of a range, that a task holds as arrays.
HELD = 1 << 20
#: Vertices of whose labels the driver, and every worker, holds an array.
NUMBERED = 1 << 24


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def connected_components(
    edges: DataFrame, *, src: str = "src", dst: str = "dst", max_rounds: int = 60
) -> DataFrame:
    """Label every vertex of ``edges`` with the smallest vertex id it can reach, ignoring direction.

    Alternates large-star and small-star steps, each one aggregate and one equi-join, so that no vertex's
    neighbours are ever gathered in one place; a hub's rows can be split by the adaptive skew join. Every round is
    written to the shared folder. Self loops keep their vertex; rows with a null end are ignored; an empty input
    gives an empty result. Columns: ``node``, ``component`` (both of the type of ``src``).
    """
    spark = edges.sparkSession
    work = Workspace(spark, "components")
    kind = edges.schema[src].dataType
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).cast(kind).alias("v")).where("u is not null and v is not null")
    pairs = work.save(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "pairs")
    vertices = work.save(
        pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct(), "vertices"
    )
    current = work.save(pairs.where("u <> v"), "edges")
    work.drop(pairs)
    seen = _signature(current)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = work.save(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(low, "u")
        small = (
            linked.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        small = work.save(small, "small")
        work.drop(large)
        work.drop(current)
        current, before = small, seen
        seen = _signature(current)
        if seen == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return vertices.join(current.select(F.col("u").alias("node"), F.col("v").alias("low")), "node", "left").select(
        "node", F.coalesce("low", "node").alias("component")
    )


def undirected(edges: DataFrame, *, src: str = "src", dst: str = "dst") -> DataFrame:
    """Each linked pair once in each direction, without self loops."""
    a = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where("src <> dst")
    return a.union(a.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def degrees(edges: DataFrame, *, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct neighbours of every vertex, whatever the direction."""
    return undirected(edges, src=src, dst=dst).groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree"))


def neighbours(edges: DataFrame, starts: DataFrame, depth: int, *, src: str = "src", dst: str = "dst") -> DataFrame:
    """Vertices within ``depth`` links of each start: ``start``, ``node``, ``distance``; a start is not its own neighbour.

    ``starts`` is a one-column table. Each step joins the last frontier only, so a vertex is expanded once by start.
    """
    work = Workspace(edges.sparkSession, "neighbours")
    links = work.save(undirected(edges, src=src, dst=dst), "links")
    first = starts.select(F.col(starts.columns[0]).alias("start")).distinct()
    seen = work.save(first.select("start", F.col("start").alias("node"), F.lit(0).alias("distance")), "seen")
    for step in range(1, depth + 1):
        frontier = seen.where(F.col("distance") == step - 1).withColumnRenamed("node", "src")
        found = frontier.join(links, "src").select("start", F.col("dst").alias("node")).distinct()
        found = found.join(seen.select("start", "node"), ["start", "node"], "left_anti")
        before, seen = seen, work.save(seen.unionByName(found.withColumn("distance", F.lit(step))), "seen")
        work.drop(before)
    work.drop(links)
    return seen.where("distance > 0")


def strong_components(edges: DataFrame, *, src: str = "src", dst: str = "dst", max_rounds: int = 100) -> DataFrame:
    """Label every vertex with the smallest id of its strongly connected component: ``node``, ``component``.

    Rounds of colouring: every open vertex takes the smallest id that reaches it; within a colour, what reaches its
    root backwards is the root's component and is closed. Edges between colours go. Every round is written.
    """
    spark = edges.sparkSession
    work = Workspace(spark, "strong")
    live = work.save(edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null").distinct(), "edges")
    open_ = work.save(live.select(F.col("u").alias("node")).union(live.select("v")).distinct(), "vertices")
    done = []
    for _ in range(max_rounds):
        if open_.isEmpty():
            break
        colour = open_.select("node", F.col("node").alias("c"))
        colour = _settle(work, colour, lambda c: live.join(c, F.col("u") == F.col("node")).select(F.col("v").alias("node"), "c"))
        inside = live.join(colour.select(F.col("node").alias("u"), F.col("c").alias("cu")), "u").join(colour.select(F.col("node").alias("v"), F.col("c").alias("cv")), "v")
        live = work.save(inside.where("cu = cv").select("u", "v"), "edges")
        reach = work.save(colour.where("node = c"), "reach")
        while True:
            more = live.join(reach.select(F.col("node").alias("v"), "c"), "v").select(F.col("u").alias("node"), "c").distinct()
            more = work.save(more.join(reach, "node", "left_anti"), "more")
            if more.isEmpty():
                break
            reach = work.save(reach.union(more), "reach")
        done.append(reach.select("node", F.col("c").alias("component")))
        open_ = work.save(open_.join(reach, "node", "left_anti"), "vertices")
        keep_u, keep_v = open_.select(F.col("node").alias("u")), open_.select(F.col("node").alias("v"))
        live = work.save(live.join(keep_u, "u", "left_semi").join(keep_v, "v", "left_semi").select("u", "v"), "edges")
    else:
        raise RuntimeError(f"strong components did not settle in {max_rounds} rounds")
    if not done:
        return open_.select("node", F.col("node").alias("component"))
    found = done[0]
    for part in done[1:]:
        found = found.union(part)
    return found


def _settle(work: Workspace, labels: DataFrame, step) -> DataFrame:
    """Take the smallest label that a step offers, until no label changes."""
    labels = work.save(labels, "labels")
    while True:
        offered = step(labels).groupBy("node").agg(F.min("c").alias("offer"))
        new = labels.join(offered, "node", "left").select("node", F.least("c", F.coalesce("offer", "c")).alias("new"), "c")
        new = work.save(new, "labels")
        changed = not new.where("new <> c").isEmpty()
        labels = new.select("node", F.col("new").alias("c"))
        if not changed:
            return labels


def label_propagation(edges: DataFrame, *, src: str = "src", dst: str = "dst", weight: str | None = None, rounds: int = 60) -> DataFrame:
    """Groups by synchronous label propagation: ``node``, ``community``.

    Each round a vertex takes the label with the largest total weight among its neighbours and, at a small weight,
    itself; of equal ones the smallest. It ends when no label changes, or when labels return to what they were two
    rounds before, where each vertex keeps the smaller of its two; labels that do neither within ``rounds`` are a
    RuntimeError.
    """
    work = Workspace(edges.sparkSession, "propagation")
    both = work.save(_weighted(edges, src, dst, weight).where("u <> v"), "edges")
    labels = work.save(both.select(F.col("u").alias("node"), F.col("u").alias("c"), F.col("u").alias("old")).distinct(), "labels")
    for _ in range(rounds):
        votes = both.join(labels.select(F.col("node").alias("v"), "c"), "v").select(F.col("u").alias("node"), "c", "w")
        votes = votes.union(labels.select("node", "c", F.lit(1e-3))).groupBy("node", "c").agg(F.round(F.sum("w"), 9).alias("w"))
        best = votes.groupBy("node").agg(F.min_by("c", F.struct((-F.col("w")).alias("w"), "c")).alias("next"))
        new = work.save(labels.join(best, "node").select("node", F.col("next").alias("c"), F.col("c").alias("old"), F.col("old").alias("older")), "labels")
        changed = new.agg(F.max(F.col("c") != F.col("old")).alias("now"), F.max(F.col("c") != F.col("older")).alias("two")).first()
        work.drop(labels)
        labels = new.select("node", "c", "old")
        if not changed["now"]:
            return labels.select("node", F.col("c").alias("community"))
        if not changed["two"]:
            return labels.select("node", F.least("c", "old").alias("community"))
    raise RuntimeError(f"labels did not settle in {rounds} rounds")


def _weighted(edges: DataFrame, src: str, dst: str, weight: str | None) -> DataFrame:
    """Each linked pair in both directions, with the largest weight it is given in either; self loops once."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    one = edges.select(F.col(src).alias("u"), F.col(dst).alias("v"), w.alias("w")).where("u is not null and v is not null and w > 0")
    both = one.union(one.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"), "w"))
    return both.groupBy("u", "v").agg(F.max("w").alias("w"))


def modularity(edges: DataFrame, labels: DataFrame, *, src: str = "src", dst: str = "dst", weight: str | None = None) -> DataFrame:
    """Modularity of a partition (``node``, ``community``) of the undirected graph: one row, ``modularity``, null without edges."""
    both = _weighted(edges, src, dst, weight)
    of_u, of_v = labels.select(F.col("node").alias("u"), F.col("community").alias("cu")), labels.select(F.col("node").alias("v"), F.col("community").alias("cv"))
    ends = both.join(of_u, "u").join(of_v, "v")
    sums = ends.groupBy("cu").agg(F.sum("w").alias("all"), F.sum(F.when(F.col("cu") == F.col("cv"), F.col("w")).otherwise(0.0)).alias("inside"))
    whole = sums.agg(F.sum("all").alias("m"))
    share = F.col("inside") / F.col("m") - (F.col("all") / F.col("m")) ** 2
    return sums.join(F.broadcast(whole)).agg(F.sum(share).alias("modularity"))


def communities(
    edges: DataFrame,
    *,
    src: str = "src",
    dst: str = "dst",
    weight: str | None = None,
    resolution: float = 1.0,
    rounds: int = 8,
    levels: int = 10,
    held: int = HELD,
    numbered: int = NUMBERED,
) -> DataFrame:
    """Communities of high modularity: ``node``, ``community`` (its smallest member).

    Parallel local moving and contraction: in a round the vertices of one half, by a hash, each move to the neighbouring
    community with the largest gain in modularity, of equal ones the smallest; halves take turns, until neither moves or
    for ``rounds`` rounds. Communities are then contracted to vertices and moved in turn, until a level gains nothing.
    The same edges give the same result.

    Over ``held`` links are dealt out by vertex and written as arrays; of up to ``numbered`` vertices the driver holds
    labels and sizes as arrays (some 30 bytes a vertex), which are broadcast in every round. Components of graphs of fewer
    links, or of more vertices, do not touch each other's moves, but for the total of weights, which is known beforehand. So
    those of at most ``held`` links, at first or once contracted, are moved whole in Arrow batches, tiny ones together.
    In larger ones every round is two joins and two aggregates, and is written.
    """
    work = Workspace(edges.sparkSession, "communities")
    pairs = _pairs(work, edges, src, dst, weight)
    total = pairs.agg(F.sum(F.when(F.col("u") == F.col("v"), F.col("w")).otherwise(2 * F.col("w")))).first()[0]
    if not total or not levels:
        nodes = pairs.select("u").union(pairs.select("v")).distinct()
        return nodes.select(F.col("u").alias("node"), F.col("u").alias("community"))
    if pairs.count() > held and (labels := _moved_by_arrays(work, pairs, numbered, float(total), resolution, rounds, levels)) is not None:
        return labels
    ordered = isinstance(pairs.schema["u"].dataType, (T.IntegralType, T.StringType))  # ids that Python orders alike
    pairs = _with_components(work, pairs, held) if ordered else pairs.withColumn("part", F.lit(0))
    found, members = [], None
    for level in range(levels):
        inside, pairs = _by_size(work, pairs, held if ordered else 0)
        if inside is not None:
            labels = _moved_inside(inside, total, resolution, rounds, levels - level)
            if members is not None:
                labels = members.join(labels.select(F.col("node").alias("community"), F.col("community").alias("next")), "community").select("node", F.col("next").alias("community"))
            found.append(work.save(labels, "found"))
        if pairs is None:
            members = None
            break
        links = work.save(pairs.union(pairs.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"), "w", "part")), "edges")
        nodes = links.select(F.col("u").alias("community")).distinct()
        if members is None:
            members = work.save(nodes.select(F.col("community").alias("node"), "community"), "members")
        elif inside is not None:
            members = members.join(nodes, "community").select("node", "community")
        labels, moved = _moved(work, links, total, resolution, rounds)
        if not moved:
            break
        named = labels.select(F.col("node").alias("community"), F.col("c").alias("next"))
        members = work.save(members.join(named, "community").select("node", F.col("next").alias("community")), "members")
        cu, cv = labels.select(F.col("node").alias("u"), F.col("c").alias("cu")), labels.select(F.col("node").alias("v"), F.col("c").alias("cv"))
        ends = links.join(cu, "u").join(cv, "v").where("cu <= cv").groupBy(F.col("cu").alias("u"), F.col("cv").alias("v"))
        pairs = work.save(ends.agg(F.sum("w").alias("w"), F.max("part").alias("part")), "pairs")
    if members is not None:
        found.append(members)
    all_ = found[0]
    for more in found[1:]:
        all_ = all_.union(more)
    low = all_.groupBy("community").agg(F.min("node").alias("low"))
    return all_.join(low, "community").select("node", F.col("low").alias("community"))


def _pairs(work: Workspace, edges: DataFrame, src: str, dst: str, weight: str | None) -> DataFrame:
    """Each linked pair (u, v, w) once, u <= v, with its largest weight, dealt by ranges and written."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    one = edges.select(F.col(src).alias("u"), F.col(dst).alias("v"), w.alias("w")).where("u is not null and v is not null and w > 0")
    one = work.save(one.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "w"), "links")
    parts = max(int(work.spark.conf.get("spark.sql.shuffle.partitions")), one.count() // HELD + 1)
    return work.save(one.repartitionByRange(parts, "u", "v").groupBy("u", "v").agg(F.max("w").alias("w")), "pairs")


def _with_components(work: Workspace, pairs: DataFrame, held: int) -> DataFrame:
    """Pairs with ``part``, a member of their component.

    Every task finds the components of the range of links that it has. Vertices that several tasks have met link their
    roots, and the components of those are found in turn; they are few where near ids are linked.
    """
    kind = pairs.schema["u"].dataType.simpleString()
    rooted = work.save(pairs.mapInArrow(moves.rooted, f"u {kind}, v {kind}, w double, root {kind}"), "rooted")
    met = rooted.where("v is null").select(F.col("u").alias("node"), "root")
    several = met.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    links = work.save(met.join(several.select("node", "low"), "node").where("root <> low").select(F.col("low").alias("u"), F.col("root").alias("v")).distinct(), "roots")
    if (n := links.count()) <= held:
        links = links.withColumn("w", F.lit(1.0)).repartition(1) if n else links.withColumn("w", F.lit(1.0))
        names = links.mapInArrow(moves.rooted, f"u {kind}, v {kind}, w double, root {kind}").where("v is null").select(F.col("u").alias("root"), F.col("root").alias("part"))
    else:
        names = connected_components(links, src="u", dst="v").select(F.col("node").alias("root"), F.col("component").alias("part"))
    names = work.save(names, "names")
    return rooted.where("v is not null").join(names, "root", "left").select("u", "v", "w", F.coalesce("part", "root").alias("part"))


def _by_size(work: Workspace, pairs: DataFrame, held: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Pairs of components of at most ``held`` pairs, with ``group`` and ``bin`` of at most about as many, and pairs of larger ones; None for none.

    Components over a 64th of that are broadcast, a row each; they are no more than a share of the pairs over it.
    """
    tiny = held // 64
    sizes = pairs.groupBy("part").agg(F.count(F.lit(1)).alias("links"))
    sizes = work.save(sizes.where(F.col("links") > tiny), "sizes")
    whole = pairs.count()
    row = sizes.agg(F.sum("links").alias("some"), F.sum(F.when(F.col("links") > held, F.col("links"))).alias("large")).first()
    some, large = row["some"] or 0, row["large"] or 0
    known = pairs.join(F.broadcast(sizes), "part", "left")
    inside = None
    if whole > large:
        bins = (whole - some) // max(1, held // 4) + 1
        inside = known.where(F.col("links").isNull() | (F.col("links") <= held)).select(
            "u", "v", "w", F.when(F.col("links").isNotNull(), F.col("part")).alias("group"), F.when(F.col("links").isNull(), F.pmod(F.xxhash64("part"), F.lit(bins))).alias("bin")
        )
    return inside, known.where(F.col("links") > held).select("u", "v", "w", "part") if large else None


def _moved_inside(pairs: DataFrame, total: float, resolution: float, rounds: int, levels: int) -> DataFrame:
    """Communities (node, community) of whole components, each in one task."""
    kind = pairs.schema["u"].dataType.simpleString()
    turns = (_side("u") + 2 * _side("v")).cast("byte").alias("turns")
    move = moves.move_inside(float(total), resolution, rounds, levels)
    return pairs.select("u", "v", "w", turns, "group", "bin").groupBy("group", "bin").applyInArrow(move, f"node {kind}, community {kind}")


def _numbered(work: Workspace, pairs: DataFrame, most: int) -> tuple[DataFrame, DataFrame, int] | None:
    """Vertices by their place in the order of ids (place, node), pairs by places, and how many places there are; None if over ``most``.

    Whole numbers within a range of ``most`` are their own places, from the smallest on; a place may then be without vertex.
    """
    kind = pairs.schema["u"].dataType
    if isinstance(kind, T.IntegralType):
        low, high = pairs.agg(F.min("u"), F.max("v")).first()
        if high - low < most:
            ids = work.spark.range(high - low + 1).select(F.col("id").cast("int").alias("place"), (F.col("id") + low).cast(kind).alias("node"))
            return ids, pairs.select(*[(F.col(c) - low).cast("int").alias(c) for c in ("u", "v")], "w"), high - low + 1
    ids = work.save(pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct(), "nodes")
    if (n := ids.count()) > most:
        return None
    ids = work.save(numbered_rows(ids, ["node"], "place").select((F.col("place") - 1).cast("int").alias("place"), "node"), "nodes")
    for c in ("u", "v"):
        pairs = pairs.join(ids.select(F.col("node").alias(c), F.col("place").alias(f"place {c}")), c)
    return ids, pairs.select(F.col("place u").alias("u"), F.col("place v").alias("v"), "w"), n


def _moved_by_arrays(work: Workspace, pairs: DataFrame, most: int, total: float, resolution: float, rounds: int, levels: int) -> DataFrame | None:
    """Communities (node, community, its smallest member) of pairs that are dealt out by vertex; None for over ``most`` vertices.

    A vertex's links are in one task. Tasks give the labels that change, the driver sums the sizes.
    """
    if (found := _numbered(work, pairs, most)) is None:
        return None
    ids, links, n = found
    parts = 4 * pairs.count() // HELD + 1
    links = links.union(links.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"), "w"))
    sides, turn = ids.select("place", _side("node").cast("byte").alias("turn")).toArrow(), np.zeros(n, np.int8)
    turn[sides["place"].to_numpy()] = sides["turn"].to_numpy()
    del sides
    share = work.spark.sparkContext.broadcast
    member = name = np.arange(n, dtype=np.int32)
    held, known, shared = None, None, None
    for _ in range(levels):
        before, held = held, work.save(links.repartition(parts, "u").mapInArrow(moves.packed, "u binary, v binary, w binary"), "blocks")
        if before is not None:
            shared.destroy()
            work.drop(before)
        sums, k = held.mapInArrow(moves.degrees, "node int, k double").toArrow(), np.zeros(len(name))
        k[sums["node"].to_numpy()] = sums["k"].to_numpy()
        del sums
        known = k > 0 if known is None else known
        c, side, still = np.arange(len(name), dtype=np.int32), turn[name], 0
        for number in range(rounds):
            shared = share((c, np.bincount(c, k, len(c)), side))
            went = held.mapInArrow(moves.move_half(shared, number % 2, total, resolution), "node int, c int").toArrow()
            shared.destroy()
            c[went["node"].to_numpy()] = went["c"].to_numpy()
            still = 0 if went.num_rows else still + 1
            if still == 2:
                break
        if (c == np.arange(len(c))).all():
            break
        names, at = np.unique(c, return_inverse=True)
        at = at.astype(np.int32)
        member, name = at[member], name[names]
        shared = share(at)
        links = held.mapInArrow(moves.contract(shared), "u int, v int, w double")
    low = np.unique(member, return_index=True)[1].astype(np.int32)[member]
    low[~known] = -1
    shared = share(low)
    kind = pairs.schema["u"].dataType.simpleString()
    found = work.save(ids.mapInArrow(moves.look_up(shared), f"node {kind}, low int"), "found")
    shared.destroy()
    return found.join(ids.select(F.col("place").alias("low"), F.col("node").alias("community")), "low").select("node", "community")


def _side(node: str) -> Column:
    """The half that a vertex is in."""
    return F.pmod(F.xxhash64(node), F.lit(2))


def _moved(work: Workspace, links: DataFrame, total: float, resolution: float, rounds: int) -> tuple[DataFrame, bool]:
    """Labels (node, c) after local moving, and whether any vertex moved."""
    degree = work.save(links.groupBy(F.col("u").alias("node")).agg(F.sum("w").alias("k")), "degrees")
    labels = work.save(degree.select("node", "k", F.col("node").alias("c")), "labels")
    moved, still = False, 0
    for number in range(rounds):
        ends = links.where((F.col("u") != F.col("v")) & (_side("u") == number % 2)).join(labels.select(F.col("node").alias("v"), F.col("c").alias("to")), "v")
        near = ends.groupBy(F.col("u").alias("node"), "to").agg(F.sum("w").alias("w"))
        own = labels.where(_side("node") == number % 2).select("node", F.col("c").alias("to"), F.lit(0.0).alias("w"))
        near = near.union(own).groupBy("node", "to").agg(F.sum("w").alias("w"))
        size = labels.groupBy(F.col("c").alias("to")).agg(F.sum("k").alias("size"))
        rows = near.join(labels, "node").join(size, "to")
        others = F.col("size") - F.when(F.col("to") == F.col("c"), F.col("k")).otherwise(0.0)
        gain = F.floor((F.col("w") - resolution * F.col("k") * others / total) / total / moves.GRAIN + 0.5)
        best = rows.withColumn("gain", gain).groupBy("node").agg(
            F.min_by("to", F.struct((-F.col("gain")).alias("g"), F.col("to").alias("t"))).alias("best"),
            F.max("gain").alias("most"),
            F.max(F.when(F.col("to") == F.col("c"), F.col("gain"))).alias("stays"),
        )
        goes = F.coalesce(F.col("most") > F.col("stays"), F.lit(False))
        new = labels.join(best, "node", "left").select("node", "k", F.when(goes, F.col("best")).otherwise(F.col("c")).alias("c"), goes.alias("went"))
        new = work.save(new, "labels")
        work.drop(labels)
        went = not new.where("went").isEmpty()
        labels = new.select("node", "k", "c")
        moved, still = moved or went, 0 if went else still + 1
        if still == 2:
            break
    return labels, moved


def clusterings(
    edges: DataFrame, ids: DataFrame, *, metric: str, threshold: int, src: str = "src", dst: str = "dst", weight: str | None = None
) -> DataFrame:
    """All clusterings of one metric and threshold: system_id, label, metric, cluster, directed, threshold.

    Strong components of the directed graph, weak components, and communities of the weighted undirected graph. Ids (one
    column) without a link are clusters of their own.
    """

    def named(found: DataFrame, group: str, cluster: str, directed: bool) -> DataFrame:
        labels = ranked_labels(found, ids, component=group)
        constants = {"metric": metric, "cluster": cluster, "directed": directed, "threshold": threshold}
        return labels.select(F.col("node").alias("system_id"), "label", *[F.lit(v).alias(k) for k, v in constants.items()])

    parts = [
        named(strong_components(edges, src=src, dst=dst), "component", "components", True),
        named(connected_components(edges, src=src, dst=dst), "component", "components", False),
        named(communities(edges, src=src, dst=dst, weight=weight), "community", "communities", False),
    ]
    return parts[0].union(parts[1]).union(parts[2])


def protein_edges(scores: DataFrame, systems: DataFrame, *, metric: str, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Edges (src, dst, similarity) of a metric from a threshold on, between systems of the table, and the ids of those.

    ``systems`` has system_id, system_type, and the numbers of chains; only holo systems of at most five chains of
    either kind take part.
    """
    ids = systems.where("system_type = 'holo' and system_num_protein_chains <= 5 and system_num_ligand_chains <= 5").select("system_id").distinct()
    rows = scores.where((F.col("metric") == metric) & (F.col("similarity") >= threshold))
    for side in ("query_system", "target_system"):
        rows = rows.join(ids.withColumnRenamed("system_id", side), side, "left_semi")
    return rows.select(F.col("query_system").alias("src"), F.col("target_system").alias("dst"), "similarity"), ids


def ligand_edges(scores: DataFrame, ligands: DataFrame, *, threshold: int, metric: str = "tanimoto_similarity_max") -> tuple[DataFrame, DataFrame]:
    """Edges (src, dst, similarity) of ligands, whose numbers are made texts, from a threshold on, and the ids of all ligands."""
    ids = ligands.select(F.col("number_id_by_inchikeys").cast("string").alias("system_id")).where("system_id is not null").distinct()
    ends = [F.col(f"{side}_ligand_id").cast("string").alias(name) for side, name in (("query", "src"), ("target", "dst"))]
    return scores.where(F.col(metric) >= threshold).select(*ends, F.col(metric).alias("similarity")), ids


def ranked_labels(components: DataFrame, nodes: DataFrame | None = None, *, node: str = "node", component: str = "component") -> DataFrame:
    """Labels c0, c1, … by size, the largest first, of equal ones the one with the smallest member; ``node``, ``label``.

    Ids of ``nodes`` (one column) that no component has are components of their own. Only a row by component is ordered, by ranges.
    """
    found = components.select(F.col(node).alias("node"), F.col(component).alias("component"))
    if nodes is not None:
        alone = nodes.select(F.col(nodes.columns[0]).alias("node")).distinct().join(found.select("node"), "node", "left_anti")
        found = found.union(alone.select("node", F.col("node").alias("component")))
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("low"))
    sizes = numbered_rows(sizes, [F.desc("n"), "low"], "place")
    names = sizes.select("component", F.concat(F.lit("c"), (F.col("place") - 1).cast("string")).alias("label"), "n")
    return found.join(names, "component").select("node", "label", F.col("n").alias("size"))
