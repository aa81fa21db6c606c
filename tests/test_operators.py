import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn import schemas
from cairn.functions import scalars
from cairn.operators import enrich, evaluate, graph, series, similarity, spatial, split, structure
from cairn.plans import stages
from cairn.session import Workspace


def pairs(spark, rows, names="src string, dst string"):
    return spark.createDataFrame(rows, names)


def as_map(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_components_small(spark):
    edges = pairs(spark, [("a", "b"), ("b", "c"), ("d", "e"), ("g", "g")])
    assert as_map(graph.connected_components(edges), "node", "component") == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d", "g": "g"}
    labels = graph.ranked_labels(graph.connected_components(edges), pairs(spark, [("f",)], "node string"))
    assert as_map(labels, "node", "label") == {"a": "c0", "b": "c0", "c": "c0", "d": "c1", "e": "c1", "f": "c2", "g": "c3"}
    assert graph.connected_components(pairs(spark, [])).count() == 0


def closure(n, edges):
    reach = np.eye(n, dtype=bool)
    for a, b in edges:
        reach[a, b] = True
    for k in range(n):
        reach |= np.outer(reach[:, k], reach[k])
    return reach


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_closure(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(45)] + [(0, k) for k in range(30, 36)]
    nodes = {x for e in edges for x in e}
    df = pairs(spark, edges, "src long, dst long")
    both = closure(40, edges + [(b, a) for a, b in edges])
    assert as_map(graph.connected_components(df), "node", "component") == {v: int(np.flatnonzero(both[v])[0]) for v in nodes}
    one = closure(40, edges)
    assert as_map(graph.strong_components(df), "node", "component") == {v: int(np.flatnonzero(one[v] & one[:, v])[0]) for v in nodes}


def test_long_path_settles(spark):
    df = pairs(spark, [(k, k + 1) for k in range(200)], "src long, dst long")
    assert {r.component for r in graph.connected_components(df).collect()} == {0}


def test_strong_small(spark):
    found = graph.strong_components(pairs(spark, [("a", "b"), ("b", "a"), ("b", "c")]))
    assert as_map(found, "node", "component") == {"a": "a", "b": "a", "c": "c"}


def test_neighbours_and_degree(spark):
    path = pairs(spark, [("a", "b"), ("b", "c"), ("c", "d"), ("b", "a")])
    start = pairs(spark, [("a",)], "s string")
    assert sorted((r.node, r.distance) for r in graph.neighbours(path, start, 2).collect()) == [("b", 1), ("c", 2)]
    assert as_map(graph.degrees(path), "node", "degree") == {"a": 1, "b": 2, "c": 2, "d": 1}


def best_moves(edges, turn, rounds=8, levels=10):
    """Local moving and contraction as documented, vertex by vertex."""
    links = {}
    for a, b in edges:
        links[a, b] = links[b, a] = 1.0
    total = sum(links.values())
    member = {u: u for u, _ in links}
    for _ in range(levels):
        k = {}
        for (u, _), w in links.items():
            k[u] = k.get(u, 0) + w
        label, moved, still = {u: u for u in k}, False, 0
        for number in range(rounds):
            size = {}
            for u, c in label.items():
                size[c] = size.get(c, 0) + k[u]
            new = dict(label)
            for u in k:
                near = {label[u]: 0.0}
                for (a, b), w in links.items():
                    if a == u and b != u:
                        near[label[b]] = near.get(label[b], 0) + w
                gain = {c: round((w - k[u] * (size[c] - (k[u] if c == label[u] else 0)) / total) / total, 12) for c, w in near.items()}
                best = min(gain, key=lambda c: (-gain[c], c))
                if turn(u) == number % 2 and gain[best] > gain[label[u]]:
                    new[u] = best
            went = new != label
            label, moved, still = new, moved or went, 0 if went else still + 1
            if still == 2:
                break
        if not moved:
            break
        member = {u: label[c] for u, c in member.items()}
        merged = {}
        for (a, b), w in links.items():
            merged[label[a], label[b]] = merged.get((label[a], label[b]), 0) + w
        links = merged
    low = {}
    for u, c in member.items():
        low[c] = min(u, low.get(c, u))
    return {u: low[c] for u, c in member.items()}


def quality_of(edges, label):
    links = {(a, b) for a, b in edges} | {(b, a) for a, b in edges}
    m = len(links)
    inside, total = {}, {}
    for a, b in links:
        total[label[a]] = total.get(label[a], 0) + 1
        inside[label[a]] = inside.get(label[a], 0) + (label[a] == label[b])
    return sum(inside[c] / m - (total[c] / m) ** 2 for c in total)


def test_communities_equal_brute_force(spark):
    rng = random.Random(4)
    group = {v: v // 8 for v in range(40)}
    edges = sorted({(a, b) for a in range(40) for b in range(a) if rng.random() < (0.6 if group[a] == group[b] else 0.02)})
    df = pairs(spark, edges, "src long, dst long")
    side = {r.id: r.t for r in spark.range(40).select("id", F.pmod(F.xxhash64("id"), F.lit(2)).alias("t")).collect()}
    found = as_map(graph.communities(df), "node", "community")
    assert found == best_moves(edges, side.get)
    labels = graph.communities(df)
    assert graph.modularity(df, labels).first().modularity == pytest.approx(quality_of(edges, found)) and quality_of(edges, found) > 0.6
    assert graph.communities(pairs(spark, [], "src long, dst long")).count() == 0
    assert graph.modularity(pairs(spark, [], "src long, dst long"), labels).first().modularity is None


def test_communities_of_several_components(spark, monkeypatch):
    """Small components are moved in one task, large ones by joins until they are contracted; the result is the same."""
    rng = random.Random(5)
    edges = {("v98", "v99")}
    for start, n, share in ((0, 36, 0.14), (40, 20, 0.2), (70, 9, 0.5)):
        edges |= {(f"v{a:02d}", f"v{b:02d}") for a in range(start, start + n) for b in range(start, a) if rng.random() < share or a == b + 1}
    edges = sorted(edges)
    ids = spark.createDataFrame([(v,) for v in sorted({v for e in edges for v in e})], "id string")
    side = {r.id: r.t for r in ids.select("id", F.pmod(F.xxhash64("id"), F.lit(2)).alias("t")).collect()}
    want = best_moves(edges, side.get, levels=3)
    df, saved, save = pairs(spark, edges, "src string, dst string"), [], Workspace.save
    monkeypatch.setattr(Workspace, "save", lambda self, df, tag: saved.append(tag) or save(self, df, tag))
    assert as_map(graph.communities(df, levels=3), "node", "community") == want
    assert len(saved) < 9  # it was one by round
    for held in (0, 40):
        assert as_map(graph.communities(df, levels=3, held=held), "node", "community") == want


def test_communities_of_weights_and_loops(spark):
    rows = [(1, 2, 2.0), (2, 1, 3.0), (2, 3, 0.5), (3, 4, 4.0), (5, 5, 1.0), (6, None, 9.0), (7, 8, 0.0)]
    df = pairs(spark, rows, "src int, dst int, w double")
    found = as_map(graph.communities(df, weight="w"), "node", "community")
    assert found == as_map(graph.communities(df, weight="w", held=0), "node", "community") == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5}
    assert as_map(graph.communities(df, weight="w", levels=0), "node", "community") == {k: k for k in range(1, 6)}


def test_label_propagation_settles(spark):
    clique = [(a, b) for a in range(5) for b in range(a)] + [(a + 10, b + 10) for a in range(5) for b in range(a)] + [(0, 10)]
    found = as_map(graph.label_propagation(pairs(spark, clique, "src long, dst long")), "node", "community")
    assert len({found[k] for k in range(5)}) == 1 and len({found[k + 10] for k in range(5)}) == 1 and set(found) == {*range(5), *range(10, 15)}
    star = as_map(graph.label_propagation(pairs(spark, [(0, k) for k in range(1, 5)], "src long, dst long")), "node", "community")
    assert len(set(star.values())) == 1


def test_clusterings_and_edges(spark):
    scores = spark.createDataFrame([("a", "b", "m", 60), ("b", "a", "m", 70), ("b", "c", "m", 55), ("c", "x", "m", 99), ("a", "c", "n", 90), ("c", "d", "m", 10)], "query_system string, target_system string, metric string, similarity int")
    systems = spark.createDataFrame([(s, "ion" if s == "x" else "holo", 1, 1) for s in "abcdx"], "system_id string, system_type string, system_num_protein_chains int, system_num_ligand_chains int")
    edges, ids = graph.protein_edges(scores, systems, metric="m", threshold=50)
    assert sorted((r.src, r.dst) for r in edges.collect()) == [("a", "b"), ("b", "a"), ("b", "c")] and {r[0] for r in ids.collect()} == set("abcd")
    found = {(r.cluster, r.directed, r.system_id): r.label for r in graph.clusterings(edges, ids, metric="m", threshold=50, weight="similarity").collect()}
    assert [found["components", False, s] for s in "abcd"] == ["c0", "c0", "c0", "c1"]
    assert [found["components", True, s] for s in "abcd"] == ["c0", "c0", "c1", "c2"]
    assert len({found["communities", False, s] for s in "abc"}) < 3 and len(found) == 12
    ligands = spark.createDataFrame([(1, 2, 80), (2, 3, 10)], "query_ligand_id int, target_ligand_id int, tanimoto_similarity_max int")
    numbers = spark.createDataFrame([(1,), (2,), (3,), (None,)], "number_id_by_inchikeys int")
    edges, ids = graph.ligand_edges(ligands, numbers, threshold=50)
    assert [tuple(r) for r in edges.collect()] == [("1", "2", 80)] and {r[0] for r in ids.collect()} == {"1", "2", "3"}


def test_greedy_mapping_equals_brute_force(spark):
    rng = random.Random(6)
    rows = [(g, a, b, rng.choice([0.0, 0.25, 0.5, 0.75, 1.0])) for g in range(12) for a in range(rng.randint(1, 5)) for b in range(rng.randint(1, 5))]
    want = set()
    for g in range(12):
        open_ = {(a, b): s for k, a, b, s in rows if k == g and s > 0}
        while open_:
            a, b = min(open_, key=lambda p: (-open_[p], p))
            want.add((g, a, b, open_[a, b]))
            open_ = {p: s for p, s in open_.items() if p[0] != a and p[1] != b}
    found = similarity.greedy_mapping(spark.createDataFrame(rows, "k int, l int, r int, score double"), keys=["k"], left="l", right="r", score="score")
    assert {tuple(r) for r in found.collect()} == want


def test_orders_by_ranges(spark):
    from cairn.operators import ordered

    rng = random.Random(3)
    rows = [(k, rng.choice("abc"), rng.randint(0, 9)) for k in range(200)]
    df = spark.createDataFrame(rows, "k int, g string, v int")
    place = sorted(rows, key=lambda r: (-r[2], r[0]))
    found = as_map(ordered.numbered_rows(df, [F.desc("v"), "k"], "place"), "k", "place")
    assert found == {r[0]: i for i, r in enumerate(place, 1)}
    total, want = 0, {}
    for r in place:
        total += r[2]
        want[r[0]] = total
    assert as_map(ordered.running(df, [F.desc("v"), "k"], {"sum": "v"}), "k", "sum") == want
    assert as_map(ordered.medians(df, ["g"], "v"), "g", "median") == {g: float(np.median([r[2] for r in rows if r[1] == g])) for g in "abc"}
    assert ordered.numbered_rows(df.limit(0), ["k"], "place").count() == 0 and ordered.medians(df.limit(0), ["g"], "v").count() == 0


def test_joins_of_totals_split_hot_groups(spark):
    from cairn.operators import hot

    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, None).otherwise(F.col("id") % 700).alias("k"), "id")
    rows.write.mode("overwrite").saveAsTable("hot_rows")
    rows = spark.table("hot_rows")
    rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("m")).write.mode("overwrite").saveAsTable("hot_totals")
    totals = spark.table("hot_totals")
    for merge in (False, True):
        found = hot.join_totals(rows, totals, ["k"], size="n", salt=F.col("id"), merge=merge)
        assert found.columns == ["k", "id", "n", "m"] and found.count() == 3000
        assert found.exceptAll(rows.join(totals, rows.k.eqNullSafe(totals.k)).select(rows.k, "id", "n", "m")).count() == 0
    assert hot.hot_groups(totals, "n").where("k is null").count() == 1
    some = totals.where("k < 100")
    assert hot.join_totals(rows, some, ["k"], size="n", salt=F.col("id"), how="inner").count() == rows.where("k < 100").count()


def test_overlap(spark):
    items = spark.createDataFrame([("q", "h"), ("q", "h"), ("q", "p"), ("t", "h"), ("t", "p"), ("t", "p"), ("t", "p"), ("z", None)], "k string, i string")
    found = {(r["query"], r.target): (r.pli_qcov, r.pli_unique_qcov) for r in similarity.multiset_overlap_edges(items, key="k", item="i").collect()}
    assert found == {("q", "t"): (67, 100), ("t", "q"): (50, 100)}


@pytest.mark.parametrize("least", [51, 70, 100])
def test_close_edges_equal_all_edges(spark, least):
    draw = random.Random(least)
    rows = [(k, draw.randrange(12)) for k in range(150) for _ in range(draw.choice([1, 1, 2, 2, 3, 4, 5, 8]))]
    rows += [(k, draw.randrange(60)) for k in (200, 201, 202) for _ in range(45)] + [(k, i % 20) for k in (203, 204) for i in range(40)]
    rows += [(k, i) for k in (205, 206, 207) for i in (1, 1, 1, 2)] + [(208, None), (None, 3), (None, 4)]
    items = spark.createDataFrame(rows, "k long, i long")
    every = similarity.multiset_overlap_edges(items, key="k", item="i").where(F.col("pli_qcov") >= least).collect()
    found = similarity.multiset_overlap_edges(items, key="k", item="i", min_score=least).collect()
    assert every and sorted(map(tuple, found)) == sorted(map(tuple, every))


def test_written_tables_leave_no_shuffle_files(spark):
    from cairn.session import Workspace

    def kept():
        tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
        return tracker.shuffleStatuses().size()

    before = kept()
    saved = Workspace(spark, "test").save(spark.range(1000).groupBy(F.col("id") % 7).count(), "counts")
    assert kept() <= before and saved.count() == 7


def test_means_are_added_up_in_order(spark):
    rows = [("a", k, x) for k, x in enumerate([1e16, 1.0, -1e16, 1.0])] + [("b", 0, None), ("b", 1, 3.0), ("c", 0, None)]
    table = spark.createDataFrame(rows, "k string, at int, x double").repartition(4, "at")
    assert as_map(similarity.means_in_order(table, ["x"], keys=["k"], order=["at"]), "k", "x") == {"a": 0.25, "b": 3.0, "c": None}


def test_truncated_percent_rounds_binary_fractions(spark):
    rows = spark.createDataFrame([(c, n) for n in range(1, 201) for c in range(n + 1)], "c int, n int")
    for r in rows.select("c", "n", scalars.truncated_percent(F.col("c") / F.col("n")).alias("s")).collect():
        assert r.s == int(float(np.rint(r.c / r.n * 100)) / 100 * 100), (r.c, r.n)


def test_orientation(spark):
    edges = spark.createDataFrame([("a", "b", 40), ("b", "a", 60), ("a", "x", 90)], "query string, target string, s int")
    one = lambda v: spark.createDataFrame([(v,)], "id string")
    assert [tuple(r) for r in similarity.cross_similarity(edges, one("a"), one("b"), score="s").collect()] == [("b", "a", 60)]


def test_rounding_and_text(spark):
    x = spark.createDataFrame([(0.005,), (0.015,), (0.29,)], "x double")
    assert [r[0] for r in x.select(scalars.half_even_percent(F.col("x"))).collect()] == [0, 2, 29]
    assert [r[0] for r in x.select(scalars.truncated_percent(F.col("x"))).collect()][2] == 28
    texts = ["A:9-163", "B:-3-715", "SM:9--163", "SM:-9--163", "x", "C:163L-170", "D:5"]
    t = spark.createDataFrame([(k, v) for k, v in enumerate(texts)], "k int, t string").orderBy("k").select(scalars.parse_range(F.col("t")).alias("r"))
    assert [tuple(r.r) for r in t.collect()] == [
        ("A", "9", "163"), ("B", "-3", "715"), ("SM", "9", "-163"), ("SM", "-9", "-163"), (".", "0", "0"), ("C", "163L", "170"), ("D", "5", "5")
    ]


def test_affinity(spark):
    rows = spark.createDataFrame([("1", "nM"), ("0", "nM"), (">10", "nM"), ("2", "M"), ("1", "?")], "v string, u string")
    found = rows.select(scalars.p_affinity(scalars.clean_number(F.col("v")), F.col("u")).alias("p")).collect()
    assert [None if r.p is None else round(r.p, 4) for r in found] == [9.0, None, 8.0, -0.301, None]


def test_code_functions(spark):
    one = spark.range(1)
    codes = F.array(*[F.lit(c) for c in ("1AB", "ABC", "LONG", "ZZ")])
    row = one.select(
        scalars.code_order(codes).alias("o"),
        scalars.replace_parts(F.lit("A-B"), {"A": "X"}).alias("r"),
        scalars.replace_parts(F.lit("PRD_A"), {"PRD_A": "X"}).alias("p"),
        scalars.any_part(F.lit("A-UNK"), ["UNK"]).alias("d"),
        scalars.pad_id(F.lit("7")).alias("z"),
        scalars.digits(F.lit("-12a")).alias("n"),
        scalars.multiset_overlap(scalars.multiset(F.array(F.lit("h"), F.lit("h"))), scalars.multiset(F.array(F.lit("h")))).alias("m"),
        scalars.strict_sum(F.array(F.lit(1.0), F.lit(None))).alias("s"),
        scalars.max_or(F.array(F.lit(None).cast("double"))).alias("x"),
        scalars.one_hot(F.lit("q"), ["a", "b"], "b").alias("h"),
        scalars.pad_to(F.array(F.lit(1.0)), 3).alias("pad"),
    ).first()
    assert row.o == ["LONG", "ABC", "1AB", "ZZ"] and (row.r, row.p, row.d, row.z, row.n, row.m) == ("X-B", "PRD_A", True, "007", 12, 1)
    assert row.s is None and row.x == -1 and row.h == [0, 1] and row.pad == [1, 0, 0]


def test_missing_library_has_a_clear_error():
    with pytest.raises(ImportError, match="optional library"):
        scalars.plugin("no_such_library:thing")


def test_greedy_mapping(spark):
    rows = [("s", 0, 0, 0.9), ("s", 0, 1, 0.8), ("s", 1, 0, 0.85), ("s", 1, 1, 0.1)]
    found = similarity.greedy_mapping(spark.createDataFrame(rows, "k string, l int, r int, score double"), keys=["k"], left="l", right="r", score="score")
    assert sorted((r.l, r.r) for r in found.collect()) == [(0, 0), (1, 1)]


def test_aligned_positions(spark):
    rows = spark.createDataFrame([("a", "AC-D", "A-GD", 5, 1)], "k string, q string, t string, q0 int, t0 int")
    found = similarity.aligned_positions(rows, keys=["k"], query="q", target="t", query_start="q0", target_start="t0")
    assert [(r.query_pos, r.target_pos) for r in found.collect()] == [(5, 1), (7, 3)]


def test_top_and_gaps(spark):
    g = spark.createDataFrame([("g", 2, 5), ("g", 1, 5), ("g", 3, 3)], "g string, id int, s int")
    assert [r.id for r in enrich.top_by(g, ["g"], [F.desc("s"), "id"], 2).orderBy("rank").collect()] == [1, 2]
    r = spark.createDataFrame([("c", k) for k in (1, 2, 5, 6, 9)], "c string, r int")
    assert sorted((x.gap_from, x.gap_to) for x in spatial.gaps(r, by=["c"], at="r").collect()) == [(2, 5), (6, 9)]


def test_numbered_is_dense(spark):
    df = spark.createDataFrame([(v,) for v in "dbacabz"], "v string")
    assert as_map(enrich.numbered(df, "v", "n"), "v", "n") == {"a": 0, "b": 1, "c": 2, "d": 3, "z": 4}


def test_radius_and_intervals(spark):
    rng = np.random.default_rng(1)
    xyz = rng.random((60, 3))
    points = spark.createDataFrame([(k, *map(float, p)) for k, p in enumerate(xyz)], "id int, x double, y double, z double")
    found = sorted((r.l_id, r.r_id) for r in spatial.radius_join(points, points, 0.2).collect())
    far = np.sqrt(((xyz[:, None] - xyz[None]) ** 2).sum(2))
    assert found == sorted((int(i), int(j)) for i, j in zip(*np.nonzero(far <= 0.2)))
    ranges = spark.createDataFrame([("d", 0, 5), ("e", 3, 30), ("f", 9, 9)], "label string, a int, b int")
    at = spark.createDataFrame([("c", k) for k in (4, 5, 29, 30)], "c string, p int")
    held = spatial.interval_join(at, ranges, at="p", start="a", end="b", width=4)
    assert sorted((r.p, r.label) for r in held.collect()) == [(4, "d"), (4, "e"), (5, "e"), (29, "e")]
    best = spatial.best_overlap(at, ranges, by="c", label="label", at="p", start="a", end="b", width=4).first()
    assert (best.label, best.n_points) == ("e", 3)


def test_series(spark):
    p = spark.createDataFrame([("K", "a", "b"), ("K", "b", "c"), ("M", "a", "c")], "constant string, id1 string, id2 string")
    pockets = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("c", 2), ("b", 2)], "id string, pocket int")
    found = {(r.constant, r.pocket): r.members for r in series.matched_series(p, pockets).collect()}
    assert found == {("K", 1): ["a", "b", "c"], ("K", 2): ["b", "c"], ("M", 1): ["a", "c"]}


def test_split_invariants(spark):
    rng = random.Random(2)
    rows = [(k, k // 3, f"l{k % 5}", k % 12, k % 9, True, float(rng.randint(1, 9)), f"u{k}") for k in range(240)]
    systems = spark.createDataFrame(rows, "system long, entry long, code string, cluster long, val_cluster long, passes_quality boolean, size double, uniqueness string")
    edges = spark.createDataFrame([(rng.randrange(240), rng.randrange(240)) for _ in range(120)], "src long, dst long")
    rules = split.SplitRules(leakage=(1, 60), num_test=5, min_val_cluster=3, num_val=6, per_val_cluster=2, max_removed_share=0.5, ranges={"size": (1, 9)}, criteria=(), weights={"leakage_count": -1.0})
    found = split.assign(split.prepare(systems, rules), [edges], rules)
    by = as_map(found, "system", "split")
    assert set(by) == set(range(240)) and set(by.values()) == {"train", "val", "test", "removed"}
    test = [s for s, x in by.items() if x == "test"]
    leaks = split.leakage_sets(spark.createDataFrame([(s,) for s in test], "system long"), systems, [edges], 1)
    assert all(by[r.leaked] in ("removed", "test") for r in leaks.collect())
    entries = {rows[s][1] for s, x in by.items() if x == "val"}
    assert not any(by[s] == "train" and rows[s][1] in entries for s in by)


def test_leakage_counts_equal_sets(spark):
    draw = random.Random(6)
    rows = [(k, draw.choice([None, 1, 2, 3]), draw.choice([None, *range(8)])) for k in range(40)] + [(99, None, None)]
    systems = spark.createDataFrame(rows, "system long, cluster long, entry long")
    graphs = [pairs(spark, [(draw.randrange(45), draw.randrange(45)) for _ in range(30)], "src long, dst long") for _ in range(2)]
    tests = systems.where("system % 3 <> 1")
    for depth in (1, 2):
        want = as_map(split.leakage_sets(tests, systems, graphs, depth).groupBy("system").count(), "system", "count")
        assert want and as_map(split.leakage_counts(tests, systems, graphs, depth), "system", "leakage_count") == want


def test_add_backs(spark):
    rows = [("t", "A", "test", True, "x"), ("r", "B", "removed", True, "y"), ("q", "A", "removed", True, "x"), ("p", "C", "removed", False, "z"), ("k", "D", "train", True, "x")]
    table = spark.createDataFrame(rows, "system string, code string, split string, passes_quality boolean, ligand_cluster string")
    members = [("s", k, k) for k in "trqpk"]
    series_ = spark.createDataFrame(members, "series string, system string, unique string")
    assert {r.system for r in split.add_back_series(table, series_).where("split = 'test'").collect()} == {"t", "r"}
    assert {r.system for r in split.add_back_series(table, series_, min_unique=4).where("split = 'test'").collect()} == {"t"}
    assert {r.system for r in split.add_back_novel(table).where("split = 'test'").collect()} == {"t", "r"}


def test_evaluation(spark):
    rows = [("a", 1, 1.0, 0.9), ("a", 2, 0.5, 0.8), ("b", 1, 3.0, 0.1), ("c", 1, None, None)]
    scores = spark.createDataFrame(rows, "s string, rank int, rmsd double, lddt double")
    best = evaluate.best_pose(evaluate.evaluated(scores, scores.select("s").distinct(), key="s"), key="s", rank="rank", rmsd="rmsd", top_n=5)
    table = evaluate.results_table(best, {"all": F.lit(True), "none": F.lit(False)}, key="s").collect()
    assert [(r.subset, r.n_systems, round(r.success_rate, 2), r.median_rmsd) for r in table] == [("all", 3, 33.33, 3.0)]
    strata = evaluate.stratify(spark.createDataFrame([(1, 10.0, 90.0), (2, 90.0, 90.0)], "s int, p double, l double"), {"new_p": {"p": 50}, "new": {"p": 50, "l": 50}})
    assert [(r.new_p, r.new, r.not_novel) for r in strata.orderBy("s").collect()] == [(True, False, False), (False, False, True)]
    assert as_map(evaluate.counts_of(strata, ["new_p", "not_novel"]), "flag", "n") == {"new_p": 1, "not_novel": 1}


def test_structure(spark):
    assert structure.identity("ACDEFG", "CDEF") == 1.0
    pairs_ = structure.global_alignment("ACDE", "ACE", opened=-1)
    assert [p for p in pairs_ if None not in p][:2] == [(0, 0), (1, 1)]
    rng = np.random.default_rng(0)
    a = rng.random((10, 3))
    turn, _ = np.linalg.qr(rng.random((3, 3)))
    turn *= np.sign(np.linalg.det(turn))
    b = a @ turn + 3
    b[0] += 5
    rotation, shift, rmsd, used = structure.refined(a, b)
    assert rmsd < 1e-9 and 0 not in used
    with pytest.raises(ValueError):
        structure.refined(a[:2], b[:2])
    atoms = spark.createDataFrame([("A", 5, 1), ("A", 9, 2), ("A", 9, 3), ("B", 2, 4)], "chain string, r int, n int")
    assert sorted((x.chain, x.r, x.res_id) for x in structure.renumbered(atoms, by="chain", residue="r").collect()) == [("A", 5, 1), ("A", 9, 2), ("A", 9, 2), ("B", 2, 1)]
    assert structure.first_atom(atoms, by=["chain", "r"], order="n").count() == 3


def test_stages():
    assert stages.selected("a", run=["a"]) and not stages.selected("b", run=["a"]) and not stages.selected("a", skip=["a"])
    assert stages.run_stages([("a", lambda v: v + 1), ("b", lambda v: v * 10)], 1, skip=["a"]) == 10
    assert stages.batches(range(5), number=2) == [[0, 1, 2], [3, 4]] and stages.batches([], size=3) == []
    assert stages.fingerprint({"a": [1, 2], "b": 3}) == stages.fingerprint({"b": 3, "a": [2, 1]})


def test_dictionary():
    assert len(schemas.METRICS) == 28
    name = schemas.cluster_column("pli_qcov", 50, "components", True)
    assert name == "pli_qcov__50__strong__component" and "strongly" in schemas.cluster_description(name)
    assert all(text for _, _, text in schemas.dictionary(schemas.PROTEIN_SIMILARITY))


def test_communities_of_large_components_by_arrays(spark, monkeypatch):
    """Links of a component that no task holds are dealt out by vertex; rounds join nothing, and the result is the same."""
    rng = random.Random(8)
    edges = sorted({(a, b) for a in range(1, 70) for b in range(a) if b == a - 1 or rng.random() < (0.5 if a // 7 == b // 7 else 0.01)})
    saved, save = [], Workspace.save
    for kind, name in (("long", lambda v: 10 * v - 300), ("string", lambda v: f"v{v:02d}")):
        named = [(name(a), name(b)) for a, b in edges]
        ids = spark.createDataFrame([(name(v),) for v in range(70)], f"id {kind}")
        side = {r.id: r.t for r in ids.select("id", F.pmod(F.xxhash64("id"), F.lit(2)).alias("t")).collect()}
        want, df = best_moves(named, side.get, levels=4), pairs(spark, named, f"src {kind}, dst {kind}")
        monkeypatch.setattr(Workspace, "save", lambda self, df, tag: saved.append(tag) or save(self, df, tag))
        assert as_map(graph.communities(df, levels=4, held=5), "node", "community") == want
        assert "labels" not in saved and "blocks" in saved  # labels were joined and written once a round
        monkeypatch.setattr(Workspace, "save", save)


def test_tanimoto_by_chunks(spark, monkeypatch):
    """Chunks of fingerprints are compared without a row by pair or bit; all of them count, with ties by target."""
    rng = random.Random(9)
    rows = [(f"k{v:02d}", rng.sample(range(0, 4000, 250), rng.randint(0, 6))) for v in range(60)] + [("none", None), (None, [0])]
    df = spark.createDataFrame(rows, "key string, bits array<int>")
    monkeypatch.setattr(similarity.fingerprints_, "TARGETS", 7)
    monkeypatch.setattr(similarity.fingerprints_, "QUERIES", 4)
    found = similarity.tanimoto_top_k(df, df.where("key < 'k20'"), k=3)
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()  # it made a row by bit
    want, sets = set(), {k: set(b) for k, b in rows if k and b}
    for a in (k for k in sets if k < "k20"):
        near = [(-int(round(len(sets[a] & x) / len(sets[a] | x) * 100) / 100 * 100), b) for b, x in sets.items() if b != a and sets[a] & x]
        want |= {(a, b, -s, n) for n, (s, b) in enumerate(sorted(near)[:3], 1)}
    assert {(r["query"], r["target"], r["similarity"], r["rank"]) for r in found.collect()} == want
