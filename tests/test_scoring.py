import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cairn.operators import ligands, scoring, series, similarity

MATRIX = """# a small matrix
   A  C  D
A  4  0 -2
C  0  9 -3
D -2 -3  6
"""


def test_sequence_similarity(spark):
    matrix = scoring.read_substitutions(MATRIX.split("\n"))
    assert matrix["A", "C"] == 0 and matrix["D", "D"] == 6
    rows = spark.createDataFrame([("ACD-", "ACDA"), ("AAx", "ACX"), ("--", "AA"), ("BD", "DD")], "q string, t string")
    found = [r.s for r in rows.select(scoring.sequence_similarity(F.col("q"), F.col("t"), matrix).alias("s")).collect()]
    assert found == [1.0, pytest.approx(2 / 3), None, 1.0]  # X stands for A, B for D


def test_mapped_alignments(spark):
    shape = "query string, target string, qcov double, fident double, seqsim double, lddt double, qstart int, tstart int, qaln string, taln string, lddtfull string"
    rows = [
        ("pdb_00001abc_xyz-enrich.cif_a", "pdb_00002xyz_xyz-enrich.cif.gz_b", 0.5, 0.4, 0.6, 0.8, 1, 2, "ac-d", "A-Cd", "0.9,0.1"),
        ("pdb_00001abc_xyz-enrich.cif_z", "pdb_00002xyz_xyz-enrich.cif_b", 0.5, 0.4, 0.6, 0.8, 1, 2, "a", "a", "1"),
    ]
    chains = spark.createDataFrame([("1abc", "a", "A"), ("2xyz", "b", "B")], "pdb_id string, auth_id string, asym_id string")
    table = spark.createDataFrame(rows, shape)
    found = scoring.mapped_alignments(table, chains, aligner="foldseek", search_db="holo").collect()
    assert len(found) == 1 and (found[0].query_entry, found[0].query_chain, found[0].target_entry, found[0].target_chain) == ("1abc", "A", "2xyz", "B")
    assert found[0].fident_qcov == pytest.approx(0.2) and found[0].lddt_qcov == pytest.approx(0.4) and found[0].qaln == "AC-D"
    pred = table.withColumns({"target": F.lit("AF-P1-F1-model_v4.cif")})
    one = scoring.mapped_alignments(pred, chains, aligner="foldseek", search_db="pred").first()
    assert (one.target_entry, one.target_chain) == ("P1", "A")
    numbers = spark.createDataFrame([("1abc", "A", k, k + 10) for k in range(4)] + [("2xyz", "B", k, k + 20) for k in range(2)], "pdb_id string, asym_id string, index int, number int")
    pairs = scoring.aligned_residues(scoring.mapped_alignments(table, chains, aligner="foldseek", search_db="holo"), numbers).orderBy("query_pos").collect()
    assert [(r.query_pos, r.target_pos, r.same, r.lddt) for r in pairs] == [(10, 21, 1, 0.9), (12, None, 1, 0.1)]


def score_case(seed):
    """Alignments of random chains, with systems, pockets and interactions."""
    rng = random.Random(seed)
    chains = {(f"e{e}", c): rng.randint(5, 9) for e in range(4) for c in "AB"}
    alignments = []
    for q in chains:
        for t in chains:
            for source in ("foldseek", "mmseqs"):
                if q != t and rng.random() < 0.55:
                    n = min(chains[q], chains[t])
                    qa = "".join(rng.choice("AC") for _ in range(n))
                    ta = "".join(rng.choice("AC") for _ in range(n))
                    s = {k: rng.randint(1, 8) / 8 for k in ("qcov", "fident", "seqsim", "lddt")}
                    alignments.append((*q, *t, source, s["qcov"], s["fident"], s["seqsim"], s["lddt"] if source == "foldseek" else None, qa, ta, [rng.randint(0, 4) / 4 for _ in range(n)]))
    systems = {}
    for e in range(4):
        for b in range(2):
            held = rng.sample("AB", rng.randint(1, 2))
            systems[f"e{e}__{b}"] = [(f"e{e}", c, f"{b}.{c}") for c in sorted(held)]
    pockets = {(s, i, r) for s, held in systems.items() for e, c, i in held for r in range(chains[e, c]) if rng.random() < 0.6}
    kinds = [(s, i, r, rng.choice("xyz")) for s, i, r in sorted(pockets) for _ in range(rng.randint(0, 3))]
    return chains, alignments, systems, pockets, kinds


def brute_scores(case):
    chains, alignments, systems, pockets, kinds = case
    by = {}
    for a in alignments:
        by.setdefault((a[0], a[1], a[2], a[3]), {})[a[4]] = a
    names = {}

    def pair_scores(found):
        out = {}
        for source, a in found.items():
            v = {"qcov": a[5], "fident": a[6], "seqsim": a[7], "fident_qcov": a[6] * a[5], "seqsim_qcov": a[7] * a[5]}
            if source == "foldseek":
                v |= {"lddt": a[8], "lddt_qcov": a[8] * a[5]}
            for k, x in v.items():
                out[k, source] = x
        return out

    for q, qs in systems.items():
        for t, ts in systems.items():
            if q == t:
                continue
            met = {(x, y): by[x[0], x[1], y[0], y[1]] for x in qs for y in ts if (x[0], x[1], y[0], y[1]) in by}
            if not met:
                continue
            scores = {}
            for (x, _), found in met.items():
                for (k, source), v in pair_scores(found).items():
                    if v > 0:
                        scores[f"protein_{k}_max", source] = max(scores.get((f"protein_{k}_max", source), 0), v)
                        best = scores.get(("w", k, source), (0, 0))
                        scores["w", k, source] = max(best, (v * chains[x[0], x[1]], v))
            for key in [k for k in scores if k[0] == "w"]:
                scores[f"protein_{key[1]}_weighted_max", key[2]] = scores.pop(key)[1]
            mapper = ("lddt_qcov", "foldseek") if any("foldseek" in f for f in met.values()) else ("fident_qcov", "mmseqs")
            open_ = {p: pair_scores(f)[mapper] for p, f in met.items() if mapper in pair_scores(f)}
            chosen = []
            while open_:
                x, y = min(open_, key=lambda p: (-open_[p], p[0][2], p[1][2]))
                chosen.append((x, y))
                open_ = {p: s for p, s in open_.items() if p[0] != x and p[1] != y}
            size = sum(chains[x[0], x[1]] for x in qs)
            n_pocket = len({p for p in pockets if p[0] == q})
            mine = Counter(k for k in kinds if k[0] == q)
            for x, y in chosen:
                for (k, source), v in pair_scores(met[x, y]).items():
                    key = (f"protein_{k}_weighted_sum", source)
                    scores[key] = scores.get(key, 0) + v * chains[x[0], x[1]] / size
                for source, a in met[x, y].items():
                    for r, (c, d, l) in enumerate(zip(a[9], a[10], a[11])):
                        l = l if source == "foldseek" else 0.0  # noqa: E741
                        if (q, x[2], r) not in pockets:
                            continue
                        both = (t, y[2], r) in pockets
                        same = float(c == d)
                        for k, v in (("lddt", l), ("fident", same), ("qcov", both), ("lddt_qcov", l * both), ("fident_qcov", same * both)):
                            key = (f"pocket_{k}", source)
                            scores[key] = scores.get(key, 0) + v / n_pocket
                        if both:
                            a_, b_ = (Counter(k[3] for k in kinds if k[:3] == (s, i, r)) for s, i in ((q, x[2]), (t, y[2])))
                            if a_ and b_:
                                key = ("pli_qcov", source)
                                scores[key] = scores.get(key, 0) + sum((a_ & b_).values()) / sum(mine.values())
                                key = ("pli_unique_qcov", source)
                                scores[key] = scores.get(key, 0) + len(set(a_) & set(b_)) / len(mine)
            for metric in {k[0] for k in scores}:
                f, m = (scores.get((metric, s), 0) for s in ("foldseek", "mmseqs"))
                if max(f, m) > 0:
                    names[q, t, metric] = (round(max(f, m) * 100), "both" if abs(f - m) < 1e-6 else "foldseek" if f > m else "mmseqs")
    return names


@pytest.mark.parametrize("seed", [1, 5])
def test_scores_equal_brute_force(spark, seed):
    case = score_case(seed)
    chains, alignments, systems, pockets, kinds = case
    shape = "query_entry string, query_chain string, target_entry string, target_chain string, source string, qcov double, fident double, seqsim double, lddt double, qaln string, taln string, l array<double>"
    mapped = spark.createDataFrame(alignments, shape)
    mapped = mapped.withColumns({
        "qstart": F.lit(1), "tstart": F.lit(1), "fident_qcov": F.col("fident") * F.col("qcov"), "seqsim_qcov": F.col("seqsim") * F.col("qcov"), "lddt_qcov": F.col("lddt") * F.col("qcov"),
        "lddtfull": F.when(F.col("source") == "foldseek", F.array_join(F.col("l").cast("array<string>"), ",")),
    })
    system_chains = spark.createDataFrame([(s, e, i, c, chains[e, c], k) for s, held in systems.items() for k, (e, c, i) in enumerate(held)], "system_id string, pdb_id string, instance string, asym_id string, length int, place int")
    numbers = spark.createDataFrame([(e, c, k, k) for (e, c), n in chains.items() for k in range(n)], "pdb_id string, asym_id string, index int, number int")
    pocket = spark.createDataFrame(sorted(pockets), "system_id string, instance string, residue int")
    inter = spark.createDataFrame(kinds, "system_id string, instance string, residue int, kind string")
    rows = scoring.score_systems(mapped, system_chains, numbers, pocket, inter).collect()
    found = {(r.query_system, r.target_system, r.metric): (r.similarity, r.source) for r in rows}
    want = brute_scores(case)
    assert sorted((k, v, found.get(k)) for k, v in want.items() if found.get(k) != v) == [] and set(found) == set(want)
    assert found == want and all(r.protein_mapping and r.search_db == "holo" for r in rows)
    apo = scoring.score_systems(mapped, system_chains, numbers, pocket, inter, search_db="apo", holo_chains=spark.createDataFrame([("e1", "A")], "pdb_id string, asym_id string")).collect()
    assert {r.target_system for r in apo} <= {f"{e}_{c}" for e, c in chains} - {"e1_A"} and not any(r.metric.startswith("pli") for r in apo)
    with pytest.raises(ValueError):
        scoring.score_systems(mapped, system_chains, numbers, pocket, inter, search_db="other")


def test_select_links(spark):
    rows = [("1abc__1", "2xyz_A", "m", 90), ("1abc__1", "2xyz_A", "n", 95), ("1abc__1", "1abc_B", "m", 99), ("1abc__1", "1abc_B", "n", 99), ("1abc__1", "3zzz_A", "m", 99), ("1abc__1", "4www_A", "m", 80), ("1abc__1", "4www_A", "n", 80)]
    scores = spark.createDataFrame(rows, "query_system string, target_system string, metric string, similarity int")
    ranking = spark.createDataFrame([("2xyz", 2.0), ("4www", 1.0), ("3zzz", None)], "target_id string, sort_score double")
    found = similarity.select_links(scores, {"m": 80, "n": 80}, ranking, most=2).orderBy("rank").collect()
    assert [r.id for r in found] == ["4www_A", "2xyz_A"]
    assert similarity.select_links(scores, {"m": 80, "n": 80}, ranking, most=1, ascending=False).first().id == "2xyz_A"


def test_ligand_numbers_and_synonyms(spark):
    rows = [("s1", "K2", "C"), ("s1", "K1", "CC"), ("s2", "K1", "CC"), ("s2", "", "?"), ("s3", None, "?"), ("s2", "K1", "CC")]
    by_key, by_system = ligands.numbered_ligands(spark.createDataFrame(rows, "system_id string, inchikeys string, ligand_rdkit_canonical_smiles string"))
    assert {r.inchikeys: r.number_id_by_inchikeys for r in by_key.collect()} == {"K1": 0, "K2": 1}
    assert {r.system_id: r.multi_number_id_by_inchikeys_withl for r in by_system.collect()} == {"s1": "l0__l1", "s2": "l0"}
    codes = spark.createDataFrame([("1AB", "C"), ("ABC", "C"), ("LONG", "CC"), ("9LONG", "CC"), ("ONE", "N"), ("UNK", "C")], "code string, smiles string")
    same = ligands.synonyms(codes, dummies=("UNK",))
    assert {r.code: r.unique_code for r in same.collect()} == {"1AB": "ABC", "ABC": "ABC", "LONG": "LONG", "9LONG": "LONG"}
    asked = spark.createDataFrame([("1AB",), ("ZZZ",)], "code string")
    assert {r.code for r in ligands.with_synonyms(asked, same).collect()} == {"1AB", "ABC", "ZZZ"}


def test_ligand_clusters_and_similarity(spark):
    index = spark.createDataFrame([("s", 300.0, "C", False, False), ("s", 400.0, "CC", False, False), ("t", 500.0, "C", True, False), ("t", 100.0, "CC", False, False), ("u", 1.0, "?", False, False)], "system_id string, ligand_molecular_weight double, ligand_rdkit_canonical_smiles string, ligand_is_ion boolean, ligand_is_artifact boolean")
    numbers = spark.createDataFrame([("C", 0), ("CC", 1)], "ligand_rdkit_canonical_smiles string, number_id_by_inchikeys int")
    labels = spark.createDataFrame([("0", "c0"), ("1", "c1")], "system_id string, label string")
    assert {r.system_id: r.label for r in ligands.clusters_by_system(labels, numbers, index).collect()} == {"s": "c1", "t": "c1"}
    scores = spark.createDataFrame([(0, 5, 40), (6, 0, 70), (1, 5, 90), (5, 6, 99)], "query_ligand_id int, target_ligand_id int, tanimoto_similarity_max int")
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "id int")
    systems = spark.createDataFrame([("a", 5), ("b", 6), ("b", 5), ("c", 0)], "system_id string, number_id_by_inchikeys int")
    found = {r.system_id: r.tanimoto_similarity_max for r in ligands.cross_similarity(scores, ids(0, 1), ids(5, 6), systems).collect()}
    assert found == {"a": 90, "b": 90}
    split = spark.createDataFrame([("a", 5, "test"), ("b", 6, "test"), ("c", 0, "train"), ("d", 1, "train")], "system_id string, number_id_by_inchikeys int, split string")
    assert {r.system_id: r.tanimoto_similarity_max for r in ligands.max_similarity(scores, split, metric="tanimoto_similarity_max").collect()} == {"a": 90, "b": 70}


def test_matched_pairs(spark):
    pairs = spark.createDataFrame([("k1", "k2", 20, 10, 8), ("k1", "k2", 20, 10, 9), ("k1", "k3", 20, 5, 4)], "inchikey1 string, inchikey2 string, size1 int, size2 int, constant_size int")
    similar = ligands.pair_similarity(pairs)
    assert {(r.key, r.other): r.similarity for r in similar.collect()} == {("k1", "k2"): 45.0, ("k2", "k1"): 90.0}
    rows = spark.createDataFrame([("s", "k2", "test"), ("t", "k9", "test"), ("u", "k1", "train"), ("v", "k5", "test"), ("w", "k5", "train")], "system_id string, inchikey string, split string")
    found = {r.system_id: (r.mmp_similarity_max, r.nearest) for r in ligands.max_pair_similarity(rows, similar).collect()}
    assert found == {"s": (90.0, "k1"), "t": (0.0, None), "v": (100.0, "k5")}
    assert ligands.max_pair_similarity(rows, similar, same=1.0).where("system_id = 'v'").first().mmp_similarity_max == 1.0


def test_congeneric_series(spark, tmp_path):
    (tmp_path / "p.csv").write_text("CC\tCN\t7\tABC\tC>>N\t*CCO\nCC\tCO\t007\tXYZ\tC>>O\t*CCO\nC\tN\tABC\tXYZ\tx\t*C*\n")
    pairs = series.read_pairs(spark, str(tmp_path / "p.csv"))
    assert pairs.first().id1 == "007"
    systems = spark.createDataFrame([("s1", "007", "p", "q"), ("s2", "ABC", "p", "q"), ("s3", "XYZ", "p", "r"), ("s4", "ABC", None, "q")], "system_id string, ligand_unique_ccd_code string, protein_label string, pocket_label string")
    sizes = spark.createDataFrame([("*CCO", 12), ("*C*", 30)], "constant string, heavy_atoms int")
    found = series.congeneric_series(pairs, systems, constant_sizes=sizes)
    assert sorted((r.system_id, r.congeneric_id, r.n_members) for r in found.collect()) == [("s1", "c0", 2), ("s2", "c0", 2)]
    assert series.congeneric_series(pairs, systems, constant_sizes=sizes, min_constant=13).count() == 0
    subset = spark.createDataFrame([("s1",), ("s2",)], "id string")
    assert {r.system_id for r in series.in_series(found, subset, least=2).collect()} == {"s1", "s2"} and series.in_series(found, subset, least=3).count() == 0
    index = spark.createDataFrame([("C>N", "A"), ("CC", "B"), ("CA", "B"), ("", "D"), (None, "E")], "ligand_rdkit_canonical_smiles string, ligand_unique_ccd_code string")
    assert [tuple(r) for r in series.fragment_input(index).collect()] == [("B", "CA")]
