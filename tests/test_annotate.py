import pytest
from pyspark.sql import functions as F

from cairn.operators import annotate


def ligand(asym, **more):
    base = {
        "instance": 1, "asym_id": asym, "ccd_code": f"L{asym}", "unique_ccd_code": f"L{asym}", "smiles": "C", "molecular_weight": 300.0, "qed": 0.5,
        "num_heavy_atoms": 10, "num_resolved_heavy_atoms": 10, "num_unresolved_heavy_atoms": 0, "is_ion": False, "is_artifact": False, "is_cofactor": False,
        "is_covalent": False, "protein_chains": ["1.A"], "neighboring_ligands": [], "interacting_ligands": [], "neighboring_residues": {"1.A": [5, 6, 7]},
        "interacting_residues": {"1.A": [6]}, "interactions": {"1.A": {6: ["h", "h", "p"]}}, "crystal_contacts": [],
    }
    return {**base, **more}


def chain(asym, **more):
    residues = {k: {"index": k - 1, "auth_number": str(k + 100)} for k in range(1, 11)}
    base = {"asym_id": asym, "auth_id": asym.lower(), "entity_id": "1", "chain_type": "polypeptide(L)", "length": 10, "holo": None, "mappings": {}, "residues": residues}
    return {**base, **more}


@pytest.fixture(scope="module")
def entries(spark):
    first = {
        "pdb_id": "1abc", "release_date": "2020-01-01", "resolution": 2.0, "validation": {"resolution": 2.0, "r": 0.2, "rfree": 0.25, "r_minus_rfree": 0.05},
        "chains": {"A": chain("A", mappings={"UniProt": {"P1": [{"start": 1, "end": 9}]}}), "B": chain("B", entity_id="2"), "C": chain("C"), "L": chain("L"), "M": chain("M"), "I": chain("I")},
        "systems": [
            {"biounit_id": "1", "ligands": [ligand("L"), ligand("M", num_heavy_atoms=None, is_artifact=True, protein_chains=["1.A", "1.B"], interactions={"1.B": {3: ["x"]}}, interacting_residues={"1.B": [3]}, neighboring_residues={"1.B": [3, 4]})]},
            {"biounit_id": "2", "ligands": [ligand("I", is_ion=True, protein_chains=["2.B"], interactions=None, crystal_contacts=[{"chain": "A", "residue": 6, "atoms": [1]}, {"chain": "C", "residue": 2, "atoms": [1, 2]}, {"chain": "I", "residue": 1, "atoms": [7]}])]},
            {"biounit_id": "3", "ligands": [ligand("L", protein_chains=[])]},
        ],
    }
    rows = [(first,), ({"pdb_id": "2xyz", "chains": {}, "systems": []},), ({"pdb_id": "3nul"},)]
    return spark.createDataFrame(rows, f"entry {annotate.ENTRY}")


def test_systems(entries):
    found = {r.system_id: r for r in annotate.systems(entries).collect()}
    assert set(found) == {"1abc__1__1.A_1.B__1.L_1.M", "1abc__2__2.B__1.I"}
    one, ion = found["1abc__1__1.A_1.B__1.L_1.M"], found["1abc__2__2.B__1.I"]
    assert (one.system_type, ion.system_type) == ("holo", "ion")
    assert (one.system_num_protein_chains, one.system_proper_num_protein_chains, one.system_num_ligand_chains, one.system_proper_num_ligand_chains) == (2, 1, 2, 1)
    assert (one.system_num_interactions, one.system_proper_num_interactions, one.system_num_unique_interactions) == (4, 3, 3)
    assert one.system_num_pocket_residues == 5 and one.system_num_heavy_atoms is None and ion.system_num_heavy_atoms == 10
    assert ion.system_proper_ligand_max_molecular_weight == -1.0 and one.system_proper_ligand_max_molecular_weight == 300.0
    # A:6 lies in the pocket and I is a ligand, so that only C:2 counts.
    assert (ion.system_num_crystal_contacted_residues, ion.system_num_atoms_with_crystal_contacts) == (1, 2)
    assert ion.system_fraction_atoms_with_crystal_contacts == pytest.approx(0.2) and one.system_fraction_atoms_with_crystal_contacts is None


def test_ligands_and_index(entries):
    found = {r.ligand_id: r for r in annotate.ligands(entries).collect()}
    assert set(found) == {"1abc__1__1.L", "1abc__1__1.M", "1abc__2__1.I", "1abc__3__1.L"}
    first = found["1abc__1__1.L"]
    assert (first.ligand_num_interactions, first.ligand_num_unique_interactions, first.ligand_num_pocket_residues) == (3, 2, 3)
    assert sorted(first.ligand_interactions) == ["1.A_6_h", "1.A_6_h", "1.A_6_p"] and first.ligand_is_proper and not found["1abc__2__1.I"].ligand_is_proper
    assert found["1abc__2__1.I"].ligand_num_interactions == 0 and found["1abc__2__1.I"].ligand_interactions == []
    index = annotate.flatten(entries).collect()
    assert len(index) == 3 and all(r.entry_pass_validation_criteria for r in index) and {r.system_type for r in index} == {"holo", "ion"}


def test_system_interactions_leave_out_artifacts(entries):
    rows = entries.select(F.explode("entry.systems").alias("s")).select(annotate.system_interactions(F.col("s.ligands")).alias("i")).collect()
    assert sorted((x.chain, x.residue, x.kind) for x in rows[0].i) == [("1.A", 6, "h"), ("1.A", 6, "h"), ("1.A", 6, "p")]


def test_prune_and_residues(entries):
    kept = {r.p: r.n for r in annotate.pruned(entries).select(F.col("entry.pdb_id").alias("p"), F.size("entry.systems").alias("n")).collect()}
    assert kept["1abc"] == 2 and kept["2xyz"] == 0
    few = annotate.pruned(entries, most_ligand_chains=1).select(F.transform("entry.systems", lambda s: s["biounit_id"]).alias("b")).first().b
    assert few == ["3"]
    assert annotate.pruned(entries, most_protein_chains=0, count_interacting=True).select(F.size("entry.systems").alias("n")).first().n == 0
    chains = annotate.only_pocket_residues(entries).first().entry.chains
    assert sorted(chains["A"].residues) == [5, 6, 7] and sorted(chains["B"].residues) == [3, 4] and chains["C"].residues == {}


def test_chain_labels_and_names(entries):
    labelled = annotate.label_chains(entries)
    chains = labelled.first().entry.chains
    assert (chains["A"].holo, chains["B"].holo, chains["C"].holo, chains["L"].holo) == (True, True, False, None)
    names = lambda kind, aligner: sorted(r.name for r in annotate.chains_for_alignment(labelled, kind, aligner).collect())
    assert names("holo", "mmseqs") == ["1abc_a", "1abc_b"] and names("pred", "foldseek") == ["AF-P1-F1-model_v4_A"]
    assert names("apo", "mmseqs") == []  # chain C is of the entity of a holo chain
    assert names("holo", "foldseek")[0] == "pdb_00001abc_xyz-enrich.cif_a"
    with pytest.raises(ValueError):
        annotate.chains_for_alignment(labelled, "other", "mmseqs")


def test_quality(spark):
    rows = [(2.0, 0.2, 0.25, 0.05), (3.6, 0.2, 0.25, 0.05), (2.0, None, 0.25, 0.05), (2.0, 0.2, 0.25, 0.06)]
    table = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, v struct<resolution:double,r:double,rfree:double,r_minus_rfree:double>")
    assert [r.p for r in table.orderBy("k").select(annotate.entry_quality(F.col("v")).alias("p")).collect()] == [True, False, False, False]
    good = {
        "entry_pass": True, "num_unresolved_heavy_atoms": 1, "num_covalent_ligands": 1, "fraction_atoms_with_crystal_contacts": 0.0, "pocket_num_unresolved_heavy_atoms": 0,
        **{f"{p}_{c}": v for p in ("ligand", "pocket") for c, v in (("max_alt_count", 1), ("average_occupancy", 0.8), ("average_rscc", 0.9), ("average_rsr", 0.3), ("percent_outliers_clashes", 0.0))},
    }
    bad = [{}, {"entry_pass": None}, {"num_unresolved_heavy_atoms": 2}, {"ligand_average_rscc": None}, {"pocket_percent_outliers_clashes": 100.0}, {"ligand_percent_outliers_clashes": 0.1}]
    import pandas as pd

    data = pd.DataFrame([{**good, **b, "k": k} for k, b in enumerate(bad)])
    shape = "entry_pass boolean, " + ", ".join(f"{c} double" for c in list(good)[1:]) + ", k int"
    rows = [tuple(None if pd.isna(v) else (bool(v) if c == "entry_pass" else int(v) if c == "k" else float(v)) for c, v in r.items()) for r in data[[*good, "k"]].to_dict("records")]
    frame = spark.createDataFrame(rows, shape)
    found = frame.orderBy("k").select(annotate.system_quality({c: F.col(c) for c in good}).alias("p")).collect()
    assert [r.p for r in found] == [True, False, False, False, True, False]


def test_residue_summary(spark):
    shape = "g string, processed boolean, rsr double, rsrz double, rscc double, average_occupancy double, average_b_factor double, alt_count int, atom_count int, heavy_atom_count int, num_unresolved_heavy_atoms int, unknown_residue boolean, outliers array<string>"
    rows = [
        ("a", True, 0.2, 1.0, 0.9, 1.0, 10.0, 1, 5, 4, 0, False, ["clashes"]),
        ("a", True, float("nan"), 2.0, 0.7, 0.5, 30.0, 2, 7, 6, 1, True, []),
        ("a", False, None, None, None, None, None, None, None, None, None, None, None),
        ("b", False, None, None, None, None, None, None, None, None, None, None, None),
    ]
    found = annotate.residue_summary(spark.createDataFrame(rows, shape), ["g"]).collect()
    assert len(found) == 1
    r = found[0]
    assert (r.num_residues, r.num_processed_residues, r.max_alt_count, r.atom_count, r.unknown_residue_count) == (3, 2, 2, 12, 1)
    assert (r.average_rsr, r.average_rsrz, r.average_b_factor) == (0.2, 1.5, 20.0)
    assert r.percent_rscc_over_threshold == pytest.approx(100 / 3) and r.percent_outliers_clashes == pytest.approx(100 / 3) and r.percent_rsr_under_threshold == pytest.approx(100 / 3)


def test_chain_classes(spark):
    rows = [("polypeptide", 15, False, False), ("polypeptide", 15, False, True), ("polypeptide", 9, False, True), ("polynucleotide", 12, False, False), ("polypeptide", 50, True, True), ("water", 1, True, False), ("other", 1, None, None)]
    table = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, kind string, length int, bird boolean, up boolean").orderBy("k")
    found = table.select(annotate.is_ligand_chain(F.col("kind"), F.col("length"), F.col("bird"), F.col("up")).alias("l")).collect()
    assert [r.l for r in found] == [True, False, True, False, True, False, True]
    kinds = spark.createDataFrame([("non-polymer",), ("polyribonucleotide",), ("?",)], "t string").select(annotate.chain_label(F.col("t")).alias("l"))
    assert [r.l for r in kinds.collect()] == ["SMALLMOLECULE", "RNA", "UNKNOWN"]


def test_mappings_and_domains(spark):
    chains = spark.createDataFrame([("1abc", "A", "a"), ("1abc", "B", "b")], "pdb_id string, asym_id string, auth_id string")
    segments = spark.createDataFrame([("1abc", "A", "UniProt", "P1", 1, 9), ("1abc", "A", "UniProt", "P1", 12, 20), ("1abc", "A", "CATH", "x", 1, 5)], "pdb_id string, asym_id string, db string, accession string, start int, end int")
    maps = annotate.external_mappings(segments).first().mappings
    assert [tuple(r) for r in maps["UniProt"]["P1"]] == [(1, 9), (12, 20)] and list(maps["CATH"]) == ["x"]
    domains = spark.createDataFrame([("1abc", "a", "d1", "fold", "1", "6A"), ("1abc", "a", "d2", "other", "6", "30")], "pdb string, chain string, domainid string, domain string, pdb_from string, pdb_to string")
    ranges = annotate.domain_ranges(chains, domains)
    pockets = spark.createDataFrame([("s", "1abc", "A", k) for k in (4, 5, 6, 7, 8)] + [("t", "1abc", "A", 2), ("t", "1abc", "A", 40)], "system_id string, pdb_id string, asym_id string, residue int")
    found = {r.system_id: (r.domain, r.label, r.n) for r in annotate.pocket_domains(pockets, ranges, width=4).collect()}
    assert found == {"s": ("d2", "other", 3), "t": ("d1", "fold", 1)}
    classes = spark.createDataFrame([("P1", "PTHR1", "1")], "uniprotac string, panther string, shard string")
    assert {(r.domain, r.start) for r in annotate.class_ranges(segments, classes).collect()} == {("PTHR1", 1), ("PTHR1", 12)}
    kinases = spark.createDataFrame([("1abc", "a", "P1", "ABL1"), ("1abc", "b", "P1", "ABL1")], "pdb string, chain string, uniprot string, kinase string")
    assert {(r.asym_id, r.domain) for r in annotate.kinase_ranges(chains, segments, kinases).collect()} == {("A", "ABL1")}


def test_links_and_proximity(spark):
    names = [f"ptnr{n}_{p}" for n in (1, 2) for p in ("auth_seq_id", "label_comp_id", "label_asym_id", "label_seq_id", "label_atom_id")]
    rows = [
        ("e", "covale", "10", "CYS", "A", "9", "SG", "1", "LIG", "L", None, "C1"),
        ("e", "covale", "1", "LIG", "L", None, "C1", "1", "LIG", "L", None, "C2"),
        ("e", "hydrog", "1", "LIG", "L", None, "C1", "1", "A", "R", "1", "N1"),
        ("e", "hydrog", "1", "G", "R", "2", "N1", "1", "LIG", "L", None, "C1"),
        ("e", "disulf", "1", "CYS", "A", "2", "SG", "1", "CYS", "A", "3", "SG"),
    ]
    found = annotate.connections(spark.createDataFrame(rows, "pdb_id string, conn_type_id string, " + ", ".join(f"{n} string" for n in names)))
    assert sorted(r.kind for r in found.collect()) == ["covale", "covale", "hydrog"]
    ligands = spark.createDataFrame([("e", "L", ["A"]), ("e", "M", ["A"])], "pdb_id string, asym_id string, neighbors array<string>")
    links = annotate.linkages(found, ligands).collect()
    assert [(r.asym_id, r.linkages) for r in links] == [("L", ["10:CYS:A:9:SG__1:LIG:L:?:C1"])]
    near = spark.createDataFrame([("a", ["b"]), ("b", []), ("c", ["zz"]), ("d", ["b"])], "ligand_id string, near array<string>")
    assert {r.ligand_id: r.component for r in annotate.proximity_systems(near).collect()} == {"a": "a", "b": "a", "c": "c", "d": "a"}


def test_interface_gaps(spark):
    rows = [("e", "A", k, "CA", False, float(k), 0.0, 0.0) for k in (1, 2, 5, 6)] + [("e", "B", k, "CA", False, float(k), 3.0, 0.0) for k in (1, 2, 3)] + [("e", "L", 1, "C1", True, 5.0, 3.0, 0.0), ("f", "A", 1, "CA", False, 0.0, 0.0, 0.0)]
    atoms = spark.createDataFrame(rows, "pdb_id string, chain string, residue int, atom string, hetero boolean, x double, y double, z double")
    points = {(r[1], r[2]): r[5:] for r in rows if r[0] == "e"}
    far = lambda p, q: sum((a - b) ** 2 for a, b in zip(points[p], points[q])) ** 0.5
    edges = {("A", 2), ("A", 5)}
    want = {}
    for a in "ABL":
        for b in "ABL":
            if a < b and any(p[0] in (a, b) for p in edges):
                inter = {x for p in points for q in points if p[0] == a and q[0] == b and far(p, q) <= 4.5 for x in (p, q)}
                if inter:
                    want[a, b] = [n for radius in (4, 8) for near in [[p for p in inter if any(far(p, g) <= radius for g in edges if g[0] in (a, b))]] for n in (len(near), len([p for p in near if p in edges]))]
    found = {(r.chain1, r.chain2): list(r)[3:] for r in annotate.interface_gaps(atoms).collect()}
    assert found == want and len(want) == 2
    sums = {r.chain: r.interface_atom_gaps_4A for r in annotate.chain_gaps(annotate.interface_gaps(atoms)).collect()}
    assert sums["A"] == want["A", "B"][0] + want["A", "L"][0]


def test_structure_checks(spark):
    files = spark.createDataFrame([("s", 1, "L", 3), ("s", 1, "M", 0)], "system_id string, ligand_instance int, ligand_asym_id string, size int")
    checks = annotate.structure_checks(files, lambda row: {"fits": 6 / row["size"] == 2}, ("fits",))
    assert {r.ligand_asym_id: r.fits for r in checks.collect()} == {"L": True, "M": None}
    index = spark.createDataFrame([("s", 1, "L"), ("s", 1, "N")], "system_id string, ligand_instance int, ligand_asym_id string")
    assert {r.ligand_asym_id: r.fits for r in annotate.with_checks(index, checks.drop("size")).collect()} == {"L": True, "N": None}
