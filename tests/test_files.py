import io
import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.operators import evaluate, loader, structure
from cairn.plans import commands, config, stages
from cairn.sources import parsers, sinks

CIF = """data_1ABC
#
_exptl.method 'X-RAY DIFFRACTION'
_refine.ls_d_res_high 2.10
_struct_keywords.pdbx_keywords "A 'B' C"
_exptl_crystal_grow.pH ?
#
loop_
_pdbx_sifts_unp_segments.asym_id
_pdbx_sifts_unp_segments.unp_acc
_pdbx_sifts_unp_segments.seq_id_start
_pdbx_sifts_unp_segments.seq_id_end
A P12345 1 90
A P12345 95 120
B 'Q 1' ? .
#
loop_
_pdbx_molecule.instance_id
_pdbx_molecule.asym_id
1 C
#
"""


def test_categories(spark):
    texts = spark.createDataFrame([("f", CIF), ("g", "data_x\n")], "file string, value string")
    info = {r.file: r for r in parsers.entry_info(texts).collect()}
    assert (info["f"].entry_determination_method, info["f"].entry_resolution, info["f"].entry_keywords, info["f"].entry_pH) == ("X-RAY DIFFRACTION", 2.1, "A 'B' C", None)
    assert info["g"].entry_resolution is None
    rows = {(r.asym_id, r.db, r.accession, r.start, r.end) for r in parsers.segments(texts).collect()}
    assert rows == {("A", "UniProt", "P12345", 1, 90), ("A", "UniProt", "P12345", 95, 120), ("B", "UniProt", "Q 1", None, None), ("C", "BIRD", "C", None, None)}


def test_listing_and_shards(spark):
    paths = spark.createDataFrame([("/x/ab/pdb_00001abc/",), ("/x/cd/pdb_00002cde",), ("/x/README",)], "path string")
    assert [r.entry for r in parsers.listed_entries(paths, short=True).collect()] == ["1abc", "2cde"]
    assert [r.entry for r in parsers.listed_entries(paths, codes=("ab",)).collect()] == ["pdb_00001abc"]
    assert parsers.listed_entries(paths, ids=("2cde",), codes=("ab",)).count() == 1
    assert parsers.archive_shards(["/a/ab.zip", "/a/cd.zip", "/a/long.zip", "/a/ab.txt"], shards=["ab"]) == {"ab": "/a/ab.zip"}


def test_archives(spark, tmp_path):
    files = spark.createDataFrame([("ab", "b.json", b"2"), ("ab", "a.json", b"1"), ("cd", "c.json", b"3")], "shard string, name string, content binary")
    done = {r.shard: r.n for r in sinks.write_archives(files, str(tmp_path)).collect()}
    assert done == {"ab": 2, "cd": 1} and sorted(p.name for p in tmp_path.iterdir()) == ["ab.zip", "cd.zip"]
    with zipfile.ZipFile(io.BytesIO((tmp_path / "ab.zip").read_bytes())) as archive:
        assert archive.namelist() == ["a.json", "b.json"] and archive.read("b.json") == b"2"
    first = (tmp_path / "ab.zip").read_bytes()
    sinks.write_archives(files, str(tmp_path)).collect()
    assert (tmp_path / "ab.zip").read_bytes() == first


def test_index_and_layout(spark, tmp_path):
    a = spark.createDataFrame([("s", "True")], "system_id string, flag string")
    b = spark.createDataFrame([("t", 1.0)], "system_id string, w double")
    path = str(tmp_path / "index")
    assert sinks.write_index([a, b], path, flags=("flag",), renamed={"w": "weight"})
    assert {r.system_id: (r.flag, r.weight) for r in spark.read.parquet(path).collect()} == {"s": (True, None), "t": (False, 1.0)}
    assert not sinks.write_index([a, b], path, flags=("flag",), renamed={"w": "weight"}) and sinks.write_index([a], path)
    sinks.write_ligands([a, a], str(tmp_path / "ligands"))
    assert spark.read.parquet(str(tmp_path / "ligands")).count() == 1
    folder = tmp_path / "clusters" / "cluster=components" / "metric=m"
    folder.mkdir(parents=True)
    a.toPandas().to_parquet(folder / "threshold=50.parquet")
    assert sinks.moved_into_folders(spark, str(tmp_path / "clusters")) == 1 and sinks.moved_into_folders(spark, str(tmp_path / "clusters")) == 0
    assert spark.read.parquet(str(tmp_path / "clusters")).first().threshold == 50


ATOMS = "system_id string, serial int, atom string, residue_name string, chain string, residue int, x double, y double, z double, element string, hetero boolean"


def test_structure_texts(spark, tmp_path):
    rows = [("s", 2, "C1'", "LIG", "1.B", 1, 1.5, -2.0, 30.25, "c", True), ("s", 1, "CA", "ALA", "1.A", 7, 0.0, 0.0, 0.0, "C", False)]
    atoms = spark.createDataFrame(rows, ATOMS)
    cif = sinks.cif_text(atoms).first().text
    assert cif.startswith("data_s\n#\nloop_\n_atom_site.group_PDB\n") and "\nATOM 1 C CA ALA 1.A 7 0.000 0.000 0.000\nHETATM 2 C \"C1'\" LIG 1.B 1 1.500 -2.000 30.250\n#" in cif
    (tmp_path / "t.cif").write_text(cif.replace('"C1\'"', "C1"))
    back = parsers.atoms(spark, str(tmp_path / "t.cif")).orderBy("line_no").collect()
    assert [(r.label_atom_id, r.label_asym_id, r.Cartn_z) for r in back] == [("CA", "1.A", 0.0), ("C1", "1.B", 30.25)]
    chains = sinks.pdb_chains(spark.createDataFrame([("s", "1.B", False), ("s", "1.A", True)], "system_id string, chain string, is_protein boolean"))
    names = {r.chain: r.name for r in chains.collect()}
    assert names == {"1.A": "A", "1.B": "B"}
    pdb = sinks.pdb_text(atoms.withColumn("chain", F.when(F.col("chain") == "1.A", "A").otherwise("B"))).first().text
    assert pdb.split("\n")[0] == "ATOM      1  CA  ALA A   7       0.000   0.000   0.000  1.00  0.00           C" and pdb.endswith("END\n")
    assert all(len(line) == 78 for line in pdb.split("\n")[:2])
    fasta = sinks.fasta(spark.createDataFrame([("s", "1.B", "AC"), ("s", "1.A", "GG"), ("s", "1.C", None)], "system_id string, chain string, sequence string"))
    assert fasta.first().text == ">1.A\nGG\n>1.B\nAC\n"
    assert sinks.write_texts(fasta, "sequences.fasta", str(tmp_path / "out")) == 1
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path / "out"))
    system = structure.System("1abc__1__1.A__1.L")
    with pytest.raises(ValueError):
        structure.System("1abc")
    assert system.entry_id == "1abc" and system.protein_chains == ["1.A"] and system.ligand_chains == ["1.L"]
    (tmp_path / "out" / system.system_id).mkdir()
    (tmp_path / "out" / system.system_id / "sequences.fasta").write_text(">1.A\nGG\n")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path / "out"))
    links = spark.createDataFrame([(system.system_id, "x", "apo"), ("other", "y", "apo")], "reference_system_id string, id string, kind string")
    system = structure.System(system.system_id, files=files, links=links)
    assert system.sequences == {"1.A": "GG"} and [r.id for r in system.linked_structures.collect()] == ["x"]
    with pytest.raises(KeyError):
        _ = system.entry


def test_structure_operators(spark):
    rng = np.random.default_rng(3)
    xyz = rng.random((12, 3)) * 9
    turn, _ = np.linalg.qr(rng.random((3, 3)))
    turn *= np.sign(np.linalg.det(turn))
    moved = xyz @ turn + 5
    moved[3] += 20
    make = lambda name, p: spark.createDataFrame([(name, k, "CA", "ALA", "A", k, *map(float, v), "C", False) for k, v in enumerate(p)], ATOMS)
    _, _, raw, fit = structure.superimposed_structures(make("a", xyz), make("b", moved))
    assert fit < 1e-6 < raw
    both = structure.concatenated(make("a", xyz), make("b", moved))
    assert both.count() == 24 and {r.system_id for r in both.collect()} == {"a--b"}
    assert structure.common_sequence("ACDE", "ACE", opened=-1)[:2] == [(0, 0), (1, 1)]
    one = structure.surface(np.zeros((1, 3)), ["C"])
    assert one[0] == pytest.approx(4 * np.pi * 3.1**2)
    apart = structure.buried_surface(np.zeros((1, 3)), np.full((1, 3), 50.0), (["C"], ["O"]))
    near = structure.buried_surface(np.zeros((1, 3)), np.array([[2.0, 0, 0]]), (["C"], ["O"]), number=2000)
    caps = 2 * np.pi * 3.1 * (3.1 - (4 + 3.1**2 - 2.92**2) / 4) + 2 * np.pi * 2.92 * (2.92 - (4 - 3.1**2 + 2.92**2) / 4)
    assert apart == 0 and near == pytest.approx(caps, rel=0.02)
    residues = spark.createDataFrame([("a", "A", 0, "ALA", True), ("a", "A", 99, "ALA", False), ("a", "A", 1, "XXX", True)], "system_id string, chain string, residue int, residue_name string, resolved boolean")
    masks = {r.residue: r["mask"] for r in structure.atom_mask(make("a", xyz), residues, {"ALA": ("N", "CA", "CB")}).collect()}
    assert masks == {0: [0, 1, 0], 99: [0, 0, 0], 1: []}


def test_loader(spark):
    a, b = np.ones((2, 3)), np.ones((4, 1))
    stacked = loader.pad_and_stack([a, b])
    assert stacked.shape == (2, 4, 3) and stacked[0, 2, 0] == loader.PAD and stacked[1, 0, 1] == loader.PAD
    assert loader.padded(np.ones((2, 3, 4)), 5, [0, 2]).shape == (5, 3, 5)
    with pytest.raises(ValueError):
        loader.pad_and_stack([np.ones(2), np.ones((2, 2))])
    rows = [(s, k, "CA" if k % 2 else "N", "ALA", "A", k, float(k), 0.0, 0.0, "C", False) for s, n in (("s", 4), ("t", 2), ("u", 3)) for k in range(n)]
    atoms = spark.createDataFrame(rows, ATOMS)
    only = loader.transformed(atoms, loader.select_atoms(["CA"]))
    assert {r.atom for r in only.collect()} == {"CA"} and loader.transformed(atoms, loader.select_atoms(["CA"], negate=True)).count() == 5
    features = loader.featurized(atoms, loader.default_features(), ["coordinates", "calpha_coordinates", "elements", "atom_mask"])
    found = list(loader.batches(features, size=2))
    assert [ids for ids, _ in found] == [["s", "t"], ["u"]] and found[0][1]["coordinates"].shape == (2, 4, 3)
    assert found[0][1]["coordinates"][1, 2, 0] == loader.PAD and found[0][1]["coordinates"][0, 3, 0] == 3.0 and found[0][1]["elements"][0, 0].tolist() == [1, 0, 0, 0, 0, 0]
    assert sorted(i for ids, _ in loader.batches(features, size=2, shuffle=3) for i in ids) == ["s", "t", "u"]


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("flow:\n  make_ligands_batch_size: 7\nsplit:\n  num_test: 3\n  leakage: [1, 2]\n")
    found = config.load({"flow": {"make_ligands_batch_size": 5, "force_update": True}}, file=str(tmp_path / "c.yaml"), args=["scatter.two_char_codes=01", "flow.skip_specific_stages=a,b"])
    assert found["flow"].make_ligands_batch_size == 7 and found["flow"].force_update and found["flow"].skip_specific_stages == ["a", "b"]
    assert found["split"].leakage == (1, 2) and found["scatter"].two_char_codes == ["01"] and found["quality"].max_entry_r == 0.4
    assert config.load(contents="split: {num_val: 9}")["split"].num_val == 9
    for wrong in ({"nope": {}}, {"flow": {"nope": 1}}, {"split": {"nope": 1}}, {"flow": {"cluster_metrics": ["nope"]}}):
        with pytest.raises(ValueError):
            config.load(wrong)
    with pytest.raises(ValueError):
        config.arguments(["flow"])
    assert stages.fingerprint(config.plain(config.load())) == stages.fingerprint(config.plain(config.load({"flow": {}})))


def test_scatters_and_retry():
    def scatter_make():
        return [[1], [2]]

    assert stages.controlled(scatter_make, skip=["make"])() == [[]] and stages.controlled(scatter_make, run=["make"])() == [[1], [2]]
    assert stages.scattered(lambda c: c[0] * 2, [[1], [], [2]], sum) == 6
    assert stages.scatter_entries("cab", done="a", size=1) == [["b"], ["c"]] and stages.scatter_entries("cab", done="a", size=3, force=True) == [["a", "b", "c"]]
    assert stages.scatter_clusters(["m"], [50, 70], done=[("m", 50)], force=False) == [[("m", 70)]] and len(stages.scatter_clusters(["m", "n"], [50], most=1)) == 1
    assert len(stages.scatter_partitions()) == 38 and len(stages.scatter_leakage(["p"], "protein")) == 28 and len(stages.scatter_leakage(["p"], "ligand", only_first=True)) == 1
    assert stages.scatter_splits({}) == [[]] and stages.scatter_splits({"a.yaml": "split: {num_test: 2}"})[0][0][0].num_test == 2
    calls, waits = [], []

    def fails():
        calls.append(1)
        if len(calls) < 3:
            raise OSError

    stages.retried(fails, wait=waits.append)()
    assert waits == [1.0, 2.0]
    with pytest.raises(OSError):
        stages.retried(lambda: (_ for _ in ()).throw(OSError()), tries=2, wait=waits.append)()


def test_summary(spark):
    lig = spark.createDataFrame([("m", "r", 1, "A", 10, 0.5, 0.4, 1.0, "x", "y"), ("m", "r", 1, "B", 30, 0.9, None, 3.0, None, None)], "model string, reference string, rank int, chain string, atom_count int, lddt_pli double, lddt_lp double, bisy_rmsd double, best_rmsd_chain string, best_pli_chain string")
    systems = spark.createDataFrame([("m", "r", 1, 2, 4, 1, 1, 1, 2)], "model string, reference string, rank int, num_reference_ligands int, num_model_ligands int, num_reference_proteins int, num_model_proteins int, mapped_reference_ligands int, mapped_model_ligands int")
    checks = spark.createDataFrame([("m", "r", 1, "A", "ok", 1.0), ("m", "r", 1, "B", "ok", 0.0)], "model string, reference string, rank int, chain string, check string, value double")
    rows = {r.chain: r for r in evaluate.summary(lig, systems, checks).collect()}
    assert set(rows) == {"A", "B"} and rows["A"].bisy_rmsd_ave == 2.0 and rows["A"].bisy_rmsd_wave == 2.5 and rows["B"].lddt_lp_ave == 0.4
    assert rows["A"].fraction_reference_ligands_mapped == 0.5 and rows["A"].posebusters == {"ok": 0.25} and rows["A"].best_rmsd_matched_reference_chain == "x"
    assert evaluate.summary(lig, systems, checks, by_weight_and_number=True).first().posebusters == {"ok": 0.125}


def fake_scorer(row):
    if row["id"] == "bad":
        raise ValueError("no file")
    return [{"chain": "A", "lddt_pli": 0.5, "lddt_lp": None, "bisy_rmsd": 1.0, "bisy_rmsd_wave": 1.0 + row["rank"], "lddt_pli_wave": 0.9}]


def test_commands(spark, tmp_path):
    (tmp_path / "p.csv").write_text("id,reference_system_id,receptor_file,ligand_file,rank,confidence\na,s1,,l.sdf,1,0.5\nb,s1,,l.sdf,2,0.4\nc,s2,,l.sdf,1,\nbad,s3,,l.sdf,1,\n")
    args = ["--prediction_file", str(tmp_path / "p.csv"), "--output_dir", str(tmp_path / "o"), "--scorer", "tests.test_files:fake_scorer", "--num_processes", "2"]
    found = commands.score(args, spark)
    assert found.where("error is null").count() == 3 and found.where("error is not null").first().error == "ValueError: no file"
    assert commands.score(args, spark).where("error is null").count() == 3
    spark.createDataFrame([("s1", "test"), ("s2", "test"), ("t1", "train")], "system_id string, split string").write.parquet(str(tmp_path / "split.parquet"))
    rows = [("t1", "s1", "pocket_qcov", 80), ("s1", "t1", "pocket_qcov", 60), ("t1", "s2", "tanimoto_similarity_max", 10), ("s2", "t1", "protein_seqsim_weighted_sum", 90)]
    spark.createDataFrame(rows, "query_system string, target_system string, metric string, similarity int").write.parquet(str(tmp_path / "scores.parquet"))
    spark.createDataFrame([("s1", True), ("s2", None)], "system_id string, system_pass_validation_criteria boolean").write.parquet(str(tmp_path / "index.parquet"))
    strata = commands.stratify(["--split_file", str(tmp_path / "split.parquet"), "--output_dir", str(tmp_path / "o"), "--scores", str(tmp_path / "scores.parquet"), "--index", str(tmp_path / "index.parquet")], spark)
    by = {r.system_id: r for r in strata.collect()}
    assert (by["s1"].pocket_qcov, by["s1"].novel_pocket_pli, by["s1"].novel_ligand, by["s1"].passes_quality) == (80.0, False, True, True)
    assert by["s2"].novel_protein is False and by["s2"].passes_quality is False
    table = commands.report(["--score_file", str(tmp_path / "o" / "scores.parquet"), "--data_file", str(tmp_path / "o" / "test_set.parquet"), "--output_dir", str(tmp_path / "o")], spark).collect()
    assert [r["Subset"] for r in table][0] == "all"
    written = next((tmp_path / "o" / "results.csv").glob("*.csv")).read_text().split("\n")
    assert written[0] == "Subset,No. systems,Top n,Success Rate (%),Median RMSD,Stdev RMSD,Mean lDDT-PLI,Stdev lDDT-PLI" and written[1].startswith("all,2,10,100.0,2.0")
    trend = {(r.metric, r.cutoff, r.analysis): r["mean"] for r in spark.read.parquet(str(tmp_path / "o" / "trends.parquet")).collect()}
    assert trend["pocket_qcov", 10.0, "CDF"] == 0.0 and trend["pocket_qcov", 20.0, "CDF"] == 0.5 and trend["pocket_qcov", 100.0, "XS"] == 0.0
    (tmp_path / "src" / "r1" / "index").mkdir(parents=True)
    (tmp_path / "src" / "r1" / "index" / "f").write_text("x")
    copy = ["--source", str(tmp_path / "src"), "--target", str(tmp_path / "dst"), "--release", "r1"]
    assert commands.copy(copy) == ["index"] and commands.copy(copy) == [] and (tmp_path / "dst" / "r1" / "index" / "f").exists()
    shown = commands.show(["--index", str(tmp_path / "split.parquet"), "--wanted", "*", "--columns", "system_id", "--filters", json.dumps([["split", "==", "train"]])], spark)
    assert [r.system_id for r in shown.collect()] == ["t1"]
    with pytest.raises(SystemExit):
        commands.main(["nope"])


def test_reports(spark):
    systems = spark.createDataFrame([("a", "train", "x", 1, 1, True), ("b", "train", "x", 2, 1, None), ("c", "test", None, 2, 3, False)], "system_id string, split string, cl string, system_num_protein_chains int, system_proper_num_ligand_chains int, f boolean")
    assert {(r.split, r.column): r.n for r in evaluate.diversity(systems, ["cl", "system_id"]).collect()} == {("train", "cl"): 1, ("train", "system_id"): 2, ("test", "system_id"): 1}
    parts = {r.split: r for r in evaluate.chain_composition(systems).collect()}
    assert (parts["train"].single_single, parts["train"].multiple_single, parts["test"].multiple_multiple) == (1, 1, 1)
    assert {r.split: r.f for r in evaluate.flag_percent(systems, ["f"]).collect()} == {"train": 50.0, "test": 0.0}
    split = spark.createDataFrame([("a", "val", 1)], "system_id string, split string, k int")
    assert evaluate.merged(split, systems).columns[-2:] == ["split_y", "k"]
    strata = {"train_vs_test": spark.createDataFrame([("c", 5.0, True), ("c", 5.0, True)], "system_id string, m double, novel_all boolean")}
    found = evaluate.with_strata(systems, strata)
    assert found.count() == 3 and "m__train_vs_test" in found.columns and "novel_all" in found.columns
