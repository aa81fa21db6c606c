import json
import zipfile

from pyspark.sql import functions as F

from cairn.sources import parsers, sinks
from cairn.streaming import events


def test_domains(spark):
    line = "\t".join(["1", "e1abcA1", "", "", "1abc", "A", "A:9-16,B:-3-7", "", "", "a", "x", "h", "t", "fam", "", ""])
    found = parsers.domains(spark.createDataFrame([("#c",), (line,)], "value string")).collect()
    assert [(r.pdb, r.chain, r.pdb_from, r.pdb_to, r.domain) for r in found] == [("1abc", "A", "9", "16", "fam"), ("1abc", "B", "-3", "7", "fam")]


def test_affinities(spark):
    rows = spark.createDataFrame([("x", "1", None), ("x", None, "100"), ("y", "0", None)], "id string, ki string, kd string")
    first = parsers.binding_affinity(rows, id_col="id", ki="ki", kd="kd")
    assert [(r.id, r.pchembl) for r in first.collect()] == [("x", 8.0)]
    second = parsers.listed_affinity(spark.createDataFrame([("x", "5;7"), ("y", "6;")], "id string, v string"), id_col="id", values="v")
    best = {r.id: r.pchembl for r in parsers.preferred_affinity({"a": first, "b": second}).collect()}
    assert best == {"x": 8.0, "y": 6.0}
    ragged = spark.createDataFrame(
        [(1, "f", "1abc", "", "", "", ""), (2, "f", "", "LIG:A:1", "Kd", "10", "nM"), (3, "f", "", "ZZZ:A:1", "Ka", "1", "nM"), (4, "f", "2abc", "", "", "", "")],
        "n int, f string, entry string, lig string, kind string, v string, u string",
    )
    found = parsers.ragged_affinity(ragged, order="n", within="f", entry="entry", ligand="lig", kind="kind", value="v", unit="u").collect()
    assert [(r.id, r.pchembl) for r in found] == [("1abc_LIG", 8.0)]


def test_components_and_atoms(spark, tmp_path):
    block = "_chem_comp.id {0}\n_chem_comp.name 'a name'\n_chem_comp.formula_weight 12.5\nloop_\n_pdbx_chem_comp_descriptor.x\n{0} SMILES tool 1 CCO\n{0} SMILES_CANONICAL tool 1 OCC\n{0} InChIKey InChI 1 KEY-{0}\n"
    (tmp_path / "c.cif").write_text("data_AAA\n" + block.format("AAA") + "#\ndata_BBB\n" + block.format("BBB") + "data_CCC\n_chem_comp.id CCC\n")
    found = parsers.components(spark, str(tmp_path / "c.cif")).collect()
    assert [(r.binder_id, r.weight, r.canonical_smiles, r.inchikey) for r in found] == [("AAA", 12.5, "CCO", "KEY-AAA"), ("BBB", 12.5, "CCO", "KEY-BBB")]
    names = ["group_PDB", "label_atom_id", "label_asym_id", "label_seq_id", "Cartn_x", "Cartn_y", "Cartn_z", "type_symbol"]
    (tmp_path / "s.cif").write_text("data_x\nloop_\n" + "".join(f"_atom_site.{n}\n" for n in names) + "ATOM CA A 1 1.0 2.0 3.5 C\nHETATM O B . 0 0 0 O\n#\n")
    rows = parsers.atoms(spark, str(tmp_path / "s.cif")).orderBy("line_no").collect()
    assert [(r.label_atom_id, r.label_seq_id, r.Cartn_z) for r in rows] == [("CA", 1, 3.5), ("O", None, 0.0)]


def test_documents(spark, tmp_path):
    schema = "pdb_id string, systems map<string, struct<system_type: string, ligands: array<struct<ligand_id: string, ligand_rdkit_canonical_smiles: string>>>>"
    entry = {"pdb_id": "1abc", "systems": {"s": {"system_type": "holo", "ligands": [{"ligand_id": "l", "ligand_rdkit_canonical_smiles": "C"}, {"ligand_id": "m", "ligand_rdkit_canonical_smiles": ""}]}}}
    with zipfile.ZipFile(tmp_path / "ab.zip", "w") as archive:
        archive.writestr("1abc.json", json.dumps(entry))
        archive.writestr("note.txt", "x")
        archive.writestr("bad.json", "{")
    rows = parsers.zipped_entries(spark, str(tmp_path / "ab.zip"), schema)
    assert rows.count() == 2 and [(r.pdb_id, r.ligand_id) for r in parsers.ligands(rows).collect()] == [("1abc", "l")]
    (tmp_path / "v.xml").write_text('<x><Entry PDB-resolution="2.1" PDB-R="NotAvailable" clashscore="3"/></x>')
    report = parsers.validation(spark, str(tmp_path / "v.xml")).first()
    assert (report.pdb_resolution, report.pdb_r, report.clashscore) == (2.1, None, 3.0)
    (tmp_path / "co.json").write_text(json.dumps({"Heme": [{"cofactors": ["HEM", "HEA"], "EC": ["1"]}]}))
    assert [(r["class"], r.code) for r in parsers.cofactors(spark, str(tmp_path / "co.json")).collect()] == [("Heme", "HEM"), ("Heme", "HEA")]


def test_sinks(spark, tmp_path):
    scores = spark.createDataFrame([("a", "b", "m1", 50), ("a", "c", "m2", 60)], "query_system string, target_system string, metric string, similarity int")
    sinks.write_scores(scores, f"{tmp_path}/s")
    back = spark.read.parquet(f"{tmp_path}/s")
    assert back.where("metric = 'm2'").count() == 1 and dict(back.dtypes)["similarity"] == "tinyint"
    sinks.compact(back, f"{tmp_path}/k", key="query_system", files=1)
    assert spark.read.parquet(f"{tmp_path}/k").count() == 2
    both = sinks.union_all([scores, scores.select("metric", F.lit(1).alias("extra"))])
    assert both.count() == 4 and "extra" in both.columns
    links = spark.createDataFrame([("r", "i", 1, 5)], "reference_system_id string, id string, n int, old int")
    new = spark.createDataFrame([("r", "i", 9)], "reference_system_id string, id string, old int")
    assert sinks.consolidate_links(links, new).first().old == 9


def test_stream(spark, tmp_path):
    rows = [(1, "2024-01-01 00:10:00", "a", 2.0), (2, "2024-01-01 00:20:00", "a", 3.0), (3, "2024-01-01 05:00:00", "b", 1.0)]
    df = spark.createDataFrame(rows, "event_id long, ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(f"{tmp_path}/in")
    stream = events.windowed(events.read(spark, f"{tmp_path}/in", "event_id long, ts timestamp, event_type string, value double"))
    query = stream.writeStream.format("memory").queryName("seen").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert sorted((r.event_type, r.n, r.total) for r in spark.table("seen").collect()) == [("a", 2, 5.0), ("b", 1, 1.0)]
    for _ in range(2):
        events.append_missing(df, f"{tmp_path}/out", "event_id")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3
