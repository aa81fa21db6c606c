"""Readers of annotation files: each gives a DataFrame of the parsed rows."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.functions.scalars import clean_number, p_affinity, parse_range


def domains(lines: DataFrame, *, text_col: str = "value") -> DataFrame:
    """Domain table: tab-separated lines after comments; one row per range of a domain.

    Columns pdb, chain, domainid, domain, pdb_from, pdb_to.
    """
    cells = F.split(F.col(text_col), "\t")
    rows = lines.where(~F.col(text_col).startswith("#") & (F.trim(text_col) != "")).select(
        cells[1].alias("domainid"), cells[4].alias("pdb"), cells[6].alias("ranges"), cells[13].alias("domain")
    )
    rows = rows.select("domainid", "pdb", "domain", F.explode(F.split("ranges", ",")).alias("piece"))
    found = parse_range(F.trim("piece"))
    return rows.select(
        "pdb", found["chain"].alias("chain"), "domainid", "domain", found["start"].alias("pdb_from"), found["end"].alias("pdb_to")
    )


def classes(spark: SparkSession, folder: str) -> DataFrame:
    """Protein classes: headerless tab-separated files named by class; distinct rows with the shard of the accession."""
    raw = spark.read.option("sep", "\t").schema("id string, family string, name string").csv(folder)
    accession = F.regexp_extract("id", r"UniProtKB=([A-Z0-9]+)", 1)
    return (
        raw.select(accession.alias("uniprotac"), F.col("family").alias("panther"), F.col("_metadata.file_name").alias("panther_class"))
        .where("uniprotac <> ''")
        .distinct()
        .withColumn("shard", F.right("uniprotac", F.lit(1)))
    )


def binding_affinity(rows: DataFrame, *, id_col: str, ki: str, kd: str) -> DataFrame:
    """Median affinity by id, of the inhibition constant where there is one, else of the dissociation constant (nM)."""
    value = F.coalesce(clean_number(F.col(ki)), clean_number(F.col(kd)))
    rows = rows.select(F.col(id_col).alias("id"), p_affinity(value).alias("p")).where("id is not null and p is not null")
    return rows.groupBy("id").agg(F.median("p").alias("pchembl"))


def listed_affinity(rows: DataFrame, *, id_col: str, values: str, mark: str = ";") -> DataFrame:
    """Median of listed values by id."""
    rows = rows.select(F.col(id_col).alias("id"), F.explode(F.split(values, mark)).alias("v"))
    return rows.select("id", F.col("v").try_cast("double").alias("v")).where("id is not null and v is not null").groupBy("id").agg(F.median("v").alias("pchembl"))


def ragged_affinity(rows: DataFrame, *, order: str, within: str, entry: str, ligand: str, kind: str, value: str, unit: str) -> DataFrame:
    """Affinities of a table whose entry is written once and left out below; association constants are skipped.

    ``within`` names the file or block, so that carrying an entry forward never orders the whole table.
    """
    above = Window.partitionBy(within).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("entry", F.last(F.when(F.col(entry) != "", F.col(entry)), ignorenulls=True).over(above))
    rows = rows.where((F.col(kind) != "Ka") & (F.col(ligand) != ""))
    p = p_affinity(clean_number(F.col(value)), F.col(unit))
    rows = rows.select(F.concat_ws("_", "entry", F.regexp_replace(ligand, ":.*", "")).alias("id"), p.alias("p")).where("p is not null")
    return rows.groupBy("id").agg(F.median("p").alias("pchembl"))


def preferred_affinity(tables: dict[str, DataFrame]) -> DataFrame:
    """One affinity by id, of the first table that has it; order is preference."""
    parts = [df.select("id", "pchembl", F.lit(k).alias("preference")) for k, df in enumerate(tables.values())]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.where("pchembl is not null").groupBy("id").agg(F.min_by("pchembl", "preference").alias("pchembl"))


def components(spark: SparkSession, path: str) -> DataFrame:
    """Chemical components of an mmCIF file by block: id, name, weight, canonical and isomeric SMILES, InChIKey.

    Blocks are records cut at ``data_``, so that a large file is split between tasks; blocks that lack a value go.
    """
    blocks = spark.read.option("lineSep", "\ndata_").text(path)

    def item(name: str):
        return F.trim(F.regexp_replace(F.regexp_extract("value", rf"(?m)^_chem_comp\.{name}\s+(.+?)\s*$", 1), "^[\"']|[\"']$", ""))

    def descriptor(kind: str):
        return F.regexp_extract("value", rf"(?m)^\S+\s+{kind}\s+(?:\"[^\"]*\"|'[^']*'|\S+)\s+\S+\s+[\"']?([^\"'\s]+)", 1)

    rows = blocks.select(
        item("id").alias("binder_id"),
        item("name").alias("name"),
        item("formula_weight").try_cast("double").alias("weight"),
        descriptor("SMILES").alias("canonical_smiles"),
        descriptor("SMILES_CANONICAL").alias("isomeric_smiles"),
        descriptor("InChIKey").alias("inchikey"),
    )
    wanted = [c for c in rows.columns if c != "weight"]
    return rows.where(" and ".join(f"{c} <> ''" for c in wanted) + " and weight is not null")


def kinases(structures: DataFrame, info: DataFrame) -> DataFrame:
    """Structures with what is known of their kinase."""
    return structures.join(info.drop(*[c for c in info.columns if c in structures.columns and c != "kinase_ID"]), "kinase_ID", "left")


def cofactors(spark: SparkSession, path: str) -> DataFrame:
    """Class and code of cofactors, of a JSON object class → list of {cofactors, EC}."""
    kind = "map<string, array<struct<cofactors: array<string>, EC: array<string>>>>"
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)).alias("class", "groups"))
    return raw.select("class", F.explode("groups").alias("g")).select("class", F.explode("g.cofactors").alias("code"), F.col("g.EC").alias("EC"))


def entries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Entry documents, a JSON object per file; a malformed one gives nulls in place of ending the job."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("entry"))


def zipped_entries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Entry documents within zip archives, one row each: archive, member and entry."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def unzip(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in archive.namelist():
                        if name.endswith(".json"):
                            yield pd.DataFrame({"file": [file], "member": [name], "text": [archive.read(name).decode()]})

    return files.mapInPandas(unzip, "file string, member string, text string").select("file", "member", F.from_json("text", schema).alias("entry"))


#: Attributes of a validation report that are read.
REPORT = ("PDB-resolution", "PDB-R", "PDB-Rfree", "clashscore", "percent-rama-outliers", "percent-rota-outliers", "DataCompleteness", "DCC_R", "meanI_over_sigI", "EDS_R")


def validation(spark: SparkSession, path: str) -> DataFrame:
    """Entry metrics of validation reports (XML); what isn't available is null."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.regexp_extract("value", r"(?s)<Entry\s([^>]*)>", 1).alias("attrs"))

    def value(name: str):
        return F.regexp_extract(F.concat(F.lit(" "), "attrs"), rf"\s{name}=\"([^\"]*)\"", 1).try_cast("double").alias(name.lower().replace("-", "_"))

    return raw.select("file", *[value(n) for n in REPORT])


ATOM_COLUMNS = {
    "group_PDB": "string", "label_atom_id": "string", "label_comp_id": "string", "label_asym_id": "string", "label_seq_id": "int",
    "Cartn_x": "double", "Cartn_y": "double", "Cartn_z": "double", "type_symbol": "string",
}


def atoms(spark: SparkSession, path: str) -> DataFrame:
    """Atom table of mmCIF files: the rows of the atom_site loop, of the first model where models are numbered."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.regexp_extract("value", r"(?s)loop_\s*((?:_atom_site\.\S+\s*)+)(.*?)(?=\n#|\nloop_|\z)", 0).alias("block"))
    names = F.regexp_extract_all("block", F.lit(r"_atom_site\.(\S+)"), F.lit(1))
    rows = text.select("file", names.alias("names"), F.posexplode(F.split("block", "\n")).alias("line_no", "line")).where(F.col("line").rlike("^(ATOM|HETATM)"))
    cells = rows.select("file", "line_no", F.map_from_arrays("names", F.slice(F.split(F.trim("line"), r"\s+"), F.lit(1), F.size("names"))).alias("c"))
    first = F.coalesce(F.try_element_at("c", F.lit("pdbx_PDB_model_num")), F.lit("1")) == "1"
    return cells.where(first).select("file", "line_no", *[F.try_element_at("c", F.lit(k)).try_cast(t).alias(k) for k, t in ATOM_COLUMNS.items()])


def ligands(entry_rows: DataFrame) -> DataFrame:
    """Ligands of holo systems with a SMILES, one row by ligand id, of entries as nested documents."""
    systems = entry_rows.select("entry.pdb_id", F.explode("entry.systems").alias("system_id", "s")).where("s.system_type = 'holo'")
    rows = systems.select("pdb_id", "system_id", F.explode("s.ligands").alias("l")).select("pdb_id", "system_id", "l.*")
    return rows.where("ligand_rdkit_canonical_smiles is not null and ligand_rdkit_canonical_smiles <> ''").dropDuplicates(["ligand_id"])


def cells(texts: DataFrame, category: str, columns: tuple[str, ...], *, key: str = "file", text_col: str = "value") -> DataFrame:
    """Rows of an mmCIF category, of a loop or of single items, as texts: the key and ``columns``; ``?`` and ``.`` are null.

    Values are words or quoted; a loop's rows are cut by its number of columns. Each file is one row of the input.
    """
    word = r"'(?:[^']|'(?=\S))*'|\"(?:[^\"]|\"(?=\S))*\"|[^\s]+"
    block = F.regexp_extract(text_col, rf"(?s)(?:^|\n)loop_\s*\n((?:\s*_{category}\.\S+\s*\n)+)(.*?)(?=\n#|\nloop_|\n_|\ndata_|\z)", 1)
    body = F.regexp_extract(text_col, rf"(?s)(?:^|\n)loop_\s*\n((?:\s*_{category}\.\S+\s*\n)+)(.*?)(?=\n#|\nloop_|\n_|\ndata_|\z)", 2)
    names = F.regexp_extract_all(block, F.lit(rf"_{category}\.(\S+)"), F.lit(1))
    words = F.regexp_extract_all(body, F.lit(f"({word})"), F.lit(1))
    loop = texts.select(F.col(key), names.alias("names"), words.alias("words")).where(F.size("names") > 0)
    width = F.size("names")
    rows = F.transform(F.sequence(F.lit(0), F.floor(F.size("words") / width).cast("int") - 1), lambda i: F.map_from_arrays("names", F.slice("words", i * width + 1, width)))
    many = loop.where(F.size("words") >= width).select(key, F.explode(rows).alias("c"))
    pair = rf"(?m)^_{category}\.(\S+)[ \t]+({word})[ \t]*$"
    single = texts.select(F.col(key), F.regexp_extract_all(text_col, F.lit(pair), F.lit(1)).alias("k"), F.regexp_extract_all(text_col, F.lit(pair), F.lit(2)).alias("v"))
    one = single.where(F.size("k") > 0).select(key, F.map_from_arrays("k", "v").alias("c"))

    def value(name: str):
        raw = F.regexp_replace(F.try_element_at("c", F.lit(name)), r"^(['\"])(.*)\1$", "$2")
        return F.when(~raw.isin("?", "."), raw).alias(name)

    return many.union(one).select(key, *[value(c) for c in columns])


#: Where the facts of an entry are: column, category, item. Fixed names.
ENTRY_INFO = (
    ("entry_oligomeric_state", "pdbx_struct_assembly", "oligomeric_details"),
    ("entry_determination_method", "exptl", "method"),
    ("entry_keywords", "struct_keywords", "pdbx_keywords"),
    ("entry_pH", "exptl_crystal_grow", "pH"),
    ("entry_resolution", "refine", "ls_d_res_high"),
)


def entry_info(texts: DataFrame, *, key: str = "file") -> DataFrame:
    """Facts of entries, the first value of each; a file without any has nulls."""
    found = texts.select(key).distinct()
    for name, category, item in ENTRY_INFO:
        rows = cells(texts, category, (item,), key=key).where(F.col(item).isNotNull())
        found = found.join(rows.groupBy(key).agg(F.first(item).alias(name)), key, "left")
    return found.withColumn("entry_resolution", F.col("entry_resolution").try_cast("double"))


def segments(texts: DataFrame, *, key: str = "file") -> DataFrame:
    """Mappings of chains of entries: key, asym_id, db, accession, start, end; of molecules of the dictionary (BIRD) without a range."""
    xref = cells(texts, "pdbx_sifts_xref_db_segments", ("asym_id", "xref_db", "xref_db_acc", "seq_id_start", "seq_id_end"), key=key)
    found = xref.select(key, "asym_id", F.col("xref_db").alias("db"), F.col("xref_db_acc").alias("accession"), F.col("seq_id_start").alias("start"), F.col("seq_id_end").alias("end"))
    unp = cells(texts, "pdbx_sifts_unp_segments", ("asym_id", "unp_acc", "seq_id_start", "seq_id_end"), key=key)
    found = found.union(unp.select(key, "asym_id", F.lit("UniProt"), "unp_acc", "seq_id_start", "seq_id_end"))
    bird = cells(texts, "pdbx_molecule", ("asym_id",), key=key)
    found = found.union(bird.select(key, "asym_id", F.lit("BIRD"), "asym_id", F.lit(None).cast("string"), F.lit(None).cast("string")))
    return found.where("asym_id is not null").withColumns({c: F.col(c).try_cast("int") for c in ("start", "end")}).distinct()


def alignments(spark: SparkSession, path: str, *, structure: bool) -> DataFrame:
    """Alignment rows of an external aligner's table: ids, coverage, identity, starts and aligned texts; of structures lddt and lddtfull."""
    names = "query string, target string, qlen int, lddt double, qcov double, fident double, alnlen int, qstart int, qend int, tstart int, tend int, qaln string, taln string, lddtfull string"
    shape = names if structure else names.replace("lddt double, ", "").replace(", lddtfull string", "")
    return spark.read.option("sep", "\t").schema(shape).csv(path)


def listed_entries(paths: DataFrame, *, codes: tuple[str, ...] = (), ids: tuple[str, ...] = (), short: bool = False) -> DataFrame:
    """Entry ids of paths (one column) whose last part is ``pdb_0000xxxx``: column ``entry``, in full or as four characters, in order."""
    name = F.regexp_extract(paths.columns[0], r"([^/]+)/?$", 1)
    rows = paths.select(name.alias("entry")).where(F.col("entry").rlike("^(pdb_0000)?[0-9a-z]{4}$")).distinct()
    four = F.right("entry", F.lit(4))
    if ids:
        rows = rows.where(four.isin([i[-4:] for i in ids]))
    elif codes:
        rows = rows.where(F.substring(four, 2, 2).isin(list(codes)))
    return rows.select((four if short else F.col("entry")).alias("entry")).distinct().orderBy("entry")


def archive_shards(paths: list[str], *, shards: list[str] | None = None) -> dict[str, str]:
    """Archives by shard, of paths ``…/xx.zip``; other names are left out, and all but ``shards`` where they are given."""
    found = {}
    for path in sorted(paths):
        name = path.rsplit("/", 1)[-1]
        if name.endswith(".zip") and len(name) == 6 and (shards is None or name[:2] in shards):
            found[name[:2]] = path
    return found
