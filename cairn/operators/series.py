"""Matched series: sets of members that share a constant part and a pocket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.scalars import pad_id
from cairn.operators.ordered import numbered_rows


def matched_series(pairs: DataFrame, pockets: DataFrame, *, min_members: int = 2) -> DataFrame:
    """Series of members: ``constant``, ``pocket``, ``members`` (in order, distinct), ``n_members``.

    ``pairs`` has id1, id2 and the constant part they share; ``pockets`` an id and a pocket, of several rows by id. A
    pair counts in each pocket that both of its ids have.
    """
    of = pockets.select("id", "pocket").distinct()
    left = pairs.select("constant", "id1", "id2").join(of.withColumnRenamed("id", "id1"), "id1")
    both = left.join(of.withColumnRenamed("id", "id2"), ["id2", "pocket"], "left_semi")
    members = both.select("constant", "pocket", F.explode(F.array("id1", "id2")).alias("member")).distinct()
    found = members.groupBy("constant", "pocket").agg(F.array_sort(F.collect_list("member")).alias("members"))
    return found.withColumn("n_members", F.size("members").cast("long")).where(F.col("n_members") >= min_members)


def with_series(systems: DataFrame, series: DataFrame, *, member: str, pocket: str) -> DataFrame:
    """Systems whose member and pocket are in a series, one row by series."""
    rows = series.select("constant", F.col("pocket").alias(pocket), "n_members", F.explode("members").alias(member))
    return systems.join(rows, [member, pocket])


def single_attachment(fragments: DataFrame, *, constant: str = "constant", mark: str = "*", exclude: str = "[<>]") -> DataFrame:
    """Fragment pairs whose constant part has one attachment and no excluded character."""
    c = F.col(constant)
    return fragments.where((F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))) == 1).where(~c.rlike(exclude))


#: Columns of a file of matched pairs. Fixed names.
PAIR_COLUMNS = ("SMILES1", "SMILES2", "id1", "id2", "V1>>V2", "CONSTANT")


def fragment_input(index: DataFrame) -> DataFrame:
    """What the external fragmenter reads: a SMILES by ligand code, the first in order; odd bonds, empty and missing ones are left out."""
    smiles, code = F.col("ligand_rdkit_canonical_smiles"), F.col("ligand_unique_ccd_code")
    rows = index.where(smiles.isNotNull() & code.isNotNull() & (smiles != "") & ~smiles.rlike("[<>]"))
    return rows.groupBy(code.alias("id")).agg(F.min(smiles).alias("smiles"))


def read_pairs(spark, path: str) -> DataFrame:
    """Matched pairs of a tab-separated file without a header: smiles1, smiles2, id1, id2, change, constant; ids that are numbers are padded."""
    names = ("smiles1", "smiles2", "id1", "id2", "change", "constant")
    rows = spark.read.option("sep", "\t").schema(", ".join(f"{n} string" for n in names)).csv(path)
    return rows.withColumns({c: pad_id(F.col(c)) for c in ("id1", "id2")})


def congeneric_series(pairs: DataFrame, systems: DataFrame, *, constant_sizes: DataFrame, min_constant: int = 10) -> DataFrame:
    """Systems of matched series: system_id, congeneric_id, constant, pocket, members, n_members, member, const_size.

    ``pairs`` has id1, id2, constant; ``systems`` system_id, ligand_unique_ccd_code, protein_label and pocket_label;
    ``constant_sizes`` constant and heavy atoms. Pairs count with one attachment, and within pockets (both labels) that
    both codes have; series with a constant part of fewer than ``min_constant`` atoms are left out. Ids number the series in
    the order of constant and pocket.
    """
    pocket = F.concat_ws("_", "protein_label", "pocket_label")
    of = systems.where("protein_label is not null and pocket_label is not null").select("system_id", F.col("ligand_unique_ccd_code").alias("id"), pocket.alias("pocket"))
    found = matched_series(single_attachment(pairs), of.select("id", "pocket"))
    found = found.join(constant_sizes.select("constant", F.col("heavy_atoms").alias("const_size")), "constant").where(F.col("const_size") >= min_constant)
    found = numbered_rows(found, ["constant", "pocket"], "number")
    found = found.withColumn("congeneric_id", F.concat(F.lit("c"), (F.col("number") - 1).cast("string"))).drop("number")
    rows = found.withColumn("member", F.explode("members"))
    return of.withColumnRenamed("id", "member").join(rows, ["member", "pocket"]).distinct()


def in_series(series: DataFrame, subset: DataFrame, *, least: int) -> DataFrame:
    """Systems of the subset (one column) in a series of which the subset has at least ``least`` different members: system_id."""
    rows = series.join(subset.select(F.col(subset.columns[0]).alias("system_id")).distinct(), "system_id", "left_semi")
    wide = rows.groupBy("congeneric_id").agg(F.count_distinct("member").alias("n")).where(F.col("n") >= least)
    return rows.join(wide, "congeneric_id", "left_semi").select("system_id").distinct()
