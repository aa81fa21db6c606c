"""Ligands: numbers, synonyms, clusters by system, similarity across sets, matched pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions import scalars
from cairn.operators.enrich import first_by, numbered
from cairn.operators.similarity import best_match, oriented


def numbered_ligands(ligands: DataFrame, *, mark: str = "__") -> tuple[DataFrame, DataFrame]:
    """Ligands by key (``inchikeys``) with a number from 0 in its order, and ligands by system with all numbers of the system.

    ``ligands`` has system_id, inchikeys and ligand_rdkit_canonical_smiles, of several rows alike one; rows without a key
    have no number. The texts of a system's numbers are joined in the order of the numbers.
    """
    rows = ligands.distinct().where("inchikeys is not null and inchikeys <> ''")
    name = "number_id_by_inchikeys"
    by_key = rows.groupBy("inchikeys").agg(F.min("ligand_rdkit_canonical_smiles").alias("ligand_rdkit_canonical_smiles"))
    by_key = numbered(by_key, "inchikeys", name).withColumn(f"{name}_withl", F.concat(F.lit("l"), F.col(name).cast("string")))
    held = rows.join(by_key.select("inchikeys", name, f"{name}_withl"), "inchikeys")
    numbers = F.array_sort(F.collect_list(name))
    every = held.groupBy("system_id").agg(
        F.array_join(numbers.cast("array<string>"), mark).alias(f"multi_{name}"),
        F.array_join(F.transform(numbers, lambda n: F.concat(F.lit("l"), n.cast("string"))), mark).alias(f"multi_{name}_withl"),
    )
    return by_key, held.join(every, "system_id")


def synonyms(codes: DataFrame, *, dummies: tuple[str, ...] = ()) -> DataFrame:
    """Codes that share a structure with another, and the one that stands for them: code, unique_code.

    ``codes`` has code and smiles; codes with a part among ``dummies`` are none. The longest code stands, of those the
    first that begins with a letter.
    """
    rows = codes.where(F.col("smiles").isNotNull()).select("code", "smiles").distinct()
    if dummies:
        rows = rows.where(~scalars.any_part(F.col("code"), dummies))
    same = rows.groupBy("smiles").agg(F.collect_set("code").alias("codes")).where(F.size("codes") > 1)
    # As published: letters before digits at the first character, then by length, then in order.
    first = F.array_min(F.transform("codes", lambda c: F.struct(c.rlike("^[0-9]").alias("d"), (-F.length(c)).alias("n"), c.alias("c"))))["c"]
    return same.select("codes", first.alias("unique_code")).select(F.explode("codes").alias("code"), "unique_code")


def with_synonyms(codes: DataFrame, same: DataFrame) -> DataFrame:
    """Codes (one column) and all synonyms of them, of one step."""
    name = codes.columns[0]
    groups = same.select(F.col("code").alias(name), "unique_code")
    touched = codes.join(groups, name).select("unique_code").distinct()
    return codes.union(groups.join(touched, "unique_code", "left_semi").select(name)).distinct()


def clusters_by_system(labels: DataFrame, ligands: DataFrame, index: DataFrame) -> DataFrame:
    """Labels of ligand numbers as labels of systems, by each system's heaviest ligand that is neither ion nor artifact.

    ``labels`` has system_id (a number as text), label and other columns; ``ligands`` ligand_rdkit_canonical_smiles and
    number_id_by_inchikeys; ``index`` system_id, ligand_molecular_weight, ligand_rdkit_canonical_smiles, ligand_is_ion and
    ligand_is_artifact. Of ligands of equal weight the one with the smallest number counts.
    """
    number = ligands.groupBy("ligand_rdkit_canonical_smiles").agg(F.max("number_id_by_inchikeys").alias("number"))
    fit = index.where("not ligand_is_ion and not ligand_is_artifact").join(number, "ligand_rdkit_canonical_smiles").where("number is not null")
    heaviest = first_by(fit.select("system_id", "ligand_molecular_weight", "number"), ["system_id"], [F.desc_nulls_last("ligand_molecular_weight"), "number"])
    named = labels.withColumn("number", F.col("system_id").try_cast("long")).drop("system_id")
    return named.join(heaviest.select("system_id", "number"), "number").select(*labels.columns)


def cross_similarity(
    scores: DataFrame, queries: DataFrame, targets: DataFrame, systems: DataFrame, *, metric: str = "tanimoto_similarity_max", of_query: bool = False
) -> DataFrame:
    """Of each system with a ligand among ``targets`` the similarity of its ligand to the nearest of ``queries``: system_id and the metric.

    ``systems`` has system_id and number_id_by_inchikeys; of several ligands of a system the most similar counts. With
    ``of_query`` the systems are those of the query side of each stored score, as published.
    """
    ends = {"query": "query_ligand_id", "target": "target_ligand_id"}
    kept = scores.select("query_ligand_id", "target_ligand_id", metric, F.col("query_ligand_id").alias("stored"))
    best = best_match(oriented(kept, queries, targets, **ends), by="query_ligand_id", other="target_ligand_id", score=metric)
    key = F.col("stored") if of_query else F.col("query_ligand_id")
    rows = best.select(key.alias("number_id_by_inchikeys"), metric).join(systems.select("system_id", "number_id_by_inchikeys").distinct(), "number_id_by_inchikeys")
    return rows.groupBy("system_id").agg(F.max(metric).alias(metric))


def pair_similarity(pairs: DataFrame, *, min_constant: int = 5) -> DataFrame:
    """Similarity of matched pairs, in both directions: key, other, similarity, the share of the key's atoms that both have, in percent.

    ``pairs`` has inchikey1, inchikey2, size1, size2 and constant_size (heavy atoms); of several pairs the largest counts.
    """
    rows = pairs.where(F.col("constant_size") >= min_constant)
    ends = [F.struct(F.col(f"inchikey{a}").alias("key"), F.col(f"inchikey{b}").alias("other"), (100 * F.col("constant_size") / F.col(f"size{a}")).alias("similarity")) for a, b in ((1, 2), (2, 1))]
    return rows.select(F.inline(F.array(*ends))).groupBy("key", "other").agg(F.max("similarity").alias("similarity"))


def max_pair_similarity(ligands: DataFrame, similarity: DataFrame, *, train: str = "train", test: str = "test", label: str = "split", same: float = 100.0) -> DataFrame:
    """Of each test ligand the largest matched-pair similarity to a train ligand: system_id, inchikey, mmp_similarity_max, nearest.

    ``ligands`` has system_id, inchikey and the label. A ligand that train has too counts ``same`` (published tables hold
    1 there, on a scale to 100); without any pair it is 0 and ``nearest`` null. Of equal ones the first key is nearest.
    """
    known = ligands.where(F.col(label) == train).select(F.col("inchikey").alias("other")).distinct()
    asked = ligands.where(F.col(label) == test).select("system_id", "inchikey").distinct()
    keys = asked.select("inchikey").distinct()
    exact = keys.join(known, keys["inchikey"] == known["other"]).select("inchikey", "other", F.lit(float(same)).alias("similarity"), F.lit(0).alias("rank"))
    near = similarity.withColumnRenamed("key", "inchikey").join(keys, "inchikey", "left_semi").join(known, "other", "left_semi").select("inchikey", "other", "similarity", F.lit(1).alias("rank"))
    best = exact.union(near).groupBy("inchikey").agg(F.min_by(F.struct("similarity", "other"), F.struct("rank", (-F.col("similarity")).alias("s"), "other")).alias("b"))
    found = asked.join(best, "inchikey", "left")
    return found.select("system_id", "inchikey", F.coalesce("b.similarity", F.lit(0.0)).alias("mmp_similarity_max"), F.when(F.col("b.similarity") > 0, F.col("b.other")).alias("nearest"))


def max_similarity(similarity: DataFrame, ligands: DataFrame, *, metric: str, train: str = "train", test: str = "test", label: str = "split") -> DataFrame:
    """Of each test system the largest similarity of a ligand of it to a train ligand: system_id and the metric.

    ``similarity`` has query_ligand_id, target_ligand_id and the metric, ``ligands`` system_id, the number of the ligand and
    the label. Scores are taken in either direction.
    """
    of = lambda name: ligands.where(F.col(label) == name).select("number_id_by_inchikeys").distinct()
    return cross_similarity(similarity, of(train), of(test), ligands.where(F.col(label) == test), metric=metric)
