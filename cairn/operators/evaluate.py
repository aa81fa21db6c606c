"""Evaluation of ranked predictions: result tables, curves against similarity, novelty strata."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.scalars import map_rows
from cairn.operators.ordered import medians


def evaluated(scores: DataFrame, data: DataFrame, *, key: str, rank: str = "rank", rmsd: str = "rmsd", lddt: str = "lddt", success: float = 2.0) -> DataFrame:
    """Scores of the systems in ``data``, one by system and rank; a missing RMSD is the largest, a missing lDDT 0.

    Of several rows of a system and rank the one with the smallest RMSD counts, then the largest lDDT.
    """
    order = F.struct(F.coalesce(rmsd, F.lit(float("inf"))).alias("r"), (-F.coalesce(lddt, F.lit(0.0))).alias("l"))
    one = scores.groupBy(key, rank).agg(F.min_by(F.struct(rmsd, lddt), order).alias("best row")).select(key, rank, "`best row`.*")
    one = one.join(data, key)
    worst = one.agg(F.max(rmsd).alias("worst of all"))
    one = one.join(F.broadcast(worst))  # one row
    filled = F.coalesce(rmsd, "worst of all")
    return one.withColumns({rmsd: filled, lddt: F.coalesce(lddt, F.lit(0.0))}).withColumn("success", F.col(rmsd) <= success).drop("worst of all")


def best_pose(rows: DataFrame, *, key: str, rank: str, rmsd: str, top_n: int) -> DataFrame:
    """Of each system the pose with the smallest RMSD among the first ``top_n``."""
    rest = [c for c in rows.columns if c != key]
    best = F.min_by(F.struct(*rest), F.struct(rmsd, rank))
    return rows.where(F.col(rank) <= top_n).groupBy(key).agg(best.alias("best row")).select(key, "`best row`.*")


def results_table(best: DataFrame, subsets: dict[str, Column], *, key: str, rmsd: str = "rmsd", lddt: str = "lddt") -> DataFrame:
    """A row by subset: systems, success in percent, median and population deviation of RMSD and lDDT.

    ``best`` has one row by system, as :func:`best_pose` gives it.
    """
    marked = best.select(key, rmsd, lddt, "success", F.explode(F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), name) for name, c in subsets.items()]), lambda s: s.isNotNull())).alias("subset"))
    # A system is one row by now, so that counts of rows with a key, made where the rows are, count systems.
    found = marked.groupBy("subset").agg(
        F.count(key).alias("n_systems"),
        (100 * F.sum(F.when(F.col("success") & F.col(key).isNotNull(), 1).otherwise(0)) / F.count(key)).alias("success_rate"),
        F.stddev_pop(rmsd).alias("stdev_rmsd"),
        F.stddev_pop(lddt).alias("stdev_lddt"),
    )
    for column, name in ((rmsd, "median_rmsd"), (lddt, "median_lddt")):
        found = found.join(medians(marked, ["subset"], column).withColumnRenamed("median", name), "subset", "left")
    return found


def curve(rows: DataFrame, *, similarity: str, cuts: Sequence[float]) -> DataFrame:
    """Success at or below each similarity cut, above it, and how much of the set lies above.

    A row is copied once by cut, before an aggregate that the map side does; counts of none divide as one.
    """
    cut = F.explode(F.array(*[F.lit(float(c)) for c in cuts])).alias("cut")
    each = rows.select(F.coalesce(similarity, F.lit(0.0)).alias("s"), F.col("success").cast("long").alias("ok"), cut)
    low = F.col("s") <= F.col("cut")

    def share(n: Column, of: Column) -> Column:
        return n / F.greatest(of, F.lit(1))

    n_low, n_high = F.sum(low.cast("long")), F.sum((~low).cast("long"))
    ok_low, ok_high = F.sum(F.when(low, F.col("ok")).otherwise(0)), F.sum(F.when(~low, F.col("ok")).otherwise(0))
    return each.groupBy("cut").agg(
        n_low.alias("n_below"),
        share(ok_low, n_low).alias("success_below"),
        share(ok_high, n_high).alias("success_above"),
        (share(ok_high, n_high) - share(ok_low, n_low)).alias("excess"),
        share(n_high, F.count(F.lit(1))).alias("leaked_share"),
    )


def max_similarity_table(parts: dict[str, DataFrame], systems: DataFrame, *, key: str) -> DataFrame:
    """One row by system with the largest similarity of every metric, 0 where there is none."""
    found = None
    for name, part in parts.items():
        rows = part.select(F.col(part.columns[0]).alias(key), F.lit(name).alias("metric"), F.col(part.columns[1]).cast("double").alias("v"))
        found = rows if found is None else found.unionByName(rows)
    wide = found.groupBy(key).pivot("metric", list(parts)).agg(F.max("v"))
    return systems.select(key).distinct().join(wide, key, "left").na.fill(0.0, list(parts))


def stratify(table: DataFrame, limits: dict[str, dict[str, float]]) -> DataFrame:
    """Novelty flags: all metrics of a flag are below their limits; ``not_novel`` where no flag holds."""
    flags = {name: reduce(and_, [F.col(f"`{m}`") < t for m, t in rules.items()]) for name, rules in limits.items()}
    table = table.withColumns(flags)
    none = reduce(and_, [~F.col(f) for f in flags], F.lit(True))
    return table.withColumn("not_novel", none)


def counts_of(table: DataFrame, flags: Sequence[str]) -> DataFrame:
    """How many rows each flag holds for: ``flag``, ``n``."""
    sums = table.agg(*[F.sum(F.col(f).cast("long")).alias(f) for f in flags])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(f).alias("flag"), F.coalesce(f, F.lit(0)).alias("n")) for f in flags])))


def shares(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Counts of a value within a group, and their share of the group."""
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy(*by).agg(F.sum("n").alias("all"))
    return counts.join(total, list(by)).withColumn("share", F.col("n") / F.col("all")).drop("all")


def weighted(rows: DataFrame, by: Sequence[str], score: str, weight: str) -> DataFrame:
    """Mean and weighted mean, rows without a score left out of both."""
    w = F.when(F.col(score).isNotNull(), F.col(weight))
    return rows.groupBy(*by).agg(F.avg(score).alias(f"{score}_mean"), (F.sum(F.col(score) * w) / F.sum(w)).alias(f"{score}_weighted"))


#: Scores of poses, as summaries name them.
POSE_SCORES = ("lddt_pli", "lddt_lp", "bisy_rmsd")


def summary(ligands: DataFrame, systems: DataFrame, checks: DataFrame | None = None, *, by_weight_and_number: bool = False) -> DataFrame:
    """One row by pose and ligand chain: the pose's numbers, means and weighted means of each score, and the ligand's scores.

    ``ligands`` has model, reference, rank, chain, atom_count, the scores, and best_rmsd_chain and best_pli_chain;
    ``systems`` model, reference, rank, num_reference_ligands, num_model_ligands, num_reference_proteins,
    num_model_proteins, mapped_reference_ligands, mapped_model_ligands; ``checks`` model, reference, rank, chain, check and
    value. Weights are numbers of atoms, and missing scores are left out. Checks are averaged alike; published tables
    divide them by their number as well, which ``by_weight_and_number`` does.
    """
    keys = ["model", "reference", "rank"]
    w = F.col("atom_count")
    means = []
    for s in POSE_SCORES:
        weight = F.when(F.col(s).isNotNull(), w)
        means += [F.avg(s).alias(f"{s}_ave"), (F.sum(F.col(s) * weight) / F.sum(weight)).alias(f"{s}_wave")]
    found = systems.withColumns(
        {
            "fraction_reference_ligands_mapped": F.col("mapped_reference_ligands") / F.col("num_reference_ligands"),
            "fraction_model_ligands_mapped": F.col("mapped_model_ligands") / F.col("num_model_ligands"),
        }
    ).drop("mapped_reference_ligands", "mapped_model_ligands")
    found = found.join(ligands.groupBy(*keys).agg(*means), keys, "left")
    if checks is not None:
        rows = checks.join(ligands.select(*keys, "chain", "atom_count"), [*keys, "chain"])
        value, n = F.col("value").cast("double"), F.count(F.lit(1)) if by_weight_and_number else F.lit(1)
        averages = rows.groupBy(*keys, "check").agg((F.sum(value * w) / F.sum(w) / n).alias("v"))
        maps = averages.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("check", "v")))).alias("posebusters"))
        found = found.join(maps, keys, "left")
    per = ligands.select(*keys, "chain", *POSE_SCORES, F.col("best_rmsd_chain").alias("best_rmsd_matched_reference_chain"), F.col("best_pli_chain").alias("best_pli_matched_reference_chain"))
    return per.join(found, keys)


def score_set(predictions: DataFrame, scorer, shape: str) -> DataFrame:
    """Scores of predictions in batches: ``scorer`` takes a row as a dict and gives dicts of ``shape``, one by ligand chain.

    A prediction whose scorer raises gives one row with the error in ``error`` and nulls elsewhere. ``predictions`` has
    id, reference_system_id, receptor_file, ligand_file and rank.
    """

    def one(row: dict) -> list[dict]:
        base = {"id": row["id"], "reference_system_id": row["reference_system_id"], "rank": row["rank"], "error": None}
        try:
            return [{**base, **found} for found in scorer(row)]
        except Exception as error:  # noqa: BLE001 - reported in the row
            return [{**base, "error": f"{type(error).__name__}: {error}"}]

    rows = predictions.withColumns({"id": F.col("id").cast("string"), "reference_system_id": F.col("reference_system_id").cast("string")})
    return map_rows(rows, one, f"id string, reference_system_id string, rank int, error string, {shape}")


def write_results(best: DataFrame, subsets: dict[str, Column], path: str, *, key: str, top_n: int, rmsd: str = "rmsd", lddt: str = "lddt") -> DataFrame:
    """Write the result table as CSV, with the published names of its columns, and return it; empty subsets are left out."""
    found = results_table(best, subsets, key=key, rmsd=rmsd, lddt=lddt)
    order = F.create_map(*[F.lit(x) for pair in enumerate(subsets) for x in pair[::-1]])
    table = found.orderBy(order[F.col("subset")]).select(
        F.col("subset").alias("Subset"),
        F.col("n_systems").alias("No. systems"),
        F.lit(top_n).alias("Top n"),
        F.col("success_rate").alias("Success Rate (%)"),
        F.col("median_rmsd").alias("Median RMSD"),
        F.col("stdev_rmsd").alias("Stdev RMSD"),
        F.col("median_lddt").alias("Mean lDDT-PLI"),  # a median under its published name
        F.col("stdev_lddt").alias("Stdev lDDT-PLI"),
    )
    table.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return table


def trends(rows: DataFrame, metrics: Sequence[str], *, rmsd: str = "rmsd", lddt: str = "lddt", cuts: Sequence[float] = tuple(10.0 * k for k in range(11))) -> DataFrame:
    """Performance against the distance to the train set: metric, cutoff, analysis, mean.

    At a distance rows count whose similarity is at least 100 less it. Analyses: S success, XS and EF its difference and
    ratio to that of all rows, delta_RMSD and delta_lDDT_PLI differences of means, CDF the share of rows. A row is copied
    by metric and cutoff before an aggregate that the map side does.
    """
    names = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.coalesce(m, F.lit(0.0)).cast("double").alias("similarity")) for m in metrics])).alias("m")
    ok = F.col("success").cast("double")
    each = rows.select(names, ok.alias("ok"), F.col(rmsd).alias("rmsd"), F.col(lddt).alias("lddt"), F.explode(F.array(*[F.lit(float(c)) for c in cuts])).alias("cutoff"))
    held = F.col("m.similarity") >= 100 - F.col("cutoff")
    n = F.greatest(F.sum(held.cast("int")), F.lit(1))
    sums = each.groupBy(F.col("m.metric").alias("metric"), "cutoff").agg(
        *[(F.sum(F.when(held, F.col(c)).otherwise(0.0)) / n).alias(c) for c in ("ok", "rmsd", "lddt")],
        *[(F.sum(c) / F.count(F.lit(1))).alias(f"all_{c}") for c in ("ok", "rmsd", "lddt")],
        F.avg(held.cast("double")).alias("share"),
    )
    analyses = {
        "S": F.col("ok"),
        "XS": F.col("ok") - F.col("all_ok"),
        "EF": F.try_divide("ok", "all_ok"),
        "delta_RMSD": F.col("rmsd") - F.col("all_rmsd"),
        "delta_lDDT_PLI": F.col("all_lddt") - F.col("lddt"),
        "CDF": F.col("share"),
    }
    return sums.select("metric", "cutoff", F.inline(F.array(*[F.struct(F.lit(k).alias("analysis"), v.alias("mean")) for k, v in analyses.items()])))


def with_quality(table: DataFrame, index: DataFrame, *, key: str = "system_id") -> DataFrame:
    """Rows of systems that the index has, with ``passes_quality``; a missing mark counts as not."""
    marks = index.groupBy(key).agg(F.max(F.coalesce("system_pass_validation_criteria", F.lit(False))).alias("passes_quality"))
    return table.join(marks, key)


# Reports on splits.


def merged(split: DataFrame, index: DataFrame, *, key: str = "system_id", suffix: str = "_y") -> DataFrame:
    """Index rows of the split's systems with its columns; of columns that both have the split's get the suffix."""
    renamed = {c: f"{c}{suffix}" for c in split.columns if c in index.columns and c != key}
    return index.join(split.withColumnsRenamed(renamed), key)


def with_strata(systems: DataFrame, strata: dict[str, DataFrame], *, key: str = "system_id") -> DataFrame:
    """Systems with the columns of stratified tables; those that aren't about novelty get the name of their table behind."""
    for name, table in strata.items():
        one = table.dropDuplicates([key]).withColumnsRenamed({c: f"{c}__{name}" for c in table.columns if c != key and "novel" not in c})
        systems = systems.drop(*[c for c in one.columns if c != key and c in systems.columns]).join(one, key, "left")
    return systems


def diversity(systems: DataFrame, columns: Sequence[str], *, by: str = "split") -> DataFrame:
    """Distinct values of columns by split, long: split, column, n; pairs are made distinct before they are counted."""
    rows = systems.select(by, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])))
    return rows.where("value is not null").distinct().groupBy(by, "column").agg(F.count(F.lit(1)).alias("n"))


def chain_composition(systems: DataFrame, *, by: str = "split", proteins: str = "system_num_protein_chains", ligands: str = "system_proper_num_ligand_chains") -> DataFrame:
    """Systems by split with one or several proteins and ligands."""
    p, x = F.col(proteins), F.col(ligands)
    kinds = {"single_single": (p == 1) & (x == 1), "single_multiple": (p == 1) & (x > 1), "multiple_single": (p > 1) & (x == 1), "multiple_multiple": (p > 1) & (x > 1)}
    return systems.groupBy(by).agg(*[F.count_if(c).alias(n) for n, c in kinds.items()], F.count(F.lit(1)).alias("total"))


def flag_percent(systems: DataFrame, flags: Sequence[str], *, by: str = "split") -> DataFrame:
    """Percent of systems by split that each flag holds for, missing ones not."""
    return systems.groupBy(by).agg(*[(100 * F.avg(F.coalesce(F.col(f), F.lit(False)).cast("int"))).alias(f) for f in flags])
