"""Commands: score predictions, stratify a test set, write result tables, query an index."""

from __future__ import annotations

import argparse
import importlib
import json
import shutil
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import evaluate
from cairn.operators.similarity import cross_similarity
from cairn.session import get_session

#: Novelty flags and the similarities they need to be below. Fixed by the published procedure.
NOVEL = {
    "novel_pocket_pli": {"pli_unique_qcov": 50, "pocket_qcov": 50, "pocket_lddt_qcov": 50},
    "novel_ligand": {"tanimoto_similarity_max": 30, "mmp_similarity_max": 50},
    "novel_protein": {"protein_seqsim_weighted_sum": 30, "protein_lddt_weighted_sum": 50},
    "novel_all": {
        "pli_unique_qcov": 50, "pocket_qcov": 50, "pocket_lddt": 50, "protein_seqsim_weighted_sum": 30,
        "protein_lddt_weighted_sum": 50, "tanimoto_similarity_max": 30,
    },
}
SCORES = "chain string, lddt_pli double, lddt_lp double, bisy_rmsd double, bisy_rmsd_wave double, lddt_pli_wave double"


def _function(path: str) -> Callable:
    """The function ``module:name``."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def score(args: Sequence[str], spark: SparkSession | None = None) -> DataFrame:
    """Score predictions of a CSV file (id, reference_system_id, receptor_file, ligand_file, rank) with a scorer, a function of a row."""
    parser = argparse.ArgumentParser("score")
    parser.add_argument("--prediction_file", required=True)
    parser.add_argument("--output_dir", required=True)
    parser.add_argument("--scorer", required=True, help="module:function that takes a row and gives one mapping by ligand chain")
    parser.add_argument("--overwrite", action="store_true")
    parser.add_argument("--num_processes", type=int, default=8, help="tasks that score")
    for flag in ("score_receptor", "posebusters", "posebusters_full"):
        parser.add_argument(f"--{flag}", action="store_true", help="handed to the scorer")
    given = parser.parse_args(args)
    spark = spark or get_session("score")
    rows = spark.read.option("header", True).csv(given.prediction_file).withColumn("rank", F.col("rank").cast("int"))
    for column in ("receptor_file", "ligand_file"):
        if column not in rows.columns:
            rows = rows.withColumn(column, F.lit(None).cast("string"))
    target = f"{given.output_dir.rstrip('/')}/scores.parquet"
    done = Path(target).exists() and not given.overwrite
    if done:
        rows = rows.join(spark.read.parquet(target).where("error is null").select("id", "reference_system_id", "rank").distinct(), ["id", "reference_system_id", "rank"], "left_anti")
    options = {f: getattr(given, f) for f in ("score_receptor", "posebusters", "posebusters_full")}
    scorer = _function(given.scorer)
    found = evaluate.score_set(rows.repartition(given.num_processes), lambda row: scorer({**row, **options}), SCORES)
    found.write.mode("append" if done else "overwrite").parquet(target)
    return spark.read.parquet(target)


def stratify(args: Sequence[str], spark: SparkSession | None = None) -> DataFrame:
    """Largest similarities of test systems to train systems, and novelty flags.

    Similarities are read of ``--scores`` (long: query_system, target_system, metric, similarity).
    """
    parser = argparse.ArgumentParser("stratify")
    parser.add_argument("--split_file", required=True)
    parser.add_argument("--output_dir", required=True)
    parser.add_argument("--scores", required=True)
    parser.add_argument("--index", help="index with system_pass_validation_criteria, for passes_quality")
    parser.add_argument("--split_label", default="split")
    parser.add_argument("--train_label", default="train")
    parser.add_argument("--test_label", default="test")
    parser.add_argument("--overwrite", action="store_true")
    given = parser.parse_args(args)
    spark = spark or get_session("stratify")
    target = f"{given.output_dir.rstrip('/')}/{given.test_label}_set.parquet"
    if Path(target).exists() and not given.overwrite:
        return spark.read.parquet(target)
    table = spark.read.option("header", True).csv(given.split_file) if given.split_file.endswith(".csv") else spark.read.parquet(given.split_file)
    ids = {n: table.where(F.col(given.split_label) == n).select("system_id").distinct() for n in (given.train_label, given.test_label)}
    scores = spark.read.parquet(given.scores).select("query_system", "target_system", "metric", F.col("similarity").cast("double").alias("similarity"))
    metrics = sorted({m for limits in NOVEL.values() for m in limits})
    parts = {}
    for metric in metrics:
        edges = scores.where(F.col("metric") == metric).drop("metric")
        best = cross_similarity(edges, ids[given.train_label], ids[given.test_label], query="query_system", target="target_system", score="similarity")
        parts[metric] = best.select("query_system", "similarity")
    found = evaluate.stratify(evaluate.max_similarity_table(parts, ids[given.test_label], key="system_id"), NOVEL)
    if given.index:
        found = evaluate.with_quality(found, spark.read.parquet(given.index))
    found.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def report(args: Sequence[str], spark: SparkSession | None = None) -> DataFrame:
    """Result tables (CSV, of all systems and of those that pass quality) and trends (Parquet) of scores and a stratified test set."""
    parser = argparse.ArgumentParser("report")
    parser.add_argument("--score_file", required=True)
    parser.add_argument("--data_file", required=True)
    parser.add_argument("--output_dir", required=True)
    parser.add_argument("--max_top_n", type=int, default=10)
    given = parser.parse_args(args)
    spark = spark or get_session("report")
    key, rmsd, lddt = "system_id", "bisy_rmsd_wave", "lddt_pli_wave"
    scores = spark.read.parquet(given.score_file).withColumnRenamed("reference_system_id", key)
    rows = evaluate.evaluated(scores, spark.read.parquet(given.data_file), key=key, rmsd=rmsd, lddt=lddt)
    subsets = {"all": F.lit(True), **{n: F.col(n) for n in (*NOVEL, "not_novel") if n in rows.columns}}
    written = None
    for name, part in (("results", rows), *([("results_quality", rows.where("passes_quality"))] if "passes_quality" in rows.columns else [])):
        best = evaluate.best_pose(part, key=key, rank="rank", rmsd=rmsd, top_n=given.max_top_n)
        written = evaluate.write_results(best, subsets, f"{given.output_dir.rstrip('/')}/{name}.csv", key=key, top_n=given.max_top_n, rmsd=rmsd, lddt=lddt)
    metrics = [m for m in sorted({m for limits in NOVEL.values() for m in limits}) if m in rows.columns]
    if metrics:
        first = evaluate.best_pose(rows, key=key, rank="rank", rmsd=rmsd, top_n=1)
        evaluate.trends(first, metrics, rmsd=rmsd, lddt=lddt).write.mode("overwrite").parquet(f"{given.output_dir.rstrip('/')}/trends.parquet")
    return written


def copy(args: Sequence[str], spark: SparkSession | None = None, ask: Callable[[str], str] = input) -> list[str]:
    """Copy a release from one folder to another, asking before its large parts unless told yes; what is there already stays."""
    parser = argparse.ArgumentParser("copy")
    parser.add_argument("--source", required=True)
    parser.add_argument("--target", required=True)
    parser.add_argument("--release", required=True)
    parser.add_argument("--iteration", default="")
    parser.add_argument("-y", "--yes", action="store_true")
    given = parser.parse_args(args)
    base = Path(given.source, given.release, given.iteration)
    if not base.is_dir():
        raise FileNotFoundError(base)
    done = []
    for part in sorted(base.iterdir()):
        target = Path(given.target, given.release, given.iteration, part.name)
        size = sum(p.stat().st_size for p in part.rglob("*") if p.is_file()) if part.is_dir() else part.stat().st_size
        if target.exists() or (size > 1 << 30 and not given.yes and ask(f"copy {part.name}, {size >> 20} MB? [y/n] ").strip().lower() != "y"):
            continue
        target.parent.mkdir(parents=True, exist_ok=True)
        shutil.copytree(part, target) if part.is_dir() else shutil.copy2(part, target)
        done.append(part.name)
    return done


def show(args: Sequence[str], spark: SparkSession | None = None) -> DataFrame:
    """Rows of an index: columns, splits and filters as JSON."""
    from cairn.sources import datasets

    parser = argparse.ArgumentParser("show")
    parser.add_argument("--index", required=True)
    parser.add_argument("--splits")
    parser.add_argument("--columns", default="")
    parser.add_argument("--wanted", default="train,val")
    parser.add_argument("--filters", default="[]")
    given = parser.parse_args(args)
    spark = spark or get_session("show")
    filters = [[tuple(t) for t in f] if f and isinstance(f[0], list) else tuple(f) for f in json.loads(given.filters)]
    splits = spark.read.parquet(given.splits) if given.splits else None
    return datasets.query_index(spark.read.parquet(given.index), splits, columns=given.columns.split(",") if given.columns else None, wanted=given.wanted.split(","), filters=filters)


COMMANDS = {f.__name__: f for f in (score, stratify, report, copy, show)}


def main(args: Sequence[str] | None = None) -> None:
    """``python -m cairn.plans.commands NAME …``"""
    import sys

    name, *rest = list(sys.argv[1:] if args is None else args) or ["--help"]
    if name not in COMMANDS:
        raise SystemExit(f"commands: {', '.join(COMMANDS)}")
    found = COMMANDS[name](rest)
    if isinstance(found, DataFrame):
        found.show(truncate=False)


if __name__ == "__main__":
    main()
