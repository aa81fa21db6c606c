"""Enrichment of the index: window columns, pivots, first and top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn import schemas
from cairn.functions.scalars import distinct_text
from cairn.operators.hot import join_totals
from cairn.operators.ordered import numbered_rows, running
from cairn.session import Workspace


def group_columns(df: DataFrame, by: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    """Aggregates of a row's group, added to each of its rows.

    They are made by a grouped aggregate with partial sums, written, and joined back without gathering a hot group,
    where a window would send all its rows, with all their columns, to one task.
    """
    totals = df.groupBy(*by).agg(*[c.alias(n) for n, c in columns.items()], F.count(F.lit(1)).alias("rows of group"))
    totals = Workspace(df.sparkSession, "group-columns").save(totals, "totals")
    plain = [f"`{f.name}`" for f in df.schema if "map<" not in f.dataType.simpleString()]
    return join_totals(df, totals, by, size="rows of group", salt=F.xxhash64(*plain)).drop("rows of group")


def first_by(df: DataFrame, by: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each group in the given order, which must settle ties."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank in group", rank).where("`rank in group` = 1").drop("rank in group")


def top_by(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group with their rank; the plan keeps ``n`` a group before it shuffles."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= n)


def numbered(df: DataFrame, column: str, name: str) -> DataFrame:
    """Each distinct value of a column with its place in order from 0, and the rows joined to it.

    Values are ordered and numbered by ranges; no task sees them all.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    ids = numbered_rows(values, [column], name)
    return df.join(ids.withColumn(name, F.col(name) - 1), column, "left")


def aggregated_columns(index: DataFrame, *, entry: str, biounit: str, system: str, code: str, flags: Sequence[str]) -> DataFrame:
    """The aggregates that every index row carries: of its biounit the ligands, kinds of ligands and flags, of its system the codes."""
    by = [entry, biounit]
    found = group_columns(
        index,
        by,
        {
            "biounit_num_ligands": F.count(F.lit(1)),
            "biounit_num_unique_codes": F.count_distinct(code),
            **{f"biounit_num_{f}": F.sum(F.coalesce(F.col(f), F.lit(False)).cast("long")) for f in flags},
            **{f"biounit_any_{f}": F.bool_or(F.coalesce(F.col(f), F.lit(False))) for f in flags},
        },
    )
    return group_columns(found, [system], {"system_unique_codes": distinct_text(F.col(code).cast("string"))})


def cluster_pivot(clusters: DataFrame, names: Sequence[tuple[str, int, str, bool]]) -> DataFrame:
    """Clusterings as columns by system: ``names`` are (metric, threshold, cluster, directed). Of several labels the smallest."""
    column = F.concat_ws(
        "__",
        "metric",
        F.col("threshold").cast("string"),
        F.when(F.col("cluster") == "communities", "community").otherwise(
            F.concat_ws("__", F.when(F.col("directed"), "strong").otherwise("weak"), F.lit("component"))
        ),
    )
    wanted = [schemas.cluster_column(*n) for n in names]
    return clusters.withColumn("name", column).groupBy("system_id").pivot("name", wanted).agg(F.min("label"))


def with_clusters(index: DataFrame, clusters: DataFrame, names: Sequence[tuple[str, int, str, bool]]) -> DataFrame:
    return index.join(cluster_pivot(clusters, names), "system_id", "left")


def nonredundant(index: DataFrame, *, uniqueness: str, order: Sequence[Column | str]) -> DataFrame:
    """One row by group of redundant systems."""
    return first_by(index, [uniqueness], order)


def venn(df: DataFrame, value: str, group: str, names: Sequence[str]) -> DataFrame:
    """How many values occur in which of the groups: ``region`` is a text of 0 and 1 in the order of ``names``."""
    marks = df.where(F.col(group).isin(list(names))).groupBy(value).agg(*[F.max((F.col(group) == n).cast("int")).alias(f"in {i}") for i, n in enumerate(names)])
    region = F.concat(*[F.col(f"in {i}").cast("string") for i in range(len(names))])
    return marks.where(F.col(value).isNotNull()).groupBy(region.alias("region")).agg(F.count(F.lit(1)).alias("n"))


def ks_statistic(df: DataFrame, value: str, group: str, first: str, second: str) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and the sample sizes. Only counts by distinct value are ordered, by ranges."""
    counts = df.where(F.col(value).isNotNull() & F.col(group).isin(first, second)).groupBy(F.col(value).alias("v")).agg(
        F.sum((F.col(group) == first).cast("long")).alias("a"), F.sum((F.col(group) == second).cast("long")).alias("b")
    )
    whole = counts.agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    steps = running(counts, ["v"], {"until a": "a", "until b": "b"}).join(F.broadcast(whole))  # one row
    steps = steps.select(F.col("until a").alias("a"), F.col("until b").alias("b"), "na", "nb")
    return steps.agg(F.max(F.abs(F.col("a") / F.col("na") - F.col("b") / F.col("nb"))).alias("statistic"), F.max("na").alias("n_first"), F.max("nb").alias("n_second"))


def ks_p_value(statistic: float, n: int, m: int) -> float:
    """Asymptotic two-sided p-value."""
    import math

    size = n * m / (n + m)
    x = (math.sqrt(size) + 0.12 + 0.11 / math.sqrt(size)) * statistic
    if x < 0.2:
        return 1.0
    return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))))
