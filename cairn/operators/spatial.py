"""Joins by distance and by interval, through bucket keys, and gaps in numbering."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def radius_join(left: DataFrame, right: DataFrame, radius: float, *, axes: tuple[str, ...] = ("x", "y", "z"), within: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of points at most ``radius`` apart, with ``distance``; columns of the left are ``l_…``, of the right ``r_…``.

    Space is cut into cells as wide as the radius. A right point stands in its cell alone, a left one in its cell and
    those around, so that near points share exactly one cell; the cell, and columns ``within``, are an equi-join key.
    """
    a = left.select(*[F.col(c).alias(f"l_{c}") for c in left.columns])
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])

    def cell(side: str, shift: tuple[int, ...]) -> Column:
        return F.struct(*[(F.floor(F.col(f"{side}_{x}") / radius) + d).cast("long").alias(x) for x, d in zip(axes, shift)])

    around = F.array(*[cell("l", shift) for shift in product((-1, 0, 1), repeat=len(axes))])
    a = a.withColumn("cell", F.explode(around))
    b = b.withColumn("cell", cell("r", (0,) * len(axes)))
    same = F.col("a.cell") == F.col("b.cell")
    for c in within:
        same = same & (F.col(f"a.l_{c}") == F.col(f"b.r_{c}"))
    distance = F.sqrt(sum(((F.col(f"l_{x}") - F.col(f"r_{x}")) ** 2 for x in axes), F.lit(0.0)))
    joined = a.alias("a").join(b.alias("b"), same).drop("cell")
    return joined.withColumn("distance", distance).where(F.col("distance") <= radius)


def contacts(points: DataFrame, radius: float, *, chain: str, residue: str, axes: tuple[str, ...] = ("x", "y", "z")) -> DataFrame:
    """Residue pairs of different chains with atoms within ``radius``: the lower chain first, one row by pair of residues."""
    near = radius_join(points, points, radius, axes=axes).where(F.col(f"l_{chain}") < F.col(f"r_{chain}"))
    return near.groupBy(f"l_{chain}", f"r_{chain}", f"l_{residue}", f"r_{residue}").agg(F.min("distance").alias("distance"))


def interval_join(points: DataFrame, ranges: DataFrame, *, at: str, start: str, end: str, width: int, within: tuple[str, ...] = ()) -> DataFrame:
    """Points with the ranges that hold them, the end not included. Columns of both must differ but for ``within``.

    Ranges stand in every bucket of ``width`` that they touch, points in theirs, so the join is an equi-join; a range
    costs its length over the width.
    """
    r = ranges.where(F.col(start) < F.col(end)).withColumn("bucket", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))))
    p = points.withColumn("bucket", F.floor(F.col(at) / width))
    return p.join(r, ["bucket", *within]).where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("bucket")


def best_overlap(points: DataFrame, ranges: DataFrame, *, by: str, label: str, at: str, start: str, end: str, width: int, within: tuple[str, ...] = ()) -> DataFrame:
    """Of each ``by`` the label whose ranges hold most of its points, of equal ones the first; ``label``, ``n_points``."""
    held = interval_join(points, ranges, at=at, start=start, end=end, width=width, within=within).select(by, label, at).distinct()
    counts = held.groupBy(by, label).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(by).agg(F.max("n").alias("n_points"))
    return counts.join(best, by).where("n = n_points").groupBy(by, "n_points").agg(F.min(label).alias(label))


def gaps(rows: DataFrame, *, by: list[str], at: str) -> DataFrame:
    """Neighbouring numbers of a group that aren't consecutive: ``gap_from``, ``gap_to``."""
    before = F.lag(at).over(Window.partitionBy(*by).orderBy(at))
    found = rows.select(*by, at).distinct().withColumn("gap_from", before).where(F.col(at) - F.col("gap_from") > 1)
    return found.select(*by, "gap_from", F.col(at).alias("gap_to"))
