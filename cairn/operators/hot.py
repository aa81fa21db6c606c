"""Joins of rows to totals of their groups, where some groups may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A group is hot if it holds over one in so many rows. Fewer than this many groups can be, so they may be broadcast.
SHARE = 1024


def hot_groups(totals: DataFrame, size: str) -> DataFrame:
    """The rows of ``totals`` (one by group, with the number ``size`` of its rows) that are hot: fewer than :data:`SHARE`."""
    whole = totals.agg(F.sum(size)).first()[0] or 0
    return totals.where(F.col(size) * SHARE > whole)


def join_totals(rows: DataFrame, totals: DataFrame, on: Sequence[str], *, size: str, salt: Column, how: str = "left", merge: bool = False) -> DataFrame:
    """Rows with the columns that ``totals``, one row by group, has besides the keys ``on``; ``how`` is left or inner.

    Totals of hot groups are broadcast, their number being bounded. All other rows meet their totals by an equi-join in
    which the rows of hot groups are dealt out by ``salt``, a number that rows of a group differ in, so that no task
    gets a hot group. ``totals`` is read three times and should be a written table. Null keys equal each other.
    ``merge`` keeps to a shuffled join where the plan might broadcast small totals, so that cost grows evenly.
    """
    values = [c for c in totals.columns if c not in on]
    hot = hot_groups(totals, size)
    hot = hot.select(*[F.col(f"`{c}`").alias(f"hot key {k}") for k, c in enumerate(on)], F.struct(*[F.col(f"`{c}`") for c in values]).alias("hot totals"))
    same = [rows[f"`{c}`"].eqNullSafe(hot[f"hot key {k}"]) for k, c in enumerate(on)]
    marked = rows.join(F.broadcast(hot), same, "left").drop(*[f"hot key {k}" for k in range(len(on))])
    marked = marked.withColumn("hot salt", F.when(F.col("hot totals").isNotNull(), 1 + F.pmod(salt, F.lit(SHARE * SHARE))).otherwise(0).cast("long"))
    cold = totals.select(
        *[F.col(f"`{c}`").alias(f"cold key {k}") for k, c in enumerate(on)],
        F.struct(*[F.col(f"`{c}`") for c in values]).alias("cold totals"),
        (F.col(f"`{size}`") - F.col(f"`{size}`")).cast("long").alias("cold salt"),  # 0, but no constant that leaves the key
    )
    cold = cold.hint("merge") if merge else cold
    same = [marked[f"`{c}`"].eqNullSafe(cold[f"cold key {k}"]) for k, c in enumerate(on)]
    found = marked.join(cold, [*same, F.col("hot salt") == F.col("cold salt")], "left")
    found = found.withColumn("totals of group", F.coalesce("hot totals", "cold totals"))
    if how == "inner":
        found = found.where(F.col("totals of group").isNotNull())
    return found.select(*[f"`{c}`" for c in rows.columns], *[F.col("totals of group")[v].alias(v) for v in values])
