"""Rows known by what they hold, so that results find back to them without their texts being carried along."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a few numbers each that a task may hold for a broadcast join. Beyond it the join is shuffled.
BROADCAST_ROWS = 1_000_000


def row_key(rows: DataFrame, id_col: str, text_col: str) -> dict[str, Column]:
    """Columns ``i``, ``x``, ``y``: the id and 128 bits of the text, null counting as empty. Rows that share them are alike."""
    raw = F.coalesce(rows[text_col], F.lit(""))
    return {"i": rows[id_col], "x": F.xxhash64(raw), "y": F.xxhash64(F.lit(1), raw)}


def bounded(side: DataFrame, rows: int | None = None) -> DataFrame:
    """``side``, to be broadcast if it is counted to be small; it should be a written table."""
    return F.broadcast(side) if (side.count() if rows is None else rows) <= BROADCAST_ROWS else side


def matching(rows: DataFrame, keys: DataFrame, key: dict[str, Column] | None = None, how: str = "inner") -> DataFrame:
    """Rows joined to ``keys``, a written table, on i, x and y; ``key`` gives those of rows that haven't them as columns."""
    names = {n: keys[n].alias(f"key {n}") for n in ("i", "x", "y")}
    side = bounded(keys.select(*names.values(), *[c for c in keys.columns if c not in names]))
    mine = key or {n: rows[n] for n in names}
    same = mine["i"].eqNullSafe(side["key i"]) & (mine["x"] == side["key x"]) & (mine["y"] == side["key y"])
    return rows.join(side, same, how)
