"""Removal of lines that spread over many sites, in DataFrame expressions only.

Each line's hash gets a HyperLogLog sketch of the sites it occurs on; Spark merges the sketches of tasks, so that a line
that all documents share costs one sketch per task. A line whose estimate is clearly above the threshold goes, one
clearly below stays, and those within the sketch's error of it get an exact distinct count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.rows import row_key
from cairn.operators.hot import hot_groups, join_totals
from cairn.session import Workspace

#: log2 of a sketch's registers; three standard errors are what an estimate is trusted to.
REGISTERS = 12
ERROR = 3 * 1.04 / math.sqrt(2**REGISTERS)


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _key(line: Column) -> Column:
    """128 bits of a trimmed line, as two longs."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(lines: DataFrame, work: Workspace, *, min_sites: int) -> DataFrame:
    """Keys of lines on at least ``min_sites`` sites, with their number ``n`` of rows; ``lines`` has ``key`` and ``site``.

    A hot line that is clearly spread leaves before any line is dealt out by key, by a broadcast of bounded size; then
    a line comes once for each of its sites.
    """
    spread = lines.groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(REGISTERS))).alias("sites"), F.count(F.lit(1)).alias("n"))
    band = max(1, math.ceil(ERROR * min_sites))
    spread = work.save(spread.where(F.col("sites") >= min_sites - band), "spread")
    far = F.col("sites") > min_sites + band
    hot = hot_groups(spread, "n").where(far).select("key")
    near = spread.where(~far).select("key", "n")
    pairs = lines.join(F.broadcast(hot), "key", "left_anti").select("key", "site").distinct()
    exact = pairs.join(near, "key").groupBy("key").agg(F.count(F.lit(1)).alias("exact"), F.first("n").alias("n"))
    return spread.where(far).select("key", "n").union(exact.where(F.col("exact") >= min_sites).select("key", "n"))


def line_dedup(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = 10
) -> DataFrame:
    """One row per row of ``docs``: id, cleaned ``text``, ``n_lines``, ``n_removed``.

    Lines are cut at line feeds and compared without spaces, tabs and carriage returns at their ends. A line that
    occurs on ``min_sites`` sites or more is removed wherever it stands; lines that are empty so trimmed are neither
    counted nor removed. A null site is a site of its own, a null text an empty one; repeated rows are cleaned each.
    An empty table gives an empty result; other columns are ignored, whatever their names.
    """
    work = Workspace(docs.sparkSession, "line-dedup")
    key = row_key(docs, id_col, text_col)
    base = docs.select(
        *[c.alias(n) for n, c in key.items()], docs[text_col].alias("raw"), F.coalesce(docs[site_col].cast("string"), F.lit("\0")).alias("site")
    )
    distinct = F.array_distinct(F.filter(F.transform(_lines(F.col("raw")), _trimmed), lambda x: x != ""))
    lines = base.select("i", "x", "y", "site", F.explode(F.transform(distinct, _key)).alias("key"))
    lines = work.save(lines, "lines")
    gone = work.save(boilerplate(lines, work, min_sites=min_sites), "boilerplate")
    marked = join_totals(lines.select("i", "x", "y", "key"), gone, ["key"], size="n", salt=F.col("x"), how="inner")
    marked = marked.groupBy("i", "x", "y").agg(F.collect_set("key").alias("gone"))
    marked = work.save(marked.select(F.col("i").alias("of"), F.col("x").alias("ox"), F.col("y").alias("oy"), "gone"), "marked")
    work.drop(lines)
    same = F.col("i").eqNullSafe(F.col("of")) & (F.col("x") == F.col("ox")) & (F.col("y") == F.col("oy"))
    found = base.join(marked, same, "left").select(F.col("i").alias("doc"), "raw", "gone", _lines(F.col("raw")).alias("lines"))

    def removed(line: Column) -> Column:
        return F.coalesce(F.array_contains(F.col("gone"), _key(_trimmed(line))), F.lit(False))

    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~removed(x)))
    filled = F.filter("lines", lambda x: _trimmed(x) != "")
    found = found.select("doc", F.col("lines"), kept.alias("kept"), F.size(filled).cast("long").alias("n_lines"))
    return found.select(
        F.col("doc").alias(id_col),
        F.array_join("kept", "\n").alias(text_col),
        "n_lines",
        (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
    )
