"""Exact deduplication by distributed most-significant-digit radix partitioning.

Each text is the byte string *length, normalised bytes*. A round takes the next bytes of every open row as its digit
and splits each group by it; a group of one row, or one whose texts have ended, is closed. Equality is decided by the
bytes alone, never by a digest.

Only counts per (group, digit) are aggregated, with partial sums on the map side, so a group that holds a third of all
rows costs one row per task. The counts of hot groups come back to their rows by broadcast, those of others by an
equi-join in which the rows of hot groups are dealt out to all tasks. Every round is written to the shared folder, and holds only the rows that still share all their
bytes so far with another row, and only the bytes that were not looked at yet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.hot import join_totals
from cairn.session import Workspace

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """Null as empty, A-Z in lower case, all else as it is."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def exact_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    first_digit: int = 32,
    growth: int = 32,
    with_row: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Rows are equal when their texts are identical after lower-casing A-Z; null counts as empty. The row with the
    largest id of its group stays; a null id is below all others, and of rows that repeat the largest id exactly one
    stays, so each group has one row with ``kept``. ``text_sha256`` describes the result and decides nothing. An empty
    table gives an empty result; further columns of ``docs`` are ignored, whatever their names, unless ``with_row``
    asks for the whole row back as a struct ``row``.

    Digits take ``first_digit`` bytes in the first round and ``growth`` times as many in each later one.
    """
    work = Workspace(docs.sparkSession, "exact-dedup")
    text = docs[text_col]
    base = docs.select(
        docs[id_col].alias("id"),
        F.coalesce(text, F.lit("")).alias("raw"),
        (F.struct(*[docs[c] for c in docs.columns]) if with_row else F.lit(None).cast("boolean")).alias("row"),
    )
    # First digit: the length, so that all texts of a group end together, and the leading bytes.
    head = F.substring(F.translate(F.substring("raw", 1, first_digit), UPPER, LOWER).cast("binary"), 1, first_digit)
    base = base.withColumns({"size": F.octet_length("raw"), "digit": head, "rid": F.monotonically_increasing_id()})
    shared = (
        base.groupBy("size", "digit")
        .agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("group"))
        .where("n > 1")
    )
    shared = work.save(shared, "counts")
    body = F.translate("raw", UPPER, LOWER)
    rows = join_totals(base, shared, ["size", "digit"], size="n", salt=F.col("rid"), merge=True)
    current = work.save(
        rows.select(
            "id",
            "rid",
            "row",
            "size",
            "group",
            F.col("n").isNull().alias("closed"),
            F.sha2(body, 256).alias("sha"),
            F.lit(1).cast("long").alias("members"),
            F.lit(None).cast(base.schema["id"].dataType).alias("keep"),
            F.lit(True).alias("kept"),
            F.when(F.col("n").isNotNull(), F.expr(f"substring(cast(translate(raw, '{UPPER}', '{LOWER}') as binary), {first_digit + 1})")).alias("rest"),
        ),
        "round",
    )
    work.drop(shared)
    done = [current.where("closed").withColumn("keep", F.col("id"))]
    at, width = first_digit, first_digit * growth
    while not (open_rows := current.where("not closed")).isEmpty():
        open_rows = open_rows.drop("members", "keep", "kept", "closed").withColumn("digit", F.substring("rest", 1, width))
        split = open_rows.groupBy("group", "digit").agg(
            F.count(F.lit(1)).alias("members"),
            F.max(F.struct(F.col("id"), (-F.col("rid")).alias("r"))).alias("winner"),
            F.min("rid").alias("next"),
        )
        split = work.save(split, "counts")
        rows = join_totals(open_rows, split, ["group", "digit"], size="members", salt=F.col("rid"), how="inner", merge=True)
        closed = (F.col("members") == 1) | (F.col("size") <= at + width)
        current = work.save(
            rows.select(
                "id",
                "rid",
                "row",
                "size",
                F.col("next").alias("group"),
                closed.alias("closed"),
                "sha",
                "members",
                F.col("winner.id").alias("keep"),
                (F.col("winner.r") == -F.col("rid")).alias("kept"),
                F.when(~closed, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
            ),
            "round",
        )
        work.drop(split)
        done.append(current.where("closed"))
        at, width = at + width, width * growth
    out = None
    for part in done:
        part = part.select(
            F.col("id").alias(id_col),
            F.col("keep").alias("keep_id"),
            F.col("members").alias("group_size"),
            "kept",
            F.col("sha").alias("text_sha256"),
            *(["row"] if with_row else []),
        )
        out = part if out is None else out.unionAll(part)
    return out


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, with all their columns."""
    return exact_groups(docs, id_col=id_col, text_col=text_col, with_row=True).where("kept").select("row.*")
