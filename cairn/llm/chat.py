"""Chat formatting of typed content parts, in DataFrame expressions only.

A message's content is an array of parts. A visitor turns the parts into one body: text is escaped, an image, audio or
document part becomes its placeholder, in order, and its reference and the number of tokens it stands for are
recorded. Turns of a conversation are then set in a template, with the code-point spans of the assistant's bodies as
loss mask.

Escaping: a control string is a bracket, any number of backslashes, and one of :data:`TAIL`; inside a text it gets one
backslash more, so that no text holds a control string, and taking one away gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SAY, END = "<|start|>", "<|say|>", "<|end|>\n"
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
OTHER = "<|attachment|>"
TAIL = r"(\|[A-Za-z0-9_]*\|>|/?s>|/?SYS>>|/?INST\])"
ESCAPE = r"([<\[])(\\*)" + TAIL, r"$1\\$2$3"
UNESCAPE = r"([<\[])\\(\\*)" + TAIL, r"$1$2$3"
TURN = r"(?s)<\|start\|>(.*?)<\|say\|>(.*?)<\|end\|>\n"

#: The type of a message's content.
PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
#: Tokens that an attachment stands for: one per image tile of so many pixels a side, per so much of a second, per page.
TILE, PER_SECOND, PER_PAGE, UNSIZED = 28, 25, 512, 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, *ESCAPE)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, *UNESCAPE)


def text_parts(text: Column) -> Column:
    """Content of a single text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).cast("array<struct<type:string,text:string>>")


def _field(part: Column, fields: set[str], name: str, kind: str) -> Column:
    return part[name].cast(kind) if name in fields else F.lit(None).cast(kind)


def visit(parts: Column, fields: set[str]) -> tuple[Column, Column]:
    """The body of a message and its attachments (kind, ref, tokens, in order). Neighbouring texts are kept apart by a line end."""

    def attached(p: Column) -> Column:
        return ~p["type"].eqNullSafe("text")

    def placeholder(p: Column) -> Column:
        marks = F.create_map(*[F.lit(x) for pair in PLACEHOLDER.items() for x in pair])
        return F.coalesce(marks[p["type"]], F.lit(OTHER))

    def piece(p: Column, i: Column) -> Column:
        follows = (i > 0) & ~attached(p) & ~attached(F.get(parts, i - 1))
        body = escape(F.coalesce(_field(p, fields, "text", "string"), F.lit("")))
        return F.when(attached(p), placeholder(p)).otherwise(F.concat(F.when(follows, "\n").otherwise(""), body))

    def record(p: Column) -> Column:
        width, height = _field(p, fields, "width", "int"), _field(p, fields, "height", "int")
        image = F.ceil(width / TILE) * F.ceil(height / TILE)
        audio = F.ceil(_field(p, fields, "seconds", "double") * PER_SECOND)
        pages = _field(p, fields, "pages", "long") * PER_PAGE
        tokens = F.when(p["type"] == "image", image).when(p["type"] == "audio", audio).when(p["type"] == "document", pages)
        return F.struct(
            p["type"].alias("kind"),
            _field(p, fields, "ref", "string").alias("ref"),
            F.coalesce(tokens, F.lit(UNSIZED)).cast("long").alias("tokens"),
        )

    return F.array_join(F.transform(parts, piece), ""), F.transform(F.filter(parts, attached), record)


def format_conversations(
    rows: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    parts_col: str | None = None,
    learn_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: id, ``n_turns``, ``formatted``, ``loss_spans``, ``attachments``, ``attachment_tokens``.

    ``rows`` holds a message each, of text (``text_col``) or of typed parts (``parts_col``, an array of structs with
    ``type`` and any of the fields of :data:`PARTS`). Turns go by turn, then role, then body; a null turn comes first.
    A null role or text is empty, a null or empty list of parts an empty body; an unknown or null type is an
    attachment of the placeholder :data:`OTHER`. Messages with a null id are one conversation. Repeated rows are turns
    of their own; an empty table gives an empty result; other columns are ignored.

    ``loss_spans`` are start and length, in code points of ``formatted``, of the bodies of ``learn_role``.
    """
    if parts_col is None:
        parts, fields = text_parts(rows[text_col]), {"text"}
    else:
        parts, fields = rows[parts_col], set(rows.schema[parts_col].dataType.elementType.names)
    parts = F.coalesce(parts, F.array().cast(rows.select(parts.alias("p")).schema["p"].dataType))
    base = rows.select(
        rows[conv_col].alias("conv"),
        rows[turn_col].alias("turn"),
        F.coalesce(rows[role_col], F.lit("")).alias("role"),
        parts.alias("parts"),
    )
    body, attachments = visit(F.col("parts"), fields)
    base = base.select("conv", "turn", "role", body.alias("body"), attachments.alias("attached"))
    base = base.withColumn("head", F.concat(F.lit(START), escape(F.col("role")), F.lit(SAY)))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "body")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(END)
    base = base.withColumns({"at": F.row_number().over(order), "start": F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head")})
    base = base.withColumn("learn", F.col("role") == learn_role)
    turns = F.array_sort(F.collect_list(F.struct("at", "head", "body", "start", "learn", "attached")))
    spans = F.transform(
        F.filter("turns", lambda t: t["learn"]),
        lambda t: F.struct(t["start"].cast("long").alias("start"), F.length(t["body"]).cast("long").alias("length")),
    )
    recorded = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                t["attached"],
                lambda a: F.struct((t["at"] - 1).cast("long").alias("turn_index"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")),
            ),
        )
    )
    return (
        base.groupBy("conv")
        .agg(turns.alias("turns"))
        .select(
            F.col("conv").alias(conv_col),
            F.size("turns").cast("long").alias("n_turns"),
            F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
            spans.alias("loss_spans"),
            recorded.alias("attachments"),
        )
        .withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    roles, bodies = (F.regexp_extract_all(formatted, F.lit(TURN), F.lit(k)) for k in (1, 2))
    return F.zip_with(roles, bodies, lambda r, b: F.struct(unescape(r).alias("role"), unescape(b).alias("text")))


def under_mask(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
