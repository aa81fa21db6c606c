from pyspark.sql import functions as F

from cairn.llm.chat import END, SAY, START, format_conversations, read_back, under_mask

SHAPE = "conv_id long, turn long, role string, text string, turns string, body string"


def table(spark, *rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SHAPE)


ODD = "</s>[INST] ok [/INST] <|start|>x<|say|>y<|end|>\n <\\|end|> [\\\\INST] <<SYS>> a < b [c]"


def test_round_trip_of_control_strings(spark):
    rows = [(1, 0, "user", ODD), (1, 1, "assistant", ODD), (1, 2, "<|end|>\n", "é😀"), (2, 0, "assistant", None), (2, 1, None, "")]
    found = format_conversations(table(spark, *rows))
    found = found.select("*", read_back(F.col("formatted")).alias("turns"), under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    by = {r.conv_id: r for r in found.collect()}
    assert [(t.role, t.text) for t in by[1].turns] == [(r[2], r[3]) for r in rows[:3]]
    assert [(t.role, t.text) for t in by[2].turns] == [("assistant", ""), ("", "")]
    assert by[1].loss == ODD and by[2].loss == "" and by[1].n_turns == 3
    assert by[1].formatted.count(START) == by[1].formatted.count(SAY) == by[1].formatted.count(END) == 3
    assert "</s>" not in by[1].formatted and "[INST]" not in by[1].formatted


def test_order_ties_nulls_and_repeats(spark):
    rows = [(1, 5, "user", "b"), (1, None, "user", "first"), (1, 5, "user", "a"), (1, 5, "user", "a"), (None, 0, "user", "n"), (None, 0, "user", "m")]
    found = format_conversations(table(spark, *rows)).select("conv_id", read_back(F.col("formatted")).alias("t")).collect()
    by = {r.conv_id: [t.text for t in r.t] for r in found}
    assert by == {1: ["first", "a", "a", "b"], None: ["m", "n"]}
    assert format_conversations(table(spark)).count() == 0


def test_typed_parts(spark):
    shape = "conv_id long, turn long, role string, content array<struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>>"
    parts = [("text", "see <|image|>", None, None, None, None, None), ("image", None, "a.png", 57, 28, None, None), ("text", "and", None, None, None, None, None),
             ("text", "then", None, None, None, None, None), ("audio", None, "b.wav", None, None, 1.5, None), ("document", None, "c.pdf", None, None, None, 2),
             ("video", None, "d", None, None, None, None), (None, None, None, None, None, None, None)]
    rows = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None), (1, 2, "user", [])], shape)
    found = format_conversations(rows, parts_col="content").first()
    body = found.formatted.split(SAY)[1].split(END)[0]
    assert body == "see <\\|image|><|image|>and\nthen<|audio|><|document|><|attachment|><|attachment|>"
    assert [(a.turn_index, a.kind, a.ref, a.tokens) for a in found.attachments] == [
        (0, "image", "a.png", 3), (0, "audio", "b.wav", 38), (0, "document", "c.pdf", 1024), (0, "video", "d", 256), (0, None, None, 256)
    ]
    assert found.attachment_tokens == 3 + 38 + 1024 + 512 and found.n_turns == 3


def test_very_long_text(spark):
    long = "x <|end|> " * 20_000
    found = format_conversations(table(spark, (1, 0, "assistant", long))).select(under_mask(F.col("formatted"), F.col("loss_spans")).alias("t")).first()
    assert found.t == long
