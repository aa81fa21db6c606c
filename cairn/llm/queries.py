"""The registered queries opN_*: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.llm import chat, decontaminate, exact_dedup, html_extract, kneser_ney, line_dedup, packing, simhash, token_count, toxicity
from cairn.sources.tables import table

ASCII_LOWER = f"translate(coalesce(text, ''), '{exact_dedup.UPPER}', '{exact_dedup.LOWER}')"


def op1_chat_format(spark, sf):
    control = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").union(added)
    found = chat.format_conversations(rows)
    turns = F.transform(chat.read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = chat.under_mask(F.col("formatted"), F.col("loss_spans"))
    return found.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"),
        F.sha2(masked, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_decontaminate(spark, sf):
    return decontaminate.overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def learnable(doc):
    """SQL of the rows whose labels may be learnt from; a null id is one of them."""
    return f"not coalesce(crc32(cast(cast({doc} as string) as binary)) % 3 = 1, false)"


def op3_toxicity(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.train(docs, labels, F.expr(learnable("doc")))
    return toxicity.score(docs, model).withColumn("held_out", ~F.expr(learnable("doc_id")))


def op4_line_dedup(spark, sf):
    return line_dedup.line_dedup(table(spark, sf, "documents"))


def op5_token_count(spark, sf):
    import public_tokenizers

    return token_count.count_tokens(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_simhash(spark, sf):
    found = simhash.near_groups(table(spark, sf, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex(F.col("signature")[0]), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_packing(spark, sf):
    import public_tokenizers

    found = packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op8_html_extract(spark, sf):
    found = html_extract.extract(table(spark, sf, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_exact_dedup(spark, sf):
    return exact_dedup.exact_groups(table(spark, sf, "documents"))


def op10_kneser_ney(spark, sf):
    docs = table(spark, sf, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    model = kneser_ney.train(docs.where(~held_out))
    return kneser_ney.score(docs, model).withColumn("held_out", held_out)


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_decontaminate": op2_decontaminate,
    "op3_toxicity": op3_toxicity,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_count": op5_token_count,
    "op6_simhash": op6_simhash,
    "op7_packing": op7_packing,
    "op8_html_extract": op8_html_extract,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_kneser_ney": op10_kneser_ney,
}

ORACLE = {
    "op1_chat_format": r"""
        with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
                   union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
                   union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e as (select *, '([<\[])(\\*)(\|[A-Za-z0-9_]*\|>|/?s>|/?SYS>>|/?INST\])' as control from c),
        t as (select *, regexp_replace(text, control, '\1\\\2\3', 'g') as body,
                     regexp_replace(role, control, '\1\\\2\3', 'g') as head from e),
        s as (select conv_id, count(*) as n_turns,
                     string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, body) as turns,
                     coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, body), '') as loss,
                     sum(24 + length(head) + length(body)) as formatted_chars
              from t group by conv_id)
        select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
               cast(formatted_chars as bigint) as formatted_chars
        from s""",
    "op2_decontaminate": r"""
        with d as (select doc_id, unnest(w) as w, generate_subscripts(w, 1) as p
                   from (select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w
                         from documents)),
        i as (select item_id, unnest(w) as w, generate_subscripts(w, 1) as p, len(w) as n
              from (select item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w
                    from benchmark)),
        m as (select doc_id, item_id, n, d.p - i.p as shift, i.p as pos from d join i using (w)),
        near as (select doc_id, item_id, shift, count(*) as matched from m group by all having count(*) >= least(n, 8)),
        win as (select *, count(*) over (partition by doc_id, item_id, shift order by pos
                                         range between current row and 12 following) as w
                from m join near using (doc_id, item_id, shift))
        select doc_id, item_id, n as item_tokens, max(matched) as matched, max(w) as window_matched from win
        where w >= case when n < 13 then n else 11 end group by all""",
    "op4_line_dedup": r"""
        with l as (select doc_id, source, unnest(x) as line, generate_subscripts(x, 1) as p
                   from (select doc_id, coalesce(source, chr(0)) as source, string_split(coalesce(text, ''), chr(10)) as x from documents)),
        k as (select *, trim(line, ' ' || chr(9) || chr(13)) as t from l),
        gone as (select t from k where t <> '' group by t having count(distinct source) >= 10)
        select doc_id, coalesce(string_agg(case when g.t is null then line end, chr(10) order by p), '') as text,
               count(case when k.t <> '' then 1 end) as n_lines, count(g.t) as n_removed
        from k left join gone g on k.t = g.t group by doc_id""",
    "op9_exact_dedup": f"""
        with d as (select doc_id, {ASCII_LOWER} as t from documents)
        select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
               doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
        from d window w as (partition by t)""",
}
