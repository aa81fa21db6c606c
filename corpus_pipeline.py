"""The corpus pipeline: raw documents in, packed training sequences out.

Each stage is a function of (spark, docs, folder of the tables) and gets what the stage before it kept. All but the
last return the columns of ``documents``. Null texts count as empty, null ids are ids like any other, repeated rows are
exact copies of which one stays, and an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from cairn.llm.queries import learnable
from cairn.session import Workspace
from cairn.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic; it learns from the rows that op3 may learn from."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), F.expr(learnable("doc")))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles agree to 0.8 or more."""
    return simhash.near_dedup(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: SQL has neither the classifier, nor the signatures, nor the tokenizer; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; what has been read goes."""
    work = Workspace(spark, "corpus-pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, work.save(stage(spark, docs, sf_dir), name)
        if number:
            work.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
