"""Corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

Every stage works on all rows its predecessor kept; all but the last return
the columns of ``documents``, extra ones included, whatever these are called.
Null and empty texts are rejected by the first stage, which finds no letter in
them; the others take them as their docstrings say.  An empty table gives an
empty table in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crawlcat.llm import decontaminate, jaccard, language, packing, secrets
from crawlcat.llm.common import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model doesn't reject; ``lang`` stays as it was given.

    Null texts and texts without letters go; repeated rows are judged alike; a
    null ``lang`` or ``doc_id`` doesn't matter.  Without labelled rows all go.
    """
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    return language.recognised(docs, model)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the least id.

    Rows are told by id and text; null ids come last, rows that repeat both are
    one document, and all texts without words are one group.
    """
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark; null texts stay, every row is judged by its own text."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret but widely copied examples replaced; ``n_chars`` is counted anew.

    Null texts stay null (and have no ``n_chars``); repeated rows are answered
    alike and count once.
    """
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document left; a null text is one piece with the end id, repeated rows are packed each."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("packing", pack_sequences),
]

#: SQL can't express the tokenizer and the trained stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "_"))
    return docs
