"""The corpus pipeline: STAGES in order, each over all that the one before kept.

``run(spark, sf_dir)`` applies them to ``documents``; every stage's result is
written as Parquet into the shared checkpoint folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lifetide.llm.common import stage, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the learned languages go (no letter, or a score under langid.MIN_SCORE)."""
    from lifetide.llm import langid
    return langid.keep(docs, langid.fit(langid.fold(docs)))


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of documents linked by shingles, the one with the smallest doc_id stays."""
    from lifetide.llm.jaccard import keep_one
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    from lifetide.llm.decontam import clean
    return clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts become pseudonyms; n_chars follows the text."""
    from pyspark.sql import functions as F

    from lifetide.llm import pii
    out = pii.pseudonymise(docs, count_col=None)
    cols = [F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*cols) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words taken of every kept document at the target weights of the sources."""
    from lifetide.llm.mixing import mix
    return mix(docs)


STAGES = [
    ("language id", identify_language),
    ("n-gram jaccard join", join_near_copies),
    ("benchmark decontamination", decontaminate),
    ("pii", pseudonymise),
    ("source mix", mix_sources),
]

#: SQL cannot express the language model; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
