"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lifetide.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_source_mix(spark, base):
    from lifetide.llm.mixing import mix
    return mix(table(spark, base, "documents"))


@query
def op5_pii_pseudonyms(spark, base):
    from lifetide.llm.pii import pseudonymise
    return pseudonymise(table(spark, base, "documents").select("doc_id", "text"))


@query
def op8_template_decontam(spark, base):
    from lifetide.llm.decontam import contaminated
    return contaminated(table(spark, base, "documents"), table(spark, base, "benchmark"))


@query
def op3_license_scan(spark, base):
    from lifetide.llm.licenses import scan
    return scan(table(spark, base, "documents"))


@query
def op9_language_id(spark, base):
    from lifetide.llm.langid import language_of_documents
    return language_of_documents(table(spark, base, "documents"))


@query
def op2_quality_gam(spark, base):
    from lifetide.llm.quality import quality_of_documents
    return quality_of_documents(table(spark, base, "documents"), table(spark, base, "labels"))


@query
def op7_toxicity(spark, base):
    from lifetide.llm.toxicity import toxicity_of_documents
    return toxicity_of_documents(table(spark, base, "documents"), table(spark, base, "labels"))


@query
def op6_piecewise_fingerprints(spark, base):
    from lifetide.llm.fingerprints import fingerprint_documents
    return fingerprint_documents(table(spark, base, "documents"))


@query
def op4_sentence_spans(spark, base):
    from lifetide.llm.spans import dedup_spans
    return dedup_spans(table(spark, base, "documents").select("doc_id", "text"))


@query
def op1_ngram_jaccard(spark, base):
    from lifetide.llm.jaccard import join
    return join(table(spark, base, "documents"))


@query
def op13_spelling_variants(spark, base):
    from lifetide.llm.variants import spelling_variants
    return spelling_variants(table(spark, base, "documents"))


@query
def op11_maxscore_search(spark, base):
    from lifetide.llm.maxscore import search_vectors
    return search_vectors(table(spark, base, "embeddings"))


@query
def op12_conversation_repair(spark, base):
    from lifetide.llm.conversations import repair_conversations
    return repair_conversations(table(spark, base, "conversations"))
