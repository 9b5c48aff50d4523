"""Registered queries of the operators: one thin query each, over the whole of
its table, deriving the digest columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm.common import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
#: DuckDB SQL of the queries that SQL can express on whole tables.
ORACLES: dict[str, str] = {}


def register(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have Jaccard >= 0.85."""
    from dimflow.llm.op1_ngram_join import ngram_join
    return ngram_join(read_table(spark, sf_dir, "documents"), n=4, num=85, den=100)


@register
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    from dimflow.llm.op3_secrets import scan_secrets
    return scan_secrets(read_table(spark, sf_dir, "documents"))


@register
def op4_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 contiguous shards of near equal bytes over all documents."""
    from dimflow.llm.op4_shards import shard_documents
    return shard_documents(read_table(spark, sf_dir, "documents"), shards=24)


@register
def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and the text decoded from them."""
    from dimflow.llm.op9_bpe import encode_documents
    return encode_documents(read_table(spark, sf_dir, "documents"))


@register
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count rules and content share of every document."""
    from dimflow.llm.op10_quality import quality_rules, train
    docs = read_table(spark, sf_dir, "documents")
    return quality_rules(docs, train(docs, read_table(spark, sf_dir, "labels")))


@register
def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of embeddings with cosine >= 0.95."""
    from dimflow.llm.op5_vectors import near_vectors
    return near_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.95)


@register
def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy passages that documents share, each with its class and links."""
    from dimflow.llm.op2_passages import passage_classes, repeated_passages
    return passage_classes(repeated_passages(read_table(spark, sf_dir, "documents")))


@register
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    from dimflow.llm.op6_langid import identify, train
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, train(docs))


@register
def op7_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms of every document."""
    from dimflow.llm.op7_pii import sanitise
    out = sanitise(read_table(spark, sf_dir, "documents"))
    return out.withColumn("clean_sha256", F.sha2("clean_text", 256)).drop("clean_text")


@register
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raked weight, probability and choice of every document."""
    from dimflow.llm.op8_mixing import mix_sources
    return mix_sources(read_table(spark, sf_dir, "documents"))


@register
def op12_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 tokens."""
    from dimflow.llm.op12_packing import pack_documents
    return pack_documents(read_table(spark, sf_dir, "documents"), window=4096, end_id=2)


@register
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the 16 leading whitened components."""
    from dimflow.llm.op13_whitening import whiten
    return whiten(read_table(spark, sf_dir, "embeddings"), components=16)


@register
def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest collocations of each language."""
    from dimflow.llm.op11_phrases import collocations
    return collocations(read_table(spark, sf_dir, "documents"), min_count=30, top=2000)


def _sql_of_phrases() -> str:
    from dimflow.llm.op11_phrases import ORACLE_SQL
    return ORACLE_SQL


ORACLES["op11_phrase_mining"] = _sql_of_phrases()
