"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns of documents.  Nulls, empty and repeated rows are
treated as the operators' docstrings say; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dimflow.llm.common import read_table
from dimflow.llm.op1_ngram_join import ngram_join
from dimflow.llm.op3_secrets import redact_secrets
from dimflow.llm.op8_mixing import sample_mix
from dimflow.llm.op9_bpe import encode_documents
from dimflow.llm.op10_quality import keep_quality, train
from dimflow.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the field is trained on labels."""
    return keep_quality(docs, train(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 5-word shingle sets with Jaccard >= 0.8,
    the one of the smallest id; documents without words stay."""
    joined = ngram_join(docs, n=5, num=80, den=100)
    gone = joined.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced in their texts."""
    return redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in the target mix of sources, languages and topics."""
    return sample_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, with digests of ids and decoded text."""
    return encode_documents(docs, keep_ids=True)


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates),
          ("secret scans", secrets), ("mixing to target weights", mix),
          ("BPE encoding and decoding", tokens)]

#: Training, raking and encoding are not expressible in SQL; the stages are
#: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
