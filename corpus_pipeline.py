"""From raw documents to token ids: five stages, each an operator of ``trolley.llm``.

Each stage takes the documents that the one before left, with all their columns, and its
decisions take effect: rows go, or texts change. The last returns tokens in place of documents.
Between stages, documents are a Parquet table below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm import decontamination, line_dedup, ngram_join, quality, sentencepiece_codec
from trolley.llm.arrow_maps import ready
from trolley.session import scratch_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling selects; the labels are those of ``labels``."""
    ratio = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.selected(docs, ratio)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the lines that no smaller ``doc_id`` holds, and ``n_chars`` of those."""
    return line_dedup.rewritten(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest ``doc_id`` of each group of near duplicates: sets of
    five-word shingles with a Jaccard similarity of 0.8 and more."""
    return ngram_join.firsts(docs, n=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of ``benchmark``."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and the text that they ``decoded`` to."""
    tokens = sentencepiece_codec.round_trip(docs, sentencepiece_codec.MODEL_FILE)
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece_tokens),
]

#: Training a model and segmenting words are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
