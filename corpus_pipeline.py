"""From raw documents to a mixed, encoded corpus: quality, repeated lines, near-duplicates, mixing, encoding.

Each stage works on all rows that the one before kept. Between stages the documents are written and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import bpe, line_runs, mixing, quality, simhash
from souk.llm.frames import scope, stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go (score below 0.3)."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines of 50 words or more are cut out; a document of which nothing is left goes."""
    columns = docs.columns
    length = "n_chars" if "n_chars" in columns else None
    kept = line_runs.drop_repeated_runs(docs, min_words=50, length_col=length)
    whole, gone = kept.columns[len(columns) :]
    return kept.filter(F.col(gone) < F.col(whole)).select(*columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by fingerprints of three-word shingles, 3 bits apart at most, or by five-word
    shingles with a Jaccard similarity of 0.8 or more, the one with the smallest id stays."""
    return simhash.first_of_each_group(docs, shingle_words=3, max_distance=3, similarity=0.8)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are weighed by the square root of their bytes, documents repeated accordingly and shuffled."""
    return mixing.mix(docs, exponent=0.5, epochs=1.0, seed=42).select(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document."""
    return bpe.encode(docs).select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]

#: The classifier, the fingerprints and the encoding cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Tables written on the way are deleted but for the one that the last stage reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scope(spark, keep_last=True):
        for _, function in STAGES[:-1]:
            with scope(spark, keep_last=True):
                docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
