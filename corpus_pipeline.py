"""A corpus pipeline of five operators, each stage written and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, ngram_join, packing, pii, quality
from tidemark.session import scratch_dir, prepare_python


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the threshold table keeps."""
    return quality.kept_rows(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies:
    five-word shingles, linked from a similarity of 80 percent on."""
    prepare_python(spark)
    return ngram_join.one_of_each(docs, percent=80, shingle=5)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    prepare_python(spark)
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return pii.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    prepare_python(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("packing", sequence_packing),
]

#: SQL cannot express the tokens of the last stage; tests hold it against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in the
    shared folder and read as the next stage's documents."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = scratch_dir(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
