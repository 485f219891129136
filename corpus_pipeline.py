"""From raw documents to packed training sequences, in five stages.

Each stage takes all documents that its predecessor kept and returns a DataFrame. All but the last
return the columns of `documents`, with `n_chars` following the text. `run` writes the result
of each stage to the shared folder and reads it back, so that a lost executor costs a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensula.llm import classifier, line_dedup, pii, queries, simhash
from mensula.llm.common import table
from mensula.sizing import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the cut; the model learns from `labels` and the given texts."""
    model = queries.quality_model(docs, table(spark, sf_dir, "labels"))
    return docs.where(classifier.scorer(docs, model) >= queries.QUALITY_CUT)


def _with_text(cleaned: DataFrame, docs: DataFrame) -> DataFrame:
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate across sites and stand first elsewhere."""
    return _with_text(line_dedup.clean(docs), docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id."""
    return simhash.deduplicate(docs, shingle=4, distance=4)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return _with_text(docs.withColumn("text", pii.redacted(docs, pii.learn(docs))), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return queries.packed(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", simhash_stage),
    ("PII", pii_stage),
    ("packing", packing_stage),
]

# A trained model, a text's hashes and a tokenizer are not for SQL; tests/llm/test_pipeline.py has the plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
