"""From documents to packed sequences: quality, line dedup, near-duplicates, mixing, packing.

A stage is a function of (spark, docs, sf_dir); what it returns is written as Parquet and reread as
the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens.llm import line_dedup, minhash, mixing, packing, quality
from orderlens.llm.common import table
from orderlens.llm.queries import ready
from orderlens.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier selects; fitted on rated documents of ``docs``."""
    ready(spark)
    graded = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return graded.where("selected").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document, or an earlier line, has."""
    return line_dedup.deduplicated(docs, shortest=1)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one of the smallest doc_id, and one row of it."""
    ready(spark)
    return minhash.representatives(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, as documents cut to the blocks that the mix takes."""
    ready(spark)
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences with their token ids."""
    ready(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("minhash near-dedup", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the fitted classifier nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, landing each in the shared folder."""
    ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
