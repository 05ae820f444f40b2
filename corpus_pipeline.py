"""A training corpus in five stages, each one operator of ``enrichkit.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet in the
shared folder and read again as the next stage's ``docs``. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from enrichkit.llm.catalog import tokenizer_path
from enrichkit.llm.neardup import one_of_each
from enrichkit.llm.packing import pack_documents
from enrichkit.llm.quality import MEASURES, passes, quality_ledger
from enrichkit.llm.secrets import redact_documents
from enrichkit.llm.tables import bound_batches, table
from enrichkit.llm.toxicity import keep_clean, train
from enrichkit.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    bound_batches(spark)
    return keep_clean(docs, train(docs, table(spark, sf_dir, "labels")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all quality rules."""
    bound_batches(spark)
    # Columns that are called like a measurement step aside.
    own = {c: f"{c}__of_the_document" for c in docs.columns if c in {*MEASURES, "fail_bits"}}
    kept = docs.withColumnsRenamed(own)
    passed = quality_ledger(kept, keep=kept.columns).filter(passes("v1")).select(kept.columns)
    return passed.withColumnsRenamed({new: old for old, new in own.items()})


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more.
    Unlike texts under one id all stay."""
    bound_batches(spark)
    return one_of_each(docs, words=5, percent=80, one_row=False)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets replaced."""
    bound_batches(spark)
    return redact_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids, packed into sequences of 1024 tokens."""
    bound_batches(spark)
    return pack_documents(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("secrets", secrets),
    ("packing", packing),
]
#: The stages hold a trained model, MinHash components and BPE, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
