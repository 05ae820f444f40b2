"""The operators' queries: ``name -> fn(spark, sf_dir)``, and DuckDB SQL where SQL can say it.

Every query runs its operator with production parameters over its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrichkit.llm import oracle
from enrichkit.llm.bpe import round_trip_digests
from enrichkit.llm.chat import conversation_digests, probe_conversation
from enrichkit.llm.counting import edited_counts, sample_edits
from enrichkit.llm.fingerprints import fingerprint_documents
from enrichkit.llm.lexical import ranked_search
from enrichkit.llm.neardup import near_duplicates
from enrichkit.llm.packing import pack_documents
from enrichkit.llm.pieces import piece_digests
from enrichkit.llm.quality import passes, quality_ledger
from enrichkit.llm.runs import run_digests
from enrichkit.llm.secrets import scan_documents
from enrichkit.llm.sharding import shard_documents
from enrichkit.llm.tables import table
from enrichkit.llm.toxicity import score_documents, train

BPE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"


def tokenizer_path() -> str:
    return public_tokenizers.path(BPE_FILE)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_digests(probe_conversation(table(spark, sf_dir, "conversations")), tokenizer_path())


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return edited_counts(docs.withColumn("edits", sample_edits(F.col("text"))), tokenizer_path())


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality_ledger(table(spark, sf_dir, "documents"))
    return ledger.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes("base")).alias("base_failed"),
        passes("v1").alias("kept"),
        "fail_bits",
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels")))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_documents(table(spark, sf_dir, "documents"))

    def written(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_FILE))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_minhash_near_dedup,
        op3_chat_formatting,
        op4_best_fit_packing,
        op5_token_counts,
        op6_bpe,
        op7_fingerprints,
        op8_quality_rules,
        op9_toxicity,
        op10_secret_scans,
        op11_sentencepiece,
        op12_ranked_search,
        op13_periodic_runs,
        pipeline,
    )
}
ORACLE: dict[str, str] = oracle.SQL
