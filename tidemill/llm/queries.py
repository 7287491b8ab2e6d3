"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.chat_format import format_turns, read_back
from tidemill.llm.decontaminate import contained_items
from tidemill.llm.exact_dedup import exact_duplicates
from tidemill.llm.importance_resampling import resample
from tidemill.llm.jaccard_join import jaccard_components
from tidemill.llm.pii import digest_columns as pii_columns
from tidemill.llm.pii import find_personal_data
from tidemill.llm.secret_scan import digest_columns as secret_columns
from tidemill.llm.secret_scan import find_secrets
from tidemill.llm.sentencepiece_dropout import encode_documents
from tidemill.llm.suffix_dedup import remove_repeats
from tidemill.llm.token_counts import edited_counts, with_sample_edits
from tidemill.llm.tokenizer_alignment import align_documents
from tidemill.llm.toxicity import held_out, score_documents, train
from tidemill.llm.word_table_bpe import encoded_digests as word_bpe_digests

#: Folder of the public vocabularies.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")

#: Documents that score this much count as toxic.
TOXIC_FROM = 0.3

Query = Callable[[SparkSession, str], DataFrame]


def importable(spark: SparkSession) -> None:
    """Environment of Python workers.

    They find this package even if only the driver has it on its path (on a cluster it is
    installed or shipped), and Arrow takes its memory where it can be given back.
    """
    environment = spark.sparkContext.environment
    environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    environment.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def encoded_digests(docs: DataFrame) -> DataFrame:
    """Per document: token count and digests of the ids and of the text decoded from them."""
    return encode_documents(docs, f"{TOKENIZERS}/piece_bpe_32k.model").select(
        "doc_id",
        "n_tokens",
        "n_chars",
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        "lossless",
    )


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(_table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents")).drop("row")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four edits per document, drawn from hashes of doc_id."""
    edited = edited_counts(with_sample_edits(_table(spark, sf_dir, "documents")), f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    return edited.withColumn("n_leaves", F.size("leaf_tokens").cast("long")).drop("leaf_chars", "leaf_tokens")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train(docs, _table(spark, sf_dir, "labels"))
    return score_documents(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"),
        F.to_json("offending").alias("offending"),
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_columns(find_secrets(_table(spark, sf_dir, "documents")))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like the template."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    return read_back(format_turns(turns.unionByName(extra)))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_columns(find_personal_data(_table(spark, sf_dir, "documents")))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return align_documents(docs, f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe_digests(_table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


def registered_queries() -> dict[str, Query]:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_decontaminate": op3_decontaminate,
        "op4_token_counts": op4_token_counts,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_toxicity": op6_toxicity,
        "op7_secret_scan": op7_secret_scan,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_chat_format": op9_chat_format,
        "op10_pii": op10_pii,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_tokenizer_alignment": op12_tokenizer_alignment,
        "op13_word_bpe": op13_word_bpe,
    }
