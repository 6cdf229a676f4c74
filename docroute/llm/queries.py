"""One registered query per operator, each over its whole table.

A query applies its operator with production parameters and derives the columns
of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from docroute.llm import ann, bpe_chunks, exact_dedup, langid, lm, ngram_join, packing, phrases, substring, suffixes, token_counts, wavelet, whitening
from docroute.llm.tokenise import tokenizer_file


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.near_copies(_documents(spark, sf))


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return langid.languages(_documents(spark, sf)).drop("mixture")


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf), tokenizer_file("piece_bpe_32k.model"))


def op4_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    ranks = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    return bpe_chunks.encode_digests(_documents(spark, sf), ranks, public_tokenizers.PATTERN)


def op5_nearest_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(spark.read.parquet(f"{sf}/embeddings.parquet"))


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf))


def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return wavelet.token_files(_documents(spark, sf), tokenizer_file("byte_bpe_50k.json"))


def op8_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring.substring_digests(_documents(spark, sf))


def op9_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf), tokenizer_file("word_bpe_49k.json"))


def op10_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score(_documents(spark, sf))


def op11_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """A deviation of more than 63 bits is null."""
    rows = whitening.whiten(spark.read.parquet(f"{sf}/embeddings.parquet"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    left = suffixes.remove_repeated_bytes(_documents(spark, sf))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(_documents(spark, sf))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_language_id": op2_language_id,
        "op3_token_counts": op3_token_counts,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_nearest_vectors": op5_nearest_vectors,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_token_files": op7_token_files,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_lm_scores": op10_lm_scores,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_suffix_dedup": op12_suffix_dedup,
        "op13_phrase_collocations": op13_phrase_collocations,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": ngram_join.ORACLE_SQL,
        "op5_nearest_vectors": ann.ORACLE_SQL,
        "op6_exact_dedup": exact_dedup.ORACLE_SQL,
        "op8_substring_dedup": substring.ORACLE_SQL,
        "op13_phrase_collocations": phrases.ORACLE_SQL,
    }
