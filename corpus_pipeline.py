"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and gives a table that the next one reads
from Parquet.  All but the last keep the columns of documents; the last gives the
places of the token pieces in their sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.llm import exact_dedup, langid, ngram_join, packing, substring
from docroute.llm.tokenise import tokenizer_file
from docroute.sources.documents import shared_folder


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null or no letters) go."""
    return langid.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, one document stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similarity 0.75 join, one stays."""
    return ngram_join.drop_near_copies(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in a run of 35 that occurs elsewhere go; a text that loses all its
    words stays as an empty one."""
    left = substring.remove_repeated(docs)
    if "n_chars" not in docs.columns:
        return left
    length = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return left.select(*[length.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and their offset in it."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("ngram_join", drop_near_copies),
    ("substring_dedup", remove_repeated_passages),
    ("best_fit_packing", pack_sequences),
]

#: SQL has no language model to fit and no tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    folder = f"{shared_folder(spark)}/docroute-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
