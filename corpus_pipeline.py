"""From raw documents to token files: quality rules, near copies, benchmark passages, mixing, tokens.

Each stage takes what the one before it kept and returns whole documents, the last one the digest of the
token store. ``run`` writes every stage as Parquet below the shared folder and reads it again, so a lost
executor costs no more than the stage at work. Documents keep their columns, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsetrail.llm.common import table
from pulsetrail.llm.decontam import without_items
from pulsetrail.llm.mixing import mixed_rows
from pulsetrail.llm.quality import quality
from pulsetrail.llm.queries import tokenizer_path
from pulsetrail.llm.simhash import without_near_copies
from pulsetrail.llm.token_store import read_tokens, write_tokens
from pulsetrail.workspace import stage

# Tokens are no matter of SQL; tests hold the pipeline against a plain version of it.
ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality(docs).filter("kept").select("_row.*")


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return without_near_copies(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_rows(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the token store, read back: doc_id, start, n_tokens, ids_crc32."""
    return read_tokens(spark, write_tokens(docs, tokenizer_path()), with_ids=False)


STAGES = [
    ("quality rules", good_documents),
    ("simhash near copies", distinct_documents),
    ("benchmark decontamination", clean_documents),
    ("mixing to target weights", mixed_documents),
    ("token files", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
