"""Corpus pipeline: documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``. All stages take NULLs in any column, empty and
very long texts, repeated rows, an empty table and extra columns; what they make of them is
said by the operator that each one calls. All but the last return the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm import exact, langid, mixing, packing, simhash
from larder.llm.queries import vocabulary
from larder.session import stage

END_ID = 1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told.

    Texts without a letter go, NULL included, and texts that score at most 1.2 times chance,
    which is one part in the number of learned languages (see ``langid.keep_identified``).
    """
    return langid.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per distinct text (A-Z in lower case); the largest id stays."""
    return exact.drop_exact_copies(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per group of near copies; the smallest id stays.

    Near copies have a Jaccard similarity of 0.8 or more over distinct runs of five words.
    Texts are grouped by SimHash fingerprints at most 4 bits apart, of 64, and decided inside a
    group by comparing the sets; pairs at 0.8 that lie further apart are proposed by MinHashes.
    """
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document is left out or taken up to three times."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens, with their token ids."""
    return packing.pack_documents(docs, vocabulary(), END_ID)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Language scores, fingerprints and token ids are beyond SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
