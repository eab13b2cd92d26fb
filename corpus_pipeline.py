"""From raw documents to packed token windows, stage by stage.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerframe.llm import exact, packing, pii, simhash, toxicity
from ledgerframe.llm.common import keep, table
from ledgerframe.llm.queries import byte_bpe, packed_digests


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on ``labels``, rejects go."""
    chain = toxicity.fit_chain(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, chain)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of fingerprints linked at four bits or fewer the smallest doc_id stays."""
    return simhash.near_dedup(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind in brackets."""
    return pii.mask(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces; see ``op4_packing`` for the columns."""
    # fewer remembered segments than by default: Python workers keep what the stages
    # before have taken of an executor's memory
    return packed_digests(packing.token_pieces(docs, byte_bpe(), remember=150_000))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_windows),
]

# the toxicity models and the fingerprints are beyond SQL; the tests hold the result
# against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
