"""The corpus pipeline: five stages over documents, each written and read again.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame.  All but the last return the columns of docs.  Every stage works on
all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseloom.llm import minhash, mixing, packing, pii, toxicity
from caseloom.llm.common import table
from caseloom.session import materialize

MIX_WEIGHTS, OTHER_WEIGHT = {"src0": 2.0}, 1.0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return minhash.drop_near_duplicates(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; spans of personal data are replaced by their kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out at their source's rate, in a shuffled order."""
    return mixing.mix_sources(docs, MIX_WEIGHTS, OTHER_WEIGHT)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2048 tokens."""
    return packing.pack_windows(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Learned scores, darts and token ids have no SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
