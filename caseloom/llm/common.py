"""Small helpers that several operators of this package share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = 20240501

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # of the splitmix64 finaliser


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack(df: DataFrame) -> DataFrame:
    """The whole row as one struct column `doc`, so that helper columns cannot clash with its own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc"))


def unpack(df: DataFrame) -> DataFrame:
    return df.select("doc.*")


def word_list(text: Column) -> Column:
    """Lower-cased words of letters and digits; null text has none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def mix(h: np.ndarray) -> np.ndarray:
    """A full-avalanche permutation of unsigned 64-bit integers."""
    h = h ^ (h >> np.uint64(30))
    h = h * _M1
    h = h ^ (h >> np.uint64(27))
    h = h * _M2
    return h ^ (h >> np.uint64(31))
