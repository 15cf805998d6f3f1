"""A join that stays splittable when one key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HASH = "_key_hash"


def join_lookup(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join rows, of which very many may share a key, with one lookup row per key.

    A lookup that was aggregated by the key would reuse that shuffle for the
    join, and adaptive execution only splits a hot partition between two
    shuffles made for the join.  The hash as a second join key asks for them.
    """
    hashed = lookup.withColumn(_HASH, F.xxhash64(key))
    return rows.withColumn(_HASH, F.xxhash64(key)).join(hashed, [key, _HASH], how).drop(_HASH)
