"""Global order without a global task, at every size by the same path.

A window without partitions would pull every row into one task.  Here rows are
range-partitioned and sorted by the key, written once with their place, and
the totals of the partitions before are added.  Keys may be null (they come
first), repeat, or be of any type with an order; a hash of the row breaks ties,
so a key that repeats very often is split as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import materialize

_PLACE, _PART, _TIE, _OFFSET = "_place", "_part", "_tie", "_offset"
_ROW_BITS = 33  # of monotonically_increasing_id: the rest is the partition


def _placed(df: DataFrame, key: str) -> DataFrame:
    """Rows with their partition in key order and their place inside it."""
    tied = df.withColumn(_TIE, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    ranged = tied.repartitionByRange(F.col(key), F.col(_TIE)).sortWithinPartitions(F.col(key), F.col(_TIE)).drop(_TIE)
    table = materialize(ranged.withColumn(_PLACE, F.monotonically_increasing_id()), "ordered")
    return table.withColumn(_PART, F.shiftright(_PLACE, _ROW_BITS))


def _offsets(totals: DataFrame, total: str) -> DataFrame:
    """Sum of the totals of all partitions before; one row per partition."""
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(_PART, F.coalesce(F.sum(total).over(before), F.lit(0)).alias(_OFFSET))


def running_total(df: DataFrame, key: str, amount: str, out: str) -> DataFrame:
    """out = sum of amount over all rows before, in the order of the key."""
    placed = _placed(df, key)
    inside = Window.partitionBy(_PART).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = _offsets(placed.groupBy(_PART).agg(F.sum(amount).alias("_total")), "_total")
    local = placed.withColumn("_local", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return (local.join(offsets, _PART).withColumn(out, F.col(_OFFSET) + F.col("_local"))
            .drop(_PART, _PLACE, _OFFSET, "_local"))


def global_row_number(df: DataFrame, key: str, out: str) -> DataFrame:
    """1-based position of every row in the order of the key; no window, one shuffle."""
    placed = _placed(df, key)
    offsets = _offsets(placed.groupBy(_PART).agg(F.count("*").alias("_total")), "_total")
    inside = F.col(_PLACE).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (placed.join(offsets, _PART).withColumn(out, F.col(_OFFSET) + inside + 1)
            .drop(_PART, _PLACE, _OFFSET))
