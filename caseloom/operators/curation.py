"""The hand-labelled set: blank template, corrections, agreement, review list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.text import matches_any
from caseloom.sources.tables import OVERRIDES, literal_table


def add_blank_labels(df: DataFrame, cols: Sequence[str] = fv.LABEL_COLUMNS) -> DataFrame:
    return df.withColumns({c: F.lit("") for c in cols})


def project_columns(df: DataFrame, cols: Sequence[str] = fv.GOLDEN_FINAL_COLUMNS) -> DataFrame:
    return df.select(*cols)


def count_missing_labels(df: DataFrame,
                         cols: Sequence[str] = ("true_intent", "true_routing")) -> DataFrame:
    """One row, missing_<column>: null or empty labels."""
    return df.agg(*[F.count_if(F.col(c).isNull() | (F.col(c) == "")).alias(f"missing_{c}")
                    for c in cols])


def default_overrides(spark: SparkSession) -> DataFrame:
    return literal_table(spark, fv.LABEL_OVERRIDES, OVERRIDES)


def apply_overrides(df: DataFrame, overrides: DataFrame, key: str = "customer_tweet_id",
                    cols: Sequence[str] = fv.LABEL_COLUMNS) -> DataFrame:
    """Replace all label columns of the listed rows together.

    An override may set "" or null, so the hit is a flag of its own.  Spark
    broadcasts the overrides when it finds them small enough.
    """
    one_each = overrides.groupBy(key).agg(F.min(F.struct(*cols)).alias("_new"))
    joined = df.join(one_each.withColumn("_hit", F.lit(True)), key, "left")
    changed = {c: F.when(F.col("_hit"), F.col(f"_new.{c}")).otherwise(F.col(c)) for c in cols}
    return joined.withColumns(changed).select(*df.columns)


def override_metrics(df: DataFrame, overrides: DataFrame, key: str = "customer_tweet_id") -> DataFrame:
    """One row: rows changed, overrides planned, whether they differ."""
    matched = df.join(overrides.select(key).distinct(), key, "left_semi")
    parts = matched.select(F.lit(1).alias("m"), F.lit(0).alias("p")).unionAll(
        overrides.select(key).distinct().select(F.lit(0), F.lit(1)))
    sums = parts.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("rows_changed"),
                     F.coalesce(F.sum("p"), F.lit(0)).alias("overrides_planned"))
    return sums.withColumn("mismatch", F.col("rows_changed") != F.col("overrides_planned"))


def agreement_rate(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row per name: equal labels over all rows; null never agrees."""
    sums = df.agg(F.count("*").alias("total"),
                  *[F.count_if(F.col(a) == F.col(b)).alias(name) for name, (a, b) in pairs.items()])
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"), F.col(name).alias("agreed")) for name in pairs]))
    return (sums.select("total", rows.alias("r"))
            .select("r.measure", "r.agreed", "total",
                    F.try_divide("r.agreed", "total").alias("agreement")))


def flag_uncertain_notes(df: DataFrame, note: str = "model_confidence_note",
                         markers: Sequence[str] = fv.UNCERTAINTY_MARKERS) -> DataFrame:
    """Rows whose note sounds unsure; rows without a note drop out."""
    return df.where(matches_any(F.lower(note), markers, ignore_case=False))
