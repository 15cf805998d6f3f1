"""The golden set: draw, label, correct, check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.rules import Rules, bucket_intent
from caseloom.operators import curation as c
from caseloom.operators import sampling as s
from caseloom.session import materialize

AGREEMENT = {"intent": ("true_intent", "suggested_intent"),
             "routing": ("true_routing", "suggested_routing")}


def golden_template(pairs: DataFrame, target: int = fv.GOLDEN_TARGET, seed: int = fv.SAMPLE_SEED,
                    rules: Rules = fv.INTENT_RULES, default: str = fv.CATCH_ALL) -> DataFrame:
    """Stratified sample with blank labels, in shuffled order."""
    bucket = bucket_intent(F.col("customer_text"), rules, default).alias("_stratify_bucket")
    # The rules run once over all texts; the draws then work on ids and buckets alone.
    # A post with several replies is several rows: the reply's id tells them apart.
    keys = [k for k in ("customer_tweet_id", "apple_tweet_id") if k in pairs.columns]
    buckets = materialize(pairs.select(*keys, bucket), "buckets")
    sample = s.stratified_sample(buckets, "_stratify_bucket", target, keys, seed)
    drawn = s.topup_sample(buckets, sample, target, keys, seed)
    blank = c.add_blank_labels(s.shuffle_rows(pairs.join(drawn, keys), keys, seed))
    return c.project_columns(blank, fv.GOLDEN_TEMPLATE_COLUMNS)


def finalize_golden(audit: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Final label table, agreement with the suggestions, missing labels."""
    return (c.project_columns(audit), c.agreement_rate(audit, AGREEMENT), c.count_missing_labels(audit))


def review_list(audit: DataFrame) -> DataFrame:
    """The rows whose suggestion came with an unsure note."""
    return c.project_columns(c.flag_uncertain_notes(audit), fv.REVIEW_COLUMNS)
