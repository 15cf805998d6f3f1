from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.operators import curation as c
from caseloom.plans import curate

AUDIT = ("customer_tweet_id long, customer_text string, apple_reply_text string, is_dm_redirect boolean, true_intent string, "
         "true_routing string, escalation_reason string, suggested_intent string, suggested_routing string, "
         "suggested_reason string, model_confidence_note string")


def audit(spark):
    row = lambda i, intent, note: (i, "t", "r", False, intent, "escalate", "why", "x", "escalate", "", note)
    return spark.createDataFrame([row(1, "x", "Neither fits"), row(2, "y", None), row(3, "", "clear case"),
                                  row(4, None, "COULD also be"), row(671346, "x", "unclear")], AUDIT)


def test_overrides_replace_all_three_columns(spark):
    new = spark.createDataFrame([(1, "z", "auto_handle", ""), (99, "z", "auto_handle", "")],
                                "customer_tweet_id long, true_intent string, true_routing string, escalation_reason string")
    got = {r.customer_tweet_id: r for r in c.apply_overrides(audit(spark), new).collect()}
    assert (got[1].true_intent, got[1].true_routing, got[1].escalation_reason) == ("z", "auto_handle", "")
    assert (got[2].true_intent, got[2].escalation_reason) == ("y", "why") and len(got) == 5
    assert tuple(c.override_metrics(audit(spark), new).first()) == (1, 2, True)


def test_default_overrides(spark):
    default = c.default_overrides(spark)
    assert default.count() == len(fv.LABEL_OVERRIDES) == 16
    got = c.apply_overrides(audit(spark), default).where("customer_tweet_id = 671346").first()
    assert (got.true_intent, got.escalation_reason) == ("app_store_billing", "account_security_risk")


def test_finalize(spark):
    final, agreement, missing = curate.finalize_golden(audit(spark))
    assert final.columns == fv.GOLDEN_FINAL_COLUMNS and final.count() == 5
    assert {r.measure: (r.agreed, r.total, r.agreement) for r in agreement.collect()} == {
        "intent": (2, 5, 0.4), "routing": (5, 5, 1.0)}
    assert tuple(missing.first()) == (2, 0)


def test_review_list(spark):
    listed = curate.review_list(audit(spark))
    assert listed.columns == fv.REVIEW_COLUMNS
    assert sorted(r.customer_tweet_id for r in listed.collect()) == [1, 4, 671346]


def test_golden_template(spark):
    text = F.element_at(F.array(*[F.lit(x) for x in ("battery", "update now", "wifi", "login", "refund", "hello")]),
                        (F.col("id") % 6 + 1).cast("int"))
    pairs = spark.range(1000).select(F.col("id").alias("customer_tweet_id"), text.alias("customer_text"),
                                     F.lit("r").alias("apple_reply_text"), F.lit(False).alias("is_dm_redirect"))
    template = curate.golden_template(pairs)
    assert template.columns == fv.GOLDEN_TEMPLATE_COLUMNS
    rows = template.collect()
    assert len({r.customer_tweet_id for r in rows}) == len(rows) == 200
    per_bucket = {b: sum(r._stratify_bucket == b for r in rows) for b in fv.INTENTS}
    assert min(per_bucket.values()) >= 33 and all(r.true_intent == "" for r in rows)
