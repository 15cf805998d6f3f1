import pytest
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions import rules as r

ROWS = [
    ("My phone caught fire", "out_of_scope_or_other", "safety_hazard"),
    ("it exploded in my hand", "out_of_scope_or_other", ""),
    ("there is an unauthorized charge", "battery_power_drain", "account_security_risk"),
    ("I want a refund now", "app_store_billing", "financial_refund_request"),
    ("I was overcharged", "battery_power_drain", ""),
    ("I was charged twice", "battery_power_drain", "financial_refund_request"),
    ("worst update ever", "ios_update_issues", "angry_customer_needs_human_tone"),
    ("WORST fire refund", "app_store_billing", "safety_hazard"),
    ("no need to DM, press the side button", "connectivity_hardware", ""),
    ("I don't want to dm you", "out_of_scope_or_other", ""),
    ("my account is locked out", "apple_id_account", "account_security_risk"),
    ("supercharge my phone", "battery_power_drain", ""),
    ("powerful", "out_of_scope_or_other", ""),
    ("installed it", "out_of_scope_or_other", ""),
    ("ios 11 is here", "ios_update_issues", ""),
    ("Apple ID password", "apple_id_account", ""),
]


@pytest.fixture(scope="module")
def decided(spark):
    df = spark.createDataFrame(ROWS, "text string, intent string, reason string")
    return df.select("*", r.bucket_intent(F.col("text")).alias("bucket"),
                     r.simple_intent(F.col("text")).alias("simple"),
                     r.route_decision(F.col("text")).alias("d")).collect()


def test_intent_rules(decided):
    assert [(x.text, x.bucket) for x in decided] == [(x.text, x.intent) for x in decided]
    assert [x.simple for x in decided] == [x.intent for x in decided]


def test_routing_rules(decided):
    assert [(x.text, x.d.reason) for x in decided] == [(x.text, x.reason) for x in decided]
    assert [x.d.routing for x in decided] == ["escalate" if x.reason else "auto_handle" for x in decided]


def test_null_text_is_catch_all(values):
    assert values(r.bucket_intent, "string", None) == [fv.CATCH_ALL]
    assert tuple(values(r.route_decision, "string", None)[0]) == ("auto_handle", "")


def test_stem_prefix(values):
    rules = r.RoutingRules(stem_prefix=True)
    got = values(lambda c: r.route_decision(c, None, rules)["reason"], "string", "it exploded", "I was overcharged", "hello")
    assert got == ["safety_hazard", "financial_refund_request", ""]


@pytest.mark.parametrize("text, flags, expected", [
    ("hello", [True, True, True], ("escalate", "requires_dm_troubleshooting")),
    ("hello", [True, True, False], ("auto_handle", "")),
    ("hello", [True], ("escalate", "requires_dm_troubleshooting")),
    ("hello", [], ("auto_handle", "")),
    ("no need to dm", [True, True, True], ("auto_handle", "")),
    ("refund", [False], ("escalate", "financial_refund_request")),
])
def test_precedent_votes(spark, text, flags, expected):
    kind = "text string, p array<struct<customer_text:string,is_dm_redirect:boolean>>"
    row = spark.createDataFrame([(text, [("x", f) for f in flags])], kind)
    assert tuple(row.select(r.route_decision(F.col("text"), F.col("p")).alias("d")).first().d) == expected


def test_baseline_routing_and_reply(values):
    assert values(r.simple_routing, "string", "I was hacked", "refund!", "unauthorized", "fire", None) == \
        ["escalate", "escalate", "auto_handle", "auto_handle", "auto_handle"]
    assert values(r.simple_reply_template, "string", *fv.INTENTS) == [fv.REPLY_TEMPLATES[i] for i in fv.INTENTS]
