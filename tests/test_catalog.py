"""Every registered query against its SQL, and plan shape."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, duck, sql) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["customer_tweet_id", "customer_text", "apple_tweet_id", "apple_reply_text",
                          "is_dm_redirect", "thread_depth"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["prepare_pairs", "apply_overrides", "classification_report", "trivial_predict",
                                  "route_decision", "stratified_sample", "retrieve_precedent", "score_requests"])
def test_no_cross_join(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", ["dedup_templated_replies", "stratified_sample", "head_per_intent", "retrieve_precedent"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_author_count_reads_two_short_columns(spark):
    plan = queries()["author_volume"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<conv_id:bigint,role:string>" in plan and "PushedFilters: [IsNotNull(role), EqualTo(role,user)]" in plan
