import hashlib

import pytest
from pyspark.sql import functions as F

from caseloom.operators import sampling as s
from caseloom.plans.curate import golden_template
from caseloom.operators.ranks import global_row_number, running_total


def table(spark, rows=700, partitions=5):
    """Six buckets, one of which holds most rows."""
    bucket = F.when(F.col("id") % 10 < 5, 0).otherwise(F.col("id") % 10 - 4).cast("string")
    return spark.range(rows).select(F.col("id").alias("customer_tweet_id"), bucket.alias("bucket")).repartition(partitions)


def keys(df):
    return sorted(r[0] for r in df.select("customer_tweet_id").collect())


def order(i, seed=42):
    return hashlib.md5(f"{i}:{seed}".encode()).hexdigest()


def test_stratified_sample_is_even_and_independent_of_partitions(spark):
    df = table(spark)
    sample = s.stratified_sample(df, "bucket", 200)
    assert {r["bucket"]: r["count"] for r in s.value_counts(sample, "bucket").collect()} == {str(b): 33 for b in range(6)}
    assert keys(sample) == keys(s.stratified_sample(table(spark, partitions=1), "bucket", 200))
    zero = sorted((i for i in range(700) if i % 10 < 5), key=order)[:33]
    assert keys(sample.where("bucket = '0'")) == sorted(zero)


def test_more_buckets_than_rows_asked_for(spark):
    assert s.stratified_sample(table(spark), "bucket", 3).count() == 6


def test_topup_fills_to_target_without_repeats(spark):
    df = table(spark)
    full = s.topup_sample(df, s.stratified_sample(df, "bucket", 200), 200)
    assert full.count() == 200 and len(set(keys(full))) == 200
    assert set(keys(s.stratified_sample(df, "bucket", 200))) < set(keys(full))
    few = df.where("customer_tweet_id < 10")
    assert s.topup_sample(few, few.where("customer_tweet_id < 4"), 200).count() == 10


def test_fixed_size_and_shuffle(spark):
    df = table(spark, 50)
    assert keys(s.fixed_size_sample(df, 7)) == sorted(sorted(range(50), key=order)[:7])
    assert s.fixed_size_sample(df, 0).count() == 50
    assert [r[0] for r in s.shuffle_rows(df).select("customer_tweet_id").collect()] == sorted(range(50), key=order)
    assert keys(s.fixed_size_sample(df, 7, seed=1)) != keys(s.fixed_size_sample(df, 7))


@pytest.mark.parametrize("n, low, high", [(25, 8, 8), (1, 1, 1), (2, 1, 1)])
def test_spread_sample(spark, n, low, high):
    df = spark.range(100).select(F.col("id").alias("customer_tweet_id"),
                                 F.when(F.col("id") != 50, F.col("id") / 10).alias("score"))
    got = keys(s.spread_sample(df, "score", n))
    assert len(got) == len(set(got)) == low + high + n - 2 * (n // 3)
    lowest = [50, *range(low - 1)]
    assert set(lowest) | set(range(100 - high, 100)) <= set(got)


def test_spread_sample_of_a_tiny_table(spark):
    df = spark.range(4).select(F.col("id").alias("customer_tweet_id"), F.col("id").alias("score"))
    assert keys(s.spread_sample(df, "score", 25)) == [0, 1, 2, 3]


def test_head_and_top_n_with_a_hot_group(spark):
    df = table(spark, 5000, 16)
    got = s.top_n_per_group(df, [F.col("bucket")], [F.desc("customer_tweet_id")], 1500, fan_in=4)
    assert keys(got.where("bucket = '0'")) == sorted(sorted((i for i in range(5000) if i % 10 < 5), reverse=True)[:1500])
    assert got.where("bucket = '3'").count() == 500
    head = s.head_per_intent(df, "bucket", "customer_tweet_id", 2)
    assert keys(head.where("bucket = '0'")) == [0, 1]


def test_set_operations(spark):
    a, b = spark.range(5).toDF("customer_tweet_id"), spark.range(3, 8).toDF("customer_tweet_id")
    assert keys(s.union_samples(a, b)) == [0, 1, 2, 3, 3, 4, 4, 5, 6, 7]
    assert keys(s.unique_by_id(s.union_ids(a, b))) == list(range(8))
    assert keys(s.not_in_set(spark.range(10).toDF("customer_tweet_id"), a, b)) == [8, 9]
    assert keys(s.sample_remainder(a, b)) == [0, 1, 2]


def test_global_order(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000 - 500).alias("k"), (F.col("id") % 3).alias("amount"))
    numbered = global_row_number(df, "k", "pos").orderBy("k").collect()
    assert [r.pos for r in numbered] == list(range(1, 1001))
    totals = running_total(df, "k", "amount", "below").orderBy("k").collect()
    below = 0
    for r in totals:
        assert r.below == below
        below += r.amount


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_global_order_of_null_and_repeated_keys(spark, kind):
    rows = [(None, 1), (3, 2), (3, 2), (3, 4), (None, 5), (1, 6)] + [(7, i) for i in range(500)]
    df = spark.createDataFrame(rows, "k bigint, v int").withColumn("k", F.col("k").cast(kind))
    got = global_row_number(df, "k", "pos").orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1, 507))
    assert [r.k for r in got] == sorted((r.k for r in df.collect()), key=lambda k: (k is not None, k or 0))


def test_golden_template_with_several_replies_per_post(spark):
    pairs = spark.range(400).select((F.col("id") % 200).alias("customer_tweet_id"), F.concat(F.lit("text "), "id").alias("customer_text"),
                                    F.col("id").alias("apple_tweet_id"), F.lit("reply").alias("apple_reply_text"), F.lit(False).alias("is_dm_redirect"))
    assert golden_template(pairs, target=100).count() == 100


def test_spread_sample_is_unique_by_id(spark):
    df = spark.range(60).select((F.col("id") % 40).alias("customer_tweet_id"), F.col("id").cast("double").alias("score"))
    ids = [r.customer_tweet_id for r in s.spread_sample(df, "score", 25).collect()]
    assert len(ids) == len(set(ids))


def test_fixed_size_sample_is_the_start_of_the_order(spark):
    df = spark.range(300).select((F.col("id") % 100).alias("customer_tweet_id"), F.lit("long text").alias("text"))
    want = [r.customer_tweet_id for r in df.orderBy(*s.sample_order("customer_tweet_id")).limit(10).collect()]
    assert sorted(r.customer_tweet_id for r in s.fixed_size_sample(df, 10).collect()) == sorted(want)
