"""One key on a third of all rows: right results, and the hot partition is split."""

import pytest
from pyspark.sql import functions as F

from caseloom.operators import pairs as p
from caseloom.operators import scoring as sc
from caseloom.operators.retrieval import attach_precedents
from caseloom.session import scratch_path

SMALL = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
         "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16"}
ROWS = 60_000


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which a few megabytes behave like a large table."""
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hot(c):
    """Column: 0 on a third of the rows, else the value itself."""
    return F.when(c % 3 == 0, 0).otherwise(c)


def split(df):
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_one_post_with_a_third_of_all_replies(spark, small_partitions):
    posts = spark.range(ROWS).select(F.col("id").alias("tweet_id"), F.lit("post").alias("text"), F.lit("a").alias("author_id"))
    replies = spark.range(ROWS).repartition(8).select(
        (F.col("id") + ROWS).alias("tweet_id"), F.md5(F.col("id").cast("string")).alias("text"),
        hot(F.col("id")).alias("in_response_to_tweet_id"))
    pairs = p.pair_posts_with_replies(posts, replies)
    assert split(pairs)
    assert pairs.count() == ROWS and pairs.where("customer_tweet_id = 0").count() == ROWS // 3
    first = p.pair_posts_with_replies(posts, replies, first_only=True)
    assert first.where("customer_tweet_id = 0").first().apple_tweet_id == ROWS
    assert first.count() == ROWS - ROWS // 3 + 1


@pytest.mark.parametrize("author", [0, None])
def test_one_author_with_a_third_of_all_pairs(spark, small_partitions, author):
    name = F.when(F.col("id") % 3 == 0, F.lit(author).cast("string")).otherwise(F.col("id").cast("string"))
    posts = spark.range(ROWS).repartition(8).select(
        F.col("id").alias("customer_tweet_id"), F.lit(True).alias("inbound"),
        F.md5(F.col("id").cast("string")).alias("text"), name.alias("author_id"))
    joined = p.attach_author_volume(posts, p.author_volume(posts))
    assert split(joined)
    hot_rows = joined.where("customer_tweet_id % 3 = 0").agg(F.count("*").alias("n"), F.max("thread_depth").alias("d")).first()
    assert (hot_rows.n, hot_rows.d) == (ROWS // 3, ROWS // 3 if author == 0 else None)
    assert joined.count() == ROWS


def test_one_prompt_in_a_third_of_all_requests(spark, small_partitions):
    calls = spark.sparkContext.accumulator(0)

    def answer(batch):
        calls.add(len(batch))
        return "re: " + batch["prompt"]

    text = F.concat(F.lit("prompt "), hot(F.col("id")))
    posts = spark.range(ROWS).repartition(8).select("id", text.alias("text"), F.md5(F.col("id").cast("string")).alias("payload"))
    requests = sc.make_requests(posts, "s", F.col("text"))
    scored = sc.score_requests(requests, None, sc.python_scorer(answer), store=scratch_path(spark, "answers"))
    assert calls.value == ROWS - ROWS // 3 + 1
    assert split(scored)
    assert scored.where(F.col("response") == F.concat(F.lit("re: "), "text")).count() == ROWS


def test_one_precedent_near_a_third_of_all_posts(spark, small_partitions):
    found = spark.range(ROWS).repartition(8).select(
        F.col("id").alias("query_id"), hot(F.col("id")).alias("corpus_id"), F.lit(0.5).alias("distance"),
        F.lit(1).alias("rank"))
    corpus = spark.range(ROWS).select(
        F.col("id").alias("customer_tweet_id"), F.lit("q").alias("customer_text"), F.lit("a").alias("apple_reply_text"),
        F.lit(True).alias("is_dm_redirect"))
    attached = attach_precedents(found, corpus)
    assert split(attached)
    assert attached.where("precedents[0].id = 0").count() == ROWS // 3 and attached.count() == ROWS
