from pyspark.sql import functions as F

from caseloom.operators import pairs as p
from caseloom.plans.prepare import prepare_pairs
from caseloom.sources.tables import RAW_POSTS

POSTS = [
    (1, "u1", True, "@acme my phone is dead", None),
    (2, "Acme", False, "@u1 Please DM us", 1),
    (3, "Acme", False, "@u1 Still there?", 1),
    (4, "u2", True, "hello @ACME", None),
    (5, "Acme", False, "@u1 PLEASE  dm us", 4),
    (6, "u2", True, "@acme again", None),
    (7, "u3", True, "nothing to do with it", None),
    (8, None, True, "@Acme anonymous", None),
    (9, "Acme", False, "@u4 See https://t.co/abc now", 8),
    (10, "u1", False, "@acme an outbound one", 2),
    (11, "Acme", False, "unprompted", None),
    (12, "Acme", False, "@u4 see https://t.co/xyz now", 6),
]


def posts(spark):
    return spark.createDataFrame(POSTS, RAW_POSTS)


def ids(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_brand_filter_is_a_substring_test(spark):
    assert ids(p.filter_brand_posts(posts(spark), "Acme"), "tweet_id") == [(i,) for i in (1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 12)]


def test_every_reply_is_paired_and_nulls_never_match(spark):
    inbound, replies = p.filter_inbound(posts(spark)), p.filter_brand_replies(posts(spark), "Acme")
    pairs = p.pair_posts_with_replies(inbound, replies)
    assert ids(pairs, "customer_tweet_id", "apple_tweet_id") == [(1, 2), (1, 3), (4, 5), (6, 12), (8, 9)]
    first = p.pair_posts_with_replies(inbound, replies, first_only=True)
    assert ids(first, "customer_tweet_id", "apple_tweet_id") == [(1, 2), (4, 5), (6, 12), (8, 9)]


def test_prepare(spark):
    got = {(r.customer_tweet_id, r.apple_tweet_id): r for r in prepare_pairs(posts(spark), "Acme").collect()}
    # 5 repeats the wording of 2, 9 that of 12 (links count as one)
    assert sorted(got) == [(1, 2), (1, 3), (6, 12)]
    assert got[1, 2].is_dm_redirect and not got[1, 3].is_dm_redirect
    assert got[1, 2].thread_depth == 1 and got[6, 12].thread_depth == 2


def test_volume_counts_null_author_but_does_not_join_it(spark):
    volume = p.author_volume(p.filter_brand_posts(posts(spark), "Acme"))
    assert ids(volume.where("author_id is not null"), "author_id", "thread_depth") == [("u1", 1), ("u2", 2)]
    pair = spark.createDataFrame([(8, None)], "customer_tweet_id long, author_id string")
    assert p.attach_author_volume(pair, volume).first().thread_depth is None


def test_handles_keep_templates_apart_unless_stripped(spark):
    df = spark.createDataFrame([(1, 1, "@1 DM us"), (2, 2, "@2 DM us")],
                               "customer_tweet_id long, apple_tweet_id long, apple_reply_text string")
    assert p.dedup_templated_replies(df).count() == 2
    assert ids(p.dedup_templated_replies(df, strip_handles=True), "customer_tweet_id") == [(1,)]


def test_one_wording_on_most_rows(spark):
    df = spark.range(20000).select(
        F.col("id").alias("customer_tweet_id"), F.col("id").alias("apple_tweet_id"),
        F.when(F.col("id") % 3 < 2, "the same reply").otherwise(F.concat(F.lit("reply "), "id")).alias("apple_reply_text"))
    expected = ids(p.dedup_templated_replies(df.repartition(7)), "customer_tweet_id")
    assert expected == ids(p.dedup_templated_replies(df.repartition(3)), "customer_tweet_id")
    assert len(expected) == 1 + 6666 and expected[0] == (0,)


def test_counts_and_leakage_guard(spark):
    df, ex = spark.range(10).withColumnRenamed("id", "customer_tweet_id"), spark.range(3, 30).withColumnRenamed("id", "customer_tweet_id")
    kept = p.exclude_golden(df, ex)
    assert ids(kept, "customer_tweet_id") == [(0,), (1,), (2,)]
    assert tuple(p.row_counts_before_after(df, kept).first()) == (10, 3, 7)
    assert tuple(p.row_counts_before_after(df.limit(0), kept.limit(0)).first()) == (0, 0, 0)
