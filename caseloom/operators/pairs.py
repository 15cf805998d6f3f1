"""Raw posts to customer/reply pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.text import flag_dm_redirect, mentions_brand, reply_dedup_key
from caseloom.operators.joins import join_lookup
from caseloom.operators.sampling import first_per_key


def filter_brand_posts(posts: DataFrame, brand: str) -> DataFrame:
    """Posts by the brand, or naming it anywhere in the text."""
    return posts.where((F.col("author_id") == brand) | mentions_brand(F.col("text"), brand))


def filter_inbound(posts: DataFrame) -> DataFrame:
    return posts.where("inbound").withColumn("tweet_id", F.col("tweet_id").try_cast("bigint"))


def filter_brand_replies(posts: DataFrame, brand: str) -> DataFrame:
    answered = F.col("in_response_to_tweet_id").try_cast("bigint")
    return posts.where(F.col("author_id") == brand).withColumn("in_response_to_tweet_id", answered)


def project_rename(joined: DataFrame) -> DataFrame:
    """Pair columns under the names of the pair table."""
    return joined.select(
        F.col("post.tweet_id").alias("customer_tweet_id"),
        F.col("post.text").alias("customer_text"),
        F.col("reply.tweet_id").alias("apple_tweet_id"),
        F.col("reply.text").alias("apple_reply_text"),
        F.col("post.author_id").alias("author_id"))


def pair_posts_with_replies(posts: DataFrame, replies: DataFrame,
                            first_only: bool = False) -> DataFrame:
    """Inner join post <- reply; one row per reply, or only the earliest reply.

    The author stays in the pair, so no second join is needed to attach it.
    A post with very many replies is a skewed key on the reply side only, which
    adaptive execution splits; with first_only the replies shrink to one per
    post before the shuffle.
    """
    if first_only:
        answered = replies.where(F.col("in_response_to_tweet_id").isNotNull())
        replies = first_per_key(answered, [F.col("in_response_to_tweet_id")], [F.col("tweet_id")])
    return project_rename(posts.alias("post").join(
        replies.alias("reply"), F.expr("post.tweet_id = reply.in_response_to_tweet_id")))


def add_dm_flag(pairs: DataFrame, patterns: Sequence[str] = fv.DM_REDIRECT_PATTERNS) -> DataFrame:
    return pairs.withColumn("is_dm_redirect", flag_dm_redirect(F.col("apple_reply_text"), patterns))


def author_volume(posts: DataFrame) -> DataFrame:
    """Inbound posts per author (stored under its historical name thread_depth)."""
    return posts.where("inbound").groupBy("author_id").agg(F.count("*").alias("thread_depth"))


def attach_author_volume(pairs: DataFrame, volume: DataFrame) -> DataFrame:
    return join_lookup(pairs, volume, "author_id")


def dedup_templated_replies(pairs: DataFrame, order_by: list[Column] | None = None,
                            strip_handles: bool = False) -> DataFrame:
    """One pair per reply wording, the earliest one.

    Rows are grouped by a digest: the shuffle and the sort carry 64 characters
    instead of a second copy of the reply.
    """
    order_by = order_by or [F.col("customer_tweet_id"), F.col("apple_tweet_id")]
    wording = F.sha2(reply_dedup_key(F.col("apple_reply_text"), strip_handles), 256)
    return first_per_key(pairs, [wording], order_by)


def exclude_golden(df: DataFrame, ids: DataFrame, key: str = "customer_tweet_id") -> DataFrame:
    """Leakage guard: drop the rows whose id is listed."""
    return df.join(ids.select(key), key, "left_anti")


def row_counts_before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows_before, rows_after, rows_removed."""
    counts = before.select(F.lit(1).alias("b"), F.lit(0).alias("a")).unionAll(
        after.select(F.lit(0).alias("b"), F.lit(1).alias("a")))
    n_before, n_after = F.coalesce(F.sum("b"), F.lit(0)), F.coalesce(F.sum("a"), F.lit(0))
    return counts.agg(n_before.alias("rows_before"), n_after.alias("rows_after"),
                      (n_before - n_after).alias("rows_removed"))
