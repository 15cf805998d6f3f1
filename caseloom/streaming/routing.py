"""Rule routing on a stream of incoming posts.

The rules look at one post at a time, so the batch columns run unchanged on a
streaming DataFrame: no state, no watermark, append output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.rules import RoutingRules, Rules, route_decision, simple_intent
from caseloom.operators.pairs import filter_brand_posts, filter_inbound


def route_incoming(posts: DataFrame, brand: str, rules: RoutingRules = RoutingRules(),
                   intents: Rules = fv.INTENT_RULES, default: str = fv.CATCH_ALL) -> DataFrame:
    """Inbound posts for the brand with keyword intent, routing and reason."""
    inbound = filter_inbound(filter_brand_posts(posts, brand))
    routed = inbound.withColumn("_d", route_decision(F.col("text"), None, rules))
    return routed.select("tweet_id", "author_id", "text",
                         simple_intent(F.col("text"), intents, default).alias("intent"),
                         F.col("_d.routing").alias("routing"), F.col("_d.reason").alias("reason"))
