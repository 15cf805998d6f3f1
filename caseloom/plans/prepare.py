"""Raw posts to the pair table and the retrieval table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from caseloom import fixed_values as fv
from caseloom.functions.text import clean_text
from caseloom.operators import pairs as p
from caseloom.operators.latent import TextModel
from caseloom.sources.retrieval_store import Embedder, RetrievalIndex, build_retrieval_table


def prepare_pairs(posts: DataFrame, brand: str, first_only: bool = False,
                  strip_handles: bool = False,
                  dm_patterns: Sequence[str] = fv.DM_REDIRECT_PATTERNS) -> DataFrame:
    """Filter, pair, repair, deduplicate, flag and count; one lazy plan.

    Only the reply decides what is a duplicate, so the customer text, the flag
    and the volume follow after the duplicates are gone.
    """
    brand_posts = p.filter_brand_posts(posts, brand)
    inbound = p.filter_inbound(brand_posts)
    pairs = p.pair_posts_with_replies(inbound, p.filter_brand_replies(brand_posts, brand), first_only)
    unique = p.dedup_templated_replies(clean_text(pairs, "apple_reply_text"), strip_handles=strip_handles)
    flagged = p.add_dm_flag(clean_text(unique, "customer_text"), dm_patterns)
    counted = p.attach_author_volume(flagged, p.author_volume(brand_posts))
    return counted.select("customer_tweet_id", "customer_text", "apple_tweet_id", "apple_reply_text",
                          "is_dm_redirect", "thread_depth")


def build_index(pairs: DataFrame, excluded: DataFrame, embedder: Embedder | TextModel, path: str, **options) -> RetrievalIndex:
    """Retrieval index of all pairs that are not in the golden set."""
    return build_retrieval_table(pairs, embedder, path, excluded, **options)
