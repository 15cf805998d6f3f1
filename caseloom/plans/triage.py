"""One run of the agent over a table of posts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.rules import RoutingRules, route_decision
from caseloom.functions.text import over_limit, precedent_summary
from caseloom.operators.retrieval import find_precedents, join_precedents
from caseloom.operators.sampling import fixed_size_sample
from caseloom.operators.scoring import Scorer, classify_intents, draft_replies
from caseloom.session import materialize
from caseloom.sources.retrieval_store import RetrievalIndex


def run_triage(posts: DataFrame, corpus: DataFrame | RetrievalIndex, classifier: Scorer, drafter: Scorer,
               cache: DataFrame | None = None, brand: str = "the brand",
               labels: Sequence[str] = fv.INTENTS, fallback: str = fv.CATCH_ALL,
               rules: RoutingRules = RoutingRules(), k: int = fv.TOP_K, approximate: bool = False,
               store: str | None = None, keep_precedents: bool = False, sample: int = 0) -> DataFrame:
    """classify -> retrieve -> route -> draft.

    posts and corpus carry customer_tweet_id and "embedding"; with an index as corpus
    the posts' texts are embedded by the index's own model.  Retrieval comes before routing because routing counts how the precedents were handled.  One row
    per row of posts, also where ids repeat.  sample runs that many posts
    (fixed_values.RUN_SAMPLE_SIZE is the usual number), 0 all of them.
    """
    posts = fixed_size_sample(posts, sample)
    classified = classify_intents(posts, classifier, labels, fallback, cache, brand=brand,
                                  store=store and f"{store}/classify")
    # The search feeds both the drafts and the result, and must not run twice.
    search = corpus.find_precedents if isinstance(corpus, RetrievalIndex) else partial(find_precedents, corpus=corpus)
    found = materialize(search(posts, k=k, approximate=approximate), "precedents")
    grounded = join_precedents(classified.drop("embedding"), found)
    decision = route_decision(F.col("customer_text"), F.col("precedents"), rules)
    routed = (grounded.withColumn("_d", decision)
              .withColumn("routing_decision", F.col("_d.routing"))
              .withColumn("escalation_reason_predicted", F.col("_d.reason")).drop("_d"))
    drafted = draft_replies(routed, drafter, cache, brand, rules.opt_out, store=store and f"{store}/draft")
    out = drafted.withColumn("retrieved_precedent", precedent_summary(F.col("precedents")))
    out = out.withColumn("over_280", over_limit(F.col("drafted_reply")))
    return out if keep_precedents else out.drop("precedents")
