"""Batch model scoring: request table -> cache split -> scorer -> checked answers.

A scorer maps a DataFrame (key, system, prompt) to (key, response).  Whatever
it does - a model in mapInPandas, a service, a rule - it is called once per
distinct request that the cache cannot answer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.parsing import parse_judge_score, parse_label_array, parse_suggestion
from caseloom.functions.prompts import (classify_system, draft_system, judge_message, judge_system,
                                        precedent_blocks, suggest_message, suggest_system)
from caseloom.functions.text import (fallback_text, format_examples, numbered_prompt, reply_is_malformed,
                                     request_key, search, strip_code_fence, strip_invisible, truncate_text)
from caseloom.operators.joins import join_lookup
from caseloom.operators.pairs import exclude_golden
from caseloom.operators.ranks import global_row_number
from caseloom.operators.sampling import head_per_intent
from caseloom.session import materialize
from caseloom.sources.response_store import ResponseStore, newest, without
from caseloom.sources.tables import RESPONSE_CACHE

Scorer = Callable[[DataFrame], DataFrame]
Validator = Callable[[Column], Column]


# ---- scorers --------------------------------------------------------------

def python_scorer(answer: Callable[[pd.DataFrame], pd.Series]) -> Scorer:
    """A scorer from a function over Arrow batches with columns system, prompt, attempt."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "response": answer(batch)})

    return lambda requests: requests.mapInPandas(run, "key string, response string")


def column_scorer(answer: Callable[[Column, Column], Column]) -> Scorer:
    """A scorer from a Column expression of (system, prompt)."""
    return lambda requests: requests.select(
        "key", answer(F.col("system"), F.col("prompt")).alias("response"))


# ---- response cache -------------------------------------------------------

def empty_cache(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], RESPONSE_CACHE)


def cache_upsert(cache: DataFrame, new: DataFrame, validator: Validator | None = None) -> DataFrame:
    """Cache with the new answers; only valid ones enter, the last write wins."""
    accepted = new.where(F.col("response").isNotNull())
    if validator is not None:
        accepted = accepted.where(validator(F.col("response")))
    return newest(cache.unionByName(accepted.select("key", "response", "written_at")))


def cache_hit(requests: DataFrame, cache: DataFrame, validator: Validator | None = None) -> DataFrame:
    """Requests with the cached response, where there is a (valid) one."""
    return join_lookup(requests, _usable(cache, validator), "key", "inner")


def cache_miss(requests: DataFrame, cache: DataFrame, validator: Validator | None = None) -> DataFrame:
    """One row per distinct request the cache cannot answer.

    Repeats go first, inside each task: a prompt that makes up a third of all
    requests reaches the join as one row per task.
    """
    distinct = requests.dropDuplicates(["key"])
    return distinct.join(_usable(cache, validator).select("key"), "key", "left_anti")


def cache_stats(cache: DataFrame) -> DataFrame:
    """One row: stored responses and their size in bytes."""
    live = newest(cache)
    size = F.sum((F.octet_length("key") + F.octet_length("response")).cast("bigint"))
    return live.agg(F.count("*").alias("entries"), F.coalesce(size, F.lit(0)).alias("bytes"))


def _usable(cache: DataFrame, validator: Validator | None) -> DataFrame:
    live = newest(cache).select("key", "response")
    return live if validator is None else live.where(F.coalesce(validator(F.col("response")), F.lit(False)))


# ---- scoring --------------------------------------------------------------

def make_requests(df: DataFrame, system: Column | str, prompt: Column, model: str = "default",
                  effort: str = "low") -> DataFrame:
    """Adds system, prompt and the key that identifies the request."""
    system = F.lit(system) if isinstance(system, str) else system
    return (df.withColumns({"system": system, "prompt": prompt})
            .withColumn("key", request_key(F.lit(model), F.lit(effort), F.col("system"), F.col("prompt"))))


def open_store(spark: SparkSession, store: str) -> DataFrame:
    """The answers kept at a path by earlier runs; none where there is no store yet."""
    return ResponseStore.open(spark, store).rows()


def ask_until_valid(misses: DataFrame, scorer: Scorer, validator: Validator | None = None, attempts: int = 1) -> tuple[DataFrame, DataFrame]:
    """Valid answers (key, response), and the ledger (key, attempt, response, valid) of everything asked.

    misses: key, system, prompt.  A request without a valid answer goes back to the scorer,
    up to `attempts` times in all; the scorer sees the number of the try as "attempt".
    Every round is written before the next reads it, so no try is repeated.
    """
    valid = F.col("response").isNotNull()
    if validator is not None:
        valid = valid & F.coalesce(validator(F.col("response")), F.lit(False))
    open_, ledger = materialize(misses, "asked"), None
    for attempt in range(1, attempts + 1):
        said = scorer(open_.withColumn("attempt", F.lit(attempt))).select("key", F.lit(attempt).alias("attempt"), "response", valid.alias("valid"))
        # a scorer that is silent on a request has answered null
        told = materialize(open_.select("key").join(said, "key", "left").select(
            "key", F.lit(attempt).alias("attempt"), "response", F.coalesce("valid", F.lit(False)).alias("valid")), "answers")
        ledger = told if ledger is None else ledger.unionByName(told)
        if attempt < attempts:
            open_ = materialize(open_.join(told.where("valid").select("key"), "key", "left_anti"), "asked")
            if open_.isEmpty():
                break
    return ledger.where("valid").select("key", "response"), ledger


def score_requests(requests: DataFrame, cache: DataFrame | None, scorer: Scorer,
                   validator: Validator | None = None, store: str | None = None, attempts: int = 1) -> DataFrame:
    """requests plus "response"; null where no valid answer came back in `attempts` tries.

    With store, answers kept there count as cached, new ones are appended, and the
    ledger of tries is kept beside them: a lost executor or a second run repeats no call.
    """
    spark = requests.sparkSession
    distinct = requests.select("key", "system", "prompt").dropDuplicates(["key"])
    known = None if cache is None else _usable(cache, validator)
    kept = None if store is None else ResponseStore.open(spark, store)
    if kept is not None:
        distinct = materialize(distinct, "requests")
        stored = kept.lookup(distinct)
        if validator is not None:
            stored = stored.where(F.coalesce(validator(F.col("response")), F.lit(False)))
        known = stored if known is None else known.unionByName(without(stored, known))
    if known is None:
        misses = distinct
    else:
        known = materialize(known, "known")
        misses = distinct.join(known.select("key"), "key", "left_anti")
    answers, ledger = ask_until_valid(misses, scorer, validator, attempts)
    if kept is not None:
        kept.append(answers.withColumn("written_at", F.current_timestamp()))
        ledger.write.mode("append").parquet(f"{store}/ledger")
    return join_lookup(requests, answers if known is None else known.unionByName(answers), "key")


def pack_batches(df: DataFrame, key: str = "customer_tweet_id", text: str = "customer_text",
                 size: int = fv.BATCH_SIZE) -> DataFrame:
    """batch, ids, texts: groups of size consecutive rows in id order; ids may be null or repeat."""
    return _packed(global_row_number(df.select(key, text), key, "_pos"), key, text, size)


def _packed(numbered: DataFrame, key: str, text: str, size: int) -> DataFrame:
    batch = F.floor((F.col("_pos") - 1) / size).cast("bigint").alias("batch")
    rows = F.array_sort(F.collect_list(F.struct("_pos", key, text))).alias("rows")
    packed = numbered.groupBy(batch).agg(rows)
    return packed.select("batch", F.col(f"rows.{key}").alias("ids"), F.col(f"rows.{text}").alias("texts"))


def classify_intents(posts: DataFrame, scorer: Scorer, labels: Sequence[str] = fv.INTENTS,
                     fallback: str = fv.CATCH_ALL, cache: DataFrame | None = None,
                     system: str | None = None, brand: str = "the brand", on_bad_item: str = "stop",
                     key: str = "customer_tweet_id", text: str = "customer_text",
                     size: int = fv.BATCH_SIZE, model: str = "default", store: str | None = None, attempts: int = 1) -> DataFrame:
    """posts plus "predicted_intent", one request per packed batch.

    With more than one attempt, an answer that is no JSON array is asked for again.
    The agent uses the catch-all as fallback; the stand-alone classifier uses
    fallback="FAILED" with on_bad_item="reject".
    """
    # The position stands for the row: ids may repeat.
    numbered = materialize(global_row_number(posts, key, "_pos"), "numbered")
    batches = _packed(numbered, key, text, size)
    requests = make_requests(batches, system or classify_system(brand, labels),
                             numbered_prompt(F.col("texts")), model)
    whole = None if attempts == 1 else lambda r: strip_code_fence(r).rlike(r"(?s)^\[.*\]$")
    scored = score_requests(requests, cache, scorer, whole, store, attempts)
    named = parse_label_array(F.col("response"), labels, F.size("ids"), fallback, on_bad_item)
    rows = scored.select("batch", F.posexplode(named).alias("_at", "predicted_intent"))
    predicted = rows.select((F.col("batch") * size + F.col("_at") + 1).alias("_pos"), "predicted_intent")
    return numbered.join(predicted, "_pos", "left").drop("_pos").withColumn(
        "predicted_intent", F.coalesce("predicted_intent", F.lit(fallback)))


def suggest_labels(golden: DataFrame, scorer: Scorer, intents: Sequence[str] = fv.INTENTS,
                   cache: DataFrame | None = None, system: str | None = None, brand: str = "the brand",
                   model: str = "default", store: str | None = None) -> DataFrame:
    """golden plus suggested_intent/routing/reason and the confidence note."""
    requests = make_requests(golden, system or suggest_system(brand, intents),
                             suggest_message(F.col("customer_text"), F.col("apple_reply_text")), model)
    scored = score_requests(requests, cache, scorer, store=store)
    return (scored.withColumn("_s", parse_suggestion(F.col("response"), intents))
            .select(*golden.columns, "_s.*"))


def fewshot_match(pairs: DataFrame, rules: Sequence[tuple[str, Sequence[str]]] = fv.FEWSHOT_RULES,
                  text: str = "customer_text") -> DataFrame:
    """A row per pair and intent it matches; matching minds the case."""
    hits = F.array(*[F.when(search(F.col(text), "|".join(patterns), False), F.lit(intent))
                     for intent, patterns in rules])
    return pairs.withColumn("intent", F.explode(F.array_compact(hits)))


def fewshot_examples(pairs: DataFrame, excluded: DataFrame,
                     rules: Sequence[tuple[str, Sequence[str]]] = fv.FEWSHOT_RULES,
                     n: int = fv.FEWSHOT_PER_INTENT, key: str = "customer_tweet_id") -> DataFrame:
    """One row, "examples": up to n clipped texts per intent, in rule order."""
    matched = fewshot_match(exclude_golden(pairs.select(key, "customer_text"), excluded, key), rules)
    picked = head_per_intent(matched, "intent", key, n)
    position = F.array_position(F.array(*[F.lit(name) for name, _ in rules]), F.col("intent"))
    block = F.concat(F.lit('Tweet: "'), truncate_text(F.col("customer_text"), fv.EXAMPLE_CLIP),
                     F.lit('"\n-> intent: '), F.col("intent"))
    # At most n rows per rule are left here.
    ordered = F.array_sort(F.collect_list(F.struct(position.alias("p"), key, block.alias("block"))))
    return picked.agg(format_examples(F.transform(ordered, lambda x: x["block"])).alias("examples"))


def draft_replies(df: DataFrame, scorer: Scorer, cache: DataFrame | None = None, brand: str = "the brand",
                  opt_out: str = fv.NO_DM_PATTERN, model: str = "default", store: str | None = None, attempts: int = 1) -> DataFrame:
    """df (customer_text, predicted_intent, routing_decision, precedents) plus "drafted_reply"."""
    system = draft_system(brand, F.col("customer_text"), F.col("predicted_intent"),
                          F.col("routing_decision"), F.col("precedents"), opt_out)
    requests = make_requests(df, system, F.col("customer_text"), model)
    scored = score_requests(requests, cache, scorer, lambda r: ~reply_is_malformed(r), store, attempts)
    reply = F.when(F.col("response").isNull(), fallback_text(F.col("response"))).otherwise(
        strip_invisible(F.col("response")))
    return scored.withColumn("drafted_reply", reply).select(*df.columns, "drafted_reply")


def judge_replies(df: DataFrame, scorer: Scorer, cache: DataFrame | None = None,
                  precedent: Column | None = None, system: str | None = None,
                  model: str = "default", store: str | None = None, attempts: int = 1) -> DataFrame:
    """df plus judge_relevance, judge_groundedness, judge_tone (all null on failure).

    The rubric is part of the request, so a changed rubric asks again.  By
    default the judge sees what the draft was grounded in: the precedent array
    if there is one, else the clipped summary.
    """
    if precedent is None:
        precedent = (precedent_blocks(F.col("precedents")) if "precedents" in df.columns
                     else F.col("retrieved_precedent"))
    requests = make_requests(df, system or judge_system(), judge_message(
        F.col("customer_text"), precedent, F.col("drafted_reply")), model)
    valid = lambda r: parse_judge_score(r)["judge_relevance"].isNotNull()
    scored = score_requests(requests, cache, scorer, valid, store, attempts)
    return (scored.withColumn("_j", parse_judge_score(F.col("response"))).select(*df.columns, "_j.*"))
