import pandas as pd
import pytest
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.prompts import draft_system
from caseloom.operators import scoring as sc
from caseloom.plans.triage import run_triage
from caseloom.session import scratch_path
from caseloom.sources.response_store import ResponseStore


@pytest.fixture
def calls(spark):
    """Counts what reaches the scorer."""
    return spark.sparkContext.accumulator(0)


def echo(calls):
    def answer(batch):
        calls.add(len(batch))
        return batch["prompt"].map(lambda p: f"re: {p}" if p != "silent" else None)

    return sc.python_scorer(answer)


def requests(spark, *prompts):
    df = spark.createDataFrame(list(enumerate(prompts)), "id long, text string")
    return sc.make_requests(df, "sys", F.col("text"), "m")


def cache(spark, reqs, response, day=1):
    return reqs.select("key", F.lit(response).alias("response"), F.lit(f"2024-01-0{day}").cast("timestamp").alias("written_at"))


def answers(df):
    return {r.id: r.response for r in df.select("id", "response").collect()}


def test_one_call_per_distinct_miss(spark, calls):
    reqs = requests(spark, "a", "b", "a", "c", "silent")
    known = cache(spark, requests(spark, "b"), "cached")
    got = sc.score_requests(reqs, known, echo(calls), store=scratch_path(spark, "store"))
    assert answers(got) == {0: "re: a", 1: "cached", 2: "re: a", 3: "re: c", 4: None}
    assert calls.value == 3


def test_a_second_run_finds_its_answers_in_the_store(spark, calls):
    store, reqs = scratch_path(spark, "store"), requests(spark, "a", "b")
    first = answers(sc.score_requests(reqs, None, echo(calls), store=store))
    more = requests(spark, "a", "b", "c")
    assert answers(sc.score_requests(more, None, echo(calls), store=store)) == {**first, 2: "re: c"}
    assert calls.value == 3 and sc.cache_stats(sc.open_store(spark, store)).first().entries == 3


def test_invalid_answers_are_not_used_not_stored_and_asked_again(spark, calls):
    store = scratch_path(spark, "store")
    reqs = requests(spark, "good", "bad")
    valid = lambda r: r.contains("good") | (r == "ok")
    known = cache(spark, requests(spark, "good"), "stale")
    assert answers(sc.score_requests(reqs, known, echo(calls), valid, store)) == {0: "re: good", 1: None}
    stored = sc.open_store(spark, store)
    assert [r.response for r in stored.collect()] == ["re: good"]
    before = calls.value
    assert answers(sc.score_requests(reqs, stored, echo(calls), valid, store)) == {0: "re: good", 1: None}
    assert calls.value == before + 1  # only the failed one


def test_last_write_wins(spark):
    reqs = requests(spark, "a")
    twice = cache(spark, reqs, "old", 1).unionByName(cache(spark, reqs, "new", 2))
    assert answers(sc.cache_hit(reqs, twice)) == {0: "new"}
    newer = sc.cache_upsert(twice, cache(spark, reqs, "newest", 3))
    assert [r.response for r in newer.collect()] == ["newest"]
    kept = sc.cache_upsert(twice, cache(spark, reqs, "bad", 4), lambda r: r != "bad")
    assert [r.response for r in kept.collect()] == ["new"]
    stats = sc.cache_stats(twice).first()
    assert (stats.entries, stats.bytes) == (1, 64 + 3)
    assert tuple(sc.cache_stats(sc.empty_cache(reqs)).first()) == (0, 0)


def test_key_depends_on_every_part(spark):
    df = spark.createDataFrame([(1, "t")], "id long, text string")
    variants = [sc.make_requests(df, s, F.col("text"), m, e).first().key
                for s, m, e in [("s", "m", "low"), ("s2", "m", "low"), ("s", "m2", "low"), ("s", "m", "high")]]
    assert len(set(variants)) == 4


def test_batches_keep_id_order(spark):
    posts = spark.range(25).select((F.col("id") * 3).alias("customer_tweet_id"),
                                   F.concat(F.lit("t"), F.col("id")).alias("customer_text")).repartition(6)
    rows = sc.pack_batches(posts).orderBy("batch").collect()
    assert [len(r.ids) for r in rows] == [10, 10, 5]
    assert [i for r in rows for i in r.ids] == [3 * i for i in range(25)]
    assert rows[2].texts == ["t20", "t21", "t22", "t23", "t24"]


def classify(spark, answer, **options):
    posts = spark.createDataFrame([(i, f"post {i}", "extra") for i in range(1, 13)],
                                  "customer_tweet_id long, customer_text string, other string")
    out = sc.classify_intents(posts, sc.column_scorer(lambda s, p: F.lit(answer)), **options)
    assert out.columns == ["customer_tweet_id", "customer_text", "other", "predicted_intent"]
    return {r.customer_tweet_id: r.predicted_intent for r in out.collect()}


def test_classification_falls_back(spark):
    answer = ('[{"id": 1, "intent": "apple_id_account"}, {"id": 2, "intent": "no such"}, '
              '{"id": 3, "intent": "app_store_billing"}]')
    got = classify(spark, answer)
    assert (got[1], got[2], got[3], got[11]) == ("apple_id_account", fv.CATCH_ALL, fv.CATCH_ALL, "apple_id_account")
    got = classify(spark, answer, fallback="FAILED", on_bad_item="reject")
    assert set(got.values()) == {"FAILED"}
    assert set(classify(spark, None).values()) == {fv.CATCH_ALL}


def test_fewshot(spark):
    pairs = spark.createDataFrame([
        (1, "my battery just dies"), (2, "Battery drain"), (3, "battery life and wifi"), (4, "battery is dead"),
        (5, "battery drain again"), (6, "thanks"), (7, "x" * 200 + " wifi")], "customer_tweet_id long, customer_text string")
    matched = sc.fewshot_match(pairs)
    assert sorted((r.customer_tweet_id, r.intent) for r in matched.collect() if r.customer_tweet_id == 3) == [
        (3, "battery_power_drain"), (3, "connectivity_hardware")]
    assert matched.where("customer_tweet_id = 2").count() == 0  # matching minds the case
    text = sc.fewshot_examples(pairs, pairs.where("customer_tweet_id = 1")).first().examples
    assert text.split("\n\n") == [
        'Tweet: "battery life and wifi"\n-> intent: battery_power_drain',
        'Tweet: "battery is dead"\n-> intent: battery_power_drain',
        'Tweet: "battery life and wifi"\n-> intent: connectivity_hardware',
        f'Tweet: "{"x" * 150}"\n-> intent: connectivity_hardware',
        'Tweet: "thanks"\n-> intent: out_of_scope_or_other']
    assert sc.fewshot_examples(pairs, pairs).first().examples == ""


def test_draft_instructions(spark):
    kind = "t string, r string, p array<struct<customer_text:string,apple_reply_text:string>>"
    df = spark.createDataFrame([("no need to dm", "auto_handle", [("q", "a")]), ("hi", "escalate", [])], kind)
    texts = [r.s for r in df.select(draft_system("Acme", F.col("t"), F.lit("billing"), F.col("r"), F.col("p")).alias("s")).collect()]
    assert "does not want to be sent to DM" in texts[0] and "Message: q\nReply: a" in texts[0] and "billing" in texts[0]
    assert "right team will take over" in texts[1] and "sent to DM" not in texts[1]


def test_run(spark):
    posts = spark.createDataFrame([(1, "my phone caught fire", [1.0, 0.0]), (2, "hello", [0.2, 1.0]), (3, "hello", [1.0, 0.0])],
                                  "customer_tweet_id long, customer_text string, embedding array<float>")
    corpus = spark.createDataFrame(
        [(10, "old one", "Please DM us", True, [1.0, 0.1]), (11, "old two", "Try this.", False, [0.1, 1.0]),
         (12, "old three", "DM us", True, [0.9, 0.0])],
        "customer_tweet_id long, customer_text string, apple_reply_text string, is_dm_redirect boolean, embedding array<float>")
    classifier = sc.column_scorer(lambda s, p: F.lit('[{"id": 1, "intent": "battery_power_drain"}]'))
    drafter = sc.column_scorer(lambda s, p: F.when(p == "hello", "\u200bHere is how it works.").otherwise("cut o"))
    store = scratch_path(spark, "run")
    rows = {r.customer_tweet_id: r for r in run_triage(posts, corpus, classifier, drafter, k=2, store=store).collect()}
    assert (rows[1].routing_decision, rows[1].escalation_reason_predicted) == ("escalate", "safety_hazard")
    assert rows[1].drafted_reply == fv.FAILED_REPLY and rows[2].drafted_reply == "Here is how it works."
    assert (rows[3].routing_decision, rows[3].escalation_reason_predicted) == ("escalate", "requires_dm_troubleshooting")
    assert rows[2].routing_decision == "auto_handle" and rows[2].retrieved_precedent == "old two; old one"
    assert [rows[i].predicted_intent for i in (1, 2, 3)] == ["battery_power_drain", fv.CATCH_ALL, fv.CATCH_ALL]
    again = run_triage(posts, corpus, classifier, drafter, k=2)
    assert sorted(again.collect()) == sorted(rows.values())


def test_suggest_and_judge(spark):
    golden = spark.createDataFrame([(1, "q", None)], "customer_tweet_id long, customer_text string, apple_reply_text string")
    out = sc.suggest_labels(golden, sc.column_scorer(lambda s, p: F.lit("no json"))).first()
    assert (out.suggested_intent, out.model_confidence_note) == ("", fv.FAILED_NOTE)
    df = spark.createDataFrame([(1, "q", "p", "reply")],
                               "customer_tweet_id long, customer_text string, retrieved_precedent string, drafted_reply string")
    seen = sc.column_scorer(lambda s, p: F.when(
        p == "Customer message: q\n\nHistorical precedent: p\n\nDrafted reply: reply",
        '```json\n{"relevance": 5, "groundedness": 4, "tone": 3}\n```'))
    judged = sc.judge_replies(df, seen).first()
    assert (judged.judge_relevance, judged.judge_groundedness, judged.judge_tone) == (5, 4, 3)


def test_repeated_and_null_ids_keep_their_rows(spark):
    from caseloom.operators.scoring import classify_intents, column_scorer, pack_batches
    from pyspark.sql import functions as F
    posts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, None)], "customer_tweet_id long, customer_text string")
    assert sum(len(r.ids) for r in pack_batches(posts, size=2).collect()) == 5
    scorer = column_scorer(lambda system, prompt: F.lit("[]"))
    out = classify_intents(posts, scorer, ["x", "y"], "y", size=2).collect()
    assert sorted((r.customer_tweet_id or 0, r.customer_text or "") for r in out) == [(0, ""), (0, "d"), (1, "a"), (1, "b"), (2, "c")]


def test_requests_with_null_parts_stay_apart(spark):
    from caseloom.functions.text import request_key
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([("a", None), (None, "a"), ("a", ""), ("", "a"), (None, None)], "x string, y string")
    assert rows.select(request_key(F.col("x"), F.col("y")).alias("k")).distinct().count() == 5


def stubborn(tries):
    """Answers "ok" from a prompt's so many-th try on, before that "bad"; silent on "silent"."""
    def answer(batch):
        return pd.Series([None if p == "silent" else "ok" if a >= int(p[-1]) + tries else "bad" for p, a in zip(batch["prompt"], batch["attempt"])], dtype=object)

    return sc.python_scorer(answer)


@pytest.mark.parametrize("attempts, want", [(1, [None, None, None, None]), (2, ["ok", None, None, None]), (4, ["ok", "ok", "ok", None])])
def test_invalid_answers_go_back_to_the_scorer(spark, attempts, want):
    store = scratch_path(spark, "store")
    reqs = requests(spark, "p0", "p1", "p2", "silent")
    got = answers(sc.score_requests(reqs, None, stubborn(2), lambda r: r == "ok", store, attempts))
    assert [got[i] for i in range(4)] == want
    ledger = spark.read.parquet(f"{store}/ledger").join(reqs.select("key", "id"), "key").collect()
    tries = {}
    for r in ledger:
        tries.setdefault(r.id, []).append((r.attempt, r.valid))
    for i, w in enumerate(want):
        n = attempts if w is None else i + 2
        assert sorted(tries[i]) == [(a, w is not None and a == n) for a in range(1, n + 1)]


# ---- the stored log

def key_rows(spark, numbers, response="r", day=1):
    return spark.createDataFrame([(i,) for i in numbers], "i long").select(
        F.sha2(F.col("i").cast("string"), 256).alias("key"), F.concat(F.lit(response), "i").alias("response"),
        F.lit(f"2024-01-0{day}").cast("timestamp").alias("written_at"))


def test_store_lookups_appends_and_compaction(spark):
    store = ResponseStore.open(spark, scratch_path(spark, "log"))
    assert store.rows().count() == 0 and store.lookup(key_rows(spark, range(3))).count() == 0 and store.compact() is store
    store = store.append(key_rows(spark, range(500))).append(key_rows(spark, range(100, 200), "new", 2))
    assert store.append(key_rows(spark, [])) is store
    asked = key_rows(spark, [5, 150, 9_999, 150]).unionByName(spark.createDataFrame([(None, None, None)], "key string, response string, written_at timestamp"))
    assert sorted(r.response for r in store.lookup(asked).collect()) == ["new150", "r5"]
    again = ResponseStore.open(spark, store.path)
    assert again.segments == store.segments or sorted(again.segments) == sorted(store.segments)
    small = again.compact()
    assert len(small.segments) == 1 and small.rows().count() == 500 and again.rows().count() == 600
    assert sorted(r.response for r in small.lookup(asked).collect()) == ["new150", "r5"]
    assert ResponseStore.open(spark, store.path).rows().count() == 500


def test_a_lookup_reads_the_asked_buckets_only(spark):
    store = ResponseStore.open(spark, scratch_path(spark, "log")).append(key_rows(spark, range(2_000)))
    maybe = store.maybe_known(key_rows(spark, [1, 2, 50_000, 50_001, 50_002]))
    assert 2 <= maybe.count() <= 3  # the filters rule the absent ones out, nearly always
    plan = store._latest(maybe)._jdf.queryExecution().executedPlan().toString()
    assert "In(key, " in plan and "PartitionFilters: [" in plan and "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    files = store._read([3]).select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all("/bucket=3/" in r.f for r in files)


def test_filters_never_deny_a_key(spark):
    store = ResponseStore.open(spark, scratch_path(spark, "log"))
    for part in range(3):
        store = store.append(key_rows(spark, range(part * 700, part * 700 + 700 * (part + 1))))
    assert store.maybe_known(key_rows(spark, range(0, 3_500, 7))).count() == 500


def test_keys_that_are_no_digests(spark):
    rows = spark.createDataFrame([("zz top", "a", None), ("", "b", None), ("é", "c", None)], "key string, response string, written_at timestamp")
    store = ResponseStore.open(spark, scratch_path(spark, "log")).append(rows)
    assert sorted(r.response for r in store.lookup(rows).collect()) == ["a", "b", "c"]
