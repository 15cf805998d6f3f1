"""The job's input tables, derived from the given ones.

Posts and replies come from conversations, labelled pairs from documents and
labels, vectors from embeddings.  The given texts are invented prose in which
no customer-service phrase occurs, so the queries use rule sets made of words
that do occur; the fixed rule sets are tested on inline rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.rules import RoutingRules, first_rule, matches_any

BRAND = "AcmeCare"

LABELS = ["abusive", "markup", "table", "plain"]
DEFAULT = "plain"
LEXICON = [("abusive", r"idiot|worthless|trash"), ("markup", r"[#*%]{3}"), ("table", r"\|")]
MOVED = [r"ing the ", r"license"]
ROUTES = RoutingRules(
    escalations=[("abuse_report", r"\b(idiot|scum)\b"), ("legal_matter", r"license"),
                 ("leaked_secret", r"token = "), ("shouting", r"worthless")],
    opt_out=r"trash|@mail", precedent_reason="handled_elsewhere")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sql_rule(c: str, flags: str = "") -> str:
    """The lexicon as the CASE the other engine runs."""
    arms = " ".join(f"WHEN regexp_matches({c}, '{flags}{p}') THEN '{n}'" for n, p in LEXICON)
    return f"CASE {arms} ELSE '{DEFAULT}' END"


SQL_MOVED = "regexp_matches(text, '(?i)ing the |license')"
SQL_ROUTE = """CASE WHEN regexp_matches(customer_text, '(?i)\\b(idiot|scum)\\b') THEN 'abuse_report'
 WHEN regexp_matches(customer_text, '(?i)license') THEN 'legal_matter'
 WHEN regexp_matches(customer_text, '(?i)token = ') THEN 'leaked_secret'
 WHEN regexp_matches(customer_text, '(?i)worthless') THEN 'shouting'
 WHEN regexp_matches(customer_text, '(?i)trash|@mail') THEN '' END"""

SQL_INPUTS = {
    "posts": f"""SELECT conv_id * 1000 + turn AS tweet_id,
 CASE role WHEN 'assistant' THEN '{BRAND}' WHEN 'user' THEN 'u' || conv_id ELSE role END AS author_id,
 role = 'user' AS inbound,
 CASE WHEN role = 'user' THEN '@acmecare ' || text ELSE text END AS text,
 CASE WHEN role = 'assistant' THEN conv_id * 1000 + turn - 1 END AS in_response_to_tweet_id
 FROM conversations""",
    "pairs": f"""SELECT doc_id AS customer_tweet_id, text AS customer_text, doc_id AS apple_tweet_id,
 text AS apple_reply_text, source AS author_id, lang, {SQL_MOVED} AS is_dm_redirect FROM documents""",
    "golden": f"""SELECT d.doc_id AS customer_tweet_id, text AS customer_text, text AS apple_reply_text,
 {SQL_MOVED} AS is_dm_redirect, n_chars,
 CASE WHEN toxic = 1 THEN 'abusive' WHEN quality = 0 THEN 'markup' ELSE 'plain' END AS true_intent,
 CASE WHEN toxic = 1 THEN 'escalate' ELSE 'auto_handle' END AS true_routing,
 CASE WHEN toxic = 1 THEN 'abuse_report' ELSE '' END AS escalation_reason
 FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "audit": f"""SELECT g.*, {sql_rule('customer_text')} AS suggested_intent,
 CASE WHEN regexp_matches(customer_text, 'worthless') THEN 'escalate' ELSE 'auto_handle' END AS suggested_routing,
 '' AS suggested_reason,
 CASE true_intent WHEN 'abusive' THEN 'Neither fits fully' WHEN 'markup' THEN 'Unclear source' END AS model_confidence_note
 FROM golden g""",
    "judged": """SELECT customer_tweet_id, customer_text, apple_reply_text AS drafted_reply,
 CASE WHEN true_intent = 'abusive' THEN NULL ELSE 1 + n_chars % 5 END AS judge_relevance,
 CASE WHEN true_intent = 'abusive' THEN NULL ELSE 1 + (n_chars // 7) % 5 END AS judge_groundedness,
 CASE WHEN true_intent = 'abusive' THEN NULL ELSE 1 + (n_chars // 100) % 5 END AS judge_tone FROM golden""",
    "human": """SELECT customer_tweet_id, 1 + (n_chars + CASE true_intent WHEN 'markup' THEN 1 ELSE 0 END) % 5 AS human_relevance,
 1 + (n_chars // 9) % 5 AS human_groundedness, 1 + (n_chars // 90) % 5 AS human_tone FROM golden""",
    "vectors": f"""SELECT vec_id AS customer_tweet_id, text AS customer_text, text AS apple_reply_text,
 {SQL_MOVED} AS is_dm_redirect, embedding::DOUBLE[] AS v FROM embeddings JOIN documents ON vec_id = doc_id""",
    "asked": "SELECT * FROM vectors WHERE customer_tweet_id IN (SELECT doc_id FROM labels)",
    "corpus": "SELECT * FROM vectors WHERE customer_tweet_id NOT IN (SELECT doc_id FROM labels)",
    "distances": """SELECT a.customer_tweet_id AS query_id, c.customer_tweet_id AS corpus_id,
 list_sum(list_transform(list_zip(a.v, c.v), lambda z: pow(z[1] - z[2], 2))) AS distance
 FROM asked a CROSS JOIN corpus c""",
    "found": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, corpus_id) AS rank
 FROM distances) WHERE rank <= 3""",
    "requests": """SELECT doc_id, text AS prompt, sha256('m1|low|rubric|' || text) AS key FROM documents""",
    "stored": """SELECT DISTINCT sha256('m1|low|rubric|' || text) AS key, 'stored ' || md5(text) AS response
 FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
}


def posts(spark: SparkSession, sf: str) -> DataFrame:
    role, tweet = F.col("role"), F.col("conv_id") * 1000 + F.col("turn")
    author = F.when(role == "assistant", BRAND).when(
        role == "user", F.concat(F.lit("u"), F.col("conv_id"))).otherwise(role)
    return table(spark, sf, "conversations").select(
        tweet.alias("tweet_id"), author.alias("author_id"), (role == "user").alias("inbound"),
        F.when(role == "user", F.concat(F.lit("@acmecare "), F.col("text"))).otherwise(F.col("text")).alias("text"),
        F.when(role == "assistant", tweet - 1).alias("in_response_to_tweet_id"))


def _moved() -> Column:
    return matches_any(F.col("text"), MOVED)


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("customer_tweet_id"), F.col("text").alias("customer_text"),
        F.col("doc_id").alias("apple_tweet_id"), F.col("text").alias("apple_reply_text"),
        F.col("source").alias("author_id"), "lang", _moved().alias("is_dm_redirect"))


def golden(spark: SparkSession, sf: str) -> DataFrame:
    toxic, poor = F.col("toxic") == 1, F.col("quality") == 0
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        F.col("doc_id").alias("customer_tweet_id"), F.col("text").alias("customer_text"),
        F.col("text").alias("apple_reply_text"), _moved().alias("is_dm_redirect"), "n_chars",
        F.when(toxic, "abusive").when(poor, "markup").otherwise("plain").alias("true_intent"),
        F.when(toxic, "escalate").otherwise("auto_handle").alias("true_routing"),
        F.when(toxic, "abuse_report").otherwise("").alias("escalation_reason"))


def golden_ids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select(F.col("doc_id").alias("customer_tweet_id"))


def audit(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("customer_text")
    return golden(spark, sf).select(
        "*", first_rule(text, LEXICON, DEFAULT, ignore_case=False).alias("suggested_intent"),
        F.when(matches_any(text, ["worthless"], False), "escalate").otherwise("auto_handle").alias("suggested_routing"),
        F.lit("").alias("suggested_reason"),
        F.when(F.col("true_intent") == "abusive", "Neither fits fully")
        .when(F.col("true_intent") == "markup", "Unclear source").alias("model_confidence_note"))


def judged(spark: SparkSession, sf: str) -> DataFrame:
    n, scored = F.col("n_chars"), F.col("true_intent") != "abusive"
    return golden(spark, sf).select(
        "customer_tweet_id", "customer_text", F.col("apple_reply_text").alias("drafted_reply"),
        F.when(scored, 1 + n % 5).alias("judge_relevance"),
        F.when(scored, 1 + F.floor(n / 7) % 5).alias("judge_groundedness"),
        F.when(scored, 1 + F.floor(n / 100) % 5).alias("judge_tone"))


def human(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_chars")
    return golden(spark, sf).select(
        "customer_tweet_id",
        (1 + (n + F.when(F.col("true_intent") == "markup", 1).otherwise(0)) % 5).alias("human_relevance"),
        (1 + F.floor(n / 9) % 5).alias("human_groundedness"), (1 + F.floor(n / 90) % 5).alias("human_tone"))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    vecs = table(spark, sf, "embeddings")
    return docs.join(vecs, docs.doc_id == vecs.vec_id).select(
        F.col("vec_id").alias("customer_tweet_id"), F.col("text").alias("customer_text"),
        F.col("text").alias("apple_reply_text"), _moved().alias("is_dm_redirect"), "embedding")


def asked(spark: SparkSession, sf: str) -> DataFrame:
    return vectors(spark, sf).join(golden_ids(spark, sf), "customer_tweet_id", "left_semi")


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return vectors(spark, sf).join(golden_ids(spark, sf), "customer_tweet_id", "left_anti")
