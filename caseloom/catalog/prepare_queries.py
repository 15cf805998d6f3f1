"""Sources, pairing, volumes, deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.catalog import inputs as t
from caseloom.catalog.registry import query
from caseloom.functions.rules import bucket_intent
from caseloom.operators import evaluate
from caseloom.operators import pairs as p
from caseloom.operators import sampling as s
from caseloom.operators.latent import fit_latent
from caseloom.plans.evaluation import review_sheet
from caseloom.plans.prepare import build_index, prepare_pairs
from caseloom.session import scratch_path
from caseloom.sources import retrieval_store as store
from caseloom.sources import tables

BRAND_POSTS = f"(author_id = '{t.BRAND}' OR regexp_matches(text, '(?i)@{t.BRAND}'))"
DEDUP_KEY = r"regexp_replace(regexp_replace(lower(apple_reply_text), '\s+', ' ', 'g'), 'https?://\S+', '<link>', 'g')"
PAIRED = f"""SELECT p.tweet_id AS customer_tweet_id, p.text AS customer_text, r.tweet_id AS apple_tweet_id,
 r.text AS apple_reply_text, p.author_id FROM posts p JOIN posts r ON p.tweet_id = r.in_response_to_tweet_id
 WHERE p.inbound AND r.author_id = '{t.BRAND}'"""


# ---- sources and sinks ----------------------------------------------------

@query("scan_raw_posts", "SELECT * FROM posts", ("posts",))
def scan_raw_posts(spark, sf):
    path = scratch_path(spark, "raw-posts")
    tables.write_table(t.posts(spark, sf), path, "csv")
    return tables.scan_raw_posts(spark, path)


# Every type of a table is found again from its CSV.
@query("scan_inferred", "SELECT event_id, user_id, event_type, value FROM events")
def scan_inferred(spark, sf):
    path = scratch_path(spark, "events-csv")
    tables.write_table(t.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), path, "csv")
    return tables.scan_inferred(spark, path)


@query("scan_csv_table", """SELECT customer_tweet_id, customer_text, apple_reply_text, is_dm_redirect,
 true_intent, true_routing, escalation_reason FROM golden""", ("golden",))
def scan_csv_table(spark, sf):
    path = scratch_path(spark, "golden-csv")
    tables.write_table(t.golden(spark, sf), path, "csv")
    return tables.scan_csv_table(spark, path, tables.GOLDEN_FINAL)


@query("scan_optional_table", "SELECT lang, count(*) AS kept FROM documents GROUP BY lang")
def scan_optional_table(spark, sf):
    missing = tables.scan_optional_table(spark, scratch_path(spark, "never-written"), tables.EXCLUDED_IDS)
    return p.exclude_golden(t.pairs(spark, sf), missing).groupBy("lang").agg(F.count("*").alias("kept"))


@query("write_table", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def write_table(spark, sf):
    path = scratch_path(spark, "documents")
    tables.write_table(t.table(spark, sf, "documents"), path)
    return spark.read.parquet(path)


def _index(spark, sf):
    path = scratch_path(spark, "index")
    pairs = t.pairs(spark, sf).withColumn("thread_depth", F.lit(1).cast("bigint"))
    build_index(pairs, t.golden_ids(spark, sf), fit_latent(pairs, "customer_text", 64, features=1024), path)
    return path


@query("build_retrieval_table", """SELECT customer_tweet_id, customer_text, is_dm_redirect,
 CAST(1 AS BIGINT) AS thread_depth, 64 AS dim FROM pairs
 WHERE customer_tweet_id NOT IN (SELECT doc_id FROM labels)""", ("pairs",))
def build_retrieval_table(spark, sf):
    return store.load_retrieval_table(spark, _index(spark, sf)).select(
        "customer_tweet_id", "customer_text", "is_dm_redirect", "thread_depth", F.size("embedding").alias("dim"))


@query("load_retrieval_table", """SELECT count(*) AS entries FROM documents
 WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def load_retrieval_table(spark, sf):
    return store.count_entries(store.load_retrieval_table(spark, _index(spark, sf)))


# Half of the pairs first, the others appended: the golden ids are half of the rows of neither.
@query("append_to_index", """SELECT customer_tweet_id, is_dm_redirect FROM pairs""", ("pairs",))
def append_to_index(spark, sf):
    path, pairs = scratch_path(spark, "index"), t.pairs(spark, sf).withColumn("thread_depth", F.lit(1).cast("bigint"))
    golden = t.golden_ids(spark, sf)
    build_index(pairs, golden, fit_latent(pairs, "customer_text", 32, features=512), path)
    store.open_index(spark, path).append(pairs.join(golden, "customer_tweet_id", "left_semi"))
    return store.load_retrieval_table(spark, path).select("customer_tweet_id", "is_dm_redirect")


# ---- filters and pairing --------------------------------------------------

def _brand_posts(spark, sf):
    return p.filter_brand_posts(t.posts(spark, sf), t.BRAND)


def _paired(spark, sf, first_only=False):
    posts = t.posts(spark, sf)
    return p.pair_posts_with_replies(p.filter_inbound(posts), p.filter_brand_replies(posts, t.BRAND), first_only)


@query("filter_brand_posts", f"SELECT * FROM posts WHERE {BRAND_POSTS}", ("posts",))
def filter_brand_posts(spark, sf):
    return _brand_posts(spark, sf)


@query("filter_inbound", "SELECT * FROM posts WHERE inbound", ("posts",))
def filter_inbound(spark, sf):
    return p.filter_inbound(t.posts(spark, sf))


@query("filter_brand_replies", f"SELECT * FROM posts WHERE author_id = '{t.BRAND}'", ("posts",))
def filter_brand_replies(spark, sf):
    return p.filter_brand_replies(t.posts(spark, sf), t.BRAND)


@query("project_rename", f"SELECT * EXCLUDE (author_id) FROM ({PAIRED})", ("posts",))
def project_rename(spark, sf):
    return _paired(spark, sf).drop("author_id")


@query("pair_posts_with_replies", f"SELECT customer_tweet_id, apple_tweet_id FROM ({PAIRED})", ("posts",))
def pair_posts_with_replies(spark, sf):
    return _paired(spark, sf).select("customer_tweet_id", "apple_tweet_id")


# Ten documents answer the first of their ten; later documents count as earlier replies.
@query("pair_first_reply_only", """SELECT doc_id // 10 * 10 AS customer_tweet_id, min(-doc_id) AS apple_tweet_id FROM documents
 GROUP BY doc_id // 10 * 10""")
def pair_first_reply_only(spark, sf):
    docs = t.table(spark, sf, "documents")
    answered = (F.floor(F.col("doc_id") / 10) * 10).alias("in_response_to_tweet_id")
    replies = docs.select((-F.col("doc_id")).alias("tweet_id"), "text", answered)
    posts = docs.select(F.col("doc_id").alias("tweet_id"), "text", F.col("source").alias("author_id"))
    return p.pair_posts_with_replies(posts, replies, first_only=True).select("customer_tweet_id", "apple_tweet_id")


@query("attach_author", f"SELECT customer_tweet_id, apple_tweet_id, author_id FROM ({PAIRED})", ("posts",))
def attach_author(spark, sf):
    return _paired(spark, sf).select("customer_tweet_id", "apple_tweet_id", "author_id")


@query("author_volume", "SELECT author_id, count(*) AS thread_depth FROM posts WHERE inbound GROUP BY author_id",
       ("posts",))
def author_volume(spark, sf):
    return p.author_volume(t.posts(spark, sf))


@query("attach_author_volume", f"""SELECT customer_tweet_id, apple_tweet_id, q.author_id, thread_depth FROM ({PAIRED}) q
 LEFT JOIN (SELECT author_id, count(*) AS thread_depth FROM posts WHERE inbound GROUP BY author_id) v
 ON q.author_id = v.author_id""", ("posts",))
def attach_author_volume(spark, sf):
    joined = p.attach_author_volume(_paired(spark, sf), p.author_volume(t.posts(spark, sf)))
    return joined.select("customer_tweet_id", "apple_tweet_id", "author_id", "thread_depth")


@query("dedup_templated_replies", f"""SELECT customer_tweet_id, apple_reply_text, author_id, lang FROM pairs
 QUALIFY row_number() OVER (PARTITION BY {DEDUP_KEY} ORDER BY customer_tweet_id) = 1""", ("pairs",))
def dedup_templated_replies(spark, sf):
    unique = p.dedup_templated_replies(t.pairs(spark, sf))
    return unique.select("customer_tweet_id", "apple_reply_text", "author_id", "lang")


@query("row_counts_before_after", f"""SELECT count(*) AS rows_before, count(DISTINCT {DEDUP_KEY}) AS rows_after,
 count(*) - count(DISTINCT {DEDUP_KEY}) AS rows_removed FROM pairs""", ("pairs",))
def row_counts_before_after(spark, sf):
    pairs = t.pairs(spark, sf)
    return p.row_counts_before_after(pairs, p.dedup_templated_replies(pairs))


@query("exclude_golden", "SELECT doc_id AS customer_tweet_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def exclude_golden(spark, sf):
    return p.exclude_golden(t.pairs(spark, sf), t.golden_ids(spark, sf)).select("customer_tweet_id", "lang")


@query("share_true", "SELECT avg(CASE WHEN is_dm_redirect THEN 1 ELSE 0 END) AS is_dm_redirect_share FROM pairs",
       ("pairs",))
def share_true(spark, sf):
    return evaluate.share_true(t.pairs(spark, sf), "is_dm_redirect")


# The whole job: filter, pair, repair, flag, deduplicate, count.
@query("prepare_pairs", f"""SELECT customer_tweet_id, customer_text, apple_tweet_id, apple_reply_text,
 false AS is_dm_redirect, thread_depth FROM (SELECT * FROM ({PAIRED})
  QUALIFY row_number() OVER (PARTITION BY {DEDUP_KEY} ORDER BY customer_tweet_id, apple_tweet_id) = 1) q
 JOIN (SELECT author_id, count(*) AS thread_depth FROM posts WHERE inbound GROUP BY author_id) v
 ON q.author_id = v.author_id""", ("posts",))
def prepared(spark, sf):
    return prepare_pairs(t.posts(spark, sf), t.BRAND)


# ---- samples and set operations -------------------------------------------

ORDER = "md5(customer_tweet_id || ':42'), customer_tweet_id"
STRATIFIED = f"""SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {ORDER})
 <= greatest(1, 201 // (SELECT count(DISTINCT lang) FROM pairs))"""
REST = f"SELECT * FROM pairs WHERE customer_tweet_id NOT IN (SELECT customer_tweet_id FROM ({STRATIFIED}))"


def _sample(spark, sf):
    return s.stratified_sample(t.pairs(spark, sf), "lang", 201)


@query("stratified_sample", f"SELECT customer_tweet_id, lang FROM ({STRATIFIED})", ("pairs",))
def stratified_sample(spark, sf):
    return _sample(spark, sf).select("customer_tweet_id", "lang")


@query("sample_remainder", f"SELECT customer_tweet_id, lang FROM ({REST})", ("pairs",))
def sample_remainder(spark, sf):
    return s.sample_remainder(t.pairs(spark, sf), _sample(spark, sf)).select("customer_tweet_id", "lang")


@query("topup_sample", f"""SELECT customer_tweet_id, lang FROM ({STRATIFIED}) UNION ALL
 SELECT customer_tweet_id, lang FROM (SELECT * FROM ({REST}) ORDER BY {ORDER}
 LIMIT (201 - (SELECT count(*) FROM ({STRATIFIED}))))""", ("pairs",))
def topup_sample(spark, sf):
    return s.topup_sample(t.pairs(spark, sf), _sample(spark, sf), 201).select("customer_tweet_id", "lang")


@query("fixed_size_sample", f"SELECT customer_tweet_id, lang FROM pairs ORDER BY {ORDER} LIMIT 30", ("pairs",))
def fixed_size_sample(spark, sf):
    return s.fixed_size_sample(t.pairs(spark, sf), 30).select("customer_tweet_id", "lang")


@query("shuffle_rows", f"SELECT customer_tweet_id, lang FROM pairs ORDER BY {ORDER}", ("pairs",))
def shuffle_rows(spark, sf):
    return s.shuffle_rows(t.pairs(spark, sf).select("customer_tweet_id", "lang"))


@query("head_per_intent", """SELECT customer_tweet_id, lang FROM pairs
 QUALIFY row_number() OVER (PARTITION BY lang ORDER BY customer_tweet_id) <= 2""", ("pairs",))
def head_per_intent(spark, sf):
    return s.head_per_intent(t.pairs(spark, sf), "lang", "customer_tweet_id", 2).select("customer_tweet_id", "lang")


@query("distinct_buckets", f"SELECT DISTINCT {t.sql_rule('lower(customer_text)')} AS bucket FROM pairs", ("pairs",))
def distinct_buckets(spark, sf):
    bucketed = t.pairs(spark, sf).withColumn("bucket", bucket_intent(F.col("customer_text"), t.LEXICON, t.DEFAULT))
    return s.distinct_buckets(bucketed, "bucket")


@query("value_counts", f"""SELECT bucket, count(*) AS count FROM
 (SELECT {t.sql_rule('lower(customer_text)')} AS bucket FROM pairs) GROUP BY bucket""", ("pairs",))
def value_counts(spark, sf):
    bucketed = t.pairs(spark, sf).withColumn("bucket", bucket_intent(F.col("customer_text"), t.LEXICON, t.DEFAULT))
    return s.value_counts(bucketed, "bucket")


MEAN = "(judge_relevance + judge_groundedness + judge_tone) / 3.0"
ENDS = f"""SELECT customer_tweet_id FROM (SELECT customer_tweet_id FROM judged
  ORDER BY {MEAN} ASC NULLS FIRST, customer_tweet_id LIMIT 8)
 UNION SELECT customer_tweet_id FROM (SELECT customer_tweet_id FROM judged
  ORDER BY {MEAN} DESC NULLS LAST, customer_tweet_id DESC LIMIT 8)"""


@query("spread_sample", f"""SELECT customer_tweet_id FROM ({ENDS}) UNION ALL SELECT customer_tweet_id FROM
 (SELECT customer_tweet_id FROM judged WHERE customer_tweet_id NOT IN ({ENDS}) ORDER BY {ORDER} LIMIT 9)""",
       ("golden", "judged"))
def spread_sample(spark, sf):
    return review_sheet(t.judged(spark, sf)).select("customer_tweet_id")


@query("union_samples", """SELECT doc_id AS customer_tweet_id, lang FROM documents UNION ALL
 SELECT d.doc_id, lang FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def union_samples(spark, sf):
    pairs = t.pairs(spark, sf).select("customer_tweet_id", "lang")
    return s.union_samples(pairs, pairs.join(t.golden_ids(spark, sf), "customer_tweet_id", "left_semi"))


@query("unique_by_id", "SELECT doc_id AS customer_tweet_id, lang FROM documents")
def unique_by_id(spark, sf):
    return s.unique_by_id(union_samples(spark, sf))


@query("union_ids", "SELECT doc_id AS customer_tweet_id FROM labels UNION ALL SELECT vec_id FROM embeddings")
def union_ids(spark, sf):
    vec = t.table(spark, sf, "embeddings").select(F.col("vec_id").alias("customer_tweet_id"))
    return s.union_ids(t.golden_ids(spark, sf), vec)


@query("not_in_set", """SELECT doc_id AS customer_tweet_id, lang FROM documents
 WHERE doc_id NOT IN (SELECT doc_id FROM labels UNION ALL SELECT vec_id FROM embeddings)""")
def not_in_set(spark, sf):
    vec = t.table(spark, sf, "embeddings").select(F.col("vec_id").alias("customer_tweet_id"))
    return s.not_in_set(t.pairs(spark, sf), t.golden_ids(spark, sf), vec).select("customer_tweet_id", "lang")
