"""Text columns, rules and parsers."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.catalog import inputs as t
from caseloom.catalog.registry import query
from caseloom.functions import parsing, rules
from caseloom.functions import text as x

def text():
    return F.col("customer_text")

@query("repair_mojibake", "SELECT customer_tweet_id, md5(customer_text) AS repaired FROM pairs", ("pairs",))
def repair_mojibake(spark, sf):
    # Each text is damaged first (its bytes read as ISO-8859-1) and must come back whole.
    damaged = F.decode(F.encode(text(), "UTF-8"), "ISO-8859-1")
    return t.pairs(spark, sf).select("customer_tweet_id", F.md5(x.repair_mojibake(damaged)).alias("repaired"))


# Damaged twice, by two code pages in turn.
@query("repair_two_layers", "SELECT customer_tweet_id, md5(customer_text) AS repaired FROM pairs", ("pairs",))
def repair_two_layers(spark, sf):
    damaged = text()
    for page in ("ISO-8859-1", "ISO-8859-1"):
        damaged = F.decode(F.encode(damaged, "UTF-8"), page)
    return t.pairs(spark, sf).select("customer_tweet_id", F.md5(x.repair_mojibake(damaged)).alias("repaired"))


@query("repair_keeps_sound_text", """SELECT doc_id AS customer_tweet_id, md5(text) AS repaired FROM documents""")
def repair_keeps_sound_text(spark, sf):
    return t.pairs(spark, sf).select("customer_tweet_id", F.md5(x.repair_mojibake(text())).alias("repaired"))


@query("flag_dm_redirect", "SELECT customer_tweet_id, is_dm_redirect FROM pairs", ("pairs",))
def flag_dm_redirect(spark, sf):
    flag = x.flag_dm_redirect(F.col("apple_reply_text"), t.MOVED)
    return t.pairs(spark, sf).select("customer_tweet_id", flag.alias("is_dm_redirect"))


@query("no_dm_preference", """SELECT customer_tweet_id, regexp_matches(customer_text, '(?i)trash|@mail') AS opted_out
 FROM pairs""", ("pairs",))
def no_dm_preference(spark, sf):
    return t.pairs(spark, sf).select("customer_tweet_id", x.no_dm_preference(text(), t.ROUTES.opt_out).alias("opted_out"))


KEY = r"regexp_replace(regexp_replace(lower({}), '\s+', ' ', 'g'), 'https?://\S+', '<link>', 'g')"


@query("reply_dedup_key", f"""SELECT doc_id AS id, md5({KEY.format('text')}) AS wording FROM documents
 UNION ALL SELECT page_id, md5({KEY.format("url || ' ' || html")}) FROM pages""")
def reply_dedup_key(spark, sf):
    pages = t.table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.concat_ws(" ", "url", "html").alias("text"))
    both = t.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text").unionByName(pages)
    return both.select("id", F.md5(x.reply_dedup_key(F.col("text"))).alias("wording"))


@query("bucket_intent", f"SELECT customer_tweet_id, {t.sql_rule('lower(customer_text)')} AS bucket FROM pairs", ("pairs",))
def bucket_intent(spark, sf):
    return t.pairs(spark, sf).select("customer_tweet_id",
                                     rules.bucket_intent(text(), t.LEXICON, t.DEFAULT).alias("bucket"))


@query("simple_intent", f"SELECT customer_tweet_id, {t.sql_rule('customer_text', '(?i)')} AS intent FROM pairs", ("pairs",))
def simple_intent(spark, sf):
    return t.pairs(spark, sf).select("customer_tweet_id",
                                     rules.simple_intent(text(), t.LEXICON, t.DEFAULT).alias("intent"))


@query("simple_reply_template", f"""SELECT customer_tweet_id, 'Canned reply: ' || {t.sql_rule('customer_text', '(?i)')} AS reply
 FROM pairs""", ("pairs",))
def simple_reply_template(spark, sf):
    label = rules.simple_intent(text(), t.LEXICON, t.DEFAULT)
    canned = {name: f"Canned reply: {name}" for name in t.LABELS}
    return t.pairs(spark, sf).select("customer_tweet_id", rules.simple_reply_template(label, canned).alias("reply"))


@query("simple_routing", """SELECT customer_tweet_id,
 CASE WHEN regexp_matches(customer_text, '(?i)idiot|license') THEN 'escalate' ELSE 'auto_handle' END AS routing FROM pairs""",
       ("pairs",))
def simple_routing(spark, sf):
    return t.pairs(spark, sf).select("customer_tweet_id",
                                     rules.simple_routing(text(), ["idiot", "license"]).alias("routing"))


def _groups(spark, sf):
    """source x language groups as precedent lists, split so that no list grows with the data."""
    part = F.floor(F.col("customer_tweet_id") / 100)
    return t.pairs(spark, sf).groupBy("author_id", "lang", part.alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("customer_tweet_id", "customer_text", "is_dm_redirect"))).alias("precedents"))


GROUPED = "(SELECT *, customer_tweet_id // 100 AS part FROM pairs)"


@query("dm_vote", f"""SELECT author_id, lang, part, bool_and(is_dm_redirect) AS all_moved FROM {GROUPED}
 GROUP BY author_id, lang, part""", ("pairs",))
def dm_vote(spark, sf):
    return _groups(spark, sf).select("author_id", "lang", "part", rules.dm_vote(F.col("precedents")).alias("all_moved"))


@query("precedent_summary", f"""SELECT author_id, lang, part,
 string_agg(substr(customer_text, 1, 60), '; ' ORDER BY customer_tweet_id) AS summary FROM {GROUPED}
 GROUP BY author_id, lang, part""", ("pairs",))
def precedent_summary(spark, sf):
    return _groups(spark, sf).select("author_id", "lang", "part",
                                     x.precedent_summary(F.col("precedents")).alias("summary"))


@query("format_examples", f"""SELECT author_id, lang, part,
 string_agg('Tweet: ' || customer_text, chr(10) || chr(10) ORDER BY customer_tweet_id) AS examples FROM {GROUPED}
 GROUP BY author_id, lang, part""", ("pairs",))
def format_examples(spark, sf):
    blocks = F.transform("precedents", lambda p: F.concat(F.lit("Tweet: "), p["customer_text"]))
    return _groups(spark, sf).select("author_id", "lang", "part", x.format_examples(blocks).alias("examples"))


@query("numbered_prompt", f"""SELECT author_id, lang, part, string_agg(pos || '. ' || customer_text, chr(10) ORDER BY pos) AS prompt
 FROM (SELECT *, row_number() OVER (PARTITION BY author_id, lang, part ORDER BY customer_tweet_id) AS pos FROM {GROUPED})
 GROUP BY author_id, lang, part""", ("pairs",))
def numbered_prompt(spark, sf):
    return _groups(spark, sf).select("author_id", "lang", "part",
                                     x.numbered_prompt(F.col("precedents.customer_text")).alias("prompt"))


@query("route_decision", f"""SELECT customer_tweet_id,
 CASE WHEN coalesce({t.SQL_ROUTE}, CASE WHEN all_moved THEN 'x' ELSE '' END) = '' THEN 'auto_handle' ELSE 'escalate' END AS routing,
 coalesce({t.SQL_ROUTE}, CASE WHEN all_moved THEN 'handled_elsewhere' ELSE '' END) AS reason
 FROM {GROUPED} p JOIN (SELECT author_id, lang, part, bool_and(is_dm_redirect) AS all_moved FROM {GROUPED}
 GROUP BY author_id, lang, part) v USING (author_id, lang, part)""", ("pairs",))
def route_decision(spark, sf):
    decision = rules.route_decision(F.col("post.customer_text"), F.col("precedents"), t.ROUTES)
    routed = _groups(spark, sf).select("precedents", F.explode("precedents").alias("post")).select(
        F.col("post.customer_tweet_id").alias("customer_tweet_id"), decision.alias("d"))
    return routed.select("customer_tweet_id", "d.routing", "d.reason")


@query("reply_is_malformed", """SELECT customer_tweet_id,
 length(trim(apple_reply_text, E' \\t\\n\\r')) < 15 OR NOT (regexp_matches(trim(apple_reply_text, E' \\t\\n\\r'), '[.!?"’]$')
  OR regexp_matches(trim(apple_reply_text, E' \\t\\n\\r'), 'https?://\\S+$')) AS malformed,
 length(apple_reply_text) > 280 AS over_280 FROM pairs""", ("pairs",))
def reply_is_malformed(spark, sf):
    reply = F.col("apple_reply_text")
    return t.pairs(spark, sf).select("customer_tweet_id", x.reply_is_malformed(reply).alias("malformed"),
                                     x.over_limit(reply).alias("over_280"))


@query("strip_invisible", "SELECT customer_tweet_id, trim(customer_text, E' \\t\\n\\r') AS cleaned FROM pairs", ("pairs",))
def strip_invisible(spark, sf):
    # Zero-width characters are put in front, behind and between the words.
    dirty = F.concat(F.lit(" \u200b"), F.replace(text(), F.lit("."), F.lit("\u200c.\ufeff")), F.lit("\u200d\n"))
    return t.pairs(spark, sf).select("customer_tweet_id", x.strip_invisible(dirty).alias("cleaned"))


@query("fallback_text", """SELECT customer_tweet_id, CASE WHEN is_dm_redirect THEN customer_text
 ELSE '[reply generation failed -- flagged for manual drafting]' END AS reply FROM pairs""", ("pairs",))
def fallback_text(spark, sf):
    reply = x.fallback_text(F.when(F.col("is_dm_redirect"), text()))
    return t.pairs(spark, sf).select("customer_tweet_id", reply.alias("reply"))


@query("strip_code_fence", "SELECT customer_tweet_id, trim(customer_text, E' \\t\\n\\r') AS body FROM pairs", ("pairs",))
def strip_code_fence(spark, sf):
    opening = F.when(F.col("is_dm_redirect"), "```json\n").otherwise("```\n")
    fenced = F.concat(F.lit("\n"), opening, text(), F.lit("\n```  \n"))
    return t.pairs(spark, sf).select("customer_tweet_id", x.strip_code_fence(fenced).alias("body"))


@query("truncate_text", """SELECT customer_tweet_id, substr(customer_text, 1, 150) AS c150,
 substr(customer_text, 1, 120) AS c120, substr(customer_text, 1, 60) AS c60 FROM pairs""", ("pairs",))
def truncate_text(spark, sf):
    return t.pairs(spark, sf).select("customer_tweet_id", *[
        x.truncate_text(text(), n).alias(f"c{n}") for n in (150, 120, 60)])


@query("request_key", """SELECT customer_tweet_id, sha256('m1|low|' || lang || '|' || customer_text) AS key FROM pairs""",
       ("pairs",))
def request_key(spark, sf):
    return t.pairs(spark, sf).select("customer_tweet_id", x.request_key(
        F.lit("m1"), F.lit("low"), F.col("lang"), text()).alias("key"))


# ---- parsers, over responses made of the events' JSON payloads ------------

K = "CAST(json_extract(props, '$.k') AS INT)"


def _k():
    return F.get_json_object("props", "$.k")


@query("parse_label_array", f"""SELECT event_id,
 CASE WHEN k % 7 = 0 THEN 'plain' ELSE CASE k % 4 WHEN 0 THEN 'abusive' WHEN 1 THEN 'markup' WHEN 2 THEN 'table' ELSE 'plain' END END AS first,
 CASE WHEN k % 7 = 0 OR k % 5 = 0 THEN 'plain' ELSE 'table' END AS second,
 CASE WHEN k % 7 = 0 OR k % 5 = 0 THEN 'plain' ELSE 'markup' END AS third
 FROM (SELECT event_id, {K} AS k FROM events)""")
def parse_label_array(spark, sf):
    k = _k().cast("int")
    named = F.element_at(F.array(*[F.lit(n) for n in t.LABELS]), k % 4 + 1)
    second = F.when(k % 5 == 0, "no such label").otherwise("table")
    # Every seventh is not JSON, every fifth has a bad second item; ids 0 and 99 are out of range.
    response = F.when(k % 7 == 0, F.concat(F.lit("sorry, "), F.col("props"))).otherwise(F.concat(
        F.lit('```json\n[{"id": 1, "intent": "plain"}, {"id": 0, "intent": "table"}, {"id": "1", "intent": "'), named,
        F.lit('"}, {"id": 2.0, "intent": "'), second,
        F.lit('"}, {"id": 99, "intent": "table"}, {"id": 3, "intent": "markup"}]\n```')))
    out = parsing.parse_label_array(response, t.LABELS, F.lit(3), t.DEFAULT)
    return t.table(spark, sf, "events").select("event_id", out.alias("labels")).select(
        "event_id", *[F.col("labels")[i].alias(n) for i, n in enumerate(("first", "second", "third"))])


@query("parse_suggestion", f"""SELECT event_id, CASE WHEN ok THEN event_type ELSE '' END AS suggested_intent,
 CASE WHEN ok THEN CASE k % 2 WHEN 0 THEN 'escalate' ELSE 'auto_handle' END ELSE '' END AS suggested_routing,
 CASE WHEN ok AND k % 2 = 0 THEN 'even' ELSE '' END AS suggested_reason,
 CASE WHEN ok THEN 'k is ' || k ELSE 'FAILED - label manually' END AS model_confidence_note
 FROM (SELECT *, event_type IN ('click', 'view', 'error') AND k % 7 <> 0 AS ok FROM (SELECT *, {K} AS k FROM events))""")
def parse_suggestion(spark, sf):
    k = _k().cast("int")
    routing = F.when(k % 7 == 0, "later").when(k % 2 == 0, "escalate").otherwise("auto_handle")
    reason = F.when(k % 2 == 0, ', "escalation_reason": "even"').otherwise("")
    response = F.concat(F.lit('{"intent": "'), F.col("event_type"), F.lit('", "routing": "'), routing, F.lit('"'),
                        reason, F.lit(', "confidence_note": "k is '), k.cast("string"), F.lit('"}'))
    parsed = parsing.parse_suggestion(response, ["click", "view", "error"])
    return t.table(spark, sf, "events").select("event_id", parsed.alias("s")).select("event_id", "s.*")


@query("parse_judge_score", f"""SELECT event_id, CASE WHEN ok THEN k % 6 ELSE -1 END AS relevance,
 CASE WHEN ok THEN 1 + k % 5 ELSE -1 END AS groundedness, CASE WHEN ok THEN 1 + k % 7 ELSE -1 END AS tone
 FROM (SELECT *, k % 6 BETWEEN 1 AND 5 AND k % 7 < 5 AS ok FROM (SELECT event_id, {K} AS k FROM events))""")
def parse_judge_score(spark, sf):
    k = _k().cast("int")
    response = F.concat(F.lit('{"relevance": '), (k % 6).cast("string"), F.lit(', "groundedness": "'),
                        (1 + k % 5).cast("string"), F.lit('", "tone": '), (1 + k % 7).cast("string"), F.lit("}"))
    parsed = parsing.parse_judge_score(response)
    return t.table(spark, sf, "events").select("event_id", parsed.alias("j")).select(
        "event_id", *[F.coalesce(F.col(f"j.judge_{d}"), F.lit(-1)).alias(d)
                      for d in ("relevance", "groundedness", "tone")])
