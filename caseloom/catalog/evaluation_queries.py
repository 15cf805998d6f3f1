"""Curation and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.catalog import inputs as t
from caseloom.catalog.registry import query
from caseloom.operators import curation as c
from caseloom.operators import evaluate as e
from caseloom.plans import curate, evaluation

GOLDEN = ("golden",)
AUDIT = ("golden", "audit")
REVIEW = ("golden", "judged", "human")
FINAL = ", ".join(fv.GOLDEN_FINAL_COLUMNS)


# ---- curation -------------------------------------------------------------

@query("project_columns", f"SELECT {FINAL} FROM audit", AUDIT)
def project_columns(spark, sf):
    return c.project_columns(t.audit(spark, sf))


@query("add_blank_labels", "SELECT customer_tweet_id, '' AS true_intent, '' AS true_routing, '' AS escalation_reason FROM pairs",
       ("pairs",))
def add_blank_labels(spark, sf):
    return c.add_blank_labels(t.pairs(spark, sf).select("customer_tweet_id"))


@query("count_missing_labels", """SELECT count(*) FILTER (WHERE model_confidence_note IS NULL OR model_confidence_note = '') AS missing_model_confidence_note,
 count(*) FILTER (WHERE escalation_reason IS NULL OR escalation_reason = '') AS missing_escalation_reason,
 count(*) FILTER (WHERE true_intent IS NULL OR true_intent = '') AS missing_true_intent FROM audit""", AUDIT)
def count_missing_labels(spark, sf):
    return c.count_missing_labels(t.audit(spark, sf), ["model_confidence_note", "escalation_reason", "true_intent"])


MARKERS = "|".join(fv.UNCERTAINTY_MARKERS).replace("'", "''")


@query("flag_uncertain_notes", f"""SELECT customer_tweet_id, model_confidence_note FROM audit
 WHERE regexp_matches(lower(model_confidence_note), '{MARKERS}')""", AUDIT)
def flag_uncertain_notes(spark, sf):
    return c.flag_uncertain_notes(t.audit(spark, sf)).select("customer_tweet_id", "model_confidence_note")


@query("review_list", f"""SELECT {', '.join(fv.REVIEW_COLUMNS)} FROM audit
 WHERE regexp_matches(lower(model_confidence_note), 'unclear|either')""", AUDIT)
def review_list(spark, sf):
    return curate.review_list(t.audit(spark, sf))


@query("golden_template", """SELECT customer_tweet_id, customer_text, is_dm_redirect, bucket AS _stratify_bucket, '' AS true_intent FROM (
 WITH b AS (SELECT *, """ + t.sql_rule("lower(customer_text)") + """ AS bucket, md5(customer_tweet_id || ':42') AS h FROM pairs),
 first AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY h, customer_tweet_id)
  <= greatest(1, 200 // (SELECT count(DISTINCT bucket) FROM b)))
 SELECT * FROM first UNION ALL
 SELECT * FROM (SELECT * FROM b WHERE customer_tweet_id NOT IN (SELECT customer_tweet_id FROM first)
  ORDER BY h, customer_tweet_id LIMIT (200 - (SELECT count(*) FROM first))))""", ("pairs",))
def golden_template(spark, sf):
    template = curate.golden_template(t.pairs(spark, sf), 200, rules=t.LEXICON, default=t.DEFAULT)
    return template.select("customer_tweet_id", "customer_text", "is_dm_redirect", "_stratify_bucket", "true_intent")


def _overrides(spark, sf):
    """Corrections for the rows of poor quality; "" is a value, not a gap."""
    return t.table(spark, sf, "labels").where("quality = 0").select(
        F.col("doc_id").alias("customer_tweet_id"), F.lit("table").alias("true_intent"),
        F.lit("escalate").alias("true_routing"), F.lit("").alias("escalation_reason"))


@query("apply_overrides", """SELECT customer_tweet_id, CASE WHEN quality = 0 THEN 'table' ELSE true_intent END AS true_intent,
 CASE WHEN quality = 0 THEN 'escalate' ELSE true_routing END AS true_routing,
 CASE WHEN quality = 0 THEN '' ELSE escalation_reason END AS escalation_reason
 FROM golden JOIN labels ON customer_tweet_id = doc_id""", GOLDEN)
def apply_overrides(spark, sf):
    changed = c.apply_overrides(t.golden(spark, sf), _overrides(spark, sf))
    return changed.select("customer_tweet_id", *fv.LABEL_COLUMNS)


@query("override_metrics", """SELECT (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)) AS rows_changed,
 (SELECT count(*) FROM labels WHERE quality = 0) AS overrides_planned,
 (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)) <> (SELECT count(*) FROM labels WHERE quality = 0) AS mismatch""")
def override_metrics(spark, sf):
    return c.override_metrics(t.golden(spark, sf), _overrides(spark, sf))


@query("agreement_rate", """SELECT measure, agreed, total, agreed / total AS agreement FROM (
 SELECT 'intent' AS measure, count(*) FILTER (WHERE true_intent = suggested_intent) AS agreed, count(*) AS total FROM audit
 UNION ALL SELECT 'routing', count(*) FILTER (WHERE true_routing = suggested_routing), count(*) FROM audit)""", AUDIT)
def agreement_rate(spark, sf):
    return curate.finalize_golden(t.audit(spark, sf))[1]


# ---- baselines and label reports ------------------------------------------

MAJORITY = "(SELECT true_intent FROM golden GROUP BY true_intent ORDER BY count(*) DESC, true_intent LIMIT 1)"
SIMPLE_ROUTING = "CASE WHEN regexp_matches(customer_text, '(?i)idiot|license') THEN 'escalate' ELSE 'auto_handle' END"
PREDICTED = f"(SELECT *, {t.sql_rule('customer_text', '(?i)')} AS predicted_intent FROM golden)"


def _simple(spark, sf):
    return e.simple_predict(t.golden(spark, sf), rules=t.LEXICON, default=t.DEFAULT,
                            templates={n: f"Canned reply: {n}" for n in t.LABELS},
                            escalations=["idiot", "license"])


def _with_failures(spark, sf):
    """Predictions in which everything taken for a table came back failed."""
    failed = F.when(F.col("predicted_intent") == "table", fv.FAILED_LABEL).otherwise(F.col("predicted_intent"))
    return _simple(spark, sf).withColumn("predicted_intent", failed)


@query("majority_class", f"SELECT {MAJORITY} AS true_intent", GOLDEN)
def majority_class(spark, sf):
    return e.majority_class(t.golden(spark, sf), "true_intent")


@query("trivial_predict", f"""SELECT customer_tweet_id, {MAJORITY} AS predicted_intent, 'escalate' AS routing_decision,
 'Thanks for reaching out! Please DM us so we can look into this further.' AS drafted_reply FROM golden""", GOLDEN)
def trivial_predict(spark, sf):
    return e.trivial_predict(t.golden(spark, sf)).select(
        "customer_tweet_id", "predicted_intent", "routing_decision", "drafted_reply")


@query("simple_predict", f"""SELECT customer_tweet_id, predicted_intent, {SIMPLE_ROUTING} AS routing_decision,
 'Canned reply: ' || predicted_intent AS drafted_reply FROM {PREDICTED}""", GOLDEN)
def simple_predict(spark, sf):
    return _simple(spark, sf).select("customer_tweet_id", "predicted_intent", "routing_decision", "drafted_reply")


@query("drop_failed_predictions", f"SELECT customer_tweet_id, predicted_intent FROM {PREDICTED} WHERE predicted_intent <> 'table'", GOLDEN)
def drop_failed_predictions(spark, sf):
    return e.drop_failed_predictions(_with_failures(spark, sf)).select("customer_tweet_id", "predicted_intent")


@query("failed_count", f"SELECT count(*) FILTER (WHERE predicted_intent = 'table') AS failed FROM {PREDICTED}", GOLDEN)
def failed_count(spark, sf):
    return e.failed_count(_with_failures(spark, sf))


@query("accuracy", f"SELECT count(*) FILTER (WHERE true_intent = predicted_intent) / count(*) AS accuracy FROM {PREDICTED}", GOLDEN)
def accuracy(spark, sf):
    return e.accuracy(_simple(spark, sf), "true_intent", "predicted_intent")


LABEL_LIST = "(VALUES " + ", ".join(f"({i}, '{name}')" for i, name in enumerate(t.LABELS)) + ") AS l(position, label)"
PER_LABEL = f"""SELECT position, label, support, tp, predicted, coalesce(tp / nullif(predicted, 0), 0) AS p,
 coalesce(tp / nullif(support, 0), 0) AS r, coalesce(2 * tp / nullif(support + predicted, 0), 0) AS f FROM (
 SELECT position, label, count(*) FILTER (WHERE true_intent = label) AS support,
  count(*) FILTER (WHERE predicted_intent = label) AS predicted,
  count(*) FILTER (WHERE true_intent = label AND predicted_intent = label) AS tp
 FROM {LABEL_LIST} CROSS JOIN {PREDICTED} GROUP BY position, label)"""


@query("classification_report", f"""SELECT * FROM (WITH s AS ({PER_LABEL})
 SELECT position, label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM s
 UNION ALL SELECT 4, 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM s
 UNION ALL SELECT 5, 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM s
 UNION ALL SELECT 6, 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM s)""", GOLDEN)
def classification_report(spark, sf):
    report = e.classification_report(_simple(spark, sf), "true_intent", "predicted_intent", t.LABELS)
    return report.withColumns({m: F.round(m, 6) for m in ("precision", "recall", "f1")})


@query("confusion_matrix", "SELECT position, label, " + ", ".join(
    f"count(*) FILTER (WHERE true_intent = label AND predicted_intent = '{n}') AS \"{n}\"" for n in t.LABELS)
    + f" FROM {LABEL_LIST} CROSS JOIN {PREDICTED} GROUP BY position, label", GOLDEN)
def confusion_matrix(spark, sf):
    return e.confusion_matrix(_simple(spark, sf), "true_intent", "predicted_intent", t.LABELS)


@query("system_comparison", f"""SELECT 'trivial' AS system, count(*) FILTER (WHERE true_intent = {MAJORITY}) / count(*) AS intent_accuracy,
 count(*) FILTER (WHERE true_routing = 'escalate') / count(*) AS routing_accuracy FROM golden
 UNION ALL SELECT 'simple', count(*) FILTER (WHERE true_intent = predicted_intent) / count(*),
 count(*) FILTER (WHERE true_routing = {SIMPLE_ROUTING}) / count(*) FROM {PREDICTED}""", GOLDEN)
def system_comparison(spark, sf):
    return e.cube_accuracy(_cube(spark, sf))


def _cube(spark, sf):
    return evaluation.system_cube(t.golden(spark, sf), rules=t.LEXICON, default=t.DEFAULT, escalations=["idiot", "license"])


@query("confusion_cube", f"""SELECT 'intent' AS task, 'simple' AS system, true_intent AS truth, predicted_intent AS pred, count(*) AS n FROM {PREDICTED} GROUP BY ALL
 UNION ALL SELECT 'routing', 'simple', true_routing, {SIMPLE_ROUTING}, count(*) FROM {PREDICTED} GROUP BY ALL
 UNION ALL SELECT 'intent', 'trivial', true_intent, {MAJORITY}, count(*) FROM golden GROUP BY ALL
 UNION ALL SELECT 'routing', 'trivial', true_routing, 'escalate', count(*) FROM golden GROUP BY ALL""", GOLDEN)
def confusion_cube(spark, sf):
    return _cube(spark, sf)


# ---- judge and human scores -----------------------------------------------

@query("row_mean_score", """SELECT customer_tweet_id, coalesce(round((judge_relevance + judge_groundedness + judge_tone) / 3, 6), -1) AS mean
 FROM judged""", ("golden", "judged"))
def row_mean_score(spark, sf):
    mean = e.row_mean_score(F.col("judge_relevance"), F.col("judge_groundedness"), F.col("judge_tone"))
    return t.judged(spark, sf).select("customer_tweet_id", F.coalesce(F.round(mean, 6), F.lit(-1.0)).alias("mean"))


JUDGE_LINES = " UNION ALL ".join(f"""SELECT 'judge_{d}' AS dimension, sum(judge_{d}) / count(*) AS mean_all_rows,
 sum(judge_{d}) / count(judge_{d}) AS mean_scored, count(*) - count(judge_{d}) AS failed FROM judged""" for d in fv.JUDGE_DIMENSIONS)


@query("mean_judge_scores", JUDGE_LINES, ("golden", "judged"))
def mean_judge_scores(spark, sf):
    return e.mean_judge_scores(t.judged(spark, sf), [f"judge_{d}" for d in fv.JUDGE_DIMENSIONS])


@query("join_human_judge", """SELECT customer_tweet_id, human_relevance, human_tone, judge_relevance, judge_tone
 FROM human JOIN judged USING (customer_tweet_id) WHERE judge_tone IS NOT NULL""", REVIEW)
def join_human_judge(spark, sf):
    joined = e.join_human_judge(t.human(spark, sf), t.judged(spark, sf)).where(F.col("judge_tone").isNotNull())
    return joined.select("customer_tweet_id", "human_relevance", "human_tone", "judge_relevance", "judge_tone")


@query("score_spread", """SELECT 'human_tone' AS score, min(human_tone) AS min, max(human_tone) AS max, count(DISTINCT human_tone) AS distinct_values FROM human
 UNION ALL SELECT 'human_relevance', min(human_relevance), max(human_relevance), count(DISTINCT human_relevance) FROM human""", REVIEW)
def score_spread(spark, sf):
    return e.score_spread(t.human(spark, sf), "human_tone", "human_relevance")


def _scored(spark, sf):
    return e.join_human_judge(t.human(spark, sf), t.judged(spark, sf))


@query("exact_match_rate", """SELECT count(*) FILTER (WHERE human_relevance = judge_relevance) / count(*) AS exact_match
 FROM human JOIN judged USING (customer_tweet_id)""", REVIEW)
def exact_match_rate(spark, sf):
    return e.exact_match_rate(_scored(spark, sf), "human_relevance", "judge_relevance")


@query("within_one_rate", """SELECT count(*) FILTER (WHERE abs(human_relevance - judge_relevance) <= 1) / count(*) AS within_one
 FROM human JOIN judged USING (customer_tweet_id)""", REVIEW)
def within_one_rate(spark, sf):
    return e.within_one_rate(_scored(spark, sf), "human_relevance", "judge_relevance")


def _spearman_sql(name: str, rows: str, a: str, b: str) -> str:
    """rho from mid-ranks, p from the finite series for Student's t."""
    return f"""SELECT '{name}' AS pair, round(rho, 6) AS rho, n, round(1 - CASE WHEN nu % 2 = 1
  THEN 2 / pi() * (theta + sin(theta) * cos(theta) * (1 + coalesce((SELECT sum(term) FROM (
   SELECT exp(sum(ln(pow(cos(theta), 2) * (k - 1) / k)) OVER (ORDER BY k)) AS term FROM range(3, nu - 1, 2) r(k))), 0)))
  ELSE sin(theta) * (1 + coalesce((SELECT sum(term) FROM (
   SELECT exp(sum(ln(pow(cos(theta), 2) * (k - 1) / k)) OVER (ORDER BY k)) AS term FROM range(2, nu - 1, 2) r(k))), 0)) END, 6) AS p
 FROM (SELECT *, n - 2 AS nu, atan(abs(rho) / sqrt(1 - rho * rho)) AS theta FROM (
  SELECT corr(ra, rb) AS rho, count(*) AS n FROM (
   SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2 AS ra,
    rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2 AS rb
   FROM {rows} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)))"""


REVIEWED = "(SELECT * FROM human JOIN judged USING (customer_tweet_id))"


@query("spearman", _spearman_sql("tone", REVIEWED, "human_tone", "judge_tone") + " UNION ALL "
       + _spearman_sql("doc size and id", "documents", "n_chars", "doc_id") + " UNION ALL "
       + _spearman_sql("relevance", REVIEWED, "human_relevance", "judge_groundedness"), REVIEW)
def spearman(spark, sf):
    scored, docs = _scored(spark, sf), t.table(spark, sf, "documents")
    lines = [("tone", scored, "human_tone", "judge_tone"), ("doc size and id", docs, "n_chars", "doc_id"),
             ("relevance", scored, "human_relevance", "judge_groundedness")]
    out = [e.spearman(df, a, b).select(F.lit(name).alias("pair"), F.round("rho", 6).alias("rho"),
                                       F.round("p", 6).alias("p"), "n") for name, df, a, b in lines]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("judge_agreement", " UNION ALL ".join(f"""SELECT '{d}' AS dimension, round(corr(ra, rb), 6) AS rho, count(*) AS n,
 (SELECT count(*) FILTER (WHERE human_{d} = judge_{d}) / count(*) FROM {REVIEWED}) AS exact_match FROM (
 SELECT rank() OVER (ORDER BY human_{d}) + (count(*) OVER (PARTITION BY human_{d}) - 1) / 2 AS ra,
  rank() OVER (ORDER BY judge_{d}) + (count(*) OVER (PARTITION BY judge_{d}) - 1) / 2 AS rb
 FROM {REVIEWED} WHERE judge_{d} IS NOT NULL)""" for d in fv.JUDGE_DIMENSIONS), REVIEW)
def judge_agreement(spark, sf):
    return evaluation.judge_agreement(t.human(spark, sf), t.judged(spark, sf)).select(
        "dimension", F.round("rho", 6).alias("rho"), "n", "exact_match")
