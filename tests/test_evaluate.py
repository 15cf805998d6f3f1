import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.operators import evaluate as e
from caseloom.plans import evaluation

RELEVANCE = [4, 5, 5, 5, 5, 5, 3, 1, 1, 2, 4, 2, 5, 5, 5, 4, 2, 4, 5, 5, 4, 5, 4, 1, 5]
GROUNDED = [5, 4, 2, 5, 5, 3, 5, 1, 1, 2, 3, 2, 3, 4, 5, 3, 1, 2, 5, 4, 1, 3, 5, 1, 2]


def scores(spark, a, b):
    return spark.createDataFrame(list(zip(a, b)), "a int, b int")


def mid_ranks(v):
    return [sum(x < y for x in v) + (sum(x == y for x in v) + 1) / 2 for y in v]


def test_spearman_of_human_scores(spark):
    got = e.spearman(scores(spark, RELEVANCE, GROUNDED), "a", "b").first()
    assert got.n == 25 and got.rho == pytest.approx(0.569273, abs=1e-6)


def test_spearman_against_brute_force(spark):
    rng = random.Random(3)
    a = [rng.choice([1, 2, 2, 3, 9]) for _ in range(60)]
    b = [x + rng.randrange(5) for x in a]
    ra, rb = mid_ranks(a), mid_ranks(b)
    m = (len(a) + 1) / 2
    rho = sum((x - m) * (y - m) for x, y in zip(ra, rb)) / math.sqrt(
        sum((x - m) ** 2 for x in ra) * sum((y - m) ** 2 for y in rb))
    assert e.spearman(scores(spark, a, b), "a", "b").first().rho == pytest.approx(rho, abs=1e-12)


def test_spearman_edges(spark):
    constant = e.spearman(scores(spark, [1, 2, 3], [4, 4, 4]), "a", "b").first()
    assert constant.rho is None and constant.p is None and constant.n == 3
    perfect = e.spearman(scores(spark, [1, 2, 3, 4], [2, 4, 6, 8]), "a", "b").first()
    assert perfect.rho == pytest.approx(1) and perfect.p == 0
    assert e.spearman(scores(spark, [1, 2], [1, 2]), "a", "b").first().p is None
    gaps = e.spearman(scores(spark, [1, None, 3, 2], [1, 5, 3, None]), "a", "b").first()
    assert gaps.n == 2
    empty = e.spearman(scores(spark, [1], [None]), "a", "b").first()
    assert (empty.rho, empty.p, empty.n) == (None, None, 0)


@pytest.mark.parametrize("rho, n, p", [(.502, 25, .0106), (.439, 25, .0281), (.223, 25, .2840), (.5, 10, .1411),
                                       (.01, 40_000, .0455), (0.0, 25, 1.0), (.001, 30_000_000, 4.3e-8)])
def test_p_value(spark, rho, n, p):
    t2 = rho * rho * (n - 2) / (1 - rho * rho)
    row = spark.createDataFrame([(t2, float(n - 2))], "t double, nu double")
    assert row.select(e._t_two_sided()("t", "nu").alias("p")).first().p == pytest.approx(p, rel=5e-3)


TRUTH = list("aaaabbbccd")
PRED = list("aabcbbabcc")


def predicted(spark, truth=TRUTH, pred=PRED):
    return spark.createDataFrame(list(zip(truth, pred)), "t string, p string")


def test_report(spark):
    rows = {r.label: r for r in e.classification_report(predicted(spark), "t", "p", ["a", "b", "c", "d", "e"]).collect()}
    assert [rows[x].position for x in ("a", "e", "accuracy", "macro avg", "weighted avg")] == [0, 4, 5, 6, 7]
    assert (rows["a"].precision, rows["a"].recall, rows["a"].support) == (pytest.approx(2 / 3), 0.5, 4)
    assert rows["a"].f1 == pytest.approx(2 * 2 / 7)
    assert (rows["d"].precision, rows["d"].recall, rows["d"].f1, rows["d"].support) == (0, 0, 0, 1)
    assert (rows["e"].precision, rows["e"].f1, rows["e"].support) == (0, 0, 0)
    assert rows["accuracy"].f1 == 0.5 and rows["accuracy"].support == 10
    recalls = [0.5, 2 / 3, 0.5, 0, 0]
    assert rows["macro avg"].recall == pytest.approx(sum(recalls) / 5)
    assert rows["weighted avg"].recall == pytest.approx(sum(r * n for r, n in zip(recalls, [4, 3, 2, 1, 0])) / 10)


def test_report_with_labels_outside_the_list(spark):
    rows = {r.label: r for r in e.classification_report(predicted(spark), "t", "p", ["a", "b"]).collect()}
    assert "accuracy" not in rows
    assert rows["micro avg"].precision == pytest.approx(4 / 7) and rows["micro avg"].recall == pytest.approx(4 / 7)
    assert rows["micro avg"].support == 7


def test_report_of_nothing(spark):
    rows = e.classification_report(predicted(spark).limit(0), "t", "p", ["a"]).collect()
    assert [(r.label, r.precision, r.support) for r in sorted(rows, key=lambda r: r.position)] == [
        ("a", 0, 0), ("accuracy", 0, 0), ("macro avg", 0, 0), ("weighted avg", 0, 0)]


def test_matrix(spark):
    got = [tuple(r)[1:] for r in e.confusion_matrix(predicted(spark), "t", "p", ["a", "b", "c", "e"]).orderBy("position").collect()]
    assert got == [("a", 2, 1, 1, 0), ("b", 1, 2, 0, 0), ("c", 0, 1, 1, 0), ("e", 0, 0, 0, 0)]


def test_baselines(spark):
    golden = spark.createDataFrame([
        (1, "battery drain", "battery_power_drain", "auto_handle"), (2, "refund", "app_store_billing", "escalate"),
        (3, "hello", "app_store_billing", "auto_handle")],
        "customer_tweet_id long, customer_text string, true_intent string, true_routing string")
    rows = {r.system: r for r in evaluation.baseline_comparison(golden).collect()}
    assert rows["trivial"].intent_accuracy == pytest.approx(2 / 3) and rows["trivial"].routing_accuracy == pytest.approx(1 / 3)
    assert rows["simple"].intent_accuracy == pytest.approx(2 / 3) and rows["simple"].routing_accuracy == 1


def test_majority_ties_go_to_the_lowest_label(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), (None,)], "x string")
    assert e.majority_class(df, "x").first().x == "a"


def test_failures(spark):
    df = predicted(spark, "aab", ["FAILED", "a", "b"])
    assert e.failed_count(df, "p").first().failed == 1 and e.drop_failed_predictions(df, "p").count() == 2
    assert e.accuracy(df, "t", "p").first().accuracy == pytest.approx(2 / 3)


def test_prediction_report_leaves_failures_out(spark):
    df = predicted(spark, "aab", ["FAILED", "a", "b"])
    report, matrix, failed = evaluation.prediction_report(df, ["a", "b"], "t", "p")
    assert {r.label: r.support for r in report.collect()}["accuracy"] == 2
    assert [(r.a, r.b) for r in matrix.orderBy("position").collect()] == [(1, 0), (0, 1)] and failed.first().failed == 1


def test_judge_means(spark):
    df = scores(spark, [5, None], [4, 2])
    rows = {r.dimension: r for r in e.mean_judge_scores(df, ["a", "b"]).collect()}
    assert (rows["a"].mean_all_rows, rows["a"].mean_scored, rows["a"].failed) == (2.5, 5.0, 1)
    assert (rows["b"].mean_all_rows, rows["b"].mean_scored, rows["b"].failed) == (3.0, 3.0, 0)


def test_agreement(spark):
    n = len(RELEVANCE)
    human = spark.createDataFrame([(i, RELEVANCE[i], GROUNDED[i]) for i in range(n)],
                                  "customer_tweet_id long, human_x int, human_y int")
    judge = spark.createDataFrame([(i, GROUNDED[i], GROUNDED[i]) for i in range(n)],
                                  "customer_tweet_id long, judge_x int, judge_y int")
    rows = {r.dimension: r for r in evaluation.judge_agreement(human, judge, ["x", "y"]).collect()}
    assert rows["y"].rho == pytest.approx(1) and rows["y"].exact_match == 1
    pairs = list(zip(RELEVANCE, GROUNDED))
    assert rows["x"].exact_match == pytest.approx(sum(a == b for a, b in pairs) / n)
    assert rows["x"].within_one == pytest.approx(sum(abs(a - b) <= 1 for a, b in pairs) / n)


def test_spread_and_row_mean(spark):
    df = scores(spark, [1, 5, None], [2, 2, 3])
    assert [tuple(r) for r in e.score_spread(df, "a", "b").collect()] == [("a", 1, 5, 2), ("b", 2, 3, 2)]
    means = [r[0] for r in df.select(e.row_mean_score(F.col("a"), F.col("b"))).collect()]
    assert means == [1.5, 3.5, None]


def test_report_totals_equal_rows(spark):
    labels = ["a", "b", "c"]
    combos = list(itertools.product(labels, labels)) * 3
    df = predicted(spark, [x for x, _ in combos], [y for _, y in combos])
    matrix = e.confusion_matrix(df, "t", "p", labels).collect()
    assert sum(r[x] for r in matrix for x in labels) == len(combos)


# ---- one pass, one formula

@pytest.mark.parametrize("t", [0.0, 1e-6, 0.3, 1.0, 2.5, 12.0, 400.0])
def test_p_values_of_few_degrees_have_closed_forms(t):
    assert e.t_two_sided(t * t, 1) == pytest.approx(1 - 2 / math.pi * math.atan(t) if t < 10 else 2 / math.pi * math.atan(1 / t), rel=1e-10)
    assert e.t_two_sided(t * t, 2) == pytest.approx(2 / ((2 + t * t) * (1 + t / math.sqrt(2 + t * t))), rel=1e-10)
    # three degrees: a finite sum
    a = math.atan(t / math.sqrt(3))
    assert e.t_two_sided(t * t, 3) == pytest.approx(1 - 2 / math.pi * (a + math.sin(a) * math.cos(a)), abs=1e-11)


@pytest.mark.parametrize("t", [0.1, 1.0, 2.0, 3.5, 6.0])
@pytest.mark.parametrize("dof", [9_999_999, 10_000_001, 1e6, 1e9, 1e13])
def test_p_values_near_the_normal_limit(t, dof):
    """Two terms of the expansion in 1 / dof, on both sides of ten millions."""
    bell = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    second = t * (3 * t ** 6 - 7 * t ** 4 - 5 * t ** 2 - 3) / 96
    want = math.erfc(t / math.sqrt(2)) + 2 * bell * ((t ** 3 + t) / 4 / dof + second / dof ** 2)
    assert e.t_two_sided(t * t, dof) == pytest.approx(want, rel=1e-10)


def test_p_values_do_not_jump():
    values = [e.t_two_sided(4.0, 1.1 ** k) for k in range(0, 320)]
    steps = [b - a for a, b in zip(values, values[1:])]
    assert all(s < 1e-12 for s in steps) and values[-1] == pytest.approx(math.erfc(2 / math.sqrt(2)), rel=1e-10)


def test_all_label_reports_come_from_one_scan(spark, tmp_path):
    df = predicted(spark).withColumns({"r": F.lit("escalate"), "d": F.col("p")})
    path = str(tmp_path / "run")
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    cube = e.confusion_cube(stored, {"intent": ("t", {"full": F.col("p"), "always b": F.lit("b")}), "routing": ("r", {"full": F.col("d")})})
    assert cube._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    labels = ["a", "b", "c", "e"]
    pairs = e.cube_pairs(cube, "intent", "full")
    assert sorted(e.report_of_pairs(pairs, labels).collect()) == sorted(e.classification_report(df, "t", "p", labels).collect())
    assert sorted(e.matrix_of_pairs(pairs, labels).collect()) == sorted(e.confusion_matrix(df, "t", "p", labels).collect())
    rows = {r.system: r for r in e.cube_accuracy(e.cube_with_trivial(cube, "full", {"intent": None, "routing": F.lit("escalate")})).collect()}
    assert rows["full"].intent_accuracy == e.accuracy(df, "t", "p").first().accuracy and rows["trivial"].routing_accuracy == 1.0
    assert rows["trivial"].intent_accuracy == e.accuracy(e.trivial_predict(df, "t"), "t", "predicted_intent").first().accuracy


def test_the_judging_job(spark):
    from caseloom.operators.scoring import column_scorer
    from caseloom.plans.evaluation import evaluate_run
    rows = [(i, f"my phone {i} will not charge", "reply", False, fv.INTENTS[i % 3], "escalate" if i % 2 else "auto_handle", "", fv.INTENTS[i % 2],
             "escalate", "", f"Please see {i}.", "none") for i in range(24)]
    run = spark.createDataFrame(rows, """customer_tweet_id long, customer_text string, apple_reply_text string, is_dm_redirect boolean, true_intent string,
        true_routing string, escalation_reason string, predicted_intent string, routing_decision string, escalation_reason_predicted string,
        drafted_reply string, retrieved_precedent string""")
    scores = lambda s, p: F.concat(F.lit('{"relevance": '), (F.length(p) % 5 + 1).cast("string"), F.lit(', "groundedness": 3, "tone": 4}'))
    human = run.select("customer_tweet_id", *[(F.col("customer_tweet_id") % 5 + 1).alias(f"human_{d}") for d in fv.JUDGE_DIMENSIONS])
    out = evaluate_run(run, column_scorer(scores), human)
    systems = {r.system: r for r in out["systems"].collect()}
    assert set(systems) == {"trivial", "simple", "full"} and systems["full"].routing_accuracy == 0.5
    assert out["judged"].where("judge_tone = 4").count() == 24 and out["means"].where("failed = 0").count() == 3
    assert {r.dimension for r in out["agreement"].collect()} == set(fv.JUDGE_DIMENSIONS)
    assert out["report"].where("label = 'accuracy'").count() == 1 and out["matrix"].count() == len(fv.INTENTS)
    assert out["review"].count() == min(24, fv.HUMAN_SAMPLE_SIZE)
