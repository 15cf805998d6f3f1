"""Reports over a finished run."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.rules import Rules, simple_intent, simple_routing
from caseloom.operators import evaluate as e
from caseloom.operators.sampling import spread_sample
from caseloom.operators.scoring import Scorer, judge_replies
from caseloom.session import materialize


def system_cube(golden: DataFrame, run: bool = False, text: str = "customer_text", rules: Rules = fv.INTENT_RULES, default: str = fv.CATCH_ALL,
                escalations: Sequence[str] = fv.BASELINE_ESCALATION_PATTERNS) -> DataFrame:
    """The confusion cube of the baselines, and of the run whose predictions the table holds, over both tasks; one scan."""
    intents = {"simple": simple_intent(F.col(text), rules, default)} | ({"full": F.col("predicted_intent")} if run else {})
    routes = {"simple": simple_routing(F.col(text), escalations)} | ({"full": F.col("routing_decision")} if run else {})
    cube = e.confusion_cube(golden, {"intent": ("true_intent", intents), "routing": ("true_routing", routes)})
    # every later report reads these few cells
    return materialize(e.cube_with_trivial(materialize(cube, "cube"), "simple", {"intent": None, "routing": F.lit(fv.ESCALATE)}), "cube")


def baseline_comparison(golden: DataFrame, run: DataFrame | None = None) -> DataFrame:
    """A row per system: intent and routing accuracy.  A run carries the golden columns and its predictions."""
    return e.cube_accuracy(system_cube(golden if run is None else run, run is not None))


def evaluate_run(run: DataFrame, judge: Scorer, human: DataFrame | None = None, labels: Sequence[str] = fv.INTENTS,
                 store: str | None = None, attempts: int = 1) -> dict[str, DataFrame]:
    """The judging job: systems compared, the run's report and matrix, judge scores and their means, and agreement with human scores.

    run: golden columns and the run's output.  The rows are scanned once for all label
    reports, the judge is asked once a reply, and what it said is written before it is reported.
    """
    cube = system_cube(run, True)
    judged = materialize(judge_replies(run, judge, store=store, attempts=attempts), "judged")
    dimensions = [f"judge_{d}" for d in fv.JUDGE_DIMENSIONS]
    pairs = e.cube_pairs(cube, "intent", "full")
    reports = {"systems": e.cube_accuracy(cube), "report": e.report_of_pairs(pairs, labels), "matrix": e.matrix_of_pairs(pairs, labels),
               "judged": judged, "means": e.mean_judge_scores(judged, dimensions), "review": review_sheet(judged)}
    if human is not None:
        reports["agreement"] = judge_agreement(human, judged)
    return reports


def prediction_report(predictions: DataFrame, labels: Sequence[str] = fv.INTENTS, truth: str = "true_intent",
                      pred: str = "predicted_intent") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Report and confusion matrix of the rows that got a label, and the number that did not."""
    scored = e.drop_failed_predictions(predictions, pred)
    return (e.classification_report(scored, truth, pred, labels), e.confusion_matrix(scored, truth, pred, labels),
            e.failed_count(predictions, pred))


def review_sheet(judged: DataFrame, n: int = fv.HUMAN_SAMPLE_SIZE, seed: int = fv.SAMPLE_SEED) -> DataFrame:
    """Rows for a person to score: low, high and other judge scores."""
    mean = e.row_mean_score(*[F.col(f"judge_{d}") for d in fv.JUDGE_DIMENSIONS])
    return spread_sample(judged.withColumn("_avg_judge_score", mean), "_avg_judge_score", n, seed=seed)


def judge_agreement(human: DataFrame, judge: DataFrame,
                    dimensions: Sequence[str] = fv.JUDGE_DIMENSIONS) -> DataFrame:
    """A row per dimension: rho, p, n, exact_match, within_one."""
    merged = e.join_human_judge(human, judge)
    columns = [(d, F.col(f"human_{d}"), F.col(f"judge_{d}")) for d in dimensions]
    rates = merged.agg(F.array(*[F.struct(
        F.lit(d).alias("dimension"), e.hit_rate(h == j).alias("exact_match"),
        e.hit_rate(F.abs(h - j) <= 1).alias("within_one")) for d, h, j in columns]).alias("rates"))
    correlations = reduce(DataFrame.unionByName, [
        e.spearman(merged, f"human_{d}", f"judge_{d}").withColumn("dimension", F.lit(d)) for d in dimensions])
    return correlations.join(rates.select(F.inline("rates")), "dimension")
