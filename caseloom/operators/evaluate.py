"""Baselines, reports and agreement statistics.

Every report starts from one aggregation over the rows, grouped by the few
label or score values; all else is arithmetic on that small result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.rules import Rules, simple_intent, simple_reply_template, simple_routing
from caseloom.operators.ranks import running_total
from caseloom.session import materialize


def _share(hits: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(hits.cast("double"), total.cast("double")), F.lit(0.0))


def hit_rate(condition: Column) -> Column:
    """Share of all rows where the condition holds; null does not."""
    return F.try_divide(F.count_if(condition).cast("double"), F.count("*").cast("double"))


# ---- baselines ------------------------------------------------------------

def majority_class(df: DataFrame, col: str) -> DataFrame:
    """The most frequent value, the lowest one on ties."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(col)).limit(1).select(col)


def trivial_predict(df: DataFrame, truth: str = "true_intent", reply: str = fv.TRIVIAL_REPLY) -> DataFrame:
    """Always the majority class, always escalate, always the same reply."""
    return df.withColumns({"predicted_intent": majority_class(df, truth).scalar(),
                           "routing_decision": F.lit(fv.ESCALATE), "drafted_reply": F.lit(reply)})


def simple_predict(df: DataFrame, text: str = "customer_text", rules: Rules = fv.INTENT_RULES,
                   default: str = fv.CATCH_ALL,
                   templates: Mapping[str, str] = fv.REPLY_TEMPLATES,
                   escalations: Sequence[str] = fv.BASELINE_ESCALATION_PATTERNS) -> DataFrame:
    """Keyword intent, canned reply, keyword routing."""
    return (df.withColumn("predicted_intent", simple_intent(F.col(text), rules, default))
            .withColumn("routing_decision", simple_routing(F.col(text), escalations))
            .withColumn("drafted_reply", simple_reply_template(F.col("predicted_intent"), templates)))


# ---- label reports --------------------------------------------------------

def drop_failed_predictions(df: DataFrame, col: str = "predicted_intent") -> DataFrame:
    return df.where(F.col(col) != fv.FAILED_LABEL)


def failed_count(df: DataFrame, col: str = "predicted_intent") -> DataFrame:
    return df.agg(F.count_if(F.col(col) == fv.FAILED_LABEL).alias("failed"))


def share_true(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.avg(F.col(col).cast("int")).alias(f"{col}_share"))


def accuracy(df: DataFrame, truth: str, pred: str) -> DataFrame:
    return df.agg(hit_rate(F.col(truth) == F.col(pred)).alias("accuracy"))


def _label_pairs(df: DataFrame, truth: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def _labels(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    listed = F.posexplode(F.array(*[F.lit(label) for label in labels])).alias("position", "label")
    return df.sparkSession.range(1).select(listed)


def confusion_cube(df: DataFrame, tasks: Mapping[str, tuple[str, Mapping[str, Column]]]) -> DataFrame:
    """(task, system, truth, pred, n): every task and system of a table in one scan and one aggregation.

    tasks: name -> (truth column, system -> prediction).  A task's number of cells is that
    of its label pairs, whatever the number of rows.
    """
    cells = F.array(*[F.struct(F.lit(task).alias("task"), F.lit(system).alias("system"), F.col(truth).cast("string").alias("truth"),
                               pred.cast("string").alias("pred")) for task, (truth, systems) in tasks.items() for system, pred in systems.items()])
    return df.select(F.explode(cells).alias("c")).groupBy("c.task", "c.system", "c.truth", "c.pred").agg(F.count("*").alias("n"))


def cube_with_trivial(cube: DataFrame, of: str, fixed: Mapping[str, Column | None]) -> DataFrame:
    """The cube with a system "trivial" that says the same of every row.

    fixed: task -> what it says, or None for the task's most frequent truth, the lowest on
    ties.  Truths are read off the cells of the system `of`, so the rows are not scanned again.
    """
    truths = cube.where(F.col("system") == of).groupBy("task", "truth").agg(F.sum("n").alias("n"))
    known = F.when(F.col("truth").isNotNull(), F.struct((-F.col("n")).alias("n"), "truth"))
    most = truths.groupBy("task").agg(F.min(known)["truth"].alias("most"))
    said = F.col("most")
    for task, value in fixed.items():
        if value is not None:
            said = F.when(F.col("task") == task, value).otherwise(said)
    rows = truths.where(F.col("task").isin(list(fixed))).join(most, "task")
    return cube.unionByName(rows.select("task", F.lit("trivial").alias("system"), "truth", said.alias("pred"), "n"))


def cube_accuracy(cube: DataFrame) -> DataFrame:
    """A row per system, a column <task>_accuracy per task."""
    hits = F.sum(F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0))
    rates = cube.groupBy("system", "task").agg(F.try_divide(hits.cast("double"), F.sum("n").cast("double")).alias("accuracy"))
    tasks = sorted(r["task"] for r in rates.select("task").distinct().collect())
    wide = rates.groupBy("system").pivot("task", tasks).agg(F.first("accuracy"))
    return wide.select("system", *[F.col(f"`{t}`").alias(f"{t}_accuracy") for t in tasks])


def cube_pairs(cube: DataFrame, task: str, system: str) -> DataFrame:
    """(truth, pred, n) of one task and system, for classification_report and confusion_matrix."""
    return cube.where((F.col("task") == task) & (F.col("system") == system)).select("truth", "pred", "n")


def classification_report(df: DataFrame, truth: str, pred: str, labels: Sequence[str]) -> DataFrame:
    return report_of_pairs(_label_pairs(df, truth, pred), labels)


def report_of_pairs(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """label, precision, recall, f1, support of (truth, pred, n); 0 where a ratio has no rows.

    After the labels come the accuracy (named micro avg where rows carry labels
    outside the list), the plain mean and the mean weighted by support.
    """
    hit = F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0)
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"),
                 F.lit(0).cast("bigint").alias("predicted"), hit.alias("tp")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp")))).alias("s"))
    totals = sides.groupBy("s.label").agg(
        *[F.sum(f"s.{c}").alias(c) for c in ("support", "predicted", "tp")])
    listed = _labels(pairs, labels).join(totals, "label", "full").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("support", "predicted", "tp")})

    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    scored = listed.withColumns({
        "precision": _share(tp, predicted), "recall": _share(tp, support),
        "f1": _share(2 * tp, support + predicted)})
    known = F.col("position").isNotNull()

    def over(total: Column) -> Column:
        return F.coalesce(F.sum(F.when(known, total)), F.lit(0))

    measures = ["precision", "recall", "f1"]
    all_support = over(support)
    micro = {"precision": _share(over(tp), over(predicted)), "recall": _share(over(tp), all_support),
             "f1": _share(2 * over(tp), all_support + over(predicted))}
    # Rows with a label outside the list turn the accuracy line into a micro average.
    outside = F.sum(F.when(~known, support + predicted).otherwise(0)) > 0

    def line(name: Column, values: Mapping[str, Column], position: int) -> Column:
        return F.struct(F.lit(position).alias("position"), name.alias("label"),
                        *[values[m].alias(m) for m in measures], all_support.alias("support"))

    averages = scored.agg(F.array(
        line(F.when(outside, "micro avg").otherwise("accuracy"), micro, len(labels)),
        line(F.lit("macro avg"),
             {m: F.coalesce(F.avg(F.when(known, F.col(m))), F.lit(0.0)) for m in measures}, len(labels) + 1),
        line(F.lit("weighted avg"),
             {m: _share(over(F.col(m) * support), all_support) for m in measures}, len(labels) + 2),
    ).alias("lines")).select(F.explode("lines").alias("l")).select("l.*")
    columns = ["position", "label", *measures, "support"]
    return scored.where(known).select(columns).unionByName(averages.select(columns))


def confusion_matrix(df: DataFrame, truth: str, pred: str, labels: Sequence[str]) -> DataFrame:
    return matrix_of_pairs(_label_pairs(df, truth, pred), labels)


def matrix_of_pairs(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """A row per true label, a column per predicted label, in list order, of (truth, pred, n)."""
    counts = pairs.groupBy(F.col("truth").alias("label")).pivot("pred", list(labels)).agg(F.sum("n"))
    return _labels(pairs, labels).join(counts, "label", "left").na.fill(0).select("position", "label", *labels)


def system_comparison(systems: Mapping[str, DataFrame], intent: tuple[str, str] = ("true_intent", "predicted_intent"),
                      routing: tuple[str, str] = ("true_routing", "routing_decision")) -> DataFrame:
    """A row per system: intent and routing accuracy."""
    rows = None
    for name, df in systems.items():
        row = df.agg(F.lit(name).alias("system"),
                     hit_rate(F.col(intent[0]) == F.col(intent[1])).alias("intent_accuracy"),
                     hit_rate(F.col(routing[0]) == F.col(routing[1])).alias("routing_accuracy"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


# ---- judge and human scores -----------------------------------------------

def row_mean_score(*cols: Column) -> Column:
    """Mean of the scores of a row; null where any is missing."""
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total / len(cols)


def mean_judge_scores(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A row per dimension: mean over all rows (a failure counts 0), mean of the
    scored rows, and the number of failures."""
    sums = df.agg(F.count("*").alias("rows"), *[F.sum(c).alias(f"s_{c}") for c in cols],
                  *[F.count(c).alias(f"n_{c}") for c in cols])
    line = F.explode(F.array(*[
        F.struct(F.lit(c).alias("dimension"), F.coalesce(F.col(f"s_{c}"), F.lit(0)).alias("s"),
                 F.col(f"n_{c}").alias("n")) for c in cols]))
    return sums.select("rows", line.alias("l")).select(
        "l.dimension", F.try_divide("l.s", "rows").alias("mean_all_rows"),
        F.try_divide("l.s", "l.n").alias("mean_scored"), (F.col("rows") - F.col("l.n")).alias("failed"))


def join_human_judge(human: DataFrame, judge: DataFrame, key: str = "customer_tweet_id") -> DataFrame:
    return human.join(judge, key)


def exact_match_rate(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(hit_rate(F.col(a) == F.col(b)).alias("exact_match"))


def within_one_rate(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(hit_rate(F.abs(F.col(a) - F.col(b)) <= 1).alias("within_one"))


def score_spread(df: DataFrame, *cols: str) -> DataFrame:
    """A row per column: lowest, highest and number of distinct scores."""
    sums = df.agg(*[f(c).alias(f"{n}_{c}") for c in cols
                    for n, f in (("lo", F.min), ("hi", F.max), ("d", F.count_distinct))])
    line = F.explode(F.array(*[
        F.struct(F.lit(c).alias("score"), F.col(f"lo_{c}").alias("min"), F.col(f"hi_{c}").alias("max"),
                 F.col(f"d_{c}").alias("distinct_values")) for c in cols]))
    return sums.select(line.alias("l")).select("l.*")


def _gamma_step(a: float) -> float:
    """Gamma(a + 1/2) / (sqrt(a) Gamma(a)): an asymptotic series, reached from smaller a by the recurrence."""
    factor = 1.0
    while a < 40.0:
        factor *= a / (a + 0.5) * math.sqrt((a + 1.0) / a)
        a += 1.0
    z = 1.0 / a
    return factor * (1.0 + z * (-1 / 8 + z * (1 / 128 + z * (5 / 1024 + z * (-21 / 32768 + z * (-399 / 262144 + z * 869 / 4194304))))))


def t_two_sided(t_squared: float, dof: float) -> float:
    """P(|T| > t) of Student's t, by one formula at every number of degrees of freedom.

    With u = sqrt(dof) sinh(y / sqrt(dof)) the tail is the integral of
    cosh(y / sqrt(dof)) ** -dof over y, which becomes exp(-y * y / 2) as dof grows; it is
    summed by double-exponential quadrature, relative to the integrand's first value.
    """
    root = math.sqrt(dof)
    start = math.asinh(math.sqrt(t_squared / dof))

    def log_cosh(z: float) -> float:
        return z + math.log1p(math.exp(-2.0 * z)) - math.log(2.0) if z > 1.0 else 0.5 * math.log1p(math.sinh(z) ** 2)

    if math.isinf(start):
        return 0.0
    base = log_cosh(start)
    # log cosh(start + s) - log cosh(start) without the difference of two near numbers
    tanh = math.tanh(start)

    def decay(s: float) -> float:
        z = s / root
        if z > 1.0:
            return dof * (log_cosh(start + z) - base)
        return dof * math.log1p(2.0 * math.sinh(z / 2.0) ** 2 + tanh * math.sinh(z))

    scale = 1.0 / max(1.0, root * tanh)  # how far the integrand reaches
    terms, step = [], 1.0 / 64
    for i in range(-320, 321):
        u = i * step
        s = scale * math.exp(math.pi / 2 * math.sinh(u))
        if 0.0 < s < 1e300:
            exponent = decay(s) if s / root < 700.0 else math.inf
            if exponent < 745.0:
                terms.append(math.exp(-exponent) * s * math.pi / 2 * math.cosh(u))
    tail = math.fsum(terms) * step
    # Gamma((dof + 1) / 2) / (sqrt(pi dof) Gamma(dof / 2)), twice
    front = 2.0 * _gamma_step(dof / 2.0) / math.sqrt(2.0 * math.pi)
    return min(1.0, front * math.exp(-dof * base) * tail)


def _t_two_sided():
    """UDF of t_two_sided, for the one row of a report."""
    @F.pandas_udf("double")
    def p_value(t_squared: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(t) or nu < 1 else t_two_sided(float(t), float(nu)) for t, nu in zip(t_squared, dof)], dtype="float64")

    return p_value


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: rho (average ranks), two-sided p, n; null rho without variance.

    Ranks come from the counts of distinct values, so rows with equal scores
    never travel: the rows are read once and reduced to their score pairs.
    """
    pairs = materialize(
        df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
        .agg(F.count("*").alias("n")), "score-pairs")
    n = pairs.agg(F.sum("n")).scalar()

    def centred_ranks(side: str) -> DataFrame:
        values = pairs.groupBy(side).agg(F.sum("n").alias("ties"))
        below = running_total(values, side, "ties", "below")
        # mid-rank minus the mean rank (n + 1) / 2
        return below.select(side, (F.col("below") + (F.col("ties") - n) / 2.0).alias(f"r{side}"))

    ranked = pairs.join(centred_ranks("a"), "a").join(centred_ranks("b"), "b")
    w, ra, rb = F.col("n"), F.col("ra"), F.col("rb")
    sums = ranked.agg(F.sum(w).alias("n"), F.sum(w * ra * rb).alias("ab"),
                      F.sum(w * ra * ra).alias("aa"), F.sum(w * rb * rb).alias("bb"))
    raw = F.try_divide("ab", F.sqrt("aa") * F.sqrt("bb"))
    rho = F.when(raw.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), raw)))
    unexplained = 1 - F.col("rho") * F.col("rho")
    t_squared = F.when(unexplained > 1e-15,
                       F.try_divide(F.col("rho") * F.col("rho") * (F.col("n") - 2), unexplained)
                       ).when(F.col("rho").isNotNull(), F.lit(float("inf")))
    p_value = _t_two_sided()
    return (sums.select(F.coalesce("n", F.lit(0)).alias("n"), rho.alias("rho"))
            .select("rho", F.when(F.col("n") > 2, p_value(t_squared, (F.col("n") - 2).cast("double"))).alias("p"), "n"))
