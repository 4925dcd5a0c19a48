"""Threshold and ranking metrics of scored tables, per model or segment.

Scored rows carry a 0/1 label, a score and optionally a prediction. Every
function takes ``by`` columns; all groups are computed in the same job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintage.functions.columns import ratio
from vintage.functions.ordering import cut_points, running_totals

RATES = (
    "precision",
    "recall",
    "f1_score",
    "true_positive_rate",
    "false_positive_rate",
    "true_negative_rate",
    "false_negative_rate",
)


def ranked_counts(scored: DataFrame, label: str = "label", score: str = "probability",
                  by: Sequence[str] = (), cuts: Sequence[float] | None = None) -> DataFrame:
    """One row per distinct score with positives, negatives and running totals.

    Equal scores are merged before anything is ordered, which is what gives
    ties their half weight in the area and one point on each curve.
    """
    rows = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        *by, F.col(score).cast("double").alias("score"), F.col(label).cast("long").alias("_y")
    )
    if cuts is None:
        cuts = cut_points(rows, "score")
    groups = rows.groupBy(*by, "score").agg(
        F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg")
    )
    totals = running_totals(groups, "score", ["pos", "neg"], by=by, descending=True, cuts=cuts)
    return totals.withColumnsRenamed(
        {"cum_pos": "tp", "cum_neg": "fp", "all_pos": "positives", "all_neg": "negatives"}
    )


def areas() -> list[Column]:
    """ROC area and average precision as aggregates over ranked counts."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    pairs = neg * (F.col("tp") - F.col("pos")) + neg * pos / 2
    all_pairs = F.max(F.col("positives").cast("double") * F.col("negatives"))
    gain = ratio(F.col("pos"), F.col("positives")) * ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    return [
        F.try_divide(F.sum(pairs), all_pairs).alias("roc_auc"),
        F.sum(gain).alias("average_precision"),
    ]


def ranking_metrics(scored: DataFrame, label: str = "label", score: str = "probability",
                    by: Sequence[str] = (), cuts: Sequence[float] | None = None) -> DataFrame:
    """ROC area (ties at half) and average precision (step sum) per group."""
    counts = ranked_counts(scored, label, score, by, cuts)
    return counts.groupBy(*by).agg(*areas())


def roc_curve(scored: DataFrame, label: str = "label", score: str = "probability",
              by: Sequence[str] = ()) -> DataFrame:
    """fpr, tpr, threshold per distinct score, plus the origin of each group."""
    counts = ranked_counts(scored, label, score, by)
    points = counts.select(
        *by,
        F.coalesce(ratio(F.col("fp"), F.col("negatives")), F.lit(0.0)).alias("fpr"),
        F.coalesce(ratio(F.col("tp"), F.col("positives")), F.lit(0.0)).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    origin = _groups(scored, by).select(
        *by, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    return points.unionByName(origin)


def pr_curve(scored: DataFrame, label: str = "label", score: str = "probability",
             by: Sequence[str] = ()) -> DataFrame:
    """precision, recall, threshold per distinct score, plus the (1, 0) end."""
    counts = ranked_counts(scored, label, score, by)
    points = counts.select(
        *by,
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.coalesce(ratio(F.col("tp"), F.col("positives")), F.lit(1.0)).alias("recall"),
        F.col("score").alias("threshold"),
    )
    end = _groups(scored, by).select(
        *by,
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        F.lit(None).cast("double").alias("threshold"),
    )
    return points.unionByName(end)


def _groups(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    if by:
        return scored.select(*by).distinct()
    return scored.agg(F.count("*").alias("_rows")).drop("_rows")


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction",
              by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp as four conditional counts."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return scored.groupBy(*by).agg(
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(y & p).alias("tp"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and the four rates; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def share(num, den):
        return F.coalesce(ratio(num, den), F.lit(0.0))

    return counts.withColumns(
        {
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1_score": share(2 * tp, 2 * tp + fp + fn),
            "true_positive_rate": share(tp, tp + fn),
            "false_positive_rate": share(fp, fp + tn),
            "true_negative_rate": share(tn, tn + fp),
            "false_negative_rate": share(fn, fn + tp),
        }
    )


def threshold_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction",
                      by: Sequence[str] = ()) -> DataFrame:
    return with_rates(confusion(scored, label, prediction, by))


def classification_report(scored: DataFrame, label: str = "label",
                          prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Per-class rows 0 and 1, then accuracy, macro avg and weighted avg."""
    c = confusion(scored, label, prediction, by)
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp

    def scores(hit, false_alarm, miss):
        zero = F.lit(0.0)
        return (
            F.coalesce(F.try_divide(hit, hit + false_alarm), zero),
            F.coalesce(F.try_divide(hit, hit + miss), zero),
            F.coalesce(F.try_divide(2 * hit, 2 * hit + false_alarm + miss), zero),
            hit + miss,
        )

    def line(name, values):
        fields = ("precision", "recall", "f1_score", "support")
        return F.struct(F.lit(name).alias("class"), *[v.alias(f) for v, f in zip(values, fields)])

    neg, pos = scores(tn, fn, fp), scores(tp, fp, fn)
    accuracy = F.coalesce(F.try_divide(tn + tp, total), F.lit(0.0))
    macro = [(a + b) / 2 for a, b in zip(neg[:3], pos[:3])]
    weighted = [
        F.coalesce(F.try_divide(a * neg[3] + b * pos[3], total), F.lit(0.0))
        for a, b in zip(neg[:3], pos[:3])
    ]
    lines = F.array(
        line("0", neg),
        line("1", pos),
        line("accuracy", (accuracy, accuracy, accuracy, total)),
        line("macro avg", (*macro, total)),
        line("weighted avg", (*weighted, total)),
    )
    return c.select(*by, F.inline(lines)).withColumn("support", F.col("support").cast("long"))


def evaluate(scored: DataFrame, label: str = "label", score: str = "probability",
             prediction: str = "prediction", by: Sequence[str] = ("model",)) -> DataFrame:
    """All metrics of every group: one row per model (or segment).

    Predictions are tallied per distinct score together with the labels, so a
    single shuffle serves the ranking and the threshold metrics. Running totals
    and bucket totals ask for the same columns, which lets Spark reuse it.
    """
    rows = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        *by,
        F.col(score).cast("double").alias("score"),
        F.col(label).cast("long").alias("_y"),
        F.col(prediction).cast("long").alias("_p"),
    )
    y, p = F.col("_y"), F.col("_p")
    groups = rows.groupBy(*by, "score").agg(
        F.sum(y).alias("pos"),
        F.sum(1 - y).alias("neg"),
        F.sum(p * y).alias("hits"),
        F.sum(p * (1 - y)).alias("alarms"),
    )
    ranked = running_totals(
        groups, "score", ["pos", "neg", "hits", "alarms"], by=by, descending=True,
        cuts=cut_points(rows, "score"),
    ).withColumnsRenamed(
        {"cum_pos": "tp", "cum_neg": "fp", "all_pos": "positives", "all_neg": "negatives"}
    )
    summed = ranked.groupBy(*by).agg(
        *areas(),
        F.max("negatives").alias("_n"),
        F.max("positives").alias("_m"),
        F.max("cum_hits").alias("_tp"),
        F.max("cum_alarms").alias("_fp"),
    )
    counts = summed.select(
        *by,
        "roc_auc",
        "average_precision",
        (F.col("_n") - F.col("_fp")).alias("tn"),
        F.col("_fp").alias("fp"),
        (F.col("_m") - F.col("_tp")).alias("fn"),
        F.col("_tp").alias("tp"),
    )
    return with_rates(counts)


def best_model(metrics: DataFrame, metric: str = "roc_auc",
               order: Sequence[str] = ()) -> DataFrame:
    """The row with the largest metric; the earlier model wins a tie.

    ``order`` lists models in order of preference; others follow by name.
    """
    if metric not in metrics.columns:
        raise ValueError(f"unknown metric: {metric}")
    return metrics.filter(F.col(metric).isNotNull()).orderBy(*_preference(metric, order)).limit(1)


def _preference(metric: str, order: Sequence[str]) -> list[Column]:
    places = [F.when(F.col("model") == name, i) for i, name in enumerate(order)]
    place = [F.coalesce(*places, F.lit(len(order)))] if places else []
    return [F.col(metric).desc_nulls_last(), *place, F.col("model")]


def evaluation_summary(metrics: DataFrame, primary: str = "roc_auc",
                       order: Sequence[str] = ()) -> DataFrame:
    """Per model: test size, its metrics, and whether it is the best one.

    The window runs over one row per model.
    """
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*_preference(primary, order)))
    sized = metrics.withColumn("test_size", F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp"))
    return sized.withColumn("is_best", (place == 1) & F.col(primary).isNotNull())


def calibration(scored: DataFrame, label: str = "label", score: str = "probability",
                bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean predicted against actual rate per equal-width probability bin."""
    bin_no = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(*by, bin_no.alias("bin")).agg(
        F.count("*").alias("rows"),
        F.avg(score).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("actual_rate"),
    )


def cost_curve(scored: DataFrame, cost_fp: float, cost_fn: float, label: str = "label",
               score: str = "probability", by: Sequence[str] = ()) -> DataFrame:
    """Cost of calling everything at or above each score positive."""
    counts = ranked_counts(scored, label, score, by)
    missed = F.col("positives") - F.col("tp")
    return counts.select(
        *by,
        F.col("score").alias("threshold"),
        (F.col("fp") * F.lit(float(cost_fp)) + missed * F.lit(float(cost_fn))).alias("cost"),
    )


def cost_threshold(scored: DataFrame, cost_fp: float, cost_fn: float, label: str = "label",
                   score: str = "probability", by: Sequence[str] = ()) -> DataFrame:
    """Cheapest threshold per group; the highest one among equal costs."""
    curve = cost_curve(scored, cost_fp, cost_fn, label, score, by)
    best = F.min(F.struct(F.col("cost"), (-F.col("threshold")).alias("neg")))
    return curve.groupBy(*by).agg(best.alias("b")).select(
        *by, (-F.col("b.neg")).alias("threshold"), F.col("b.cost").alias("cost")
    )
