"""Metrics against brute force and published confusion matrices."""

import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from vintage.functions import ordering
from vintage.operators import evaluate


@pytest.fixture(params=["one task", "bucketed"])
def route(request, monkeypatch):
    if request.param == "bucketed":
        monkeypatch.setattr(ordering, "SINGLE_TASK_ROWS", 0)
    return request.param


def brute_auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(pairs):
    total, recall, out = sum(y for _, y in pairs), 0.0, 0.0
    for t in sorted({s for s, _ in pairs}, reverse=True):
        chosen = [y for s, y in pairs if s >= t]
        out += (sum(chosen) / total - recall) * sum(chosen) / len(chosen)
        recall = sum(chosen) / total
    return out


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(3)
    return [(round(rng.random(), 1 + i % 3), int(rng.random() < 0.4)) for i in range(600)]


@pytest.fixture(scope="module")
def scored(spark, pairs):
    rows = [("m", s, y, int(s >= 0.5)) for s, y in pairs] + [("flat", 0.5, y, 1) for _, y in pairs]
    rows += [(None, 1 - s, y, 0) for s, y in pairs]
    return spark.createDataFrame(rows, "model string, probability double, label int, prediction int")


def test_worked_example(spark, route):
    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.7, 0), (0.1, 1)]
    row = evaluate.ranking_metrics(spark.createDataFrame(rows, "probability double, label int")).head()
    assert row.roc_auc == pytest.approx(7 / 12)
    assert row.average_precision == pytest.approx(0.7555555555555555)


def test_areas_equal_brute_force(scored, pairs, route):
    got = {r.model: r for r in evaluate.ranking_metrics(scored, by=["model"]).collect()}
    assert got["m"].roc_auc == pytest.approx(brute_auc(pairs))
    assert got["m"].average_precision == pytest.approx(brute_ap(pairs))
    assert got["flat"].roc_auc == pytest.approx(0.5)
    assert got[None].roc_auc == pytest.approx(1 - brute_auc(pairs))


def test_area_equals_the_exact_spark_evaluator(scored, route):
    one = scored.filter("model = 'm'")
    spark_area = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0).evaluate(
        one.withColumn("label", F.col("label").cast("double"))
    )
    assert evaluate.ranking_metrics(one).head().roc_auc == pytest.approx(spark_area)


def test_one_class_only_has_no_area(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "probability double, label int")
    row = evaluate.ranking_metrics(df).head()
    assert row.roc_auc is None and row.average_precision == pytest.approx(1.0)


def test_curves(spark, route):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0)], "probability double, label int")
    roc = sorted(tuple(r) for r in evaluate.roc_curve(df).collect())
    assert roc == [(0.0, 0.0, math.inf), (0.0, 0.5, 0.9), (0.5, 1.0, 0.8), (1.0, 1.0, 0.1)]
    pr = {r.threshold: (r.precision, r.recall) for r in evaluate.pr_curve(df).collect()}
    assert pr == {0.9: (1.0, 0.5), 0.8: (pytest.approx(2 / 3), 1.0), 0.1: (0.5, 1.0), None: (1.0, 0.0)}


def test_roc_points_integrate_to_the_area(scored, pairs):
    points = sorted((r.fpr, r.tpr) for r in evaluate.roc_curve(scored.filter("model = 'm'")).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(brute_auc(pairs))


# tn, fp, fn, tp and precision, recall, f1, tpr, fpr, tnr, fnr as published.
PUBLISHED = {
    "logistic_regression": (885, 60, 21, 240, 0.8, 0.9195402298850575, 0.8556149732620321),
    "random_forest": (892, 53, 22, 239, 0.8184931506849316, 0.9157088122605364, 0.864376130198915),
    "xgboost": (895, 50, 29, 232, 0.8226950354609929, 0.8888888888888888, 0.85451197053407),
}


def test_published_matrices_give_the_published_rates(spark):
    rows = [(m, *v[:4]) for m, v in PUBLISHED.items()]
    got = evaluate.with_rates(spark.createDataFrame(rows, "model string, tn long, fp long, fn long, tp long"))
    for r in got.collect():
        tn, fp, fn, tp, precision, recall, f1 = PUBLISHED[r.model]
        assert (r.precision, r.recall, r.f1_score) == pytest.approx((precision, recall, f1), abs=1e-12)
        assert r.true_positive_rate == r.recall
        assert r.false_positive_rate == pytest.approx(fp / (fp + tn))
        assert r.true_negative_rate + r.false_positive_rate == pytest.approx(1)
        assert r.false_negative_rate + r.true_positive_rate == pytest.approx(1)


def test_rates_are_zero_where_undefined(spark):
    row = evaluate.with_rates(spark.createDataFrame([(0, 0, 0, 0)], "tn long, fp long, fn long, tp long")).head()
    assert all(row[c] == 0.0 for c in evaluate.RATES)


def test_evaluate_joins_both_kinds_of_metric(scored, route):
    apart = {r.model: r for r in evaluate.threshold_metrics(scored, by=["model"]).collect()}
    for r in evaluate.evaluate(scored).collect():
        assert [r[c] for c in ("tn", "fp", "fn", "tp", *evaluate.RATES)] == pytest.approx(
            [apart[r.model][c] for c in ("tn", "fp", "fn", "tp", *evaluate.RATES)]
        )


def test_classification_report(spark):
    rows = [(0, 0)] * 6 + [(0, 1)] * 2 + [(1, 0)] + [(1, 1)] * 3
    df = spark.createDataFrame(rows, "label int, prediction int")
    got = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert got["1"].precision == pytest.approx(0.6) and got["1"].support == 4
    assert got["0"].recall == pytest.approx(0.75)
    assert got["accuracy"].precision == pytest.approx(0.75)
    assert got["macro avg"].recall == pytest.approx(0.75)
    assert got["weighted avg"].precision == pytest.approx((6 / 7 * 8 + 0.6 * 4) / 12)


def test_best_model_first_wins_ties(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", None)], "model string, roc_auc double")
    assert evaluate.best_model(df, order=["b", "a"]).head().model == "b"
    assert evaluate.best_model(df).head().model == "a"
    with pytest.raises(ValueError):
        evaluate.best_model(df, "speed")


def test_calibration_puts_one_into_the_last_bin(spark):
    df = spark.createDataFrame([(1.0, 1), (0.95, 0), (0.0, 0)], "probability double, label int")
    got = {r.bin: (r.rows, r.actual_rate) for r in evaluate.calibration(df).collect()}
    assert got == {9: (2, 0.5), 0: (1, 0.0)}


def test_cost_threshold(spark, route):
    df = spark.createDataFrame([(0.9, 1), (0.6, 0), (0.5, 1), (0.2, 0)], "probability double, label int")
    assert tuple(evaluate.cost_threshold(df, 1, 10).head()) == (0.5, 1.0)
    assert tuple(evaluate.cost_threshold(df, 10, 1).head()) == (0.9, 1.0)
