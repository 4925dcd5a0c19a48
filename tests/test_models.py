"""Training, search, scoring, attribution, saved models and composed jobs."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from vintage.operators import evaluate, explain, sample, score, train
from vintage.plans import jobs
from vintage.sources import tables
from vintage.streaming import requests as streams

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    out = []
    for i in range(400):
        a, b, c = rng.gauss(0, 1), rng.gauss(5, 3), rng.random()
        y = int(rng.random() < 1 / (1 + math.exp(-(2 * a - 0.4 * (b - 5) - 1))))
        out.append((i, a, b, c, y, "train" if i % 4 else "test"))
    df = spark.createDataFrame(out, "id long, a double, b double, c double, label int, split string")
    return df.coalesce(1).persist()


@pytest.fixture(scope="module")
def models(rows):
    small = {"random_forest": {"n_estimators": 5, "max_depth": 3}, "gradient_boosting": {"n_estimators": 3, "max_depth": 2}}
    return {m: train.fit(rows, m, FEATURES, params=small.get(m)) for m in train.MODELS}


def test_class_weights(rows):
    neg, pos = train.class_counts(rows, "label")
    got = {r.label: r for r in train.class_weights(rows, "label").collect()}
    assert got[0].balanced_weight == pytest.approx(400 / (2 * neg))
    assert got[1].balanced_weight == pytest.approx(400 / (2 * pos))
    assert got[1].positive_weight == pytest.approx(neg / pos)


def test_logistic_regression_minimises_the_same_objective(rows, models):
    """Newton steps on 0.5 |w|^2 + C * sum(weight * loss) reach the same weights."""
    data = np.array([[r.a, r.b, r.c, r.label] for r in rows.collect()])
    x, y = data[:, :3], data[:, 3]
    x = (x - x.mean(0)) / x.std(0, ddof=1)
    x = np.c_[x, np.ones(len(x))]
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    penalty = np.diag([1.0, 1.0, 1.0, 0.0])
    beta = np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        grad = x.T @ (w * (p - y)) + penalty @ beta
        beta -= np.linalg.solve((x.T * (w * p * (1 - p))) @ x + penalty, grad)
    fitted = models["logistic_regression"].stages[-1]
    assert list(fitted.coefficients.toArray()) + [fitted.intercept] == pytest.approx(list(beta), abs=1e-3)


def test_every_model_learns(rows, models):
    for name, model in models.items():
        scored = score.score(rows, model, ["label"])
        assert evaluate.ranking_metrics(scored).head().roc_auc > 0.75, name


def test_predict_uses_the_threshold(rows, models):
    out = score.predict(rows, models["logistic_regression"], ["id"], 0.3)
    assert out.filter("(probability >= 0.3) <> (prediction = 1)").count() == 0


def test_folds_are_stratified_and_stable(rows):
    folded = train.stratified_folds(rows, "label", ["id"], 5)
    sizes = [r["count"] for r in folded.groupBy("label", "fold").count().collect() if r["label"] == 1]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    again = train.stratified_folds(rows.repartition(6), "label", ["id"], 5)
    assert set(map(tuple, folded.select("id", "fold").collect())) == set(map(tuple, again.select("id", "fold").collect()))


def test_candidates():
    grid = {"p": [1, 2], "q": ["x", "y", "z"]}
    assert len(train.grid_candidates(grid)) == 6
    some = train.random_candidates(grid, 4)
    assert len({str(c) for c in some}) == 4 and some == train.random_candidates(grid, 4)
    assert len(train.random_candidates(grid, 20)) == 6
    assert len(train.grid_candidates(train.GRIDS["random_forest"])) == 3 * 5 * 3 * 3 * 3


def test_search_agrees_with_cross_validator(rows):
    scores = train.search(rows, "logistic_regression", FEATURES, ["id"], candidates=[{"C": 0.01}, {"C": 1.0}], k=3)
    table = train.search_table(scores)
    got = {r.candidate: r for r in table.collect()}
    assert sum(r.is_best for r in got.values()) == 1 and all(r.folds == 3 for r in got.values())
    folded = train.stratified_folds(rows, "label", ["id"], 3)
    neg, pos = train.class_counts(rows, "label")
    weighted = folded.withColumn("_weight", train.balanced_weight("label", neg, pos))
    pipeline = train.estimator("logistic_regression", FEATURES, 400 * 2 // 3, {"C": 1.0})
    lr = pipeline.getStages()[-1]
    cv = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=ParamGridBuilder().addGrid(lr.regParam, [1.5 / 400]).build(),
        evaluator=BinaryClassificationEvaluator(numBins=0),
        numFolds=3,
        foldCol="fold",
    ).fit(weighted.withColumn("label", F.col("label").cast("double")))
    assert got[1].mean_test_score == pytest.approx(cv.avgMetrics[0], abs=2e-3)


def test_search_rejects_unknown_names(rows):
    with pytest.raises(ValueError):
        train.search(rows, "logistic_regression", FEATURES, ["id"], scoring="speed")
    with pytest.raises(ValueError):
        train.tune(rows, "logistic_regression", FEATURES, ["id"], method="guess")
    with pytest.raises(ValueError):
        train.estimator("svm", FEATURES, 10)


def test_tune_refits_the_best(rows):
    model, table = train.tune(rows, "random_forest", FEATURES, ["id"], n_iter=2, k=2, scoring="f1",
                              grid={"n_estimators": [3], "max_depth": [1, 4], "max_features": ["sqrt"]})
    best = table.filter("is_best").head()
    assert str({"n_estimators": 3, "max_depth": model.stages[-1].getMaxDepth(), "max_features": "sqrt"}) == best.params


def test_saved_model_scores_the_same(rows, models, tmp_path):
    path = str(tmp_path / "m")
    tables.save_model(models["logistic_regression"], path)
    loaded = tables.load_model(path)
    assert tables.model_features(loaded) == FEATURES
    a = score.score(rows, models["logistic_regression"], ["id"]).orderBy("id").collect()
    assert a == score.score(rows, loaded, ["id"]).orderBy("id").collect()


def test_streamed_scores_equal_batch(spark, rows, models, tmp_path):
    source = str(tmp_path / "in")
    rows.withColumn("a", F.when(F.col("id") != 3, F.col("a"))).repartition(3).write.parquet(source)
    stream = streams.stream_table(spark, source, files_per_batch=1)
    out = streams.run_available(
        streams.score_stream(stream, models["logistic_regression"], FEATURES, ["id"]), str(tmp_path / "out"), mode="append"
    )
    want = score.predict(rows.filter("id <> 3"), models["logistic_regression"], ["id"])
    assert {tuple(r) for r in out.select(*want.columns).collect()} == {tuple(r) for r in want.collect()}


def test_linear_attribution_adds_up(rows, models):
    model = models["logistic_regression"]
    phi = explain.explain_linear(model, rows, rows.filter("id < 50"), ["id"])
    shares = phi.groupBy("id").agg(F.sum("phi").alias("s"), F.max("base").alias("base"))
    scored = score.score(rows, model, ["id"]).withColumn("z", F.log(F.col("probability") / (1 - F.col("probability"))))
    for r in shares.join(scored, "id").limit(50).collect():
        assert r.s + r.base == pytest.approx(r.z, abs=1e-9)


@pytest.mark.parametrize("name, output", [("random_forest", "probability"), ("gradient_boosting", "log_odds")])
def test_permutation_attribution_is_efficient(rows, models, name, output):
    explained = rows.filter("id < 20")
    shares = explain.permutation_attribution(models[name], explained, rows.select(*FEATURES), ["id"], 4, output=output)
    sums = shares.groupBy("id").agg(F.sum("phi").alias("s"), F.max("base").alias("b"), F.max("value").alias("v"))
    p = {r.id: r.probability for r in score.score(explained, models[name], ["id"]).collect()}
    got = sums.collect()
    assert len(got) == 20
    for r in got:
        want = p[r.id] if output == "probability" else math.log(p[r.id] / (1 - p[r.id]))
        assert r.v == pytest.approx(want, abs=1e-9)
        assert r.s == pytest.approx(r.v - r.b, abs=1e-9)


def test_permutation_attribution_of_a_linear_model(rows, models):
    """With one background row every order gives the closed form exactly."""
    model, pool = models["logistic_regression"], rows.filter("id = 7").select(*FEATURES)
    explained = rows.filter("id < 5")
    got = explain.permutation_attribution(model, explained, pool, ["id"], 2, output="log_odds")
    want = explain.explain_linear(model, explained, pool, ["id"])
    a = {(r.id, r.feature): r.phi for r in got.collect()}
    b = {(r.id, r.feature): r.phi for r in want.collect()}
    assert a == pytest.approx(b, abs=1e-9)
    with pytest.raises(ValueError):
        explain.permutation_attribution(model, explained, pool.limit(0), ["id"])


def test_importance_and_breakdown(spark):
    rows = [(1, "a", 3.0), (1, "b", -1.0), (1, "c", 0.5), (2, "a", -1.0), (2, "b", -1.0), (2, "c", 0.0)]
    phi = spark.createDataFrame(rows, "id int, feature string, phi double")
    table = explain.importance(phi).collect()
    assert [(r.feature, r.mean_abs, r["mean"], r["std"]) for r in table[:2]] == [("a", 2.0, 1.0, 2.0), ("b", 1.0, -1.0, 0.0)]
    parts = {(r.id, r.rank): (r.feature, r.phi) for r in explain.instance_breakdown(phi, ["id"], 1).collect()}
    assert parts == {(1, 1): ("a", 3.0), (1, 2): ("other", -0.5), (2, 1): ("a", -1.0), (2, 2): ("other", -1.0)}


def test_explain_all_stacks_models(rows, models):
    shares = explain.explain_all(models, rows, rows, ["id"], background_size=20, sample_size=6, permutations=2)
    counts = {r.model: r["count"] for r in shares.groupBy("model").count().collect()}
    assert counts == {m: 18 for m in models}
    assert explain.top_features(explain.importance(shares, ["model"]), 2).count() == 6
    with pytest.raises(ValueError):
        explain.explain_all({}, rows, rows, ["id"])


def test_random_rows_are_exact(rows):
    ids = {r.id for r in sample.random_rows(rows, ["id"], 25).collect()}
    assert len(ids) == 25 and ids == {r.id for r in sample.random_rows(rows.repartition(5), ["id"], 25).collect()}


def test_retrain_with_search(rows):
    result = jobs.retrain(rows, ["id"], "label", inputs=FEATURES, models=("logistic_regression",), n_iter=2, k=2)
    assert result["metrics"].head().roc_auc > 0.7
    assert result["best"].head().model == "logistic_regression"
    assert result["search"].count() == 2
    summary = result["summary"].head()
    assert summary.test_size == 100 and summary.is_best


def test_train_from_raw_and_score_applications(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        amount = rng.uniform(1000, 9000)
        bad = rng.random() < amount / 10000
        status = "Charged Off" if bad else "Fully Paid" if i % 10 else "Current"
        rows.append((i, status, f"{2015 + i // 100}-{1 + i % 12:02d}-01", amount, None if i % 7 == 0 else rng.random()))
    raw = spark.createDataFrame(rows, "id long, loan_status string, issue_d string, loan_amnt double, dti double")
    result = jobs.train_from_raw(raw, models=("logistic_regression",), tune=False)
    assert result["metrics"].head().roc_auc > 0.6
    assert "id" not in result["features"] and "issue_month" in result["features"]
    sides = {r.split: r for r in result["filled"].collect()}
    assert {r.filled for r in sides.values()} == {0}
    assert result["scored"].filter("model = 'logistic_regression'").count() == sides["test"].rows
    rules = [r for r in score.application_rules() if r.name in ("loan_amnt", "dti")]
    new = spark.createDataFrame(
        [(1, 5000.0, 0.5, "2020-05-01"), (2, -1.0, 0.5, "2020-05-01"), (3, 5000.0, 0.5, "soon")],
        "id int, loan_amnt double, dti double, issue_d string",
    )
    scored, rejected = jobs.score_applications(new, result["models"]["logistic_regression"], rules, ["id"])
    assert [r.id for r in scored.collect()] == [1]
    assert {r.id: r.violations for r in rejected.collect()} == {
        2: ["loan_amnt:min"], 3: ["issue_year:null", "issue_month:null"],
    }
