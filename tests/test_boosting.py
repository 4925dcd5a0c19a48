"""Second-order boosting against a plain version, on both routes, and its model on disk."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from vintage.operators import boosting, score, train

FEATURES = ["a", "b", "c"]


def table(spark, n=500, seed=5, skew=False):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)) * 4)
    if skew:
        x[: n // 3] = x[0]
    y = (x[:, 0] + x[:, 1] * (x[:, 2] > 0) + rng.normal(size=n) > 1).astype(int)
    w = np.where(y == 1, 2.5, 1.0)
    rows = [(k, *map(float, v), int(t), float(u)) for k, (v, t, u) in enumerate(zip(x, y, w, strict=True))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label int, weight double")
    return df, x, y, w


def vectors(df):
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def plain(x, y, w, trees, depth, rate, gamma, least, ridge=1.0):
    """Margins of all rows, every value a threshold, by direct sums."""
    margin = np.zeros(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)

        def worth(m):
            return g[m].sum() ** 2 / (h[m].sum() + ridge)

        def split(m, level):
            best = None
            if level < depth:
                for f in range(x.shape[1]):
                    for at in np.unique(x[m, f]):
                        left, right = m & (x[:, f] <= at), m & (x[:, f] > at)
                        if not left.any() or not right.any() or min(h[left].sum(), h[right].sum()) < least:
                            continue
                        gain = worth(left) + worth(right) - worth(m)
                        if best is None or gain > best[0] + 1e-9:
                            best = (gain, left, right)
            if best is None or best[0] < max(gamma, 1e-9):
                margin[m] += -rate * g[m].sum() / (h[m].sum() + ridge)
                return
            split(best[1], level + 1)
            split(best[2], level + 1)

        split(np.ones(len(y), bool), 0)
    return margin


def margins(model, df):
    got = score.score(vectors(df), PipelineModel(stages=[model]), ["id"]).collect()
    return [math.log(r["probability"] / (1 - r["probability"])) for r in sorted(got, key=lambda r: r["id"])]


@pytest.mark.parametrize("options", [
    {"max_depth": 3, "learning_rate": 0.3},
    {"max_depth": 2, "gamma": 5.0},
    {"max_depth": 4, "min_child_weight": 12.0},
])
@pytest.mark.parametrize("blocks", ["one task", "passes", "shuffled"])
def test_equals_plain_boosting(spark, monkeypatch, options, blocks):
    if blocks != "one task":
        monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
        monkeypatch.setattr(boosting, "REFRESH", 2)
    if blocks == "shuffled":
        monkeypatch.setattr(boosting, "DIRECT_TASKS", 0)
    df, x, y, w = table(spark, 300)
    n = 5 if blocks == "passes" else 3
    model = boosting.BoostedTrees(n_estimators=n, **options).fit(vectors(df.repartition(3)))
    full = {"learning_rate": 0.1, "gamma": 0.0, "min_child_weight": 1.0, **options}
    want = plain(x, y, w, n, full["max_depth"], full["learning_rate"], full["gamma"], full["min_child_weight"])
    assert margins(model, df) == pytest.approx(list(want), abs=1e-6)


def test_both_routes_and_any_layout_give_the_same_trees(spark, monkeypatch):
    df = vectors(table(spark, 400, skew=True)[0])
    once = boosting.BoostedTrees(n_estimators=4, colsample_bytree=0.7).fit(df.coalesce(1))
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
    again = boosting.BoostedTrees(n_estimators=4, colsample_bytree=0.7).fit(df.repartition(5))
    monkeypatch.setattr(boosting, "DIRECT_TASKS", 0)
    shuffled = boosting.BoostedTrees(n_estimators=4, colsample_bytree=0.7).fit(df.repartition(4))
    keep = [(t.feature, t.threshold, t.left) for t in once.fitted()]
    for other in (again, shuffled):
        assert [(t.feature, t.threshold, t.left) for t in other.fitted()] == keep
        for a, b in zip(once.fitted(), other.fitted(), strict=True):
            assert a.value == pytest.approx(b.value, abs=1e-9)


def test_row_and_column_sampling(spark):
    df = vectors(table(spark, 400)[0]).coalesce(1)
    model = boosting.BoostedTrees(n_estimators=12, max_depth=2, colsample_bytree=0.34, subsample=0.5).fit(df)
    trees = model.fitted()
    assert all(len({t.feature[n] for n in range(len(t.left)) if t.left[n] >= 0}) <= 1 for t in trees)
    assert len({t.feature[0] for t in trees}) == 3
    whole = boosting.BoostedTrees(n_estimators=1).fit(df).fitted()[0].cover[0]
    assert 0.35 * whole < trees[0].cover[0] < 0.65 * whole
    again = boosting.BoostedTrees(n_estimators=12, max_depth=2, colsample_bytree=0.34, subsample=0.5).fit(df)
    assert again.fitted() == trees


def test_one_class_empty_table_and_clashing_names(spark):
    df, *_ = table(spark, 60)
    one = boosting.BoostedTrees(n_estimators=3).fit(vectors(df.withColumn("label", F.lit(1))))
    assert min(margins(one, df)) > 0
    none = boosting.BoostedTrees(n_estimators=3).fit(vectors(df.limit(0)))
    assert margins(none, df.limit(2)) == [0.0, 0.0]
    odd = one.transform(vectors(df.withColumn("_margin", F.lit("mine"))))
    assert odd.where("_margin = 'mine' AND prediction = 1").count() == 60
    assert one.transform(vectors(df.limit(0))).count() == 0


def test_saved_pipeline_scores_alike(spark, tmp_path):
    df, *_ = table(spark, 200)
    model = train.fit(df, "gradient_boosting", FEATURES, params={"n_estimators": 3, "gamma": 0.1, "colsample_bytree": 0.9}, key=["id"], fill={"a": 0.0})
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    holes = df.withColumn("a", F.when(F.col("id") % 7 != 0, F.col("a")))
    assert sorted(score.score(holes, loaded, ["id"]).collect()) == sorted(score.score(holes, model, ["id"]).collect())


def test_gain_importance(spark):
    df, *_ = table(spark, 400)
    flat = df.withColumn("c", F.lit(1.0))
    model = boosting.BoostedTrees(n_estimators=5).fit(vectors(flat))
    got = {r["feature"]: r for r in boosting.gain_importance(spark, model, FEATURES).collect()}
    assert got["c"]["splits"] == 0 and got["c"]["share"] == 0
    assert sum(r["share"] for r in got.values()) == pytest.approx(1)
    assert got["a"]["total_gain"] == pytest.approx(got["a"]["mean_gain"] * got["a"]["splits"])


def test_passes_use_a_task_for_each_block_however_few_made_them(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    df = vectors(table(spark, 800)[0])
    seen, level = [], boosting.level_of_table
    monkeypatch.setattr(boosting, "level_of_table", lambda state, tasks, *a: seen.append(state.select("block").distinct().count() / tasks) or level(state, tasks, *a))
    try:
        fits = [boosting.BoostedTrees(n_estimators=1, max_depth=2).fit(df.coalesce(n)).fitted() for n in (1, 3)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert fits[0] == fits[1]
    assert max(seen) <= 3


def test_descend_follows_the_nodes(spark):
    tree = boosting.Tree(feature=[1, 0, 0, 0, 0], threshold=[0.0, 1.0, 0.0, 0.0, 0.0], left=[1, 3, -1, -1, -1], right=[2, 4, -1, -1, -1])
    x = np.array([[0.0, -1.0], [2.0, -1.0], [0.0, 1.0], [np.nan, 0.0], [1.0, np.nan]])
    assert tree.descend(x, tree.threshold).tolist() == [3, 4, 2, 4, 2]
    assert boosting.Tree(feature=[0], threshold=[0.0], left=[-1], right=[-1]).descend(x, [0.0]).tolist() == [0] * 5
    assert tree.descend(x[:0], tree.threshold).tolist() == []
