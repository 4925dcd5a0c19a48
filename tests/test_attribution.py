"""Tree and coalition attributions against enumeration, and the stacked search against single fits."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintage.operators import attribution, explain, score, stacked, train

FEATURES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    x[:, 4] = np.round(x[:, 4])
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.7 * rng.normal(size=400) > 0.4).astype(int)
    found = spark.createDataFrame([(k, *map(float, v), int(t)) for k, (v, t) in enumerate(zip(x, y, strict=True))], "id long, a double, b double, c double, d double, e double, label int")
    return found.persist()


def known_value(nodes, tree, at, x, known):
    """A tree's mean where only some features are known: others go both ways by the training rows."""
    r = nodes[tree, at]
    if r["left"] < 0:
        return r["value"]
    if r["feature"] in known:
        return known_value(nodes, tree, r["left"] if x[r["feature"]] <= r["threshold"] else r["right"], x, known)
    return sum(nodes[tree, c]["cover"] / r["cover"] * known_value(nodes, tree, c, x, known) for c in (r["left"], r["right"]))


@pytest.mark.parametrize("name", ["random_forest", "gradient_boosting"])
def test_tree_attribution_equals_enumeration(rows, name):
    model = train.fit(rows, name, FEATURES, params={"n_estimators": 4, "max_depth": 4}, key=["id"])
    some = rows.where("id < 12")
    got = attribution.tree_attribution(model, some, ["id"]).collect()
    nodes = {(r["tree"], r["node"]): r.asDict() for r in attribution.node_table(model).collect()}
    trees = {t: n["weight"] for (t, k), n in nodes.items() if k == 0}
    own = {r["id"]: [r[c] for c in FEATURES] for r in some.collect()}
    scores = {r["id"]: r["probability"] for r in score.score(some, model, ["id"]).collect()}
    for key, x in own.items():
        worth = {s: sum(w * known_value(nodes, t, 0, x, s) for t, w in trees.items()) for k in range(6) for s in map(frozenset, itertools.combinations(range(5), k))}
        mine = {r["feature"]: r for r in got if r["id"] == key}
        for j, feature in enumerate(FEATURES):
            want = sum(
                math.factorial(len(s)) * math.factorial(4 - len(s)) / math.factorial(5) * (worth[s | {j}] - worth[s]) for s in worth if j not in s
            )
            assert mine[feature]["phi"] == pytest.approx(want, abs=1e-9)
        p = scores[key]
        value = math.log(p / (1 - p)) if name == "gradient_boosting" else p
        assert mine["a"]["value"] == pytest.approx(value, abs=1e-9)
        assert sum(r["phi"] for r in mine.values()) == pytest.approx(value - mine["a"]["base"], abs=1e-9)


def test_tree_attribution_of_few_rows(rows):
    model = train.fit(rows, "random_forest", FEATURES, params={"n_estimators": 2, "max_depth": 1}, key=["id"], fill=dict.fromkeys(FEATURES, 0.0))
    holes = rows.limit(3).withColumn("a", F.lit(None).cast("double"))
    assert attribution.tree_attribution(model, holes, ["id"]).where("phi IS NULL OR isnan(phi)").count() == 0
    assert attribution.tree_attribution(model, rows.limit(0), ["id"]).count() == 0


def test_coalitions_of_a_linear_model_are_its_closed_form(rows):
    model = train.fit(rows, "logistic_regression", FEATURES, key=["id"])
    some, pool = rows.where("id < 8"), rows.where("id >= 380")
    want = {(r["id"], r["feature"]): r["phi"] for r in explain.explain_linear(model, some, pool, ["id"]).collect()}
    for most in (attribution.ALL_COALITIONS, 24):
        got = attribution.coalition_attribution(model, some, pool, ["id"], most=most, output="log_odds").collect()
        assert {(r["id"], r["feature"]): r["phi"] for r in got} == pytest.approx(want, abs=1e-6)


def test_coalitions_agree_with_trees(rows):
    model = train.fit(rows, "random_forest", FEATURES, params={"n_estimators": 10, "max_depth": 4}, key=["id"])
    some = rows.where("id < 40")
    exact = {(r["id"], r["feature"]): r["phi"] for r in attribution.tree_attribution(model, some, ["id"]).collect()}
    found = attribution.coalition_attribution(model, some, rows, ["id"], draws=100).collect()
    assert all(abs(sum(r["phi"] for r in found if r["id"] == k) - next(r["value"] - r["base"] for r in found if r["id"] == k)) < 1e-9 for k in range(40))
    pairs = np.array([(r["phi"], exact[r["id"], r["feature"]]) for r in found])
    assert np.corrcoef(pairs.T)[0, 1] > 0.95 and np.abs(pairs[:, 0] - pairs[:, 1]).mean() < 0.03


def test_solver_is_exact_on_any_game():
    rng = np.random.default_rng(0)
    z, weight = attribution.coalitions(4)
    worth = {tuple(s): rng.normal() for s in itertools.product((0, 1), repeat=4)}
    phi = attribution.coalition_solver(z, weight) @ np.array([worth[0, 0, 0, 0], *(worth[tuple(s)] for s in z), worth[1, 1, 1, 1]])
    for j in range(4):
        want = sum(
            math.factorial(sum(s)) * math.factorial(3 - sum(s)) / 24 * (worth[tuple(1 if k == j else v for k, v in enumerate(s))] - worth[s]) for s in worth if not s[j]
        )
        assert phi[j] == pytest.approx(want)


def test_stacked_search_equals_single_fits(rows):
    grid = [0.01, 1.0, 100.0]
    together = train.search(rows, "logistic_regression", FEATURES, ["id"], candidates=[{"C": c} for c in grid], k=3).collect()
    single = train.search(rows, "logistic_regression", FEATURES, ["id"], candidates=[{"C": c, "max_iter": 1000} for c in grid], k=3).collect()
    key = lambda r: (r["candidate"], r["fold"])
    for a, b in zip(sorted(together, key=key), sorted(single, key=key), strict=True):
        assert (a["test_score"], a["train_score"]) == pytest.approx((b["test_score"], b["train_score"]), abs=1e-3)


def test_stacked_weights_are_the_minimum(rows):
    folded = rows.select(*FEATURES, F.lit(2.5).alias("flat"), F.col("label").cast("double").alias("label"), (F.col("id") % 3).cast("int").alias("fold")).persist()
    features = [*FEATURES, "flat"]
    stack = stacked.fit_stack(folded.repartition(5), features, "label", [0.01, 10.0, 1e6], 3)
    assert stack.passes <= 15
    data = folded.toPandas()
    for c, penalty in enumerate(stack.penalties):
        for f in range(3):
            own = data[data.fold != f]
            x, y = own[features].to_numpy(), own.label.to_numpy()
            std = np.where(x.std(0, ddof=1) > 1e-12, x.std(0, ddof=1), np.inf)
            design = np.c_[np.ones(len(y)), (x - x.mean(0)) / std]
            cost = len(y) / (2 * np.bincount(y.astype(int))[y.astype(int)])
            w = stack.weights[c, f]
            slope = design.T @ (cost * (1 / (1 + np.exp(-design @ w)) - y)) + np.r_[0, w[1:]] / penalty
            assert np.abs(slope).max() < 1e-5
            assert w[-1] == 0
    with pytest.raises(ValueError):
        stacked.fit_stack(folded.where("label = 1"), features, "label", [1.0], 3)


def test_tree_attribution_works_out_each_leaf_once_for_many_rows(rows, monkeypatch):
    model = train.fit(rows, "random_forest", FEATURES, params={"n_estimators": 3, "max_depth": 5}, key=["id"])
    trees = attribution.tree_bundles([r.asDict() for r in attribution.node_table(model).collect()])
    x = np.random.default_rng(1).normal(size=(1000, 5))
    x[0, 0], x[1, 1] = np.nan, -np.inf
    few = [attribution.shapley_of_trees(x[k : k + 1], trees) for k in range(40)]
    worked, parts = [], attribution.shapley_parts
    monkeypatch.setattr(attribution, "shapley_parts", lambda inside, share: worked.append(np.broadcast(inside, share).size) or parts(inside, share))
    phi, value = attribution.shapley_of_trees(x[2:], trees)
    once = sum(worked)
    attribution.shapley_of_trees(np.concatenate([x[2:]] * 8), trees)
    assert sum(worked) == 2 * once
    everything = attribution.shapley_of_trees(x, trees)
    assert np.allclose(everything[0][:40], np.concatenate([p for p, _ in few]), atol=1e-12)
    assert np.allclose(everything[1][:40], np.concatenate([v for _, v in few]), atol=1e-12)
    assert np.allclose(everything[0][2:], phi, atol=1e-15) and np.allclose(everything[1][2:], value, atol=1e-15)
