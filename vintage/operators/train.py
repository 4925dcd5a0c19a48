"""Weighted classifiers, stratified folds and hyperparameter search."""

from __future__ import annotations

import itertools
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.functions.ordering import exact_quantiles, hash_rank
from vintage.operators import stacked
from vintage.operators.boosting import BoostedTrees
from vintage.operators.evaluate import evaluate
from vintage.operators.score import positive_probability
from vintage.sources.tables import use_shared_checkpoints

# --- fixed values: parameter grids and defaults of the published runs --------
GRIDS: dict[str, dict[str, list]] = {
    "logistic_regression": {
        "C": [0.01, 0.1, 1.0, 10.0, 100.0],
    },
    "random_forest": {
        "n_estimators": [50, 100, 200],
        "max_depth": [5, 10, 15, 20, None],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
        "max_features": ["sqrt", "log2", None],
    },
    "gradient_boosting": {
        "n_estimators": [50, 100, 200],
        "max_depth": [3, 4, 5, 6, 7],
        "learning_rate": [0.01, 0.05, 0.1, 0.2],
        "gamma": [0, 0.1, 0.5, 1.0],
        "min_child_weight": [1, 3, 5],
        "subsample": [0.8, 0.9, 1.0],
        "colsample_bytree": [0.8, 0.9, 1.0],
    },
}
DEFAULTS: dict[str, dict[str, Any]] = {
    "logistic_regression": {"C": 1.0, "max_iter": 1000},
    "random_forest": {"n_estimators": 100, "max_depth": 10},
    "gradient_boosting": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1},
}
# --- end of fixed values ------------------------------------------------------

MODELS = tuple(DEFAULTS)
SCORING = {"roc_auc": "roc_auc", "precision": "precision", "recall": "recall", "f1": "f1_score"}
MAX_DEPTH = 30
#: Parameters of the grids that Spark's learners have no counterpart of.
UNMAPPED = frozenset({"min_samples_split"})


#: Fits read a partition for so many rows and LEAST_PARTITIONS at least, unless told otherwise. Bagging is
#: seeded by partition, and the number follows from the rows alone, so equal rows give an equal model.
PARTITION_ROWS = 200_000
LEAST_PARTITIONS = 2


def partitions_of(rows: int) -> int:
    return max(LEAST_PARTITIONS, -(-rows // PARTITION_ROWS))


def dealt(df: DataFrame, key: Sequence[str], partitions: int) -> DataFrame:
    """Rows dealt by key and in its order, whatever files they came from."""
    return df.repartition(partitions, *key).sortWithinPartitions(*key)


def class_counts(df: DataFrame, label: str) -> tuple[int, int]:
    """Negative and positive rows."""
    row = df.agg(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).head()
    return row[0], row[1]


def balanced_weight(label: str, negatives: int, positives: int) -> Column:
    """n / (2 * n_class) for each row."""
    n = negatives + positives
    return F.when(F.col(label) == 1, n / (2 * positives) if positives else 1.0).otherwise(
        n / (2 * negatives) if negatives else 1.0
    )


def positive_weight(label: str, negatives: int, positives: int) -> Column:
    """negatives / positives for positive rows, 1 for the others."""
    return F.when(F.col(label) == 1, negatives / positives if positives else 1.0).otherwise(1.0)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Both weightings per class, as a table."""
    y = F.col(label)
    neg, pos = F.count_if(y == 0), F.count_if(y == 1)
    n = (neg + pos).cast("double")

    def line(value, rows, scale):
        return F.struct(
            F.lit(value).alias("label"),
            rows.alias("rows"),
            F.try_divide(n, 2 * rows).alias("balanced_weight"),
            scale.alias("positive_weight"),
        )

    scale = F.try_divide(neg.cast("double"), pos.cast("double"))
    lines = F.array(line(0, neg, F.lit(1.0)), line(1, pos, scale))
    return df.agg(lines.alias("_l")).select(F.inline("_l"))


def estimator(name: str, features: Sequence[str], rows: int, params: Mapping[str, Any] | None = None,
              label: str = "label", weight: str = "_weight", seed: int = 42,
              fill: Mapping[str, float] | None = None) -> Pipeline:
    """Unfitted pipeline for one of MODELS.

    ``fill`` puts a value in place of a feature's NULLs, in a stage of its own that is
    saved with the model. ``rows`` is the number of training rows: with balanced weights their sum,
    which turns the inverse penalty C into Spark's averaged-loss penalty.
    """
    if name not in DEFAULTS:
        raise ValueError(f"unknown model: {name}")
    p = {**DEFAULTS[name], **(params or {})}
    stages: list = [filling(fill)] if fill else []
    stages.append(VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error"))
    common = {"labelCol": label, "weightCol": weight}
    if name == "logistic_regression":
        stages.append(StandardScaler(inputCol="features", outputCol="scaled", withMean=True))
        stages.append(
            LogisticRegression(
                featuresCol="scaled",
                elasticNetParam=0.0,
                regParam=1.0 / (p["C"] * max(rows, 1)),
                maxIter=p["max_iter"],
                standardization=False,
                **common,
            )
        )
    elif name == "random_forest":
        stages.append(
            RandomForestClassifier(
                numTrees=p["n_estimators"],
                maxDepth=MAX_DEPTH if p["max_depth"] is None else p["max_depth"],
                minInstancesPerNode=p.get("min_samples_leaf", 1),
                featureSubsetStrategy=p.get("max_features", "sqrt") or "all",
                seed=seed,
                **common,
            )
        )
    else:
        stages.append(BoostedTrees(seed=seed, **common, **p))
    return Pipeline(stages=stages)


def medians(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Median of each feature for ``fill``; 0 where it has no value at all."""
    found = exact_quantiles(df, features, [0.5])
    return {c: float(found[c][0]) if found[c] else 0.0 for c in features}


def filling(fill: Mapping[str, float]) -> SQLTransformer:
    filled = ", ".join(f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {v!r}D) AS `{c}`" for c, v in fill.items())
    return SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(f'`{c}`' for c in fill)}), {filled} FROM __THIS__")


def weight_for(name: str, label: str, negatives: int, positives: int) -> Column:
    rule = positive_weight if name == "gradient_boosting" else balanced_weight
    return rule(label, negatives, positives)


def fit(df: DataFrame, name: str, features: Sequence[str], label: str = "label",
        params: Mapping[str, Any] | None = None, seed: int = 42,
        counts: tuple[int, int] | None = None, key: Sequence[str] | None = None,
        partitions: int | None = 0, fill: Mapping[str, float] | None = None) -> PipelineModel:
    """Fit one model with its class weighting.

    Rows are dealt to ``partitions`` (0: as many as they fill) by ``key`` (or else by all
    they hold), so the same rows give the same model on any file layout; None takes them
    as they lie.
    """
    use_shared_checkpoints(df.sparkSession)
    neg, pos = counts or class_counts(df, label)
    rows = df if partitions is None else dealt(df, key or [*features, label], partitions or partitions_of(neg + pos))
    weighted = rows.withColumn("_weight", weight_for(name, label, neg, pos))
    return estimator(name, features, neg + pos, params, label, seed=seed, fill=fill).fit(weighted)


def stratified_folds(df: DataFrame, label: str, key: Sequence[str], k: int = 5,
                     seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold 0..k-1 per row; within each class fold sizes differ by at most one."""
    ranked = hash_rank(df, key, by=[label], seed=seed, out=out)
    return ranked.withColumn(out, ((F.col(out) - 1) % k).cast("int"))


def grid_candidates(grid: Mapping[str, Sequence]) -> list[dict[str, Any]]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def random_candidates(grid: Mapping[str, Sequence], n_iter: int = 20,
                      seed: int = 42) -> list[dict[str, Any]]:
    """Grid points that give distinct fits; all of them when the grid is smaller.

    Points that differ only in parameters without a counterpart here are one.
    """
    distinct = {tuple((k, v) for k, v in p.items() if k not in UNMAPPED): p for p in reversed(grid_candidates(grid))}
    points = list(distinct.values())[::-1]
    return random.Random(seed).sample(points, min(n_iter, len(points)))


def search(df: DataFrame, name: str, features: Sequence[str], key: Sequence[str],
           label: str = "label", candidates: Sequence[Mapping[str, Any]] | None = None,
           k: int = 5, scoring: str = "roc_auc", parallelism: int = 4, seed: int = 42,
           partitions: int = 0, fill: Mapping[str, float] | None = None) -> DataFrame:
    """Cross-validated score per candidate and fold, on both sides of the fold.

    Logistic candidates are fitted and scored together, one pass over the rows per step
    (stacked.fit_stack). Otherwise each fit is a distributed Spark job: a candidate's folds are fitted and evaluated by
    one of ``parallelism`` threads, which then lets its models go: the driver holds that
    many candidates at once, and one number per side of the others.
    """
    if scoring not in SCORING:
        raise ValueError(f"unknown scoring metric: {scoring}")
    metric = SCORING[scoring]
    candidates = list(candidates or grid_candidates(GRIDS[name]))
    numbered = dealt(stratified_folds(df, label, key, k, seed), key, partitions or partitions_of(df.count()))
    folded = numbered.select(
        *[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias(label), "fold"
    )
    folded = folded.persist(StorageLevel.MEMORY_AND_DISK)
    sizes = {
        (r["fold"], int(r[label])): r["count"] for r in folded.groupBy("fold", label).count().collect()
    }

    def train_counts(fold):
        return tuple(sum(n for (f, y), n in sizes.items() if f != fold and y == side) for side in (0, 1))

    def run_one(i):
        parts = []
        for fold in range(k):
            rows = folded.filter(F.col("fold") != fold)
            model = fit(rows, name, features, label, candidates[i], seed, train_counts(fold), partitions=None, fill=fill)
            side = F.when(F.col("fold") == fold, "test").otherwise("train")
            scored = model.transform(folded).select(
                F.lit(fold).alias("held_out"), side.alias("side"), label, "prediction",
                positive_probability().alias("probability"),
            )
            parts.append(scored)
        scores = evaluate(reduce(DataFrame.unionByName, parts), label, by=["held_out", "side"])
        found = {(r["held_out"], r["side"]): r[metric] for r in scores.collect()}
        params = str(dict(candidates[i]))
        return [(i, params, f, found.get((f, "test")), found.get((f, "train"))) for f in range(k)]

    def run_stack():
        numeric = folded.select(*[F.coalesce(F.nanvl(c, F.lit(None).cast("double")), F.lit((fill or {}).get(c)).cast("double")).alias(c) for c in features], label, "fold")
        stack = stacked.fit_stack(numeric, features, label, [{**DEFAULTS[name], **c}["C"] for c in candidates], k)
        side = F.when(F.col("fold") == F.col("held_out"), "test").otherwise("train").alias("side")
        scored = numeric.select(label, "fold", F.inline(stack.probability(features)))
        scored = scored.select("candidate", "held_out", side, label, (F.col("probability") > 0.5).cast("double").alias("prediction"), "probability")
        found = {(r["candidate"], r["held_out"], r["side"]): r[metric] for r in evaluate(scored, label, by=["candidate", "held_out", "side"]).collect()}
        return [(i, str(dict(c)), f, found.get((i, f, "test")), found.get((i, f, "train"))) for i, c in enumerate(candidates) for f in range(k)]

    both = all(0 < train_counts(fold)[side] for fold in range(k) for side in (0, 1))
    try:
        if name == "logistic_regression" and both and all(set(c) <= {"C"} for c in candidates):
            rows = run_stack()
        else:
            with ThreadPoolExecutor(parallelism) as pool:
                run = inheritable_thread_target(df.sparkSession)(run_one)
                rows = list(itertools.chain.from_iterable(pool.map(run, range(len(candidates)))))
    finally:
        folded.unpersist()
    return df.sparkSession.createDataFrame(
        rows, "candidate int, params string, fold int, test_score double, train_score double"
    ).withColumn("model", F.lit(name))


def search_table(scores: DataFrame) -> DataFrame:
    """Mean and deviation of the test score, mean train score, best first."""
    table = scores.groupBy("model", "candidate", "params").agg(
        F.avg("test_score").alias("mean_test_score"),
        F.stddev_pop("test_score").alias("std_test_score"),
        F.avg("train_score").alias("mean_train_score"),
        F.count("*").alias("folds"),
    )
    best = F.max(F.struct("mean_test_score", (-F.col("candidate")).alias("c")))
    winners = table.groupBy("model").agg(best.alias("_b"))
    return (
        table.join(winners, "model")
        .withColumn("is_best", F.col("candidate") == -F.col("_b.c"))
        .drop("_b")
        .orderBy("model", F.desc("mean_test_score"), "candidate")
    )


def tune(df: DataFrame, name: str, features: Sequence[str], key: Sequence[str],
         label: str = "label", method: str = "random", n_iter: int = 20, k: int = 5,
         scoring: str = "roc_auc", parallelism: int = 4, seed: int = 42,
         grid: Mapping[str, Sequence] | None = None, partitions: int = 0,
         fill: Mapping[str, float] | None = None) -> tuple[PipelineModel, DataFrame]:
    """Search, then refit the best candidate on all rows."""
    grid = grid or GRIDS[name]
    if method == "grid":
        candidates = grid_candidates(grid)
    elif method == "random":
        candidates = random_candidates(grid, n_iter, seed)
    else:
        raise ValueError(f"unknown method: {method}; use 'grid' or 'random'")
    scores = search(df, name, features, key, label, candidates, k, scoring, parallelism, seed, partitions, fill)
    table = search_table(scores)
    best = table.filter("is_best").head()
    model = fit(df, name, features, label, candidates[best["candidate"]], seed, key=key, partitions=partitions, fill=fill)
    return model, table


def tune_all(df: DataFrame, features: Sequence[str], key: Sequence[str], label: str = "label",
             models: Sequence[str] = MODELS, **options) -> dict[str, tuple[PipelineModel, DataFrame]]:
    return {m: tune(df, m, features, key, label, **options) for m in models}
