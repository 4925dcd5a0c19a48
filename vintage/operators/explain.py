"""Feature attribution of single predictions and of whole models."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import StandardScalerModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintage.functions.ordering import hash_rank
from vintage.operators.attribution import coalition_attribution, tree_attribution
from vintage.operators.sample import random_rows
from vintage.operators.score import positive_probability
from vintage.sources.tables import cut_lineage, model_features


# A background of up to this many numbers (16 MB) is sent to every executor.
BROADCAST_CELLS = 2_000_000
# Attribution rows that a task groups at once.
GROUPED_ROWS = 500_000
TREES = ("RandomForestClassificationModel", "BoostedTreesModel")


def linear_attribution(df: DataFrame, background: DataFrame, key: Sequence[str],
                       coefficients: Mapping[str, float],
                       scale: Mapping[str, float] | None = None,
                       means: Mapping[str, float] | None = None) -> DataFrame:
    """coefficient * (x - background mean) / scale, long form, in log-odds.

    The background means are one row; they become literals, not a join.
    """
    means = means or background.agg(*[F.avg(c).alias(c) for c in coefficients]).head()
    scale = scale or {}
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            (F.lit(float(w)) * (F.col(c).cast("double") - F.lit(means[c])) / F.lit(float(scale.get(c, 1.0)))).alias("phi"),
        )
        for c, w in coefficients.items()
        if scale.get(c, 1.0) != 0
    ]
    return df.select(*key, F.inline(F.array(*cells)))


def explain_linear(model: PipelineModel, df: DataFrame, background: DataFrame,
                   key: Sequence[str]) -> DataFrame:
    """Linear attribution with the weights and scales of a fitted pipeline.

    ``base`` is the log-odds of the mean background row.
    """
    features = model_features(model)
    scaler = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    fitted = next(s for s in model.stages if isinstance(s, LogisticRegressionModel))
    weights = dict(zip(features, map(float, fitted.coefficients.toArray())))
    scale = dict(zip(features, map(float, scaler.std.toArray())))
    center = dict(zip(features, map(float, scaler.mean.toArray())))
    means = background.agg(*[F.avg(c).alias(c) for c in features]).head()
    base = fitted.intercept + sum(
        weights[c] * (means[c] - center[c]) / scale[c] for c in features if scale[c]
    )
    shares = linear_attribution(df, background, key, weights, scale, means.asDict())
    return shares.withColumn("base", F.lit(float(base)))


def _orders(d: int, permutations: int, seed: int) -> list[list[int]]:
    """Feature orders in antithetic pairs: each with its reverse."""
    rng = random.Random(seed)
    out: list[list[int]] = []
    while len(out) < permutations:
        order = rng.sample(range(d), d)
        out += [order, order[::-1]]
    return out[:permutations]


def permutation_attribution(model: PipelineModel, df: DataFrame, background: DataFrame,
                            key: Sequence[str], permutations: int = 10, seed: int = 42,
                            output: str = "probability") -> DataFrame:
    """Sampled Shapley values for any model: key..., feature, phi, base, value.

    Along each feature order a background row turns into the explained row one
    feature at a time; a feature's share is the mean change it causes. Per row
    the shares add up to value - base exactly. All hybrid rows are scored in
    one distributed transform and summed on the map side. ``background`` is
    numbered by hash, counted, and each (row, order) looks up one of its rows.
    """
    features = model_features(model)
    d = len(features)
    spark = df.sparkSession
    vector = F.array(*[F.col(c).cast("double") for c in features])
    numbered = hash_rank(background, background.columns, seed=seed, out="_n")
    pool = cut_lineage(numbered.select(F.col("_n").alias("_pool"), vector.alias("_b")))
    size = pool.count()
    if size == 0:
        raise ValueError("the background is empty")
    places = []
    for order in _orders(d, permutations, seed):
        at = [0] * d
        for step, f in enumerate(order):
            at[f] = step
        places.append((order, at))
    orders = F.array(
        *[
            F.struct(
                F.lit(i).alias("order_id"),
                F.array(*map(F.lit, order)).alias("order"),
                F.array(*map(F.lit, at)).alias("place"),
            )
            for i, (order, at) in enumerate(places)
        ]
    )
    rows = df.select(*key, vector.alias("_x"), F.inline(orders))
    rows = rows.withColumn("_pick", F.pmod(F.xxhash64(*key, "order_id"), F.lit(size)) + 1)
    side = F.broadcast(pool) if size * d <= BROADCAST_CELLS else pool
    paired = rows.join(side, F.col("_pick") == F.col("_pool"))
    steps = paired.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    hybrid = F.transform(
        F.sequence(F.lit(0), F.lit(d - 1)),
        lambda i: F.when(F.get("place", i) < F.col("step"), F.get("_x", i)).otherwise(F.get("_b", i)),
    )
    ready = steps.select(*key, "order", "step", array_to_vector(hybrid).alias("features"))
    scorer = PipelineModel(stages=model.stages[1:])
    p = positive_probability()
    if output == "log_odds":
        tiny = F.lit(1e-300)
        p = F.log(F.greatest(p, tiny)) - F.log(F.greatest(1 - p, tiny))
    elif output != "probability":
        raise ValueError(f"unknown output: {output}")
    scored = scorer.transform(ready).select(*key, "order", "step", p.alias("f"))
    step, f = F.col("step"), F.col("f")
    # Step s adds feature order[s-1] and has not yet added order[s].
    parts = F.array_compact(
        F.array(
            F.when(step > 0, F.struct(F.get("order", step - 1).alias("_f"), f.alias("_v"))),
            F.when(step < d, F.struct(F.get("order", step).alias("_f"), (-f).alias("_v"))),
            F.when(step == 0, F.struct(F.lit(-1).alias("_f"), f.alias("_v"))),
            F.when(step == d, F.struct(F.lit(-2).alias("_f"), f.alias("_v"))),
        )
    )
    shares = (
        scored.select(*key, F.inline(parts))
        .groupBy(*key, "_f")
        .agg((F.sum("_v") / F.lit(float(permutations))).alias("phi"))
    )
    w = Window.partitionBy(*key)
    names = F.array(*map(F.lit, features))
    return (
        shares.withColumn("base", F.max(F.when(F.col("_f") == -1, F.col("phi"))).over(w))
        .withColumn("value", F.max(F.when(F.col("_f") == -2, F.col("phi"))).over(w))
        .filter("_f >= 0")
        .select(*key, F.get(names, F.col("_f")).alias("feature"), "phi", "base", "value")
    )


def importance(attribution: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute, mean and population deviation per feature, largest first."""
    table = attribution.groupBy(*by, "feature").agg(
        F.avg(F.abs("phi")).alias("mean_abs"),
        F.avg("phi").alias("mean"),
        F.stddev_pop("phi").alias("std"),
    )
    return table.orderBy(*by, F.desc("mean_abs"), "feature")


def top_features(table: DataFrame, k: int = 10, by: Sequence[str] = ("model",)) -> DataFrame:
    """The ``k`` most important features of each model."""
    part = [*by] or [F.lit(0)]
    w = Window.partitionBy(*part).orderBy(F.desc("mean_abs"), "feature")
    ranked = table.withColumn("rank", F.row_number().over(w))
    return ranked.filter(F.col("rank") <= k).select(*by, "rank", "feature", "mean_abs")


def instance_breakdown(attribution: DataFrame, key: Sequence[str], k: int = 15) -> DataFrame:
    """Waterfall data: the ``k`` largest contributions per row, rest as one.

    The row's base value is carried along when the attribution has one. The rows are
    counted and dealt by key so that a task orders about GROUPED_ROWS of them, however
    many there are.
    """
    tasks = -(-attribution.count() // GROUPED_ROWS)
    attribution = attribution.repartition(max(tasks, 1), *key)
    w = Window.partitionBy(*key).orderBy(F.desc(F.abs("phi")), "feature")
    ranked = attribution.withColumn("rank", F.least(F.row_number().over(w), F.lit(k + 1)))
    name = F.when(F.col("rank") <= k, F.col("feature")).otherwise("other")
    carried = [F.max(c).alias(c) for c in ("base",) if c in attribution.columns]
    return ranked.groupBy(*key, "rank", name.alias("feature")).agg(F.sum("phi").alias("phi"), *carried)


def explain(model: PipelineModel, background: DataFrame, df: DataFrame, key: Sequence[str],
            background_size: int = 500, sample_size: int = 200, permutations: int = 10,
            seed: int = 42, method: str | None = None) -> DataFrame:
    """Sample both tables and attribute: log-odds for boosting and logistic
    models, probability for forests.

    By default logistic models use the closed form, tree models their node table and
    others coalitions; ``method`` "coalitions" or "permutations" takes that instead.
    """
    pool = random_rows(background, key, background_size, seed)
    rows = random_rows(df, key, sample_size, seed)
    last = type(model.stages[-1]).__name__
    if method is None and last == "LogisticRegressionModel":
        return explain_linear(model, rows, pool, key)
    output = "log_odds" if last.startswith(("Boosted", "Logistic")) else "probability"
    if method is None and last in TREES:
        shares = tree_attribution(model, rows, key)
    elif method == "permutations":
        shares = permutation_attribution(model, rows, pool.select(*model_features(model)), key, permutations, seed, output)
    elif method in (None, "coalitions"):
        shares = coalition_attribution(model, rows, pool, key, seed=seed, output=output)
    else:
        raise ValueError(f"unknown method: {method}")
    return shares.select(*key, "feature", "phi", "base")


def explain_all(models: Mapping[str, PipelineModel], background: DataFrame, df: DataFrame,
                key: Sequence[str], **options) -> DataFrame:
    """Attributions of several models in one table with a ``model`` column."""
    if not models:
        raise ValueError("no models to explain")
    out = None
    for name, model in models.items():
        part = explain(model, background, df, key, **options).withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out
