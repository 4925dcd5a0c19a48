"""Reference statistics, drift, request statistics, histograms and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.functions.columns import batches, long_rows, ratio
from vintage.functions.ordering import grouped_quantiles
from vintage.operators.profile import _union
from vintage.spec import LATENCY_BOUNDS, PROBABILITY_BOUNDS


def reference_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean, sample deviation, min and max per feature: the drift baseline."""
    parts = []
    for batch in batches(features):
        structs = [
            F.struct(
                F.lit(c).alias("feature"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            )
            for c in batch
        ]
        parts.append(long_rows(df, structs))
    return _union(parts)


def feature_extremes(df: DataFrame, features: Sequence[str],
                     by: Sequence[str] = ()) -> DataFrame:
    """Smallest and largest value per feature (and group), ignoring NULLs.

    A stream keeps all features in one aggregation, hence in one state.
    """
    parts = []
    for batch in [features] if df.isStreaming else batches(features):
        structs = [
            F.struct(
                F.lit(c).alias("feature"),
                F.min(F.col(c).cast("double")).alias("low"),
                F.max(F.col(c).cast("double")).alias("high"),
            )
            for c in batch
        ]
        parts.append(long_rows(df, structs, by=by))
    return _union(parts)


def drift(df: DataFrame, reference: DataFrame, features: Sequence[str],
          by: Sequence[str] = (), threshold: float = 3.0) -> DataFrame:
    """Largest absolute z-score per feature against the reference.

    |x - mean| is largest at the smallest or the largest value, so two
    aggregates per feature replace a per-row join. Features with no reference
    or with zero deviation are skipped.
    """
    return drift_from_extremes(feature_extremes(df, features, by), reference, by, threshold)


def drift_from_extremes(extremes: DataFrame, reference: DataFrame, by: Sequence[str] = (),
                        threshold: float = 3.0) -> DataFrame:
    usable = reference.filter("mean IS NOT NULL AND std IS NOT NULL AND std <> 0")
    joined = extremes.join(usable.select("feature", "mean", "std"), "feature")
    z_low = F.abs(F.try_divide(F.col("low") - F.col("mean"), F.col("std")))
    z_high = F.abs(F.try_divide(F.col("high") - F.col("mean"), F.col("std")))
    return joined.select(
        *by,
        "feature",
        F.greatest(z_low, z_high).alias("z_score"),
        F.col("mean").alias("reference_mean"),
        F.when(z_high >= z_low, F.col("high")).otherwise(F.col("low")).alias("current_value"),
    ).withColumn("drifted", F.coalesce(F.col("z_score") > threshold, F.lit(False)))


def drift_summary(checks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row (per group): any drift, features checked, largest z-score."""
    return checks.groupBy(*by).agg(
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("drift_detected"),
        F.count("*").alias("features_checked"),
        F.count_if("drifted").alias("features_with_drift"),
        F.coalesce(F.max("z_score"), F.lit(0.0)).alias("max_z_score"),
    )


def request_aggregates(status: str = "status", duration: str = "duration") -> list[Column]:
    errors = F.count_if(F.col(status) >= 400)
    return [
        F.count("*").alias("total_requests"),
        errors.alias("errors"),
        ratio(errors, F.count("*")).alias("error_rate"),
        (F.avg(duration) * 1000).alias("avg_latency_ms"),
    ]


def request_stats(log: DataFrame, by: Sequence[str] = ("method", "endpoint")) -> DataFrame:
    """Requests, errors (status 400 and up), error rate and mean latency."""
    return log.groupBy(*by).agg(*request_aggregates())


def request_counts(log: DataFrame) -> DataFrame:
    """Request counter by method, endpoint and status."""
    return log.groupBy("method", "endpoint", "status").agg(F.count("*").alias("requests"))


def cumulative_histogram(df: DataFrame, value: str, bounds: Sequence[float],
                         by: Sequence[str] = ()) -> DataFrame:
    """Rows at or below each bound, plus the +Inf row; with count and sum.

    All buckets are conditional counts of one aggregation, so rows are not
    multiplied by the number of bounds.
    """
    edges = [*map(float, bounds), float("inf")]
    structs = [
        F.struct(
            F.lit("+Inf" if e == float("inf") else str(e)).alias("le"),
            (F.count(value) if e == float("inf") else F.count_if(F.col(value) <= e)).alias("bucket"),
            F.count(value).alias("count"),
            F.sum(value).alias("sum"),
        )
        for e in edges
    ]
    return long_rows(df, structs, by=by)


def latency_histogram(log: DataFrame, by: Sequence[str] = ("method", "endpoint")) -> DataFrame:
    return cumulative_histogram(log, "duration", LATENCY_BOUNDS, by)


def probability_histogram(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return cumulative_histogram(predictions, "probability", PROBABILITY_BOUNDS, by)


def prediction_counts(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Prediction counter by class."""
    return predictions.groupBy(*by, "prediction").agg(F.count("*").alias("predictions"))


def firing(endpoint_alerts: DataFrame, drift_checks: DataFrame,
           by: Sequence[str] = ("method", "endpoint")) -> DataFrame:
    """The alerts that fire, one row each: alert, subject, value."""
    subject = F.concat_ws(" ", *by)
    kinds = F.array_compact(
        F.array(
            F.when(F.col("error_alert"), F.struct(F.lit("error_rate").alias("alert"), F.col("error_rate").alias("value"))),
            F.when(F.col("latency_alert"), F.struct(F.lit("p95_latency").alias("alert"), F.col("p95_seconds").alias("value"))),
        )
    )
    service = endpoint_alerts.select(subject.alias("subject"), F.inline(kinds))
    moved = drift_checks.filter("drifted").select(
        F.col("feature").alias("subject"), F.lit("drift").alias("alert"), F.col("z_score").alias("value")
    )
    return service.unionByName(moved)


def alerts(log: DataFrame, by: Sequence[str] = ("method", "endpoint"),
           max_error_rate: float = 0.05, max_p95_seconds: float = 1.0) -> DataFrame:
    """Error-rate and exact p95 latency alerts per endpoint."""
    stats = request_stats(log, by)
    p95 = grouped_quantiles(log, by, ["duration"], [0.95]).select(*by, F.col("q0").alias("p95_seconds"))
    return stats.join(p95, list(by), "left").select(
        *by,
        "error_rate",
        "p95_seconds",
        (F.col("error_rate") > max_error_rate).alias("error_alert"),
        F.coalesce(F.col("p95_seconds") > max_p95_seconds, F.lit(False)).alias("latency_alert"),
    )
