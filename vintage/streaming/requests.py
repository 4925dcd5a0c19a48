"""Windowed request, prediction and drift statistics on streams or tables.

The same functions run on a batch DataFrame, which is how their results are
checked.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintage.functions.columns import nan_to_null
from vintage.operators.monitor import drift_from_extremes, feature_extremes, request_aggregates
from vintage.operators.score import align, predict


def stream_table(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """A Parquet table as a stream of its files.

    Zone-less timestamps become TIMESTAMP (in the session zone), because a
    watermark needs one.
    """
    schema = spark.read.parquet(path).schema
    # A file stream takes a folder or a glob; the glob also fits a single file.
    glob = f"{path[:-1]}[{path[-1]}]"
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(glob)
    )
    zoneless = [f.name for f in schema if isinstance(f.dataType, T.TimestampNTZType)]
    return nan_to_null(stream.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}))


def _windowed(df: DataFrame, ts: str, width: str, watermark: str) -> DataFrame:
    timed = df.withWatermark(ts, watermark) if df.isStreaming else df
    return timed.withColumn("window", F.window(ts, width))


def windowed_requests(log: DataFrame, ts: str = "ts", width: str = "1 day",
                      watermark: str = "10 minutes",
                      by: Sequence[str] = ("method", "endpoint")) -> DataFrame:
    """Request statistics per time window and endpoint."""
    stats = _windowed(log, ts, width, watermark).groupBy("window", *by).agg(*request_aggregates())
    return stats.select(F.col("window.start").alias("window_start"), *by, "total_requests", "errors", "error_rate", "avg_latency_ms")


def windowed_predictions(predictions: DataFrame, ts: str = "ts", width: str = "1 day",
                         watermark: str = "10 minutes") -> DataFrame:
    """Predictions per time window and class."""
    counts = _windowed(predictions, ts, width, watermark).groupBy("window", "prediction").agg(
        F.count("*").alias("predictions"), F.avg("probability").alias("mean_probability")
    )
    return counts.select(
        F.col("window.start").alias("window_start"), "prediction", "predictions", "mean_probability"
    )


def windowed_drift(df: DataFrame, reference: DataFrame, features: Sequence[str], ts: str = "ts",
                   width: str = "1 day", watermark: str = "10 minutes",
                   threshold: float = 3.0) -> DataFrame:
    """Largest z-score per time window and feature.

    The state holds two numbers per window and feature, not the rows.
    """
    extremes = feature_extremes(_windowed(df, ts, width, watermark), features, by=["window"])
    checks = drift_from_extremes(extremes, reference, ["window"], threshold)
    return checks.withColumn("window_start", F.col("window.start")).drop("window")


def score_stream(df: DataFrame, model: PipelineModel, features: Sequence[str],
                 keep: Sequence[str]) -> DataFrame:
    """Align, leave out rows with NULL features, and score."""
    aligned = align(df, features, keep)
    return predict(aligned.filter(F.size("null_features") == 0), model, keep)


def run_available(stream: DataFrame, path: str, mode: str = "complete",
                  batch_fn: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Process all input that is there now and return the written table.

    complete: each trigger replaces the table with the new totals.
    append: each micro-batch owns one folder and overwrites it, so a batch
    replayed after a failure leaves no duplicates.
    ``batch_fn`` is applied to every micro-batch before it is written.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch_fn(batch) if batch_fn else batch
        target = path if mode == "complete" else f"{path}/batch={batch_id}"
        out.write.mode("overwrite").parquet(target)

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{path}-progress")
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    written = spark.read.parquet(path)
    return written if mode == "complete" else written.drop("batch")
