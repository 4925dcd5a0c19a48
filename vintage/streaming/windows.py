"""Windows that are written as they change, and alerts whose state is a sketch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from vintage.functions.columns import ratio, unused

VERSION = "batch"
#: Distances from a quantile's rank, each half the one before, of which the number of rows picks one.
STEPS = 13


def write_changes(changed: DataFrame, path: str, number: int, window: str = "window_start") -> None:
    """Store the rows that a micro-batch changed: one folder for each window and batch.

    A batch replaces its own folders alone, so replaying it adds nothing, and late rows
    touch the partitions of their windows alone.
    """
    versioned = changed.withColumn(VERSION, F.lit(number).cast("long"))
    versioned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(window, VERSION).parquet(path)


def run_updates(stats: DataFrame, path: str, window: str = "window_start") -> StreamingQuery:
    """Process all input that is there now in update mode, and return the finished query.

    Only windows that a micro-batch changes are written. Windows that the watermark has
    passed leave the state; rows that come after that are dropped by Spark, so the
    watermark's delay must cover how late rows come.
    """
    query = (
        stats.writeStream.outputMode("update")
        .option("checkpointLocation", f"{path}-progress")
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, number: write_changes(batch, path, number, window))
        .start()
    )
    query.awaitTermination()
    return query


def latest(spark: SparkSession, path: str, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest version of each row that run_updates wrote; keys: the window and the group columns.

    A filter on the window prunes partitions. NULL keys are values like others. A stream
    without rows gives an empty table.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where):
        return spark.createDataFrame([], stats.schema)
    rows = spark.read.schema(stats.withColumn(VERSION, F.lit(0).cast("long")).schema).parquet(path)
    held = [c for c in stats.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*held), VERSION).alias(own := unused(stats.columns, "_newest")))
    return newest.select(*(F.col(own)[c].alias(c) if c in held else F.col(c) for c in stats.columns))


def rank_error(k: int) -> float:
    """Share of rows by which a sketch of parameter k misses a rank, at most, in 99 of 100 cases (fixed values of KLL sketches)."""
    return 2.296 / k**0.9723


def windowed_alerts(log: DataFrame, ts: str = "ts", width: str = "1 day", watermark: str = "10 minutes",
                    by: Sequence[str] = ("method", "endpoint"), max_error_rate: float = 0.05,
                    max_p95_seconds: float = 1.0, k: int = 800) -> DataFrame:
    """Error-rate and p95 latency alerts per time window, on streams or tables.

    The state of a window and group is two counts and a KLL sketch of its latencies, whose
    size depends on k and barely on the rows. p95_low and p95_high enclose the exact,
    interpolated p95: they lie twice rank_error(k) and a row or two to either
    side of p95_seconds (for many rows, 2 ** (1 - STEPS) of them). latency_sure tells that the alert is
    the same for all values between them. Without latencies p95 is NULL and no alert fires.
    """
    timed = log.withWatermark(ts, watermark) if log.isStreaming else log
    stats = timed.withColumn("window", F.window(ts, width)).groupBy("window", *by).agg(
        F.count("*").alias("total_requests"),
        F.count_if(F.col("status") >= 400).alias("errors"),
        F.count("duration").alias("timed"),
        F.kll_sketch_agg_double(F.col("duration").cast("double"), F.lit(k)).alias("sketch"),
    )
    # Ranks must be constants: steps of half the distance, of which the number of rows picks one that is a row or more.
    steps = [2 * rank_error(k) + 2.0**-j for j in range(STEPS)]
    step = F.least(F.floor(F.log2("timed")), F.lit(STEPS - 1)).cast("int")

    def at(ranks):
        values = F.kll_sketch_get_quantile_double("sketch", F.array(*(F.lit(min(max(r, 0.0), 1.0)) for r in ranks)))
        return F.when(F.col("timed") > 0, F.get(values, step if len(ranks) > 1 else F.lit(0)))

    found = stats.select(
        F.col("window.start").alias("window_start"), *by, "total_requests", "errors",
        ratio(F.col("errors"), F.col("total_requests")).alias("error_rate"),
        at([0.95]).alias("p95_seconds"),
        at([0.95 - d for d in steps]).alias("p95_low"),
        at([0.95 + d for d in steps]).alias("p95_high"),
    )
    fires = [F.coalesce(F.col(c) > max_p95_seconds, F.lit(False)) for c in ("p95_low", "p95_seconds", "p95_high")]
    return found.withColumns({
        "error_alert": F.coalesce(F.col("error_rate") > max_error_rate, F.lit(False)),
        "latency_alert": fires[1],
        "latency_sure": fires[0] == fires[2],
    })
