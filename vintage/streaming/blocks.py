"""Block-wise cleaning of a stream: a block is filled from all its rows, however they came."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vintage.functions.columns import unused
from vintage.operators.clean import impute_by_group

SEEN = "block string, until timestamp, high timestamp, rows long, batch long"
FILLED = "block string, batch long"


def _facts(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A table of one folder per micro-batch or block; empty before the first."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def due_blocks(spark: SparkSession, path: str, batch: int, delay: str, last: bool = False) -> list[str]:
    """Blocks with rows that came after their last filling, and that are over.

    A block is over when the latest event so far is ``delay`` beyond its end, or when the
    input ends. Only facts of ``batch`` and earlier count, so a replayed batch finds the same.
    """
    seen = _facts(spark, f"{path}/seen", SEEN).where(F.col("batch") <= batch)
    filled = _facts(spark, f"{path}/filled", FILLED).where(F.col("batch") < batch if not last else F.col("batch") <= batch)
    blocks = seen.groupBy("block").agg(F.max("until").alias("until"), F.max("batch").alias("touched"))
    done = filled.groupBy("block").agg(F.max("batch").alias("done"))
    open_ = blocks.join(done, "block", "left").where("done IS NULL OR touched > done")
    if not last:
        high = seen.agg(F.max("high").alias("high"))
        open_ = open_.crossJoin(F.broadcast(high)).where(F.col("until") <= F.col("high") - F.expr(f"INTERVAL {delay}"))
    return sorted(r["block"] for r in open_.select("block").collect())


def clean_blocks(stream: DataFrame, path: str, block: Sequence[str], numeric: Sequence[str] = (),
                 text: Sequence[str] = (), ts: str | None = None, until: str | None = None,
                 delay: str = "10 minutes", last: bool = True) -> DataFrame:
    """Fill gaps with the median or mode of the row's block, and return the written table.

    A block is all rows of equal ``block`` columns (NULL is a value like others). ``until``
    names the column with the time at which a row's block is over, ``ts`` that of the event;
    without them blocks are over when the input that is there has been read (``last``).

    Each micro-batch writes its rows below its own folder, one folder a block, and a line of
    facts a block. Blocks that are over are then read from there, filled by impute_by_group,
    which spreads a large block over many tasks, and replace their own partition of the
    result. Rows that come later, however late, fill their block anew, so the result is that
    of the whole table in one batch, for any files and triggers; a replayed batch writes the
    same again. Rows wait in files, not in state: state is a line per block and batch. A
    stream without rows gives an empty table.
    """
    spark = stream.sparkSession
    own = unused(stream.columns, "_block")
    when = F.col(ts).cast("timestamp") if ts else F.lit(None).cast("timestamp")
    over = F.col(until).cast("timestamp") if until else F.lit(None).cast("timestamp")
    came = unused(stream.columns, "_batch")
    schema, columns = stream.schema, stream.columns
    # Folders have names of one length, whatever the block's values hold.
    keyed = stream.withColumn(own, F.md5(F.to_json(F.struct(*block), {"ignoreNullFields": "false"})))
    layout = spark.createDataFrame([], schema).withColumn(own, F.lit("")).withColumn(came, F.lit(0).cast("long")).schema

    def fill(blocks: list[str], batch: int, mode: str) -> None:
        if not blocks:
            return
        rows = spark.read.schema(layout).parquet(f"{path}/rows").where(F.col(own).isin(blocks) & (F.col(came) <= batch))
        cleaned = impute_by_group(rows.drop(came), [own], numeric, text)
        cleaned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(own).parquet(f"{path}/clean")
        lines = spark.createDataFrame([(b,) for b in blocks], "block string")
        lines.write.mode(mode).parquet(f"{path}/filled/batch={batch}")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy(own).parquet(f"{path}/rows/{came}={number}")
        stored = spark.read.schema(layout).parquet(f"{path}/rows").where(F.col(came) == number)
        facts = stored.groupBy(F.col(own).alias("block")).agg(F.max(over).alias("until"), F.max(when).alias("high"), F.count("*").alias("rows"))
        facts.write.mode("overwrite").parquet(f"{path}/seen/batch={number}")
        if until:
            fill(due_blocks(spark, path, number, delay), number, "overwrite")

    query = (
        keyed.writeStream.option("checkpointLocation", os.path.join(path, "progress")).trigger(availableNow=True).foreachBatch(write).start()
    )
    query.awaitTermination()
    if last:
        newest = _facts(spark, f"{path}/seen", SEEN).agg(F.max("batch")).head()[0]
        if newest is not None:
            fill(due_blocks(spark, path, newest, delay, last=True), newest, "append")
    kinds = {**dict.fromkeys(numeric, "double"), **dict.fromkeys(text, "string")}
    empty = spark.createDataFrame([], schema).withColumns({c: F.col(c).cast(t) for c, t in kinds.items()})
    return _facts(spark, f"{path}/clean", empty.withColumn(own, F.lit("")).schema).select(*columns)
