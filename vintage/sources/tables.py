"""Readers, writers and file-level facts for local, HDFS or object storage."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintage.functions.columns import nan_to_null, row_hash


def read_raw(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    nrows: int | None = None,
    order_by: Sequence[str] = (),
    files_per_batch: int | None = None,
    partitions: int | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """CSV or gzip CSV as a DataFrame, or as a stream with ``files_per_batch``.

    Only the header is read to plan: columns are text unless ``types`` names a
    type, which is applied by ``try_cast``. A plain file is split among tasks unless
    ``multi_line`` says that values hold line breaks; for gzip files, which cannot be
    split anyhow, that is the default. Gzip files cannot be split, so they
    are spread over ``partitions`` tasks right after the read.
    """
    if nrows is not None and files_per_batch is not None:
        raise ValueError("nrows and files_per_batch exclude each other")
    multi_line = path.endswith(".gz") if multi_line is None else multi_line
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    if files_per_batch is not None:
        names = spark.read.options(**options).csv(path).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        df = (
            spark.readStream.options(**options)
            .option("maxFilesPerTrigger", files_per_batch)
            .schema(schema)
            .csv(path)
        )
    else:
        df = spark.read.options(**options).csv(path)
        if path.endswith(".gz") or any(f.endswith(".gz") for f in df.inputFiles()[:1]):
            df = df.repartition(partitions or spark.sparkContext.defaultParallelism)
    typed = {c: F.col(c).try_cast(t) for c, t in (types or {}).items() if c in df.columns}
    df = nan_to_null(df.withColumns(typed))
    if nrows is not None:
        df = first_rows(df, nrows, order_by)
    return df


def first_rows(df: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows of a key order; any ``n`` rows when none is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """Parquet, or CSV when the suffix says so, pruned to ``columns``."""
    if path.endswith((".csv", ".csv.gz")):
        df = read_raw(spark, path)
    else:
        df = nan_to_null(spark.read.parquet(path))
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write CSV for a .csv path, gzipped for .csv.gz, and Parquet otherwise; return the path used."""
    writer = df.write.mode(mode)
    if path.endswith((".csv", ".csv.gz")):
        packed = {"compression": "gzip"} if path.endswith(".gz") else {}
        writer.options(header=True, **packed).csv(path)
        return path
    path = path if path.endswith(".parquet") else f"{path}.parquet"
    writer.parquet(path)
    return path


def append_table(df: DataFrame, path: str) -> None:
    """Add files to a Parquet table without touching those already there."""
    df.write.mode("append").parquet(path)


def write_split(df: DataFrame, path: str, split: str = "split") -> None:
    """Train and test as two partitions of one table, each prunable on read."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def file_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row per file. The content column is pruned, so no file is opened."""
    files = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        name.alias("file_name"),
        F.col("length").alias("size_bytes"),
        F.round(F.col("length") / F.lit(1024.0 * 1024.0), 2).alias("size_mb"),
        F.col("modificationTime").alias("modified"),
        name.endswith(".gz").alias("is_compressed"),
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows that each file of a file-based table holds."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("rows"))


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-free table fingerprint in one pass, for version tracking."""
    h = row_hash(df, df.columns)
    return df.select(h.alias("_h")).agg(
        F.count("*").alias("rows"),
        F.bit_xor("_h").alias("xor_hash"),
        F.sum(F.col("_h").cast("decimal(38,0)")).cast("string").alias("sum_hash"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted model; its feature list lives in the assembler stage."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_features(model: PipelineModel) -> list[str]:
    for stage in model.stages:
        if isinstance(stage, VectorAssembler):
            return list(stage.getInputCols())
    raise ValueError("the model has no VectorAssembler stage")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; on a local master one of our own if unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="vintage-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def use_shared_checkpoints(spark: SparkSession) -> None:
    """Let checkpoints, also those inside iterative fits, go to that folder."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages restart from files, not from the source."""
    use_shared_checkpoints(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    unique = spark.sql("SELECT uuid()").head()[0]
    return os.path.join(shared_folder(spark), f"{name}-{unique}")


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete what was written to a scratch path; nothing may read it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
