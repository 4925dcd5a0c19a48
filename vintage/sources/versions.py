"""Versions of a file-based table: digests of rows add up to those of files, and these to that of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIGESTS = "file string, size_bytes long, modified timestamp, rows long, high decimal(38,0), low decimal(38,0), hashed_in int"


def row_text(columns: Sequence[str]) -> Column:
    """A row as text that no other row shares: each value behind its length, N for NULL, in the order of names."""
    cells = [F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("N")) for text in (F.col(f"`{c}`").cast("string") for c in sorted(columns))]
    return F.concat(*cells)


def row_sums(columns: Sequence[str]) -> list[Column]:
    """Rows, and sums of two 60-bit parts of their MD5, which do not depend on order or files."""
    digest = F.md5(row_text(columns))
    part = lambda at: F.sum(F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)"))
    return [F.count("*").alias("rows"), part(1).alias("high"), part(16).alias("low")]


def _is_folder(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return files.exists(where) and files.getFileStatus(where).isDirectory()


def listed(spark: SparkSession, path: str) -> DataFrame:
    """Files of a table: file, size_bytes, modified and the path to read. No file is opened."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.col("_metadata.file_path").alias("file"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"), F.col("path").alias("_path")
    )


def file_digests(spark: SparkSession, path: str, known: DataFrame | None = None, number: int = 1) -> DataFrame:
    """DIGESTS: a line per Parquet file, with the version that hashed it.

    Files that ``known`` holds with the same size and time keep their line; only others are
    read. The driver gets the names of those, as it does for any read. A file without rows
    has zero sums.
    """
    now = listed(spark, path)
    same = ["file", "size_bytes", "modified"]
    old = known if known is not None else spark.createDataFrame([], DIGESTS)
    kept = now.drop("_path").join(old, same)
    fresh = now.join(old.select(*same), same, "left_anti")
    names = [r["_path"] for r in fresh.select("_path").collect()]
    if not names:
        return kept.select(*_names())
    reader = spark.read.option("basePath", path) if _is_folder(spark, path) else spark.read
    rows = reader.parquet(*names)
    sums = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(*row_sums(rows.columns))
    new = fresh.drop("_path").join(sums, "file", "left").na.fill(0, ["rows", "high", "low"]).withColumn("hashed_in", F.lit(number))
    return kept.select(*_names()).unionByName(new.select(*_names()))


def _names() -> list[str]:
    return [part.strip().split(" ")[0] for part in DIGESTS.replace("38,0", "38").split(",")]


def table_digest(digests: DataFrame) -> DataFrame:
    """One row: files, rows, high, low and their digest; equal for tables of the same rows in whatever files."""
    total = digests.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,0)").cast("string").alias(c) for c in ("high", "low")],
    )
    return total.withColumn("digest", F.md5(F.concat_ws(":", F.col("rows").cast("string"), "high", "low")))


def recorded(spark: SparkSession, history: str, number: int | None = None) -> DataFrame:
    """The files of a recorded version (default: the latest)."""
    lines = spark.read.schema(f"{DIGESTS}, version int").parquet(history)
    last = number if number is not None else lines.agg(F.max("version")).head()[0]
    return lines.where(F.col("version") == last).drop("version")


def record_version(spark: SparkSession, path: str, history: str) -> int:
    """Write the digests of the table as it is now below ``history``, reading new and changed files only; its number.

    Each version is one folder, overwritten if the job runs again before the next is made.
    """
    number, known = 1, None
    if _is_folder(spark, history):
        number = 1 + (spark.read.schema("version int").parquet(history).agg(F.max("version")).head()[0] or 0)
        known = recorded(spark, history, number - 1) if number > 1 else None
    file_digests(spark, path, known, number).write.mode("overwrite").parquet(f"{history}/version={number}")
    return number


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """file, change (added, removed, changed), rows_before, rows_after. A file rewritten with the same rows is not listed."""
    a = before.select("file", F.struct("rows", "high", "low").alias("was"))
    b = after.select("file", F.struct("rows", "high", "low").alias("is"))
    change = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed").otherwise("changed")
    both = a.join(b, "file", "full").where(~F.col("was").eqNullSafe(F.col("is")))
    return both.select("file", change.alias("change"), F.col("was.rows").alias("rows_before"), F.col("is.rows").alias("rows_after"))
