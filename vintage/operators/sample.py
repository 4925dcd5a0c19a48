"""Seeded samples that depend on row keys only, never on file order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintage.functions.columns import date_of
from vintage.functions.ordering import HASH_BITS, take_by_hash

# Aim for hash buckets of about this many rows when the table size is known.
ROWS_PER_BUCKET = 50_000


def _months(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn("month", F.date_format(F.trunc(date_of(df, date), "month"), "yyyy-MM"))


def month_histogram(df: DataFrame, date: str) -> DataFrame:
    """Rows per calendar month; NULL dates belong to no month."""
    months = _months(df, date).filter("month IS NOT NULL")
    return months.groupBy("month").agg(F.count("*").alias("rows"))


def month_quotas(df: DataFrame, date: str, sample_size: int = 10_000) -> DataFrame:
    """Rows to draw per month, in proportion to its share of all rows.

    Every month gets at least one row and at most what it has. NULL dates
    count in the total. The order of double operations is fixed: share first.
    """
    counts = _months(df, date).groupBy("month").agg(F.count("*").alias("rows"))
    total = F.sum("rows").over(Window.partitionBy(F.lit(0)))
    share = F.col("rows").cast("double") / total.cast("double")
    quota = F.least(F.greatest(F.lit(1), F.floor(F.lit(sample_size) * share)), F.col("rows"))
    return counts.select("month", "rows", quota.cast("long").alias("quota")).filter("month IS NOT NULL")


def stratified_sample(df: DataFrame, date: str, key: Sequence[str], sample_size: int = 10_000,
                      seed: int = 42) -> DataFrame:
    """Month-proportional sample without replacement, at most ``sample_size``."""
    quotas = month_quotas(df, date, sample_size)
    rows, drawn = quotas.agg(F.sum("rows"), F.sum("quota")).head()
    rows, drawn = rows or 0, drawn or 0
    bits = min(HASH_BITS, (rows // ROWS_PER_BUCKET).bit_length())
    picked = take_by_hash(
        _months(df, date), key, quotas=quotas, by=["month"], seed=seed, bits=bits, total=drawn
    )
    if drawn > sample_size:
        picked = take_by_hash(picked, key, n=sample_size, seed=seed + 1)
    return picked.drop("month")


def random_rows(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), the same ones on every run."""
    return take_by_hash(df, key, n=n, seed=seed)


def date_diversity(df: DataFrame, date: str) -> DataFrame:
    """Distinct days and their range; fewer than two cannot be split by time."""
    days = df.select(date_of(df, date).alias("_d")).groupBy("_d").count()
    return days.agg(
        F.count("_d").alias("distinct_dates"),
        F.min("_d").alias("min_date"),
        F.max("_d").alias("max_date"),
        (F.count("_d") < 2).alias("too_few"),
    )
