"""Time-based train and test sets, their checks, and label mapping."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintage.functions.columns import date_of, percent


def split_suggestions(df: DataFrame, date: str, ratios: Sequence[float] = (0.8, 0.7)) -> DataFrame:
    """Split day per ratio with the train and test rows it gives.

    Rows are first counted per day, so the ordered window sees at most one row
    per calendar day. The split day is the one at 0-based position
    int(n * ratio) of the sorted non-NULL dates.
    """
    per_day = df.select(date_of(df, date).alias("day")).groupBy("day").agg(F.count("*").alias("c"))
    everything = Window.partitionBy(F.lit(0))
    in_order = everything.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = (
        per_day.withColumn("rows", F.sum("c").over(everything))
        .filter("day IS NOT NULL")
        .withColumn("dated", F.sum("c").over(everything))
        .withColumn("cum", F.sum("c").over(in_order))
    )
    cut = F.floor(F.col("dated") * F.col("ratio"))
    first = (
        days.withColumn("ratio", F.explode(F.array(*[F.lit(float(r)) for r in ratios])))
        .filter(F.col("cum") > cut)
        .groupBy("ratio", "rows", "dated")
        .agg(F.min(F.struct("day", "cum", "c")).alias("s"))
    )
    train = F.col("s.cum") - F.col("s.c")
    test = F.col("dated") - train
    return first.select(
        "ratio",
        F.col("s.day").alias("split_date"),
        train.alias("train_rows"),
        percent(train, F.col("rows")).alias("train_pct"),
        test.alias("test_rows"),
        percent(test, F.col("rows")).alias("test_pct"),
    )


def split_date(df: DataFrame, date: str, ratio: float = 0.8) -> dt.date:
    """The split day itself, for operators that take it as a constant."""
    row = split_suggestions(df, date, [ratio]).head()
    if row is None:
        if ratio >= 1 and not df.select(date_of(df, date).alias("d")).filter("d IS NOT NULL").isEmpty():
            raise IndexError(f"ratio {ratio} leaves no row for the test side")
        raise ValueError(f"no valid dates in column '{date}'")
    return row["split_date"]


def _when(cond: Column, code: str) -> Column:
    return F.when(cond, F.lit(code))


def check_split_date(df: DataFrame, date: str, split: dt.date | str, mode: str = "full",
                     min_rows: int = 100) -> DataFrame:
    """Range, emptiness and size checks of a chosen split day, as one row."""
    day = F.lit(split).cast("date")
    full = F.lit(mode == "full")
    stats = df.select(date_of(df, date).alias("_d")).agg(
        F.min("_d").alias("min_date"),
        F.max("_d").alias("max_date"),
        F.count_if(F.col("_d") < day).alias("train_rows"),
        F.count_if(F.col("_d") >= day).alias("test_rows"),
        F.count("_d").alias("_dated"),
    )
    empty_range = F.col("min_date").isNull()
    before, after = day < F.col("min_date"), day > F.col("max_date")
    usable = ~empty_range & ~before & ~after
    no_test, no_train = usable & (F.col("test_rows") == 0), usable & (F.col("train_rows") == 0)
    errors = F.array(
        _when(empty_range, "no_dates"),
        _when(before, "before_range"),
        _when(after, "after_range"),
        _when(no_test & full, "empty_test"),
        _when(no_train & full, "empty_train"),
    )
    sized = usable & full & ~no_test & ~no_train
    warnings = F.array(
        _when(no_test & ~full, "empty_test"),
        _when(no_train & ~full, "empty_train"),
        _when(sized & (F.col("test_rows") < min_rows), "small_test"),
        _when(sized & (F.col("train_rows") < min_rows), "small_train"),
    )
    return (
        stats.withColumn("errors", F.array_compact(errors))
        .withColumn("warnings", F.array_compact(warnings))
        .select(
            (F.size("errors") == 0).alias("is_valid"),
            "errors",
            "warnings",
            "min_date",
            "max_date",
            "train_rows",
            "test_rows",
            F.coalesce(percent(F.col("train_rows"), F.col("_dated")), F.lit(0.0)).alias("train_pct"),
            F.coalesce(percent(F.col("test_rows"), F.col("_dated")), F.lit(0.0)).alias("test_pct"),
        )
    )


def temporal_split(df: DataFrame, date: str, split: dt.date | str, out: str = "split") -> DataFrame:
    """Mark rows before the split day train and the rest test; NULL dates go."""
    day, cut = date_of(df, date), F.lit(split).cast("date")
    marked = df.withColumn(out, F.when(day < cut, "train").when(day >= cut, "test"))
    return marked.filter(F.col(out).isNotNull())


def validate_split(df: DataFrame, date: str, split: dt.date | str, side: str = "split") -> DataFrame:
    """Rows on the wrong side, overlap, empty sides and missing dates, one row."""
    cut = F.lit(split).cast("date")
    rows = df.select(F.col(side).alias("_s"), date_of(df, date).alias("_d"))
    train, test, day = F.col("_s") == "train", F.col("_s") == "test", F.col("_d")
    stats = rows.agg(
        F.count_if(train).alias("train_rows"),
        F.count_if(test).alias("test_rows"),
        F.min(F.when(train, day)).alias("train_min"),
        F.max(F.when(train, day)).alias("train_max"),
        F.min(F.when(test, day)).alias("test_min"),
        F.max(F.when(test, day)).alias("test_max"),
        F.count_if(train & (day >= cut)).alias("train_violations"),
        F.count_if(test & (day < cut)).alias("test_violations"),
        F.count_if(train & day.isNull()).alias("_train_null"),
        F.count_if(test & day.isNull()).alias("_test_null"),
    )
    errors = F.array_compact(
        F.array(
            _when(F.col("train_violations") > 0, "late_rows_in_train"),
            _when(F.col("test_violations") > 0, "early_rows_in_test"),
            _when(F.col("train_rows") == 0, "empty_train"),
            _when(F.col("test_rows") == 0, "empty_test"),
        )
    )
    warnings = F.array_compact(
        F.array(
            _when(F.col("train_max") >= F.col("test_min"), "overlap"),
            _when(F.col("_train_null") > 0, "missing_dates_in_train"),
            _when(F.col("_test_null") > 0, "missing_dates_in_test"),
        )
    )
    checked = stats.withColumn("errors", errors).withColumn("warnings", warnings)
    return checked.select(
        (F.size("errors") == 0).alias("is_valid"),
        "errors",
        "warnings",
        "train_rows",
        "test_rows",
        "train_min",
        "train_max",
        "test_min",
        "test_max",
        (F.col("train_violations") + F.col("test_violations")).alias("overlap_count"),
    )


def map_labels(df: DataFrame, column: str, labels: Mapping[str, int | None],
               out: str = "target") -> DataFrame:
    """0/1 target from a status; excluded and unknown statuses are dropped."""
    pairs = [F.lit(v) for k, y in labels.items() if y is not None for v in (k, y)]
    mapped = df.withColumn(out, F.create_map(*pairs)[F.col(column)].cast("int"))
    return mapped.filter(F.col(out).isNotNull())
