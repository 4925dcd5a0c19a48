"""Column drops, imputation, outlier reports and type consistency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintage.functions.columns import (
    batches,
    long_rows,
    numeric_columns,
    parse_timestamp,
    percent,
    present,
    string_columns,
)
from vintage.functions.ordering import (
    exact_quantiles,
    grouped_quantiles,
    modes,
    non_null_counts,
)
from vintage.operators.profile import _union
from vintage.spec import DATE_PATTERNS

IMPUTATION_LOG = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("fill_value", T.StringType()),
        T.StructField("missing_before", T.LongType()),
        T.StructField("missing_after", T.LongType()),
    ]
)


def drop_columns(df: DataFrame, columns: Sequence[str], reason: str) -> tuple[DataFrame, DataFrame]:
    """Drop the listed columns that exist; the log names both kinds."""
    found = present(df, dict.fromkeys(columns))
    missing = [c for c in dict.fromkeys(columns) if c not in set(found)]
    out = df.drop(*found)
    log = df.sparkSession.createDataFrame(
        [("drop_columns", reason, found, missing, len(df.columns), len(out.columns))],
        "operation string, reason string, columns_dropped array<string>, "
        "columns_not_found array<string>, columns_before int, columns_after int",
    )
    return out, log


def _missing_counts(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, int]]:
    rows, counts = 0, {}
    for batch in batches(columns):
        row = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in batch]).head()
        rows = row["_rows"]
        counts.update({c: row[c] for c in batch})
    return rows, counts


def impute(
    df: DataFrame,
    numeric_fill: str = "median",
    categorical_fill: str = "mode",
    exclude: Sequence[str] = (),
    fit: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Fill gaps with statistics of ``fit`` (default: the table itself).

    numeric_fill: median, mean, zero or drop; categorical_fill: mode, unknown
    or drop. Statistics are one value per column and become literals. Returns
    the filled table and the imputation log.
    """
    if numeric_fill not in ("median", "mean", "zero", "drop"):
        raise ValueError(f"unknown numeric_fill: {numeric_fill}")
    if categorical_fill not in ("mode", "unknown", "drop"):
        raise ValueError(f"unknown categorical_fill: {categorical_fill}")
    fit = df if fit is None else fit
    skip = set(exclude)
    numeric = [c for c in numeric_columns(df) if c not in skip]
    text = [c for c in string_columns(df) if c not in skip]
    rows, counts = _missing_counts(df, numeric + text)
    numeric = [c for c in numeric if counts[c] < rows]
    text = [c for c in text if counts[c] < rows]

    fills: dict[str, float | str | None] = {}
    if numeric and numeric_fill == "median":
        known = {c: counts[c] for c in numeric} if fit is df else None
        fills.update({c: q and q[0] for c, q in exact_quantiles(fit, numeric, [0.5], known).items()})
    elif numeric_fill == "mean":
        for batch in batches(numeric):
            fills.update(fit.agg(*[F.avg(c).alias(c) for c in batch]).head().asDict())
    elif numeric_fill == "zero":
        fills.update({c: 0.0 for c in numeric})
    if text and categorical_fill == "mode":
        found = {r["column"]: r["mode"] for r in modes(fit, text).collect()}
        fills.update({c: found.get(c) for c in text})
    elif categorical_fill == "unknown":
        fills.update({c: "Unknown" for c in text})

    columns = {}
    for c in numeric:
        if fills.get(c) is not None:
            kind = df.schema[c].dataType if numeric_fill == "zero" else T.DoubleType()
            columns[c] = F.coalesce(F.col(c).cast(kind), F.lit(fills[c]).cast(kind))
    for c in text:
        if fills.get(c) is not None:
            columns[c] = F.coalesce(F.col(c), F.lit(fills[c]))
    out = df.withColumns(columns)
    dropped = [c for cols, how in ((numeric, numeric_fill), (text, categorical_fill)) if how == "drop" for c in cols]
    if dropped:
        out = out.dropna(subset=dropped)

    log = [
        (
            c,
            kind,
            method,
            None if fills.get(c) is None else str(fills[c]),
            rows - counts[c],
            0 if fills.get(c) is not None or method == "drop" else rows - counts[c],
        )
        for cols, kind, method in (
            (numeric, "numeric", numeric_fill),
            (text, "categorical", categorical_fill),
        )
        for c in cols
    ]
    return out, df.sparkSession.createDataFrame(log, IMPUTATION_LOG)


def drop_missing_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(columns) if columns else None)


def add_missing_indicators(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_missing`` as 0/1 for each column."""
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in columns})


def impute_by_group(df: DataFrame, by: Sequence[str], numeric: Sequence[str] = (),
                    text: Sequence[str] = ()) -> DataFrame:
    """Fill gaps with the median or mode of the row's own block.

    Block statistics form one row per block. Spark broadcasts that table when
    its measured size allows and otherwise joins by block, splitting hot blocks.
    """
    out = df
    if numeric:
        medians = grouped_quantiles(df, by, numeric, [0.5])
        out = _fill_from(out, by, medians, numeric, "q0", "double")
    if text:
        out = _fill_from(out, by, modes(df, text, by), text, "mode", "string")
    return out


def _fill_from(df, by, stats, columns, value, dtype):
    wide = stats.groupBy(*by).agg(
        *[F.max(F.when(F.col("column") == c, F.col(value))).alias(f"_fill_{c}") for c in columns]
    )
    right = wide.withColumnsRenamed({k: f"_by_{k}" for k in by})
    joined = df.join(right, [df[k].eqNullSafe(right[f"_by_{k}"]) for k in by], "left")
    filled = joined.withColumns({c: F.coalesce(F.col(c).cast(dtype), F.col(f"_fill_{c}")) for c in columns})
    return filled.select(*df.columns)


def outliers_iqr(df: DataFrame, columns: Sequence[str] | None = None,
                 limit: int | None = None) -> DataFrame:
    """Values outside 1.5 interquartile ranges, per numeric column."""
    numeric = set(numeric_columns(df))
    columns = [c for c in columns or df.columns if c in numeric]
    quartiles = exact_quantiles(df, columns, [0.25, 0.75], non_null_counts(df, columns), limit)
    parts = []
    for batch in batches(columns):
        structs = []
        for c in batch:
            q1, q3 = quartiles[c] or (None, None)
            low = None if q1 is None else q1 - 1.5 * (q3 - q1)
            high = None if q1 is None else q3 + 1.5 * (q3 - q1)
            x = F.col(c).cast("double")
            hits = F.count_if((x < F.lit(low)) | (x > F.lit(high)))
            structs.append(
                F.struct(
                    F.lit(c).alias("column"),
                    hits.alias("count"),
                    percent(hits, F.count("*")).alias("pct"),
                    F.lit(low).cast("double").alias("lower_bound"),
                    F.lit(high).cast("double").alias("upper_bound"),
                    F.min(x).alias("min_value"),
                    F.max(x).alias("max_value"),
                )
            )
        parts.append(long_rows(df, structs))
    return _union(parts)


def outliers_zscore(df: DataFrame, columns: Sequence[str] | None = None,
                    threshold: float = 3.0) -> DataFrame:
    """Values more than ``threshold`` sample deviations from the mean."""
    numeric = set(numeric_columns(df))
    columns = [c for c in columns or df.columns if c in numeric]
    parts = []
    for batch in batches(columns):
        stats = df.agg(
            *[F.avg(c).alias(f"m_{c}") for c in batch], *[F.stddev_samp(c).alias(f"s_{c}") for c in batch]
        ).head()
        structs = []
        for c in batch:
            mean, std = F.lit(stats[f"m_{c}"]).cast("double"), F.lit(stats[f"s_{c}"]).cast("double")
            z = F.abs(F.try_divide(F.col(c).cast("double") - mean, std))
            hits = F.count_if(z > threshold)
            structs.append(
                F.struct(
                    F.lit(c).alias("column"),
                    hits.alias("count"),
                    percent(hits, F.count("*")).alias("pct"),
                    F.lit(float(threshold)).alias("threshold"),
                )
            )
        parts.append(long_rows(df, structs))
    return _union(parts)


def outlier_top(report: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` columns with most outliers, with the total over all columns.

    The report has one row per column, so a window over it is small.
    """
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    summed = report.select("column", "count", "pct", total.alias("total_count"))
    return summed.orderBy(F.desc("count"), "column").limit(k)


def coerce_dates(df: DataFrame, columns: Sequence[str],
                 patterns: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    """Text dates to timestamps; unparseable text becomes NULL."""
    text = [c for c in present(df, columns) if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: parse_timestamp(F.col(c), patterns) for c in text})


def id_columns(df: DataFrame) -> list[str]:
    """Text columns whose name contains "id", which must stay text."""
    return [c for c in string_columns(df) if "id" in c.lower()]


def type_consistency(df: DataFrame, dates: Sequence[str] = (),
                     patterns: Sequence[str] = DATE_PATTERNS) -> tuple[DataFrame, DataFrame]:
    """Dates to timestamps, id-like text kept as text, gappy numbers to double."""
    text_ids = id_columns(df)
    out = coerce_dates(df, dates, patterns).withColumns({c: F.col(c).cast("string") for c in text_ids if c not in dates})
    whole = [c for c in numeric_columns(df) if not isinstance(df.schema[c].dataType, T.DoubleType)]
    gappy = []
    if whole:
        rows, counts = _missing_counts(df, whole)
        gappy = [c for c in whole if counts[c] < rows]
    out = out.withColumns({c: F.col(c).cast("double") for c in gappy})
    changes = [
        *[(c, df.schema[c].dataType.simpleString(), "timestamp", "date column") for c in present(df, dates)],
        *[(c, "string", "string", "id column") for c in text_ids if c not in dates],
        *[(c, df.schema[c].dataType.simpleString(), "double", "contains NULLs") for c in gappy],
    ]
    log = df.sparkSession.createDataFrame(
        changes, "column string, from_type string, to_type string, reason string"
    )
    return out, log
