"""Schema-driven column selection and scalar column helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintage.spec import DATE_PATTERNS

# Aggregates per batch: wider ones overflow the JVM method size limit and lose
# generated code. Batches read disjoint columns, so no column is scanned twice.
BATCH = 40


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in columns if c in have]


def unused(taken: Iterable[str], stem: str) -> str:
    """A column name that is not taken, in any case."""
    names = {c.lower() for c in taken}
    while stem.lower() in names:
        stem += "_"
    return stem


def batches(columns: Sequence[str], size: int = BATCH) -> list[list[str]]:
    return [list(columns[i : i + size]) for i in range(0, len(columns), size)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column, once, at the source."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats})


def parse_timestamp(col: Column, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """First pattern that fits wins; text that fits none becomes NULL."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(p)) for p in patterns])


def date_of(df: DataFrame, column: str, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """Day of a date, timestamp or text column; unparseable text is NULL."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.to_date(parse_timestamp(F.col(column), patterns))
    return F.to_date(F.col(column))


def row_hash(df: DataFrame, columns: Sequence[str], seed: int = 0) -> Column:
    """64-bit hash of a row that also tells apart where its NULLs stand.

    xxhash64 skips NULL inputs, so ("a", NULL) and (NULL, "a") would collide
    without the presence mask.
    """
    mask = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns], mask)


def long_rows(df: DataFrame, structs: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Aggregate once and return one output row per struct of aggregates."""
    agg = df.groupBy(*by).agg(F.array(*structs).alias("_rows"))
    return agg.select(*by, F.inline("_rows"))


def melt(df: DataFrame, columns: Sequence[str], keep: Sequence[Column | str] = (),
         dtype: str = "double", name: str = "column", value: str = "value") -> DataFrame:
    """Long form of some columns, leaving out NULLs."""
    cells = F.array(
        *[F.struct(F.lit(c).alias(name), F.col(c).cast(dtype).alias(value)) for c in columns]
    )
    return df.select(*keep, F.inline(cells)).filter(F.col(value).isNotNull())


def ratio(num: Column, den: Column) -> Column:
    """Double division that yields NULL for a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)
