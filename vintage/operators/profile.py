"""Column profiles, missing values, value distributions and leakage screens."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.functions import ordering
from vintage.functions.columns import batches, date_of, long_rows, melt, numeric_columns, percent
from vintage.operators.evaluate import areas, ranked_counts
from vintage.spec import LoanSpec


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def column_profile(df: DataFrame, columns: Sequence[str] | None = None,
                   exact: bool = False) -> DataFrame:
    """Type, rows, nulls, distinct values, min and max (as text) per column.

    Approximate distinct counts take one pass over all columns. Exact ones
    count each column's values apart, so only single values are shuffled and
    equal ones are merged before that.
    """
    columns = list(columns or df.columns)
    kinds = {c: df.schema[c].dataType.simpleString() for c in columns}
    if exact:
        return _union([_exact_profile(df, c, kinds[c]) for c in columns])
    parts = []
    for batch in batches(columns):
        structs = [
            F.struct(
                F.lit(c).alias("column"),
                F.lit(kinds[c]).alias("type"),
                F.count("*").alias("rows"),
                (F.count("*") - F.count(c)).alias("nulls"),
                F.approx_count_distinct(c).alias("distinct"),
                F.min(c).cast("string").alias("min"),
                F.max(c).cast("string").alias("max"),
            )
            for c in batch
        ]
        parts.append(long_rows(df, structs))
    return _union(parts)


def _exact_profile(df: DataFrame, column: str, kind: str) -> DataFrame:
    values = df.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    return values.agg(
        F.lit(column).alias("column"),
        F.lit(kind).alias("type"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("v").alias("distinct"),
        F.min("v").cast("string").alias("min"),
        F.max("v").cast("string").alias("max"),
    )


def type_histogram(profile: DataFrame) -> DataFrame:
    """How many columns of a profile have each type."""
    return profile.groupBy("type").agg(F.count("*").alias("columns"))


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None,
                    only_missing: bool = True) -> DataFrame:
    """Missing count and percentage of all rows, one row per column."""
    parts = []
    for batch in batches(list(columns or df.columns)):
        structs = [
            F.struct(
                F.lit(c).alias("column"),
                (F.count("*") - F.count(c)).alias("missing"),
                F.coalesce(percent(F.count("*") - F.count(c), F.count("*")), F.lit(0.0)).alias("pct"),
            )
            for c in batch
        ]
        parts.append(long_rows(df, structs))
    out = _union(parts)
    return out.filter("missing > 0") if only_missing else out


def missing_ranking(df: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` columns with the largest share of missing values."""
    ranked = missing_profile(df, only_missing=False)
    return ranked.orderBy(F.desc("pct"), "column").limit(k)


def high_missing(df: DataFrame, threshold: float = 50.0,
                 max_columns: int | None = None) -> DataFrame:
    """Columns above ``threshold`` percent missing, worst first; all of them unless limited."""
    found = missing_profile(df).filter(F.col("pct") > threshold).orderBy(F.desc("pct"), "column")
    return found if max_columns is None else found.limit(max_columns)


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None,
                   digest: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first of each identical row, and their percentage.

    Long text named in ``digest`` is compared by SHA-256, which keeps the
    shuffle at 64 bytes a row however long the text is.
    """
    keys = [
        F.sha2(F.col(c), 256).alias(c) if c in digest else F.col(c) for c in columns or df.columns
    ]
    groups = df.select(*keys).groupBy(*(columns or df.columns)).agg(F.count("*").alias("n"))
    rows, extra = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return groups.agg(
        rows.alias("rows"),
        extra.alias("duplicates"),
        F.coalesce(percent(extra, rows), F.lit(0.0)).alias("pct"),
    )


def table_stats(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and their percentage in one pass."""
    columns = df.columns
    present_cells = sum((F.count(c) for c in columns), F.lit(0))
    cells = F.count("*") * F.lit(len(columns))
    return df.agg(
        F.count("*").alias("rows"),
        F.lit(len(columns)).alias("columns"),
        (cells - present_cells).cast("long").alias("missing_cells"),
        F.round(F.coalesce(percent(cells - present_cells, cells), F.lit(0.0)), 2).alias("missing_pct"),
    )


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of all rows per non-NULL value, most frequent first.

    The total is a scalar subquery over no columns at all, so it is answered
    from file footers where the source keeps row counts.
    """
    rows = df.select(F.col(column).alias("value")).filter("value IS NOT NULL")
    counts = rows.groupBy("value").agg(F.count("*").alias("count"))
    total = df.agg(F.count("*").alias("total"))
    return (
        counts.select("value", "count", percent(F.col("count"), total.scalar()).alias("pct"))
        .orderBy(F.desc("count"), "value")
    )


def membership_share(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """How many rows have one of ``values``, and their percentage of all rows."""
    hits = F.count_if(F.col(column).isin(*values))
    return df.agg(
        hits.alias("count"),
        F.coalesce(percent(hits, F.count("*")), F.lit(0.0)).alias("pct"),
    )


def date_profile(df: DataFrame, column: str) -> DataFrame:
    """First and last day, and the values missing after coercion."""
    missing = F.count("*") - F.count("_d")
    return df.select(date_of(df, column).alias("_d")).agg(
        F.min("_d").alias("min_date"),
        F.max("_d").alias("max_date"),
        missing.alias("missing"),
        F.coalesce(percent(missing, F.count("*")), F.lit(0.0)).alias("pct"),
    )


def top_dates(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent days, earlier first among equals."""
    days = df.select(date_of(df, column).alias("day")).filter("day IS NOT NULL")
    counts = days.groupBy("day").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "day").limit(n)


def leakage_risk(column: Column, spec: LoanSpec = LoanSpec()) -> Column:
    """high, medium, safe or target from a column's name."""
    lower = F.lower(column)

    def mentions(words):
        return reduce(Column.__or__, [F.contains(lower, F.lit(w)) for w in words], F.lit(False))

    return (
        F.when(column.isin(*spec.leakage) | mentions(spec.high_keywords), "high")
        .when(mentions(spec.medium_keywords), "medium")
        .when(column == spec.target, "target")
        .otherwise("safe")
    )


def leakage_by_name(df: DataFrame, spec: LoanSpec = LoanSpec()) -> DataFrame:
    """Risk class of every column; the target itself is listed in no class."""
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column string")
    rated = names.select("column", leakage_risk(F.col("column"), spec).alias("risk"))
    return rated.filter("risk != 'target'")


def leakage_screen(df: DataFrame, label: str, columns: Sequence[str] | None = None,
                   spec: LoanSpec = LoanSpec()) -> DataFrame:
    """Name-based risk plus what the data says: NULL rate and one-feature AUC.

    A column that separates the classes almost alone (AUC near 0 or 1) is a
    leakage suspect whatever its name.
    """
    columns = [c for c in columns or numeric_columns(df) if c != label]
    labelled = df.filter(F.col(label).isNotNull())
    rows = labelled.count()
    long = melt(labelled, columns, keep=[F.col(label).cast("long").alias("label")])
    cuts = ordering.cut_points(long, "value", ordering.buckets_for(rows * len(columns)))
    ranked = ranked_counts(long, "label", "value", ["column"], cuts)
    scores = ranked.groupBy("column").agg(
        *areas(), (F.max("positives") + F.max("negatives")).alias("filled")
    )
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    missing = F.lit(rows) - F.coalesce("filled", F.lit(0))
    return names.join(scores, "column", "left").select(
        "column",
        leakage_risk(F.col("column"), spec).alias("risk"),
        F.coalesce(percent(missing, F.lit(rows)), F.lit(0.0)).alias("null_pct"),
        F.col("roc_auc").alias("auc"),
    )


def drop_plan(leakage: DataFrame, missing: DataFrame) -> DataFrame:
    """Columns to drop with the reasons that apply, one row per column."""
    left = leakage.filter("risk = 'high'").select("column", F.lit(True).alias("leakage"))
    right = missing.select("column", F.lit(True).alias("high_missing"))
    return left.join(right, "column", "full_outer").select(
        "column",
        F.coalesce("leakage", F.lit(False)).alias("leakage"),
        F.coalesce("high_missing", F.lit(False)).alias("high_missing"),
    )


def drop_summary(df: DataFrame, plan: DataFrame) -> DataFrame:
    """Column totals of a drop plan; a column with two reasons counts once."""
    return plan.agg(
        F.lit(len(df.columns)).alias("total_columns"),
        F.count_if("leakage").alias("drop_leakage"),
        F.count_if("high_missing").alias("drop_missing"),
        (F.lit(len(df.columns)) - F.count("*")).alias("remaining_columns"),
    )


def vintage_profile(df: DataFrame, vintage: Column, expected: Mapping[str, str]) -> DataFrame:
    """Non-NULL rate and share of castable values per vintage and column.

    One aggregation row per vintage carries all columns, so the table is never
    multiplied by its number of columns.
    """
    parts = []
    for batch in batches(list(expected)):
        structs = [
            F.struct(
                F.lit(c).alias("column"),
                F.count("*").alias("rows"),
                percent(F.count(c), F.count("*")).alias("filled_pct"),
                percent(F.count(F.col(c).try_cast(expected[c])), F.count(c)).alias("castable_pct"),
            )
            for c in batch
        ]
        parts.append(long_rows(df.withColumn("vintage", vintage), structs, by=["vintage"]))
    return _union(parts)


def vintage_consistency(profile: DataFrame, min_castable: float = 100.0) -> DataFrame:
    """Per column: is it in every vintage, and does its type ever conflict?"""
    filled = F.col("filled_pct") > 0
    return (
        profile.groupBy("column")
        .agg(
            F.count("*").alias("vintages"),
            F.count_if(filled).alias("vintages_present"),
            F.count_if(filled & (F.col("castable_pct") < min_castable)).alias("type_conflicts"),
        )
        .select(
            "column",
            "vintages",
            "vintages_present",
            "type_conflicts",
            F.when(F.col("vintages_present") == F.col("vintages"), "common")
            .when(F.col("vintages_present") == 1, "unique")
            .otherwise("partial")
            .alias("presence"),
        )
    )


def schema_consistency(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Which named tables have each column, and under how many types.

    The tables are stacked by name as text, so a table without a column
    contributes only NULLs for it and a column's type is what its values say.
    """
    typed: dict[str, set[str]] = {}
    for df in tables.values():
        for f in df.schema:
            typed.setdefault(f.name, set()).add(f.dataType.simpleString())
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            df.select(F.lit(name).alias("_table"), *[F.col(c).cast("string") for c in df.columns])
            for name, df in tables.items()
        ],
    )
    per_table = _union(
        [
            long_rows(
                stacked,
                [F.struct(F.lit(c).alias("column"), F.count(c).alias("filled")) for c in batch],
                by=["_table"],
            )
            for batch in batches(list(typed))
        ]
    )
    declared = F.create_map(*[F.lit(v) for c, t in typed.items() for v in (c, len(t))])
    return per_table.groupBy("column").agg(
        F.count_if(F.col("filled") > 0).alias("tables_present"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("filled") > 0, F.col("_table")))), ",").alias("found_in"),
        F.sum("filled").alias("values"),
    ).withColumn("declared_types", declared[F.col("column")])


def metric_rows(section: str, df: DataFrame, name: str | None, metrics: Sequence[str]) -> DataFrame:
    """Any report as (section, name, metric, value) rows."""
    key = F.col(name).cast("string") if name else F.lit(None).cast("string")
    cells = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    )
    return df.select(F.lit(section).alias("section"), key.alias("name"), F.inline(cells))
