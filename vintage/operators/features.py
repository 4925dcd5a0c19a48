"""Derived columns, column selection and segment rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.functions.columns import date_of, numeric_columns, present, ratio
from vintage.spec import EXCLUDED_FEATURES, TARGET_COLUMN


def feature_columns(df: DataFrame, issue: str = "issue_d",
                    earliest: str = "earliest_cr_line") -> dict[str, Column]:
    """Expressions of the engineered features whose inputs exist.

    Training and scoring share these definitions. Zero denominators give NULL.
    """
    have = set(df.columns)

    def day(c):
        return date_of(df, c)

    recipes = {
        "funded_to_loan_ratio": (
            ("funded_amnt", "loan_amnt"),
            lambda: ratio(F.col("funded_amnt"), F.col("loan_amnt")),
        ),
        "installment_to_income_ratio": (
            ("installment", "annual_inc"),
            lambda: ratio(F.col("installment"), F.col("annual_inc")),
        ),
        "fico_midpoint": (
            ("fico_range_low", "fico_range_high"),
            lambda: (F.col("fico_range_low") + F.col("fico_range_high")).cast("double") / 2,
        ),
        "fico_range": (
            ("fico_range_low", "fico_range_high"),
            lambda: F.col("fico_range_high") - F.col("fico_range_low"),
        ),
        "credit_history_years": (
            (issue, earliest),
            lambda: F.datediff(day(issue), day(earliest)) / F.lit(365.25).cast("double"),
        ),
        "issue_year": ((issue,), lambda: F.year(day(issue))),
        "issue_month": ((issue,), lambda: F.month(day(issue))),
    }
    return {name: make() for name, (needs, make) in recipes.items() if have.issuperset(needs)}


def engineer_features(df: DataFrame, issue: str = "issue_d",
                      earliest: str = "earliest_cr_line") -> DataFrame:
    """Add every feature whose inputs are present; skip the others."""
    return df.withColumns(feature_columns(df, issue, earliest))


def complete_features(df: DataFrame, issue: str = "issue_d",
                      earliest: str = "earliest_cr_line") -> DataFrame:
    """Compute features only where the caller left them NULL or absent."""
    made = feature_columns(df, issue, earliest)
    filled = {n: F.coalesce(F.col(n), e) if n in df.columns else e for n, e in made.items()}
    return df.withColumns(filled)


def select_features(df: DataFrame, excluded: Sequence[str] = EXCLUDED_FEATURES,
                    target: str = TARGET_COLUMN) -> DataFrame:
    """Drop the excluded columns but never the target."""
    return df.drop(*[c for c in present(df, excluded) if c != target])


def model_inputs(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns that reach a model."""
    if target not in df.columns:
        raise ValueError(f"target column '{target}' not found")
    skip = {target, *exclude}
    return [c for c in numeric_columns(df) if c not in skip]


def feature_matrix(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """(features vector, label); a NULL feature is an error, as in training."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    cast = df.select(F.col(target).cast("double").alias("label"), *[F.col(c).cast("double") for c in features])
    return assembler.transform(cast).select("features", "label")


def join_segment_rate(df: DataFrame, history: DataFrame, segment: str, flag: Column,
                      out: str = "rejection_rate") -> DataFrame:
    """Share of flagged history rows per segment, joined to every row.

    Rates are aggregated before the join. No broadcast is forced: Spark uses
    one when the measured rate table is small and splits hot segments if not.
    """
    rates = history.groupBy(F.col(segment).alias("_segment")).agg(
        F.avg(flag.cast("double")).alias(out)
    )
    return df.join(rates, df[segment] == rates["_segment"], "left").drop("_segment")
