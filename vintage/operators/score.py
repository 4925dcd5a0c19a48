"""Input rules, feature alignment and scoring; the same for batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.spec import APPLICATION_FIELDS, FieldRule, parse_rules


def application_rules() -> list[FieldRule]:
    return parse_rules(APPLICATION_FIELDS)


def _field(df: DataFrame, rule: FieldRule) -> Column:
    if rule.name not in df.columns:
        return F.lit(None).cast(rule.dtype)
    return F.col(rule.name).try_cast(rule.dtype)


def apply_defaults(df: DataFrame, rules: Sequence[FieldRule]) -> DataFrame:
    """Type every ruled field and put its default where it is NULL or absent."""
    filled = {}
    for r in rules:
        value = _field(df, r)
        filled[r.name] = value if r.default is None else F.coalesce(value, F.lit(r.default).cast(r.dtype))
    return df.withColumns(filled)


def check_rules(df: DataFrame, rules: Sequence[FieldRule],
                ordered: Sequence[tuple[str, str]] = (), out: str = "violations") -> DataFrame:
    """Add the list of broken rules of each row, empty for a valid row.

    Codes are field:required, field:type, field:min, field:max and, for each
    (low, high) pair in ``ordered``, high<low.
    """
    codes = []
    for r in rules:
        value = _field(df, r)
        if r.required:
            absent = F.col(r.name).isNull() if r.name in df.columns else F.lit(True)
            codes.append(F.when(absent, f"{r.name}:required"))
        if r.name in df.columns:
            codes.append(F.when(F.col(r.name).isNotNull() & value.isNull(), f"{r.name}:type"))
        if r.low is not None:
            codes.append(F.when(value < F.lit(r.low), f"{r.name}:min"))
        if r.high is not None:
            codes.append(F.when(value > F.lit(r.high), f"{r.name}:max"))
    by_name = {r.name: r for r in rules}
    for low, high in ordered:
        a, b = (_field(df, by_name.get(n, FieldRule(n))) for n in (low, high))
        codes.append(F.when(b < a, f"{high}<{low}"))
    return df.withColumn(out, F.array_compact(F.array(*codes)))


def valid_rows(checked: DataFrame, column: str = "violations") -> DataFrame:
    return checked.filter(F.size(column) == 0).drop(column)


def rejected_rows(checked: DataFrame, column: str = "violations") -> DataFrame:
    return checked.filter(F.size(column) > 0)


def violation_counts(checked: DataFrame, column: str = "violations") -> DataFrame:
    """Rows per broken rule."""
    codes = checked.select(F.explode(column).alias("violation"))
    return codes.groupBy("violation").agg(F.count("*").alias("rows"))


def align(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (),
          out: str = "null_features") -> DataFrame:
    """Model features in model order as doubles, with the list that is NULL.

    A column the table lacks is an error; columns the model does not know are
    left out. Rows with a non-empty list must be rejected, not scored.
    """
    missing = sorted(set(features) - set(df.columns))
    if missing:
        raise ValueError(f"missing required features: {missing}")
    numbers = df.select(*keep, *[F.col(c).try_cast("double").alias(c) for c in features])
    nulls = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in features])
    return numbers.withColumn(out, F.array_compact(nulls))


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def score(df: DataFrame, model: PipelineModel, keep: Sequence[str] = ()) -> DataFrame:
    """The model's own class and its positive-class probability."""
    scored = model.transform(df)
    return scored.select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        positive_probability().alias("probability"),
    )


def predict(df: DataFrame, model: PipelineModel, keep: Sequence[str] = (),
            threshold: float = 0.5) -> DataFrame:
    """Serving form: class 1 when the probability reaches the threshold."""
    scored = score(df, model, keep)
    return scored.withColumn("prediction", (F.col("probability") >= threshold).cast("int"))
