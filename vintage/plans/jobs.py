"""End-to-end jobs composed from the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.operators import clean, evaluate, features, profile, score, split, train
from vintage.sources.tables import cut_lineage, model_features, write_split
from vintage.spec import FieldRule, LoanSpec


def planned_drops(df: DataFrame, spec: LoanSpec = LoanSpec(), keep: Sequence[str] = ()) -> list[str]:
    """Columns that the validation plan drops: of high leakage risk by name, or mostly missing.

    The target, the date, the row key and ``keep`` stay.
    """
    plan = profile.drop_plan(profile.leakage_by_name(df, spec), profile.high_missing(df))
    stay = {spec.target, spec.date, *spec.row_key, *keep}
    return sorted({r["column"] for r in plan.select("column").collect()} - stay)


def clean_table(df: DataFrame, spec: LoanSpec = LoanSpec(), drop: Sequence[str] | None = None,
                fit_on: str = "all", split_day: dt.date | None = None,
                exclude: Sequence[str] = (), plan: bool = False) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Drop, impute, report outliers, fix types; the table and its reports.

    ``plan`` drops what ``planned_drops`` finds in the table, besides ``drop`` (by default
    the exact names of the specification).

    fit_on="all" takes imputation statistics from the whole table, as the
    published runs did; "train" takes them from rows before ``split_day``,
    which keeps test rows out of them. ``exclude`` names columns never filled,
    such as the target and the date.
    """
    before = df
    found = planned_drops(df, spec, exclude) if plan else []
    names = dict.fromkeys([*(spec.leakage if drop is None else drop), *spec.drop, *found])
    dropped, drop_log = clean.drop_columns(df, list(names), "leakage and high missing values")
    basis = None
    if fit_on == "train":
        if split_day is None:
            raise ValueError("fit_on='train' needs split_day")
        marked = split.temporal_split(dropped, spec.date, split_day)
        basis = marked.filter("split = 'train'").drop("split")
    elif fit_on != "all":
        raise ValueError(f"unknown fit_on: {fit_on}")
    filled, fill_log = clean.impute(dropped, exclude=exclude, fit=basis)
    typed, type_log = clean.type_consistency(filled, [spec.date], spec.date_patterns)
    shapes = _shape("initial", before).unionByName(_shape("final", typed))
    return typed, {
        "drops": drop_log,
        "imputation": fill_log,
        "outliers": clean.outliers_iqr(filled),
        "types": type_log,
        "shapes": shapes,
    }


def _shape(stage: str, df: DataFrame) -> DataFrame:
    return df.agg(
        F.lit(stage).alias("stage"), F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns")
    )


def build_features(df: DataFrame, spec: LoanSpec = LoanSpec(), mode: str = "dev",
                   split_day: dt.date | str | None = None,
                   path: str | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Label, split by date, derive and select features.

    The result is one table with ``target`` and ``split``; with ``path`` it is
    also written, one partition per side. A given split day is checked and, in
    full mode, an invalid one is an error.
    """
    if mode not in ("dev", "full"):
        raise ValueError(f"unknown mode: {mode}")
    labelled = split.map_labels(df, spec.target, spec.labels)
    reports = {}
    if split_day is None:
        split_day = split.split_date(labelled, spec.date, spec.train_ratio)
    else:
        reports["split_check"] = split.check_split_date(labelled, spec.date, split_day, mode)
        _require(reports["split_check"], mode, "split date")
    sides = split.temporal_split(labelled, spec.date, split_day)
    reports["split_validation"] = split.validate_split(sides, spec.date, split_day)
    if mode == "full":
        _require(reports["split_validation"], mode, "temporal split")
    made = features.engineer_features(sides, spec.date)
    out = features.select_features(made, spec.excluded, "target")
    created = sorted(set(made.columns) - set(sides.columns))
    reports["metadata"] = df.sparkSession.createDataFrame(
        [(mode, str(split_day), len(out.columns), created, list(spec.excluded))],
        "mode string, split_date string, columns int, features_created array<string>, "
        "excluded_features array<string>",
    )
    if path:
        write_split(out, path)
    return out, reports


def _require(report: DataFrame, mode: str, what: str) -> None:
    row = report.head()
    if mode == "full" and not row["is_valid"]:
        raise ValueError(f"invalid {what}: {list(row['errors'])}")


def score_models(models: Mapping[str, object], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Scores of several models stacked with a ``model`` column."""
    parts = [
        score.score(df, m, keep).withColumn("model", F.lit(name)) for name, m in models.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def retrain(df: DataFrame, key: Sequence[str], label: str = "target", side: str = "split",
            inputs: Sequence[str] | None = None, models: Sequence[str] = train.MODELS,
            tune: bool = True, metric: str = "roc_auc", **search) -> dict[str, object]:
    """Fit (or tune) on train rows, evaluate on test rows, pick the best.

    Returns the fitted models and the metric, best-model and search tables.
    The feature table is cut from its lineage once: every fit reads it again.
    NULL features get the median of the train side, in a stage of each model, so
    every row is fitted on or scored; ``filled`` counts the rows that had one.
    """
    inputs = list(inputs or features.model_inputs(df, label, key))
    whole = cut_lineage(df.select(*key, label, side, *inputs))
    gaps = reduce(Column.__or__, [F.col(c).isNull() for c in inputs])
    filled = whole.groupBy(side).agg(F.count("*").alias("rows"), F.count_if(gaps).alias("filled"))
    train_rows = whole.filter(F.col(side) == "train")
    test_rows = whole.filter(F.col(side) == "test")
    fill = train.medians(train_rows, inputs)
    tables = []
    fitted = {}
    for name in models:
        if tune:
            fitted[name], scores = train.tune(train_rows, name, inputs, key, label, fill=fill, **search)
            tables.append(scores)
        else:
            fitted[name] = train.fit(train_rows, name, inputs, label, key=key, fill=fill)
    scored = cut_lineage(score_models(fitted, test_rows, [*key, label]))
    metrics = evaluate.evaluate(scored, label)
    return {
        "models": fitted,
        "features": inputs,
        "filled": filled,
        "scored": scored,
        "metrics": metrics,
        "summary": evaluate.evaluation_summary(metrics, metric, models),
        "best": evaluate.best_model(metrics, metric, models),
        "search": reduce(DataFrame.unionByName, tables) if tables else None,
    }


def train_from_raw(raw: DataFrame, spec: LoanSpec = LoanSpec(), mode: str = "dev",
                   plan: bool = True, **options) -> dict[str, object]:
    """Validate, drop by plan, clean, build features, fit or tune, evaluate and pick the best model.

    The target and the date are not imputed: a row without either is no
    training row. The raw table is cut from its lineage once: some ten passes of the
    steps read it, and none of them does its joins again.
    """
    raw = cut_lineage(raw)
    cleaned, reports = clean_table(raw, spec, exclude=[spec.target, spec.date], plan=plan)
    kept = tuple(c for c in spec.excluded if c not in spec.row_key)
    made, more = build_features(cleaned, replace(spec, excluded=kept), mode)
    result = retrain(made, spec.row_key, **options)
    return {**result, "reports": {**reports, **more}}


def score_applications(df: DataFrame, model: PipelineModel, rules: Sequence[FieldRule], keep: Sequence[str],
                       ordered: Sequence[tuple[str, str]] = (("fico_range_low", "fico_range_high"),),
                       issue: str = "issue_d") -> tuple[DataFrame, DataFrame]:
    """Check, default, derive, align and score; (scored rows, rejected rows).

    Stateless, so it takes a table or a stream. A rejected row lists its broken
    rules, or the model features that are still NULL.
    """
    inputs = model_features(model)
    checked = score.check_rules(df, rules, ordered)
    filled = features.complete_features(score.apply_defaults(checked, rules), issue)
    aligned = score.align(filled, inputs, [*keep, "violations"])
    broken = F.when(F.size("violations") > 0, F.col("violations")).otherwise(
        F.transform("null_features", lambda c: F.concat(c, F.lit(":null")))
    )
    judged = aligned.withColumn("violations", broken).drop("null_features")
    scored = score.predict(score.valid_rows(judged), model, keep)
    return scored, score.rejected_rows(judged).select(*keep, "violations")


def validation_report(df: DataFrame, spec: LoanSpec = LoanSpec(), ongoing: Sequence[str] = (),
                      sample: DataFrame | None = None) -> DataFrame:
    """Names-based and data-based findings as (section, name, metric, value).

    ``sample`` limits the data part to a sample, as the layered original does;
    by default it covers the whole table.
    """
    data = df if sample is None else sample
    leakage = profile.leakage_by_name(df, spec)
    missing = profile.high_missing(data)
    plan = profile.drop_plan(leakage, missing)
    rows = profile.metric_rows
    parts = [
        rows("leakage", leakage.groupBy("risk").agg(F.count("*").alias("columns")), "risk", ["columns"]),
        rows("missing", profile.missing_ranking(data), "column", ["missing", "pct"]),
        rows("target", profile.value_distribution(data, spec.target), "value", ["count", "pct"]),
        rows("dates", profile.date_profile(data, spec.date), None, ["missing", "pct"]),
        rows(
            "split",
            split.split_suggestions(data, spec.date).withColumn("day", F.date_format("split_date", "yyyy-MM-dd")),
            "day",
            ["ratio", "train_rows", "test_rows"],
        ),
        rows(
            "drops",
            profile.drop_summary(df, plan),
            None,
            ["total_columns", "drop_leakage", "drop_missing", "remaining_columns"],
        ),
    ]
    if ongoing:
        parts.append(rows("ongoing", profile.membership_share(data, spec.target, ongoing), None, ["count", "pct"]))
    return reduce(DataFrame.unionByName, parts)
