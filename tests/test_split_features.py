"""Sampling, splits, labels and features."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vintage.operators import features, sample, split
from vintage.plans import jobs
from vintage.spec import LoanSpec


def dates(spark, days):
    rows = [(i, None if d is None else f"2020-01-{d:02d}") for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "id int, issue_d string")


@pytest.mark.parametrize("ratio", [0.8, 0.7, 0.5, 0.29, 0.0])
def test_split_date_is_the_element_of_the_sorted_dates(spark, ratio):
    days = [3, 3, 1, 9, 9, 9, 4, 2, 2, 10]
    want = sorted(days)[int(len(days) * ratio)]
    assert split.split_date(dates(spark, [*days, None]), "issue_d", ratio) == dt.date(2020, 1, want)


def test_split_date_errors(spark):
    with pytest.raises(ValueError):
        split.split_date(dates(spark, [None]), "issue_d")
    with pytest.raises(IndexError):
        split.split_date(dates(spark, [1, 2]), "issue_d", 1.0)


def test_suggestions_divide_by_all_rows(spark):
    row = split.split_suggestions(dates(spark, [1, 2, 3, 4, None]), "issue_d", [0.5]).head()
    assert (row.train_rows, row.test_rows, row.train_pct) == (2, 2, 40.0)


def test_ties_go_to_test_and_null_dates_vanish(spark):
    df = dates(spark, [1, 2, 2, 2, 3, None])
    sides = split.temporal_split(df, "issue_d", "2020-01-02")
    assert [r.split for r in sides.orderBy("id").collect()] == ["train", "test", "test", "test", "test"]
    report = split.validate_split(sides, "issue_d", "2020-01-02").head()
    assert report.is_valid and report.overlap_count == 0 and report.warnings == []


@pytest.mark.parametrize(
    "day, mode, errors, warnings",
    [
        ("2019-12-31", "full", ["before_range"], []),
        ("2020-02-01", "dev", ["after_range"], []),
        ("2020-01-01", "full", ["empty_train"], []),
        ("2020-01-01", "dev", [], ["empty_train"]),
        ("2020-01-02", "full", [], ["small_test", "small_train"]),
        ("2020-01-02", "dev", [], []),
    ],
)
def test_split_date_checks(spark, day, mode, errors, warnings):
    row = split.check_split_date(dates(spark, [1, 2, 3, None]), "issue_d", day, mode).head()
    assert (row.errors, row.warnings, row.is_valid) == (errors, warnings, not errors)


def test_split_check_without_dates(spark):
    assert split.check_split_date(dates(spark, [None]), "issue_d", "2020-01-01").head().errors == ["no_dates"]


def test_validation_finds_wrong_rows_and_empty_sides(spark):
    df = dates(spark, [1, 5, 9]).withColumn("split", F.when(F.col("id") == 1, "test").otherwise("train"))
    row = split.validate_split(df, "issue_d", "2020-01-06").head()
    assert row.errors == ["late_rows_in_train", "early_rows_in_test"] and row.overlap_count == 2
    assert row.warnings == ["overlap"]
    row = split.validate_split(df.withColumn("split", F.lit("train")), "issue_d", "2020-02-01").head()
    assert row.errors == ["empty_test"]


def test_labels_drop_excluded_and_unknown(spark):
    df = spark.createDataFrame([("Fully Paid",), ("Default",), ("Current",), ("?",), (None,)], "loan_status string")
    got = {r.loan_status: r.target for r in split.map_labels(df, "loan_status", LoanSpec().labels).collect()}
    assert got == {"Fully Paid": 0, "Default": 1}


@pytest.fixture(scope="module")
def months(spark):
    # month 1 holds most rows, month 2 two, month 3 one, some rows have no date
    rows = [(i, "2020-01-15" if i < 90 else "2020-02-01" if i < 92 else "2020-03-01" if i < 93 else None) for i in range(100)]
    return spark.createDataFrame(rows, "id int, d string")


@pytest.mark.parametrize("size", [1, 2, 10, 50, 100, 1000])
def test_month_quotas_and_sample(months, size):
    counts = {"2020-01": 90, "2020-02": 2, "2020-03": 1}
    want = {m: min(max(1, int(size * (c / 100))), c) for m, c in counts.items()}
    got = {r.month: r.quota for r in sample.month_quotas(months, "d", size).collect()}
    assert got == want
    drawn = sample.stratified_sample(months, "d", ["id"], size).collect()
    assert len(drawn) == len({r.id for r in drawn}) == min(sum(want.values()), size)
    assert all(r.d for r in drawn)


def test_sample_does_not_depend_on_partitioning(months):
    a = {r.id for r in sample.stratified_sample(months, "d", ["id"], 30).collect()}
    b = {r.id for r in sample.stratified_sample(months.repartition(9), "d", ["id"], 30).collect()}
    c = {r.id for r in sample.stratified_sample(months, "d", ["id"], 30, seed=7).collect()}
    assert a == b and a != c


def test_diversity(months, spark):
    assert sample.date_diversity(months, "d").head().distinct_dates == 3
    assert sample.date_diversity(dates(spark, [1, 1, None]), "issue_d").head().too_few


def test_features_by_hand(spark):
    df = spark.createDataFrame(
        [(100.0, 80.0, 12.0, 1200.0, 700, 704, "Dec-2015", "Dec-2005"), (0.0, 5.0, 1.0, 0.0, 650, 654, "bad", "Jan-2000")],
        "loan_amnt double, funded_amnt double, installment double, annual_inc double, "
        "fico_range_low int, fico_range_high int, issue_d string, earliest_cr_line string",
    )
    a, b = features.engineer_features(df).collect()
    assert (a.funded_to_loan_ratio, a.installment_to_income_ratio, a.fico_midpoint, a.fico_range) == (0.8, 0.01, 702.0, 4)
    assert a.credit_history_years == pytest.approx(3652 / 365.25)
    assert (a.issue_year, a.issue_month) == (2015, 12)
    assert b.funded_to_loan_ratio is None and b.installment_to_income_ratio is None
    assert b.credit_history_years is None and b.issue_year is None


def test_absent_inputs_skip_the_feature(spark):
    df = spark.createDataFrame([(1.0,)], "loan_amnt double")
    assert features.engineer_features(df).columns == ["loan_amnt"]


def test_complete_keeps_given_values(spark):
    df = spark.createDataFrame([(1, 3, 9.0), (1, 3, None)], "fico_range_low int, fico_range_high int, fico_midpoint double")
    assert [r.fico_midpoint for r in features.complete_features(df).collect()] == [9.0, 2.0]


def test_selection_keeps_the_target(spark):
    df = spark.createDataFrame([(1, "u", 1, 2.0, "t")], "id int, url string, target int, x double, s string")
    assert features.select_features(df, ["id", "url", "target"], "target").columns == ["target", "x", "s"]
    assert features.model_inputs(df, "target", ["id"]) == ["x"]
    with pytest.raises(ValueError):
        features.model_inputs(df, "missing")
    row = features.feature_matrix(df, "target", ["x", "id"]).head()
    assert list(row.features) == [2.0, 1.0] and row.label == 1.0


def test_segment_rates(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("z",)], "seg string")
    history = spark.createDataFrame([("a", True), ("a", False), ("b", False)], "seg string, rejected boolean")
    got = {r.seg: r.rejection_rate for r in features.join_segment_rate(rows, history, "seg", F.col("rejected")).collect()}
    assert got == {"a": 0.5, "b": 0.0, "z": None}


def test_build_features(spark, tmp_path):
    rows = [(i, "Fully Paid" if i % 3 else "Charged Off", f"2015-{1 + i % 12:02d}-01", 10.0, 5.0) for i in range(48)]
    df = spark.createDataFrame(rows, "id int, loan_status string, issue_d string, loan_amnt double, funded_amnt double")
    out, reports = jobs.build_features(df, path=str(tmp_path / "f"), mode="full")
    meta = reports["metadata"].head()
    assert meta.features_created == ["funded_to_loan_ratio", "issue_month", "issue_year"]
    assert "id" not in out.columns
    back = spark.read.parquet(str(tmp_path / "f"))
    assert back.count() == out.count() == 48
    with pytest.raises(ValueError):
        jobs.build_features(df, mode="full", split_day="1999-01-01")
    lenient, reports = jobs.build_features(df, mode="dev", split_day="1999-01-01")
    assert lenient.count() == 48 and not reports["split_check"].head().is_valid
    with pytest.raises(ValueError):
        jobs.build_features(df, mode="fast")
