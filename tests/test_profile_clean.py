"""Profiling and cleaning on small frames with known answers."""

import math

import pytest
from pyspark.sql import functions as F

from vintage.functions.columns import nan_to_null, row_hash
from vintage.operators import clean, profile
from vintage.plans import jobs
from vintage.spec import LoanSpec


def one(df):
    return df.head().asDict()


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def gaps(spark):
    rows = [
        (1, 1.0, "a", None),
        (2, None, "b", None),
        (3, 3.0, None, 5),
        (4, 10.0, "b", None),
        (5, None, "a", None),
    ]
    return spark.createDataFrame(rows, "id long, x double, s string, k int")


def test_nan_counts_as_missing(spark):
    df = nan_to_null(spark.createDataFrame([(math.nan,), (2.0,)], "x double"))
    assert one(profile.missing_profile(df))["missing"] == 1


def test_row_hash_sees_where_the_null_stands(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "p string, q string")
    assert df.select(row_hash(df, ["p", "q"])).distinct().count() == 2


def test_missing_profile_and_high_missing(gaps):
    assert by(profile.missing_profile(gaps), "column")["x"]["pct"] == 40.0
    assert "id" not in by(profile.missing_profile(gaps), "column")
    assert [r.column for r in profile.high_missing(gaps).collect()] == ["k"]
    assert [r.column for r in profile.missing_ranking(gaps, 2).collect()] == ["k", "x"]


def test_exactly_half_missing_is_not_high(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert profile.high_missing(df).count() == 0


def test_table_stats(gaps):
    assert one(profile.table_stats(gaps)) == {"rows": 5, "columns": 4, "missing_cells": 7, "missing_pct": 35.0}


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (1, None)], "a int, b string")
    assert one(profile.duplicate_rows(df)) == {"rows": 4, "duplicates": 2, "pct": 50.0}
    assert one(profile.duplicate_rows(df, digest=["b"]))["duplicates"] == 2


def test_distribution_divides_by_all_rows(gaps):
    found = profile.value_distribution(gaps, "s").collect()
    assert [(r.value, r["count"], r.pct) for r in found] == [("a", 2, 40.0), ("b", 2, 40.0)]


def test_reports_on_an_empty_table(gaps):
    empty = gaps.filter("id < 0")
    assert one(profile.table_stats(empty))["missing_pct"] == 0.0
    assert one(profile.membership_share(empty, "s", ["a"])) == {"count": 0, "pct": 0.0}
    assert one(profile.duplicate_rows(empty)) == {"rows": 0, "duplicates": 0, "pct": 0.0}


@pytest.mark.parametrize("exact", [True, False])
def test_column_profile(gaps, exact):
    found = by(profile.column_profile(gaps, exact=exact), "column")
    assert found["s"] == {
        "column": "s", "type": "string", "rows": 5, "nulls": 1, "distinct": 2, "min": "a", "max": "b",
    }
    kinds = {r.type: r.columns for r in profile.type_histogram(profile.column_profile(gaps)).collect()}
    assert kinds == {"bigint": 1, "double": 1, "string": 1, "int": 1}


def test_leakage_names(spark):
    columns = "recoveries Hardship_Flag last_fico_range_high issue_d loan_status annual_inc".split()
    df = spark.createDataFrame([tuple("x" * 6)], columns)
    risk = {r.column: r.risk for r in profile.leakage_by_name(df).collect()}
    assert risk == {
        "recoveries": "high", "Hardship_Flag": "high", "last_fico_range_high": "medium",
        "issue_d": "medium", "annual_inc": "safe",
    }


def test_leakage_screen_scores_a_perfect_column(spark):
    rows = [(i, float(i >= 5), None, int(i >= 5)) for i in range(10)]
    df = spark.createDataFrame(rows, "n int, perfect double, empty double, y int")
    found = by(profile.leakage_screen(df, "y"), "column")
    assert found["perfect"]["auc"] == 1.0
    assert found["empty"]["auc"] is None and found["empty"]["null_pct"] == 100.0


def test_drop_plan_counts_a_shared_column_once(spark):
    df = spark.createDataFrame([(None, None, 1)], "payment_plan_start_date string, other string, x int")
    plan = profile.drop_plan(profile.leakage_by_name(df), profile.high_missing(df))
    assert one(profile.drop_summary(df, plan)) == {
        "total_columns": 3, "drop_leakage": 1, "drop_missing": 2, "remaining_columns": 1,
    }


def test_schema_consistency_names_the_odd_column(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("1",)], "k string")
    found = by(profile.schema_consistency({"a": a, "b": b}), "column")
    assert found["k"]["declared_types"] == 2 and found["k"]["found_in"] == "a,b"
    assert found["a"]["tables_present"] == 1


def test_impute_median_and_smallest_mode(gaps):
    filled, log = clean.impute(gaps)
    rows = by(filled, "id")
    assert rows[2]["x"] == 3.0 and rows[3]["s"] == "a" and rows[1]["k"] == 5.0
    assert by(log, "column")["x"] == {
        "column": "x", "type": "numeric", "method": "median", "fill_value": "3.0",
        "missing_before": 2, "missing_after": 0,
    }


def test_impute_even_count_interpolates(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert 1.5 in [r.x for r in clean.impute(df)[0].collect()]


def test_impute_other_methods(gaps):
    assert by(clean.impute(gaps, "mean", "unknown")[0], "id")[2]["x"] == pytest.approx(14 / 3)
    assert by(clean.impute(gaps, "mean", "unknown")[0], "id")[3]["s"] == "Unknown"
    assert by(clean.impute(gaps, "zero")[0], "id")[1]["k"] == 0
    assert clean.impute(gaps, "drop", "drop")[0].count() == 0
    with pytest.raises(ValueError):
        clean.impute(gaps, "best")


def test_impute_can_skip_columns_and_leave_all_null_ones(spark, gaps):
    kept, log = clean.impute(gaps, exclude=["x"])
    assert by(kept, "id")[2]["x"] is None and "x" not in by(log, "column")
    empty = spark.createDataFrame([(1, None), (2, None)], "id int, z double")
    filled, log = clean.impute(empty)
    assert filled.filter("z is not null").count() == 0
    assert one(log)["missing_after"] == 2


def test_impute_uses_the_statistics_of_fit(gaps):
    filled, _ = clean.impute(gaps, fit=gaps.filter("id <= 3"))
    assert by(filled, "id")[5]["x"] == 2.0


def test_indicators(gaps):
    marked = clean.add_missing_indicators(gaps, ["x"])
    assert [r.x_missing for r in marked.orderBy("id").collect()] == [0, 1, 0, 0, 1]


def test_impute_by_group_with_a_null_block(spark):
    rows = [("a", 1.0, "p"), ("a", None, None), ("a", 4.0, "q"), (None, None, "z"), (None, 7.0, None), ("c", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, s string")
    got = sorted(map(str, (tuple(r) for r in clean.impute_by_group(df, ["g"], ["x"], ["s"]).collect())))
    want = [("a", 1.0, "p"), ("a", 2.5, "p"), ("a", 4.0, "q"), (None, 7.0, "z"), (None, 7.0, "z"), ("c", None, None)]
    assert got == sorted(map(str, want))


def test_iqr_is_strict_and_counts_against_all_rows(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)] + [(None,)], "x double")
    found = one(clean.outliers_iqr(df))
    assert (found["count"], found["lower_bound"], found["upper_bound"]) == (1, -1.0, 7.0)
    assert found["pct"] == pytest.approx(100 / 6)
    edge = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 7)], "x double")
    assert one(clean.outliers_iqr(edge))["count"] == 0


def test_iqr_large_table_route_agrees(spark):
    df = spark.range(3000).select((F.hash("id") % 997).cast("double").alias("x"))
    assert clean.outliers_iqr(df).collect() == clean.outliers_iqr(df, limit=0).collect()


def test_zscore_with_zero_deviation(spark):
    df = spark.createDataFrame([(1.0, float(i == 0)) for i in range(30)], "flat double, spike double")
    found = by(clean.outliers_zscore(df), "column")
    assert found["flat"]["count"] == 0 and found["spike"]["count"] == 1
    top = clean.outlier_top(clean.outliers_zscore(df), 1).head()
    assert (top.column, top.total_count) == ("spike", 1)


def test_dates_of_either_form_and_junk(spark):
    df = spark.createDataFrame([("Dec-2015",), ("2015-12-09",), ("soon",), (None,)], "issue_d string")
    got = [r[0] and r[0].strftime("%Y-%m-%d") for r in clean.coerce_dates(df, ["issue_d"]).collect()]
    assert got == ["2015-12-01", "2015-12-09", None, None]
    assert one(profile.date_profile(df, "issue_d"))["missing"] == 2


def test_type_consistency(spark):
    df = spark.createDataFrame([("7", 1, "Jan-2016"), ("8", None, "x")], "member_Id string, k int, issue_d string")
    typed, log = clean.type_consistency(df, ["issue_d"])
    assert dict(typed.dtypes) == {"member_Id": "string", "k": "double", "issue_d": "timestamp"}
    assert {r.column for r in log.collect()} == {"member_Id", "k", "issue_d"}


def test_drop_columns_reports_absent_ones(gaps):
    out, log = clean.drop_columns(gaps, ["x", "nope", "x"], "test")
    assert out.columns == ["id", "s", "k"]
    row = one(log)
    assert (row["columns_dropped"], row["columns_not_found"], row["columns_after"]) == (["x"], ["nope"], 3)


def test_clean_table_reports(spark):
    df = spark.createDataFrame(
        [(1, "Dec-2015", 1.0, 9.0), (2, "bad", None, 9.0), (3, "Jan-2016", 5.0, 9.0)],
        "id int, issue_d string, x double, recoveries double",
    )
    out, reports = jobs.clean_table(df, LoanSpec())
    assert out.columns == ["id", "issue_d", "x"]
    assert by(out, "id")[2]["x"] == 3.0
    assert {r.column for r in reports["outliers"].collect()} == {"id", "x"}
    assert [(r.rows, r.columns) for r in reports["shapes"].collect()] == [(3, 4), (3, 3)]
    with pytest.raises(ValueError):
        jobs.clean_table(df, fit_on="train")
