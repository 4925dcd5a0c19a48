"""Input rules, alignment, drift, request statistics and streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vintage.operators import clean, monitor, score
from vintage.spec import FieldRule
from vintage.streaming import requests as streams

RULES = [
    FieldRule("loan_amnt", required=True, low=0.0),
    FieldRule("rate", low=0.0, high=100.0),
    FieldRule("lo", "int"),
    FieldRule("hi", "int"),
]


def test_the_application_has_85_fields_15_required():
    rules = score.application_rules()
    assert len(rules) == len({r.name for r in rules}) == 85
    assert sum(r.required for r in rules) == 15
    by_name = {r.name: r for r in rules}
    assert (by_name["issue_year"].low, by_name["issue_year"].high) == (2007, 2018)
    assert by_name["policy_code"].default == 1


def test_rules(spark):
    rows = [(1.0, 5.0, 1, 2), (None, 0.0, 2, 1), (-1.0, 101.0, None, 1), (0.0, 100.0, 3, 3)]
    df = spark.createDataFrame(rows, "loan_amnt double, rate double, lo int, hi int")
    checked = score.check_rules(df, RULES, [("lo", "hi")])
    assert [r.violations for r in checked.collect()] == [
        [], ["loan_amnt:required", "hi<lo"], ["loan_amnt:min", "rate:max"], [],
    ]
    assert score.valid_rows(checked).count() == score.rejected_rows(checked).count() == 2
    assert {r.violation: r.rows for r in score.violation_counts(checked).collect()}["hi<lo"] == 1


def test_rules_on_text_and_absent_columns(spark):
    df = spark.createDataFrame([("12",), ("abc",)], "rate string")
    got = [r.violations for r in score.check_rules(df, RULES).collect()]
    assert got == [["loan_amnt:required"], ["loan_amnt:required", "rate:type"]]


def test_defaults(spark):
    rules = [FieldRule("a", "int", default=1.0), FieldRule("b", "int", default=0.0), FieldRule("c")]
    row = score.apply_defaults(spark.createDataFrame([(None,)], "a int"), rules).head()
    assert (row.a, row.b, row.c) == (1, 0, None)


def test_align(spark):
    df = spark.createDataFrame([("1.5", 2, "x"), ("oops", None, "y")], "b string, a int, extra string")
    out = score.align(df, ["a", "b"])
    assert out.columns == ["a", "b", "null_features"]
    assert [tuple(r) for r in out.collect()] == [(2.0, 1.5, []), (None, None, ["a", "b"])]
    with pytest.raises(ValueError, match="missing required"):
        score.align(df, ["a", "z"])


def test_drift_matches_a_row_by_row_maximum(spark):
    reference = spark.createDataFrame(
        [("x", 10.0, 2.0), ("flat", 1.0, 0.0), ("unknown", None, None)], "feature string, mean double, std double"
    )
    df = spark.createDataFrame([(11.0, 5.0, 1.0, 1.0), (None, 5.0, 1.0, 1.0), (3.0, 5.0, 1.0, 1.0)], "x double, flat double, unknown double, other double")
    checks = monitor.drift(df, reference, ["x", "flat", "unknown", "other"])
    row = checks.head()
    assert checks.count() == 1
    assert (row.feature, row.z_score, row.current_value, row.drifted) == ("x", 3.5, 3.0, True)
    assert tuple(monitor.drift_summary(checks).head()) == (True, 1, 1, 3.5)


def test_drift_threshold_is_strict_and_no_reference_is_no_drift(spark):
    df = spark.createDataFrame([(16.0,)], "x double")
    reference = spark.createDataFrame([("x", 10.0, 2.0)], "feature string, mean double, std double")
    assert not monitor.drift(df, reference, ["x"]).head().drifted
    none = monitor.drift_summary(monitor.drift(df, reference.filter("false"), ["x"])).head()
    assert tuple(none) == (False, 0, 0, 0.0)


@pytest.fixture(scope="module")
def log(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [
        (t0 + dt.timedelta(hours=7 * i), "GET" if i % 3 else "POST", "/p", 500 if i % 5 == 0 else 399 + i % 2, 0.01 * i)
        for i in range(60)
    ]
    return spark.createDataFrame(rows, "ts timestamp, method string, endpoint string, status int, duration double")


def test_request_stats(log):
    got = {r.method: r for r in monitor.request_stats(log).collect()}
    post = [i for i in range(60) if i % 3 == 0]
    errors = [i for i in post if i % 5 == 0 or i % 2]
    assert (got["POST"].total_requests, got["POST"].errors) == (20, len(errors))
    assert got["POST"].avg_latency_ms == pytest.approx(sum(post) / 20 * 10)


def test_histogram_is_cumulative_and_inclusive(log):
    rows = {r.le: r for r in monitor.cumulative_histogram(log, "duration", (0.01, 0.1, 0.5)).collect()}
    assert [rows[k].bucket for k in ("0.01", "0.1", "0.5", "+Inf")] == [2, 11, 51, 60]
    assert rows["+Inf"].sum == pytest.approx(sum(0.01 * i for i in range(60)))


def test_alerts(log):
    got = {r.method: r for r in monitor.alerts(log, max_p95_seconds=0.5).collect()}
    assert got["GET"].error_alert and got["GET"].latency_alert


@pytest.fixture(scope="module")
def log_path(log, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "log")
    log.repartition(5).write.parquet(path)
    return path


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_totals_equal_batch(spark, log, log_path, tmp_path):
    stream = streams.stream_table(spark, log_path, files_per_batch=2)
    out = streams.run_available(streams.windowed_requests(stream), str(tmp_path / "out"))
    want = rows_of(streams.windowed_requests(log))
    got = rows_of(out)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5:] for r in got] == [pytest.approx(r[5:]) for r in want]


def test_stream_drift_equals_batch(spark, log, log_path, tmp_path):
    reference = monitor.reference_stats(log, ["duration"])
    stream = streams.stream_table(spark, log_path, files_per_batch=1)
    out = streams.run_available(streams.windowed_drift(stream, reference, ["duration"]), str(tmp_path / "out"))
    batch = streams.windowed_drift(log, reference, ["duration"])
    assert sorted(map(str, out.collect())) == sorted(map(str, batch.select(*out.columns).collect()))


def test_a_restarted_append_stream_adds_only_new_files(spark, log, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    half = log.filter(F.hour("ts") < 12)
    half.write.parquet(source)
    first = streams.run_available(streams.stream_table(spark, source), target, mode="append")
    assert first.count() == half.count()
    log.filter(F.hour("ts") >= 12).write.mode("append").parquet(source)
    second = streams.run_available(streams.stream_table(spark, source), target, mode="append")
    assert second.count() == log.count()


def test_closed_windows_only_in_append_mode(spark, log, log_path, tmp_path):
    stream = streams.stream_table(spark, log_path)
    out = streams.run_available(streams.windowed_requests(stream), str(tmp_path / "out"), mode="append")
    last = max(r.ts for r in log.collect()).replace(hour=0)
    starts = {r.window_start for r in out.collect()}
    assert last not in starts and starts


def test_each_micro_batch_is_cleaned_by_its_own_blocks(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("a", 1.0), ("a", None), ("a", 3.0), ("b", None), ("b", 8.0)]
    spark.createDataFrame(rows, "g string, x double").coalesce(1).write.parquet(source)
    out = streams.run_available(
        streams.stream_table(spark, source), str(tmp_path / "out"), mode="append",
        batch_fn=lambda batch: clean.impute_by_group(batch, ["g"], ["x"]),
    )
    assert rows_of(out) == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 8.0), ("b", 8.0)]
