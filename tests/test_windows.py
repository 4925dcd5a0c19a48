"""Windows in update mode: the same as a batch, replays add nothing, state is bounded; quantile brackets hold."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vintage.functions.ordering import grouped_quantiles
from vintage.streaming import requests, windows

START = dt.datetime(2024, 1, 1)
KEYS = ["window_start", "method", "endpoint"]


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(8)
    rows = [
        (START + dt.timedelta(minutes=20 * k), "GET", "/hot" if k % 3 == 0 else rng.choice(["/a", "/b", None]), rng.choice([200, 200, 500, None]), rng.choice([None, rng.expovariate(1.5), 0.25]))
        for k in range(1440)
    ]
    return spark.createDataFrame(rows, "ts timestamp, method string, endpoint string, status int, duration double").persist()


def rows_of(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def in_order(log, files, path):
    """Files of days in turn; a stream reads the oldest file first."""
    for k in range(files):
        days = F.floor(F.date_diff(F.to_date("ts"), F.lit(START.date())) / (20 // files))
        log.where(days == k).coalesce(1).write.mode("append").parquet(path)


def test_updates_equal_complete_after_a_replay(spark, log, tmp_path):
    in_order(log, 10, str(tmp_path / "in"))
    stats = requests.windowed_requests(requests.stream_table(spark, str(tmp_path / "in"), files_per_batch=1), watermark="1 day")
    path = str(tmp_path / "out")
    query = windows.run_updates(stats, path)
    want = rows_of(requests.windowed_requests(log))
    assert rows_of(windows.latest(spark, path, stats, KEYS)) == want
    # The third batch once more: only its own folders are written, with the same rows.
    rows = spark.createDataFrame(spark.read.schema(stats.withColumn("batch", F.lit(0).cast("long")).schema).parquet(path).where("batch = 3").select(*stats.columns).collect(), stats.schema)
    assert 0 < rows.count() < len(want)
    windows.write_changes(rows, path, 3)
    assert rows_of(windows.latest(spark, path, stats, KEYS)) == want
    # 20 days pass through the state, and at most four of them are in it at once.
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    days = log.select(F.to_date("ts")).distinct().count()
    assert days == 20 and max(held) <= 5 * 4 < len(want)


def test_late_rows_touch_their_windows_alone(spark, log, tmp_path):
    (tmp_path / "in").mkdir()
    late = log.where("date_format(ts, 'dd') = '02'").limit(5)
    for k, part in enumerate([log.where("ts < '2024-01-04'").exceptAll(late), late]):
        part.coalesce(1).write.parquet(str(tmp_path / "in" / f"part{k}"))
    path = str(tmp_path / "out")
    stats = None
    for k in range(2):
        source = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / ("part0" if k == 0 else "part*")))
        stats = requests.windowed_requests(source, watermark="7 days")
        windows.run_updates(stats, path + str(k))
    versions = spark.read.parquet(path + "1").groupBy(F.to_date("window_start").alias("day")).agg(F.count_distinct("batch").alias("n"))
    assert {str(r.day): r.n for r in versions.collect()} == {"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 1}
    assert rows_of(windows.latest(spark, path + "1", stats, KEYS)) == rows_of(requests.windowed_requests(log.where("ts < '2024-01-04'")))


def test_no_rows(spark, log, tmp_path):
    stats = requests.windowed_requests(log.limit(0))
    assert windows.latest(spark, str(tmp_path / "none"), stats, KEYS).count() == 0
    assert windows.windowed_alerts(log.limit(0)).count() == 0


@pytest.mark.parametrize("k", [16, 800])
def test_brackets_hold_the_exact_quantile(spark, log, k):
    day = log.withColumn("window_start", F.date_trunc("day", "ts"))
    got = {(r.window_start, r.endpoint): r for r in windows.windowed_alerts(log, k=k).collect()}
    exact = grouped_quantiles(day, ["window_start", "endpoint"], ["duration"], [0.95]).collect()
    assert len(got) == len(exact)
    for r in exact:
        own = got[r.window_start, r.endpoint]
        assert (own.p95_low is None) == (r.q0 is None)
        if r.q0 is not None:
            assert own.p95_low <= r.q0 <= own.p95_high
            assert not own.latency_sure or own.latency_alert == (r.q0 > 1.0)
    assert any(r.latency_alert for r in got.values())


def test_alerts_of_a_stream(spark, log, tmp_path):
    in_order(log, 5, str(tmp_path / "in"))
    stats = windows.windowed_alerts(requests.stream_table(spark, str(tmp_path / "in"), files_per_batch=1), watermark="1 day")
    windows.run_updates(stats, str(tmp_path / "out"))
    assert rows_of(windows.latest(spark, str(tmp_path / "out"), stats, KEYS)) == rows_of(windows.windowed_alerts(log))
