"""Block-wise cleaning of streams: the same as one batch, for any files, late rows and replays."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vintage.operators.clean import impute_by_group
from vintage.streaming import blocks
from vintage.streaming.requests import stream_table

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(4)
    rows = []
    for k in range(240):
        ts = START + dt.timedelta(minutes=18 * k)
        # A third of the rows share one place.
        place = "hot" if k % 3 == 0 else rng.choice(["a", "b", None])
        rows.append((k, ts, place, None if rng.random() < 0.3 else rng.gauss(5, 2), rng.choice(["x", "y", "y", None]), rng.choice([None, 1, 2])))
    df = spark.createDataFrame(rows, "id long, ts timestamp, place string, value double, kind string, n int")
    return df.withColumns({"day": F.date_format("ts", "dd"), "over": F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY"), "_block": F.lit("own"), "_batch": F.lit(7)}).persist()


def rows_of(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("layout", ["ordered", "mixed"])
@pytest.mark.parametrize("block, timed", [(["day"], True), (["day", "place"], True), (["place"], False)])
def test_equals_one_batch(spark, events, tmp_path, layout, block, timed):
    dealt = events.repartitionByRange(3, "ts") if layout == "ordered" else events.repartition(3, "id")
    dealt.write.parquet(str(tmp_path / "in"))
    stream = stream_table(spark, str(tmp_path / "in"), files_per_batch=1)
    when = {"ts": "ts", "until": "over"} if timed else {}
    got = blocks.clean_blocks(stream, str(tmp_path / "out"), block, ["value", "n"], ["kind"], **when)
    assert got.columns == events.columns
    assert rows_of(got, events.columns) == rows_of(impute_by_group(events, block, ["value", "n"], ["kind"]), events.columns)


def test_blocks_are_filled_when_they_are_over_and_again_for_late_rows(spark, events, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    late = events.where("id = 3")

    def step(df):
        df.coalesce(1).write.mode("append").parquet(path)
        stream = stream_table(spark, path, files_per_batch=1)
        return blocks.clean_blocks(stream, out, ["day"], ["value"], ts="ts", until="over", last=False)

    first = step(events.where("day IN ('01', '02') AND id <> 3"))
    assert {r["day"] for r in first.select("day").distinct().collect()} == {"01"}
    second = step(events.where("day = '03'"))
    assert {r["day"] for r in second.select("day").distinct().collect()} == {"01", "02"}
    third = step(late)
    known = events.where("day IN ('01', '02')")
    assert rows_of(third, ["id", "value"]) == rows_of(impute_by_group(known, ["day"], ["value"]), ["id", "value"])
    filled = spark.read.parquet(f"{out}/filled")
    assert [r["count"] for r in filled.groupBy("batch").count().orderBy("batch").collect()] == [1, 1, 1]
    # A batch that is replayed finds what it found before.
    for number, want in ((0, 1), (1, 1), (2, 1)):
        assert len(blocks.due_blocks(spark, out, number, "10 minutes")) == want


def test_stream_without_rows(spark, events, tmp_path):
    events.limit(0).write.parquet(str(tmp_path / "in"))
    got = blocks.clean_blocks(stream_table(spark, str(tmp_path / "in")), str(tmp_path / "out"), ["day"], ["n"])
    assert got.count() == 0 and got.columns == events.columns
