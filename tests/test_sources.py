"""Readers, writers, file facts and fingerprints."""

import gzip

import pytest
from pyspark.sql import functions as F

from vintage.sources import tables


@pytest.fixture
def csv(tmp_path):
    path = str(tmp_path / "loans.csv.gz")
    with gzip.open(path, "wt") as f:
        f.write('id,amount,note\n1,10.5,"two\nlines, ""quoted"""\n2,oops,\n3,NaN,x\n')
    return path


def test_read_raw_types_by_name(spark, csv):
    df = tables.read_raw(spark, csv, {"id": "bigint", "amount": "double", "absent": "int"})
    assert dict(df.dtypes) == {"id": "bigint", "amount": "double", "note": "string"}
    rows = {r.id: r for r in df.collect()}
    assert rows[1].note == 'two\nlines, "quoted"' and rows[1].amount == 10.5
    assert rows[2].amount is None and rows[2].note is None and rows[3].amount is None


def test_nrows(spark, csv):
    assert [r.id for r in tables.read_raw(spark, csv, nrows=2, order_by=["id"]).collect()] == ["1", "2"]
    with pytest.raises(ValueError):
        tables.read_raw(spark, csv, nrows=2, files_per_batch=1)


def test_suffix_decides_the_format(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, s string")
    assert tables.write_table(df, str(tmp_path / "t.csv")).endswith(".csv")
    assert tables.write_table(df, str(tmp_path / "t")).endswith("t.parquet")
    assert tables.read_table(spark, str(tmp_path / "t.csv")).head().k == "1"
    assert tables.read_table(spark, str(tmp_path / "t.parquet"), ["s"]).columns == ["s"]


def test_append_and_split(spark, tmp_path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 7, "train").otherwise("test"))
    tables.append_table(df, str(tmp_path / "a"))
    tables.append_table(df, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 20
    tables.write_split(df, str(tmp_path / "s"))
    side = spark.read.parquet(str(tmp_path / "s")).filter("split = 'test'")
    assert side.count() == 3
    assert "PartitionFilters: [isnotnull(split" in side._jdf.queryExecution().executedPlan().toString()


def test_file_metadata(spark, csv):
    row = tables.file_metadata(spark, csv).head()
    assert row.file_name == "loans.csv.gz" and row.is_compressed and row.size_bytes > 0


def test_fingerprint_ignores_order_but_not_content(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "a int, b string")
    same = tables.fingerprint(df.orderBy(F.desc("a"))).head()
    assert tables.fingerprint(df).head() == same
    assert tables.fingerprint(df.distinct()).head() != same
    assert tables.fingerprint(df.fillna("y")).head() != same


def test_cut_lineage_keeps_rows_and_uses_the_named_folder(spark):
    df = tables.cut_lineage(spark.range(5))
    assert df.count() == 5
    assert spark.sparkContext.getCheckpointDir() is not None
