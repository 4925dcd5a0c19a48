"""Versions of tables: order-free digests, appends that read new files only, and what changed."""

import os

from pyspark.sql import functions as F

from vintage.sources import versions


def table(spark, low, high):
    return spark.range(low, high).select("id", F.when(F.col("id") % 3 != 0, F.concat(F.lit("x"), F.col("id"))).alias("name"), (F.col("id") % 2).cast("int").alias("side"))


def digest(spark, path):
    return versions.table_digest(versions.file_digests(spark, path)).head()


def test_digest_is_of_rows_not_files(spark, tmp_path):
    rows = table(spark, 0, 100)
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    rows.repartition(4, "name").select("side", "name", "id").write.parquet(str(tmp_path / "four"))
    rows.write.partitionBy("side").parquet(str(tmp_path / "sides"))
    a, b, c = (digest(spark, str(tmp_path / n)) for n in ("one", "four", "sides"))
    assert a["files"] == 1 and b["files"] == 4 and a["rows"] == b["rows"] == c["rows"] == 100
    assert a["digest"] == b["digest"] == c["digest"]
    rows.withColumn("name", F.coalesce("name", F.lit("N"))).write.parquet(str(tmp_path / "filled"))
    rows.unionAll(rows.limit(1)).write.parquet(str(tmp_path / "twice"))
    assert len({a["digest"], digest(spark, str(tmp_path / "filled"))["digest"], digest(spark, str(tmp_path / "twice"))["digest"]}) == 3
    assert digest(spark, next(str(p) for p in (tmp_path / "one").glob("*.parquet")))["digest"] == a["digest"]


def test_values_do_not_run_into_each_other(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "N"), ("N", None), ("", None), (None, "")], "a string, b string")
    assert rows.select(versions.row_text(["a", "b"]).alias("t")).distinct().count() == 6


def test_an_append_reads_new_files_only(spark, tmp_path):
    path, history = str(tmp_path / "t"), str(tmp_path / "history")
    table(spark, 0, 50).coalesce(2).write.parquet(path)
    assert versions.record_version(spark, path, history) == 1
    first = versions.recorded(spark, history)
    # Old files that can't be read any more, of the same size and time: reading them would fail.
    for name in os.listdir(path):
        if name.endswith(".parquet"):
            full, crc = os.path.join(path, name), os.path.join(path, f".{name}.crc")
            at, size = os.stat(full).st_mtime_ns, os.path.getsize(full)
            with open(full, "wb") as out:
                out.write(b"x" * size)
            os.utime(full, ns=(at, at))
            if os.path.exists(crc):
                os.remove(crc)
    table(spark, 50, 80).coalesce(1).write.mode("append").parquet(path)
    assert versions.record_version(spark, path, history) == 2
    second = versions.recorded(spark, history)
    assert versions.table_digest(second).head()["digest"] == digest_of(spark, tmp_path, table(spark, 0, 80))
    got = versions.changed_files(first, second).collect()
    assert [(r["change"], r["rows_before"], r["rows_after"]) for r in got] == [("added", None, 30)]
    assert {r["hashed_in"] for r in second.collect()} == {1, 2}
    back = versions.changed_files(second, first).collect()
    assert [(r["change"], r["rows_before"], r["rows_after"]) for r in back] == [("removed", 30, None)]


def digest_of(spark, tmp_path, rows):
    rows.write.parquet(str(tmp_path / "whole"))
    return digest(spark, str(tmp_path / "whole"))["digest"]


def test_rewritten_files(spark, tmp_path):
    path, history = str(tmp_path / "t"), str(tmp_path / "history")
    table(spark, 0, 20).coalesce(1).write.parquet(f"{path}/part=1")
    table(spark, 20, 40).coalesce(1).write.parquet(f"{path}/part=2")
    versions.record_version(spark, path, history)
    name = next(n for n in os.listdir(f"{path}/part=2") if n.endswith(".parquet"))
    table(spark, 20, 45).coalesce(1).write.parquet(str(tmp_path / "other"))
    other = next(n for n in os.listdir(tmp_path / "other") if n.endswith(".parquet"))
    os.replace(tmp_path / "other" / other, f"{path}/part=2/{name}")
    crc = f"{path}/part=2/.{name}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    versions.record_version(spark, path, history)
    got = versions.changed_files(versions.recorded(spark, history, 1), versions.recorded(spark, history, 2)).collect()
    assert [(r["change"], r["rows_before"], r["rows_after"]) for r in got] == [("changed", 20, 25)]


def test_table_without_rows(spark, tmp_path):
    table(spark, 0, 0).coalesce(1).write.parquet(str(tmp_path / "none"))
    got = digest(spark, str(tmp_path / "none"))
    assert got["rows"] == 0 and got["high"] == "0"
