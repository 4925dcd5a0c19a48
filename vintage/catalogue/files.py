"""Source and sink queries: what is written is what is read back."""

from pyspark.sql import functions as F

from vintage.catalogue.base import day_text, query, rounded, table
from vintage.operators import clean, profile, split
from vintage.sources import tables, versions

_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderdate": "timestamp"}
_BY_STATUS = """SELECT o_orderstatus, COUNT(*) AS "rows", CAST(SUM(o_orderkey) AS BIGINT) AS key_sum,
    ROUND(SUM(o_totalprice), 2) AS price FROM orders GROUP BY 1"""


def _by_status(df):
    stats = df.groupBy("o_orderstatus").agg(
        F.count("*").alias("rows"), F.sum("o_orderkey").alias("key_sum"), F.sum("o_totalprice").alias("price")
    )
    return rounded(stats, ["price"], 2)


@query(_BY_STATUS)
def csv_round_trip(spark, sf_dir):
    path = tables.write_table(table(spark, sf_dir, "orders"), tables.scratch_path(spark, "orders") + ".csv")
    return _by_status(tables.read_raw(spark, path, _TYPES))


@query(_BY_STATUS)
def csv_gzip_round_trip(spark, sf_dir):
    path = tables.write_table(table(spark, sf_dir, "orders"), tables.scratch_path(spark, "orders") + ".csv.gz")
    return _by_status(tables.read_raw(spark, path, _TYPES))


@query('SELECT \'orders\' AS name, COUNT(*) AS "rows" FROM orders UNION ALL SELECT \'lineitem\', COUNT(*) FROM lineitem')
def file_rows(spark, sf_dir):
    """Rows of all files of two tables."""
    total = lambda name: tables.rows_per_file(table(spark, sf_dir, name)).agg(F.lit(name).alias("name"), F.sum("rows").alias("rows"))
    return total("orders").unionAll(total("lineitem"))


@query(_BY_STATUS)
def parquet_round_trip(spark, sf_dir):
    path = tables.write_table(table(spark, sf_dir, "orders"), tables.scratch_path(spark, "orders"))
    return _by_status(tables.read_table(spark, path, ["o_orderstatus", "o_orderkey", "o_totalprice"]))


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
       FROM orders ORDER BY o_orderkey LIMIT 100"""
)
def first_rows(spark, sf_dir):
    first = tables.first_rows(table(spark, sf_dir, "orders"), 100, ["o_orderkey"])
    return day_text(first.drop("o_orderstatus", "o_orderpriority"), "o_orderdate")


@query('SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS "rows" FROM orders GROUP BY 1')
def pruned_read(spark, sf_dir):
    dates = tables.read_table(spark, f"{sf_dir}/orders.parquet", ["o_orderdate"])
    return dates.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("rows"))


@query(
    """SELECT CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS split, COUNT(*) AS "rows",
       ROUND(AVG(o_totalprice), 6) AS mean_price FROM orders GROUP BY 1"""
)
def split_table(spark, sf_dir):
    path = tables.scratch_path(spark, "split")
    tables.write_split(split.temporal_split(table(spark, sf_dir, "orders"), "o_orderdate", "2000-01-01"), path)
    stats = spark.read.parquet(path).groupBy("split").agg(
        F.count("*").alias("rows"), F.avg("o_totalprice").alias("mean_price")
    )
    return rounded(stats, ["mean_price"])


@query(_BY_STATUS)
def appended_table(spark, sf_dir):
    path = tables.scratch_path(spark, "appended")
    orders = table(spark, sf_dir, "orders")
    for status in ("F", "O", "P"):
        tables.append_table(orders.filter(F.col("o_orderstatus") == status), path)
    return _by_status(spark.read.parquet(path))


@query(
    """SELECT 'user_id' AS "column", COUNT(*) FILTER (x < lo OR x > hi) AS count FROM
         (SELECT CAST(user_id AS DOUBLE) AS x FROM events),
         (SELECT quantile_cont(user_id, 0.25) - 1.5 * (quantile_cont(user_id, 0.75) - quantile_cont(user_id, 0.25)) AS lo,
                 quantile_cont(user_id, 0.75) + 1.5 * (quantile_cont(user_id, 0.75) - quantile_cont(user_id, 0.25)) AS hi FROM events)
       UNION ALL SELECT 'value', COUNT(*) FILTER (x < lo OR x > hi) FROM
         (SELECT value AS x FROM events),
         (SELECT quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS lo,
                 quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS hi FROM events)"""
)
def json_report(spark, sf_dir):
    report = clean.outliers_iqr(table(spark, sf_dir, "events"), ["value", "user_id"])
    path = tables.scratch_path(spark, "report")
    tables.write_report(report, path)
    return spark.read.schema(report.schema).json(path).select("column", "count")


@query(
    """SELECT o_orderpriority AS value, COUNT(*) AS count FROM orders GROUP BY 1"""
)
def report_csv(spark, sf_dir):
    report = profile.value_distribution(table(spark, sf_dir, "orders"), "o_orderpriority")
    path = tables.write_table(report, tables.scratch_path(spark, "report") + ".csv")
    return tables.read_raw(spark, path, {"count": "bigint"}).select("value", "count")


@query(_BY_STATUS)
def csv_stream(spark, sf_dir):
    from vintage.streaming import requests as streams

    path = tables.write_table(
        table(spark, sf_dir, "orders").repartition(4, "o_orderkey"), tables.scratch_path(spark, "orders") + ".csv"
    )
    chunks = tables.read_raw(spark, path, _TYPES, files_per_batch=2)
    return _by_status(streams.run_available(chunks, tables.scratch_path(spark, "chunks"), mode="append"))


@query(
    """WITH t AS (SELECT o_orderstatus AS status, [CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'), CAST(o_orderkey AS VARCHAR),
              o_orderpriority, o_orderstatus, CAST(CAST(ROUND(o_totalprice * 100) AS BIGINT) AS VARCHAR)] AS x FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')),
       h AS (SELECT status, md5(list_aggregate(list_transform(x, lambda v: COALESCE(length(v) || ':' || v, 'N')), 'string_agg', '')) AS m FROM t),
       s AS (SELECT status, COUNT(*) AS n, SUM(CAST('0x' || substr(m, 1, 15) AS BIGINT)) AS high, SUM(CAST('0x' || substr(m, 16, 15) AS BIGINT)) AS low FROM h GROUP BY 1),
       c AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY status) AS INTEGER) AS version, n AS hashed_rows, CAST(SUM(n) OVER o AS BIGINT) AS "rows",
              CAST(SUM(high) OVER o AS VARCHAR) AS high, CAST(SUM(low) OVER o AS VARCHAR) AS low FROM s WINDOW o AS (ORDER BY status))
       SELECT *, md5("rows" || ':' || high || ':' || low) AS digest FROM c"""
)
def table_versions(spark, sf_dir):
    """Digest of the orders after each of three appends, and the rows that each version had to hash."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderkey", "o_orderpriority", "o_orderstatus",
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("price_cents"),
    )
    path = tables.scratch_path(spark, "versions")
    out = None
    for status in ("F", "O", "P"):
        tables.append_table(orders.filter(F.col("o_orderstatus") == status), f"{path}/orders")
        number = versions.record_version(spark, f"{path}/orders", f"{path}/history")
        files = versions.recorded(spark, f"{path}/history", number)
        hashed = files.agg(F.coalesce(F.sum(F.when(F.col("hashed_in") == number, F.col("rows"))), F.lit(0)).alias("hashed_rows"))
        line = versions.table_digest(files).drop("files").crossJoin(hashed).withColumn("version", F.lit(number))
        out = line if out is None else out.unionByName(line)
    return out
