"""Registry of queries over the test tables, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with SQL where SQL can say it."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, columns: Iterable[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def day_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


# Orders with gaps, bad dates and zero denominators put in by rule, because the
# tables have none. The same rules stand in GAPS_SQL.
def orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 7 != 0, F.col("o_totalprice")).alias("price"),
        F.when(key % 5 != 0, F.col("o_orderpriority")).alias("priority"),
        F.when(key % 10 >= 7, F.col("o_custkey")).alias("cust"),
        F.when(key % 11 == 0, "bad").otherwise(F.date_format("o_orderdate", "MMM-yyyy")).alias("issued"),
        "o_orderstatus",
        "o_orderpriority",
        "o_orderdate",
    )


GAPS_SQL = """
g AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority,
         CASE WHEN o_orderkey % 10 >= 7 THEN o_custkey END AS cust,
         CASE WHEN o_orderkey % 11 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%b-%Y') END AS issued,
         o_orderstatus, o_orderpriority, o_orderdate
  FROM orders)
"""


# Orders in the role of loans: customer balance as income, line items as terms.
def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum(net).alias("funded_amnt"),
        F.avg("l_extendedprice").alias("installment"),
        (F.avg("l_discount") * 100).alias("int_rate"),
        F.sum("l_quantity").alias("dti"),
        F.min("l_shipdate").alias("earliest_cr_line"),
        F.sum(F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("total_pymnt"),
    )
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    # Merged, never broadcast: small files may hold many rows, all of which would pass through the driver.
    joined = orders.join(customer.hint("merge"), orders.o_custkey == customer.c_custkey, "left").join(
        items.hint("merge"), orders.o_orderkey == items.l_orderkey, "left"
    )
    return joined.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("loan_status"),
        F.col("o_orderdate").alias("issue_d"),
        F.col("o_orderpriority").alias("purpose"),
        F.col("c_mktsegment").alias("addr_state"),
        F.when(F.col("o_orderkey") % 13 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("loan_amnt"),
        "funded_amnt",
        "installment",
        "int_rate",
        "dti",
        F.col("c_acctbal").alias("annual_inc"),
        (F.lit(600) + F.col("c_nationkey") * 11).alias("fico_range_low"),
        (F.lit(604) + F.col("c_nationkey") * 11 - F.when(F.col("o_orderkey") % 17 == 0, 9).otherwise(0)).alias(
            "fico_range_high"
        ),
        "earliest_cr_line",
        "total_pymnt",
    )


LOANS_SQL = """
items AS (
  SELECT l_orderkey, SUM(l_extendedprice * (1 - l_discount)) AS funded_amnt,
         AVG(l_extendedprice) AS installment, AVG(l_discount) * 100 AS int_rate,
         SUM(l_quantity) AS dti, MIN(l_shipdate) AS earliest_cr_line,
         SUM(l_extendedprice * (1 + l_tax)) AS total_pymnt
  FROM lineitem GROUP BY l_orderkey),
loans AS (
  SELECT o_orderkey AS id, o_orderstatus AS loan_status, o_orderdate AS issue_d,
         o_orderpriority AS purpose, c_mktsegment AS addr_state,
         CASE WHEN o_orderkey % 13 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS loan_amnt,
         funded_amnt, installment, int_rate, dti, c_acctbal AS annual_inc,
         600 + c_nationkey * 11 AS fico_range_low,
         604 + c_nationkey * 11 - CASE WHEN o_orderkey % 17 = 0 THEN 9 ELSE 0 END AS fico_range_high,
         earliest_cr_line, total_pymnt
  FROM orders LEFT JOIN items ON o_orderkey = l_orderkey
              LEFT JOIN customer ON o_custkey = c_custkey)
"""

LABELS = {"F": 0, "P": 1, "O": None}


# Two deterministic "models" on the labelled documents; the first has only 50
# distinct scores, so ties are common.
def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    rows = table(spark, sf_dir, "labels").join(docs, "doc_id")
    n = F.col("n_chars").cast("double")
    models = F.array(
        F.struct(
            F.lit("ties").alias("model"),
            (((F.col("doc_id") * 7919) % 50).cast("double") / 50).alias("probability"),
        ),
        F.struct(F.lit("length").alias("model"), (n / (n + 1000)).alias("probability")),
    )
    return rows.select("doc_id", "lang", F.col("quality").alias("label"), F.inline(models)).withColumn(
        "prediction", (F.col("probability") >= 0.5).cast("int")
    )


SCORED_SQL = """
d AS (
  SELECT l.doc_id, lang, quality AS label, n_chars
  FROM labels l JOIN documents USING (doc_id)),
u AS (
  SELECT doc_id, lang, label, 'ties' AS model,
         CAST((doc_id * 7919) % 50 AS DOUBLE) / 50 AS probability FROM d
  UNION ALL
  SELECT doc_id, lang, label, 'length',
         CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + 1000) FROM d),
s AS (SELECT *, CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction FROM u)
"""


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_requests(table(spark, sf_dir, "events"))


def as_requests(events: DataFrame) -> DataFrame:
    return events.select(
        "ts",
        F.lit("POST").alias("method"),
        F.col("event_type").alias("endpoint"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        (F.col("value") / 100).alias("duration"),
        "value",
        "user_id",
    )


LOG_SQL = """
r AS (
  SELECT ts, 'POST' AS method, event_type AS endpoint,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
         value / 100 AS duration, value, user_id
  FROM events)
"""
