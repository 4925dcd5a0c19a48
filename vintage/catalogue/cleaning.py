"""Cleaning queries."""

from pyspark.sql import functions as F

from vintage.catalogue.base import GAPS_SQL, day_text, orders_with_gaps, query, rounded, table
from vintage.operators import clean
from vintage.plans import jobs
from vintage.spec import LoanSpec


def _gaps(spark, sf_dir):
    return orders_with_gaps(spark, sf_dir).select("o_orderkey", "price", "priority", "cust")


def _fill_sql(price="price", priority="priority", cust="cust"):
    return f"""WITH {GAPS_SQL} SELECT o_orderkey, ROUND({price}, 4) AS price, {priority} AS priority,
               CAST({cust} AS DOUBLE) AS cust FROM g"""


_MODE = "(SELECT priority FROM g WHERE priority IS NOT NULL GROUP BY priority ORDER BY COUNT(*) DESC, priority LIMIT 1)"
_MEDIANS = {
    "price": "COALESCE(price, (SELECT quantile_cont(price, 0.5) FROM g))",
    "cust": "COALESCE(CAST(cust AS DOUBLE), (SELECT quantile_cont(CAST(cust AS DOUBLE), 0.5) FROM g))",
}


@query(_fill_sql(priority=f"COALESCE(priority, {_MODE})", **_MEDIANS))
def impute_median_mode(spark, sf_dir):
    return rounded(clean.impute(_gaps(spark, sf_dir))[0], ["price"], 4)


@query(
    _fill_sql(
        "COALESCE(price, (SELECT AVG(price) FROM g))",
        "COALESCE(priority, 'Unknown')",
        "ROUND(COALESCE(CAST(cust AS DOUBLE), (SELECT AVG(cust) FROM g)), 4)",
    )
)
def impute_mean_unknown(spark, sf_dir):
    filled = clean.impute(_gaps(spark, sf_dir), "mean", "unknown")[0]
    return rounded(filled, ["price", "cust"], 4)


@query(_fill_sql("COALESCE(price, 0)", "COALESCE(priority, 'Unknown')", "COALESCE(cust, 0)"))
def impute_zero(spark, sf_dir):
    filled = clean.impute(_gaps(spark, sf_dir), "zero", "unknown")[0]
    return rounded(filled, ["price"], 4).withColumn("cust", F.col("cust").cast("double"))


@query(
    f"""WITH {GAPS_SQL}
    SELECT 'price' AS "column", 'numeric' AS type, 'median' AS method,
           ROUND(quantile_cont(price, 0.5), 4) AS fill_number, NULL::VARCHAR AS fill_text,
           COUNT(*) - COUNT(price) AS missing_before, CAST(0 AS BIGINT) AS missing_after FROM g
    UNION ALL SELECT 'cust', 'numeric', 'median', ROUND(quantile_cont(CAST(cust AS DOUBLE), 0.5), 4), NULL,
           COUNT(*) - COUNT(cust), 0 FROM g
    UNION ALL SELECT 'priority', 'categorical', 'mode', NULL, {_MODE}, COUNT(*) - COUNT(priority), 0 FROM g"""
)
def imputation_log(spark, sf_dir):
    log = clean.impute(_gaps(spark, sf_dir))[1]
    number = F.col("fill_value").try_cast("double")
    return log.select(
        "column",
        "type",
        "method",
        F.round(number, 4).alias("fill_number"),
        F.when(number.isNull(), F.col("fill_value")).alias("fill_text"),
        "missing_before",
        "missing_after",
    )


@query(
    f"""WITH {GAPS_SQL} SELECT o_orderkey, CASE WHEN price IS NULL THEN 1 ELSE 0 END AS price_missing,
        CASE WHEN priority IS NULL THEN 1 ELSE 0 END AS priority_missing FROM g"""
)
def missing_indicators(spark, sf_dir):
    marked = clean.add_missing_indicators(_gaps(spark, sf_dir), ["price", "priority"])
    return marked.select("o_orderkey", "price_missing", "priority_missing")


@query(
    f"""WITH {GAPS_SQL} SELECT o_orderkey, price, priority, cust FROM g
        WHERE price IS NOT NULL AND priority IS NOT NULL AND cust IS NOT NULL"""
)
def drop_missing_rows(spark, sf_dir):
    return clean.drop_missing_rows(_gaps(spark, sf_dir))


def _iqr_sql(column, source):
    return f"""SELECT '{column}' AS "column", COUNT(*) FILTER (x < lo OR x > hi) AS count,
        ROUND(CAST(COUNT(*) FILTER (x < lo OR x > hi) AS DOUBLE) / COUNT(*) * 100, 6) AS pct,
        ROUND(MAX(lo), 6) AS lower_bound, ROUND(MAX(hi), 6) AS upper_bound,
        MIN(x) AS min_value, MAX(x) AS max_value
      FROM (SELECT CAST({column} AS DOUBLE) AS x FROM {source}),
           (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
             (SELECT quantile_cont(CAST({column} AS DOUBLE), 0.25) AS q1,
                     quantile_cont(CAST({column} AS DOUBLE), 0.75) AS q3 FROM {source}))"""


@query(" UNION ALL ".join(_iqr_sql(c, "events") for c in ("value", "user_id")))
def outliers_iqr(spark, sf_dir):
    found = clean.outliers_iqr(table(spark, sf_dir, "events"), ["value", "user_id"])
    return rounded(found, ["pct", "lower_bound", "upper_bound"])


_ITEM_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(_iqr_sql(c, "lineitem") for c in _ITEM_COLUMNS))
def outliers_iqr_lineitem(spark, sf_dir):
    found = clean.outliers_iqr(table(spark, sf_dir, "lineitem"), _ITEM_COLUMNS)
    return rounded(found, ["pct", "lower_bound", "upper_bound"])


def _z_sql(column, source):
    return f"""SELECT '{column}' AS "column",
        COUNT(*) FILTER (abs((x - m) / s) > 3) AS count,
        ROUND(CAST(COUNT(*) FILTER (abs((x - m) / s) > 3) AS DOUBLE) / COUNT(*) * 100, 6) AS pct,
        CAST(3 AS DOUBLE) AS threshold
      FROM (SELECT CAST({column} AS DOUBLE) AS x FROM {source}),
           (SELECT AVG(CAST({column} AS DOUBLE)) AS m, stddev_samp(CAST({column} AS DOUBLE)) AS s FROM {source})"""


@query(" UNION ALL ".join(_z_sql(c, "events") for c in ("value", "user_id", "event_id")))
def outliers_zscore(spark, sf_dir):
    found = clean.outliers_zscore(table(spark, sf_dir, "events"), ["value", "user_id", "event_id"])
    return rounded(found, ["pct"])


@query(
    "WITH o AS ("
    + " UNION ALL ".join(_iqr_sql(c, "events") for c in ("value", "user_id", "event_id"))
    + """) SELECT "column", count, pct, CAST((SELECT SUM(count) FROM o) AS BIGINT) AS total_count
         FROM o ORDER BY count DESC, "column" LIMIT 2"""
)
def outlier_top(spark, sf_dir):
    found = clean.outliers_iqr(table(spark, sf_dir, "events"))
    return rounded(clean.outlier_top(found, 2), ["pct"])


@query(
    f"""WITH {GAPS_SQL} SELECT o_orderkey,
        strftime(CAST(TRY_STRPTIME(issued, '%b-%Y') AS DATE), '%Y-%m-%d') AS issued FROM g"""
)
def coerce_dates(spark, sf_dir):
    dated = clean.coerce_dates(orders_with_gaps(spark, sf_dir), ["issued"])
    return day_text(dated.select("o_orderkey", "issued"), "issued")


@query(
    """SELECT COUNT(*) AS "rows", COUNT(amount) AS amounts, 'double' AS amount_type, 'string' AS order_id_type,
       COUNT(DISTINCT order_id) AS ids
       FROM (SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
                    CASE WHEN o_orderkey % 10 >= 7 THEN o_custkey END AS amount FROM orders)"""
)
def type_consistency(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderkey") % 10 >= 7, F.col("o_custkey")).alias("amount"),
        F.date_format("o_orderdate", "MMM-yyyy").alias("issue_d"),
    )
    typed, _ = clean.type_consistency(orders, ["issue_d"])
    kinds = dict(typed.dtypes)
    return typed.agg(
        F.count("*").alias("rows"),
        F.count("amount").alias("amounts"),
        F.lit(kinds["amount"]).alias("amount_type"),
        F.lit(kinds["order_id"]).alias("order_id_type"),
        F.count_distinct("order_id").alias("ids"),
    )


@query(
    f"""WITH {GAPS_SQL}, q AS (SELECT o_orderstatus, quantile_cont(price, 0.5) AS m FROM g GROUP BY 1),
        c AS (SELECT o_orderstatus, priority, ROW_NUMBER() OVER (PARTITION BY o_orderstatus
                ORDER BY COUNT(*) DESC, priority) AS k FROM g WHERE priority IS NOT NULL GROUP BY 1, 2)
        SELECT o_orderkey, o_orderstatus, ROUND(COALESCE(price, m), 4) AS price,
               COALESCE(g.priority, c.priority) AS priority
        FROM g JOIN q USING (o_orderstatus) JOIN c USING (o_orderstatus) WHERE k = 1"""
)
def impute_by_group(spark, sf_dir):
    rows = orders_with_gaps(spark, sf_dir).select("o_orderkey", "o_orderstatus", "price", "priority")
    filled = clean.impute_by_group(rows, ["o_orderstatus"], ["price"], ["priority"])
    return rounded(filled, ["price"], 4)


@query(
    f"""WITH {GAPS_SQL} SELECT o_orderkey AS id, ROUND({_MEDIANS["price"]}, 4) AS loan_amnt,
        COALESCE(priority, {_MODE}) AS purpose,
        strftime(CAST(TRY_STRPTIME(issued, '%b-%Y') AS DATE), '%Y-%m-%d') AS issue_d FROM g"""
)
def clean_table(spark, sf_dir):
    raw = orders_with_gaps(spark, sf_dir).select(
        F.col("o_orderkey").alias("id"),
        F.col("price").alias("loan_amnt"),
        F.col("priority").alias("purpose"),
        F.col("issued").alias("issue_d"),
        F.col("cust").alias("total_pymnt"),
    )
    cleaned, _ = jobs.clean_table(raw, LoanSpec())
    return rounded(day_text(cleaned, "issue_d"), ["loan_amnt"], 4)


@query(
    """WITH t AS (SELECT *, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price FROM orders)
       SELECT o_orderkey AS id, ROUND(COALESCE(price,
         (SELECT quantile_cont(price, 0.5) FROM t WHERE o_orderdate < TIMESTAMP '2000-01-01')), 4) AS loan_amnt,
         strftime(o_orderdate, '%Y-%m-%d') AS issue_d FROM t"""
)
def clean_table_train_statistics(spark, sf_dir):
    raw = orders_with_gaps(spark, sf_dir).select(
        F.col("o_orderkey").alias("id"),
        F.col("price").alias("loan_amnt"),
        F.col("o_orderdate").alias("issue_d"),
    )
    cleaned, _ = jobs.clean_table(
        raw, LoanSpec(), fit_on="train", split_day="2000-01-01", exclude=["issue_d"]
    )
    return rounded(day_text(cleaned, "issue_d"), ["loan_amnt"], 4)
