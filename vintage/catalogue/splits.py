"""Sampling, split, label and feature queries."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vintage.catalogue.base import LABELS, LOANS_SQL, day_text, loans, query, rounded, table
from vintage.operators import features, sample, split
from vintage.plans import jobs
from vintage.spec import LoanSpec

_LABELLED = """
t AS (SELECT *, CASE o_orderstatus WHEN 'P' THEN 1 ELSE 0 END AS target FROM orders
      WHERE o_orderstatus IN ('F', 'P'))"""
_CUT = """
c AS (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS c FROM t GROUP BY 1),
w AS (SELECT d, SUM(c) OVER (ORDER BY d) AS cum FROM c),
s AS (SELECT MIN(d) AS day FROM w WHERE cum > (SELECT CAST(floor(SUM(c) * CAST(0.8 AS DOUBLE)) AS BIGINT) FROM c))"""


@query(
    f"""WITH {_LABELLED}, {_CUT}
        SELECT CASE WHEN CAST(o_orderdate AS DATE) < day THEN 'train' ELSE 'test' END AS split,
               CAST(year(o_orderdate) AS INTEGER) AS issue_year, COUNT(*) AS "rows",
               ROUND(AVG(target), 6) AS positive_rate, ROUND(AVG(o_totalprice), 6) AS mean_price
        FROM t, s GROUP BY 1, 2"""
)
def risk_by_vintage(spark, sf_dir):
    """Label, split by date, and compare risk across issue years."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderdate", "o_totalprice")
    labelled = split.map_labels(orders, "o_orderstatus", LABELS)
    day = split.split_date(labelled, "o_orderdate", 0.8)
    sides = split.temporal_split(labelled, "o_orderdate", day)
    made = features.engineer_features(sides, "o_orderdate")
    stats = made.groupBy("split", "issue_year").agg(
        F.count("*").alias("rows"),
        F.avg("target").alias("positive_rate"),
        F.avg("o_totalprice").alias("mean_price"),
    )
    return rounded(rounded(stats, ["positive_rate"]), ["mean_price"])


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS \"rows\" FROM orders GROUP BY 1")
def month_histogram(spark, sf_dir):
    return sample.month_histogram(table(spark, sf_dir, "orders"), "o_orderdate")


_QUOTA = """
m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS "rows" FROM orders GROUP BY 1),
q AS (SELECT month, "rows", CAST(least(greatest(1, CAST(floor(1000 * (CAST("rows" AS DOUBLE)
        / (SELECT CAST(SUM("rows") AS DOUBLE) FROM m))) AS BIGINT)), "rows") AS BIGINT) AS quota FROM m)"""


@query(f"WITH {_QUOTA} SELECT * FROM q")
def stratified_quota(spark, sf_dir):
    return sample.month_quotas(table(spark, sf_dir, "orders"), "o_orderdate", 1000)


@query(f"WITH {_QUOTA} SELECT month, quota AS \"rows\" FROM q")
def stratified_sample_months(spark, sf_dir):
    drawn = sample.stratified_sample(table(spark, sf_dir, "orders"), "o_orderdate", ["o_orderkey"], 1000)
    return sample.month_histogram(drawn, "o_orderdate")


@query()
def stratified_sample(spark, sf_dir):
    return sample.stratified_sample(table(spark, sf_dir, "orders"), "o_orderdate", ["o_orderkey"], 1000)


@query()
def random_rows(spark, sf_dir):
    return sample.random_rows(table(spark, sf_dir, "orders"), ["o_orderkey"], 200)


@query(
    """SELECT COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS distinct_dates,
       strftime(MIN(o_orderdate), '%Y-%m-%d') AS min_date, strftime(MAX(o_orderdate), '%Y-%m-%d') AS max_date,
       COUNT(DISTINCT CAST(o_orderdate AS DATE)) < 2 AS too_few FROM orders"""
)
def date_diversity(spark, sf_dir):
    found = sample.date_diversity(table(spark, sf_dir, "orders"), "o_orderdate")
    return day_text(found, "min_date", "max_date")


@query(
    """WITH c AS (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS c FROM orders GROUP BY 1),
       w AS (SELECT d, c, SUM(c) OVER (ORDER BY d) AS cum, SUM(c) OVER () AS n FROM c),
       f AS (SELECT ratio, MIN(d) AS day, MIN(cum - c) AS train, MAX(n) AS n
             FROM w, (VALUES (CAST(0.8 AS DOUBLE)), (CAST(0.7 AS DOUBLE))) AS r(ratio)
             WHERE cum > CAST(floor(n * ratio) AS BIGINT) GROUP BY ratio)
       SELECT ratio, strftime(day, '%Y-%m-%d') AS split_date, CAST(train AS BIGINT) AS train_rows,
              ROUND(CAST(train AS DOUBLE) / n * 100, 6) AS train_pct, CAST(n - train AS BIGINT) AS test_rows,
              ROUND(CAST(n - train AS DOUBLE) / n * 100, 6) AS test_pct FROM f"""
)
def split_suggestions(spark, sf_dir):
    found = split.split_suggestions(table(spark, sf_dir, "orders"), "o_orderdate")
    return rounded(day_text(found, "split_date"), ["train_pct", "test_pct"])


@query(
    """SELECT mode, (mode = 'dev' OR day < DATE '2030-01-01') AND day > DATE '1990-01-01' AS is_valid,
         CASE WHEN day > DATE '2030-01-01' THEN 'after_range' WHEN day < DATE '1990-01-01' THEN 'before_range' ELSE '' END AS errors,
         '' AS warnings, strftime(MIN(o_orderdate), '%Y-%m-%d') AS min_date, strftime(MAX(o_orderdate), '%Y-%m-%d') AS max_date,
         COUNT(*) FILTER (CAST(o_orderdate AS DATE) < day) AS train_rows,
         COUNT(*) FILTER (CAST(o_orderdate AS DATE) >= day) AS test_rows,
         ROUND(CAST(COUNT(*) FILTER (CAST(o_orderdate AS DATE) < day) AS DOUBLE) / COUNT(*) * 100, 6) AS train_pct,
         ROUND(CAST(COUNT(*) FILTER (CAST(o_orderdate AS DATE) >= day) AS DOUBLE) / COUNT(*) * 100, 6) AS test_pct
       FROM orders, (VALUES ('full', DATE '2000-01-01'), ('full', DATE '2031-01-01'), ('dev', DATE '1980-01-01')) AS v(mode, day)
       GROUP BY mode, day"""
)
def split_check(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    cases = [("full", "2000-01-01"), ("full", "2031-01-01"), ("dev", "1980-01-01")]
    out = None
    for mode, day in cases:
        row = split.check_split_date(orders, "o_orderdate", day, mode).withColumn("mode", F.lit(mode))
        out = row if out is None else out.unionByName(row)
    text = out.withColumns({c: F.array_join(c, ",") for c in ("errors", "warnings")})
    return rounded(day_text(text, "min_date", "max_date"), ["train_pct", "test_pct"])


@query(
    """WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate END AS issued FROM orders)
       SELECT o_orderkey, CASE WHEN issued < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS split
       FROM x WHERE issued IS NOT NULL"""
)
def temporal_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "issued", F.when(F.col("o_orderkey") % 9 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("none")
    )
    return split.temporal_split(orders, "issued", "2000-01-01").select("o_orderkey", "split")


# One row in 1000 is put on the wrong side, to be found by the check.
@query(
    """WITH x AS (SELECT CAST(o_orderdate AS DATE) AS d,
         CASE WHEN (o_orderdate < TIMESTAMP '2000-01-01') <> (o_orderkey % 1000 = 0) THEN 'train' ELSE 'test' END AS s FROM orders),
       a AS (SELECT COUNT(*) FILTER (s = 'train' AND d >= DATE '2000-01-01') AS late,
                    COUNT(*) FILTER (s = 'test' AND d < DATE '2000-01-01') AS early,
                    COUNT(*) FILTER (s = 'train') AS train_rows, COUNT(*) FILTER (s = 'test') AS test_rows,
                    MIN(d) FILTER (s = 'train') AS a, MAX(d) FILTER (s = 'train') AS b,
                    MIN(d) FILTER (s = 'test') AS c, MAX(d) FILTER (s = 'test') AS e FROM x)
       SELECT late + early = 0 AS is_valid,
              concat_ws(',', CASE WHEN late > 0 THEN 'late_rows_in_train' END, CASE WHEN early > 0 THEN 'early_rows_in_test' END) AS errors,
              CASE WHEN b >= c THEN 'overlap' ELSE '' END AS warnings, train_rows, test_rows,
              strftime(a, '%Y-%m-%d') AS train_min, strftime(b, '%Y-%m-%d') AS train_max,
              strftime(c, '%Y-%m-%d') AS test_min, strftime(e, '%Y-%m-%d') AS test_max,
              late + early AS overlap_count FROM a"""
)
def split_validation(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    sides = split.temporal_split(orders, "o_orderdate", "2000-01-01")
    other = F.when(F.col("split") == "train", "test").otherwise("train")
    mixed = sides.withColumn("split", F.when(F.col("o_orderkey") % 1000 == 0, other).otherwise(F.col("split")))
    found = split.validate_split(mixed, "o_orderdate", "2000-01-01")
    text = found.withColumns({c: F.array_join(c, ",") for c in ("errors", "warnings")})
    return day_text(text, "train_min", "train_max", "test_min", "test_max")


@query(
    """SELECT status, target, COUNT(*) AS "rows" FROM (
         SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'X' ELSE o_orderstatus END AS status,
                CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderstatus = 'P' THEN 1 END AS target
         FROM orders) WHERE target IS NOT NULL GROUP BY 1, 2"""
)
def label_map(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "status", F.when(F.col("o_orderkey") % 17 == 0, "X").otherwise(F.col("o_orderstatus"))
    )
    mapped = split.map_labels(orders, "status", LABELS)
    return mapped.groupBy("status", "target").agg(F.count("*").alias("rows"))


_FEATURES = [
    "funded_to_loan_ratio",
    "installment_to_income_ratio",
    "fico_midpoint",
    "fico_range",
    "credit_history_years",
    "issue_year",
    "issue_month",
]
_FEATURE_SQL = """
f AS (
  SELECT *, CASE WHEN loan_amnt <> 0 THEN funded_amnt / loan_amnt END AS funded_to_loan_ratio,
    CASE WHEN annual_inc <> 0 THEN installment / annual_inc END AS installment_to_income_ratio,
    CAST(fico_range_low + fico_range_high AS DOUBLE) / 2 AS fico_midpoint,
    fico_range_high - fico_range_low AS fico_range,
    date_diff('day', CAST(earliest_cr_line AS DATE), CAST(issue_d AS DATE)) / CAST(365.25 AS DOUBLE) AS credit_history_years,
    CAST(year(issue_d) AS INTEGER) AS issue_year, CAST(month(issue_d) AS INTEGER) AS issue_month
  FROM loans)"""


@query(
    f"""WITH {LOANS_SQL}, {_FEATURE_SQL} SELECT id, ROUND(funded_to_loan_ratio, 6) AS funded_to_loan_ratio,
        ROUND(installment_to_income_ratio, 6) AS installment_to_income_ratio, fico_midpoint, fico_range,
        ROUND(credit_history_years, 6) AS credit_history_years, issue_year, issue_month FROM f"""
)
def loan_features(spark, sf_dir):
    made = features.engineer_features(loans(spark, sf_dir)).select("id", *_FEATURES)
    return rounded(made, ["funded_to_loan_ratio", "installment_to_income_ratio", "credit_history_years"])


@query(
    f"""WITH {LOANS_SQL}, {_FEATURE_SQL} SELECT id,
        CASE WHEN id % 2 = 0 THEN CAST(-1 AS DOUBLE) ELSE fico_midpoint END AS fico_midpoint, fico_range FROM f"""
)
def complete_features(spark, sf_dir):
    given = loans(spark, sf_dir).withColumn("fico_midpoint", F.when(F.col("id") % 2 == 0, -1.0))
    return features.complete_features(given).select("id", "fico_midpoint", "fico_range")


@query(
    """WITH h AS (SELECT c_mktsegment, AVG(CASE WHEN c_acctbal < 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS rate
                  FROM customer GROUP BY 1)
       SELECT o_orderkey, c.c_mktsegment, ROUND(rate, 6) AS rejection_rate
       FROM orders JOIN customer c ON o_custkey = c_custkey LEFT JOIN h ON h.c_mktsegment = c.c_mktsegment"""
)
def segment_rate_join(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = orders.join(
        customer.select("c_custkey", "c_mktsegment"), orders.o_custkey == F.col("c_custkey")
    ).select("o_orderkey", "c_mktsegment")
    rated = features.join_segment_rate(rows, customer, "c_mktsegment", F.col("c_acctbal") < 0)
    return rounded(rated, ["rejection_rate"])


@query(
    f"""WITH {LOANS_SQL}, t AS (SELECT *, issue_d AS o_orderdate, CASE loan_status WHEN 'P' THEN 1 ELSE 0 END AS target
                               FROM loans WHERE loan_status IN ('F', 'P')), {_CUT}
        SELECT CASE WHEN CAST(issue_d AS DATE) < day THEN 'train' ELSE 'test' END AS split, target,
               COUNT(*) AS "rows", ROUND(AVG(CASE WHEN loan_amnt <> 0 THEN funded_amnt / loan_amnt END), 6) AS mean_ratio,
               21 AS columns
        FROM t, s GROUP BY 1, 2"""
)
def feature_table(spark, sf_dir):
    spec = LoanSpec(labels=LABELS)
    made, reports = jobs.build_features(loans(spark, sf_dir), spec, mode="full")
    stats = made.groupBy("split", "target").agg(
        F.count("*").alias("rows"), F.avg("funded_to_loan_ratio").alias("mean_ratio")
    )
    width = F.lit(len([c for c in made.columns if c not in ("split", "target")]))
    return rounded(stats.withColumn("columns", width), ["mean_ratio"])


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]


@query(
    " UNION ALL ".join(
        f"""SELECT CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, {k} AS place, COUNT(*) AS "rows",
            MIN(CAST({c} AS DOUBLE)) AS low, MAX(CAST({c} AS DOUBLE)) AS high, ROUND(AVG({c}), 6) AS mean FROM lineitem GROUP BY 1"""
        for k, c in enumerate(_NUMBERS)
    )
)
def feature_matrix(spark, sf_dir):
    """Each place of the feature vectors, summed up per label."""
    flagged = table(spark, sf_dir, "lineitem").withColumn("returned", F.col("l_returnflag") == "R")
    made = features.feature_matrix(flagged, "returned", _NUMBERS)
    cells = made.select("label", F.posexplode(vector_to_array("features")).alias("place", "value"))
    stats = cells.groupBy("label", "place").agg(
        F.count("*").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"), F.avg("value").alias("mean")
    )
    return rounded(stats, ["mean"])
