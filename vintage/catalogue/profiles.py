"""Profiling and validation queries."""

from pyspark.sql import functions as F

from vintage.catalogue.base import (
    GAPS_SQL,
    LABELS,
    LOANS_SQL,
    day_text,
    loans,
    orders_with_gaps,
    query,
    rounded,
    table,
)
from vintage.operators import profile, split
from vintage.plans import jobs
from vintage.sources import tables
from vintage.spec import LoanSpec

_LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()
#: Names of column types in SQL and in Spark.
_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz"}
_TYPE_OF = "MAX(CASE typeof({c}) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _TYPES.items()) + " END)"


def _profile_sql(distinct):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {_TYPE_OF.format(c=c)} AS type, COUNT(*) AS "rows", COUNT(*) - COUNT({c}) AS nulls,
            {f'COUNT(DISTINCT {c}) AS "distinct",' if distinct else ""}
            CAST(MIN({c}) AS VARCHAR) AS min, CAST(MAX({c}) AS VARCHAR) AS max FROM lineitem"""
        for c in _LINEITEM
    )


@query(_profile_sql(True))
def column_profile(spark, sf_dir):
    return profile.column_profile(table(spark, sf_dir, "lineitem"), _LINEITEM, exact=True)


@query(_profile_sql(False))
def one_pass_profile(spark, sf_dir):
    """All but the approximate distinct counts of the profile in one pass."""
    return profile.column_profile(table(spark, sf_dir, "lineitem"), _LINEITEM).drop("distinct")


@query(f'SELECT type, COUNT(*) AS columns FROM ({_profile_sql(False)}) GROUP BY 1')
def type_histogram(spark, sf_dir):
    return profile.type_histogram(profile.column_profile(table(spark, sf_dir, "lineitem"), _LINEITEM))


@query(
    f"""WITH {GAPS_SQL} SELECT COUNT(*) AS "rows", 8 AS columns,
        8 * COUNT(*) - COUNT(o_orderkey) - COUNT(price) - COUNT(priority) - COUNT(cust) - COUNT(issued)
          - COUNT(o_orderstatus) - COUNT(o_orderpriority) - COUNT(o_orderdate) AS missing_cells,
        ROUND(CAST(3 * COUNT(*) - COUNT(price) - COUNT(priority) - COUNT(cust) AS DOUBLE)
              / (8 * COUNT(*)) * 100, 2) AS missing_pct
        FROM g"""
)
def table_stats(spark, sf_dir):
    return profile.table_stats(orders_with_gaps(spark, sf_dir))


@query(
    """SELECT COUNT(*) AS "rows", COUNT(*) - COUNT(DISTINCT (text, lang)) AS duplicates,
       ROUND(CAST(COUNT(*) - COUNT(DISTINCT (text, lang)) AS DOUBLE) / COUNT(*) * 100, 6) AS pct
       FROM documents"""
)
def duplicate_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text", "lang")
    return rounded(profile.duplicate_rows(docs, digest=["text"]), ["pct"])


_GAP_COLUMNS = "o_orderkey price priority cust issued o_orderstatus o_orderpriority o_orderdate".split()
_MISSING = f"WITH {GAPS_SQL}, m AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS missing,
        ROUND(CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*) * 100, 6) AS pct FROM g"""
    for c in _GAP_COLUMNS
) + ")"


@query(_MISSING + " SELECT * FROM m WHERE missing > 0")
def missing_profile(spark, sf_dir):
    return rounded(profile.missing_profile(orders_with_gaps(spark, sf_dir)), ["pct"])


@query(_MISSING + ' SELECT * FROM m ORDER BY pct DESC, "column" LIMIT 4')
def missing_ranking(spark, sf_dir):
    return rounded(profile.missing_ranking(orders_with_gaps(spark, sf_dir), 4), ["pct"])


@query(_MISSING + ' SELECT * FROM m WHERE pct > 50 ORDER BY pct DESC, "column" LIMIT 20')
def high_missing(spark, sf_dir):
    return rounded(profile.high_missing(orders_with_gaps(spark, sf_dir)), ["pct"])


# Column w<i> is NULL in all rows but those whose key leaves a remainder below i.
_WIDE = range(40)


@query(" UNION ALL ".join(
    f"""SELECT 'w{i}' AS "column", COUNT(*) FILTER (o_orderkey % 40 >= {i}) AS missing,
        ROUND(CAST(COUNT(*) FILTER (o_orderkey % 40 >= {i}) AS DOUBLE) / COUNT(*) * 100, 6) AS pct FROM orders
        HAVING COUNT(*) FILTER (o_orderkey % 40 >= {i}) * 2 > COUNT(*)"""
    for i in _WIDE
))
def high_missing_wide(spark, sf_dir):
    """All columns that are mostly missing, however many."""
    key = F.col("o_orderkey")
    wide = table(spark, sf_dir, "orders").select(*[F.when(key % 40 < i, key).alias(f"w{i}") for i in _WIDE])
    return rounded(profile.high_missing(wide), ["pct"])


@query(
    f"""WITH {GAPS_SQL} SELECT 'hardship_type' AS "column" UNION ALL
        SELECT 'cust' FROM g HAVING (COUNT(*) - COUNT(cust)) * 2 > COUNT(*)"""
)
def planned_cleaning(spark, sf_dir):
    """What cleaning by the validation plan drops: a name by its keyword, and a mostly missing column."""
    raw = orders_with_gaps(spark, sf_dir).withColumnRenamed("price", "hardship_type")
    spec = LoanSpec(target="o_orderstatus", date="issued", row_key=("o_orderkey",))
    cleaned, _ = jobs.clean_table(raw, spec, exclude=[spec.target, spec.date], plan=True)
    gone = [c for c in raw.columns if c not in cleaned.columns]
    return spark.createDataFrame([(c,) for c in gone], "column string")


@query(
    f"""WITH {GAPS_SQL} SELECT priority AS value, COUNT(*) AS count,
        ROUND(CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM g) * 100, 6) AS pct
        FROM g WHERE priority IS NOT NULL GROUP BY priority"""
)
def status_distribution(spark, sf_dir):
    return rounded(profile.value_distribution(orders_with_gaps(spark, sf_dir), "priority"), ["pct"])


@query(
    """SELECT COUNT(*) FILTER (o_orderstatus IN ('O')) AS count,
       ROUND(CAST(COUNT(*) FILTER (o_orderstatus IN ('O')) AS DOUBLE) / COUNT(*) * 100, 6) AS pct FROM orders"""
)
def ongoing_share(spark, sf_dir):
    return rounded(profile.membership_share(table(spark, sf_dir, "orders"), "o_orderstatus", ["O"]), ["pct"])


@query(
    f"""WITH {GAPS_SQL}, p AS (SELECT CAST(TRY_STRPTIME(issued, '%b-%Y') AS DATE) AS d FROM g)
        SELECT strftime(MIN(d), '%Y-%m-%d') AS min_date, strftime(MAX(d), '%Y-%m-%d') AS max_date,
               COUNT(*) - COUNT(d) AS missing,
               ROUND(CAST(COUNT(*) - COUNT(d) AS DOUBLE) / COUNT(*) * 100, 6) AS pct FROM p"""
)
def date_profile(spark, sf_dir):
    found = profile.date_profile(orders_with_gaps(spark, sf_dir), "issued")
    return rounded(day_text(found, "min_date", "max_date"), ["pct"])


@query(
    """SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day, COUNT(*) AS count FROM orders
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
)
def top_dates(spark, sf_dir):
    return day_text(profile.top_dates(table(spark, sf_dir, "orders"), "o_orderdate"), "day")


_SCREENED = ["loan_amnt", "funded_amnt", "int_rate", "annual_inc", "total_pymnt"]


def _auc_sql(column):
    return f"""SELECT '{column}' AS "column",
        CASE WHEN '{column}' = 'total_pymnt' THEN 'high' ELSE 'safe' END AS risk,
        ROUND((SELECT CAST(COUNT(*) - COUNT({column}) AS DOUBLE) / COUNT(*) * 100 FROM y), 6) AS null_pct,
        (SELECT ROUND(SUM(CAST(n AS DOUBLE) * (tp - p) + CAST(n AS DOUBLE) * p / 2)
                / MAX(CAST(pp AS DOUBLE) * nn), 6)
         FROM (SELECT p, n, SUM(p) OVER (ORDER BY v DESC) AS tp, SUM(p) OVER () AS pp, SUM(n) OVER () AS nn
               FROM (SELECT ROUND({column}, 4) AS v, SUM(target) AS p, SUM(1 - target) AS n FROM y
                     WHERE {column} IS NOT NULL GROUP BY 1))) AS auc"""


@query(
    f"""WITH {LOANS_SQL}, y AS (SELECT *, CASE loan_status WHEN 'P' THEN 1 ELSE 0 END AS target
        FROM loans WHERE loan_status IN ('F', 'P')) """
    + " UNION ALL ".join(_auc_sql(c) for c in _SCREENED)
)
def leakage_screen(spark, sf_dir):
    # Sums of doubles depend on the order of addition; rounding them first
    # keeps equal amounts tied in both engines.
    labelled = rounded(split.map_labels(loans(spark, sf_dir), "loan_status", LABELS), _SCREENED, 4)
    return rounded(profile.leakage_screen(labelled, "target", _SCREENED), ["null_pct", "auc"])


def _plan_input(spark, sf_dir):
    # A leakage-named column that is also mostly missing counts once.
    gaps = orders_with_gaps(spark, sf_dir)
    return gaps.withColumnsRenamed({"cust": "hardship_type", "price": "total_pymnt"})


@query(
    f"""WITH {GAPS_SQL}, m AS (
          SELECT 'hardship_type' AS "column", COUNT(*) - COUNT(cust) AS n, COUNT(*) AS t FROM g UNION ALL
          SELECT 'total_pymnt', COUNT(*) - COUNT(price), COUNT(*) FROM g UNION ALL
          SELECT 'priority', COUNT(*) - COUNT(priority), COUNT(*) FROM g)
        SELECT "column", "column" <> 'priority' AS leakage, n * 100 > 50 * t AS high_missing FROM m
        WHERE "column" <> 'priority' OR n * 100 > 50 * t"""
)
def drop_plan(spark, sf_dir):
    df = _plan_input(spark, sf_dir)
    return profile.drop_plan(profile.leakage_by_name(df), profile.high_missing(df))


@query(
    f"""WITH {GAPS_SQL} SELECT 8 AS total_columns, CAST(2 AS BIGINT) AS drop_leakage,
        CAST(CASE WHEN (COUNT(*) - COUNT(cust)) * 2 > COUNT(*) THEN 1 ELSE 0 END AS BIGINT) AS drop_missing,
        CAST(6 AS BIGINT) AS remaining_columns FROM g"""
)
def drop_summary(spark, sf_dir):
    df = _plan_input(spark, sf_dir)
    plan = profile.drop_plan(profile.leakage_by_name(df), profile.high_missing(df))
    return profile.drop_summary(df, plan)


# From 1998 on the code column holds text, before 1997 the flag is empty.
def _vintages(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return orders.select(
        "year",
        F.when(F.col("year") >= 1998, F.concat(F.lit("C"), F.col("o_custkey"))).otherwise(
            F.col("o_custkey").cast("string")
        ).alias("code"),
        F.when(F.col("year") >= 1997, F.col("o_orderpriority")).alias("flag"),
        F.when(F.col("year") == 1999, F.col("o_totalprice").cast("string")).alias("promo"),
    )


_EXPECTED = {"code": "bigint", "flag": "string", "promo": "double"}
_VINTAGE_SQL = """
v AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS vintage, o_custkey, o_orderpriority, o_totalprice FROM orders),
p AS (
  SELECT vintage, 'code' AS "column", COUNT(*) AS "rows", CAST(100 AS DOUBLE) AS filled_pct,
         CASE WHEN vintage >= 1998 THEN CAST(0 AS DOUBLE) ELSE CAST(100 AS DOUBLE) END AS castable_pct
  FROM v GROUP BY vintage
  UNION ALL
  SELECT vintage, 'flag', COUNT(*), CASE WHEN vintage >= 1997 THEN CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END,
         CASE WHEN vintage >= 1997 THEN CAST(100 AS DOUBLE) END FROM v GROUP BY vintage
  UNION ALL
  SELECT vintage, 'promo', COUNT(*), CASE WHEN vintage = 1999 THEN CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END,
         CASE WHEN vintage = 1999 THEN CAST(100 AS DOUBLE) END FROM v GROUP BY vintage)
"""


@query(f"WITH {_VINTAGE_SQL} SELECT * FROM p")
def vintage_profile(spark, sf_dir):
    return profile.vintage_profile(_vintages(spark, sf_dir), F.col("year"), _EXPECTED)


@query(
    f"""WITH {_VINTAGE_SQL}, c AS (SELECT "column", COUNT(*) AS vintages,
          COUNT(*) FILTER (filled_pct > 0) AS vintages_present,
          COUNT(*) FILTER (filled_pct > 0 AND castable_pct < 100) AS type_conflicts FROM p GROUP BY 1)
        SELECT *, CASE WHEN vintages_present = vintages THEN 'common' WHEN vintages_present = 1 THEN 'unique'
                       ELSE 'partial' END AS presence FROM c"""
)
def vintage_consistency(spark, sf_dir):
    found = profile.vintage_profile(_vintages(spark, sf_dir), F.col("year"), _EXPECTED)
    return profile.vintage_consistency(found)


@query(
    """WITH c AS (SELECT COUNT(*) AS n FROM customer), s AS (SELECT COUNT(*) AS n FROM supplier)
       SELECT "column", CASE WHEN "column" = 'mktsegment' THEN 1 ELSE 2 END::BIGINT AS tables_present,
              CASE WHEN "column" = 'mktsegment' THEN 'customer' ELSE 'customer,supplier' END AS found_in,
              CASE WHEN "column" = 'mktsegment' THEN c.n ELSE c.n + s.n END AS "values",
              1 AS declared_types
       FROM c, s, (VALUES ('key'), ('name'), ('nationkey'), ('acctbal'), ('mktsegment')) AS t("column")"""
)
def schema_consistency(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").withColumnsRenamed(
        {"c_custkey": "key", "c_name": "name", "c_nationkey": "nationkey", "c_acctbal": "acctbal", "c_mktsegment": "mktsegment"}
    )
    supplier = table(spark, sf_dir, "supplier").withColumnsRenamed(
        {"s_suppkey": "key", "s_name": "name", "s_nationkey": "nationkey", "s_acctbal": "acctbal"}
    )
    return profile.schema_consistency({"customer": customer, "supplier": supplier})


_REPORT_SPEC = LoanSpec(target="loan_status", date="issue_d", labels=LABELS)


@query(
    f"""WITH {LOANS_SQL}, n AS (SELECT COUNT(*) AS t FROM loans),
    m AS ("""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS c, COUNT(*) - COUNT({c}) AS k FROM loans"
        for c in (
            "id loan_status issue_d purpose addr_state loan_amnt funded_amnt installment int_rate dti "
            "annual_inc fico_range_low fico_range_high earliest_cr_line total_pymnt"
        ).split()
    )
    + """),
    days AS (SELECT CAST(issue_d AS DATE) AS d, COUNT(*) AS c FROM loans GROUP BY 1),
    w AS (SELECT d, c, SUM(c) OVER (ORDER BY d) AS cum FROM days),
    sp AS (SELECT ratio, MIN(d) AS day, MIN(cum - c) AS train FROM w, n, (VALUES (CAST(0.8 AS DOUBLE)), (CAST(0.7 AS DOUBLE))) AS r(ratio)
           WHERE cum > CAST(floor(t * ratio) AS BIGINT) GROUP BY ratio)
    SELECT 'leakage' AS section, risk AS name, 'columns' AS metric, CAST(k AS DOUBLE) AS value
      FROM (VALUES ('high', 1), ('medium', 1), ('safe', 12)) AS v(risk, k)
    UNION ALL SELECT 'missing', c, 'missing', CAST(k AS DOUBLE) FROM m
    UNION ALL SELECT 'missing', c, 'pct', ROUND(CAST(k AS DOUBLE) / t * 100, 6) FROM m, n
    UNION ALL SELECT 'target', loan_status, 'count', CAST(COUNT(*) AS DOUBLE) FROM loans GROUP BY loan_status
    UNION ALL SELECT 'target', loan_status, 'pct', ROUND(CAST(COUNT(*) AS DOUBLE) / (SELECT t FROM n) * 100, 6) FROM loans GROUP BY loan_status
    UNION ALL SELECT 'dates', '', 'missing', CAST(0 AS DOUBLE)
    UNION ALL SELECT 'dates', '', 'pct', CAST(0 AS DOUBLE)
    UNION ALL SELECT 'split', strftime(day, '%Y-%m-%d'), 'ratio', ratio FROM sp
    UNION ALL SELECT 'split', strftime(day, '%Y-%m-%d'), 'train_rows', CAST(train AS DOUBLE) FROM sp
    UNION ALL SELECT 'split', strftime(day, '%Y-%m-%d'), 'test_rows', CAST(t - train AS DOUBLE) FROM sp, n
    UNION ALL SELECT 'drops', '', metric, CAST(k AS DOUBLE) FROM
      (VALUES ('total_columns', 15), ('drop_leakage', 1), ('drop_missing', 0), ('remaining_columns', 14)) AS v(metric, k)
    UNION ALL SELECT 'ongoing', '', 'count', CAST(COUNT(*) AS DOUBLE) FROM loans WHERE loan_status = 'O'
    UNION ALL SELECT 'ongoing', '', 'pct', ROUND(CAST(COUNT(*) AS DOUBLE) / (SELECT t FROM n) * 100, 6) FROM loans WHERE loan_status = 'O'"""
)
def validation_report(spark, sf_dir):
    report = jobs.validation_report(loans(spark, sf_dir), _REPORT_SPEC, ongoing=["O"])
    return rounded(report.fillna("", subset=["name"]), ["value"])


@query()
def table_fingerprint(spark, sf_dir):
    return tables.fingerprint(table(spark, sf_dir, "lineitem"))


@query()
def file_metadata(spark, sf_dir):
    return tables.file_metadata(spark, f"{sf_dir}/*.parquet")
