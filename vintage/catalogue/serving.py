"""Input rules, scoring checks, monitoring and streaming queries."""

from pyspark.sql import functions as F

from vintage.catalogue.base import (
    LOANS_SQL,
    LOG_SQL,
    SCORED_SQL,
    as_requests,
    loans,
    query,
    request_log,
    rounded,
    scored_documents,
    table,
)
from vintage.functions.ordering import grouped_quantiles
from vintage.operators import monitor, score
from vintage.sources.tables import scratch_path
from vintage.streaming import blocks
from vintage.streaming import requests as streams
from vintage.streaming import windows

_RULES = [r for r in score.application_rules() if r.name in {"loan_amnt", "int_rate", "installment", "annual_inc", "dti", "fico_range_low", "fico_range_high"}]
_PAIR = [("fico_range_low", "fico_range_high")]
_CODES = {
    "loan_amnt:min": "loan_amnt < 0",
    "int_rate:required": "int_rate IS NULL",
    "int_rate:min": "int_rate < 0",
    "int_rate:max": "int_rate > 100",
    "installment:required": "installment IS NULL",
    "annual_inc:min": "annual_inc < 0",
    "dti:required": "dti IS NULL",
    "fico_range_low:max": "fico_range_low > 850",
    "fico_range_high:max": "fico_range_high > 850",
    "fico_range_high<fico_range_low": "fico_range_high < fico_range_low",
}


def _checked(spark, sf_dir):
    return score.check_rules(loans(spark, sf_dir), _RULES, _PAIR)


@query(
    f"WITH {LOANS_SQL}, v AS ("
    + " UNION ALL ".join(
        f"SELECT '{code}' AS violation, COUNT(*) AS \"rows\" FROM loans WHERE {cond}" for code, cond in _CODES.items()
    )
    + ') SELECT * FROM v WHERE "rows" > 0'
)
def rule_violations(spark, sf_dir):
    return score.violation_counts(_checked(spark, sf_dir))


@query(
    f"""WITH {LOANS_SQL}, v AS (SELECT id, {" OR ".join(f"COALESCE({c}, FALSE)" for c in _CODES.values())} AS bad FROM loans)
        SELECT CASE WHEN bad THEN 'rejected' ELSE 'valid' END AS side, COUNT(*) AS "rows", CAST(SUM(id) AS BIGINT) AS id_sum
        FROM v GROUP BY 1"""
)
def rule_outcome(spark, sf_dir):
    checked = _checked(spark, sf_dir)
    good = score.valid_rows(checked).select(F.lit("valid").alias("side"), "id")
    bad = score.rejected_rows(checked).select(F.lit("rejected").alias("side"), "id")
    sides = good.unionByName(bad).groupBy("side")
    return sides.agg(F.count("*").alias("rows"), F.sum("id").alias("id_sum"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE CAST(o_custkey % 7 AS INTEGER) END AS policy_code,
       CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 2 END AS acc_now_delinq, 0 AS chargeoff_within_12_mths FROM orders"""
)
def application_defaults(spark, sf_dir):
    key = F.col("o_orderkey")
    given = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 4 != 0, F.col("o_custkey") % 7).alias("policy_code"),
        F.when(key % 3 != 0, 2).alias("acc_now_delinq"),
    )
    names = {"policy_code", "acc_now_delinq", "chargeoff_within_12_mths"}
    return score.apply_defaults(given, [r for r in score.application_rules() if r.name in names])


@query(
    """SELECT concat_ws(',', CASE WHEN o_orderkey % 6 = 0 THEN 'amount' END, CASE WHEN o_orderkey % 10 < 7 THEN 'cust' END) AS null_features,
       COUNT(*) AS "rows", ROUND(SUM(CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice END), 2) AS amount
       FROM orders GROUP BY 1"""
)
def align_reject(spark, sf_dir):
    key = F.col("o_orderkey")
    given = table(spark, sf_dir, "orders").select(
        F.when(key % 10 >= 7, F.col("o_custkey")).alias("cust"),
        F.when(key % 6 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        "o_orderpriority",
    )
    aligned = score.align(given, ["amount", "cust"])
    grouped = aligned.groupBy(F.array_join("null_features", ",").alias("null_features"))
    return rounded(grouped.agg(F.count("*").alias("rows"), F.sum("amount").alias("amount")), ["amount"], 2)


_ITEMS = ["l_quantity", "l_extendedprice", "l_discount"]
_REFERENCE_SQL = "ref AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, AVG({c}) AS mean, stddev_samp({c}) AS std, MIN({c}) AS min, MAX({c}) AS max
        FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01'"""
    for c in _ITEMS
) + ")"


def _reference(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return monitor.reference_stats(items.filter("l_shipdate < TIMESTAMP_NTZ '1999-01-01'"), _ITEMS)


@query(f"WITH {_REFERENCE_SQL} SELECT feature, ROUND(mean, 4) AS mean, ROUND(std, 4) AS std, min, max FROM ref")
def reference_stats(spark, sf_dir):
    return rounded(_reference(spark, sf_dir), ["mean", "std"], 4)


_DRIFT_SQL = f"WITH {_REFERENCE_SQL}, z AS (" + " UNION ALL ".join(
    f"""SELECT l_returnflag, '{c}' AS feature, MAX(abs((x - mean) / std)) AS z_score, MAX(mean) AS reference_mean,
        CASE WHEN abs(MAX(x) - MAX(mean)) >= abs(MIN(x) - MAX(mean)) THEN MAX(x) ELSE MIN(x) END AS current_value
        FROM (SELECT l_returnflag, l_shipdate, CASE WHEN l_linenumber = 7 THEN 3 ELSE 1 END * CAST({c} AS DOUBLE) AS x FROM lineitem), ref
        WHERE feature = '{c}' AND l_shipdate >= TIMESTAMP '1999-01-01' GROUP BY 1"""
    for c in _ITEMS
) + ")"


def _drifted(spark, sf_dir):
    """Later items, those on line 7 tripled, against earlier ones."""
    later = table(spark, sf_dir, "lineitem").filter("l_shipdate >= TIMESTAMP_NTZ '1999-01-01'")
    scale = F.when(F.col("l_linenumber") == 7, 3.0).otherwise(1.0)
    moved = later.withColumns({c: F.col(c) * scale for c in _ITEMS})
    return monitor.drift(moved, _reference(spark, sf_dir), _ITEMS, by=["l_returnflag"])


@query(
    f"""{_DRIFT_SQL} SELECT l_returnflag, feature, ROUND(z_score, 6) AS z_score, ROUND(reference_mean, 4) AS reference_mean,
        ROUND(current_value, 4) AS current_value, z_score > 3 AS drifted FROM z"""
)
def drift(spark, sf_dir):
    found = rounded(_drifted(spark, sf_dir), ["z_score"])
    return rounded(found, ["reference_mean", "current_value"], 4)


@query(
    f"""{_DRIFT_SQL} SELECT l_returnflag, bool_or(z_score > 3) AS drift_detected, COUNT(*) AS features_checked,
        COUNT(*) FILTER (z_score > 3) AS features_with_drift, ROUND(MAX(z_score), 6) AS max_z_score FROM z GROUP BY 1"""
)
def drift_summary(spark, sf_dir):
    return rounded(monitor.drift_summary(_drifted(spark, sf_dir), ["l_returnflag"]), ["max_z_score"])


_STATS = """COUNT(*) AS total_requests, COUNT(*) FILTER (status >= 400) AS errors,
    ROUND(CAST(COUNT(*) FILTER (status >= 400) AS DOUBLE) / COUNT(*), 6) AS error_rate, ROUND(AVG(duration) * 1000, 8) AS avg_latency_ms"""


def _shown(stats):
    return rounded(rounded(stats, ["error_rate"]), ["avg_latency_ms"], 8)


@query(f"WITH {LOG_SQL} SELECT method, endpoint, {_STATS} FROM r GROUP BY 1, 2")
def request_stats(spark, sf_dir):
    return _shown(monitor.request_stats(request_log(spark, sf_dir)))


@query(f"WITH {LOG_SQL} SELECT method, endpoint, status, COUNT(*) AS requests FROM r GROUP BY 1, 2, 3")
def request_counts(spark, sf_dir):
    return monitor.request_counts(request_log(spark, sf_dir))


def _histogram_sql(source, value, by, bounds):
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    rows = [
        f"""SELECT {keys}'{float(b)}' AS le, COUNT(*) FILTER ({value} <= CAST({b} AS DOUBLE)) AS bucket, COUNT({value}) AS count,
            ROUND(SUM({value}), 4) AS sum FROM {source} {group}"""
        for b in bounds
    ]
    rows.append(
        f"SELECT {keys}'+Inf' AS le, COUNT({value}) AS bucket, COUNT({value}) AS count, ROUND(SUM({value}), 4) AS sum FROM {source} {group}"
    )
    return " UNION ALL ".join(rows)


@query(f"WITH {LOG_SQL} " + _histogram_sql("r", "duration", "method, endpoint", monitor.LATENCY_BOUNDS))
def latency_histogram(spark, sf_dir):
    return rounded(monitor.latency_histogram(request_log(spark, sf_dir)), ["sum"], 4)


@query(f"WITH {SCORED_SQL} SELECT model, prediction, COUNT(*) AS predictions FROM s GROUP BY 1, 2")
def prediction_counts(spark, sf_dir):
    return monitor.prediction_counts(scored_documents(spark, sf_dir), ["model"])


@query(f"WITH {SCORED_SQL} " + _histogram_sql("s", "probability", "model", monitor.PROBABILITY_BOUNDS))
def probability_histogram(spark, sf_dir):
    return rounded(monitor.probability_histogram(scored_documents(spark, sf_dir), ["model"]), ["sum"], 4)


@query(
    f"""WITH {LOG_SQL}, a AS (SELECT method, endpoint, CAST(COUNT(*) FILTER (status >= 400) AS DOUBLE) / COUNT(*) AS e,
          quantile_cont(duration, 0.95) AS p FROM r GROUP BY 1, 2)
        SELECT method, endpoint, ROUND(e, 6) AS error_rate, ROUND(p, 6) AS p95_seconds,
               e > 0.05 AS error_alert, p > 1.0 AS latency_alert FROM a"""
)
def alerts(spark, sf_dir):
    return rounded(monitor.alerts(request_log(spark, sf_dir)), ["error_rate", "p95_seconds"])


@query(
    f"""WITH {LOG_SQL}, a AS (SELECT method || ' ' || endpoint AS subject, CAST(COUNT(*) FILTER (status >= 400) AS DOUBLE) / COUNT(*) AS e,
          quantile_cont(duration, 0.95) AS p FROM r GROUP BY 1),
        z AS (SELECT MAX(abs((value - m) / s)) AS z FROM r, (SELECT AVG(value) AS m, stddev_samp(value) AS s FROM r WHERE ts < TIMESTAMP '2024-01-15')
              WHERE ts >= TIMESTAMP '2024-01-15')
        SELECT subject, 'error_rate' AS alert, ROUND(e, 6) AS value FROM a WHERE e > 0.05
        UNION ALL SELECT subject, 'p95_latency', ROUND(p, 6) FROM a WHERE p > 1.0
        UNION ALL SELECT 'value', 'drift', ROUND(z, 6) FROM z WHERE z > 3"""
)
def firing_alerts(spark, sf_dir):
    log = request_log(spark, sf_dir)
    early, late = (log.filter(f"ts {op} TIMESTAMP_NTZ '2024-01-15'") for op in ("<", ">="))
    moved = monitor.drift(late, monitor.reference_stats(early, ["value"]), ["value"])
    return rounded(monitor.firing(monitor.alerts(log), moved), ["value"])


# Streams read the events table file by file until it is used up. In complete
# mode the last state equals the batch result, which is what SQL computes.


def _stream(spark, sf_dir):
    return as_requests(streams.stream_table(spark, f"{sf_dir}/events.parquet"))


def _files(spark, sf_dir, path, files, order=None):
    """The events as a stream of so many files, one per micro-batch; with ``order`` each file is a range of it."""
    events = table(spark, sf_dir, "events")
    dealt = events.repartitionByRange(files, order) if order else events.repartition(files, "event_id")
    dealt.write.parquet(f"{path}/events")
    return as_requests(streams.stream_table(spark, f"{path}/events", files_per_batch=1))


def _start_text(df):
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


@query(f"WITH {LOG_SQL} SELECT strftime(ts, '%Y-%m-%d') AS window_start, method, endpoint, {_STATS} FROM r GROUP BY 1, 2, 3")
def stream_request_stats(spark, sf_dir):
    stats = streams.windowed_requests(_stream(spark, sf_dir))
    return _shown(_start_text(streams.run_available(stats, scratch_path(spark, "requests"))))


@query(f"WITH {LOG_SQL} SELECT strftime(ts, '%Y-%m-%d') AS window_start, method, endpoint, {_STATS} FROM r GROUP BY 1, 2, 3")
def stream_request_updates(spark, sf_dir):
    """The same in update mode, one file per micro-batch; the files are not in order of time, so the delay covers all."""
    path = scratch_path(spark, "updates")
    stats = streams.windowed_requests(_files(spark, sf_dir, path, 4), watermark="3650 days")
    windows.run_updates(stats, f"{path}/windows")
    return _shown(_start_text(windows.latest(spark, f"{path}/windows", stats, ["window_start", "method", "endpoint"])))


@query(
    f"""WITH {LOG_SQL}, a AS (SELECT strftime(ts, '%Y-%m-%d') AS window_start, method, endpoint, COUNT(*) AS n,
          CAST(COUNT(*) FILTER (status >= 400) AS DOUBLE) / COUNT(*) AS e, quantile_cont(duration, 0.95) AS p FROM r GROUP BY 1, 2, 3)
        SELECT window_start, method, endpoint, n AS total_requests, ROUND(e, 6) AS error_rate, e > 0.05 AS error_alert,
               ROUND(p, 6) AS exact_p95, p IS NOT NULL AS enclosed FROM a"""
)
def stream_alerts(spark, sf_dir):
    """Alerts of windows from a stream's sketches, and whether their bounds enclose the exact p95 of the table."""
    path = scratch_path(spark, "alerts")
    found = windows.windowed_alerts(_files(spark, sf_dir, path, 4), watermark="3650 days")
    windows.run_updates(found, f"{path}/windows")
    keys = ["window_start", "method", "endpoint"]
    seen = _start_text(windows.latest(spark, f"{path}/windows", found, keys))
    days = request_log(spark, sf_dir).withColumn("window_start", F.date_format("ts", "yyyy-MM-dd"))
    exact = grouped_quantiles(days, keys, ["duration"], [0.95]).withColumnRenamed("q0", "exact_p95")
    enclosed = F.coalesce(F.col("exact_p95").between(F.col("p95_low") - 1e-9, F.col("p95_high") + 1e-9), F.lit(False))
    shown = seen.join(exact, keys).select(*keys, "total_requests", "error_rate", "error_alert", "exact_p95", enclosed.alias("enclosed"))
    return rounded(shown, ["error_rate", "exact_p95"])


@query(
    f"""WITH {LOG_SQL} SELECT strftime(ts, '%Y-%m-%d') AS window_start, CASE WHEN value >= 50 THEN 1 ELSE 0 END AS prediction,
        COUNT(*) AS predictions, ROUND(AVG(least(value / 100, 1)), 6) AS mean_probability FROM r GROUP BY 1, 2"""
)
def stream_prediction_counts(spark, sf_dir):
    rows = _stream(spark, sf_dir).select(
        "ts",
        (F.col("value") >= 50).cast("int").alias("prediction"),
        F.least(F.col("value") / 100, F.lit(1.0)).alias("probability"),
    )
    counts = streams.windowed_predictions(rows)
    written = streams.run_available(counts, scratch_path(spark, "predictions"))
    return rounded(_start_text(written), ["mean_probability"])


@query(
    f"""WITH {LOG_SQL}, ref AS (SELECT AVG(value) AS m, stddev_samp(value) AS s FROM r WHERE ts < TIMESTAMP '2024-01-15'),
        z AS (SELECT strftime(ts, '%Y-%m-%d') AS window_start, MAX(abs((value - m) / s)) AS z, MAX(m) AS m,
            CASE WHEN abs(MAX(value) - MAX(m)) >= abs(MIN(value) - MAX(m)) THEN MAX(value) ELSE MIN(value) END AS c FROM r, ref GROUP BY 1)
        SELECT window_start, 'value' AS feature, ROUND(z, 6) AS z_score, ROUND(m, 6) AS reference_mean, ROUND(c, 6) AS current_value, z > 3 AS drifted FROM z"""
)
def stream_drift(spark, sf_dir):
    baseline = request_log(spark, sf_dir).filter("ts < TIMESTAMP_NTZ '2024-01-15'")
    reference = monitor.reference_stats(baseline, ["value"])
    checks = streams.windowed_drift(_stream(spark, sf_dir), reference, ["value"])
    written = streams.run_available(checks, scratch_path(spark, "drift"))
    return rounded(_start_text(written), ["z_score", "reference_mean", "current_value"])


@query(
    f"""WITH {LOG_SQL}, q AS (SELECT endpoint, quantile_cont(value, 0.5) AS m FROM r WHERE CAST(user_id AS BIGINT) % 4 <> 0 GROUP BY 1)
        SELECT endpoint, COUNT(*) AS "rows", ROUND(SUM(CASE WHEN user_id % 4 <> 0 THEN value ELSE m END), 4) AS total
        FROM r JOIN q USING (endpoint) GROUP BY 1"""
)
def stream_group_clean(spark, sf_dir):
    """Fill gaps of a stream of files, one per micro-batch, with the medians of whole endpoints."""
    path = scratch_path(spark, "cleaned")
    rows = _files(spark, sf_dir, path, 4).select("endpoint", F.when(F.col("user_id") % 4 != 0, F.col("value")).alias("value"))
    written = blocks.clean_blocks(rows, path, ["endpoint"], ["value"])
    totals = written.groupBy("endpoint").agg(F.count("*").alias("rows"), F.sum("value").alias("total"))
    return rounded(totals, ["total"], 4)


@query(
    f"""WITH {LOG_SQL}, d AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM r),
            q AS (SELECT day, quantile_cont(value, 0.5) AS m FROM d WHERE CAST(user_id AS BIGINT) % 4 <> 0 GROUP BY 1)
        SELECT day, COUNT(*) AS "rows", ROUND(SUM(CASE WHEN user_id % 4 <> 0 THEN value ELSE m END), 4) AS total
        FROM d LEFT JOIN q USING (day) GROUP BY 1"""
)
def stream_day_clean(spark, sf_dir):
    """Days of a stream of files, each filled with its own median once it is over, and anew for rows that come late."""
    path = scratch_path(spark, "days")
    rows = _files(spark, sf_dir, path, 4, "ts").select(
        "ts", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.when(F.col("user_id") % 4 != 0, F.col("value")).alias("value"),
        (F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY")).alias("over"),
    )
    written = blocks.clean_blocks(rows, path, ["day"], ["value"], ts="ts", until="over")
    totals = written.groupBy("day").agg(F.count("*").alias("rows"), F.sum("value").alias("total"))
    return rounded(totals, ["total"], 4)
