"""Tables as wide as the raw loan file: batched aggregations hold together."""

import pytest
from pyspark.sql import functions as F

from vintage.operators import clean, monitor, profile, score

WIDTH = 150


@pytest.fixture(scope="module")
def wide(spark):
    numbers = [
        F.when((F.col("id") + i) % 10 != 0, F.col("id") * (i + 1)).cast("double").alias(f"n{i}")
        for i in range(WIDTH - 10)
    ]
    words = [F.when(F.col("id") % 4 != 0, F.concat(F.lit("w"), F.col("id") % 3)).alias(f"s{i}") for i in range(10)]
    return spark.range(200).select(*numbers, *words)


def test_profiles_cover_every_column(wide):
    assert profile.column_profile(wide).count() == WIDTH
    assert profile.missing_profile(wide).count() == WIDTH
    assert profile.table_stats(wide).head().missing_cells == (WIDTH - 10) * 20 + 10 * 50


def test_imputation_leaves_no_gap(wide):
    filled, log = clean.impute(wide)
    assert log.count() == WIDTH
    assert profile.missing_profile(filled).count() == 0


def test_outliers_and_drift(wide):
    columns = [f"n{i}" for i in range(WIDTH - 10)]
    assert clean.outliers_iqr(wide).count() == clean.outliers_zscore(wide).count() == WIDTH - 10
    reference = monitor.reference_stats(wide, columns)
    checks = monitor.drift(wide, reference, columns)
    assert checks.count() == WIDTH - 10
    assert not monitor.drift_summary(checks).head().drift_detected


def test_all_application_rules_at_once(spark):
    rules = score.application_rules()
    row = {r.name: (r.low or 0.0) for r in rules}
    good = spark.createDataFrame([tuple(row.values())], list(row))
    bad = good.withColumn("int_rate", F.lit(101.0)).withColumn("fico_range_low", F.lit(849))
    checked = score.check_rules(good.unionByName(bad), rules, [("fico_range_low", "fico_range_high")])
    found = sorted(r.violations for r in checked.collect())
    assert found == [[], ["int_rate:max", "fico_range_high<fico_range_low"]]
    empty = score.check_rules(spark.range(1), rules).head().violations
    assert len(empty) == 15 and all(v.endswith(":required") for v in empty)
    assert score.apply_defaults(spark.range(1), rules).head().policy_code == 1
