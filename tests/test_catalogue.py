"""Every registered query with SQL equals its twin on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect
from vintage.functions import ordering

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_twin_has_its_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert compare(queries()[name](spark, SF_DIR), duck, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["stratified_sample", "lr_scored", "saved_model_scores", "scored_applications", "stream_scores"])
def test_query_without_sql_runs(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


@pytest.mark.parametrize(
    "name",
    ["impute_median_mode", "impute_by_group", "outliers_iqr", "leakage_screen", "ranking_metrics", "roc_curve",
     "pr_curve", "segment_metrics", "cost_threshold", "alerts", "stratified_sample_months", "stratified_folds"],
)
def test_large_table_routes_equal_sql(spark, duck, name, monkeypatch):
    for limit in ("SINGLE_TASK_ROWS", "EXACT_ROWS", "BROADCAST_ROWS"):
        monkeypatch.setattr(ordering, limit, 0)
    assert compare(queries()[name](spark, SF_DIR), duck, oracle_sql()[name]) is None
