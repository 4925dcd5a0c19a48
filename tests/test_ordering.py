"""Distributed ordering primitives against plain single-machine answers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintage.functions import ordering


@pytest.fixture(scope="module")
def values():
    rng = random.Random(5)
    rows = []
    for i in range(4000):
        # a third of all rows sit in one group and share one value
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        x = 7.5 if i % 3 == 0 and i % 2 else round(rng.gauss(0, 50), 1)
        rows.append((i, group, None if i % 11 == 0 else x, rng.random()))
    return rows


@pytest.fixture(scope="module")
def table(spark, values):
    return spark.createDataFrame(values, "id long, g string, x double, y double")


@pytest.mark.parametrize("limit", [0, 10**9])
def test_exact_quantiles_equal_numpy(table, values, limit):
    probs = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]
    found = ordering.exact_quantiles(table, ["x", "y"], probs, limit=limit)
    xs = [r[2] for r in values if r[2] is not None]
    assert found["x"] == pytest.approx(list(np.quantile(xs, probs)))
    assert found["y"] == pytest.approx(list(np.quantile([r[3] for r in values], probs)))


def test_exact_quantiles_of_an_empty_column(table):
    empty = table.withColumn("z", F.lit(None).cast("double"))
    assert ordering.exact_quantiles(empty, ["z"], [0.5]) == {"z": None}


def test_wrong_bracket_is_widened(table, values, monkeypatch):
    real = F.percentile_approx

    def poor(col, probs, accuracy):
        return real(col, [0.9] * len(probs), accuracy)

    monkeypatch.setattr(ordering.F, "percentile_approx", poor)
    found = ordering.exact_quantiles(table, ["y"], [0.3], limit=0)
    assert found["y"] == pytest.approx([float(np.quantile([r[3] for r in values], 0.3))])


def test_grouped_quantiles_equal_numpy(table, values):
    got = {(r.g, r.column): (r.n, r.q0, r.q1) for r in
           ordering.grouped_quantiles(table, ["g"], ["x", "y"], [0.5, 0.95]).collect()}
    for g in ("hot", "a", "b", None):
        xs = [r[2] for r in values if r[1] == g and r[2] is not None]
        n, q0, q1 = got[(g, "x")]
        assert n == len(xs)
        assert (q0, q1) == pytest.approx(tuple(np.quantile(xs, [0.5, 0.95])))


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_equal_a_plain_window(table, values, descending):
    groups = table.filter("x is not null").groupBy("g", "x").agg(F.count("*").alias("n"))
    got = {(r.g, r.x): (r.cum_n, r.all_n) for r in
           ordering.running_totals(groups, "x", ["n"], by=["g"], descending=descending).collect()}
    for g in ("hot", "a", "b", None):
        xs = [r[2] for r in values if r[1] == g and r[2] is not None]
        for x in set(xs):
            before = sum(v >= x if descending else v <= x for v in xs)
            assert got[(g, x)] == (before, len(xs))


@pytest.mark.parametrize("rows", [10**6, 10])
def test_quantiles_of_one_bucket_broadcast_nothing(spark, table, values, monkeypatch, rows):
    """The values in the brackets fill one bucket, or many if few rows fill one; the quantiles are the same."""
    made = []

    def kept(*args, **options):
        made.append(real(*args, **options))
        return made[-1]

    real = ordering.running_totals
    monkeypatch.setattr(ordering, "running_totals", kept)
    monkeypatch.setattr(ordering, "SINGLE_TASK_ROWS", rows)
    monkeypatch.setattr(ordering, "ACCURACY", 10)
    found = ordering.exact_quantiles(table, ["x", "y"], [0.5], limit=0)
    for c, i in (("x", 2), ("y", 3)):
        assert found[c] == pytest.approx([float(np.quantile([r[i] for r in values if r[i] is not None], 0.5))])
    made[0].collect()
    assert made[0].columns == ["slot", "value", "n", "all_n", "cum_n"]
    # With many buckets the join with their totals is Spark's to choose.
    assert rows == 10 or "Broadcast" not in made[0]._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_running_totals_are_the_same_for_one_bucket_and_many(spark, descending, by):
    data = [(g, x, n) for g in ("a", None) for x, n in ((None, 2), (float("nan"), 3), (-1.0, 4), (0.0, 5), (2.5, 1), (float("inf"), 6))]
    groups = spark.createDataFrame(data if by else data[:6], "g string, x double, n long")
    one, many = (ordering.running_totals(groups, "x", ["n"], by=by, descending=descending, cuts=c) for c in ([], [0.0, 2.0]))
    assert one.schema == many.schema
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    assert {(r.g, r.all_n) for r in one.collect()} == {(r.g, 21) for r in groups.collect()}


def test_hash_rank_is_a_permutation_per_group(table, values):
    rows = ordering.hash_rank(table, ["id"], by=["g"], bits=4).collect()
    assert len(rows) == len(values)
    for g in ("hot", "a", "b", None):
        ranks = sorted(r["rank"] for r in rows if r["g"] == g)
        assert ranks == list(range(1, len(ranks) + 1))
    again = ordering.hash_rank(table.repartition(7), ["id"], by=["g"], bits=4).collect()
    assert {(r["id"], r["rank"]) for r in rows} == {(r["id"], r["rank"]) for r in again}


@pytest.mark.parametrize("n", [0, 1, 17, 3999, 4000, 9000])
def test_take_by_hash_is_exact(table, n):
    ids = [r.id for r in ordering.take_by_hash(table, ["id"], n=n).collect()]
    assert len(ids) == len(set(ids)) == min(n, 4000)


def test_modes_take_the_smallest_tie(spark):
    df = spark.createDataFrame(
        [("g", "b"), ("g", "a"), ("g", None), ("h", "z"), ("h", "y"), ("h", "z")], "g string, s string"
    )
    assert ordering.modes(df, ["s"]).head()["mode"] == "z"
    assert {r.g: r.mode for r in ordering.modes(df, ["s"], ["g"]).collect()} == {"g": "a", "h": "z"}
