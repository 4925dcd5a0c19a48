"""How plans behave: shuffles, file layouts, folders."""

import pytest
from pyspark.sql import functions as F

from vintage.catalogue import base, models
from vintage.functions import ordering
from vintage.operators import evaluate, explain, train
from vintage.plans import jobs
from vintage.sources import tables
from vintage.spec import LoanSpec


def _row_exchanges(df):
    """Exchanges below which nothing has been aggregated."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [next((k for k, c in enumerate(x) if c.isalpha() or c == "*"), 0) for x in lines]
    found = 0
    for k, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            end = next((j for j in range(k + 1, len(lines)) if depth[j] <= depth[k]), len(lines))
            found += not any("HashAggregate" in x for x in lines[k:end])
    return found


def test_rows_are_shuffled_once(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 3).alias("label"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        folds = train.stratified_folds(rows, "label", ["id"])
        assert _row_exchanges(folds) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_null_groups_are_groups(spark):
    rows = spark.createDataFrame([(k, None if k % 2 else "a") for k in range(40)], "id int, g string")
    ranked = ordering.hash_rank(rows, ["id"], by=["g"])
    assert ranked.columns == ["id", "g", "rank"]
    for g in (None, "a"):
        own = sorted(r["rank"] for r in ranked.collect() if r.g == g)
        assert own == list(range(1, 21))


def test_a_forest_does_not_depend_on_files(spark):
    rows = spark.range(600).select("id", F.rand(3).alias("x"), F.rand(4).alias("y")).withColumn("label", (F.col("x") + F.col("y") > 1).cast("int"))
    rows = tables.cut_lineage(rows)
    found = []
    for files in (1, 8):
        model = train.fit(rows.repartition(files), "random_forest", ["x", "y"], params={"n_estimators": 5}, key=["id"])
        scored = model.transform(rows).select("id", "probability").orderBy("id").collect()
        found.append([r.probability.toArray().tolist() for r in scored])
    assert found[0] == found[1]


def test_null_features_are_filled_and_scored(spark):
    rows = spark.range(400).select(
        "id", F.when(F.col("id") % 4 != 0, F.rand(5)).alias("x"), F.lit(None).cast("double").alias("empty"),
        (F.rand(6) > 0.5).cast("int").alias("label"), F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"),
    )
    result = jobs.retrain(rows, ["id"], "label", inputs=["x", "empty"], models=("logistic_regression",), tune=False)
    assert result["scored"].count() == 80
    assert {r.split: r.filled for r in result["filled"].collect()} == {"train": 320, "test": 80}
    path = tables.scratch_path(spark, "filled-model")
    tables.save_model(result["models"]["logistic_regression"], path)
    assert tables.load_model(path).transform(rows).filter("prediction IS NOT NULL").count() == 400


def test_no_grid_point_is_fitted_twice():
    points = train.random_candidates(train.GRIDS["random_forest"], 1000)
    kept = [tuple(v for k, v in p.items() if k not in train.UNMAPPED) for p in points]
    assert len(kept) == len(set(kept))


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="share"):
        tables.shared_folder(Session())


def test_empty_scores(spark):
    none = spark.createDataFrame([], "model string, label int, probability double, prediction int")
    assert evaluate.evaluate(none).count() == 0


def counted_loans(spark):
    """400 loans and the number of times that one of them was made."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def status(k):
        made.add(1)
        return "P" if k % 3 == 0 else "F"

    k = F.col("id")
    rows = spark.range(400).select(
        "id", status("id").alias("loan_status"), F.date_add(F.lit("2015-01-01").cast("date"), (k % 300).cast("int")).alias("issue_d"), F.lit("car").alias("purpose"),
        (k * 7 % 90 + 100.0).alias("loan_amnt"), (k % 13 + 1.0).alias("int_rate"), (k % 7 + 2.0).alias("dti"), (k % 31 + 900.0).alias("annual_inc"),
        (k % 40 + 600).alias("fico_range_low"), (k % 40 + 604).alias("fico_range_high"),
    )
    return rows, made


def test_training_makes_the_raw_rows_once(spark):
    raw, made = counted_loans(spark)
    result = jobs.train_from_raw(raw, LoanSpec(labels={"F": 0, "P": 1}), "full", models=("logistic_regression",), tune=False)
    assert result["metrics"].count() == 1
    assert made.value == 400


def test_scored_applications_make_the_loans_once(spark, monkeypatch):
    raw, made = counted_loans(spark)
    monkeypatch.setattr(models, "loans", lambda *_: raw)
    assert sum(r.rows for r in models.scored_applications(spark, "").collect()) == 400
    assert made.value == 400


def test_loans_send_no_table_through_the_driver(spark, tmp_path):
    """Customers and line items are never broadcast, however small their files; loans without either stay."""
    k = F.col("id")
    tables_ = {
        "customer": spark.range(4).select(F.when(k < 3, k).alias("c_custkey"), (k * 10.0).alias("c_acctbal"), F.lit("A").alias("c_mktsegment"), k.cast("int").alias("c_nationkey"))
        .unionByName(spark.range(1).select(F.lit(1).cast("long").alias("c_custkey"), F.lit(99.0).alias("c_acctbal"), F.lit("B").alias("c_mktsegment"), F.lit(7).alias("c_nationkey"))),
        "orders": spark.range(20).select(
            F.when(k != 19, k).alias("o_orderkey"), F.when(k % 5 < 4, k % 5).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit("LOW").alias("o_orderpriority"),
            (k + 1.0).alias("o_totalprice"), F.lit("2015-01-01").cast("timestamp").alias("o_orderdate")),
        "lineitem": spark.range(30).select(
            F.when(k < 29, k % 10).alias("l_orderkey"), (k + 0.0).alias("l_quantity"), F.lit(8.0).alias("l_extendedprice"), F.lit(0.5).alias("l_discount"), F.lit(0.25).alias("l_tax"),
            F.lit("2014-01-01").cast("timestamp").alias("l_shipdate")),
    }
    for name, rows in tables_.items():
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    made = base.loans(spark, str(tmp_path))
    found = [(r.id, r.annual_inc, r.dti) for r in made.collect()]
    assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()
    dti = {o: sum(float(i) for i in range(29) if i % 10 == o) for o in range(10)}
    income = {0: [0.0], 1: [10.0, 99.0], 2: [20.0]}
    want = [(o if o != 19 else None, inc, dti.get(o)) for o in range(20) for inc in income.get(o % 5, [None])]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_breakdown_deals_its_rows_to_tasks_by_their_number(spark, monkeypatch):
    phi = spark.range(600).select((F.col("id") / 3).cast("int").alias("id"), F.concat(F.lit("f"), F.col("id") % 3).alias("feature"), (F.col("id") % 5 - 2.0).alias("phi"))
    whole = explain.instance_breakdown(phi, ["id"], 1)
    monkeypatch.setattr(explain, "GROUPED_ROWS", 30)
    dealt = explain.instance_breakdown(phi, ["id"], 1)
    assert dealt.rdd.getNumPartitions() == 20
    assert sorted(dealt.collect()) == sorted(whole.collect())
