"""Training, search, attribution and model scoring queries.

Most have no SQL twin: fitting is iterative. Their tests check them against
closed forms and Spark's own evaluators instead.
"""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from vintage.catalogue.base import LABELS, loans, query, rounded, table
from vintage.operators import attribution, boosting, evaluate, explain, features, monitor, score, split, train
from vintage.plans import jobs
from vintage.sources import tables
from vintage.spec import LoanSpec
from vintage.streaming import requests as streams

TEXT_FEATURES = ["chars", "words", "lines", "digits", "capitals", "repeats", "blank_share"]


def labelled_documents(spark, sf_dir):
    """Quality label and counts over the whole text of each labelled document.

    The counts are written once: every fit and score below reads the small
    numeric table, not the text.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = table(spark, sf_dir, "labels").join(docs, "doc_id")
    words = F.split(F.trim("text"), r"\s+")
    chars = F.length("text").cast("double")

    def count_of(letters):
        return chars - F.length(F.translate("text", letters, ""))

    counted = rows.select(
        "doc_id",
        F.col("quality").alias("label"),
        F.when(F.pmod(F.xxhash64("doc_id"), F.lit(10)) < 7, "train").otherwise("test").alias("split"),
        chars.alias("chars"),
        F.size(words).cast("double").alias("words"),
        (count_of("\n") + 1).alias("lines"),
        count_of("0123456789").alias("digits"),
        count_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("capitals"),
        (1 - F.size(F.array_distinct(words)) / F.size(words)).alias("repeats"),
        F.coalesce(F.try_divide(count_of(" \n\t"), chars), F.lit(0.0)).alias("blank_share"),
    )
    return tables.cut_lineage(counted)


@query(
    """WITH c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (quality = 0) AS a, COUNT(*) FILTER (quality = 1) AS b FROM labels)
       SELECT 0 AS label, a AS "rows", ROUND(CAST(n AS DOUBLE) / (2 * a), 6) AS balanced_weight, CAST(1 AS DOUBLE) AS positive_weight FROM c
       UNION ALL SELECT 1, b, ROUND(CAST(n AS DOUBLE) / (2 * b), 6), ROUND(CAST(a AS DOUBLE) / b, 6) FROM c"""
)
def class_weights(spark, sf_dir):
    found = train.class_weights(table(spark, sf_dir, "labels"), "quality")
    return rounded(found, ["balanced_weight", "positive_weight"])


@query(
    """WITH c AS (SELECT quality, COUNT(*) AS n FROM labels GROUP BY 1)
       SELECT quality, fold, n // 5 + CASE WHEN fold < n % 5 THEN 1 ELSE 0 END AS "rows"
       FROM c, (VALUES (0), (1), (2), (3), (4)) AS f(fold)"""
)
def stratified_folds(spark, sf_dir):
    folded = train.stratified_folds(table(spark, sf_dir, "labels"), "quality", ["doc_id"])
    return folded.groupBy("quality", "fold").agg(F.count("*").alias("rows"))


def _fit_and_score(spark, sf_dir, name, params=None):
    rows = labelled_documents(spark, sf_dir)
    model = train.fit(rows.filter("split = 'train'"), name, TEXT_FEATURES, params=params)
    return score.score(rows.filter("split = 'test'"), model, ["doc_id", "label"])


@query()
def lr_scored(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, "logistic_regression")


@query()
def rf_scored(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, "random_forest")


@query()
def gbt_scored(spark, sf_dir):
    return _fit_and_score(spark, sf_dir, "gradient_boosting", {})


FIRST_TREE = ["ship_year", "quantity", "discount", "line"]


@query(
    """WITH t AS (SELECT CASE WHEN l_returnflag = 'N' THEN -0.5 ELSE 0.5 END AS g,
              [CAST(YEAR(l_shipdate) AS DOUBLE), CAST(l_quantity AS DOUBLE), ROUND(l_discount * 100), CAST(l_linenumber AS DOUBLE)] AS x FROM lineitem),
       c1 AS (SELECT f, x[f] AS v, SUM(CAST(g AS DOUBLE)) AS g, CAST(COUNT(*) AS DOUBLE) / 4 AS h FROM t, (VALUES (1), (2), (3), (4)) AS k(f) GROUP BY ALL),
       w1 AS (SELECT f, v, SUM(g) OVER o AS lg, SUM(h) OVER o AS lh, SUM(g) OVER (PARTITION BY f) AS g, SUM(h) OVER (PARTITION BY f) AS h
              FROM c1 WINDOW o AS (PARTITION BY f ORDER BY v)),
       b1 AS (SELECT *, lg * lg / (lh + 1) + (g - lg) * (g - lg) / (h - lh + 1) - g * g / (h + 1) AS gain FROM w1
              WHERE lh >= 1 AND h - lh >= 1 ORDER BY gain DESC, f, v LIMIT 1),
       t2 AS (SELECT t.g, t.x, CASE WHEN t.x[b1.f] <= b1.v THEN 'L' ELSE 'R' END AS path FROM t, b1),
       c2 AS (SELECT path, f, x[f] AS v, SUM(CAST(g AS DOUBLE)) AS g, CAST(COUNT(*) AS DOUBLE) / 4 AS h FROM t2, (VALUES (1), (2), (3), (4)) AS k(f) GROUP BY ALL),
       w2 AS (SELECT path, f, v, SUM(g) OVER o AS lg, SUM(h) OVER o AS lh, SUM(g) OVER (PARTITION BY path, f) AS g, SUM(h) OVER (PARTITION BY path, f) AS h
              FROM c2 WINDOW o AS (PARTITION BY path, f ORDER BY v)),
       s2 AS (SELECT *, lg * lg / (lh + 1) + (g - lg) * (g - lg) / (h - lh + 1) - g * g / (h + 1) AS gain FROM w2 WHERE lh >= 1 AND h - lh >= 1),
       b2 AS (SELECT * FROM s2 WHERE gain >= 1e-9 QUALIFY ROW_NUMBER() OVER (PARTITION BY path ORDER BY gain DESC, f, v) = 1),
       sides AS (SELECT path, SUM(CAST(g AS DOUBLE)) AS g, CAST(COUNT(*) AS DOUBLE) / 4 AS h FROM t2 GROUP BY 1),
       nodes AS (
         SELECT '' AS path, g, h, f, v, gain FROM b1 UNION ALL
         SELECT s.path, s.g, s.h, b2.f, b2.v, b2.gain FROM sides s LEFT JOIN b2 USING (path) UNION ALL
         SELECT path || 'L', lg, lh, NULL, NULL, NULL FROM b2 UNION ALL
         SELECT path || 'R', g - lg, h - lh, NULL, NULL, NULL FROM b2)
       SELECT path, ['ship_year', 'quantity', 'discount', 'line'][f] AS feature, v AS threshold, ROUND(gain, 5) AS gain,
              ROUND(h, 5) AS cover, ROUND(-g / (h + 1), 6) AS value FROM nodes"""
)
def boosted_first_tree(spark, sf_dir):
    """The first boosted tree of two levels over all line items: splits, gains, curvatures and leaf values."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("ship_year"), F.col("l_quantity").alias("quantity"), F.round(F.col("l_discount") * 100).alias("discount"),
        F.col("l_linenumber").alias("line"), (F.col("l_returnflag") == "N").cast("int").alias("label"), F.lit(1.0).alias("weight"),
    )
    vector = VectorAssembler(inputCols=FIRST_TREE, outputCol="features")
    model = boosting.BoostedTrees(n_estimators=1, max_depth=2, learning_rate=1.0).fit(vector.transform(rows))
    nodes = boosting.paths(spark, model, FIRST_TREE).drop("tree")
    return nodes.select("path", "feature", "threshold", F.round("gain", 5).alias("gain"), F.round("cover", 5).alias("cover"), F.round("value", 6).alias("value"))


@query()
def cv_table(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir)
    scores = train.search(rows, "logistic_regression", TEXT_FEATURES, ["doc_id"], k=5)
    return train.search_table(scores)


@query()
def random_search(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir)
    _, table_ = train.tune(
        rows, "random_forest", TEXT_FEATURES, ["doc_id"], n_iter=2, k=3,
        grid={**train.GRIDS["random_forest"], "n_estimators": [20, 50], "max_depth": [5, 10]},
    )
    return table_


@query()
def retrain_models(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir)
    result = jobs.retrain(
        rows, ["doc_id"], label="label", inputs=TEXT_FEATURES,
        models=("logistic_regression", "random_forest"), tune=False,
    )
    return result["summary"]


@query()
def loan_model_metrics(spark, sf_dir):
    """Clean, label, split by date, derive, fit and evaluate on loan rows."""
    spec = LoanSpec(labels=LABELS)
    result = jobs.train_from_raw(
        loans(spark, sf_dir), spec, "full", models=("logistic_regression",), tune=False
    )
    return result["metrics"]


@query(
    """SELECT 'labelled' AS kind, COUNT(*) AS "rows" FROM orders WHERE o_orderstatus IN ('F', 'P') UNION ALL
       SELECT 'used', COUNT(*) FROM orders WHERE o_orderstatus IN ('F', 'P')"""
)
def retrain_row_counts(spark, sf_dir):
    """Every labelled row is fitted on or scored, NULL features or not."""
    rows = loans(spark, sf_dir)
    spec = LoanSpec(labels=LABELS)
    result = jobs.train_from_raw(rows, spec, "full", models=("logistic_regression",), tune=False)
    trained = result["filled"].filter("split = 'train'").agg(F.sum("rows").alias("n"))
    used = trained.unionAll(result["scored"].agg(F.count("*"))).agg(F.sum("n").alias("rows"))
    labelled = split.map_labels(rows, spec.target, LABELS).agg(F.count("*").alias("rows"))
    kind = lambda name, df: df.select(F.lit(name).alias("kind"), "rows")
    return kind("labelled", labelled).unionAll(kind("used", used))


@query()
def scored_applications(spark, sf_dir):
    """Rows rejected by rule or for a NULL feature, and scored rows by class."""
    # The medians, the fit and the scores read the rows; their joins are done once.
    rows = tables.cut_lineage(loans(spark, sf_dir))
    inputs = ["loan_amnt", "int_rate", "dti", "annual_inc", "fico_midpoint", "issue_month"]
    labelled = features.engineer_features(split.map_labels(rows, "loan_status", LABELS))
    fill = train.medians(labelled, inputs)
    model = train.fit(labelled, "logistic_regression", inputs, "target", key=["id"], fill=fill)
    rules = [r for r in score.application_rules() if r.name in {*inputs, "fico_range_low", "fico_range_high"}]
    scored, rejected = jobs.score_applications(rows, model, rules, ["id"])
    outcome = scored.select(F.col("prediction").cast("string").alias("outcome")).unionByName(
        rejected.select(F.explode("violations").alias("outcome"))
    )
    return outcome.groupBy("outcome").agg(F.count("*").alias("rows"))


@query()
def permutation_attribution(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir)
    train_rows = rows.filter("split = 'train'")
    model = train.fit(train_rows, "random_forest", TEXT_FEATURES, params={"n_estimators": 20, "max_depth": 5})
    return explain.permutation_attribution(
        model, rows.filter("split = 'test'"), train_rows.select(*TEXT_FEATURES), ["doc_id"], permutations=4
    )


@query(
    """SELECT m.model, d.feature, COUNT(*) AS "rows", CAST(0 AS DOUBLE) AS gap
       FROM labels JOIN documents USING (doc_id), (VALUES ('gradient_boosting'), ('random_forest')) AS m(model),
            (VALUES ('chars'), ('words'), ('lines'), ('digits'), ('capitals'), ('repeats'), ('blank_share')) AS d(feature) GROUP BY ALL"""
)
def tree_attribution_sums(spark, sf_dir):
    """Tree attributions of all labelled rows: their parts add up to what the model itself scores."""
    rows = labelled_documents(spark, sf_dir)
    out = None
    for name in ("random_forest", "gradient_boosting"):
        model = train.fit(rows.filter("split = 'train'"), name, TEXT_FEATURES)
        # Two sums read the attributions, which cost more than all else here.
        shares = tables.cut_lineage(attribution.tree_attribution(model, rows, ["doc_id"]))
        p = F.col("probability")
        scored = score.score(rows, model, ["doc_id"]).select("doc_id", (F.log(p) - F.log(1 - p) if name == "gradient_boosting" else p).alias("own"))
        sums = shares.groupBy("doc_id").agg((F.sum("phi") + F.max("base")).alias("total"))
        far = sums.join(scored, "doc_id").agg(F.round(F.max(F.abs(F.col("total") - F.col("own"))), 6).alias("gap"))
        part = shares.groupBy(F.lit(name).alias("model"), "feature").agg(F.count("*").alias("rows")).crossJoin(far)
        out = part if out is None else out.unionByName(part)
    return out


@query()
def tree_attribution(spark, sf_dir):
    """Mean absolute tree attribution of each feature over all rows outside the training split."""
    rows = labelled_documents(spark, sf_dir)
    model = train.fit(rows.filter("split = 'train'"), "random_forest", TEXT_FEATURES)
    return explain.importance(attribution.tree_attribution(model, rows.filter("split = 'test'"), ["doc_id"]))


@query()
def coalition_attribution(spark, sf_dir):
    """Model-agnostic attribution of a forest: its sampled default rows, all coalitions."""
    rows = labelled_documents(spark, sf_dir)
    train_rows = rows.filter("split = 'train'")
    model = train.fit(train_rows, "random_forest", TEXT_FEATURES)
    return explain.explain(model, train_rows, rows.filter("split = 'test'"), ["doc_id"], method="coalitions")


@query()
def explain_models(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir)
    train_rows = rows.filter("split = 'train'")
    models = {name: train.fit(train_rows, name, TEXT_FEATURES) for name in train.MODELS}
    shares = explain.explain_all(models, train_rows, rows.filter("split = 'test'"), ["doc_id"])
    return explain.top_features(explain.importance(shares, by=["model"]))


@query()
def saved_model_scores(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir)
    model = train.fit(rows.filter("split = 'train'"), "logistic_regression", TEXT_FEATURES)
    path = tables.scratch_path(spark, "model")
    tables.save_model(model, path)
    loaded = tables.load_model(path)
    aligned = score.align(rows, tables.model_features(loaded), keep=["doc_id"])
    return score.predict(aligned.filter(F.size("null_features") == 0), loaded, ["doc_id"])


@query()
def stream_scores(spark, sf_dir):
    """Score the events stream with a model of large values, count by day."""
    events = table(spark, sf_dir, "events")
    known = events.select(
        (F.col("event_type") == "purchase").cast("int").alias("label"),
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )
    model = train.fit(known, "logistic_regression", ["value", "k"])
    stream = streams.stream_table(spark, f"{sf_dir}/events.parquet").withColumn(
        "k", F.get_json_object("props", "$.k").cast("double")
    )
    scored = streams.score_stream(stream, model, ["value", "k"], ["event_id", "ts"])
    written = streams.run_available(scored, tables.scratch_path(spark, "scores"), mode="append")
    return monitor.prediction_counts(written.withColumn("day", F.to_date("ts")), ["day"])


@query(
    """WITH t AS (SELECT *, CASE o_orderstatus WHEN 'P' THEN 1 ELSE 0 END AS y FROM orders WHERE o_orderstatus IN ('F', 'P')),
       k AS (SELECT o_totalprice AS v, SUM(y) AS p, SUM(1 - y) AS n FROM t GROUP BY 1),
       w AS (SELECT p, n, SUM(p) OVER (ORDER BY v DESC) AS tp, SUM(p) OVER () AS pp, SUM(n) OVER () AS nn FROM k)
       SELECT ROUND(SUM(CAST(n AS DOUBLE) * (tp - p) + CAST(n AS DOUBLE) * p / 2) / MAX(CAST(pp AS DOUBLE) * nn), 6) AS roc_auc FROM w"""
)
def single_feature_auc(spark, sf_dir):
    labelled = split.map_labels(table(spark, sf_dir, "orders"), "o_orderstatus", LABELS)
    found = evaluate.ranking_metrics(labelled, "target", "o_totalprice").select("roc_auc")
    return rounded(found, ["roc_auc"])
