"""Evaluation and attribution queries."""

from pyspark.sql import functions as F

from vintage.catalogue.base import LOANS_SQL, SCORED_SQL, loans, query, rounded, scored_documents
from vintage.operators import evaluate, explain
from vintage.sources import tables

_RANKED = """
k AS (SELECT model, probability AS score, SUM(label) AS p, SUM(1 - label) AS n FROM s GROUP BY 1, 2),
w AS (SELECT model, score, p, n,
             SUM(p) OVER (PARTITION BY model ORDER BY score DESC) AS tp,
             SUM(n) OVER (PARTITION BY model ORDER BY score DESC) AS fp,
             SUM(p) OVER (PARTITION BY model) AS pp, SUM(n) OVER (PARTITION BY model) AS nn FROM k),
areas AS (SELECT model,
             SUM(CAST(n AS DOUBLE) * (tp - p) + CAST(n AS DOUBLE) * p / 2) / MAX(CAST(pp AS DOUBLE) * nn) AS roc_auc,
             SUM((CAST(p AS DOUBLE) / pp) * (CAST(tp AS DOUBLE) / (tp + fp))) AS average_precision
          FROM w GROUP BY model)"""


def _counts(by):
    return f"""
cm AS (SELECT {by}, COUNT(*) FILTER (label = 0 AND prediction = 0) AS tn, COUNT(*) FILTER (label = 0 AND prediction = 1) AS fp,
              COUNT(*) FILTER (label = 1 AND prediction = 0) AS fn, COUNT(*) FILTER (label = 1 AND prediction = 1) AS tp
       FROM s GROUP BY {by})"""


def _share(num, den, name):
    return f"ROUND(COALESCE(CAST({num} AS DOUBLE) / NULLIF({den}, 0), 0), 6) AS {name}"


_RATES = ", ".join(
    [
        _share("tp", "tp + fp", "precision"),
        _share("tp", "tp + fn", "recall"),
        _share("2 * tp", "2 * tp + fp + fn", "f1_score"),
        _share("tp", "tp + fn", "true_positive_rate"),
        _share("fp", "fp + tn", "false_positive_rate"),
        _share("tn", "tn + fp", "true_negative_rate"),
        _share("fn", "fn + tp", "false_negative_rate"),
    ]
)


@query(f"WITH {SCORED_SQL}, {_counts('model')} SELECT * FROM cm")
def confusion(spark, sf_dir):
    return evaluate.confusion(scored_documents(spark, sf_dir), by=["model"])


@query(f"WITH {SCORED_SQL}, {_counts('model')} SELECT cm.*, {_RATES} FROM cm")
def threshold_rates(spark, sf_dir):
    return rounded(evaluate.threshold_metrics(scored_documents(spark, sf_dir), by=["model"]), evaluate.RATES)


_ONE = """SELECT model, CAST({c} AS VARCHAR) AS class,
    COALESCE(CAST({h} AS DOUBLE) / NULLIF({h} + {fa}, 0), 0) AS p,
    COALESCE(CAST({h} AS DOUBLE) / NULLIF({h} + {ms}, 0), 0) AS r,
    COALESCE(CAST(2 * {h} AS DOUBLE) / NULLIF(2 * {h} + {fa} + {ms}, 0), 0) AS f, {h} + {ms} AS s FROM cm"""
_CLASSES = " UNION ALL ".join(
    [_ONE.format(c=0, h="tn", fa="fn", ms="fp"), _ONE.format(c=1, h="tp", fa="fp", ms="fn")]
)


@query(
    f"""WITH {SCORED_SQL}, {_counts('model')}, pc AS ({_CLASSES}),
    acc AS (SELECT model, CAST(tn + tp AS DOUBLE) / (tn + fp + fn + tp) AS a, tn + fp + fn + tp AS t FROM cm),
    a AS (SELECT * FROM pc
      UNION ALL SELECT model, 'accuracy', a, a, a, t FROM acc
      UNION ALL SELECT model, 'macro avg', AVG(p), AVG(r), AVG(f), SUM(s) FROM pc GROUP BY model
      UNION ALL SELECT model, 'weighted avg', SUM(p * s) / SUM(s), SUM(r * s) / SUM(s), SUM(f * s) / SUM(s), SUM(s) FROM pc GROUP BY model)
    SELECT model, class, ROUND(p, 6) AS precision, ROUND(r, 6) AS recall, ROUND(f, 6) AS f1_score,
           CAST(s AS BIGINT) AS support FROM a"""
)
def classification_report(spark, sf_dir):
    found = evaluate.classification_report(scored_documents(spark, sf_dir), by=["model"])
    return rounded(found, ["precision", "recall", "f1_score"])


@query(
    f"""WITH {SCORED_SQL}, {_RANKED}
        SELECT model, ROUND(roc_auc, 6) AS roc_auc, ROUND(average_precision, 6) AS average_precision FROM areas"""
)
def ranking_metrics(spark, sf_dir):
    found = evaluate.ranking_metrics(scored_documents(spark, sf_dir), by=["model"])
    return rounded(found, ["roc_auc", "average_precision"])


@query(
    """WITH k AS (SELECT l_extendedprice AS score, SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS p,
                         SUM(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS n FROM lineitem GROUP BY 1),
       w AS (SELECT p, n, SUM(p) OVER (ORDER BY score DESC) AS tp, SUM(n) OVER (ORDER BY score DESC) AS fp,
                    SUM(p) OVER () AS pp, SUM(n) OVER () AS nn FROM k)
       SELECT ROUND(SUM(CAST(n AS DOUBLE) * (tp - p) + CAST(n AS DOUBLE) * p / 2) / MAX(CAST(pp AS DOUBLE) * nn), 6) AS roc_auc,
              ROUND(SUM((CAST(p AS DOUBLE) / pp) * (CAST(tp AS DOUBLE) / (tp + fp))), 6) AS average_precision FROM w"""
)
def ranking_metrics_lineitem(spark, sf_dir):
    """Nearly as many distinct scores as rows: the hard case for ordering."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_extendedprice").alias("probability")
    )
    return rounded(evaluate.ranking_metrics(items), ["roc_auc", "average_precision"])


@query(
    f"""WITH {SCORED_SQL}, {_RANKED}
        SELECT model, ROUND(CAST(fp AS DOUBLE) / nn, 6) AS fpr, ROUND(CAST(tp AS DOUBLE) / pp, 6) AS tpr,
               ROUND(score, 6) AS threshold FROM w
        UNION ALL SELECT DISTINCT model, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(2 AS DOUBLE) FROM s"""
)
def roc_curve(spark, sf_dir):
    # The origin's infinite threshold is shown as 2, beyond any probability.
    points = evaluate.roc_curve(scored_documents(spark, sf_dir), by=["model"])
    shown = points.withColumn("threshold", F.least(F.col("threshold"), F.lit(2.0)))
    return rounded(shown, ["fpr", "tpr", "threshold"])


@query(
    f"""WITH {SCORED_SQL}, {_RANKED}
        SELECT model, ROUND(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision, ROUND(CAST(tp AS DOUBLE) / pp, 6) AS recall,
               ROUND(score, 6) AS threshold FROM w
        UNION ALL SELECT DISTINCT model, CAST(1 AS DOUBLE), CAST(0 AS DOUBLE), CAST(NULL AS DOUBLE) FROM s"""
)
def pr_curve(spark, sf_dir):
    points = evaluate.pr_curve(scored_documents(spark, sf_dir), by=["model"])
    return rounded(points, ["precision", "recall", "threshold"])


_EVALUATED = f"""WITH {SCORED_SQL}, {_RANKED}, {_counts('model')},
e AS (SELECT model, ROUND(roc_auc, 6) AS roc_auc, ROUND(average_precision, 6) AS average_precision,
             tn, fp, fn, tp, {_RATES} FROM areas JOIN cm USING (model))"""
_DOUBLES = ("roc_auc", "average_precision", *evaluate.RATES)


@query(f"{_EVALUATED} SELECT * FROM e")
def evaluate_models(spark, sf_dir):
    return rounded(evaluate.evaluate(scored_documents(spark, sf_dir)), _DOUBLES)


@query(f"{_EVALUATED} SELECT * FROM e ORDER BY roc_auc DESC, model LIMIT 1")
def best_model(spark, sf_dir):
    metrics = rounded(evaluate.evaluate(scored_documents(spark, sf_dir)), _DOUBLES)
    return evaluate.best_model(metrics, "roc_auc")


@query(
    f"""{_EVALUATED} SELECT model, roc_auc, tn + fp + fn + tp AS test_size,
        model = (SELECT model FROM e ORDER BY roc_auc DESC, model LIMIT 1) AS is_best FROM e"""
)
def evaluation_summary(spark, sf_dir):
    metrics = rounded(evaluate.evaluate(scored_documents(spark, sf_dir)), _DOUBLES)
    return evaluate.evaluation_summary(metrics).select("model", "roc_auc", "test_size", "is_best")


@query(
    f"""WITH {SCORED_SQL} SELECT model, CAST(least(floor(probability * 10), 9) AS INTEGER) AS bin, COUNT(*) AS "rows",
        ROUND(AVG(probability), 6) AS mean_predicted, ROUND(AVG(CAST(label AS DOUBLE)), 6) AS actual_rate
        FROM s GROUP BY 1, 2"""
)
def calibration(spark, sf_dir):
    found = evaluate.calibration(scored_documents(spark, sf_dir), by=["model"])
    return rounded(found, ["mean_predicted", "actual_rate"])


_SEGMENTED = """
k AS (SELECT model, lang, probability AS score, SUM(label) AS p, SUM(1 - label) AS n FROM s GROUP BY 1, 2, 3),
w AS (SELECT model, lang, p, n, SUM(p) OVER (PARTITION BY model, lang ORDER BY score DESC) AS tp,
             SUM(n) OVER (PARTITION BY model, lang ORDER BY score DESC) AS fp,
             SUM(p) OVER (PARTITION BY model, lang) AS pp, SUM(n) OVER (PARTITION BY model, lang) AS nn FROM k),
areas AS (SELECT model, lang,
             SUM(CAST(n AS DOUBLE) * (tp - p) + CAST(n AS DOUBLE) * p / 2) / NULLIF(MAX(CAST(pp AS DOUBLE) * nn), 0) AS roc_auc,
             SUM((CAST(p AS DOUBLE) / NULLIF(pp, 0)) * (CAST(tp AS DOUBLE) / (tp + fp))) AS average_precision
          FROM w GROUP BY 1, 2)"""


@query(
    f"""WITH {SCORED_SQL}, {_SEGMENTED}, {_counts('model, lang')}
        SELECT model, lang, ROUND(roc_auc, 6) AS roc_auc, ROUND(average_precision, 6) AS average_precision,
               tn, fp, fn, tp, {_RATES} FROM areas JOIN cm USING (model, lang)"""
)
def segment_metrics(spark, sf_dir):
    found = evaluate.evaluate(scored_documents(spark, sf_dir), by=["model", "lang"])
    return rounded(found, _DOUBLES)


@query(
    f"""WITH {SCORED_SQL}, {_RANKED}, c AS (
          SELECT model, score, fp * CAST(5 AS DOUBLE) + (pp - tp) * CAST(1 AS DOUBLE) AS cost,
                 ROW_NUMBER() OVER (PARTITION BY model ORDER BY fp * 5 + (pp - tp), score DESC) AS k FROM w)
        SELECT model, ROUND(score, 6) AS threshold, cost FROM c WHERE k = 1"""
)
def cost_threshold(spark, sf_dir):
    found = evaluate.cost_threshold(scored_documents(spark, sf_dir), 5, 1, by=["model"])
    return rounded(found, ["threshold"])


_WEIGHTS = {
    "first": {"loan_amnt": 0.002, "int_rate": -1.5, "dti": 0.25, "annual_inc": -0.01},
    "second": {"loan_amnt": -0.001, "int_rate": 4.0, "dti": 0.5, "annual_inc": 0.02},
}


def _attributions(spark, sf_dir):
    rows = loans(spark, sf_dir).select("id", "loan_amnt", "int_rate", "dti", "annual_inc")
    rows = rows.fillna(0.0, ["int_rate", "dti"])
    # Each model reads the rows twice; their joins are done once.
    rows = tables.cut_lineage(rows)
    out = None
    for name, weights in _WEIGHTS.items():
        part = explain.linear_attribution(rows, rows, ["id"], weights).withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


_PHI_SQL = (
    f"WITH {LOANS_SQL}, v AS (SELECT id, loan_amnt, COALESCE(int_rate, 0) AS int_rate, COALESCE(dti, 0) AS dti, annual_inc FROM loans), x AS ("
    + " UNION ALL ".join(
        f"SELECT '{m}' AS model, id, '{c}' AS feature, CAST({w} AS DOUBLE) * ({c} - (SELECT AVG({c}) FROM v)) AS phi FROM v"
        for m, ws in _WEIGHTS.items()
        for c, w in ws.items()
    )
    + "), imp AS (SELECT model, feature, AVG(abs(phi)) AS mean_abs, AVG(phi) AS mean, stddev_pop(phi) AS std FROM x GROUP BY 1, 2)"
)


@query(f"{_PHI_SQL} SELECT model, id, feature, ROUND(phi, 6) + 0 AS phi FROM x")
def linear_attribution(spark, sf_dir):
    return rounded(_attributions(spark, sf_dir), ["phi"]).withColumn("phi", F.col("phi") + 0.0)


@query(
    f"""{_PHI_SQL} SELECT model, feature, ROUND(mean_abs, 4) AS mean_abs, abs(ROUND(mean, 4)) AS mean, ROUND(std, 4) AS std FROM imp"""
)
def attribution_importance(spark, sf_dir):
    found = explain.importance(_attributions(spark, sf_dir), by=["model"])
    # The mean is zero up to rounding; its sign is noise.
    return rounded(found, ["mean_abs", "mean", "std"], 4).withColumn("mean", F.abs("mean"))


@query(
    f"""{_PHI_SQL}, t AS (SELECT model, CAST(ROW_NUMBER() OVER (PARTITION BY model ORDER BY mean_abs DESC, feature) AS INTEGER) AS rank,
                                 feature, ROUND(mean_abs, 4) AS mean_abs FROM imp) SELECT * FROM t WHERE rank <= 3"""
)
def top_features(spark, sf_dir):
    ranked = explain.top_features(explain.importance(_attributions(spark, sf_dir), by=["model"]), 3)
    return rounded(ranked, ["mean_abs"], 4)


@query(
    f"""{_PHI_SQL}, o AS (SELECT model, id, feature, phi, ROW_NUMBER() OVER (PARTITION BY model, id ORDER BY abs(phi) DESC, feature) AS k FROM x)
        SELECT model, id, CAST(least(k, 3) AS INTEGER) AS rank, CASE WHEN k <= 2 THEN feature ELSE 'other' END AS feature,
               ROUND(SUM(phi), 6) + 0 AS phi FROM o GROUP BY ALL"""
)
def instance_breakdown(spark, sf_dir):
    found = explain.instance_breakdown(_attributions(spark, sf_dir), ["model", "id"], 2)
    return rounded(found, ["phi"]).withColumn("phi", F.col("phi") + 0.0)
