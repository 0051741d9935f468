"""Metrics, comparisons and importance tables over scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkrisk.catalog import base
from linkrisk.catalog.base import MODEL_NAMES, SCORED, query
from linkrisk.operators import metrics

CONFUSION = """cm AS (SELECT model, split, count(*) FILTER (label = 0 AND prediction = 0) AS tn,
  count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn,
  count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM scored GROUP BY model, split)"""
METRICS = f"""{CONFUSION}, bm AS (SELECT model, split, (tp + tn) / (tn + fp + fn + tp) AS accuracy,
  coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM cm)"""
AUC = """by_score AS (SELECT model, split, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
  FROM scored GROUP BY model, split, score),
auc AS (SELECT model, split, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS roc_auc FROM (
  SELECT *, sum(neg) OVER (PARTITION BY model, split ORDER BY score) - neg AS below FROM by_score) GROUP BY model, split)"""
FOLDS = """folds AS (SELECT model, doc_id % 5 AS fold, avg(CAST(label = prediction AS INTEGER)) AS accuracy
  FROM scored WHERE split = 'train' GROUP BY 1, 2)"""
COMPARED = f"""{SCORED}, {METRICS}, {AUC}, {FOLDS},
cv AS (SELECT model, avg(accuracy) AS cv_mean, stddev_pop(accuracy) AS cv_std FROM folds GROUP BY model),
compared AS (SELECT v.model, t.accuracy AS train_accuracy, v.accuracy AS val_accuracy, v.precision, v.recall, v.f1,
  a.roc_auc, cv.cv_mean, cv.cv_std, t.accuracy - v.accuracy AS overfit,
  CASE WHEN t.accuracy - v.accuracy > 0.1 THEN 'red' WHEN t.accuracy - v.accuracy > 0.05 THEN 'orange' ELSE 'green' END AS overfit_band
  FROM bm v JOIN bm t ON t.model = v.model AND t.split = 'train' JOIN auc a ON a.model = v.model AND a.split = 'val'
  JOIN cv ON cv.model = v.model WHERE v.split = 'val')"""


def _sql_round(columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns.split())


@query("confusion_matrix", f"WITH {SCORED}, {CONFUSION} SELECT * FROM cm")
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(base.scored_rows(spark, sf))


@query("binary_metrics", f"WITH {SCORED}, {METRICS} SELECT model, split, {_sql_round('accuracy precision recall f1')} FROM bm")
def binary_metrics(spark, sf):
    return base.rounded(metrics.binary_metrics(base.scored_rows(spark, sf)), "accuracy", "precision", "recall", "f1")


@query("roc_auc", f"WITH {SCORED}, {AUC} SELECT model, split, round(roc_auc, 6) AS roc_auc FROM auc")
def roc_auc(spark, sf):
    return base.rounded(metrics.roc_auc(base.scored_rows(spark, sf)), "roc_auc")


@query("roc_auc_lines", """WITH by_score AS (SELECT l_extendedprice AS score, count(*) FILTER (l_returnflag = 'R') AS pos,
  count(*) FILTER (l_returnflag <> 'R') AS neg FROM lineitem GROUP BY 1)
SELECT round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 6) AS roc_auc, 'price' AS model
FROM (SELECT *, sum(neg) OVER (ORDER BY score) - neg AS below FROM by_score)""")
def roc_auc_lines(spark, sf):
    lines = base.table(spark, sf, "lineitem").select(
        F.lit("price").alias("model"), (F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_extendedprice").alias("score")
    )
    return base.rounded(metrics.roc_auc(lines, ["model"]), "roc_auc")


def _report_row(name: str, hit: str, false_hit: str, miss: str) -> str:
    return f"""SELECT model, split, '{name}' AS name, coalesce({hit} / nullif({hit} + {false_hit}, 0), 0) AS precision,
      coalesce({hit} / nullif({hit} + {miss}, 0), 0) AS recall,
      coalesce(2 * {hit} / nullif(2 * {hit} + {false_hit} + {miss}, 0), 0) AS f1, {hit} + {miss} AS support FROM cm"""


@query("classification_report", f"""WITH {SCORED}, {METRICS},
classes AS ({_report_row('Legitimate', 'tn', 'fn', 'fp')} UNION ALL {_report_row('Phishing', 'tp', 'fp', 'fn')}),
rows AS (SELECT * FROM classes
  UNION ALL SELECT b.model, b.split, 'accuracy', accuracy, accuracy, accuracy, tn + fp + fn + tp
    FROM bm b JOIN cm ON cm.model = b.model AND cm.split = b.split
  UNION ALL SELECT model, split, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM classes GROUP BY model, split
  UNION ALL SELECT model, split, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM classes GROUP BY model, split)
SELECT model, split, name, {_sql_round('precision recall f1')}, CAST(support AS BIGINT) AS support FROM rows""")
def classification_report(spark, sf):
    return base.rounded(metrics.classification_report(base.scored_rows(spark, sf)), "precision", "recall", "f1")


def _folds(spark, sf):
    train = base.scored_rows(spark, sf).where(F.col("split") == "train")
    return metrics.fold_accuracy(train.withColumn("fold", F.col("doc_id") % 5))


def _compared(spark, sf):
    scored = base.scored_rows(spark, sf)
    return metrics.compare_models(scored, _folds(spark, sf))


_COMPARED = "train_accuracy val_accuracy precision recall f1 roc_auc cv_mean cv_std overfit"


@query("cv_mean_std", f"WITH {COMPARED} SELECT model, {_sql_round('cv_mean cv_std')} FROM cv")
def cv_mean_std(spark, sf):
    return base.rounded(metrics.cv_mean_std(_folds(spark, sf)), "cv_mean", "cv_std")


@query("compare_models", f"WITH {COMPARED} SELECT model, {_sql_round(_COMPARED)}, overfit_band FROM compared")
def compare_models(spark, sf):
    return base.rounded(_compared(spark, sf), *_COMPARED.split())


@query("overfit_band", f"WITH {COMPARED} SELECT model, overfit_band FROM compared")
def overfit_band(spark, sf):
    return _compared(spark, sf).select("model", "overfit_band")


@query("rank_models", f"""WITH {COMPARED} SELECT model, round(val_accuracy, 6) AS val_accuracy,
  row_number() OVER (ORDER BY val_accuracy DESC NULLS LAST, model) AS place FROM compared""")
def rank_models(spark, sf):
    ranked = metrics.rank_models(_compared(spark, sf)).select("model", "val_accuracy")
    from linkrisk.functions.ordering import number_rows

    order = [F.col("val_accuracy").desc_nulls_last(), F.col("model")]
    return base.rounded(number_rows(ranked, order, "place", 1), "val_accuracy")


@query("top_3_models", f"""WITH {COMPARED} SELECT model, round(val_accuracy, 6) AS val_accuracy FROM compared
ORDER BY compared.val_accuracy DESC, model LIMIT 3""")
def top_3_models(spark, sf):
    return base.rounded(metrics.top_models(_compared(spark, sf), 3), "val_accuracy")


@query("best_model", f"""WITH {COMPARED} SELECT model, round(f1, 6) AS f1 FROM compared ORDER BY compared.f1 DESC, model LIMIT 1""")
def best_model(spark, sf):
    return base.rounded(metrics.best_model(_compared(spark, sf), "f1").select("model", "f1"), "f1")


# Settings of an imagined search: one decision threshold per setting, evaluated on five folds.
CV_RESULTS = f"""{SCORED}, results AS (
  SELECT params, avg(accuracy) AS mean_test_score, stddev_pop(accuracy) AS std_test_score FROM (
    SELECT model || '@' || t AS params, doc_id % 5 AS fold, avg(CAST(label = CAST(score >= t / 10.0 AS INTEGER) AS INTEGER)) AS accuracy
    FROM scored, (VALUES (1), (3), (5), (7)) AS g(t) GROUP BY 1, 2) GROUP BY params)"""


def _cv_results(spark, sf):
    scored = base.scored_rows(spark, sf).withColumn("t", F.explode(F.array(*[F.lit(t) for t in (1, 3, 5, 7)])))
    tried = scored.select(
        F.concat("model", F.lit("@"), F.col("t").cast("string")).alias("params"),
        (F.col("doc_id") % 5).alias("fold"),
        "label",
        (F.col("score") >= F.col("t") / F.lit(10.0)).cast("int").alias("prediction"),
    )
    folds = metrics.fold_accuracy(tried, ["params", "fold"])
    return folds.groupBy("params").agg(
        F.avg("accuracy").alias("mean_test_score"), F.stddev_pop("accuracy").alias("std_test_score")
    )


@query("cv_rank", f"""WITH {CV_RESULTS} SELECT params, round(mean_test_score, 6) AS mean_test_score,
  rank() OVER (ORDER BY round(results.mean_test_score, 9) DESC) AS rank FROM results""")
def cv_rank(spark, sf):
    results = base.rounded(_cv_results(spark, sf), "mean_test_score", digits=9)
    ranked = metrics.cv_rank(results).select("params", "mean_test_score", F.col("rank").cast("bigint").alias("rank"))
    return base.rounded(ranked, "mean_test_score")


@query("top_5_params", f"""WITH {CV_RESULTS}, ranked AS (SELECT *, rank() OVER (ORDER BY round(mean_test_score, 9) DESC) AS rank FROM results)
SELECT params, round(mean_test_score, 6) AS mean_test_score, round(std_test_score, 6) AS std_test_score, rank
FROM ranked ORDER BY rank, params LIMIT 5""")
def top_5_params(spark, sf):
    results = base.rounded(_cv_results(spark, sf), "mean_test_score", digits=9)
    ranked = metrics.cv_rank(results).withColumn("rank", F.col("rank").cast("bigint"))
    return base.rounded(metrics.top_params(ranked, 5), "mean_test_score", "std_test_score")


# Importances: the share of a model's absolute score mass per language of the documents.
LANGS = ["de", "en", "es", "fr"]
IMPORTANCE = f"""{SCORED}, wide AS (
  SELECT model, CASE WHEN model = 'm1' THEN 'Tree-based' ELSE 'Coefficient-based' END AS kind,
    {", ".join(f"round(sum(score) FILTER (lang = '{g}') / sum(score), 9) AS {g}" for g in LANGS)}
  FROM scored JOIN (SELECT doc_id, lang FROM documents) USING (doc_id) GROUP BY model),
long AS (SELECT model, kind, feature, importance FROM wide UNPIVOT (importance FOR feature IN ({", ".join(LANGS)})))"""


def _importances(spark, sf):
    docs = base.table(spark, sf, "documents").select("doc_id", "lang")
    scored = base.scored_rows(spark, sf).join(docs, "doc_id")
    share = [
        F.round(F.sum(F.when(F.col("lang") == g, F.col("score"))) / F.sum("score"), 9).alias(g) for g in LANGS
    ]
    wide = scored.groupBy("model").agg(*share)
    wide = wide.withColumn("kind", F.when(F.col("model") == "m1", "Tree-based").otherwise("Coefficient-based"))
    return metrics.importance_long(wide, LANGS).where(F.col("importance").isNotNull())


@query("importance_long", f"WITH {IMPORTANCE} SELECT model, kind, feature, round(importance, 6) AS importance FROM long")
def importance_long(spark, sf):
    return base.rounded(_importances(spark, sf), "importance")


@query("importance_summary", f"""WITH {IMPORTANCE} SELECT feature, round(avg(importance), 6) AS mean_importance,
  round(stddev_samp(importance), 6) AS std_importance FROM long GROUP BY feature""")
def importance_summary(spark, sf):
    return base.rounded(metrics.importance_summary(_importances(spark, sf)), "mean_importance", "std_importance")


@query("importance_pivot", f"""WITH {IMPORTANCE} SELECT feature,
  {", ".join(f"round(max(importance) FILTER (model = '{m}'), 6) AS {m}" for m in MODEL_NAMES)} FROM long GROUP BY feature""")
def importance_pivot(spark, sf):
    return base.rounded(metrics.importance_pivot(_importances(spark, sf), MODEL_NAMES), *MODEL_NAMES)


@query("model_run_summary", f"""WITH {COMPARED.replace("ELSE 'val' END AS split", "WHEN md5('42:' || l.doc_id) < 'e' THEN 'val' ELSE 'test' END AS split")}
SELECT {", ".join(f"round(t.{m}, 6) AS test_{m}" for m in ("accuracy", "precision", "recall", "f1"))}, round(a.roc_auc, 6) AS test_roc_auc,
  round(v.accuracy, 6) AS val_accuracy, round(v.f1, 6) AS val_f1,
  (SELECT round(max(cv_mean), 6) FROM cv WHERE model = 'm2') AS best_cv_score, 8 AS n_features,
  (SELECT count(*) FROM scored WHERE model = 'm2' AND split <> 'test') AS n_train,
  (SELECT count(*) FROM scored WHERE model = 'm2' AND split = 'test') AS n_test
FROM bm t JOIN bm v ON v.model = t.model AND v.split = 'val' JOIN auc a ON a.model = t.model AND a.split = 'test'
WHERE t.model = 'm2' AND t.split = 'test'""")
def model_run_summary(spark, sf):
    scored = base.scored_rows(spark, sf).where(F.col("model") == "m2")
    digest = F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string")))
    split = F.when(digest < "c", "train").when(digest < "e", "val").otherwise("test")
    scored = scored.withColumn("split", split)
    train = scored.where(F.col("split") == "train").withColumn("fold", F.col("doc_id") % 5)
    best = metrics.cv_mean_std(metrics.fold_accuracy(train)).agg(F.max("cv_mean")).scalar()
    summary = metrics.model_run_summary(metrics.evaluate(scored), scored, best, 8)
    return base.rounded(summary, *[c for c in summary.columns if not c.startswith("n_")])
