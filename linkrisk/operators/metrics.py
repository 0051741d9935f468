"""Classification metrics, model comparison and importance tables.

All functions work on scored rows (groups..., label, prediction, score), so one
aggregation covers any number of models and splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from linkrisk import schemas
from linkrisk.functions.ordering import running_totals
from linkrisk.functions.outcomes import overfit_band
from linkrisk.session import cut_lineage


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def confusion_matrix(scored: DataFrame, by: Sequence[str] = ("model", "split")) -> DataFrame:
    """tn, fp, fn, tp per group."""
    def cell(actual: int, predicted: int) -> Column:
        return F.count_if((F.col("label") == actual) & (F.col("prediction") == predicted))

    return scored.groupBy(*by).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def binary_metrics(scored: DataFrame, by: Sequence[str] = ("model", "split")) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; 0 where a ratio is undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return confusion_matrix(scored, by).select(
        *by,
        _ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def roc_auc(scored: DataFrame, by: Sequence[str] = ("model", "split")) -> DataFrame:
    """Exact rank AUC with half credit for ties.

    Rows without a label or a score count neither way. Rows are counted per distinct score first; negatives below a score come from
    running totals over score bins, so no task sorts all rows of a model.
    """
    usable = F.col("score").isNotNull()
    positive, negative = (F.count_if(usable & c) for c in (F.col("label") == 1, F.col("label") != 1))
    counted = scored.groupBy(*by, "score").agg(positive.alias("pos"), negative.alias("neg"))
    running = running_totals(cut_lineage(counted), by, "score", ["neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    sums = running.groupBy(*by).agg(wins.alias("wins"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return sums.select(*by, F.try_divide(F.col("wins"), (F.col("p") * F.col("n")).cast("double")).alias("roc_auc"))


def evaluate(scored: DataFrame, by: Sequence[str] = ("model", "split")) -> DataFrame:
    """binary_metrics and roc_auc of every group."""
    return binary_metrics(scored, by).join(roc_auc(scored, by), list(by))


def classification_report(scored: DataFrame, by: Sequence[str] = ("model", "split")) -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy, macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def entry(name: str, hit: Column, false_hit: Column, miss: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            _ratio(hit, hit + false_hit).alias("precision"),
            _ratio(hit, hit + miss).alias("recall"),
            _ratio(2 * hit, 2 * hit + false_hit + miss).alias("f1"),
            (hit + miss).alias("support"),
        )

    def average(name: str, pick) -> Column:
        both = F.col("c0")["support"] + F.col("c1")["support"]
        return F.struct(
            F.lit(name).alias("name"), *[pick(m, both).alias(m) for m in ("precision", "recall", "f1")], both.alias("support")
        )

    def macro(metric: str, both: Column) -> Column:
        return (F.col("c0")[metric] + F.col("c1")[metric]) / 2

    def weighted(metric: str, both: Column) -> Column:
        parts = [F.col(c)[metric] * F.col(c)["support"] for c in ("c0", "c1")]
        return _ratio(parts[0] + parts[1], both)

    accuracy = _ratio(tp + tn, tn + fp + fn + tp)
    classes = confusion_matrix(scored, by).select(
        *by,
        entry(schemas.REPORT_NAMES[0], tn, fn, fp).alias("c0"),
        entry(schemas.REPORT_NAMES[1], tp, fp, fn).alias("c1"),
        accuracy.alias("_acc"),
    )
    rows = F.array(
        F.col("c0"),
        F.col("c1"),
        average("accuracy", lambda metric, both: F.col("_acc")),
        average("macro avg", macro),
        average("weighted avg", weighted),
    )
    return classes.select(*by, F.inline(rows))


def cv_mean_std(folds: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and population deviation of fold accuracies."""
    return folds.groupBy(*by).agg(F.avg("accuracy").alias("cv_mean"), F.stddev_pop("accuracy").alias("cv_std"))


def fold_accuracy(scored: DataFrame, by: Sequence[str] = ("model", "fold")) -> DataFrame:
    """Accuracy of every model on every fold of out-of-fold predictions."""
    hit = (F.col("label") == F.col("prediction")).cast("double")
    return scored.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def compare_models(scored: DataFrame, folds: DataFrame | None = None) -> DataFrame:
    """One row per model: train accuracy, validation metrics, CV mean and deviation, over-fit."""
    metrics = evaluate(scored.where(F.col("split").isin("train", "val")))
    val = metrics.where(F.col("split") == "val").withColumnRenamed("accuracy", "val_accuracy").drop("split")
    train = metrics.where(F.col("split") == "train").select("model", F.col("accuracy").alias("train_accuracy"))
    table = train.join(val, "model").withColumn("overfit", F.col("train_accuracy") - F.col("val_accuracy"))
    table = table.withColumn("overfit_band", overfit_band(F.col("overfit")))
    return table if folds is None else table.join(cv_mean_std(folds), "model", "left")


def rank_models(table: DataFrame, metric: str = "val_accuracy") -> DataFrame:
    """Models by a metric, best first; ties in order of their name."""
    return table.orderBy(F.col(metric).desc_nulls_last(), "model")


def top_models(table: DataFrame, n: int = 3, metric: str = "val_accuracy") -> DataFrame:
    return rank_models(table, metric).select("model", metric).limit(n)


def best_model(table: DataFrame, metric: str = "val_accuracy") -> DataFrame:
    return rank_models(table, metric).limit(1)


def cv_rank(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rank of every parameter setting by mean test score, 1 = best."""
    groups = [F.col(c) for c in by] or [F.lit(0)]
    return results.withColumn("rank", F.rank().over(Window.partitionBy(*groups).orderBy(F.col("mean_test_score").desc())))


def top_params(results: DataFrame, n: int = 5) -> DataFrame:
    """The n best-ranked settings; ties in order of the setting's text."""
    return results.orderBy("rank", "params").limit(n)


def importance_long(wide: DataFrame, features: Sequence[str], kind: str = "kind") -> DataFrame:
    """One row per model and feature from one column per feature."""
    return wide.unpivot(["model", kind], list(features), "feature", "importance")


def importance_summary(long: DataFrame) -> DataFrame:
    """Mean and sample deviation over the models, greatest mean first."""
    summary = long.groupBy("feature").agg(
        F.avg("importance").alias("mean_importance"), F.stddev_samp("importance").alias("std_importance")
    )
    return summary.orderBy(F.col("mean_importance").desc(), "feature")


def importance_pivot(long: DataFrame, models: Sequence[str]) -> DataFrame:
    """Features in rows, models in columns."""
    return long.groupBy("feature").pivot("model", list(models)).agg(F.first("importance", ignorenulls=True))


def model_run_summary(metrics: DataFrame, split: DataFrame, best_cv_score: Column, n_features: int) -> DataFrame:
    """One row of numbers about a finished training run."""
    test = metrics.where(F.col("split") == "test").select(
        *[F.col(m).alias(f"test_{m}") for m in ("accuracy", "precision", "recall", "f1", "roc_auc")]
    )
    val = metrics.where(F.col("split") == "val").agg(
        F.struct(F.first("accuracy").alias("accuracy"), F.first("f1").alias("f1"))
    ).scalar()
    sizes = split.agg(
        F.struct(
            F.count_if(F.col("split").isin("train", "val")).alias("train"), F.count_if(F.col("split") == "test").alias("test")
        )
    ).scalar()
    return test.select(
        "*",
        val.getField("accuracy").alias("val_accuracy"),
        val.getField("f1").alias("val_f1"),
        best_cv_score.alias("best_cv_score"),
        F.lit(n_features).alias("n_features"),
        sizes.getField("train").alias("n_train"),
        sizes.getField("test").alias("n_test"),
    )
