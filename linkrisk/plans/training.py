"""Training runs: one model, the comparison of all, and the final search.

``rows`` always holds a key, the raw features and ``label``. Splits are written
once and every fit reads them from there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from linkrisk import schemas
from linkrisk.operators import bayes, metrics, models, neighbours, splits
from linkrisk.session import cut_lineage
from linkrisk.sources.registry import save_model


@dataclass
class TrainingRun:
    """What a run leaves behind."""

    name: str
    model: PipelineModel
    metrics: DataFrame
    comparison: DataFrame | None = None
    search: DataFrame | None = None
    summary: DataFrame | None = None


def prepare_split(rows: DataFrame, key: str, balanced: bool = True, folds: int = 5, balanced_test: bool = False) -> DataFrame:
    """Rows with ``split`` and ``fold``, written once."""
    split = splits.split_data(rows, "label", key, balanced_test=balanced_test, balanced_train_val=balanced)
    return cut_lineage(splits.stratified_kfold(split, "label", key, folds))


def _evaluated(scored: DataFrame) -> DataFrame:
    return metrics.evaluate(scored, ["model", "split"])


def train_single(rows: DataFrame, key: str, name: str = models.FOREST, params: dict | None = None) -> TrainingRun:
    """One model on a stratified split: validation and test metrics."""
    split = prepare_split(rows, key, balanced=False)
    model = models.fit_model(name, split.where(F.col("split") == "train"), params)
    held_out = split.where(F.col("split").isin("val", "test"))
    scored = models.apply_model(model, held_out, key, "label", "split").withColumn("model", F.lit(name))
    return TrainingRun(name, model, _evaluated(scored))


def out_of_fold(split: DataFrame, key: str, names, overrides: dict | None, folds: int) -> DataFrame:
    """Fold accuracies of every model, each fold scored by a fit on the others."""
    train = split.where(F.col("split") == "train")
    scored = None
    for fold in range(folds):
        others, held_out = train.where(F.col("fold") != fold), train.where(F.col("fold") == fold)
        fitted = models.train_all(others, names, overrides)
        part = models.score_models(fitted, held_out, key, "label", "fold")
        part = part.unionByName(score_simple(others, held_out, key, "label", "fold"))
        scored = part if scored is None else scored.unionByName(part)
    return metrics.fold_accuracy(scored, ["model", "fold"])


MAJORITY = "Baseline (Most Frequent)"
STRATIFIED = "Baseline (Stratified)"
NEIGHBOURS = "K-Nearest Neighbors"


def score_simple(train: DataFrame, rows: DataFrame, key: str, *keep: str, k: int = 5) -> DataFrame:
    """Scored rows of the models that need no learner: two baselines and the nearest neighbours.

    The key must be a whole number.
    """
    columns = [key, *keep, "prediction", "score"]
    majority = bayes.majority_baseline(train, rows, "label").select(*columns).withColumn("model", F.lit(MAJORITY))
    drawn = bayes.stratified_baseline(train, rows, "label", key).select(*columns).withColumn("model", F.lit(STRATIFIED))
    preparation = PipelineModel(models.prep_stages(train))
    vector = F.array(*[F.col(f"{c}_scaled") for c in schemas.FEATURES]).alias("vector")
    known = preparation.transform(train).select(F.col(key).cast("bigint").alias("id"), F.col("label").cast("int").alias("label"), vector)
    asked = preparation.transform(rows).select(F.col(key).cast("bigint").alias("query_id"), vector)
    voted = neighbours.knn_classify(known, asked, k)
    share = F.when(F.col("prediction") == 1, F.col("score")).otherwise(1 - F.col("score"))
    voted = voted.select(F.col("query_id").alias(key), "prediction", share.alias("score"))
    nearest = rows.select(key, *keep).join(voted, key).select(*columns).withColumn("model", F.lit(NEIGHBOURS))
    return majority.unionByName(drawn).unionByName(nearest)


def compare_all(
    split: DataFrame, key: str, names=None, overrides: dict | None = None, folds: int = 5
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """All learners fitted on train, and the comparison table with the simple models in it."""
    train = split.where(F.col("split") == "train")
    fitted = models.train_all(train, names, overrides)
    rows = split.where(F.col("split").isin("train", "val"))
    scored = models.score_models(fitted, rows, key, "label", "split")
    scored = cut_lineage(scored.unionByName(score_simple(train, rows, key, "label", "split")))
    accuracies = out_of_fold(split, key, names, overrides, folds) if folds else None
    return fitted, cut_lineage(metrics.compare_models(scored, accuracies))


def select_model(
    rows: DataFrame, key: str, names=None, overrides: dict | None = None, grids: dict | None = None, folds: int = 5, top: int = 3
) -> TrainingRun:
    """Compare all models, tune the best three, keep the best and test its refit on train plus validation."""
    split = prepare_split(rows, key, folds=folds)
    fitted, comparison = compare_all(split, key, names, overrides, folds)
    train = split.where(F.col("split") == "train")
    ranked = metrics.top_models(comparison.where(F.col("model").isin(*fitted)), top)
    finalists = [row["model"] for row in ranked.collect()]
    tuned, searches = {}, None
    for name in finalists:
        grid = grids.get(name, {}) if grids is not None else None
        tuned[name], result = models.grid_search(name, train, folds, grid)
        searches = result if searches is None else searches.unionByName(result)
    val = split.where(F.col("split") == "val")
    scored = models.score_models(tuned, val, key, "label", "split")
    table = cut_lineage(_evaluated(scored))
    best = metrics.best_model(table, "accuracy").first()["model"]
    params = _best_params(searches, best)
    final = models.refit_train_val(best, split, params)
    tested = models.apply_model(final, split.where(F.col("split") == "test"), key, "label", "split")
    return TrainingRun(best, final, _evaluated(tested.withColumn("model", F.lit(best))), comparison, searches)


def _best_params(searches: DataFrame, name: str) -> dict | None:
    """Setting of the best mean score; ties in order of the setting's text."""
    import ast

    order = [F.col("mean_test_score").desc(), F.col("params")]
    row = searches.where(F.col("model") == name).orderBy(*order).first()
    return ast.literal_eval(row["params"]) if row else None


def train_final(
    rows: DataFrame,
    key: str,
    name: str = models.FOREST,
    folds: int = 10,
    n_iter: int = 100,
    grid: dict | None = None,
    root: str | None = None,
    registry_name: str = "url_risk_model",
    balanced_test: bool = True,
    balanced_train_val: bool = True,
) -> TrainingRun:
    """Random search, validation, refit on train plus validation, test, summary and saved model."""
    split = prepare_split(rows, key, balanced_train_val, folds, balanced_test)
    searched, results = models.random_search(name, split.where(F.col("split") == "train"), folds, n_iter, grid)
    val = models.apply_model(searched, split.where(F.col("split") == "val"), key, "label", "split")
    best = _best_params(results, name)
    final = models.refit_train_val(name, split, best)
    test = models.apply_model(final, split.where(F.col("split") == "test"), key, "label", "split")
    scored = val.unionByName(test).withColumn("model", F.lit(name))
    table = cut_lineage(_evaluated(scored))
    score = results.agg(F.max("mean_test_score")).first()[0]
    summary = metrics.model_run_summary(table, split, F.lit(score).cast("double"), len(schemas.FEATURES))
    if root:
        save_model(final, summary, root, registry_name, schemas.FEATURES, f"Best parameters: {best}")
    return TrainingRun(name, final, table, None, results, summary)
