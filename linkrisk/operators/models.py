"""Training, tuning and scoring with Spark's own distributed learners.

A scoring model is one ``PipelineModel``: a projection that imputes and scales
with the stored training statistics, an assembler, and the learner. Scoring is
therefore a narrow plan, and what was fitted is saved and loaded as one folder.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, functions as F

from linkrisk import schemas
from linkrisk.functions import outcomes, scan
from linkrisk.operators import prep
from linkrisk.operators.features import add_missing_features
from linkrisk.sources.scans import read_scan_documents

LABEL = "label"
WEIGHT = "weight"
VECTOR = "features"

LOGISTIC = "Logistic Regression"
FOREST = "Random Forest"
BOOSTING = "Gradient Boosting"
NETWORK = "Neural Network (MLP)"
SVM_RBF = "SVM (RBF)"
SVM_LINEAR = "SVM (Linear)"
BAYES = "Naive Bayes"

# Settings of the learners before tuning.
DEFAULTS = {
    LOGISTIC: {"C": 1.0, "maxIter": 1000},
    FOREST: {"numTrees": 100, "maxDepth": 10},
    BOOSTING: {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1},
    NETWORK: {"hidden": (64, 32), "maxIter": 500},
    SVM_RBF: {"C": 1.0, "gamma": "scale", "maxIter": 100},
    SVM_LINEAR: {"C": 1.0, "maxIter": 100},
    BAYES: {},
}

# The tuning grids, as far as Spark's learners have the parameter.
GRIDS = {
    LOGISTIC: {"C": [0.1, 1.0, 10.0]},
    FOREST: {"numTrees": [50, 100, 200], "maxDepth": [5, 10, 15, 30]},
    BOOSTING: {"maxIter": [50, 100, 200], "maxDepth": [3, 5, 7], "stepSize": [0.01, 0.1, 0.2]},
    NETWORK: {"hidden": [(64, 32), (128, 64), (64, 32, 16)]},
    SVM_RBF: {"C": [0.1, 1.0, 10.0], "gamma": ["scale", "auto", 0.01, 0.1]},
    SVM_LINEAR: {"C": [0.1, 1.0, 10.0]},
}

# The wide grids of the final search, likewise.
WIDE_GRIDS = {
    FOREST: {
        "numTrees": [50, 100, 200, 300],
        "maxDepth": [5, 10, 15, 20, 30],
        "minInstancesPerNode": [1, 2, 4],
        "featureSubsetStrategy": ["sqrt", "log2", "all"],
    },
    BOOSTING: {
        "maxIter": [50, 100, 200, 300],
        "maxDepth": [3, 5, 7, 9],
        "stepSize": [0.01, 0.05, 0.1, 0.2],
        "subsamplingRate": [0.8, 0.9, 1.0],
    },
    LOGISTIC: {"C": [0.01, 0.1, 1.0, 10.0, 100.0], "maxIter": [1000, 2000]},
    NETWORK: {
        "hidden": [(64,), (128,), (64, 32), (128, 64), (128, 64, 32), (256, 128, 64)],
        "maxIter": [500, 1000, 1500],
    },
}

# Fixed value: stopping tolerance of the support vector machines.
SVM_TOLERANCE = 1e-3

# Width of the random Fourier features that stand for the RBF kernel.
RBF_FEATURES = 100

# Rows that are worth a task of their own in every pass of the perceptron, and rows of one task at most.
LEAST_TASK_ROWS = 2_000
MOST_TASK_ROWS = 500_000


def prep_stages(train: DataFrame, features: Sequence[str] = schemas.FEATURES) -> list:
    """Projection and assembler with the statistics of ``train``: one row of them is read."""
    columns = list(features)
    continuous = [c for c in columns if c not in schemas.FLAGS]
    medians = prep.column_medians(train, columns)
    filled = prep.fill_nulls(train, medians, columns)
    fill = medians.first()
    scaler = prep.scaler_fit(filled, continuous).first()
    projected = []
    for c in columns:
        value = f"coalesce(double({c}), {fill[c] or 0.0!r}D)"
        if c in continuous:
            mean, std = scaler[c]["mean"] or 0.0, scaler[c]["std"] or 1.0
            value = f"({value} - {mean!r}D) / {std!r}D"
        projected.append(f"{value} AS {c}_scaled")
    statement = f"SELECT *, {', '.join(projected)} FROM __THIS__"
    assembler = VectorAssembler(inputCols=[f"{c}_scaled" for c in columns], outputCol=VECTOR)
    return [SQLTransformer(statement=statement), assembler]


def _platt(svm: LinearSVC) -> list[Estimator]:
    """Probabilities from the margin of a linear machine through a one-feature logistic fit."""
    svm.setPredictionCol("svm_prediction").setRawPredictionCol("svm_margin")
    margin = VectorSlicer(inputCol="svm_margin", outputCol="margin", indices=[1])
    return [svm, margin, LogisticRegression(featuresCol="margin", labelCol=LABEL, weightCol=WEIGHT)]


def _fourier(width: int, gamma: float, features: Sequence[str], seed: int) -> list:
    """Random Fourier features of the scaled inputs (Rahimi and Recht, 2007) as SQL expressions."""
    draw = np.random.default_rng(seed)
    directions = draw.normal(0.0, math.sqrt(2.0 * gamma), (width, len(features)))
    phases = draw.uniform(0.0, 2.0 * math.pi, width)
    scale = math.sqrt(2.0 / width)
    columns = []
    for i in range(width):
        turn = " + ".join(f"{float(w)!r}D * {c}_scaled" for w, c in zip(directions[i], features))
        columns.append(f"{scale!r}D * cos({turn} + {float(phases[i])!r}D) AS rbf_{i}")
    statement = f"SELECT *, {', '.join(columns)} FROM __THIS__"
    return [
        SQLTransformer(statement=statement),
        VectorAssembler(inputCols=[f"rbf_{i}" for i in range(width)], outputCol="rbf_features"),
    ]


def learner(
    name: str, params: dict | None = None, total_weight: float = 1.0, features: Sequence[str] = schemas.FEATURES,
    spread: float = 1.0, seed: int = schemas.SEED,
) -> list:
    """Stages of a learner on the assembled vector.

    ``total_weight`` turns a penalty C on summed losses into Spark's penalty on the
    mean loss; ``spread`` is the variance of the scaled inputs, for ``gamma='scale'``.
    """
    chosen = {**DEFAULTS[name], **(params or {})}
    common = {"featuresCol": VECTOR, "labelCol": LABEL}
    if name == LOGISTIC:
        penalty = 1.0 / (chosen["C"] * total_weight)
        return [
            LogisticRegression(
                weightCol=WEIGHT, maxIter=chosen["maxIter"], regParam=penalty, elasticNetParam=0.0, standardization=False, **common
            )
        ]
    if name == FOREST:
        return [RandomForestClassifier(weightCol=WEIGHT, seed=seed, **chosen, **common)]
    if name == BOOSTING:
        return [GBTClassifier(seed=seed, **chosen, **common)]
    if name == NETWORK:
        layers = [len(features), *chosen["hidden"], 2]
        return [MultilayerPerceptronClassifier(layers=layers, maxIter=chosen["maxIter"], seed=seed, **common)]
    if name in (SVM_LINEAR, SVM_RBF):
        svm = LinearSVC(
            weightCol=WEIGHT,
            labelCol=LABEL,
            maxIter=chosen["maxIter"],
            regParam=1.0 / (chosen["C"] * total_weight),
            tol=SVM_TOLERANCE,
            standardization=False,
        )
        if name == SVM_LINEAR:
            return _platt(svm.setFeaturesCol(VECTOR))
        width = len(features)
        gamma = {"scale": 1.0 / (width * (spread or 1.0)), "auto": 1.0 / width}.get(chosen["gamma"], chosen["gamma"])
        return [*_fourier(RBF_FEATURES, float(gamma), features, seed), *_platt(svm.setFeaturesCol("rbf_features"))]
    if name == BAYES:
        return [NaiveBayes(modelType="gaussian", **common)]
    raise ValueError(f"unknown model {name}")


def spread_rows(name: str, rows: DataFrame) -> DataFrame:
    """The rows of a learner that reads them hundreds of times at some microseconds a row, the perceptron, dealt evenly over the cores.

    Adaptive execution joins the partitions of a few columns of numbers by their bytes, whatever a pass costs. Few rows,
    and those of the other learners, stay as they are.
    """
    if name != NETWORK:
        return rows
    n = rows.count()
    parts = min(rows.sparkSession.sparkContext.defaultParallelism, n // LEAST_TASK_ROWS)
    if parts < 2:
        return rows
    return rows.repartition(parts * math.ceil(n / (parts * MOST_TASK_ROWS)))


def prepare_training(train: DataFrame, features: Sequence[str] = schemas.FEATURES) -> tuple[list, DataFrame, dict]:
    """Preparation stages, the prepared training rows, and the totals learners need."""
    stages = prep_stages(train, features)
    ready = prep.add_weights(train.withColumn(LABEL, F.col(LABEL).cast("int")), LABEL, WEIGHT)
    prepared = PipelineModel(stages).transform(ready)
    scaled = [F.col(f"{c}_scaled") for c in features]
    totals = prepared.agg(
        F.sum(WEIGHT).alias("weight"),
        sum((F.avg(c) for c in scaled), F.lit(0.0)).alias("mean"),
        sum((F.avg(c * c) for c in scaled), F.lit(0.0)).alias("square"),
    ).first()
    width = len(list(features))
    spread = totals["square"] / width - (totals["mean"] / width) ** 2
    return stages, prepared, {"total_weight": totals["weight"], "spread": spread, "features": list(features)}


def fit_model(name: str, train: DataFrame, params: dict | None = None, features: Sequence[str] = schemas.FEATURES) -> PipelineModel:
    """Preparation and learner fitted on ``train`` (features and ``label``) as one model."""
    stages, prepared, totals = prepare_training(train, features)
    fitted = Pipeline(stages=learner(name, params, **totals)).fit(spread_rows(name, prepared))
    return PipelineModel([*stages, *fitted.stages])


def train_all(train: DataFrame, names: Sequence[str] | None = None, overrides: dict | None = None) -> dict[str, PipelineModel]:
    """Every learner fitted on the same prepared rows."""
    stages, prepared, totals = prepare_training(train)
    prepared = prepared.persist()
    models = {}
    for name in names or DEFAULTS:
        fitted = Pipeline(stages=learner(name, (overrides or {}).get(name), **totals)).fit(prepared)
        models[name] = PipelineModel([*stages, *fitted.stages])
    prepared.unpersist()
    return models


def settings(grid: dict) -> list[dict]:
    """All combinations of a grid, in the order of its lists."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def draw_settings(grid: dict, n_iter: int, seed: int = schemas.SEED) -> list[dict]:
    """``n_iter`` different settings of a grid, or all if there are fewer."""
    every = settings(grid)
    return every if n_iter >= len(every) else random.Random(seed).sample(every, n_iter)


def search(
    name: str, train: DataFrame, candidates: Sequence[dict], folds: int = 5, parallelism: int = 4, fold_column: str = "fold",
    features: Sequence[str] = schemas.FEATURES,
) -> tuple[PipelineModel, DataFrame]:
    """Cross-validated accuracy of every setting, and the model refitted with the best one.

    ``train`` carries the stratified fold number. The result table has (model,
    params, mean_test_score, std_test_score).
    """
    if not candidates:
        model = fit_model(name, train, None, features)
        return model, train.sparkSession.createDataFrame([], "model string, params string, mean_test_score double, std_test_score double")
    stages, prepared, totals = prepare_training(train, features)
    prepared = prepared.withColumn(fold_column, F.col(fold_column).cast("int")).persist()
    pipeline = Pipeline(stages=[])
    grid = [{pipeline.stages: learner(name, params, **totals)} for params in candidates]
    validator = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(labelCol=LABEL, metricName="accuracy"),
        numFolds=folds,
        foldCol=fold_column,
        parallelism=parallelism,
        seed=schemas.SEED,
    )
    fitted = validator.fit(prepared)
    prepared.unpersist()
    rows = [
        (name, str(params), float(mean), float(std))
        for params, mean, std in zip(candidates, fitted.avgMetrics, fitted.stdMetrics)
    ]
    results = train.sparkSession.createDataFrame(
        rows, "model string, params string, mean_test_score double, std_test_score double"
    )
    return PipelineModel([*stages, *fitted.bestModel.stages]), results


def grid_search(name: str, train: DataFrame, folds: int = 5, grid: dict | None = None) -> tuple[PipelineModel, DataFrame]:
    """Full grid; learners without one are fitted as they are."""
    if name not in DEFAULTS:
        raise ValueError(f"unknown model {name}")
    chosen = grid if grid is not None else GRIDS.get(name)
    return search(name, train, settings(chosen) if chosen else [], folds)


def random_search(
    name: str, train: DataFrame, folds: int = 5, n_iter: int = 50, grid: dict | None = None
) -> tuple[PipelineModel, DataFrame]:
    """A seeded draw from the wide grid; learners without one get the full small grid."""
    chosen = grid if grid is not None else WIDE_GRIDS.get(name)
    if chosen is None:
        return grid_search(name, train, folds)
    return search(name, train, draw_settings(chosen, n_iter), folds)


def apply_model(model: PipelineModel, rows: DataFrame, *keep: str) -> DataFrame:
    """(keep..., prediction, score): predicted class and probability of class 1."""
    scored = model.transform(rows)
    return scored.select(
        *keep, F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability")[1].alias("score")
    )


def score_models(models: dict[str, PipelineModel], rows: DataFrame, *keep: str) -> DataFrame:
    """Scored rows of all models under each other, with the column ``model``."""
    scored = None
    for name, model in models.items():
        part = apply_model(model, rows, *keep).withColumn("model", F.lit(name))
        scored = part if scored is None else scored.unionByName(part)
    return scored


def feature_importance(models: dict[str, PipelineModel], spark, features: Sequence[str] = schemas.FEATURES) -> DataFrame:
    """(model, feature, importance, kind) of all models that have importances or coefficients."""
    rows = []
    for name, model in models.items():
        core = model.stages[2]
        if hasattr(core, "featureImportances"):
            values, kind = core.featureImportances.toArray(), "Tree-based"
        elif hasattr(core, "coefficients"):
            values, kind = np.abs(core.coefficients.toArray()), "Coefficient-based"
        else:
            continue
        rows += [(name, f, float(v), kind) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "model string, feature string, importance double, kind string")


def refit_train_val(name: str, split: DataFrame, params: dict | None = None) -> PipelineModel:
    """Scaler and learner fitted again on raw training plus validation rows."""
    return fit_model(name, split.where(F.col("split").isin("train", "val")), params)


def batch_score(model: PipelineModel, rows: DataFrame, *keep: str) -> DataFrame:
    """Class name, confidence and both probabilities of feature rows; a feature they lack is 0 before scaling."""
    scored = apply_model(model, add_missing_features(rows), *keep)
    p_legit = 1 - F.col("score")
    return scored.select(
        *keep,
        outcomes.prediction_label(F.col("prediction")).alias("prediction"),
        outcomes.prediction_confidence(F.col("prediction"), F.col("score"), p_legit).alias("confidence"),
        F.col("score").alias("phishing_probability"),
        p_legit.alias("legitimate_probability"),
        (F.col("prediction") == 1).alias("is_phishing"),
    )


def score_scans(model: PipelineModel, docs: DataFrame, json_column: str = "document") -> DataFrame:
    """Scan documents to predictions; a document that cannot be read becomes an ERROR row."""
    doc = F.col("doc")
    parsed = read_scan_documents(docs, json_column, keep_broken=True)
    empty = F.coalesce(F.trim(json_column), F.lit("")).isin("", "{}", "null")
    rows = parsed.select(
        *scan.feature_columns(doc),
        F.coalesce(scan.scan_uuid(doc), F.lit("N/A")).alias("scan_uuid"),
        (doc["_corrupt_record"].isNull() & ~empty).alias("_usable"),
    )
    scored = batch_score(model, rows, "scan_uuid", "_usable", *schemas.FEATURES)
    ok = F.col("_usable")
    return scored.select(
        "scan_uuid",
        *schemas.FEATURES,
        F.when(ok, F.col("prediction")).otherwise(schemas.LABEL_ERROR).alias("prediction"),
        F.when(ok, F.col("confidence")).otherwise(0.0).alias("confidence"),
        *[F.when(ok, F.col(c)).alias(c) for c in ("phishing_probability", "legitimate_probability", "is_phishing")],
        F.when(~ok, F.lit("no scan result")).alias("error"),
    )
