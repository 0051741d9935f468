"""Baselines and Gaussian naive Bayes as plain aggregations."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from linkrisk import schemas
from linkrisk.functions.ordering import seeded_digest

# Fixed value: share of the greatest feature variance added to every variance.
VAR_SMOOTHING = 1e-9


def class_priors(df: DataFrame, label: str) -> DataFrame:
    """(label, n, prior) of every class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    everything = Window.partitionBy(F.lit(0))
    return counts.withColumn("prior", F.col("n") / F.sum("n").over(everything))


def majority_baseline(train: DataFrame, rows: DataFrame, label: str) -> DataFrame:
    """The most frequent training class for every row, with one-hot probability."""
    top = class_priors(train, label).orderBy(F.col("n").desc(), label).first()[label]
    return rows.withColumn("prediction", F.lit(top)).withColumn("score", (F.col("prediction") == 1).cast("double"))


def stratified_baseline(
    train: DataFrame, rows: DataFrame, label: str, key: str | Sequence[str], seed: int = schemas.SEED
) -> DataFrame:
    """A class drawn with the training share of class 1; the draw comes from a digest of its own.

    The digest that orders rows decides on splits, too; a draw from it would be tied to them.
    """
    prior = class_priors(train, label).where(F.col(label) == 1).first()
    digits = F.substring(F.md5(F.concat(seeded_digest(key, seed), F.lit(":draw"))), 1, 8)
    draw = F.conv(digits, 16, 10).cast("bigint") / F.lit(float(16**8))
    chosen = (draw < F.lit(prior["prior"] if prior else 0.0)).cast("int")
    return rows.withColumn("prediction", chosen).withColumn("score", F.col("prediction").cast("double"))


def gaussian_nb_fit(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Prior, mean and variance per class and feature, in long form."""
    values = [F.col(c).cast("double").alias(c) for c in features]
    data = df.where(F.col(label).isNotNull()).select(label, *values)
    spread = data.agg(F.greatest(*[F.var_pop(c) for c in features], F.lit(0.0))).scalar()
    per_class = data.groupBy(label).agg(
        F.count("*").alias("n"), *[F.struct(F.avg(c).alias("mean"), F.var_pop(c).alias("var")).alias(c) for c in features]
    )
    total = data.agg(F.count("*")).scalar()
    long = per_class.select(label, (F.col("n") / total).alias("prior"), *features).unpivot(
        [label, "prior"], list(features), "feature", "stats"
    )
    variance = F.col("stats.var") + F.lit(VAR_SMOOTHING) * spread
    return long.select(label, "prior", "feature", F.col("stats.mean").alias("mean"), variance.alias("variance"))


def gaussian_nb_score(model: DataFrame, rows: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Adds ``score`` (probability of class 1) and ``prediction`` for a two-class model.

    The model has classes x features rows; their numbers go into the projection.
    """
    fitted = {(row[label], row["feature"]): row for row in model.collect()}

    def joint(cls: int):
        total = F.lit(math.log(fitted[cls, features[0]]["prior"]))
        for c in features:
            fit = fitted[cls, c]
            gap = F.col(c) - F.lit(fit["mean"])
            total = total - (F.lit(math.log(2 * math.pi * fit["variance"])) + gap * gap / F.lit(fit["variance"])) / 2
        return total

    scored = rows.withColumn("_odds", joint(0) - joint(1))
    scored = scored.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(F.least("_odds", F.lit(700.0)))))
    return scored.withColumn("prediction", (F.col("_odds") < 0).cast("int")).drop("_odds")
