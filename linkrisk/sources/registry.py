"""Saved models: one folder per version, and one row of metrics beside it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from linkrisk.sources.tables import table_path, write_batch, get_table


def save_model(
    model: PipelineModel, metrics: DataFrame, root: str, name: str, features: Sequence[str], description: str = ""
) -> int:
    """Save the next version of a model; returns its number.

    ``metrics`` is one row of numbers. The description is kept only when it names
    the best parameters.
    """
    spark = metrics.sparkSession
    known = get_table(spark, root, f"{name}_metrics")
    version = 1 if known is None else known.agg(F.max("version")).first()[0] + 1
    model.write().overwrite().save(f"{table_path(root, name, version)}/model")
    kept = description if "best parameters" in description.lower() else None
    row = metrics.withColumns(
        {
            "version": F.lit(version),
            "features": F.array(*[F.lit(f) for f in features]),
            "description": F.lit(kept).cast("string"),
        }
    )
    write_batch(row, root, f"{name}_metrics", version)
    return version


def load_model(spark: SparkSession, root: str, name: str, version: int | None = None) -> tuple[PipelineModel, DataFrame]:
    """A saved model and its metrics row; the newest version if none is given."""
    known = get_table(spark, root, f"{name}_metrics")
    if known is None:
        raise ValueError(f"no model named {name} below {root}")
    number = version or known.agg(F.max("version")).first()[0]
    model = PipelineModel.load(f"{table_path(root, name, number)}/model")
    return model, known.where(F.col("version") == number)
