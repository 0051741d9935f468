"""Exact-size, class-balanced and batched draws in seeded order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from linkrisk import schemas
from linkrisk.functions.ordering import SeededClasses, seeded_rank
from linkrisk.operators import dedupe


def sample_exact(df: DataFrame, n: int, key: str | Sequence[str], seed: int = schemas.SEED) -> DataFrame:
    """Exactly n rows without replacement, or all rows if there are fewer."""
    classes = SeededClasses(df.withColumn("_class", F.lit(0)), "_class", key, seed)
    classes.cut({"take": {cls: min(n, rows) for cls, rows in classes.totals.items()}})
    return classes.rows.where(classes.reached("take")).select(*df.columns)


def minority_size(df: DataFrame, label: str) -> DataFrame:
    """Smallest class and the size of a balanced sample, as one row."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return counts.agg(F.min("n").alias("minority"), (2 * F.min("n")).alias("balanced_total"))


def balanced_sample(
    df: DataFrame,
    label: str,
    key: str | Sequence[str],
    seen: DataFrame | None = None,
    sample_size: int | None = None,
    seed: int = schemas.SEED,
) -> DataFrame:
    """Equally many rows of both classes, after dropping attempted URLs.

    An empty class empties the sample: the class size is the smaller of the two,
    and a class that has no rows left counts as 0.
    """
    classes = SeededClasses(dedupe.exclude_scanned(df, seen), label, key, seed)
    smallest = min(classes.totals.values()) if len(classes.totals) == 2 else 0
    size = smallest if sample_size is None else min(sample_size, smallest)
    classes.cut({"take": {cls: size for cls in classes.totals}})
    return classes.rows.where(classes.reached("take")).select(*df.columns)


def class_quota_rank(df: DataFrame, label: str, key: str | Sequence[str], seed: int = schemas.SEED) -> DataFrame:
    """Position of every row within its class, in seeded order."""
    return seeded_rank(df, [label], key, seed)


def shuffle(df: DataFrame, key: str | Sequence[str], seed: int = schemas.SEED) -> DataFrame:
    """A full seeded permutation, as the position ``rn`` of every row."""
    return seeded_rank(df, [], key, seed)


def assign_batches(
    df: DataFrame,
    key: str | Sequence[str],
    batch_size: int = schemas.BATCH_SIZE,
    max_batches: int | None = None,
    seed: int = schemas.SEED,
) -> DataFrame:
    """0-based batch numbers in seeded order; later batches than ``max_batches`` are left for the next run."""
    chosen = df if max_batches is None else sample_exact(df, batch_size * max_batches, key, seed)
    ranked = seeded_rank(chosen, [], key, seed, "_rn")
    batch = F.floor((F.col("_rn") - 1) / F.lit(batch_size)).cast("bigint")
    return ranked.withColumn("batch", batch).drop("_rn")
