"""Train, validation and test splits with exact class quotas.

Every split is a column ``split`` on the input rows. Quotas come from the class
totals, one number per class; rows are placed by comparing their digest with the
cut digests of their class, so the feature rows themselves are not shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from linkrisk import schemas
from linkrisk.functions.ordering import SeededClasses, seeded_rank

def share_out(available: dict, part: int) -> dict:
    """Split ``part`` rows over the classes by largest remainder; ties fall to the lower class."""
    total = sum(available.values())
    exact = {cls: part * n / total for cls, n in available.items()} if total else {cls: 0.0 for cls in available}
    quota = {cls: math.floor(share) for cls, share in exact.items()}
    by_remainder = sorted(available, key=lambda cls: (quota[cls] - exact[cls], cls))
    for cls in by_remainder[: part - sum(quota.values())]:
        quota[cls] += 1
    return quota


def _place(df: DataFrame, label: str, key: str | Sequence[str], seed: int, quotas, rest: str | None) -> DataFrame:
    """Put rows into named splits, filled one after the other in seeded order.

    ``quotas`` maps class totals to the rows per class of every split. Rows beyond
    the last split go to ``rest``, or are left out when it is None.
    """
    classes = SeededClasses(df, label, key, seed)
    wanted, filled = {}, {cls: 0 for cls in classes.totals}
    for name, sizes in quotas(classes.totals).items():
        filled = {cls: filled[cls] + sizes[cls] for cls in filled}
        wanted[name] = filled
    classes.cut(wanted)
    place = F
    for name in wanted:
        place = place.when(classes.reached(name), name)
    used = classes.rows if rest else classes.rows.where(classes.reached(name))
    return used.withColumn("split", place.otherwise(F.lit(rest))).select(*df.columns, "split")


def _minus(totals: dict, taken: dict) -> dict:
    return {cls: n - taken[cls] for cls, n in totals.items()}


def stratified_split(
    df: DataFrame,
    label: str,
    key: str | Sequence[str],
    val_size: float = schemas.VAL_SIZE,
    test_size: float = schemas.TEST_SIZE,
    seed: int = schemas.SEED,
) -> DataFrame:
    """Test, then validation out of the rest, class shares kept; all rows are used."""

    def quotas(totals: dict) -> dict:
        test = share_out(totals, math.ceil(test_size * sum(totals.values())))
        rest = _minus(totals, test)
        return {"test": test, "val": share_out(rest, math.ceil(val_size / (1.0 - test_size) * sum(rest.values())))}

    return _place(df, label, key, seed, quotas, "train")


def balanced_test_split(
    df: DataFrame,
    label: str,
    key: str | Sequence[str],
    val_size: float = schemas.VAL_SIZE,
    test_size: float = schemas.TEST_SIZE,
    seed: int = schemas.SEED,
) -> DataFrame:
    """Equally many test rows per class; the rest is stratified with ``val_size`` of the rest."""

    def quotas(totals: dict) -> dict:
        half = math.floor(sum(totals.values()) * test_size) // 2
        test = {cls: min(half, *totals.values()) for cls in totals}
        rest = _minus(totals, test)
        return {"test": test, "val": share_out(rest, math.ceil(val_size * sum(rest.values())))}

    return _place(df, label, key, seed, quotas, "train")


def fully_balanced_split(
    df: DataFrame,
    label: str,
    key: str | Sequence[str],
    val_size: float = schemas.VAL_SIZE,
    test_size: float = schemas.TEST_SIZE,
    seed: int = schemas.SEED,
) -> DataFrame:
    """Every split half and half; the surplus of the larger class is not used, no row is repeated."""

    def quotas(totals: dict) -> dict:
        smallest = min(totals.values(), default=0)
        test, val = math.floor(smallest * test_size), math.floor(smallest * val_size)
        sizes = {"test": test, "val": val, "train": smallest - test - val}
        return {name: {cls: size for cls in totals} for name, size in sizes.items()}

    return _place(df, label, key, seed, quotas, None)


def split_data(
    df: DataFrame,
    label: str,
    key: str | Sequence[str],
    val_size: float = schemas.VAL_SIZE,
    test_size: float = schemas.TEST_SIZE,
    seed: int = schemas.SEED,
    balanced_test: bool = False,
    balanced_train_val: bool = False,
) -> DataFrame:
    """The split the flags ask for; full balance wins over a balanced test set."""
    if balanced_train_val:
        return fully_balanced_split(df, label, key, val_size, test_size, seed)
    if balanced_test:
        return balanced_test_split(df, label, key, val_size, test_size, seed)
    return stratified_split(df, label, key, val_size, test_size, seed)


def stratified_kfold(df: DataFrame, label: str, key: str | Sequence[str], k: int = 5, seed: int = schemas.SEED) -> DataFrame:
    """Adds the fold number ``fold`` (0 to k-1), class shares kept."""
    ranked = seeded_rank(df, [label], key, seed, "_rn")
    return ranked.withColumn("fold", F.pmod(F.col("_rn") - 1, F.lit(k)).cast("int")).drop("_rn")


def train_plus_val(split: DataFrame) -> DataFrame:
    return split.where(F.col("split").isin("train", "val"))


def class_distribution(df: DataFrame, *by: str) -> DataFrame:
    """Rows and share per class, the last of the given columns; null classes are not counted."""
    label = by[-1]
    counts = df.where(F.col(label).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"))
    outer = Window.partitionBy(*by[:-1]) if len(by) > 1 else Window.partitionBy(F.lit(0))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(outer))


def balance_check(df: DataFrame, split: str, label: str) -> DataFrame:
    """Per split: are there exactly two classes of equal size?"""
    counts = df.where(F.col(label).isNotNull()).groupBy(split, label).agg(F.count("*").alias("n"))
    balanced = (F.count("*") == 2) & (F.min("n") == F.max("n"))
    return counts.groupBy(split).agg(balanced.alias("balanced"))
