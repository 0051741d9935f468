"""Imputation, scaling and class weights.

Statistics are fitted once, as one-row frames. Transforming reads that row and puts
its numbers into the projection, so feature rows are neither joined nor shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from linkrisk import schemas
from linkrisk.functions.ordering import running_totals
from linkrisk.session import cut_lineage

#: Half the share of the rows of a column that is counted by value around its median.
MEDIAN_SLACK = 0.0005


def missing_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null cells per column and in total, as one row."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    total = sum((F.col(c) for c in columns), F.lit(0))
    return counts.withColumn("total", total.cast("bigint"))


def _brackets(values: DataFrame, columns: Sequence[str], slack: float) -> dict[str, tuple]:
    """Rows with a value, and a bracket around its median, for each column: one scan with a quantile sketch each."""
    levels = [max(0.0, 0.5 - slack), min(1.0, 0.5 + slack)]
    found = values.agg(
        *[F.struct(F.count(c).alias("n"), F.percentile_approx(_ordered(c), levels, math.ceil(2 / slack)).alias("at")).alias(c) for c in columns]
    ).first()
    return {c: (found[c]["n"], *(found[c]["at"] or (None, None))) for c in columns}


def _ordered(c: str) -> Column:
    """The column with NaN, the greatest value, as infinity: sketches cannot place it."""
    return F.nanvl(F.col(c), F.lit(float("inf")))


def _bracketed(values: DataFrame, brackets: dict[str, tuple]) -> DataFrame:
    """``column, value, n``: the distinct values inside each bracket, and one row without a value for all that lie below."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.when(_ordered(c) >= low, F.col(c)).alias("value"), (_ordered(c) <= high).alias("keep"))
                      for c, (n, low, high) in brackets.items() if n])
    long = values.select(F.inline(F.filter(cells, lambda cell: cell["keep"])))
    return long.groupBy("column", "value").agg(F.count("*").alias("n"))


def column_medians(df: DataFrame, columns: Sequence[str], slack: float = MEDIAN_SLACK) -> DataFrame:
    """Exact medians, nulls skipped, as one row with a column per input.

    A quantile sketch brackets the median of every column, so that a share of about twice
    ``slack`` of its rows is counted by value; the two middle positions are looked up in the running
    totals of these. Should a bracket miss a position, it is widened and counted anew, so the sketch steers cost only.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    brackets = _brackets(values, columns, slack)
    if not any(n for n, _, _ in brackets.values()):
        return values.agg(*[F.max(c).alias(c) for c in columns])
    counted = cut_lineage(_bracketed(values, brackets))
    # Two numbers per column.
    sums = counted.groupBy("column").agg(F.sum("n").alias("through"), F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("below"))
    reached = {row["column"]: (row["below"] or 0, row["through"]) for row in sums.collect()}

    def holds(c: str, n: int) -> bool:
        below, through = reached.get(c, (0, 0))
        return below < (n + 1) // 2 and n // 2 + 1 <= through

    if not all(holds(c, n) for c, (n, _, _) in brackets.items() if n):
        return column_medians(df, columns, slack * 10)
    running = running_totals(counted, ["column"], "value", ["n"])
    through = F.col("n_before") + F.col("n")

    def covers(position: int):
        return (F.col("n_before") < position) & (position <= through)

    def median(c: str):
        n = brackets[c][0]
        middle = covers((n + 1) // 2) | covers(n // 2 + 1)
        return F.avg(F.when((F.col("column") == c) & middle, F.col("value"))).alias(c)

    return running.agg(*[median(c) for c in columns])


def fill_nulls(df: DataFrame, medians: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null values replaced by the given one-row medians."""
    row = medians.first()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(row[c]).cast("double")) for c in columns})


def median_impute(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Nulls to column medians of ``fit_on``, or of the whole frame when it is not given."""
    return fill_nulls(df, column_medians(df if fit_on is None else fit_on, columns), columns)


def scaler_fit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per column, as one row of structs."""
    def stats(c):
        return F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"))

    return df.agg(*[stats(c).alias(c) for c in columns])


def zscore(df: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(value - mean) / deviation; a constant column is only centred."""
    row = scaler.first()
    return df.withColumns(
        {c: (F.col(c) - F.lit(row[c]["mean"]).cast("double")) / F.lit(row[c]["std"] or 1.0) for c in columns}
    )


def scale_splits(split: DataFrame, columns: Sequence[str] | None = None, fit_on: Sequence[str] = ("train",)) -> DataFrame:
    """All splits scaled with the statistics of the ``fit_on`` splits."""
    names = columns or schemas.CONTINUOUS
    return zscore(split, scaler_fit(split.where(F.col("split").isin(*fit_on)), names), names)


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Weight n / (classes * class rows) of every class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes"))).scalar()
    return counts.withColumn("weight", total.getField("rows") / (total.getField("classes") * F.col("n")))


def add_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Class weights as a column; one number per class is read."""
    weight = F.lit(None).cast("double")
    for row in balanced_weights(df, label).collect():
        weight = F.when(F.col(label) == row[label], row["weight"]).otherwise(weight)
    return df.withColumn(name, weight)
