"""Distinct, first-seen and last-wins rows, anti-joins and unions of URL tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def first_seen(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """First row position of every key value: (key, order columns).

    The minimum is taken on the map side first, so a URL that fills a third of
    the feed travels as one row per task.
    """
    if len(order_by) == 1:
        return df.groupBy(key).agg(F.min(order_by[0]).alias(order_by[0]))
    first = df.groupBy(key).agg(F.min(F.struct(*order_by)).alias("_first"))
    return first.select(key, "_first.*")


def last_wins(df: DataFrame, key: str, value: str, order_by: Sequence[str]) -> DataFrame:
    """(key, value) with the value of the last row in the given order."""
    last = F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)
    return df.groupBy(key).agg(F.max_by(value, last).alias(value))


def latest_by_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The greatest row of every key by the order columns; ties fall to the greater values."""
    rest = [c for c in df.columns if c not in key and c not in order_by]
    newest = df.groupBy(*key).agg(F.max(F.struct(*order_by, *rest)).alias("_row"))
    return newest.select(*key, "_row.*").select(*df.columns)


def url_column(df: DataFrame) -> str:
    """Name of the URL column of a source table."""
    return "phishing_url" if "phishing_url" in df.columns else "url"


def non_null_urls(df: DataFrame, column: str = "url") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def seen_urls(*tables: DataFrame | None) -> DataFrame | None:
    """Distinct non-null URLs of all tables that exist and have a ``url`` column."""
    usable = [non_null_urls(t).select("url") for t in tables if t is not None and "url" in t.columns]
    if not usable:
        return None
    union = usable[0]
    for table in usable[1:]:
        union = union.unionAll(table)
    return union.distinct()


def exclude_scanned(df: DataFrame, seen: DataFrame | None, column: str | None = None) -> DataFrame:
    """Rows whose URL was not attempted yet. Rows without a URL stay.

    An anti-join needs no distinct right side, and Spark splits a skewed left
    partition at run time, so no side is broadcast or collected here.
    """
    if seen is None:
        return df
    name = column or url_column(df)
    right = seen.select(F.col("url").alias("_seen"))
    return df.join(right, F.col(name) == F.col("_seen"), "left_anti")


def new_domains(ranked: DataFrame, processed: DataFrame) -> DataFrame:
    """Ranked domains that were not processed; a null matches a null."""
    right = processed.select(F.col("domain").alias("_done"))
    return ranked.join(right, F.col("domain").eqNullSafe(F.col("_done")), "left_anti")


def head_domains(domains: DataFrame, n: int) -> DataFrame:
    """The n best-ranked domains, as the report of the next run."""
    return domains.orderBy(F.col("rank").asc_nulls_last(), F.col("domain").asc_nulls_last()).limit(n)


def union_samples(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both tables by column name; a column missing on one side becomes null."""
    return first.unionByName(second, allowMissingColumns=True)
