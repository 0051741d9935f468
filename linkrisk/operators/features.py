"""Feature rows from scan documents, and the labels joined back to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkrisk import schemas
from linkrisk.functions import scan
from linkrisk.operators.dedupe import url_column


def scan_features(docs: DataFrame, *keep: str) -> DataFrame:
    """The model inputs of every document, in their fixed order."""
    return docs.select(*keep, *scan.feature_columns(F.col("doc")))


def scan_features_table(docs: DataFrame) -> DataFrame:
    """Model inputs plus the submitted URL and the scan id."""
    doc = F.col("doc")
    return docs.select(
        *scan.feature_columns(doc), scan.submitted_url(doc).alias("url"), scan.scan_uuid(doc).alias("scan_uuid")
    )


def label_join(
    features: DataFrame, source: DataFrame, label: str = "is_phishing", null_safe: bool = False, keep_copies: bool = True
) -> DataFrame:
    """Left join of the label by URL.

    A URL that the source lists several times yields several rows. With
    ``keep_copies=False`` equal (url, label) pairs count once: a join that is
    followed by an upsert on the scan id ends in the same table, and a URL that
    fills a third of the source no longer multiplies its features.
    """
    column = url_column(source)
    right = source.select(F.col(column).alias("_url"), label)
    if not null_safe:
        right = right.where(F.col("_url").isNotNull())
    if not keep_copies:
        right = right.distinct()
    # Without null URLs on the right this is plain equality, but Spark adds no null
    # filter on the left, which would parse every scan document a second time.
    return features.join(right, F.col("url").eqNullSafe(F.col("_url")), "left").drop("_url")


def drop_unlabeled(features: DataFrame, label: str = "is_phishing") -> DataFrame:
    return features.dropna(subset=[label])


def unlabeled_audit(features: DataFrame, label: str = "is_phishing", examples: int = 5) -> DataFrame:
    """Rows without a label: their number, all rows, and the first example URLs."""
    missing = F.col(label).isNull()
    counts = features.agg(F.count_if(missing).alias("missing"), F.count("*").alias("total"))
    sample = features.where(missing).select("url").orderBy(F.col("url").asc_nulls_last()).limit(examples)
    listed = sample.agg(F.array_sort(F.collect_list("url")).alias("urls")).scalar()
    return counts.withColumn("examples", F.array_join(listed, " "))


def labelled_features(docs: DataFrame, source: DataFrame, label: str = "is_phishing") -> DataFrame:
    """One scan batch: features, labels joined back, rows without a label dropped."""
    features = scan_features_table(docs)
    return drop_unlabeled(label_join(features, source, label, keep_copies=False), label)


def select_features(df: DataFrame, columns: list[str] | None = None, *keep: str) -> DataFrame:
    """The model inputs in order, as doubles."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns or schemas.FEATURES])


def add_missing_features(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Model inputs that the frame lacks, as the constant 0."""
    absent = [c for c in columns or schemas.FEATURES if c not in df.columns]
    return df.withColumns({c: F.lit(0.0) for c in absent}) if absent else df
