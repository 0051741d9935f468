"""URL feeds and ranked domain lists, read from landed text files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkrisk import schemas
from linkrisk.functions import text
from linkrisk.functions.ordering import number_rows
from linkrisk.operators.dedupe import first_seen


def read_lines(spark: SparkSession, paths: str | list[str], line_sep: str | None = "\n") -> DataFrame:
    """Lines with their place: file, start of the input split, and position in it.

    The position only grows within a split, so (file, split, position) is the
    order of the lines, and files of any size are still read in parallel.
    """
    reader = spark.read.option("lineSep", line_sep) if line_sep else spark.read
    return reader.text(paths).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("position"),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Distinct non-blank lines of a manifest with their 0-based first-seen number."""
    lines = read_lines(spark, path).where(text.is_nonblank(F.col("line")))
    order = ["file_path", "split_start", "position"]
    seen = first_seen(lines.withColumnRenamed("line", "file_name"), "file_name", order)
    return number_rows(seen, order, "file_no").select("file_no", "file_name")


def read_url_feed(spark: SparkSession, base: str, manifest: DataFrame, label: int = 1) -> DataFrame:
    """(url_id, url, is_phishing) from all files that a manifest lists.

    The list of file names is all that reaches the driver, as in any file scan, and
    the same list is broadcast to number the lines' files. Spark names files with escapes,
    so names are decoded before they are matched. URLs keep a trailing
    carriage return: lines end at the line feed only.
    """
    base = base.rstrip("/")
    listed = [(row.file_no, row.file_name) for row in manifest.orderBy("file_no").collect()]
    if not listed:
        return spark.createDataFrame([], schemas.FEED_DDL)
    files = spark.createDataFrame(listed, "file_no BIGINT, file_name STRING")
    folder = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "", base).strip("/") + "/"
    path = F.url_decode(F.replace(F.col("file_path"), F.lit("+"), F.lit("%2B")))
    lines = read_lines(spark, [f"{base}/{name}" for _, name in listed])
    named = lines.withColumn("file_name", F.substring(path, F.locate(folder, path) + len(folder), F.lit(1 << 20)))
    urls = named.join(F.broadcast(files), "file_name").where(text.is_nonblank(F.col("line")) & text.has_http_scheme(F.col("line")))
    order = ["file_no", "split_start", "position"]
    seen = first_seen(urls.withColumnRenamed("line", "url"), "url", order)
    return number_rows(seen, order, "url_id").select("url_id", "url", F.lit(label).alias("is_phishing"))


def read_ranked_domains(spark: SparkSession, path: str) -> DataFrame:
    """(domain, rank) from ``rank,domain`` lines; the last line of a domain wins.

    A rank that is not a whole number fails the load.
    """
    fields = F.split("line", ",", 2)
    lines = read_lines(spark, path, line_sep=None).where(F.col("line") != "")
    rows = lines.select(
        F.get(fields, F.lit(1)).alias("domain"),
        F.get(fields, F.lit(0)).cast("int").alias("rank"),
        F.struct("file_path", "split_start", "position").alias("place"),
    )
    checked = rows.withColumn(
        "domain", F.when(F.col("domain").isNull(), F.raise_error(F.lit("line without a comma"))).otherwise(F.col("domain"))
    )
    return checked.groupBy("domain").agg(F.max_by("rank", "place").alias("rank"))
