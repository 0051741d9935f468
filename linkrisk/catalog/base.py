"""Registration of queries, the inputs derived from the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linkrisk.functions import text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under an operator name, with the SQL that gives the same rows."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- pages with a class label ---------------------------------------------------------------

IS_HTTP = "(url LIKE 'http://%')"
LABELLED_PAGES = f"""lp AS (
  SELECT page_id, url, CAST({IS_HTTP} <> (page_id % 10 = 0) AS INTEGER) AS is_phishing FROM pages)"""


def labelled_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    label = (F.col("url").startswith("http://") != (F.col("page_id") % 10 == 0)).cast("int")
    return pages.select("page_id", "url", label.alias("is_phishing"))


# --- attempts: pages that users of the event log have dealt with -----------------------------

ATTEMPTS = """success AS (
  SELECT p.url, e.event_id FROM events e JOIN pages p ON p.page_id = e.user_id
  WHERE e.event_type = 'purchase' AND e.value > 100),
attempts AS (
  SELECT p.url, e.event_id FROM events e JOIN pages p ON p.page_id = e.user_id
  WHERE e.event_type = 'error' AND e.value > 100),
seen AS (SELECT url FROM success UNION SELECT url FROM attempts)"""


def attempted(spark: SparkSession, sf: str, event_type: str) -> DataFrame:
    events = table(spark, sf, "events").where((F.col("event_type") == event_type) & (F.col("value") > 100))
    pages = table(spark, sf, "pages").select("page_id", "url")
    return events.join(pages, F.col("user_id") == F.col("page_id")).select("url", "event_id")


# --- scan documents --------------------------------------------------------------------------

SCANS = f"""scans AS (
  SELECT page_id, url AS task_url, md5(url) AS scan_uuid,
    CASE WHEN page_id % 11 <> 0 THEN url END AS original_url,
    CASE WHEN page_id % 13 <> 0 THEN nullif(regexp_extract(url, '^https?://([^/?#:]+)', 1), '') END AS domain,
    CASE WHEN page_id % 7 <> 0 THEN (page_id * 37) % 5000 END AS age,
    CASE WHEN page_id % 3 <> 0 THEN (page_id * 9973) % 1000000 + 1 END AS umbrella,
    CASE WHEN NOT {IS_HTTP} THEN 30 + page_id % 365 END AS tls,
    CASE WHEN NOT {IS_HTTP} AND page_id % 5 <> 0 THEN 100.0 ELSE (page_id * 13) % 101 END::DOUBLE AS secure,
    page_id % 4 = 0 AS malicious,
    CASE WHEN page_id % 6 <> 0 THEN page_id % 3 END AS verdict_score
  FROM pages)"""

FEATURE_ROWS = """feats AS (
  SELECT page_id, age AS domain_age_days, secure AS secure_percentage,
    CAST(umbrella IS NOT NULL AS INTEGER) AS has_umbrella_rank, coalesce(umbrella, 999999) AS umbrella_rank,
    CAST(tls IS NOT NULL AS INTEGER) AS has_tls, coalesce(tls, 0) AS tls_valid_days,
    CAST(length(nullif(task_url, '')) AS INTEGER) AS url_length,
    CASE WHEN domain <> '' THEN CAST(greatest(0, len(string_split(domain, '.')) - 2) AS INTEGER) END AS subdomain_count,
    coalesce(nullif(original_url, ''), task_url) AS url, scan_uuid
  FROM scans)"""

FEATURE_LIST = (
    "domain_age_days, secure_percentage, has_umbrella_rank, umbrella_rank, has_tls, tls_valid_days, "
    "url_length, subdomain_count"
)


def scan_documents(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, document): a JSON scan document per page, null fields left out."""
    page_id, url = F.col("page_id"), F.col("url")
    is_http = url.startswith("http://")

    def unless(rule: Column, value: Column) -> Column:
        return F.when(~rule, value)

    page = F.struct(
        unless(page_id % 13 == 0, text.url_host(url)).alias("domain"),
        unless(page_id % 7 == 0, (page_id * 37) % 5000).alias("domainAgeDays"),
        unless(page_id % 3 == 0, (page_id * 9973) % 1000000 + 1).alias("umbrellaRank"),
        unless(is_http, 30 + page_id % 365).alias("tlsValidDays"),
    )
    secure = F.when(~is_http & (page_id % 5 != 0), 100.0).otherwise(((page_id * 13) % 101).cast("double"))
    overall = F.struct(
        unless(page_id % 6 == 0, page_id % 3).alias("score"), (page_id % 4 == 0).alias("malicious")
    )
    doc = F.struct(
        unless(page_id % 11 == 0, url).alias("original_url"),
        page.alias("page"),
        F.struct(secure.alias("securePercentage")).alias("stats"),
        F.struct(url.alias("url"), F.md5(url).alias("uuid")).alias("task"),
        F.struct(overall.alias("overall")).alias("verdicts"),
    )
    return table(spark, sf, "pages").select("page_id", F.to_json(doc).alias("document"))


# --- line items with a binary label, the large table for draws and splits ----------------------

LABELLED_LINES = """ll AS (
  SELECT *, md5('42:' || line_id) AS digest FROM (
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS INTEGER) AS line_id,
      CAST(l_returnflag = 'R' AS INTEGER) AS label, l_quantity FROM lineitem))"""


def labelled_lines(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """(line_id, label): order and line numbers alone do not identify a line in the given table."""
    parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int")]
    label = (F.col("l_returnflag") == "R").cast("int").alias("label")
    return table(spark, sf, "lineitem").select(F.concat_ws("-", *parts).alias("line_id"), label, *columns)


# --- scored rows of three fixed linear models ----------------------------------------------------

MODEL_NAMES = ["m1", "m2", "m3"]
SCORED = """scored AS (
  SELECT 'm' || j AS model, CASE WHEN md5('42:' || l.doc_id) < 'c' THEN 'train' ELSE 'val' END AS split,
    l.doc_id, l.quality AS label,
    ((d.n_chars * (3 + 7 * j) + l.doc_id * 13) % 700 + 100 * j * l.quality) / 1000.0::DOUBLE AS score,
    CAST(((d.n_chars * (3 + 7 * j) + l.doc_id * 13) % 700 + 100 * j * l.quality) >= 500 AS INTEGER) AS prediction
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id, (VALUES (1), (2), (3)) AS m(j))"""


def scored_rows(spark: SparkSession, sf: str) -> DataFrame:
    """(model, split, doc_id, label, score, prediction) of three fixed models on labelled documents."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    joined = labels.join(docs, "doc_id").withColumn("j", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    doc_id, j = F.col("doc_id"), F.col("j")
    points = (F.col("n_chars") * (3 + 7 * j) + doc_id * 13) % 700 + 100 * j * F.col("label")
    in_train = F.md5(F.concat(F.lit("42:"), doc_id.cast("string"))) < "c"
    return joined.select(
        F.concat(F.lit("m"), j.cast("string")).alias("model"),
        F.when(in_train, "train").otherwise("val").alias("split"),
        "doc_id",
        "label",
        (points / F.lit(1000.0)).alias("score"),
        (points >= 500).cast("int").alias("prediction"),
    )
