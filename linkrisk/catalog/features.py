"""Scan documents to feature rows, labels and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkrisk.catalog import base
from linkrisk.catalog.base import FEATURE_LIST, FEATURE_ROWS, LABELLED_PAGES, SCANS, query
from linkrisk.functions import scan
from linkrisk.operators import features
from linkrisk.sources.scans import read_scan_documents, search_scans as search

FEATS = f"{SCANS}, {FEATURE_ROWS}"


def docs(spark, sf):
    return read_scan_documents(base.scan_documents(spark, sf))


def _one(name, expression, sql_expression):
    """Register a query with one extracted column per page."""

    def run(spark, sf):
        return docs(spark, sf).select("page_id", expression(F.col("doc")).alias(name))

    query(name, f"WITH {FEATS} SELECT page_id, {sql_expression} AS {name} FROM feats")(run)


_one("domain_age_days", scan.domain_age_days, "domain_age_days")
_one("secure_percentage", scan.secure_percentage, "secure_percentage")
_one("url_length", scan.url_length, "url_length")
_one("subdomain_count", scan.subdomain_count, "subdomain_count")


@query("umbrella_rank", f"WITH {FEATS} SELECT page_id, umbrella_rank, has_umbrella_rank FROM feats")
def umbrella_rank(spark, sf):
    doc = F.col("doc")
    return docs(spark, sf).select(
        "page_id", scan.umbrella_rank(doc).alias("umbrella_rank"), scan.has_umbrella_rank(doc).alias("has_umbrella_rank")
    )


@query("tls_valid_days", f"WITH {FEATS} SELECT page_id, tls_valid_days, has_tls FROM feats")
def tls_valid_days(spark, sf):
    doc = F.col("doc")
    return docs(spark, sf).select("page_id", scan.tls_valid_days(doc).alias("tls_valid_days"), scan.has_tls(doc).alias("has_tls"))


@query("read_scan_documents", f"""WITH {SCANS} SELECT page_id, original_url, task_url, scan_uuid, domain, age, umbrella, tls,
  secure, malicious, CAST(verdict_score AS INTEGER) AS verdict_score FROM scans""")
def read_scan_documents_query(spark, sf):
    return docs(spark, sf).select(
        "page_id",
        "doc.original_url",
        F.col("doc.task.url").alias("task_url"),
        F.col("doc.task.uuid").alias("scan_uuid"),
        "doc.page.domain",
        F.col("doc.page.domainAgeDays").alias("age"),
        F.col("doc.page.umbrellaRank").alias("umbrella"),
        F.col("doc.page.tlsValidDays").alias("tls"),
        F.col("doc.stats.securePercentage").alias("secure"),
        "doc.verdicts.overall.malicious",
        F.col("doc.verdicts.overall.score").alias("verdict_score"),
    )


@query("read_scan_documents_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def read_scan_documents_props(spark, sf):
    events = base.table(spark, sf, "events")
    return events.select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))


@query("scan_features", f"WITH {FEATS} SELECT page_id, {FEATURE_LIST} FROM feats")
def scan_features(spark, sf):
    return features.scan_features(docs(spark, sf), "page_id")


@query("scan_features_table", f"WITH {FEATS} SELECT {FEATURE_LIST}, url, scan_uuid FROM feats")
def scan_features_table(spark, sf):
    return features.scan_features_table(docs(spark, sf))


@query("select_features", f"""WITH {FEATS} SELECT {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_LIST.split(", "))} FROM feats""")
def select_features(spark, sf):
    return features.select_features(features.scan_features_table(docs(spark, sf)))


@query("add_missing_features", f"""WITH {FEATS} SELECT page_id, domain_age_days, secure_percentage, 0.0::DOUBLE AS has_umbrella_rank,
  0.0::DOUBLE AS umbrella_rank, has_tls, tls_valid_days, url_length, subdomain_count FROM feats""")
def add_missing_features(spark, sf):
    partial = features.scan_features(docs(spark, sf), "page_id").drop("umbrella_rank", "has_umbrella_rank")
    return features.add_missing_features(partial)


@query("scan_verdict", f"""WITH {SCANS} SELECT page_id, CASE WHEN malicious THEN 'malicious'
  WHEN coalesce(verdict_score, 0) = 0 THEN 'safe' END AS verdict FROM scans""")
def scan_verdict(spark, sf):
    return base.scan_documents(spark, sf).select("page_id", scan.verdict(F.col("document")).alias("verdict"))


@query("search_scans", f"""WITH {SCANS}, top AS (
  SELECT domain FROM scans WHERE domain IS NOT NULL GROUP BY domain ORDER BY count(*) DESC, domain LIMIT 1)
SELECT s.page_id, s.scan_uuid, s.domain FROM scans s JOIN top ON top.domain = s.domain ORDER BY s.scan_uuid LIMIT 5""")
def search_scans(spark, sf):
    stored = docs(spark, sf)
    domain = F.col("doc.page.domain")
    top = stored.where(domain.isNotNull()).groupBy(domain.alias("domain")).agg(F.count("*").alias("n"))
    name = top.orderBy(F.col("n").desc(), "domain").first()["domain"]
    return search(stored, name, 5).select("page_id", F.col("doc.task.uuid").alias("scan_uuid"), domain.alias("domain"))


LABELS_OF_PAGES = f"""{FEATS}, {LABELLED_PAGES}, source AS (
  SELECT url, is_phishing FROM lp WHERE page_id % 10 < 7 UNION ALL SELECT url, is_phishing FROM lp WHERE page_id % 20 = 3),
joined AS (SELECT f.*, s.is_phishing FROM feats f LEFT JOIN source s ON s.url = f.url)"""


def _source(spark, sf):
    """Labelled URLs, some missing and some listed twice."""
    pages = base.labelled_pages(spark, sf)
    once = pages.where(F.col("page_id") % 10 < 7)
    again = pages.where(F.col("page_id") % 20 == 3)
    return once.unionAll(again).select("url", "is_phishing")


@query("label_join", f"WITH {LABELS_OF_PAGES} SELECT {FEATURE_LIST}, url, scan_uuid, is_phishing FROM joined")
def label_join(spark, sf):
    return features.label_join(features.scan_features_table(docs(spark, sf)), _source(spark, sf))


@query("drop_unlabeled", f"WITH {LABELS_OF_PAGES} SELECT scan_uuid, is_phishing FROM joined WHERE is_phishing IS NOT NULL")
def drop_unlabeled(spark, sf):
    joined = features.label_join(features.scan_features_table(docs(spark, sf)), _source(spark, sf))
    return features.drop_unlabeled(joined).select("scan_uuid", "is_phishing")


@query("unlabeled_audit", f"""WITH {LABELS_OF_PAGES}
SELECT count(*) FILTER (is_phishing IS NULL) AS missing, count(*) AS total,
  (SELECT string_agg(url, ' ' ORDER BY url) FROM (SELECT url FROM joined WHERE is_phishing IS NULL ORDER BY url LIMIT 5)) AS examples
FROM joined""")
def unlabeled_audit(spark, sf):
    joined = features.label_join(features.scan_features_table(docs(spark, sf)), _source(spark, sf))
    return features.unlabeled_audit(joined)


@query("process_batch", f"""WITH {LABELS_OF_PAGES}
SELECT DISTINCT {FEATURE_LIST}, url, scan_uuid, is_phishing FROM joined WHERE is_phishing IS NOT NULL""")
def process_batch(spark, sf):
    return features.labelled_features(docs(spark, sf), _source(spark, sf))


@query("drop_duplicate_url_column", f"WITH {LABELS_OF_PAGES} SELECT scan_uuid, url, is_phishing FROM joined")
def drop_duplicate_url_column(spark, sf):
    source = _source(spark, sf).withColumnRenamed("url", "phishing_url")
    joined = features.label_join(features.scan_features_table(docs(spark, sf)), source)
    return joined.drop(*FEATURE_LIST.split(", "))
