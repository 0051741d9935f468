"""Anti-joins, distinct and first-seen rows, ids, balanced draws and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkrisk import schemas
from linkrisk.catalog import base
from linkrisk.catalog.base import ATTEMPTS, LABELLED_LINES, LABELLED_PAGES, query, table
from linkrisk.functions import text
from linkrisk.functions.ordering import number_rows
from linkrisk.operators import dedupe, sampling, splits

HOSTS = """hosts AS (
  SELECT nullif(regexp_extract(url, '^https?://([^/?#:]+)', 1), '') AS domain, CAST(min(page_id) AS INTEGER) AS rank
  FROM pages GROUP BY 1)"""
NEW_HOSTS = """processed AS (SELECT DISTINCT nullif(regexp_extract(url, '^https?://([^/?#:]+)', 1), '') AS domain FROM seen),
fresh AS (SELECT h.* FROM hosts h WHERE NOT EXISTS (
  SELECT 1 FROM processed p WHERE p.domain IS NOT DISTINCT FROM h.domain))"""


def _hosts(spark, sf):
    host = text.url_host(F.col("url")).alias("domain")
    return table(spark, sf, "pages").groupBy(host).agg(F.min("page_id").cast("int").alias("rank"))


def _seen(spark, sf):
    return dedupe.seen_urls(base.attempted(spark, sf, "purchase"), base.attempted(spark, sf, "error"))


def _new_hosts(spark, sf):
    processed = _seen(spark, sf).select(text.url_host(F.col("url")).alias("domain"))
    return dedupe.new_domains(_hosts(spark, sf), processed)


@query("exclude_scanned", f"""WITH {LABELLED_PAGES}, {ATTEMPTS}
SELECT * FROM lp WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.url = lp.url)""")
def exclude_scanned(spark, sf):
    return dedupe.exclude_scanned(base.labelled_pages(spark, sf), _seen(spark, sf))


@query("filter_already_scanned", f"""WITH {ATTEMPTS}
SELECT page_id, url AS phishing_url FROM pages p WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.url = p.url)""")
def filter_already_scanned(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.col("url").alias("phishing_url"))
    return dedupe.exclude_scanned(pages, _seen(spark, sf))


@query("new_domains", f"WITH {ATTEMPTS}, {HOSTS}, {NEW_HOSTS} SELECT * FROM fresh")
def new_domains(spark, sf):
    return _new_hosts(spark, sf)


@query("head_domains", f"""WITH {ATTEMPTS}, {HOSTS}, {NEW_HOSTS}
SELECT * FROM fresh ORDER BY rank NULLS LAST, domain NULLS LAST LIMIT 50""")
def head_domains(spark, sf):
    return dedupe.head_domains(_new_hosts(spark, sf), schemas.DOMAINS_PER_RUN)


@query("seen_urls", f"WITH {ATTEMPTS} SELECT url FROM seen")
def seen_urls(spark, sf):
    return _seen(spark, sf)


@query("union_seen", """SELECT DISTINCT url FROM (
  SELECT 'https://u' || user_id || '.example/' AS url FROM events WHERE event_type = 'view'
  UNION ALL SELECT 'https://u' || user_id || '.example/' FROM events WHERE event_type = 'signup')""")
def union_seen(spark, sf):
    events = table(spark, sf, "events")
    url = F.concat(F.lit("https://u"), F.col("user_id").cast("string"), F.lit(".example/")).alias("url")
    return dedupe.seen_urls(
        events.where(F.col("event_type") == "view").select(url), events.where(F.col("event_type") == "signup").select(url), None
    )


@query("non_null_urls", f"WITH {base.SCANS} SELECT page_id, original_url AS url FROM scans WHERE original_url IS NOT NULL")
def non_null_urls(spark, sf):
    from linkrisk.sources.scans import read_scan_documents

    docs = read_scan_documents(base.scan_documents(spark, sf))
    return dedupe.non_null_urls(docs.select("page_id", F.col("doc.original_url").alias("url")))


@query("first_seen_dedupe", "SELECT props, min(event_id) AS event_id FROM events GROUP BY props")
def first_seen_dedupe(spark, sf):
    return dedupe.first_seen(table(spark, sf, "events"), "props", ["event_id"])


@query("last_wins_dedupe", "SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def last_wins_dedupe(spark, sf):
    return dedupe.last_wins(table(spark, sf, "events"), "user_id", "value", ["event_id"])


@query("dense_url_id", """SELECT url, row_number() OVER (ORDER BY page_id) - 1 AS url_id
FROM (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url)""")
def dense_url_id(spark, sf):
    first = dedupe.first_seen(table(spark, sf, "pages"), "url", ["page_id"])
    return number_rows(first, ["page_id"], "url_id").select("url", "url_id")


@query("dense_id_1based", """SELECT doc_id, line_no, row_number() OVER (ORDER BY doc_id, line_no) AS id FROM (
  SELECT doc_id, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line_no FROM documents)""")
def dense_id_1based(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    numbered = number_rows(lines.select("doc_id", F.col("line_no").cast("bigint").alias("line_no")), ["doc_id", "line_no"], "id", 1)
    return numbered


@query("balanced_sample", f"""WITH {LABELLED_PAGES}, {ATTEMPTS},
free AS (SELECT * FROM lp WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.url = lp.url)),
size AS (SELECT CASE WHEN count(*) = 2 THEN min(n) ELSE 0 END AS k FROM (SELECT count(*) AS n FROM free GROUP BY is_phishing)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY is_phishing ORDER BY md5('42:' || page_id)) AS rn FROM free)
SELECT page_id, url, is_phishing FROM ranked, size WHERE rn <= k""")
def balanced_sample(spark, sf):
    return sampling.balanced_sample(base.labelled_pages(spark, sf), "is_phishing", "page_id", _seen(spark, sf))


@query("balanced_sample_lines", f"""WITH {LABELLED_LINES},
size AS (SELECT min(n) AS k FROM (SELECT count(*) AS n FROM ll GROUP BY label)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY digest) AS rn FROM ll)
SELECT line_id, label FROM ranked, size WHERE rn <= k""")
def balanced_sample_lines(spark, sf):
    return sampling.balanced_sample(base.labelled_lines(spark, sf), "label", "line_id")


@query("sample_exact", f"WITH {LABELLED_LINES} SELECT line_id, l_quantity FROM ll ORDER BY digest LIMIT 1000")
def sample_exact(spark, sf):
    lines = base.labelled_lines(spark, sf, "l_quantity").drop("label")
    return sampling.sample_exact(lines, 1000, "line_id")


@query("union_samples", """SELECT url, is_phishing, page_id, CAST(NULL AS VARCHAR) AS host FROM (
  SELECT url, 1 AS is_phishing, page_id FROM pages WHERE url LIKE 'http://%' ORDER BY md5('42:' || page_id) LIMIT 20)
UNION ALL SELECT url, 0, CAST(NULL AS BIGINT), regexp_extract(url, '^https?://([^/?#:]+)', 1) FROM (
  SELECT url FROM pages WHERE url NOT LIKE 'http://%' ORDER BY md5('42:' || page_id) LIMIT 20)""")
def union_samples(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    bad = sampling.sample_exact(pages.where(F.col("url").startswith("http://")), 20, "page_id")
    good = sampling.sample_exact(pages.where(~F.col("url").startswith("http://")), 20, "page_id")
    return dedupe.union_samples(
        bad.select("url", F.lit(1).alias("is_phishing"), "page_id"),
        good.select("url", F.lit(0).alias("is_phishing"), text.url_host(F.col("url")).alias("host")),
    )


@query("shuffle", "SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id)) AS rn FROM documents")
def shuffle(spark, sf):
    return sampling.shuffle(table(spark, sf, "documents").select("doc_id"), "doc_id")


@query("class_quota_rank", f"""WITH {LABELLED_LINES}
SELECT line_id, label, row_number() OVER (PARTITION BY label ORDER BY digest) AS rn FROM ll""")
def class_quota_rank(spark, sf):
    return sampling.class_quota_rank(base.labelled_lines(spark, sf), "label", "line_id")


@query("assign_batches", """SELECT event_id,
  CAST(floor((row_number() OVER (ORDER BY md5('42:' || event_id)) - 1) / 200) AS BIGINT) AS batch FROM events""")
def assign_batches(spark, sf):
    return sampling.assign_batches(table(spark, sf, "events").select("event_id"), "event_id")


@query("assign_batches_bounded", """SELECT event_id,
  CAST(floor((row_number() OVER (ORDER BY md5('42:' || event_id)) - 1) / 50) AS BIGINT) AS batch FROM events
QUALIFY batch < 7""")
def assign_batches_bounded(spark, sf):
    return sampling.assign_batches(table(spark, sf, "events").select("event_id"), "event_id", 50, 7)


@query("class_filter", f"WITH {LABELLED_PAGES} SELECT page_id, url FROM lp WHERE is_phishing = 1")
def class_filter(spark, sf):
    return base.labelled_pages(spark, sf).where(F.col("is_phishing") == 1).select("page_id", "url")


@query("constant_label", """SELECT url, 1 AS is_phishing FROM pages WHERE url LIKE 'http://%'
UNION ALL SELECT url, 0 FROM pages WHERE url NOT LIKE 'http://%'""")
def constant_label(spark, sf):
    pages = table(spark, sf, "pages").select("url")
    bad = pages.where(F.col("url").startswith("http://")).withColumn("is_phishing", F.lit(1))
    return bad.unionByName(pages.where(~F.col("url").startswith("http://")).withColumn("is_phishing", F.lit(0)))


@query("class_distribution", f"""WITH {LABELLED_LINES}
SELECT label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM ll GROUP BY label""")
def class_distribution(spark, sf):
    return base.rounded(splits.class_distribution(base.labelled_lines(spark, sf), "label"), "share")


@query("minority_size", f"""WITH {LABELLED_LINES}
SELECT min(n) AS minority, 2 * min(n) AS balanced_total FROM (SELECT count(*) AS n FROM ll GROUP BY label)""")
def minority_size(spark, sf):
    return sampling.minority_size(base.labelled_lines(spark, sf), "label")


@query("balance_check", """SELECT lang AS split, count(*) = 2 AND min(n) = max(n) AS balanced FROM (
  SELECT d.lang, l.quality, count(*) AS n FROM labels l JOIN documents d ON d.doc_id = l.doc_id GROUP BY ALL) GROUP BY lang""")
def balance_check(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("split"))
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return splits.balance_check(labels.join(docs, "doc_id"), "split", "label")
