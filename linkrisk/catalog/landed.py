"""Text feeds and stored tables: files are first written by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkrisk.catalog import base
from linkrisk.catalog.base import ATTEMPTS, LABELLED_PAGES, query, table
from linkrisk.functions import text
from linkrisk.operators import dedupe
from linkrisk.operators.ledger import ledger_rows
from linkrisk.plans.ingest import append_progress
from linkrisk.session import scratch_path
from linkrisk.sources import feeds, tables

# Lines of the feed: the URL, a blank line, the URL under another scheme, and the URL again.
FEED_LINES = """feed AS (SELECT page_id, line_no, line FROM (
  SELECT page_id, unnest([0, 1, 2, 3]) AS line_no,
    unnest([url, '  ', replace(replace(url, 'https://', 'ftp://'), 'http://', 'HTTP://'), url]) AS line FROM pages))"""


def write_lines(lines: DataFrame, order: list[str], path: str) -> str:
    """Text files whose names and lines follow the given order."""
    ranged = lines.repartitionByRange(4, *order).sortWithinPartitions(*order)
    ranged.select("line").write.text(path)
    return path


def write_feed(spark, sf) -> tuple[str, str]:
    """A feed folder and its manifest, which repeats names and has a blank line."""
    url = F.col("url")
    other = F.replace(F.replace(url, F.lit("https://"), F.lit("ftp://")), F.lit("http://"), F.lit("HTTP://"))
    lines = table(spark, sf, "pages").select(
        "page_id", F.posexplode(F.array(url, F.lit("  "), other, url)).alias("line_no", "line")
    )
    folder = write_lines(lines, ["page_id", "line_no"], scratch_path(spark, "feed"))
    names = spark.read.text(folder).select(F.col("_metadata.file_name").alias("line")).distinct()
    listed = names.select("line", F.explode(F.array(F.lit(0), F.lit(1))).alias("round"))
    blank = spark.range(1).select(F.lit(" \t").alias("line"), F.lit(0).alias("round"))
    manifest = listed.unionByName(blank).orderBy("round", "line").select("line").coalesce(1)
    path = scratch_path(spark, "manifest")
    manifest.write.text(path)
    return folder, path


@query("read_manifest", """SELECT file_no, CAST(NULL AS VARCHAR) AS missing FROM (
  SELECT unnest(generate_series(0, (SELECT least(4, count(*)) FROM pages) - 1)) AS file_no)""")
def read_manifest(spark, sf):
    _, manifest = write_feed(spark, sf)
    listed = feeds.read_manifest(spark, manifest)
    unreadable = F.when(~F.col("file_name").rlike(r"^part-\d{5}-.*\.txt$"), F.col("file_name"))
    return listed.select("file_no", unreadable.alias("missing"))


@query("read_url_feed", """SELECT row_number() OVER (ORDER BY page_id) - 1 AS url_id, url, 1 AS is_phishing
FROM (SELECT url, min(page_id) AS page_id FROM pages WHERE url LIKE 'http://%' OR url LIKE 'https://%' GROUP BY url)""")
def read_url_feed(spark, sf):
    folder, manifest = write_feed(spark, sf)
    return feeds.read_url_feed(spark, folder, feeds.read_manifest(spark, manifest))


@query("read_ranked_domains", """SELECT regexp_extract(url, '^https?://([^/?#:]+)', 1) AS domain,
  CAST(max(page_id) AS INTEGER) AS rank FROM pages GROUP BY 1""")
def read_ranked_domains(spark, sf):
    line = F.concat_ws(",", F.col("page_id").cast("string"), text.url_host(F.col("url"))).alias("line")
    path = write_lines(table(spark, sf, "pages").select("page_id", line), ["page_id"], scratch_path(spark, "ranked"))
    return feeds.read_ranked_domains(spark, path)


@query("nonblank_lines", r"""SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE regexp_matches(line, '[^\s\x0B\x1C-\x1F\x{85}\pZ]')""")
def nonblank_lines(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    return lines.where(text.is_nonblank(F.col("line")))


@query("http_scheme_filter", f"""WITH {FEED_LINES} SELECT page_id, line_no, line FROM feed
WHERE line LIKE 'http://%' OR line LIKE 'https://%'""")
def http_scheme_filter(spark, sf):
    url = F.col("url")
    other = F.replace(F.replace(url, F.lit("https://"), F.lit("ftp://")), F.lit("http://"), F.lit("HTTP://"))
    lines = table(spark, sf, "pages").select(
        "page_id", F.posexplode(F.array(url, F.lit("  "), other, url)).alias("line_no", "line")
    )
    return lines.where(text.has_http_scheme(F.col("line")))


@query("read_table", f"WITH {LABELLED_PAGES} SELECT * FROM lp")
def read_table(spark, sf):
    root = scratch_path(spark, "tables")
    tables.write_snapshot(base.labelled_pages(spark, sf), root, "labelled_pages", 2)
    return tables.read_table(spark, root, "labelled_pages", 2)


@query("upsert_table", """SELECT user_id, value, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def upsert_table(spark, sf):
    """The last event of every user, merged from one delivery for each type of event."""
    root = scratch_path(spark, "tables")
    events = table(spark, sf, "events").select("user_id", "value", "event_id", "event_type")
    for kind in ("view", "click", "purchase", "signup", "error"):
        stored = tables.upsert_table(events.where(F.col("event_type") == kind), root, "last_event", "user_id", event_time="event_id")
    return stored


PROGRESS = """hosts AS (SELECT regexp_extract(url, '^https?://([^/?#:]+)', 1) AS domain, max(page_id) AS page_id, count(*) AS n FROM pages GROUP BY 1)"""


@query("append_progress", f"""WITH {PROGRESS} SELECT domain, 'https://' || domain AS url, CAST(NULL AS BIGINT) AS n FROM hosts WHERE page_id % 2 = 0
UNION ALL SELECT domain, 'https://' || domain, n FROM hosts""")
def append_progress_query(spark, sf):
    hosts = table(spark, sf, "pages").groupBy(text.url_host(F.col("url")).alias("domain")).agg(
        F.max("page_id").alias("page_id"), F.count("*").alias("n")
    )
    home = F.concat(F.lit("https://"), F.col("domain")).alias("url")
    new = hosts.where(F.col("page_id") % 2 == 0).select("domain", home)
    return append_progress(new, hosts.select("domain", home, "n"))


@query("append_attempts", f"""WITH {ATTEMPTS}, ledger AS (
  SELECT url, 'success' AS status, 1 AS batch FROM success UNION ALL SELECT url, 'failed_permanent', 2 FROM attempts)
SELECT url, arg_max(status, batch) AS status FROM ledger GROUP BY url""")
def append_attempts(spark, sf):
    root = scratch_path(spark, "tables")
    for batch, (kind, status) in enumerate([("purchase", "success"), ("error", "failed_permanent")], 1):
        attempts = base.attempted(spark, sf, kind).withColumn("status", F.lit(status))
        for _ in range(batch):  # the second batch is delivered twice
            tables.write_batch(ledger_rows(attempts), root, "attempted_scans", batch)
    ledger = tables.read_table(spark, root, "attempted_scans")
    return dedupe.latest_by_key(ledger, ["url"], ["batch"]).select("url", "status")


@query("get_table", f"WITH {LABELLED_PAGES} SELECT *, true AS other_is_absent FROM lp")
def get_table(spark, sf):
    root = scratch_path(spark, "tables")
    tables.write_snapshot(base.labelled_pages(spark, sf), root, "labelled_pages")
    absent = tables.get_table(spark, root, "labelled_pages", 2) is None
    return tables.get_table(spark, root, "labelled_pages").withColumn("other_is_absent", F.lit(absent))


@query("feature_view", f"WITH {LABELLED_PAGES} SELECT url, is_phishing FROM lp")
def feature_view(spark, sf):
    tables.feature_view(base.labelled_pages(spark, sf), "page_view", ["url"], ["is_phishing"])
    return spark.table("page_view")


@query("detect_url_column", "SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN 'phishing_url' ELSE 'url' END AS found FROM pages")
def detect_url_column(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    sources = [
        pages.where(F.col("page_id") % 2 == 0).withColumnRenamed("url", "phishing_url"),
        pages.where(F.col("page_id") % 2 == 1),
    ]
    named = [s.select("page_id", F.col(dedupe.url_column(s)).alias("url"), F.lit(dedupe.url_column(s)).alias("found")) for s in sources]
    return named[0].unionByName(named[1])


@query("require_table_column", f"WITH {ATTEMPTS} SELECT DISTINCT url FROM attempts")
def require_table_column(spark, sf):
    root = scratch_path(spark, "tables")
    without_url = table(spark, sf, "lineitem").select("l_orderkey")
    return dedupe.seen_urls(without_url, base.attempted(spark, sf, "error"), tables.get_table(spark, root, "nothing"))


@query("iso_timestamp", """SELECT event_id, replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') AS ts_text FROM events""")
def iso_timestamp(spark, sf):
    return table(spark, sf, "events").select("event_id", text.iso_timestamp(F.col("ts")).alias("ts_text"))
