"""End-to-end runs: ingest, scan rounds and training."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkrisk.catalog import base, domains as domain_queries, landed, splitting
from linkrisk.catalog.base import LABELLED_PAGES, query, table
from linkrisk.catalog.learning import LIGHT
from linkrisk.operators import models
from linkrisk.plans import ingest, scanning, training
from linkrisk.session import cut_lineage, scratch_path
from linkrisk.sources import tables
from linkrisk.streaming import incremental

# --- ingest ----------------------------------------------------------------------------------

PROGRESS_URLS = f"""{domain_queries.LISTS}, ranked AS (SELECT page_id AS rank, domain FROM d),
next AS (SELECT domain FROM ranked ORDER BY rank, domain LIMIT 50),
filled AS (SELECT l.domain, CASE WHEN l.n = 0 THEN 'https://' || l.domain ELSE l.urls END AS urls
  FROM lists l JOIN next ON next.domain = l.domain)"""


def _write_ranked(spark, sf) -> str:
    line = F.concat_ws(",", F.col("page_id").cast("string"), F.col("domain")).alias("line")
    rows = domain_queries.domains(spark, sf).select("page_id", line)
    return landed.write_lines(rows, ["page_id"], scratch_path(spark, "ranked"))


@query("ingest_urls", f"""WITH {PROGRESS_URLS}, one AS (SELECT domain, unnest(range(len(string_split(urls, '|')))) AS pos,
  unnest(string_split(urls, '|')) AS url FROM filled)
SELECT 0 AS is_phishing, url, row_number() OVER (ORDER BY domain, pos) AS id FROM one
UNION ALL SELECT 1, url, row_number() OVER (ORDER BY page_id) - 1 FROM pages""")
def ingest_urls(spark, sf):
    folder, manifest = landed.write_feed(spark, sf)
    root = scratch_path(spark, "tables")
    fetched = domain_queries.fetched(spark, sf)
    stored = ingest.ingest_urls(spark, root, folder, manifest, _write_ranked(spark, sf), fetched)
    feed = stored[ingest.FEED_TABLE].select("is_phishing", "url", F.col("url_id").alias("id"))
    return stored[ingest.LEGIT_TABLE].unionByName(feed)


@query("collect_new_domain_urls", f"""WITH {PROGRESS_URLS.replace("FROM d),", "FROM d WHERE page_id % 5 <> 0),", 1)}
SELECT domain, urls FROM filled UNION ALL SELECT domain, 'https://' || domain FROM d WHERE page_id % 5 = 0""")
def collect_new_domain_urls(spark, sf):
    root = scratch_path(spark, "tables")
    all_domains = domain_queries.domains(spark, sf)
    ranked = all_domains.select("domain", F.col("page_id").cast("int").alias("rank"))
    tables.write_snapshot(ranked, root, ingest.RANKED_TABLE, ingest.RANKED_VERSION)
    home = F.array(F.concat(F.lit("https://"), F.col("domain")))
    done = all_domains.where(F.col("page_id") % 5 == 0).select(
        "domain", F.current_timestamp().alias("time_updated"), home.alias("urls")
    )
    tables.write_snapshot(done, root, ingest.PROGRESS_TABLE, ingest.PROGRESS_VERSION)
    progress = ingest.collect_new_domain_urls(spark, root, domain_queries.fetched(spark, sf))
    return progress.select("domain", F.array_join("urls", "|").alias("urls"))


# --- scan rounds -------------------------------------------------------------------------------

# Answers to every page: some are refused, some fail for good, some never come.
ANSWERS = f"""{LABELLED_PAGES}, answers AS (SELECT *, CASE WHEN page_id % 17 = 0 THEN 'failed_permanent' WHEN page_id % 23 = 0 THEN NULL
  WHEN page_id % 19 = 0 THEN 'failed_permanent' ELSE 'success' END AS status FROM lp)"""


def _sampled(source: str, name: str) -> str:
    return f"""{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY is_phishing ORDER BY md5('42:' || page_id)) AS rn FROM {source})
  WHERE rn <= least(10, (SELECT CASE WHEN count(*) = 2 THEN min(n) ELSE 0 END FROM (SELECT count(*) AS n FROM {source} GROUP BY is_phishing))))"""


ROUNDS = f"""{ANSWERS}, {_sampled("answers", "first_round")},
left_over AS (SELECT * EXCLUDE (status), status FROM answers WHERE page_id NOT IN (SELECT page_id FROM first_round WHERE status IS NOT NULL)),
{_sampled("left_over", "second_round")}"""


def _answers(spark, sf) -> tuple[DataFrame, DataFrame]:
    page_id = F.col("page_id")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    docs = base.scan_documents(spark, sf).join(table(spark, sf, "pages").select("page_id", "url"), "page_id")
    sent = docs.select(
        F.md5("url").alias("uuid"), "url", start.alias("submit_ts"), F.when(page_id % 17 == 0, "Bad request").alias("submit_error")
    )
    answered = docs.where((page_id % 17 != 0) & (page_id % 23 != 0)).select(
        F.md5("url").alias("uuid"),
        (start + F.make_dt_interval(secs=F.lit(40))).alias("response_ts"),
        (page_id % 19 != 0).alias("ok"),
        F.when(page_id % 19 == 0, "domain unreachable").alias("message"),
        F.when(page_id % 19 != 0, F.col("document")).alias("document"),
    )
    return sent, answered


def _two_rounds(spark, sf) -> str:
    root = scratch_path(spark, "tables")
    sent, answered = _answers(spark, sf)
    candidates = base.labelled_pages(spark, sf)
    for round_no in range(2):
        scanning.scan_round(candidates, "page_id", sent, answered, root, round_no, sample_size=10)
    return root


@query("scan_round", f"""WITH {ANSWERS}, size AS (SELECT min(n) AS k FROM (SELECT count(*) AS n FROM answers GROUP BY is_phishing)),
sampled AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY is_phishing ORDER BY md5('42:' || page_id)) AS rn FROM answers), size WHERE rn <= k),
batched AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY md5('42:' || page_id)) - 1) / 20) AS BIGINT) AS batch FROM sampled)
SELECT batch, count(*) FILTER (page_id % 17 <> 0) AS submitted, count(*) FILTER (status = 'success') AS retrieved,
  count(*) FILTER (status = 'failed_permanent') AS permanent, count(*) FILTER (status IS NULL) AS timed_out FROM batched GROUP BY batch""")
def scan_round(spark, sf):
    sent, answered = _answers(spark, sf)
    return scanning.scan_round(
        base.labelled_pages(spark, sf), "page_id", sent, answered, scratch_path(spark, "tables"), batch_size=20
    )


@query("scan_rounds_ledger", f"""WITH {ROUNDS} SELECT url, status, 0 AS batch FROM first_round WHERE status IS NOT NULL
UNION ALL SELECT url, status, 1 FROM second_round WHERE status IS NOT NULL""")
def scan_rounds_ledger(spark, sf):
    root = _two_rounds(spark, sf)
    return tables.read_table(spark, root, incremental.LEDGER_TABLE).select("url", "status", "batch")


@query("scan_rounds_features", f"""WITH {ROUNDS}, {base.SCANS}, {base.FEATURE_ROWS}
SELECT {", ".join("f." + c.strip() for c in base.FEATURE_LIST.split(","))}, f.url, f.scan_uuid, r.is_phishing FROM feats f JOIN (
  SELECT * EXCLUDE (rn) FROM first_round UNION ALL SELECT * EXCLUDE (rn) FROM second_round) r ON r.page_id = f.page_id WHERE r.status = 'success'""")
def scan_rounds_features(spark, sf):
    return incremental.read_features(spark, _two_rounds(spark, sf))


# --- training ----------------------------------------------------------------------------------


def _rows(spark, sf) -> DataFrame:
    return cut_lineage(splitting.feature_rows(spark, sf))


@query("train_single")
def train_single(spark, sf):
    return training.train_single(_rows(spark, sf), "page_id", models.FOREST, LIGHT[models.FOREST]).metrics


@query("select_model")
def select_model(spark, sf):
    names = [models.LOGISTIC, models.FOREST, models.BAYES]
    grids = {models.LOGISTIC: {"C": [0.1, 1.0]}, models.FOREST: {"numTrees": [10], "maxDepth": [3, 5]}}
    run = training.select_model(_rows(spark, sf), "page_id", names, LIGHT, grids, folds=2)
    return run.metrics


@query("train_final")
def train_final(spark, sf):
    grid = {"C": [0.1, 1.0, 10.0], "maxIter": [100]}
    root = scratch_path(spark, "models")
    return training.train_final(_rows(spark, sf), "page_id", models.LOGISTIC, 3, 2, grid, root).summary
