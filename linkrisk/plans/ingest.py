"""From landed feeds, domain lists and sitemaps to the two URL tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkrisk import schemas
from linkrisk.functions.ordering import number_rows
from linkrisk.operators import dedupe, sitemaps
from linkrisk.session import cut_lineage
from linkrisk.sources import feeds, tables

# Names and versions of the stored tables.
FEED_TABLE, FEED_VERSION = "phishing_urls", 2
RANKED_TABLE, RANKED_VERSION = "legit_domains", 1
PROGRESS_TABLE, PROGRESS_VERSION = "scan_progress_legit_urls", 4
LEGIT_TABLE, LEGIT_VERSION = "legit_urls_before_scan", 2


def load_feed(spark: SparkSession, root: str, base: str, manifest_path: str) -> DataFrame:
    """Merge the feed by URL. A known URL keeps its id, new ones are numbered behind the greatest id."""
    urls = feeds.read_url_feed(spark, base, feeds.read_manifest(spark, manifest_path))
    known = tables.get_table(spark, root, FEED_TABLE, FEED_VERSION)
    if known is not None:
        after = known.agg(F.coalesce(F.max("url_id") + 1, F.lit(0).cast("bigint"))).first()[0]
        old = known.select(F.col("url").alias("_url"), F.col("url_id").alias("_id"))
        matched = cut_lineage(urls.join(old, F.col("url") == F.col("_url"), "left").select(*urls.columns, "_id"))
        new = number_rows(matched.where("_id is null").drop("_id"), ["url_id"], "_new", after)
        kept = matched.where("_id is not null").withColumn("url_id", F.col("_id")).drop("_id")
        urls = kept.unionByName(new.withColumn("url_id", F.col("_new")).drop("_new"))
    return tables.upsert_table(urls, root, FEED_TABLE, "url", FEED_VERSION)


def load_ranked(spark: SparkSession, root: str, path: str) -> DataFrame:
    return tables.upsert_table(feeds.read_ranked_domains(spark, path), root, RANKED_TABLE, "domain", RANKED_VERSION)


def append_progress(new: DataFrame, current: DataFrame | None) -> DataFrame:
    """New progress rows and the known ones under each other."""
    return new if current is None else new.unionByName(current, allowMissingColumns=True)


def collect_new_domain_urls(
    spark: SparkSession, root: str, fetched: DataFrame, n: int | None = schemas.DOMAINS_PER_RUN, **limits: int | None
) -> DataFrame | None:
    """Expand the next n domains and add them to the progress table; no new domain, no write.

    ``limits`` are those of ``domain_pages``: cap, max_depth and max_children; None lifts a limit, n included.
    """
    ranked = tables.read_table(spark, root, RANKED_TABLE, RANKED_VERSION)
    current = tables.get_table(spark, root, PROGRESS_TABLE, PROGRESS_VERSION)
    done = ranked.select("domain").limit(0) if current is None else current
    todo = dedupe.new_domains(ranked, done)
    if todo.isEmpty():
        return current
    rows = sitemaps.collect_new_domains(ranked, done, fetched, n, **limits)
    merged = append_progress(rows, current)
    newest = dedupe.latest_by_key(merged, ["domain"], ["time_updated"])
    return tables.write_snapshot(newest, root, PROGRESS_TABLE, PROGRESS_VERSION)


def legit_urls(progress: DataFrame) -> DataFrame:
    """(is_phishing, url, id): one row per URL of every domain, ids from 1 in domain order."""
    rows = sitemaps.explode_domain_urls(progress)
    return number_rows(rows, ["domain", "pos"], "id", 1).select("is_phishing", "url", "id")


def ingest_urls(
    spark: SparkSession,
    root: str,
    feed_base: str,
    manifest_path: str,
    ranked_path: str,
    fetched: DataFrame,
    n: int | None = schemas.DOMAINS_PER_RUN,
    **limits: int | None,
) -> dict[str, DataFrame]:
    """All ingest steps one after the other, each with its stored table; limits as in ``collect_new_domain_urls``."""
    stored = {
        FEED_TABLE: load_feed(spark, root, feed_base, manifest_path),
        RANKED_TABLE: load_ranked(spark, root, ranked_path),
    }
    progress = collect_new_domain_urls(spark, root, fetched, n, **limits)
    if progress is not None:
        stored[PROGRESS_TABLE] = progress
        stored[LEGIT_TABLE] = tables.write_snapshot(legit_urls(progress), root, LEGIT_TABLE, LEGIT_VERSION)
    return stored
