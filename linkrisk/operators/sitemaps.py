"""Domains to URLs: sitemap candidates joined with landed responses.

``fetched(url, status, body)`` stands for the web: one row per address that was
retrieved. Expanding a domain is then an equi-join per level of sitemap indexes.
"""

from __future__ import annotations

from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from linkrisk import schemas
from linkrisk.functions import text
from linkrisk.operators.dedupe import new_domains
from linkrisk.session import write_scratch

_URL, _SITEMAP, _LOC = (f"{{{schemas.SITEMAP_NAMESPACE}}}{name}" for name in ("url", "sitemap", "loc"))
_DOCUMENT = StructType([StructField(name, ArrayType(StringType())) for name in ("pages", "children")])


def _locs(body: str | None) -> tuple[list[str], list[str]] | None:
    """Addresses of the page entries and of the index entries, empty ones included; None if this is no XML."""
    try:
        root = ElementTree.fromstring(body or "")
    except (ElementTree.ParseError, ValueError):
        return None
    return tuple([loc.text or "" for entry in root.iter(tag) for loc in entry.findall(_LOC)] for tag in (_URL, _SITEMAP))


@F.pandas_udf(_DOCUMENT)
def sitemap_document(body: pd.Series) -> pd.DataFrame:
    """Struct of the page and child-sitemap addresses of a document, in document order.

    Entries count at any depth and below any root, if they are in the sitemaps.org namespace.
    Spark's XML columns read a fixed path only, hence the tree search. What is no XML gives nulls.
    """
    return pd.DataFrame([_locs(text) or (None, None) for text in body], columns=["pages", "children"])


def _filled(locs: Column) -> Column:
    return F.filter(locs, lambda loc: loc != "")


def page_locs(document: Column) -> Column:
    """Page addresses in document order, each once, white space kept."""
    return F.coalesce(F.array_distinct(_filled(document["pages"])), F.array().cast("array<string>"))


def child_locs(document: Column, max_children: int | None = schemas.MAX_INDEX_CHILDREN) -> Column:
    """Child sitemaps among the first ``max_children`` entries of an index; None takes all."""
    entries = document["children"] if max_children is None else F.slice(document["children"], 1, max_children)
    return F.coalesce(_filled(entries), F.array().cast("array<string>"))


def sitemap_candidates(domains: DataFrame) -> DataFrame:
    """(domain, candidate_no, url): where to look for the sitemap of every domain."""
    return domains.select("domain", F.posexplode(text.sitemap_candidates(F.col("domain"))).alias("candidate_no", "url"))


def _answered(fetched: DataFrame) -> DataFrame:
    return fetched.where(F.col("status") == 200).select(F.col("url").alias("_url"), "body")


def sitemap_lookup(candidates: DataFrame, fetched: DataFrame) -> DataFrame:
    """Candidates that answered with status 200, with the body they returned."""
    answered = _answered(fetched)
    return candidates.join(answered, F.col("url") == F.col("_url")).drop("_url")


def parse_responses(fetched: DataFrame, max_children: int | None = schemas.MAX_INDEX_CHILDREN) -> DataFrame:
    """(url, pages, children) of all answered responses.

    A filter on the lists would be pushed below the parse and repeat it, so empty
    ones are left to the readers of the written table.
    """
    answered = _answered(fetched).select(F.col("_url").alias("url"), sitemap_document(F.col("body")).alias("doc"))
    return answered.select(
        "url", page_locs(F.col("doc")).alias("pages"), child_locs(F.col("doc"), max_children).alias("children")
    )


def sitemap_index_expand(
    candidates: DataFrame,
    fetched: DataFrame,
    max_depth: int | None = schemas.MAX_INDEX_DEPTH,
    max_children: int | None = schemas.MAX_INDEX_CHILDREN,
) -> DataFrame:
    """Page addresses below all sitemaps of a domain: (domain, place, pos, loc).

    ``place`` is the candidate number followed by the child numbers on the way
    down; (place, pos) is document order. Children of an index come before the
    page entries of the index itself. Without a depth limit each sitemap of a domain
    is opened once, at its first level, so indexes that name each other end.

    Each level joins the addresses it reaches with the landed responses, and only
    the bodies of these are carried on and parsed; an empty level ends the way down.
    """
    level = candidates.select("domain", F.array("candidate_no").alias("place"), "url")
    opened, found, depth = None, None, 0
    while True:
        addresses = level.select("url").distinct()
        reached = fetched.join(addresses, "url", "left_semi")
        parsed = write_scratch(parse_responses(reached, max_children), "sitemaps")
        here = write_scratch(level.join(parsed, "url"), "sitemap-level")
        last = F.lit((1 << 31) - 1)
        pages = here.select("domain", F.concat("place", F.array(last)).alias("place"), F.posexplode("pages").alias("pos", "loc"))
        found = pages if found is None else found.unionByName(pages)
        if max_depth is not None and depth == max_depth:
            return found
        entries = here.select("domain", "place", F.posexplode("children").alias("no", "url"))
        level = entries.groupBy("domain", "url").agg(F.min(F.concat("place", F.array("no"))).alias("place"))
        if max_depth is None:
            done = here.select("domain", "url")
            opened = write_scratch(done if opened is None else opened.unionByName(done), "sitemap-opened")
            level = level.join(opened, ["domain", "url"], "left_anti")
        level = write_scratch(level, "sitemap-entries")
        if level.isEmpty():
            return found
        depth += 1


def cap_urls_per_domain(locs: DataFrame, cap: int | None) -> DataFrame:
    """The first ``cap`` distinct addresses of every domain, numbered from 1; 0 or None keeps all.

    Copies collapse on the map side, and Spark trims every partition to the cap
    before the shuffle, so a domain with most of the pages costs no more.
    """
    first = locs.groupBy("domain", F.col("loc").alias("url")).agg(F.min(F.struct("place", "pos")).alias("_at"))
    if not cap:
        return first.select("domain", "url", F.col("_at.place").alias("place"), F.col("_at.pos").alias("pos"))
    ordered = Window.partitionBy("domain").orderBy("_at", "url")
    ranked = first.withColumn("url_no", F.row_number().over(ordered)).where(F.col("url_no") <= cap)
    return ranked.select("domain", "url", "url_no")


def domain_pages(
    domains: DataFrame,
    fetched: DataFrame,
    cap: int | None = schemas.URLS_PER_DOMAIN,
    max_depth: int | None = schemas.MAX_INDEX_DEPTH,
    max_children: int | None = schemas.MAX_INDEX_CHILDREN,
) -> DataFrame:
    """(domain, url, ...) for all domains whose sitemaps answered."""
    found = sitemap_index_expand(sitemap_candidates(domains), fetched, max_depth, max_children)
    return cap_urls_per_domain(found, cap)


def urls_per_domain(domains: DataFrame, pages: DataFrame) -> DataFrame:
    """(domain, urls): pages as an array in order, empty for domains without any.

    Takes the output of ``cap_urls_per_domain``. A cap bounds the arrays; without one a domain's
    addresses must fit in a row, else keep them one per row as ``domain_pages`` gives them.
    """
    order = ["url_no"] if "url_no" in pages.columns else ["place", "pos"]
    entries = F.array_sort(F.collect_list(F.struct(*order, "url")))
    lists = pages.groupBy("domain").agg(F.transform(entries, lambda e: e["url"]).alias("urls"))
    empty = F.array().cast("array<string>")
    return domains.select("domain").join(lists, "domain", "left").withColumn("urls", F.coalesce("urls", empty))


def extract_urls_from_domains(
    domains: DataFrame, fetched: DataFrame, cap: int | None = schemas.URLS_PER_DOMAIN, **limits: int | None
) -> DataFrame:
    """(domain, urls) from candidates, index expansion, page entries and cap; limits as in ``domain_pages``."""
    return urls_per_domain(domains, domain_pages(domains, fetched, cap, **limits))


def explode_domain_urls(progress: DataFrame, urls: str = "urls") -> DataFrame:
    """(domain, pos, url, is_phishing) with label 0; empty and unreadable lists give no rows.

    Addresses that occur under several domains are all kept.
    """
    column = F.col(urls)
    if progress.schema[urls].dataType.typeName() == "string":
        column = text.parse_url_list(column)
    return progress.select("domain", F.posexplode(column).alias("pos", "url"), F.lit(0).alias("is_phishing"))


def skip_empty_url_lists(progress: DataFrame, urls: str = "urls") -> DataFrame:
    """Rows whose list text can be read and has entries."""
    return progress.where(F.size(text.parse_url_list(F.col(urls))) > 0)


def collect_new_domains(
    ranked: DataFrame, processed: DataFrame, fetched: DataFrame, n: int | None, cap: int | None = schemas.URLS_PER_DOMAIN, **limits: int | None
) -> DataFrame:
    """Progress rows (domain, time_updated, urls) of the n best-ranked unprocessed domains, or of all with None."""
    todo = new_domains(ranked, processed)
    if n is not None:
        todo = todo.orderBy(F.col("rank").asc_nulls_last(), "domain").limit(n)
    lists = extract_urls_from_domains(write_scratch(todo, "todo"), fetched, cap, **limits)
    return lists.select(
        "domain",
        F.current_timestamp().alias("time_updated"),
        text.home_url_if_none(F.col("domain"), F.col("urls")).alias("urls"),
    )
