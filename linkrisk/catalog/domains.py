"""Domains, sitemaps and URL lists. Every page plays one domain with its own sitemaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from linkrisk.catalog.base import query, table
from linkrisk.functions import text
from linkrisk.operators import sitemaps
from linkrisk.schemas import SITEMAP_NAMESPACE

DOMAINS = """d AS (SELECT page_id, url, 'p' || page_id || '.' || regexp_extract(url, '^https?://([^/?#:]+)', 1) AS domain FROM pages)"""

# What the landed sitemaps lead to, in document order and before the cap, by kind of domain (page_id % 4):
# 0 a page list, 1 an index with nested indexes and a missing child, 2 only errors, 3 no namespace, then a plain list.
FOUND = f"""{DOMAINS}, found AS (
  SELECT domain, page_id, 0 AS a, 0 AS b, url AS loc FROM d WHERE page_id % 4 IN (0, 3)
  UNION ALL SELECT domain, page_id, 1, i, 'https://' || domain || '/item/' || i || '?a=1&b=2'
    FROM (SELECT *, unnest(generate_series(1, page_id % 13)) AS i FROM d WHERE page_id % 4 = 0)
  UNION ALL SELECT domain, page_id, i, CAST(leaf = 'b' AS INTEGER), 'https://' || domain || '/' || i || '/' || leaf
    FROM (SELECT *, unnest(generate_series(0, least(page_id % 7, 4))) AS i FROM d WHERE page_id % 4 = 1), (VALUES ('a'), ('b')) AS l(leaf)
    WHERE i <> 1 AND NOT (i = 0 AND page_id % 3 = 0)
  UNION ALL SELECT domain, page_id, 1, 0, 'https://' || domain || '/deep' FROM d WHERE page_id % 4 = 1 AND page_id % 7 >= 1
  UNION ALL SELECT domain, page_id, 1, 0, ' https://' || domain || '/x ' FROM d WHERE page_id % 4 = 3)"""
CAPPED = f"""{FOUND}, capped AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY domain ORDER BY a, b) AS url_no FROM found) WHERE url_no <= 10)"""
LISTS = f"""{CAPPED}, lists AS (SELECT d.domain, coalesce(string_agg(loc, '|' ORDER BY url_no), '') AS urls, count(loc) AS n
  FROM d LEFT JOIN capped c ON c.domain = d.domain GROUP BY d.domain)"""


def domains(spark, sf) -> DataFrame:
    """(page_id, url, domain): one domain per page."""
    name = F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit("."), text.url_host(F.col("url")))
    return table(spark, sf, "pages").select("page_id", "url", name.alias("domain"))


def _escaped(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _xml(root: str, entry: str, locs: Column, namespace: bool = True) -> Column:
    declared = f' xmlns="{SITEMAP_NAMESPACE}"' if namespace else ""
    entries = F.transform(locs, lambda loc: F.concat(F.lit(f"<{entry}><loc>"), _escaped(loc), F.lit(f"</loc></{entry}>")))
    head = F.lit(f'<?xml version="1.0" encoding="UTF-8"?>\n<{root}{declared}>')
    return F.concat(head, F.array_join(entries, "\n"), F.lit(f"</{root}>"))


def fetched(spark, sf) -> DataFrame:
    """(url, status, body): the landed responses of all domains."""
    page_id, domain = F.col("page_id"), F.col("domain")

    def under(scheme: str, path: str) -> Column:
        return F.concat(F.lit(scheme), domain, F.lit(path))

    def response(rule: Column, url: Column, status: Column | int, body: Column) -> Column:
        code = F.lit(status) if isinstance(status, int) else status
        return F.when(rule, F.struct(url.alias("url"), code.cast("int").alias("status"), body.alias("body")))

    kind = page_id % 4
    items = F.transform(
        F.filter(F.sequence(F.lit(0), page_id % 13), lambda i: i > 0),
        lambda i: F.concat(under("https://", "/item/"), i.cast("string"), F.lit("?a=1&b=2")),
    )
    listed = F.concat(F.array(F.col("url")), items)
    part = lambda i: F.concat(under("https://", "/part-"), i.cast("string"), F.lit(".xml"))
    numbers = F.sequence(F.lit(0).cast("bigint"), page_id % 7)
    leaves = lambda i: F.array(
        *[F.concat(under("https://", "/"), i.cast("string"), F.lit(leaf)) for leaf in ("/a", "/b")]
    )
    deep = F.array(under("https://", "/deep.xml"))
    children = F.transform(
        numbers,
        lambda i: F.struct(
            part(i).alias("url"),
            F.when((i == 0) & (page_id % 3 == 0), 404).otherwise(200).alias("status"),
            F.when(i == 1, _xml("sitemapindex", "sitemap", deep)).otherwise(_xml("urlset", "url", leaves(i))).alias("body"),
        ),
    )
    single = F.array(
        response(kind == 0, under("https://", "/sitemap.xml"), 200, _xml("urlset", "url", listed)),
        response(kind == 1, under("https://www.", "/sitemap_index.xml"), 200, _xml("sitemapindex", "sitemap", F.transform(numbers, part))),
        response(kind == 1, under("https://", "/deep.xml"), 200, _xml("urlset", "url", F.array(under("https://", "/deep")))),
        response(kind == 2, under("https://", "/sitemap.xml"), 404, _xml("urlset", "url", listed)),
        response(kind == 2, under("http://", "/sitemap.xml"), 200, F.lit("<urlset><url><loc>cut off")),
        response(kind == 3, under("https://", "/sitemap"), 200, _xml("urlset", "url", listed, namespace=False)),
        response(
            kind == 3,
            under("http://www.", "/sitemap.xml"),
            200,
            _xml("urlset", "url", F.array(F.col("url"), F.concat(F.lit(" "), under("https://", "/x "))))
        ),
    )
    landed = F.filter(single, lambda r: r.isNotNull())
    nested = F.when(kind == 1, children).otherwise(F.filter(children, lambda r: F.lit(False)))
    return domains(spark, sf).select(F.inline(F.concat(landed, nested)))


@query("normalize_domain", """SELECT page_id, rtrim(replace(replace(url, 'http://', ''), 'https://', ''), '/') AS domain FROM pages""")
def normalize_domain(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.normalize_domain(F.col("url")).alias("domain"))


@query("www_variants", """SELECT page_id, host AS first, CASE WHEN starts_with(host, 'www.') THEN substr(host, 5) ELSE 'www.' || host END AS second
FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'www.' ELSE '' END || regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host FROM pages)""")
def www_variants(spark, sf):
    host = F.concat(F.when(F.col("page_id") % 3 == 0, "www.").otherwise(""), text.url_host(F.col("url")))
    both = text.www_variants(F.col("host"))
    pages = table(spark, sf, "pages").select("page_id", host.alias("host"))
    return pages.select("page_id", both[0].alias("first"), both[1].alias("second"))


CANDIDATES = f"""{DOMAINS}, candidates AS (
  SELECT domain, v.no * 4 + c.no AS candidate_no, c.scheme || v.prefix || domain || c.path AS url
  FROM d, (VALUES (0, ''), (1, 'www.')) AS v(no, prefix),
  (VALUES (0, 'https://', '/sitemap.xml'), (1, 'https://', '/sitemap_index.xml'), (2, 'https://', '/sitemap'), (3, 'http://', '/sitemap.xml'))
    AS c(no, scheme, path))"""


@query("sitemap_candidates", f"WITH {CANDIDATES} SELECT * FROM candidates")
def sitemap_candidates(spark, sf):
    return sitemaps.sitemap_candidates(domains(spark, sf))


@query("sitemap_lookup", f"""WITH {DOMAINS}
SELECT domain, [0, 5, 3, 2][CAST(page_id % 4 + 1 AS INTEGER)] AS candidate_no FROM d
UNION ALL SELECT domain, 7 FROM d WHERE page_id % 4 = 3""")
def sitemap_lookup(spark, sf):
    found = sitemaps.sitemap_lookup(sitemaps.sitemap_candidates(domains(spark, sf)), fetched(spark, sf))
    return found.select("domain", "candidate_no")


@query("sitemap_locs", f"""WITH {FOUND} SELECT domain, loc FROM found WHERE page_id % 4 IN (0, 3)""")
def sitemap_locs(spark, sf):
    plain = domains(spark, sf).where(F.col("page_id") % 4 != 1)
    bodies = sitemaps.sitemap_lookup(sitemaps.sitemap_candidates(plain), fetched(spark, sf))
    locs = sitemaps.page_locs(sitemaps.sitemap_document(F.col("body")))
    return bodies.select("domain", F.explode(locs).alias("loc"))


@query("sitemap_index_locs", f"""WITH {DOMAINS} SELECT domain, 'https://' || domain || '/part-' || i || '.xml' AS loc
FROM (SELECT *, unnest(generate_series(0, least(page_id % 7, 4))) AS i FROM d WHERE page_id % 4 = 1)""")
def sitemap_index_locs(spark, sf):
    roots = sitemaps.sitemap_lookup(sitemaps.sitemap_candidates(domains(spark, sf)), fetched(spark, sf))
    locs = sitemaps.child_locs(sitemaps.sitemap_document(F.col("body")))
    return roots.select("domain", F.explode(locs).alias("loc"))


@query("sitemap_index_expand", f"WITH {FOUND} SELECT domain, loc FROM found")
def sitemap_index_expand(spark, sf):
    candidates = sitemaps.sitemap_candidates(domains(spark, sf))
    return sitemaps.sitemap_index_expand(candidates, fetched(spark, sf)).select("domain", "loc")


@query("cap_urls_per_domain", f"WITH {CAPPED} SELECT domain, loc AS url, CAST(url_no AS INTEGER) AS url_no FROM capped")
def cap_urls_per_domain(spark, sf):
    return sitemaps.domain_pages(domains(spark, sf), fetched(spark, sf))


@query("cap_urls_per_domain_none", f"WITH {FOUND} SELECT domain, loc AS url FROM found")
def cap_urls_per_domain_none(spark, sf):
    return sitemaps.domain_pages(domains(spark, sf), fetched(spark, sf), cap=None).select("domain", "url")


@query("urls_per_domain", f"WITH {LISTS} SELECT * FROM lists")
def urls_per_domain(spark, sf):
    pages = sitemaps.domain_pages(domains(spark, sf), fetched(spark, sf))
    lists = sitemaps.urls_per_domain(domains(spark, sf), pages)
    return lists.select("domain", F.array_join("urls", "|").alias("urls"), F.size("urls").cast("bigint").alias("n"))


@query("extract_urls_from_domains", f"WITH {LISTS} SELECT domain, urls FROM lists")
def extract_urls_from_domains(spark, sf):
    lists = sitemaps.extract_urls_from_domains(domains(spark, sf), fetched(spark, sf))
    return lists.select("domain", F.array_join("urls", "|").alias("urls"))


@query("default_home_url", f"""WITH {LISTS}
SELECT domain, CASE WHEN n = 0 THEN 'https://' || domain ELSE urls END AS urls FROM lists""")
def default_home_url(spark, sf):
    lists = sitemaps.extract_urls_from_domains(domains(spark, sf), fetched(spark, sf))
    filled = text.home_url_if_none(F.col("domain"), F.col("urls"))
    return lists.select("domain", F.array_join(filled, "|").alias("urls"))


# Progress rows whose URL list is text: two URLs, mixed quotes, an empty list, or something unreadable.
LIST_TEXT = f"""{DOMAINS}, progress AS (SELECT domain, url, page_id, CASE page_id % 4
  WHEN 0 THEN '[''' || url || ''', ''https://' || domain || ''']' WHEN 1 THEN '["' || url || '", ''b'']'
  WHEN 2 THEN '[]' ELSE 'no list: ' || url END AS urls FROM d)"""
EXPLODED = f"""{LIST_TEXT}, exploded AS (
  SELECT domain, 0 AS pos, url FROM progress WHERE page_id % 4 IN (0, 1)
  UNION ALL SELECT domain, 1, CASE WHEN page_id % 4 = 0 THEN 'https://' || domain ELSE 'b' END FROM progress WHERE page_id % 4 IN (0, 1))"""


def progress_text(spark, sf) -> DataFrame:
    url, domain, kind = F.col("url"), F.col("domain"), F.col("page_id") % 4
    written = (
        F.when(kind == 0, F.concat(F.lit("['"), url, F.lit("', 'https://"), domain, F.lit("']")))
        .when(kind == 1, F.concat(F.lit('["'), url, F.lit("\", 'b']")))
        .when(kind == 2, "[]")
        .otherwise(F.concat(F.lit("no list: "), url))
    )
    return domains(spark, sf).select("domain", written.alias("urls"))


@query("parse_url_list", f"""WITH {EXPLODED} SELECT p.domain, string_agg(e.url, '|' ORDER BY pos) AS urls, p.page_id % 4 <> 3 AS readable
FROM progress p LEFT JOIN exploded e ON e.domain = p.domain GROUP BY ALL""")
def parse_url_list(spark, sf):
    parsed = progress_text(spark, sf).withColumn("parsed", text.parse_url_list(F.col("urls")))
    joined = F.nullif(F.array_join("parsed", "|"), F.lit(""))
    return parsed.select("domain", joined.alias("urls"), F.col("parsed").isNotNull().alias("readable"))


@query("skip_empty_url_lists", f"WITH {LIST_TEXT} SELECT domain FROM progress WHERE page_id % 4 IN (0, 1)")
def skip_empty_url_lists(spark, sf):
    return sitemaps.skip_empty_url_lists(progress_text(spark, sf)).select("domain")


@query("explode_domain_urls", f"WITH {EXPLODED} SELECT domain, pos, url, 0 AS is_phishing FROM exploded")
def explode_domain_urls(spark, sf):
    return sitemaps.explode_domain_urls(progress_text(spark, sf))


@query("clean_utf8", "SELECT doc_id, chr(65533) || text || 'ab' AS cleaned FROM documents")
def clean_utf8(spark, sf):
    broken = F.concat(F.encode(F.concat(F.lit("\ufffd"), "text"), "UTF-8"), F.lit("a").cast("binary"), F.unhex(F.lit("FF")), F.lit("b").cast("binary"))
    return table(spark, sf, "documents").select("doc_id", text.clean_utf8(broken).alias("cleaned"))
