"""Sitemap parsing, index expansion and caps on literal responses."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linkrisk.operators import sitemaps
from linkrisk.schemas import SITEMAP_NAMESPACE as NS


def urlset(*locs, ns=f' xmlns="{NS}"', prefix=""):
    entries = "".join(f"<{prefix}url><{prefix}loc>{loc}</{prefix}loc></{prefix}url>" for loc in locs)
    return f'<?xml version="1.0"?><{prefix}urlset{ns}>{entries}</{prefix}urlset>'


def index(*locs, extra=""):
    entries = "".join(f"<sitemap><loc>{loc}</loc></sitemap>" for loc in locs)
    return f'<sitemapindex xmlns="{NS}">{entries}{extra}</sitemapindex>'


def parse(spark, body, part):
    rows = spark.createDataFrame([(body,)], "body STRING")
    return rows.select(part(sitemaps.sitemap_document(F.col("body")))).first()[0]


@pytest.mark.parametrize(
    "body, expected",
    [
        (urlset("a", "b", "c"), ["a", "b", "c"]),
        (urlset(), []),
        (urlset("a", "a", "", " b "), ["a", " b "]),
        (urlset("a?x=1&amp;y=2"), ["a?x=1&y=2"]),
        (urlset("a", ns=""), []),
        (urlset("a", ns=' xmlns="http://other"'), []),
        (urlset("a", ns=f' xmlns:s="{NS}"', prefix="s:"), ["a"]),
        (urlset("a", ns=f" xmlns='{NS}' xmlns:i='x'"), ["a"]),
        ("<!-- c -->" + urlset("a").split("?>")[1], ["a"]),
        (f'<feed xmlns="{NS}"><group><url><loc>deep</loc></url></group></feed>', ["deep"]),
        (f'<a:x xmlns:a="b" xmlns="{NS}"><url><loc>a</loc><url><loc>in</loc></url></url><a:url><a:loc>other</a:loc></a:url></a:x>', ["a", "in"]),
        ("This is not XML", []),
        (urlset("a", "b")[:-12], []),
        ("", []),
        (None, []),
        (index("x", extra="<url><loc>own</loc></url>"), ["own"]),
    ],
)
def test_page_locs(spark, body, expected):
    assert parse(spark, body, sitemaps.page_locs) == expected


def test_child_locs_are_the_first_five(spark):
    body = index(*[f"c{i}" for i in range(7)])
    assert parse(spark, body, sitemaps.child_locs) == [f"c{i}" for i in range(5)]
    assert parse(spark, urlset("a"), sitemaps.child_locs) == []


def expand(spark, responses, domains=("d.com",), cap=10, **limits):
    fetched = spark.createDataFrame(responses, "url STRING, status INT, body STRING")
    named = spark.createDataFrame([(d,) for d in domains], "domain STRING")
    pages = sitemaps.domain_pages(named, fetched, cap, **limits)
    if not cap:
        return pages
    return {r.domain: r.urls for r in sitemaps.urls_per_domain(named, pages).collect()}


ROOT = "https://d.com/sitemap.xml"


def test_cap_keeps_the_first(spark):
    assert expand(spark, [(ROOT, 200, urlset(*"abcde"))], cap=3) == {"d.com": ["a", "b", "c"]}
    assert expand(spark, [(ROOT, 200, urlset(*"abcde"))], cap=0).count() == 5


def test_index_of_two_children(spark):
    responses = [(ROOT, 200, index("c1", "c2")), ("c1", 200, urlset("a", "b")), ("c2", 200, urlset("c"))]
    assert expand(spark, responses) == {"d.com": ["a", "b", "c"]}


def test_children_come_before_own_pages(spark):
    responses = [(ROOT, 200, index("c1", extra="<url><loc>own</loc></url>")), ("c1", 200, urlset("a"))]
    assert expand(spark, responses) == {"d.com": ["a", "own"]}


def test_depth_and_fan_out_limits(spark):
    chain = [(ROOT, 200, index("l1")), ("l1", 200, index("l2", extra="<url><loc>p1</loc></url>"))]
    chain += [("l2", 200, index("l3", extra="<url><loc>p2</loc></url>")), ("l3", 200, urlset("too deep"))]
    assert expand(spark, chain) == {"d.com": ["p2", "p1"]}
    wide = [(ROOT, 200, index(*[f"c{i}" for i in range(6)]))] + [(f"c{i}", 200, urlset(f"p{i}")) for i in range(6)]
    assert expand(spark, wide) == {"d.com": [f"p{i}" for i in range(5)]}


def test_index_that_names_itself_ends(spark):
    responses = [(ROOT, 200, index(ROOT, extra="<url><loc>p</loc></url>"))]
    assert expand(spark, responses) == {"d.com": ["p"]}


def test_limits_can_be_lifted(spark):
    responses = [(ROOT, 200, index(*[f"c{i}" for i in range(7)]))] + [(f"c{i}", 200, index(f"d{i}", ROOT)) for i in range(7)]
    responses += [(f"d{i}", 200, index(f"e{i}")) for i in range(7)] + [(f"e{i}", 200, urlset(f"p{i}", f"q{i}")) for i in range(7)]
    fetched = spark.createDataFrame(responses, "url STRING, status INT, body STRING")
    named = spark.createDataFrame([("d.com",)], "domain STRING")
    rows = sitemaps.extract_urls_from_domains(named, fetched, None, max_depth=None, max_children=None).collect()
    assert [r.urls for r in rows] == [[f"{x}{i}" for i in range(7) for x in "pq"]]
    assert sitemaps.extract_urls_from_domains(named, fetched).first().urls == []


def test_only_reached_responses_are_parsed(spark, monkeypatch):
    parsed = []
    keep = sitemaps.parse_responses

    def counting(fetched, *limits):
        parsed.extend(r.url for r in fetched.collect())
        return keep(fetched, *limits)

    monkeypatch.setattr(sitemaps, "parse_responses", counting)
    responses = [(ROOT, 200, index("c1")), ("c1", 200, urlset("a"))] + [(f"o{i}", 200, urlset("o")) for i in range(20)]
    assert expand(spark, responses) == {"d.com": ["a"]}
    assert sorted(parsed) == ["c1", ROOT]


def test_failing_domain_keeps_an_empty_list(spark):
    responses = [(ROOT, 200, urlset("a")), ("https://e.com/sitemap.xml", 404, urlset("b")), ("http://e.com/sitemap.xml", 200, "oops")]
    assert expand(spark, responses, ("d.com", "e.com")) == {"d.com": ["a"], "e.com": []}


def test_later_candidates_fill_up(spark):
    responses = [(ROOT, 200, urlset("a", "b")), ("http://www.d.com/sitemap.xml", 200, urlset("b", "c"))]
    assert expand(spark, responses) == {"d.com": ["a", "b", "c"]}


def test_home_page_when_there_is_no_sitemap(spark):
    ranked = spark.createDataFrame([("a.com", 1), ("b.com", 2), ("c.com", 3)], "domain STRING, rank INT")
    done = spark.createDataFrame([("a.com",)], "domain STRING")
    fetched = spark.createDataFrame([], "url STRING, status INT, body STRING")
    rows = sitemaps.collect_new_domains(ranked, done, fetched, 1).collect()
    assert [(r.domain, r.urls) for r in rows] == [("b.com", ["https://b.com"])]
