"""Column functions on literal rows."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from linkrisk.functions import outcomes, scan, text
from linkrisk.sources.scans import read_scan_documents


def column(spark, values, expression, ddl="v STRING"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, {ddl}")
    return [r[0] for r in rows.select("i", expression(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_feed_filter(spark):
    urls = ["http://a", "https://b", "ftp://c", "HTTP://d", " http://e", "https://f/x"]
    assert column(spark, urls, text.has_http_scheme) == [True, True, False, False, False, True]


def test_blank_lines(spark):
    lines = ["http://a", "", "   ", "\t", "　", "\x1c", " x "]
    assert column(spark, lines, text.is_nonblank) == [True, False, False, False, False, False, True]


def test_candidates_for_bare_and_www_domain(spark):
    bare, www = column(spark, ["example.com", "https://www.example.com/"], text.sitemap_candidates)
    assert bare[:4] == [
        "https://example.com/sitemap.xml",
        "https://example.com/sitemap_index.xml",
        "https://example.com/sitemap",
        "http://example.com/sitemap.xml",
    ]
    assert bare[4] == "https://www.example.com/sitemap.xml" and len(bare) == len(www) == 8
    assert www[0] == "https://www.example.com/sitemap.xml" and www[4] == "https://example.com/sitemap.xml"


def test_subdomain_count(spark):
    hosts = ["example.com", "www.example.com", "a.b.example.com", "localhost", "", None, "10.0.0.1", "a.co.uk"]
    assert column(spark, hosts, text.subdomain_count) == [0, 1, 2, 0, None, None, 2, 1]


def test_url_length(spark):
    assert column(spark, ["abc", "é😀", "", None], text.url_length) == [3, 2, None, None]


def test_url_lists(spark):
    texts = ["['a', 'b']", "[\"a\", 'b']", "[]", "junk", "['it\\'s']"]
    assert column(spark, texts, text.parse_url_list) == [["a", "b"], ["a", "b"], [], None, ["it's"]]


def test_clean_utf8(spark):
    raw = [b"ab", b"a\xffb", "é".encode(), None]
    assert column(spark, raw, text.clean_utf8, "v BINARY") == ["ab", "ab", "é", None]


def test_errors_are_tested_in_order(spark):
    submit = ["Rate limit hit", "HTTP 429 invalid", "Bad Request", "INVALID url", "boom"]
    assert column(spark, submit, outcomes.submit_error) == ["retry", "retry", "permanent", "permanent", "unknown"]
    result = ["Scan not found or not ready: domain", "DNS failure", "bad domain", "host unreachable", "boom"]
    assert column(spark, result, outcomes.result_error) == ["pending", "permanent", "permanent", "permanent", "unknown"]


def test_http_status(spark):
    rows = spark.createDataFrame(
        [("submit", 200), ("submit", 429), ("submit", 400), ("submit", 404), ("result", 404), ("result", 400)], "p STRING, c INT"
    )
    got = [r[0] for r in rows.select(outcomes.http_status(F.col("p"), F.col("c"))).collect()]
    assert got == ["ok", "rate_limit", "bad_request", "http_error", "not_ready", "http_error"]


def test_overfit_bands(spark):
    assert column(spark, [0.2, 0.1, 0.07, 0.05, -1.0], outcomes.overfit_band, "v DOUBLE") == [
        "red",
        "orange",
        "orange",
        "green",
        "green",
    ]


def test_predictions(spark):
    rows = spark.createDataFrame([(1, 0.8), (0, 0.1), (1, 0.999999)], "c INT, p DOUBLE")
    got = rows.select(
        outcomes.prediction_label(F.col("c")), F.round(outcomes.prediction_confidence(F.col("c"), F.col("p"), 1 - F.col("p")), 6)
    ).collect()
    assert [tuple(r) for r in got] == [("PHISHING", 0.8), ("LEGITIMATE", 0.9), ("PHISHING", 0.999999)]


def test_verdict(spark):
    def doc(**overall):
        return json.dumps({"verdicts": {"overall": overall}})

    docs = [
        doc(score=100, malicious=True),
        doc(score=0, malicious=False),
        doc(score=50, malicious=False),
        doc(malicious=False),
        doc(score=None, malicious=False),
        "{}",
        "broken",
        None,
    ]
    assert column(spark, docs, scan.verdict) == ["malicious", "safe", None, "safe", None, "safe", None, None]


def test_features_of_partial_documents(spark):
    full = {
        "original_url": "",
        "page": {"domain": "www.a.com", "domainAgeDays": 5, "umbrellaRank": 0, "tlsValidDays": 0},
        "stats": {"securePercentage": 50},
        "task": {"url": "http://www.a.com/", "uuid": "u1"},
    }
    docs = [json.dumps(full), json.dumps({"page": None, "task": {"url": ""}}), "broken"]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i INT, document STRING")
    parsed = read_scan_documents(rows).orderBy("i")
    got = [tuple(r) for r in parsed.select(*scan.feature_columns(F.col("doc"))).collect()]
    assert got[0] == (5, 50.0, 1, 0, 1, 0, 17, 1)
    assert got[1] == got[2] == (None, None, 0, 999999, 0, 0, None, None)
    urls = [r[0] for r in parsed.select(scan.submitted_url(F.col("doc"))).collect()]
    assert urls == ["http://www.a.com/", "", None]
