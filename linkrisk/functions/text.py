"""Column expressions on feed lines, URLs and domains."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Where a sitemap is looked for, in this order, on every host variant.
SITEMAP_LOCATIONS = [
    ("https://", "/sitemap.xml"),
    ("https://", "/sitemap_index.xml"),
    ("https://", "/sitemap"),
    ("http://", "/sitemap.xml"),
]


def is_nonblank(line: Column) -> Column:
    """True for a line with any character that is not (Unicode) white space."""
    return line.rlike(r"[^\s\x0B\x1C-\x1F\x85\p{Z}]")


def has_http_scheme(url: Column) -> Column:
    return url.startswith("http://") | url.startswith("https://")


def url_host(url: Column) -> Column:
    """Host part of an http(s) URL, null for anything else."""
    return F.nullif(F.regexp_extract(url, r"^https?://([^/?#:]+)", 1), F.lit(""))


def normalize_domain(domain: Column) -> Column:
    """Domain without URL schemes and trailing slashes."""
    bare = F.replace(F.replace(domain, F.lit("http://")), F.lit("https://"))
    return F.rtrim(bare, F.lit("/"))


def www_variants(domain: Column) -> Column:
    """The domain itself, then its twin with or without the ``www.`` label."""
    twin = F.when(domain.startswith("www."), F.substr(domain, F.lit(5))).otherwise(
        F.concat(F.lit("www."), domain)
    )
    return F.array(domain, twin)


def sitemap_candidates(domain: Column) -> Column:
    """Array of the URLs at which the sitemap of a domain may be found."""
    return F.flatten(
        F.transform(
            www_variants(normalize_domain(domain)),
            lambda host: F.array(
                *[F.concat(F.lit(scheme), host, F.lit(path)) for scheme, path in SITEMAP_LOCATIONS]
            ),
        )
    )


def parse_url_list(text: Column) -> Column:
    """Array behind a URL list stored as list-shaped text; null if it cannot be read."""
    return F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})


def home_url_if_none(domain: Column, urls: Column) -> Column:
    """The URL list, or the https home page when the list is null or empty."""
    home = F.array(F.concat(F.lit("https://"), domain))
    return F.when(F.coalesce(F.size(urls), F.lit(0)) > 0, urls).otherwise(home)


def clean_utf8(raw: Column) -> Column:
    """Valid UTF-8 text from raw bytes, without the undecodable ones.

    Valid text stays as it is. Elsewhere a replacement character that is really there is set aside
    as two noncharacters while the undecodable bytes are dropped.
    """
    text, mark, aside = raw.cast("string"), F.lit("\ufffd"), F.lit("\ufdd0\ufdd1")
    dropped = F.replace(F.make_valid_utf8(F.replace(text, mark, aside)), mark)
    return F.when(F.is_valid_utf8(text), text).otherwise(F.replace(dropped, aside, mark))


def url_length(url: Column) -> Column:
    """Code points of a URL; null when it is null or empty."""
    return F.length(F.nullif(url, F.lit("")))


def subdomain_count(domain: Column) -> Column:
    """Labels in front of the last two; null for a null or empty domain."""
    labels = F.size(F.split(domain, "[.]"))
    return F.when(domain != "", F.greatest(labels - 2, F.lit(0)))


def iso_timestamp(ts: Column) -> Column:
    """ISO text of a time, microseconds only if there are any."""
    return F.regexp_replace(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.0{6}$", "")
