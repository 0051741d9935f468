"""Column expressions on a parsed scan document (a struct column)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from linkrisk import schemas
from linkrisk.functions import text


def domain_age_days(doc: Column) -> Column:
    return doc["page"]["domainAgeDays"]


def secure_percentage(doc: Column) -> Column:
    return doc["stats"]["securePercentage"]


def has_umbrella_rank(doc: Column) -> Column:
    return doc["page"]["umbrellaRank"].isNotNull().cast("int")


def umbrella_rank(doc: Column) -> Column:
    return F.coalesce(doc["page"]["umbrellaRank"], F.lit(schemas.UNRANKED))


def has_tls(doc: Column) -> Column:
    return doc["page"]["tlsValidDays"].isNotNull().cast("int")


def tls_valid_days(doc: Column) -> Column:
    return F.coalesce(doc["page"]["tlsValidDays"], F.lit(schemas.NO_TLS_DAYS))


def url_length(doc: Column) -> Column:
    return text.url_length(doc["task"]["url"])


def subdomain_count(doc: Column) -> Column:
    return text.subdomain_count(doc["page"]["domain"])


def submitted_url(doc: Column) -> Column:
    """The URL as it was submitted, or else the one the scan reports."""
    return F.coalesce(F.nullif(doc["original_url"], F.lit("")), doc["task"]["url"])


def scan_uuid(doc: Column) -> Column:
    return doc["task"]["uuid"]


def feature_columns(doc: Column) -> list[Column]:
    """All model inputs in their fixed order."""
    by_name = {
        "domain_age_days": domain_age_days,
        "secure_percentage": secure_percentage,
        "has_umbrella_rank": has_umbrella_rank,
        "umbrella_rank": umbrella_rank,
        "has_tls": has_tls,
        "tls_valid_days": tls_valid_days,
        "url_length": url_length,
        "subdomain_count": subdomain_count,
    }
    return [by_name[name](doc).alias(name) for name in schemas.FEATURES]


def verdict(document: Column) -> Column:
    """``malicious``, ``safe`` or null, from the raw JSON text of a scan.

    A missing score counts as 0, an explicit null score does not; only a
    VARIANT keeps the two apart.
    """
    parsed = F.try_parse_json(document)
    malicious = F.try_variant_get(parsed, "$.verdicts.overall.malicious", "boolean")
    score = F.try_variant_get(parsed, "$.verdicts.overall.score", "variant")
    is_zero = F.try_variant_get(parsed, "$.verdicts.overall.score", "double") == 0
    safe = score.isNull() | (~F.is_variant_null(score) & is_zero)
    return F.when(F.coalesce(malicious, F.lit(False)), "malicious").when(
        parsed.isNotNull() & safe, "safe"
    )
