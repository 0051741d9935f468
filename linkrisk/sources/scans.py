"""Scan documents: raw JSON text in, one struct per document out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkrisk import schemas


def read_scan_documents(df: DataFrame, json_column: str = "document", keep_broken: bool = False) -> DataFrame:
    """Parse the JSON column into ``doc``; unreadable text gives null fields.

    With ``keep_broken`` the field ``doc._corrupt_record`` holds text that is no document.
    """
    ddl = f"{schemas.SCAN_DDL}, _corrupt_record STRING" if keep_broken else schemas.SCAN_DDL
    parsed = F.from_json(json_column, ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return df.withColumn("doc", parsed)


def search_scans(docs: DataFrame, domain: str, size: int = schemas.SEARCH_DEFAULT) -> DataFrame:
    """Stored documents of one domain, ordered by scan id, at most ``min(size, 10000)``."""
    return (
        docs.where(F.col("doc.page.domain") == domain)
        .orderBy("doc.task.uuid")
        .limit(min(size, schemas.SEARCH_CAP))
    )
