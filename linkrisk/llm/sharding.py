"""Rendezvous hashing of record keys over weighted shards, with gapless places in each shard.

Every (key, shard) pair has a fixed uniform number u; the shard with the least -ln(u) / weight
owns the key. A further shard only competes for keys, so it takes records from the others
and moves none between them. Everything is column expressions, joins and windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from linkrisk.llm.common import digest60
from linkrisk.session import write_scratch

#: Parts of a shard that are numbered independently of each other, and copies of a row numbered at once.
PARTS, CHUNK = 4096, 10_000


def owner(key: Column, weights: list[float]) -> Column:
    """The shard, 0 to len(weights) - 1, that owns a key; ties go to the lower shard."""
    uniform = lambda s: (digest60(key, F.lit(s)).cast("double") + 1.0) / float(1 << 60)
    scores = [F.struct((-F.log(uniform(s)) / float(w)).alias("score"), F.lit(s).alias("shard")) for s, w in enumerate(weights)]
    return F.array_min(F.array(*scores))["shard"]


def place(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` (``shard, part`` and ``columns``) with ``slot``: 0, 1, 2 ... in each shard by part, then columns.

    Equal rows are counted before the shuffle, so a row that fills a third of the table
    is one row to sort; a shard is numbered in ``PARTS`` parts by counts of the parts
    before, so no task sees a whole shard.
    """
    counted = write_scratch(rows.groupBy("shard", "part", *columns).agg(F.count(F.lit(1)).alias("n")), "shard-rows")
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = write_scratch(
        counted.groupBy("shard", "part")
        .agg(F.sum("n").alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")),
        "shard-starts",
    )
    inside = W.partitionBy("shard", "part").orderBy(*[F.col(c).asc_nulls_first() for c in columns])
    first = F.coalesce(F.sum("n").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    zero = F.lit(0).cast("long")
    return (
        counted.withColumn("first", first)
        .join(starts, ["shard", "part"])
        .withColumn("chunk", F.explode(F.sequence(zero, F.expr(f"(n - 1) div {CHUNK}"))))
        .withColumn("from", F.col("chunk") * CHUNK)
        .withColumn("copy", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + CHUNK, F.col("n")) - 1)))
        .select("shard", *columns, (F.col("start") + F.col("first") + F.col("copy")).alias("slot"))
    )


def assign(docs: DataFrame, text: str = "text", key: str = "doc_id", shards: int = 24, weights: list[float] | None = None) -> DataFrame:
    """``key, size, text_crc32, shard, slot, grown_shard`` of every document.

    Size is the bytes of the text and 8; a null text has none and CRC 0. The key and the
    weights alone decide the shard, ``grown_shard`` is the one with a further shard of
    weight 1. A null key is a key like any other. Rows with equal keys share a shard.
    Slots follow a hash of the key, then key, size and CRC, so reruns agree; equal rows take
    adjacent slots. Other columns are not read; an empty table gives an empty result.
    """
    weights = weights or [1.0] * shards
    body = F.coalesce(F.col(text), F.lit(""))
    id_ = F.col(key)
    rows = docs.select(
        id_.alias("key"),
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        owner(id_, weights).alias("shard"),
        owner(id_, [*weights, 1.0]).alias("grown_shard"),
        (F.shiftright(digest60(id_), 48)).cast("int").alias("part"),
    )
    columns = ["key", "size", "text_crc32", "grown_shard"]
    return place(rows, columns).select(F.col("key").alias(key), "size", "text_crc32", "shard", "slot", "grown_shard")
