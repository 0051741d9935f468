"""Document fingerprints as quartile bucket digests.

Byte triplets are hashed into 128 buckets and counted. The digest keeps for each bucket
the quarter of all buckets its count falls into, besides the length and the quartiles'
ratios. Digests of similar texts differ in few buckets, and the difference is bounded.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BUCKETS = 128
MULTIPLIER = np.uint32(0x9E3779B1)
SHIFT = np.uint32(32 - 7)
#: Differences from here on count as no likeness at all.
LIMIT = 300


def digest(data: bytes) -> str:
    """The fingerprint of a byte string as 68 hex digits; every byte string has one."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    if len(data) >= 3:
        b = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
        triplets = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
        counts = np.bincount((triplets * MULTIPLIER) >> SHIFT, minlength=BUCKETS)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    quarter = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = (quarter.reshape(-1, 4) << np.array([6, 4, 2, 0], dtype=np.uint8)).sum(axis=1).astype(np.uint8)
    length = min(255, round(8 * math.log2(len(data) + 1)))
    ratios = (int(15 * q1 // q3) << 4 | int(15 * q2 // q3)) if q3 else 0
    return bytes([length, ratios]).hex() + packed.tobytes().hex()


def _quarters(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(fingerprint), dtype=np.uint8)
    return (raw[2:, None] >> np.array([6, 4, 2, 0], dtype=np.uint8)) & 3


def difference(a: str, b: str) -> int:
    """0 for equal fingerprints; opposite quarters count double, lengths and ratios by their distance."""
    if a == b:
        return 0
    apart = np.abs(_quarters(a).astype(np.int16) - _quarters(b))
    head = [int(a[:2], 16) - int(b[:2], 16), int(a[2], 16) - int(b[2], 16), int(a[3], 16) - int(b[3], 16)]
    return int(apart.sum() + 3 * (apart == 3).sum()) + abs(head[0]) + 2 * (abs(head[1]) + abs(head[2]))


def likeness(a: str, b: str) -> float:
    """1 for equal fingerprints, falling to 0 at a difference of ``LIMIT``."""
    return 1.0 - min(difference(a, b), LIMIT) / LIMIT


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, fingerprint`` of every whole text; a null text counts as empty."""
    from linkrisk.llm.common import map_batches

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).cast("binary").alias("body"))
    found = map_batches(rows, lambda c: {"key": c["key"], "fingerprint": [digest(b) for b in c["body"]]}, f"key {kind}, fingerprint string")
    return found.withColumnRenamed("key", key)


_OUT = "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range, those of the next range's first document last; each needs the row after it."""
    held = None  # range, key, text, fingerprint
    for batch in batches:
        out = [[] for _ in range(7)]
        for part, extra, key, text in zip(*[c.to_pylist() for c in batch.columns]):
            own = None
            if held is not None and held[0] == part:
                _, before, first, print_ = held
                own = digest(text.encode())
                n = len(first)
                edited = (first[: n - n // 2] + text[: n // 2]).encode()
                changed = digest(edited)
                row = (before, n, hashlib.sha256(edited).hexdigest(), print_, changed, likeness(print_, changed), likeness(print_, own))
                for column, value in zip(out, row):
                    column.append(value)
            held = None if extra else (part, key, text, own or digest(text.encode()))
        if out[0]:
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=[f.split()[0] for f in _OUT.split(", ")])


def edited_fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprints of every text and of the text whose second half comes from the next document.

    ``key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    The next document is that with the next greater integer key, after the last the first; null
    keys come first, rows with equal keys follow each other by text. A null text is
    empty. Other columns are not read; an empty table gives an empty result.

    The texts move once. Quantiles of the keys cut them into ranges (four per shuffle
    partition, so the driver holds that many numbers), and the first document of a range
    also goes to the end of the range before it. Rows of a range are streamed in order.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lowest = -(1 << 63)
    rows = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(lowest)).alias("order"),
        F.col(key).cast("long").alias("key"),
        F.coalesce(text, F.lit("")).alias("body"),
    )
    steps = [i / (4 * partitions) for i in range(1, 4 * partitions)]
    cuts, least = rows.agg(F.percentile_approx("order", steps, 10_000), F.min("order")).first()
    starts = sorted({*(cuts or []), least if least is not None else lowest})
    edges = F.array(*[F.lit(s) for s in starts])
    own = F.size(F.filter(edges, lambda e: e <= F.col("order"))) - 1
    before = F.pmod(F.col("part") - 1, F.lit(len(starts)))
    one = F.array(F.struct(F.col("part"), F.lit(False).alias("extra")))
    both = F.array(F.struct(F.col("part"), F.lit(False).alias("extra")), F.struct(before.alias("part"), F.lit(True).alias("extra")))
    dealt = (
        rows.withColumn("part", own)
        .withColumn("to", F.explode(F.when(F.array_contains(edges, F.col("order")), both).otherwise(one)))
        .select("to.part", "to.extra", "order", "key", "body")
        .repartition(partitions, "part")
        .sortWithinPartitions("part", "extra", "order", "body")
        .select("part", "extra", "key", "body")
    )
    return dealt.mapInArrow(_edited, _OUT).withColumnRenamed("key", key)
