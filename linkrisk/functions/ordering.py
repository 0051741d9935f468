"""Orders, ranks and running totals that need neither a global sort nor one big window.

The seeded order sorts rows by the md5 of seed and row identity. It depends only
on the data, so every engine, cluster layout and retry yields the same rows. The
first hex digits of the digest are a ready-made histogram of that order: 4,096
evenly filled buckets per class, whatever the table size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from linkrisk.schemas import SEED
from linkrisk.session import cut_lineage

# Hex digits of a digest, digits per histogram level, and rows that one task may rank.
DIGEST_DIGITS = 32
BUCKET_DIGITS = 3
EDGE_ROWS = 1_000_000  # decides on the number of passes only; the rows are the same

# Distinct values that one task may sort for a running total.
BIN_ROWS = 1_000_000


def seeded_digest(key: str | Sequence[str], seed: int = SEED) -> Column:
    """md5 over seed and key columns. The key must identify a row.

    A null key differs from an empty one, and parts of a longer key keep their borders:
    separators inside them are escaped.
    """
    names = [key] if isinstance(key, str) else list(key)
    parts = [F.col(name).cast("string") for name in names]
    if len(parts) > 1:
        parts = [F.coalesce(F.regexp_replace(p, r"([\\:])", r"\\$1"), F.lit("\\N")) for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))  # leaves out a null part


def _bucket(digest: str) -> Column:
    return F.substring(digest, 1, BUCKET_DIGITS)


def _unless_tied(neighbour: Column, digest: str, value: Column) -> Column:
    """``value``, or a failed query when two rows share a key: a draw over them would not be exact."""
    return F.when(
        neighbour == F.col(digest), F.raise_error(F.lit("the key of a seeded order must identify a row"))
    ).otherwise(value)


class SeededClasses:
    """Rows of a few classes in seeded order, cut at exact ranks.

    A histogram over digest prefixes (classes x 4,096 counts, whatever the table
    size) tells in which prefix a rank falls. Prefixes that still hold many rows are
    refined by the next digits; the rows of the last ones are ranked. What remains
    per class and cut is one digest, so a selection is a comparison: the wide rows
    are read once, filtered, and never shuffled.
    """

    def __init__(self, df: DataFrame, label: str, key: str | Sequence[str], seed: int = SEED):
        self.rows = df.where(F.col(label).isNotNull()).withColumn("_digest", seeded_digest(key, seed))
        self._label = label
        self._first = self._counts(self.rows, BUCKET_DIGITS)
        self.totals = {cls: sum(n for _, n in buckets) for cls, buckets in self._first.items()}
        self._cuts: dict[str, dict] = {}

    def _counts(self, rows: DataFrame, digits: int) -> dict:
        """Class to its (prefix, rows) pairs in order."""
        counted = rows.groupBy(self._label, F.substring("_digest", 1, digits).alias("_prefix")).agg(F.count("*").alias("_n"))
        found: dict = {}
        for row in counted.collect():
            found.setdefault(row[self._label], []).append((row["_prefix"], row["_n"]))
        return {cls: sorted(buckets) for cls, buckets in found.items()}

    def _inside(self, places: set, digits: int) -> Column:
        """True for rows whose class and prefix are among ``places``; the digest is computed once per row."""
        names = [f"{cls}:{prefix}" for cls, prefix in sorted(places)]
        return F.concat(F.col(self._label).cast("string"), F.lit(":"), F.substring("_digest", 1, digits)).isin(names)

    def cut(self, wanted: dict[str, dict]) -> "SeededClasses":
        """Find the digests for ``wanted``: cut name to class to the rank of its last row."""
        open_cuts = {(name, cls): ("", n) for name, ranks in wanted.items() for cls, n in ranks.items() if n > 0}
        counts, digits, edges = self._first, BUCKET_DIGITS, {}
        while open_cuts:
            for at, (prefix, rank) in list(open_cuts.items()):
                for bucket, n in counts[at[1]]:
                    if not bucket.startswith(prefix):
                        continue
                    if rank <= n:
                        break
                    rank -= n
                open_cuts[at] = (bucket, rank)
                if n <= EDGE_ROWS or digits >= DIGEST_DIGITS:
                    edges[at] = open_cuts.pop(at)
            if open_cuts:
                inside = self._inside({(cls, prefix) for (_, cls), (prefix, _) in open_cuts.items()}, digits)
                digits = min(digits + BUCKET_DIGITS, DIGEST_DIGITS)
                counts = self._counts(self.rows.where(inside), digits)
        digests = {}
        for length in {len(prefix) for prefix, _ in edges.values()}:
            places = {(cls, prefix, rank) for (_, cls), (prefix, rank) in edges.items() if len(prefix) == length}
            digests.update(self._digests_at(places, length))
        for (name, cls), (prefix, rank) in edges.items():
            self._cuts.setdefault(name, {})[cls] = digests[cls, prefix, rank]
        return self

    def _digests_at(self, places: set, digits: int) -> dict:
        """(class, prefix, rank) to the digest of the row at that rank of its prefix."""
        edge = self.rows.select(self._label, "_digest").where(self._inside({(c, p) for c, p, _ in places}, digits))
        prefix = F.substring("_digest", 1, digits).alias("_prefix")
        ordered = Window.partitionBy(self._label, "_prefix").orderBy("_digest")
        ranked = edge.select("*", prefix).withColumns(
            {"_rn": F.row_number().over(ordered), "_next": F.lead("_digest").over(ordered)}
        )
        at_rank = F.lit(False)
        for cls, start, rank in places:
            at_rank = at_rank | ((F.col(self._label) == cls) & (F.col("_prefix") == start) & (F.col("_rn") == rank))
        digest = _unless_tied(F.col("_next"), "_digest", F.col("_digest")).alias("_digest")
        chosen = ranked.where(at_rank).select(self._label, "_prefix", "_rn", digest)
        return {(row[self._label], row["_prefix"], row["_rn"]): row["_digest"] for row in chosen.collect()}

    def reached(self, cut: str) -> Column:
        """True for rows up to the cut of their class; null where the cut takes no row."""
        upto = F.lit(None).cast("string")
        for cls, digest in self._cuts.get(cut, {}).items():
            upto = F.when(F.col(self._label) == cls, digest).otherwise(upto)
        return F.col("_digest") <= upto


def seeded_rank(df: DataFrame, by: Sequence[str], key: str | Sequence[str], seed: int = SEED, name: str = "rn") -> DataFrame:
    """1-based rank of every row in seeded order, within each combination of ``by``.

    Rows are ranked inside their digest bucket and shifted by the bucket's running
    total, so the work spreads over the buckets even with one or two classes. Rows
    without a class keep a null rank.
    """
    groups = list(by) or ["_all"]
    keyed = df if by else df.withColumn("_all", F.lit(0))
    keyed = keyed.withColumn("_digest", seeded_digest(key, seed)).withColumn("_bucket", _bucket("_digest"))
    counted = keyed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    running = Window.partitionBy(*groups).orderBy("_bucket")
    offsets = counted.select(*groups, "_bucket", (F.sum("_n").over(running) - F.col("_n")).alias("_before"))
    joined = keyed.join(offsets, [*groups, "_bucket"], "left")
    ordered = Window.partitionBy(*groups, "_bucket").orderBy("_digest")
    rank = F.col("_before") + F.row_number().over(ordered)
    ranked = joined.withColumn(name, _unless_tied(F.lag("_digest").over(ordered), "_digest", rank))
    return ranked.select(*df.columns, name)


def number_rows(df: DataFrame, order_by: Sequence[str | Column], name: str, start: int = 0) -> DataFrame:
    """Dense ids in a given total order.

    One range-partitioned sort, written to the checkpoint folder so that its
    partitions stay fixed, then a count per partition instead of a global window.
    """
    slot = F.shiftright(F.col("_pos"), 33)
    ordered = cut_lineage(df.orderBy(*order_by)).withColumn("_pos", F.monotonically_increasing_id())
    sizes = ordered.groupBy(slot.alias("_slot")).agg(F.count("*").alias("_n"))
    running = Window.partitionBy(F.lit(0)).orderBy("_slot")
    offsets = sizes.select("_slot", (F.sum("_n").over(running) - F.col("_n")).alias("_before"))
    # One row per partition of the sorted frame, a number fixed by the session.
    joined = ordered.withColumn("_slot", slot).join(F.broadcast(offsets), "_slot")
    within = F.col("_pos").bitwiseAND((1 << 33) - 1)
    number = F.col("_before") + within + F.lit(start)
    return joined.select(*df.columns, number.cast("bigint").alias(name))


def running_totals(counted: DataFrame, by: Sequence[str], value: str, sums: Sequence[str]) -> DataFrame:
    """Adds ``<sum>_before``: the total over all smaller values of the same group.

    ``counted`` holds one row per (by, value), so a value shared by many rows weighs
    as much as a rare one; it is read several times and should have been written with
    ``cut_lineage``. Beyond ``BIN_ROWS`` such rows, quantile bins that keep the order
    are totalled first and the values inside each bin second: no task sorts more than
    about one bin.
    """
    bins = math.ceil(counted.count() / BIN_ROWS)
    if bins < 2:
        over_values = Window.partitionBy(*by).orderBy(value)
        return counted.select("*", *[(F.sum(s).over(over_values) - F.col(s)).alias(f"{s}_before") for s in sums])
    binner = QuantileDiscretizer(
        inputCol=value, outputCol="_bin", numBuckets=bins, relativeError=0.25 / bins, handleInvalid="keep"
    )
    # Rows without a value come first, as they do in one window.
    binned = binner.fit(counted).transform(counted).withColumn("_bin", F.coalesce("_bin", F.lit(-1.0)))
    over_bins = Window.partitionBy(*by).orderBy("_bin")
    offsets = binned.groupBy(*by, "_bin").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    offsets = offsets.select(
        *by, "_bin", *[(F.sum(f"_{s}").over(over_bins) - F.col(f"_{s}")).alias(f"_{s}_offset") for s in sums]
    )
    inside = Window.partitionBy(*by, "_bin").orderBy(value)
    summed = binned.select("*", *[(F.sum(s).over(inside) - F.col(s)).alias(f"_{s}_inside") for s in sums])
    joined = summed.join(offsets, [*by, "_bin"])
    totals = [(F.col(f"_{s}_inside") + F.col(f"_{s}_offset")).alias(f"{s}_before") for s in sums]
    return joined.select(*counted.columns, *totals)
