"""Hard negatives by the threshold algorithm over sorted lists of each dimension.

Rows are dealt into slices of bounded size. A slice holds, for each dimension, its rows in the order of
that component. For an anchor every list is read from the end that the sign of the anchor's
component favours, all lists to the same depth. A row is scored by its whole inner product when it
is met first. The sum of the anchor's products with the components at the depth bounds the score of
every row not met yet, so a slice is done once that threshold lies strictly below the worst
score that each of the anchor's windows still keeps. What slices find is merged by score and key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from linkrisk.session import write_scratch

#: Expected rows of a slice.
SLICE = 8_192
#: Depth of the first sorted access, and the factor from one to the next.
FIRST, GROWTH = 32, 4
#: Parts in which equal vectors are numbered before they are numbered together.
SALTS = 64
#: Components from this size on take no part; nor do those that could carry a hundred inner products beyond a long.
LARGEST = 1 << 31


# --- the threshold algorithm on one slice --------------------------------------------------


class Slice:
    """Rows (key, label, vector) of one slice with a sorted list for each dimension."""

    def __init__(self, keys: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        by = np.argsort(keys, kind="stable")
        self.keys, self.labels = keys[by], labels[by]
        self.vectors = vectors[by].astype(np.float64)
        # sums of products are exact in doubles up to 2^53, beyond that integers are taken
        bound = float(np.abs(self.vectors).max(initial=0))
        self.exact = bound * bound * max(1, vectors.shape[1]) < 2**52
        lists = np.ascontiguousarray(self.vectors.T)
        self.order = np.argsort(lists, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(lists, self.order, axis=1)

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        if not self.exact:
            return self.vectors[rows].astype(np.int64) @ anchor
        anchor = anchor.astype(np.float64)
        if 4 * len(rows) > len(self.vectors):  # picking so many rows costs more than scoring all
            return (self.vectors @ anchor)[rows].astype(np.int64)
        return (self.vectors[rows] @ anchor).astype(np.int64)

    def best(self, anchor: np.ndarray, able: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window [low, high] the rows of the first ``k`` able ones by score, then key, and their scores."""
        n, width = self.vectors.shape
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        signed = anchor.astype(object if not self.exact else np.float64)
        met = np.zeros(n, bool)
        rows, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, to = 0, FIRST
        while True:
            to = min(to, n)
            new = np.zeros(n, bool)
            if len(up) or len(down):
                new[self.order[up, n - to : n - depth]] = True
                new[self.order[down, depth:to]] = True
                new &= ~met
            else:
                new[:] = True  # every score is zero
            met |= new
            some = np.flatnonzero(new & able)
            rows, scores = np.append(rows, some), np.append(scores, self.scores(some, anchor))
            if to == n or met.all():
                return [self._kept(rows, scores, window, k) for window in windows]
            edges = [(signed[d] * self.sorted[d, at].astype(signed.dtype)).sum() for d, at in ((up, n - to), (down, to - 1))]
            threshold = int(edges[0]) + int(edges[1])
            if all(threshold < high for _, high in windows):
                kept = [self._kept(rows, scores, window, k) for window in windows]
                if all(threshold < low or (len(s) == k and threshold < s[-1]) for (low, _), (_, s) in zip(windows, kept)):
                    return kept
            # what no window can take any more is dropped
            useful = np.zeros(len(rows), bool)
            for low, high in windows:
                useful |= (scores >= low) & (scores <= high)
            rows, scores = rows[useful], scores[useful]
            depth, to = to, to * GROWTH

    def _kept(self, rows: np.ndarray, scores: np.ndarray, window: tuple[int, int], k: int) -> tuple[np.ndarray, np.ndarray]:
        inside = np.flatnonzero((scores >= window[0]) & (scores <= window[1]))
        if len(inside) > k:  # only those that reach the k-th score
            least = np.partition(scores[inside], len(inside) - k)[len(inside) - k]
            inside = inside[scores[inside] >= least]
        by = np.lexsort((rows[inside], -scores[inside]))[:k]  # rows stand in the order of their keys
        return rows[inside[by]], scores[inside[by]]


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


_NO_KEY = np.iinfo(np.int64).max


def _find(same: bool, k: int):
    """Rows sorted by slice, its candidates (null ``anchor``) before the anchors: what each anchor keeps of the slice.

    The candidates of one slice are held, anchors pass by in batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current, ready = [], None, None
        for batch in batches:
            slices = batch.column("slice").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(slices)) + 1).tolist(), len(slices)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if slices[lo] != current:
                    held, current, ready = [], slices[lo], None
                part = batch.slice(lo, hi - lo)
                is_anchor = part.column("anchor").is_valid().to_numpy(zero_copy_only=False)
                first = int(np.argmax(is_anchor)) if is_anchor.any() else len(is_anchor)
                if first:
                    held.append(part.slice(0, first))
                if first == len(is_anchor) or not held:
                    continue
                if ready is None:
                    columns = [np.concatenate([x.column(c).fill_null(_NO_KEY).to_numpy(zero_copy_only=False) for x in held]) for c in ("key", "label")]
                    ready = Slice(*columns, np.concatenate([_vectors(x.column("vector")) for x in held]))
                yield from found(ready, part.slice(first))

    def found(ready: Slice, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vectors = _vectors(part.column("vector"))
        out: list[list] = [[], [], [], []]
        rows = zip(*(part.column(c).to_pylist() for c in ("anchor", "key", "label", "windows")), vectors)
        for anchor, key, label, windows, vector in rows:
            able = (ready.labels == label) & (ready.keys != key) if same else ready.labels != label
            ends = [(w["low"], w["high"]) for w in windows]
            for number, (at, scores) in enumerate(ready.best(vector, able, ends, k)):
                for column, values in zip(out, ([anchor] * len(at), [number] * len(at), ready.keys[at].tolist(), scores.tolist())):
                    column.extend(values)
        keys = pa.array([None if x == _NO_KEY else x for x in out[2]], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), keys, pa.array(out[3], pa.int64())], names=["anchor", "window", "key", "score"]
        )

    return run


# --- rows and anchors ---------------------------------------------------------------------


def whole_components(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component as longs; null where the vector is null or a component is null, not finite or too large."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double") * scale) < F.lit(float(LARGEST)), F.lit(False)) & ~F.isnan(x.cast("double")))
    return F.when(fits, scaled)


def first_of_equal(rows: DataFrame, most: int) -> DataFrame:
    """``key, label, vector``: of rows with equal label and vector the ``most`` smallest keys; more can never be among the first ``most`` of a kind.

    They are numbered in salted parts first, so a vector that a third of the rows share is no burden.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
    rank = lambda *by: F.row_number().over(W.partitionBy(*by).orderBy(F.col("key").asc_nulls_last()))
    salted = salted.withColumn("r", rank("label", "vector", "salt")).where(F.col("r") <= most)
    return salted.withColumn("r", rank("label", "vector")).where(F.col("r") <= most).select("key", "label", "vector")


def _search(rows: DataFrame, anchors: DataFrame, slices: int, same: bool, k: int) -> DataFrame:
    """``anchor, window, key, score``: the first ``k`` rows of each window of each anchor, over all slices."""
    spread = anchors.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"), "anchor", "key", "label", "vector", "windows")
    none = F.lit(None).cast("long").alias("anchor")
    windows = F.lit(None).cast("array<struct<low: long, high: long>>").alias("windows")
    dealt = rows.select("slice", none, "key", "label", "vector", windows).unionByName(spread)
    dealt = dealt.repartition(min(slices, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "slice").sortWithinPartitions("slice", F.col("anchor").asc_nulls_first())
    found = dealt.mapInArrow(_find(same, k), "anchor long, window int, key long, score long")
    place = F.row_number().over(W.partitionBy("anchor", "window").orderBy(F.desc("score"), F.col("key").asc_nulls_last()))
    return found.withColumn("place", place).where(F.col("place") <= k)


def mine(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    is_anchor: Column | None = None,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of every anchor.

    The positives of an anchor are its first rows of the same label by score, then key, its own key left out.
    For each, the first rows of other labels whose score is between ``least`` and ``most`` percent of the
    positive's. Rows with a null label or vector, or with a component that is null, not finite or
    so large that a hundred inner products leave a long (some 10^7 for 64 components after scaling) take no part, nor do
    vectors of another length than the longest.
    Fully equal rows (key, label, vector) count once; a null key is never an anchor and
    comes after all others among ties. An empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    anchor = F.coalesce(F.expr(f"`{key}` % 50 = 0") if is_anchor is None else is_anchor, F.lit(False))
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("key"), label.cast("long").alias("label"), whole_components(F.col(f"`{vector}`")).alias("vector"), anchor.alias("is_anchor"))
    rows = rows.where("label is not null and vector is not null")
    rows = write_scratch(rows, "negatives-rows")
    total, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    slices = max(1, -(-total // SLICE))
    largest = int((2**62 / (100 * max(1, width))) ** 0.5)
    rows = rows.where((F.size("vector") == width) & F.forall("vector", lambda x: F.abs(x) <= largest))
    anchors = rows.where("is_anchor").select("key", "label", "vector").distinct().withColumn("anchor", F.monotonically_increasing_id())
    anchors = write_scratch(anchors, "negatives-anchors")
    number = F.pmod(F.xxhash64("vector", "label", "key"), F.lit(slices)).alias("slice")
    dealt = first_of_equal(rows.select("key", "label", "vector").distinct(), max(positives + 1, negatives))
    dealt = write_scratch(dealt.select("key", "label", "vector", number), "negatives-slices")
    everything = F.array(F.struct(F.lit(-(1 << 62)).alias("low"), F.lit(1 << 62).alias("high")))
    near = _search(dealt, anchors.withColumn("windows", everything), slices, True, positives)
    near = write_scratch(near.select("anchor", F.col("place").alias("nth"), F.col("key").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    # a window for each different score of a positive, in which anything can lie
    bounds = near.where("positive_score >= 0").groupBy("anchor").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    windows = F.expr(f"transform(scores, s -> named_struct('low', (s * {least} + 99) div 100, 'high', s * {most} div 100))")
    wanted = anchors.join(bounds.select("anchor", "scores", windows.alias("windows")), "anchor")
    found = _search(dealt, wanted, slices, False, negatives)
    found = write_scratch(found.select("anchor", "window", F.col("place").alias("rank"), F.col("key").alias("negative_id"), F.col("score").alias("negative_score")), "negatives-found")
    numbered = bounds.select("anchor", F.posexplode("scores").alias("window", "positive_score"))
    named = anchors.select("anchor", F.col("key").alias("anchor_id"))
    return (
        near.join(numbered, ["anchor", "positive_score"])
        .join(found, ["anchor", "window"])
        .join(named, "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )
