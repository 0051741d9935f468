"""Packing documents into fixed windows by non-negative least squares.

Pieces are counted by length in steps of 16 tokens. Combinations of up to three lengths that fill a
window are the columns of a system whose solution says how often each is used so that the
histogram is met best; rounded down to what is there, each use takes one piece of each of its
lengths. What a combination has too much is cut from its last piece. Pieces left over and
the cut ends are packed greedily: laid end to end and cut at the window's length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from linkrisk.llm.common import by_size, modest_batches
from linkrisk.session import write_scratch

#: Tokens that differ inside one step of the histogram, most pieces in a combination.
STEP, DEPTH = 16, 3
#: Parts in which pieces of a length step, and residual pieces, are numbered.
PARTS = 1024


# --- the plan on the histogram ------------------------------------------------------------


def combinations(steps: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Ascending combinations of 1 to ``depth`` steps that add up to ``steps``."""
    if depth == 1:
        return [(steps,)]
    found = combinations(steps, depth - 1)

    def extend(left: int, least: int, parts: int) -> list[tuple[int, ...]]:
        if parts == 1:
            return [(left,)] if left >= least else []
        return [(first, *rest) for first in range(least, left // parts + 1) for rest in extend(left - first, first, parts - 1)]

    return found + extend(steps, 1, depth)


def nnls(matrix: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """Least squares with non-negative coefficients by active sets."""
    x, active = np.zeros(matrix.shape[1]), np.zeros(matrix.shape[1], dtype=bool)
    limit = 1e-9 * max(1.0, float(np.abs(goal).max(initial=0)))
    for _ in range(3 * matrix.shape[1]):
        slope = matrix.T @ (goal - matrix @ x)
        slope[active] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= limit:
            break
        active[best] = True
        while True:
            solution = np.zeros_like(x)
            solution[active] = np.linalg.lstsq(matrix[:, active], goal, rcond=None)[0]
            low = active & (solution <= limit)
            if not low.any():
                break
            gap = x[low] - solution[low]
            x = x + float(np.min(np.where(gap > 0, x[low] / np.where(gap > 0, gap, 1), 0))) * (solution - x)
            active &= x > limit
            x[~active] = 0
            if not active.any():
                solution = np.zeros_like(x)
                break
        x = solution
    return x


def solve(histogram: dict[int, int], steps: int) -> list[tuple[tuple[int, ...], int]]:
    """How often each combination is used; no step is used more often than the histogram has it."""
    columns = combinations(steps)
    counts = np.array([histogram.get(s, 0) for s in range(steps + 1)], dtype=np.float64)
    matrix = np.zeros((steps + 1, len(columns)))
    for j, column in enumerate(columns):
        for s in column:
            matrix[s, j] += 1
    goal = counts.copy()
    goal[0] = 0
    times = np.rint(nnls(matrix, goal)).astype(np.int64)
    used = (matrix @ times).astype(np.int64)
    for s in range(steps, 0, -1):
        for j in np.nonzero((matrix[s] > 0) & (times > 0))[0]:
            if used[s] <= counts[s]:
                break
            fewer = min(int(times[j]), int(-(-(used[s] - counts[s]) // matrix[s, j])))
            times[j] -= fewer
            used -= (matrix[:, j] * fewer).astype(np.int64)
    return [(columns[j], int(times[j])) for j in np.nonzero(times)[0]]


# --- tokens -------------------------------------------------------------------------------


def tokens(docs: DataFrame, text: str, key: str, model: str, end: int) -> DataFrame:
    """``row, key, ids, n``: the ids of every whole text, then ``end``, as little-endian numbers of 2 or 4 bytes.

    ``row`` numbers the documents, as the table is written, so equal rows stay apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from linkrisk.llm.encoding import Encoder, binary_rows, with_end

        encoder = Encoder.of_worker(model)
        for batch in by_size(batches, "body", 4_000_000):
            ids, n = with_end(*encoder.encode(batch.column("body")), end)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("key"), binary_rows(ids, n), pa.array(n)], names=["row", "key", "ids", "n"])

    rows = modest_batches(docs).select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("body"))
    kind = docs.schema[key].dataType.simpleString()
    return write_scratch(rows.mapInArrow(run, f"row long, key {kind}, ids binary, n long"), "packing-tokens")


# --- the plan on the pieces ---------------------------------------------------------------


def _part(*columns: str):
    return F.pmod(F.xxhash64(*columns), F.lit(PARTS)).cast("int")


def _offsets(rows: DataFrame, by: list[str], value) -> DataFrame:
    """The sum of ``value`` over the parts before each part, within ``by``."""
    sums = rows.groupBy(*by, "part").agg(F.sum(value).alias("_sum"))
    before = W.partitionBy(*by).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return write_scratch(sums.select(*by, "part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("before")), "packing-offsets")


def arrange(lengths: DataFrame, window: int) -> DataFrame:
    """``row, start, length, sequence_id, offset`` of the pieces of documents ``row, n``.

    Full windows of a long document are pieces of their own, the rest is one more. Pieces get
    their use by their rank in a length step, found from counts of parts and a
    sort inside a part; the driver holds the histogram and the combinations, whose number
    depends on the window alone. Residual pieces are laid out in the same way
    by running sums. The last window is cut into powers of two and needs no padding.
    """
    spark = lengths.sparkSession
    zero = F.lit(0).cast("long")
    pieces = (
        lengths.withColumn("k", F.explode(F.sequence(zero, F.expr(f"(n - 1) div {window}"))))
        .withColumn("start", F.col("k") * window)
        .select("row", "start", F.least(F.col("n") - F.col("start"), F.lit(window)).alias("length"))
        .withColumns({"step": F.expr(f"length div {STEP}"), "part": _part("row", "start")})
    )
    pieces = write_scratch(pieces, "packing-pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("step").count().collect()}
    ranges, used, sequences = [], {}, 0
    for combination, times in solve(histogram, window // STEP):
        for slot, step in enumerate(combination):
            low = used.get(step, 0)
            ranges.append((step, low, low + times, sequences, slot))
            used[step] = low + times
        sequences += times
    ranges = spark.createDataFrame(ranges, "s long, low long, high long, first long, slot int")
    offsets = _offsets(pieces, ["step"], F.lit(1))
    rank = F.row_number().over(W.partitionBy("step", "part").orderBy("row", "start")) - 1
    ranked = pieces.withColumn("inside", rank).join(offsets, ["step", "part"]).withColumn("rank", F.col("inside") + F.col("before"))
    inside = (F.col("step") == F.col("s")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = ranked.join(F.broadcast(ranges), inside, "left").select(
        "row", "start", "length", (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"), "slot"
    )
    placed = write_scratch(placed, "packing-placed")
    before = F.coalesce(F.sum("length").over(W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)), zero)
    matched = placed.where("sequence_id is not null").withColumn("offset", before)
    matched = write_scratch(matched.withColumn("taken", F.least(F.col("length"), F.lit(window) - F.col("offset"))), "packing-matched")
    ends = matched.where("taken < length").select("row", (F.col("start") + F.col("taken")).alias("start"), (F.col("length") - F.col("taken")).alias("length"))
    rest = placed.where("sequence_id is null").select("row", "start", "length").unionByName(ends).withColumn("part", _part("row", "start"))
    rest = write_scratch(rest, "packing-rest")
    total = rest.agg(F.coalesce(F.sum("length"), zero)).first()[0]
    whole = total // window
    at, tail = whole * window, []
    for bit in reversed(range(window.bit_length())):
        if (total - whole * window) >> bit & 1:
            tail.append(F.struct(F.lit(at).alias("lo"), F.lit(at + (1 << bit)).alias("hi"), F.lit(sequences + whole + len(tail)).alias("id")))
            at += 1 << bit
    lasting = F.array(*tail) if tail else F.array(F.struct(*[F.lit(-1).alias(c) for c in ("lo", "hi", "id")]))
    lasting = lasting.cast("array<struct<lo: long, hi: long, id: long>>")

    def segments(w):
        full = F.array(F.struct((w * window).alias("lo"), ((w + 1) * window).alias("hi"), (w + sequences).alias("id")))
        return F.when(w < whole, full.cast("array<struct<lo: long, hi: long, id: long>>")).otherwise(lasting)

    running = F.coalesce(F.sum("length").over(W.partitionBy("part").orderBy("row", "start").rowsBetween(W.unboundedPreceding, -1)), zero)
    laid = rest.withColumn("running", running).join(_offsets(rest.withColumn("all", F.lit(0)), ["all"], "length").drop("all"), "part")
    laid = laid.withColumn("from", F.col("running") + F.col("before")).withColumn("to", F.col("from") + F.col("length"))
    windows = F.sequence(F.expr(f"`from` div {window}"), F.expr(f"(`to` - 1) div {window}"))
    met = F.filter(F.flatten(F.transform(windows, segments)), lambda s: (s["lo"] < F.col("to")) & (s["hi"] > F.col("from")))
    cut = laid.withColumn("s", F.explode(met)).withColumns({"a": F.greatest("from", "s.lo"), "b": F.least("to", "s.hi")})
    residual = cut.select(
        "row", (F.col("start") + F.col("a") - F.col("from")).alias("start"), (F.col("b") - F.col("a")).alias("length"),
        F.col("s.id").alias("sequence_id"), (F.col("a") - F.col("s.lo")).alias("offset"),
    )
    return matched.select("row", "start", F.col("taken").alias("length"), "sequence_id", "offset").unionByName(residual)


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", model: str = "word_bpe_49k.json", window: int = 2048, end: int = 1) -> DataFrame:
    """All documents in sequences of ``window`` tokens of any tokenizer file, a row for each piece.

    ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset``. Each token lies in one piece;
    ``window`` is a power of two of at least ``STEP``. A null or empty text is the end token alone. Equal
    rows, and rows with equal or null keys, are documents of their own. Other columns are not read; an empty
    table gives an empty result.
    """
    made = tokens(docs, text, key, model, end)
    plan = write_scratch(arrange(made.select("row", "n"), window), "packing-plan")
    by_row = plan.groupBy(F.col("row").alias("r")).agg(F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces"))
    kind = docs.schema[key].dataType.simpleString()
    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            at = []
            for i, (ids, n, pieces) in enumerate(zip(batch.column("ids"), batch.column("n").to_pylist(), batch.column("pieces").to_pylist())):
                raw = ids.as_buffer()
                wide = np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                for p in pieces:
                    at.append(i)
                    lo, length = p["start"], p["length"]
                    for column, value in zip(out[1:], (lo, length, zlib.crc32(wide[lo : lo + length]), n, p["sequence_id"], p["offset"])):
                        column.append(value)
            keys = batch.column("key").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, *[pa.array(c, pa.int64()) for c in out[1:]]], names=names)

    joined = made.join(by_row, F.col("row") == F.col("r")).select("key", "ids", "n", "pieces")
    fields = f"key {kind}, " + ", ".join(f"`{n}` long" for n in names[1:])
    return joined.mapInArrow(run, fields).withColumnRenamed("key", key)
