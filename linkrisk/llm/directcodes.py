"""Token ids in directly addressable codes: any token can be read without decoding those before it.

An id is cut into chunks from its low bits up. Level 0 holds the first chunk of every id, level 1 the second chunk
of those that go on, and so forth. A bitmap says for each chunk of a level whether its id goes on, and
the rank in it, which is the place on the next level, is found from a directory with the bits set before each
512. The widths of the chunks are those that take the fewest bits for the ids of a segment.

A file is a row of segments, each followed by a line feed:

    magic "DAC1", u64 bytes of the segment, u32 part, u32 number in the part, u64 documents, u64 ids, u8 levels, u8 width of each,
    i64 key of each document, bitmap of the keys that are null, u64 end of each document's ids in the segment,
    then for each level u64 chunks, the chunks packed from the low bit up, and but for the last level the bitmap in
    64-bit words and u32 bits set before each 512. Numbers are little-endian.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from linkrisk.llm.common import by_size, modest_batches
from linkrisk.session import scratch_path, write_scratch

MAGIC = b"DAC1"
_HEAD = struct.Struct("<4sQIIQQB")
#: Ids after which a segment is closed; a document is never parted, so a longer one makes a longer segment.
SEGMENT = 1 << 20
#: Segments of a file.
IN_FILE = 16
#: Levels at most, and the widths in bits that are chosen from; other widths are read and written too, but not as fast.
LEVELS, WIDTHS = 4, (4, 8, 16, 32)


# --- one segment --------------------------------------------------------------------------


def best_widths(ids: np.ndarray, most: int = LEVELS) -> list[int]:
    """The chunk widths out of ``WIDTHS``, of ``most`` levels at most, that take the fewest bits for the ids with their bitmaps."""
    top = max(1, int(ids.max(initial=0)).bit_length())
    longer = [len(ids), *(int((ids >> b > 0).sum()) for b in range(1, top))]  # ids with bits from b on
    # cheapest[b]: bits that the parts of the ids from bit b on take on so many levels at most, and the width of the first of these
    cheapest: list[dict[int, tuple[int, list[int]]]] = [{}]
    for _ in range(most):
        last, now = cheapest[-1], {}
        for b in range(top):
            ways = [(longer[b] * w, [w]) for w in WIDTHS if b + w >= top]
            ways += [(longer[b] * (w + 1) + last[b + w][0], [w, *last[b + w][1]]) for w in WIDTHS if b + w in last]
            if ways:
                now[b] = min(ways)
        cheapest.append(now)
    return cheapest[-1][0][1]


def _packed(values: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return values.astype(f"<u{width // 8}").tobytes()
    if width == 4:
        even = np.append(values, 0).astype(np.uint8) if len(values) % 2 else values.astype(np.uint8)
        return (even[::2] | even[1::2] << 4).tobytes()
    return b"".join(
        np.packbits((values[lo : lo + 65_536, None] >> np.arange(width, dtype=values.dtype)).astype(np.uint8) & 1, bitorder="little").tobytes()
        for lo in range(0, len(values), 65_536)
    )


def encode_segment(part: int, number: int, keys: list[int | None], counts: np.ndarray, ids: np.ndarray, widths: list[int] | None = None) -> bytes:
    """The segment of documents with so many of the ids each; the widths must hold every id."""
    ids = ids.astype(np.uint32)
    widths = widths or best_widths(ids)
    if int(ids.max(initial=0)) >> sum(widths):
        raise ValueError(f"chunks of {widths} bits do not hold {ids.max()}")
    out = [bytes(widths), np.array([k or 0 for k in keys], "<i8").tobytes()]
    out.append(np.packbits(np.array([k is None for k in keys], bool), bitorder="little").tobytes())
    out.append(np.cumsum(counts).astype("<u8").tobytes())
    rest = ids
    for level, width in enumerate(widths):
        out += [struct.pack("<Q", len(rest)), _packed(rest & np.uint32((1 << width) - 1), width)]
        if level < len(widths) - 1:
            over = rest >> np.uint32(width)
            on = over > 0
            words = np.zeros(-(-len(on) // 64) * 8, np.uint8)
            bits = np.packbits(on, bitorder="little")
            words[: len(bits)] = bits
            set_ = np.append(0, np.cumsum(np.bitwise_count(words.view("<u8")), dtype=np.int64))
            out += [words.tobytes(), set_[:-1:8].astype("<u4").tobytes()]
            rest = over[on]
    body = b"".join(out)
    return _HEAD.pack(MAGIC, _HEAD.size + len(body), part, number, len(keys), len(ids), len(widths)) + body


class Segment:
    """A segment that is read where it stands in ``data``; nothing is decoded until it is asked for."""

    def __init__(self, data, at: int = 0) -> None:
        magic, size, self.part, self.number, docs, self.length, levels = _HEAD.unpack_from(data, at)
        if magic != MAGIC or at + size > len(data):
            raise ValueError(f"no whole segment at {at}")
        self.end = at + size
        at += _HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found

        widths = take("u1", levels).tolist()
        keys = take("<i8", docs).tolist()
        none = np.unpackbits(take("u1", -(-docs // 8)), count=docs, bitorder="little")
        self.keys = [None if x else k for k, x in zip(keys, none.tolist())]
        self.ends = take("<u8", docs).astype(np.int64)
        self.levels: list[tuple] = []  # width, chunks, bitmap words, directory
        for level, width in enumerate(widths):
            n = int(take("<u8", 1)[0])
            chunks = take("u1", -(-n * width // 8))
            words, before = (take("<u8", -(-n // 64)), None) if level < levels - 1 else (None, None)
            if words is not None:
                before = take("<u4", -(-n // 512))
            self.levels.append((width, chunks, words, before))
        if at != self.end:
            raise ValueError("the segment is longer than its parts")

    def tokens(self, at: np.ndarray) -> np.ndarray:
        """The ids at any places, each by one chunk a level."""
        place, owner, shift = np.asarray(at, np.int64), np.arange(len(at)), 0
        out = np.zeros(len(place), np.uint32)
        for width, chunks, words, before in self.levels:
            out[owner] |= _chunks(chunks, width, place) << np.uint32(shift)
            shift += width
            if words is None or not len(place):
                break
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            on = words[word] >> bit & np.uint64(1) > 0
            place, owner = _rank(words, before, place[on]), owner[on]
        return out

    def range(self, lo: int, hi: int) -> np.ndarray:
        """The ids of a stretch; ranks are looked up at its start and counted on from there."""
        out, owner, shift = np.zeros(hi - lo, np.uint32), slice(None), 0
        for width, chunks, words, before in self.levels:
            if lo == hi:
                break
            out[owner] |= _stretch(chunks, width, lo, hi) << np.uint32(shift)
            shift += width
            if words is None:
                break
            bits = np.unpackbits(words[lo >> 6 : (hi + 63) >> 6].view(np.uint8), bitorder="little")[lo & 63 : (lo & 63) + hi - lo].astype(bool)
            owner = np.arange(len(out))[bits] if isinstance(owner, slice) else owner[bits]
            lo = int(_rank(words, before, np.array([lo]))[0])
            hi = lo + len(owner)
        return out

    def document(self, number: int) -> np.ndarray:
        return self.range(int(self.ends[number - 1]) if number else 0, int(self.ends[number]))


def _stretch(chunks: np.ndarray, width: int, lo: int, hi: int) -> np.ndarray:
    """The packed values of the places from ``lo`` to ``hi``."""
    if width in (8, 16, 32):
        return chunks.view(f"<u{width // 8}")[lo:hi].astype(np.uint32)
    if width == 4:
        pairs = chunks[lo >> 1 : (hi + 1) >> 1]
        out = np.empty(2 * len(pairs), np.uint32)
        out[::2], out[1::2] = pairs & 15, pairs >> 4
        return out[lo & 1 : (lo & 1) + hi - lo]
    return _chunks(chunks, width, np.arange(lo, hi))


def _chunks(chunks: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
    """The packed values of any places."""
    bit = at * width
    byte, out = bit >> 3, np.zeros(len(at), np.uint64)
    for k in range(-(-(width + 7) // 8)):
        out |= chunks[np.minimum(byte + k, len(chunks) - 1)].astype(np.uint64) << np.uint64(8 * k)
    return (out >> (bit & 7).astype(np.uint64) & np.uint64((1 << width) - 1)).astype(np.uint32)


def _rank(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many bits are set before each place: the directory's count and those of at most eight words."""
    word = at >> 6
    out = before[word >> 3].astype(np.int64)
    for k in range(7):
        full = (word & 7) > k
        out[full] += np.bitwise_count(words[(word[full] & ~7) + k])
    return out + np.bitwise_count(words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))


def segments(data) -> Iterator[Segment]:
    """The segments of a file."""
    at = 0
    while at < len(data):
        found = Segment(data, at)
        if data[found.end : found.end + 1] != b"\n":
            raise ValueError(f"no line feed behind the segment that ends at {found.end}")
        yield found
        at = found.end + 1


# --- files --------------------------------------------------------------------------------


def write(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", model: str = "byte_bpe_50k.json", end: int = 0) -> None:
    """The ids of every whole text, then ``end``, as files under a path, in ascending order of the integer key.

    A null text has the end id alone. Null keys come first; rows with equal keys stand in the order of a hash of
    their texts, equal rows in any. Such rows may fill several files. Other columns are not read.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("body"))
    rows = rows.select("key", "body", F.xxhash64("body").alias("h"), F.monotonically_increasing_id().alias("row"))
    rows = modest_batches(rows).repartitionByRange(parts, "key", "h", "row").sortWithinPartitions("key", "h", "row").select("key", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from linkrisk.llm.encoding import Encoder, with_end

        encoder, part = Encoder.of_worker(model), TaskContext.get().partitionId()
        keys: list = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        number = 0

        def segment() -> pa.RecordBatch:
            data = encode_segment(part, number, keys, np.concatenate([n for _, n in held]), np.concatenate([i for i, _ in held]))
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["segment"])

        for batch in by_size(batches, "body"):
            ids, counts = with_end(*encoder.encode(batch.column("body")), end)
            ends, names, lo = np.cumsum(counts), batch.column("key").to_pylist(), 0
            while lo < len(names):
                start = int(ends[lo - 1]) if lo else 0
                room = SEGMENT - sum(len(i) for i, _ in held)
                hi = min(len(names), int(np.searchsorted(ends, start + room)) + 1)
                held.append((ids[start : int(ends[hi - 1])], counts[lo:hi]))
                keys += names[lo:hi]
                lo = hi
                if sum(len(i) for i, _ in held) >= SEGMENT:
                    yield segment()
                    keys, held, number = [], [], number + 1
        if keys:
            yield segment()

    # the text sink writes the bytes of a string as they are, and a line feed
    written = rows.mapInArrow(run, "segment binary").select(F.col("segment").cast("string"))
    written.write.option("maxRecordsPerFile", IN_FILE).text(path)


_READ = "part long, number long, nth long, key long, local long, n_tokens long, ids_crc32 long"


def read(spark: SparkSession, path: str) -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every document in the files under a path.

    ``start`` counts the ids of all documents before it, over all files: sums by part, then inside a part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for found in segments(content.as_buffer().to_pybytes()):
                    starts = np.append(0, found.ends[:-1])
                    raw = found.range(0, found.length).astype("<u4")
                    sums = [zlib.crc32(raw[s:e]) for s, e in zip(starts.tolist(), found.ends.tolist())]
                    n = len(sums)
                    columns = [np.full(n, found.part), np.full(n, found.number), np.arange(n), found.keys, starts, found.ends - starts, sums]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[f.split()[0] for f in _READ.split(", ")])

    docs = spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, _READ)
    docs = write_scratch(docs, "directcodes-read")
    sums = docs.groupBy("part", "number").agg(F.sum("n_tokens").alias("ids"))
    sums = write_scratch(sums, "directcodes-segments")
    before = lambda w: F.coalesce(F.sum("ids").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = sums.groupBy("part").agg(F.sum("ids").alias("ids")).select(F.col("part").alias("p"), before(W.orderBy("part")).alias("of_part"))
    bases = sums.withColumn("inside", before(W.partitionBy("part").orderBy("number"))).join(parts, F.col("part") == F.col("p"))
    bases = bases.select("part", "number", (F.col("inside") + F.col("of_part")).alias("base"))
    return docs.join(bases, ["part", "number"]).select("key", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def encode(docs: DataFrame, text: str = "text", key: str = "doc_id", model: str = "byte_bpe_50k.json", end: int = 0) -> DataFrame:
    """What the files say of each document after all are written: ``key, start, n_tokens, ids_crc32``; see ``write`` and ``read``.

    An empty table gives an empty result.
    """
    path = scratch_path(docs.sparkSession, "directcodes")
    write(docs, path, text, key, model, end)
    return read(docs.sparkSession, path).withColumnRenamed("key", key)
