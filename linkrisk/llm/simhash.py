"""Near duplicates by SimHash, found with the general pigeonhole principle.

Bits are dealt into parts, correlated bits together. If each part i may differ in t_i bits, with
the t_i adding up to radius - parts + 1, then two fingerprints within the radius agree in at
least one part up to its t_i. The t_i are chosen by dynamic programming on the candidates that
a sample predicts: a part in which many fingerprints agree gets a small one, or none (-1).
The sample steers the cost only; any choice finds every pair. Fingerprints meet at the
values of their parts, each under its own value and as a probe under the greater values within t_i.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from linkrisk.llm.common import map_batches, modest_batches, own_names, remembered, with_fields
from linkrisk.session import write_scratch

SEED = 42
#: Fingerprints sampled to estimate how often parts agree (expected number).
SAMPLE = 4096
#: Members of one value of a part that are compared in one go; more are split by further bits.
HOT = 5_000
#: Up to so many members all pairs within the radius are links, beyond that a spanning forest of them; see ``crossing`` for the rest.
ALL_PAIRS = 64
#: Hashes whose bits are added up at once.
SLICE = 200_000
#: Bands of minimum hashes and hashes in each: two shingle sets of Jaccard similarity s share no band with probability (1 - s ** DEPTH) ** BANDS, 0.3 % at 0.8.
BANDS, DEPTH = 32, 8
#: Members of the largest band value that meet all others in the first round, and the factor from round to round.
PIVOTS, GROWTH = 16, 8


# --- fingerprints -------------------------------------------------------------------------


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """A second hash of a hash; salt 0 leaves it as it is."""
    if not salt:
        return h
    h = h ^ np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes | None, size: int) -> list[bytes]:
    """Shingles of the words of a text in ASCII lower case; a shorter text is one shingle, no words are none."""
    words = text.lower().split() if text else []
    if size == 1:
        return words
    if len(words) < size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*[words[i:] for i in range(size)])))


def fingerprint_batch(texts: list[bytes | None], size: int, distinct: bool = False, salts: tuple[int, ...] = (0,)) -> np.ndarray:
    """A 64-bit fingerprint of every text for each salt: the bits set in more than half of its hashes."""
    sums = np.zeros((len(salts), len(texts), 64), dtype=np.int64)
    lengths = np.zeros(len(texts), dtype=np.int64)
    hashes: list[int] = []
    owners: list[tuple[int, int]] = []

    def add() -> None:
        h = np.array(hashes, dtype=np.uint64)
        starts = np.concatenate(([0], np.cumsum([n for _, n in owners])[:-1])).astype(np.int64)
        who = [i for i, _ in owners]
        for k, salt in enumerate(salts):
            bits = np.unpackbits(_mixed(h, salt).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            np.add.at(sums[k], who, np.add.reduceat(bits, starts, axis=0, dtype=np.int64))
        hashes.clear()
        owners.clear()

    for i, text in enumerate(texts):
        pieces = shingles(text, size)
        if distinct:
            pieces = list(set(pieces))
        lengths[i] = len(pieces)
        for lo in range(0, len(pieces), SLICE):
            part = pieces[lo : lo + SLICE]
            hashes.extend([xxhash.xxh64_intdigest(s, SEED) for s in part])
            owners.append((i, len(part)))
            if len(hashes) >= SLICE:
                add()
    if owners:
        add()
    return np.packbits(sums * 2 > lengths[None, :, None], axis=2).reshape(len(salts), len(texts), 8).view(">u8")[:, :, 0].astype(np.uint64)


# --- the plan: parts and thresholds -------------------------------------------------------


def _parts(sample: np.ndarray, parts: int) -> list[list[int]]:
    """64 bit positions in so many parts of equal width; each part takes the bits most correlated with its own."""
    bits = (sample[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    with np.errstate(invalid="ignore", divide="ignore"):
        near = np.abs(np.nan_to_num(np.corrcoef(bits.astype(np.float64), rowvar=False))) if len(sample) > 1 else np.zeros((64, 64))
    free, out = list(range(64)), []
    for k in range(parts):
        width = len(free) // (parts - k)
        part = [max(free, key=lambda b: (near[b, free].sum(), -b))]
        free.remove(part[0])
        while len(part) < width:
            best = max(free, key=lambda b: (near[b, part].sum(), -b))
            part.append(best)
            free.remove(best)
        out.append(part)
    return out


def plan(sample: np.ndarray, total: int, radius: int) -> list[tuple[int, int]]:
    """(mask, threshold) of the parts that are probed, at the least estimated rows and comparisons."""
    best: tuple[float, list[tuple[int, int]]] | None = None
    probe_cost, pair_cost = 1.0, 0.05
    some = sample[:1024]
    apart = some[:, None] ^ some[None, :]
    off = ~np.eye(len(some), dtype=bool)
    for parts in range(2, min(5, radius + 2)):
        masks = [sum(1 << b for b in part) for part in _parts(sample, parts)]
        costs = []
        for mask in masks:
            width = mask.bit_count()
            seen = np.bincount(np.bitwise_count(apart & np.uint64(mask))[off], minlength=65) / max(1, off.sum())
            cost = {-1: 0.0}
            for t in range(0, radius + 1):
                rows = 1 + sum(comb(width, r) for r in range(1, t + 1)) / 2
                agree = max(float(seen[: t + 1].sum()), sum(comb(width, r) for r in range(t + 1)) / 2**width)
                cost[t] = total * (probe_cost * rows + pair_cost * agree * total)
            costs.append(cost)
        # least cost of the parts so far for each sum of their thresholds
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            step: dict[int, tuple[float, list[int]]] = {}
            for done, (spent, chosen) in table.items():
                for t, c in cost.items():
                    if done + t not in step or spent + c < step[done + t][0]:
                        step[done + t] = (spent + c, [*chosen, t])
            table = step
        spent, chosen = table[radius - parts + 1]
        if best is None or spent < best[0]:
            best = (spent, [(m, t) for m, t in zip(masks, chosen) if t >= 0])
    return best[1]


# --- probing ------------------------------------------------------------------------------


def _probes(chosen: list[tuple[int, int]]):
    """Rows (key, free, fp, own) of each fingerprint for every part that is probed."""
    flips = []
    for mask, t in chosen:
        bits = [1 << b for b in range(64) if mask >> b & 1]
        flips.append(np.array([sum(c) for r in range(1, t + 1) for c in combinations(bits, r)], dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ = batch.column(0).to_numpy().view(np.uint64)
            spaces = batch.column(1).to_numpy().astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
            for lo in range(0, len(all_), 4096):
                fps, space = all_[lo : lo + 4096], spaces[lo : lo + 4096]
                for number, ((mask, _), flip) in enumerate(zip(chosen, flips)):
                    value = fps & np.uint64(mask)
                    other = value[:, None] ^ flip[None, :]
                    who, which = np.nonzero(other > value[:, None])
                    salt = np.uint64((number + 1) * 0xD6E8FEB86659FD93 % (1 << 64))
                    key = _mixed(np.concatenate((value, other[who, which])) ^ salt, 1) ^ np.concatenate((space, space[who]))
                    n = len(key)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key.view(np.int64)),
                            pa.array(np.full(n, ~mask & (1 << 64) - 1, dtype=np.uint64).view(np.int64)),
                            pa.array(np.concatenate((fps, fps[who])).view(np.int64)),
                            pa.array(np.arange(n) < len(fps)),
                        ],
                        names=["key", "free", "fp", "own"],
                    )

    return run


_PROBE = "key long, free long, fp long, own boolean"


def _splitter(parts: int):
    """Each row under ``parts`` finer keys: of that many parts of the free bits one agrees if fewer bits differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, free, fp = (batch.column(i).to_numpy().view(np.uint64) for i in range(3))
            own = batch.column(3)
            for mask in np.unique(free).tolist():
                at = np.nonzero(free == np.uint64(mask))[0]
                bits = [b for b in range(64) if mask >> b & 1]
                for k in range(parts):
                    part = sum(1 << b for b in bits[k::parts])
                    finer = _mixed(_mixed(key[at], k + 1) ^ (fp[at] & np.uint64(part)), 7)
                    left = np.full(len(at), mask & ~part, dtype=np.uint64)
                    columns = [pa.array(x.view(np.int64)) for x in (finer, left, fp[at])]
                    yield pa.RecordBatch.from_arrays([*columns, own.take(pa.array(at))], names=["key", "free", "fp", "own"])

    return run


def links_within(members: np.ndarray, radius: int, all_pairs: int) -> list[tuple[int, int]]:
    """Links among distinct fingerprints: all within the radius of a small group, a spanning forest of them of a larger one.

    The forest starts from the members with the most neighbours and reaches every
    member that any link reaches; comparing takes memory for a few rows of the table only.
    """
    n = len(members)
    if n <= all_pairs:
        a, b = np.nonzero(np.triu(np.bitwise_count(members[:, None] ^ members[None, :]) <= radius, 1))
        return list(zip(members[a].tolist(), members[b].tolist()))
    degree = np.concatenate([(np.bitwise_count(members[lo : lo + 64, None] ^ members[None, :]) <= radius).sum(axis=1) for lo in range(0, n, 64)])
    members = members[np.argsort(-degree, kind="stable")]
    degree = -np.sort(-degree, kind="stable")
    rest = np.arange(n)[degree > 1]
    out: list[tuple[int, int]] = []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop(0)
            near = np.bitwise_count(members[rest] ^ members[at]) <= radius
            found, rest = rest[near], rest[~near]
            out.extend((int(members[at]), int(members[x])) for x in found)
            queue.extend(found)
    return out


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by key, the first column, cut between keys only; a null becomes 0."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.fill_null(False if pa.types.is_boolean(c.type) else 0).to_numpy(zero_copy_only=False) for c in batch.columns]
        key = columns[0]
        last = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
        if held and held[-1][0][-1] == key[-1]:
            held.append(columns)
            continue
        held.append([c[:last] for c in columns])
        done = [h for h in held if len(h[0])]
        if done:
            yield [np.concatenate(c) for c in zip(*done)]
        held = [[c[last:] for c in columns]]
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _edges(found: list[tuple[int, int]]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Columns a < b of pairs of different fingerprints."""
    for lo in range(0, len(found), 50_000):
        both = np.array(found[lo : lo + 50_000], dtype=np.uint64).view(np.int64)
        both = both[both[:, 0] != both[:, 1]]
        yield pa.array(both.min(axis=1)), pa.array(both.max(axis=1))


def _links(radius: int, all_pairs: int):
    """Rows (key, fp, own) sorted by key: links within each key that any fingerprint has as its own, and the keys of larger groups."""

    def pairs(key: np.ndarray, fp: np.ndarray, own: np.ndarray) -> tuple[list[tuple[int, int]], list[int]]:
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        owners = np.add.reduceat(own.astype(np.int64), starts)
        two = (sizes == 2) & (owners >= 1)
        first = starts[two]
        near = np.bitwise_count(fp[first] ^ fp[first + 1]) <= radius
        out = list(zip(fp[first][near].tolist(), fp[first + 1][near].tolist()))
        crowds = []
        for at in np.flatnonzero((sizes > 2) & (owners >= 1)).tolist():
            members = np.unique(fp[starts[at] : starts[at] + sizes[at]])
            out.extend(links_within(members, radius, all_pairs))
            if len(members) > all_pairs:
                crowds.append(int(key[starts[at]]))
        return out, crowds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fp, own in _whole_keys(batches):
            found, crowds = pairs(key, fp.view(np.uint64), own)
            for a, b in _edges(found):
                yield pa.RecordBatch.from_arrays([a, b, pa.nulls(len(a), pa.int64())], names=["a", "b", "crowd"])
            if crowds:
                none = pa.nulls(len(crowds), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(crowds, pa.int64())], names=["a", "b", "crowd"])

    return run


def _crossing(radius: int):
    """Rows (key, fp, tag, known) sorted by key: all pairs within the radius whose known tags do not agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fps, tags, known in _whole_keys(batches):
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])).tolist()
            for lo, hi in zip(starts, [*starts[1:], len(key)]):
                fp, tag, sure = fps[lo:hi].view(np.uint64), tags[lo:hi], known[lo:hi].astype(bool)
                for at in range(0, hi - lo, 64):
                    to = min(at + 64, hi - lo)
                    near = np.bitwise_count(fp[at:to, None] ^ fp[None, at:]) <= radius
                    near &= (tag[at:to, None] != tag[None, at:]) | ~(sure[at:to, None] & sure[None, at:])
                    i, j = np.nonzero(np.triu(near, 1))
                    for a, b in _edges(list(zip(fp[at + i].tolist(), fp[at + j].tolist()))):
                        yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    return run


def _dealt(rows: DataFrame) -> DataFrame:
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, "key").sortWithinPartitions("key")


def search(fps: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """The written links ``a, b, crowd`` between the distinct fingerprints ``fp`` of each ``space``, and the probes.

    Linked fingerprints differ in ``radius`` bits at most, and fingerprints that do are
    connected by links. A key under which more than ``HOT`` fingerprints stand is split by
    radius + 1 further parts of the free bits, one of which must agree, until none is left.
    Rows with a ``crowd`` name the keys of more than ``ALL_PAIRS`` fingerprints, which a forest connects.
    """
    spark = fps.sparkSession
    fps = fps.select("fp", "space")
    first = fps.where("space = 0")  # the plan of one space serves all
    total = first.count()
    share = F.pmod(F.xxhash64(F.col("fp"), F.lit("sample")), F.lit(1 << 40)) < F.lit(int((1 << 40) * min(1.0, SAMPLE / max(total, 1))))
    sample = np.array([r[0] for r in first.where(share).select("fp").collect()], dtype=np.int64).view(np.uint64)
    chosen = plan(np.sort(sample), total, radius)
    rows = fps.mapInArrow(_probes(chosen), _PROBE)
    own = fps.mapInArrow(_probes([(m, 0) for m, _ in chosen]), _PROBE)
    while True:
        hot = own.groupBy("key").count().where(F.col("count") > HOT).select(F.col("key").alias("k"))
        hot = write_scratch(hot, "simhash-hot")
        if hot.isEmpty():
            break
        cold = rows.join(hot, F.col("key") == F.col("k"), "left_anti")
        split = rows.join(hot, F.col("key") == F.col("k"), "left_semi")
        keep = split.where(F.col("free") == 0)
        finer = split.where(F.col("free") != 0).select("key", "free", "fp", "own").mapInArrow(_splitter(radius + 1), _PROBE)
        rows = write_scratch(cold.unionByName(keep).unionByName(finer), "simhash-probes")
        own = rows.where("own and free != 0")
    found = _dealt(rows.select("key", "fp", "own")).mapInArrow(_links(radius, ALL_PAIRS), "a long, b long, crowd long").distinct()
    return write_scratch(found, "simhash-links"), rows


def links(fps: DataFrame, radius: int) -> DataFrame:
    """The links ``a < b`` of ``search``."""
    return search(fps, radius)[0].where("crowd is null").select("a", "b")


def crossing(found: DataFrame, rows: DataFrame, tags: DataFrame, radius: int) -> DataFrame:
    """All pairs ``a < b`` within the radius under a crowded key whose tags differ, or are not known.

    ``tags`` has a ``tag`` (or null) for every ``fp``. Where a forest has joined what belongs together, few are left.
    """
    crowds = found.where("crowd is not null").select("crowd")
    rows = rows.select("key", "fp").join(crowds, F.col("key") == F.col("crowd"), "left_semi").join(tags, "fp")
    rows = rows.select("key", "fp", "tag", F.col("tag").isNotNull().alias("known")).distinct()
    return _dealt(rows).mapInArrow(_crossing(radius), "a long, b long").distinct()


# --- components ---------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of the edges ``a, b``: the least node that it reaches.

    Each round ties the greater neighbours of a node to its least one, then the node and its
    lesser neighbours, until no edge changes; the rounds grow with the logarithm of the nodes.
    Minima are taken before the shuffle, so a node with very many edges is no burden.
    """
    edges = write_scratch(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    mark = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        large = write_scratch(large, "edges-large")
        lesser = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(lesser, "b").select(F.col("m"), F.explode(F.array("a", "b")).alias("v"))
        edges = write_scratch(small.where("m < v").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    stars = edges.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root")
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())


def fingerprints(docs: DataFrame, text: str, keep: list[str], size: int, distinct: bool = False, salts: tuple[int, ...] = (0,)) -> DataFrame:
    """``keep`` and ``fps``, a fingerprint (signed long) for each salt."""
    source = modest_batches(docs).select(*keep, F.col(text).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("simhash")
        for batch in batches:
            found = fingerprint_batch(batch.columns[-1].to_pylist(), size, distinct, salts)
            flat = pa.array(np.ascontiguousarray(found.T).reshape(-1).view(np.int64))
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(salts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(offsets, flat)], names=[*batch.schema.names[:-1], "fps"])

    return source.mapInArrow(run, with_fields(source.drop("_text"), "fps array<long>"))


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 3, radius: int = 3) -> DataFrame:
    """``key, fingerprint, component_id`` of every document.

    The fingerprint of ``size``-word shingles as 16 hex digits, and the least key among the
    documents reachable over links of at most ``radius`` differing bits. A null text or one
    without words has fingerprint zero and is linked like any other. Rows with equal fingerprints
    are one node, so copies are never paired; null keys take part and never are the least
    unless there is no other. Other columns are not read; an empty table gives an empty result.
    """
    marked = fingerprints(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", ["key"], size)
    marked = write_scratch(marked.select("key", F.col("fps")[0].alias("fp")), "simhash-fingerprints")
    nodes = write_scratch(marked.groupBy("fp").agg(F.min("key").alias("first")), "simhash-nodes")
    roots = write_scratch(components(links(nodes.withColumn("space", F.lit(0)), radius)), "simhash-roots")
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = write_scratch(rooted.join(least, "root").select(F.col("fp").alias("f"), "component_id"), "simhash-classes")
    return marked.join(found, F.col("fp") == F.col("f")).select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


# --- one document of each group -----------------------------------------------------------


def _shingle_sets(rows: DataFrame, text: str, size: int) -> DataFrame:
    """``h`` and the sorted distinct hashes of the shingles of each text."""
    def sets(columns: dict[str, list]) -> dict[str, list]:
        hashes = [sorted({xxhash.xxh64_intdigest(s, SEED) for s in shingles(t, size)}) for t in columns["body"]]
        return {"h": columns["h"], "hashes": [np.array(x, dtype=np.uint64).view(np.int64).tolist() for x in hashes]}

    return map_batches(rows.select("h", F.col(text).cast("binary").alias("body")), sets, "h string, hashes array<long>")


def band_keys(hashes: np.ndarray) -> list[int]:
    """A signed key for each band of the minimum hashes of a set of shingle hashes; none for an empty set."""
    if not len(hashes):
        return []
    drawn = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * DEPTH), dtype=np.uint64)
    least = np.full(BANDS * DEPTH, (1 << 64) - 1, dtype=np.uint64)
    for lo in range(0, len(hashes), 512):
        np.minimum(least, ((hashes[lo : lo + 512, None] ^ drawn[0]) * (drawn[1] | np.uint64(1))).min(axis=0), out=least)
    keys = [xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(least.reshape(BANDS, DEPTH))]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def bands(rows: DataFrame, text: str, size: int) -> DataFrame:
    """``h``, the number ``n`` of distinct shingles and a ``band`` for each band value that another text has too."""
    def keyed(columns: dict[str, list]) -> dict[str, list]:
        remembered("simhash")
        hashes = [np.array([xxhash.xxh64_intdigest(s, SEED) for s in set(shingles(t, size))], dtype=np.uint64) for t in columns["body"]]
        return {"h": columns["h"], "n": [len(x) for x in hashes], "bands": [band_keys(x) for x in hashes]}

    found = map_batches(rows.select("h", F.col(text).cast("binary").alias("body")), keyed, "h string, n long, bands array<long>")
    found = found.groupBy("h").agg(F.first("n").alias("n"), F.first("bands").alias("bands"))
    found = write_scratch(found.select("h", "n", F.explode("bands").alias("band")), "dedupe-bands")
    crowds = found.groupBy("band").count().where(F.col("count") > 1).select(F.col("band").alias("k"))
    return write_scratch(found.join(crowds, F.col("band") == F.col("k"), "left_semi"), "dedupe-meetings")


def meet(cells: DataFrame, joined: DataFrame, compared: DataFrame, alike, least: float) -> tuple[DataFrame, DataFrame]:
    """``joined`` and ``compared`` with all pairs that share a band and are not joined by then.

    In each round a growing share of the texts, by their hash, meets all the others under its band values; a value all
    of whose texts are joined is done. A pair whose sizes alone rule out the similarity is left out.
    """
    largest = cells.groupBy("band").count().agg(F.max("count")).first()[0]
    if largest is None:
        return joined, compared
    place = F.pmod(F.xxhash64("h", F.lit("pivot")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    low, share = 0.0, PIVOTS / largest
    while low < 1.0:
        share = share if share < 1.0 else 1.0
        roots = write_scratch(components(joined), "dedupe-roots")
        now = cells.withColumn("place", place).where(F.col("place") >= low).join(roots, F.col("h") == F.col("node"), "left")
        now = write_scratch(now.select("h", "n", "band", "place", F.coalesce("root", "h").alias("root")), "dedupe-round")
        apart = now.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select(F.col("band").alias("k"))
        now = write_scratch(now.join(apart, F.col("band") == F.col("k"), "left_semi"), "dedupe-round")
        if now.isEmpty():
            break
        first = now.where(F.col("place") < share).select("band", F.col("h").alias("x"), F.col("n").alias("m"), F.col("root").alias("r"))
        both = first.join(now, "band").where((F.col("r") != F.col("root")) & (F.least("m", "n") >= F.lit(least) * F.greatest("m", "n")))
        pairs = both.select(F.least("x", "h").alias("x"), F.greatest("x", "h").alias("y")).distinct()
        pairs = write_scratch(pairs.join(compared, ["x", "y"], "left_anti"), "dedupe-pairs")
        joined, compared = joined.union(alike(pairs)), compared.union(pairs)
        low, share = share, share * GROWTH
    return joined, compared


def _rows_of(docs: DataFrame, body: Column, key: str, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose MD5 of ``body`` and key are in ``kept``, with how often they occur; of fully equal (key, text) rows one."""
    of_text, of_key, times = own_names(docs, "of_text", "of_key", "times_held")
    kept = write_scratch(kept.toDF(of_text, of_key, times), "dedupe-kept")
    found = docs.join(kept, (F.md5(body) == F.col(of_text)) & F.col(key).eqNullSafe(F.col(of_key)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    single = found.where(F.col(times) == 1).select(*columns)
    if kept.where(F.col(times) > 1).isEmpty():
        return single
    return single.unionByName(found.where(F.col(times) > 1).dropDuplicates([of_text, of_key]).select(*columns))


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one document of each class of ``classes``: that with the least key, all columns as they were.

    Documents are alike by their fingerprints alone, directly or over others; words are not compared
    (``keep_one`` does that). Null and empty texts and texts without words are one class. A null key stays only
    where its class has no other; equal keys with different texts are told apart by the MD5 of the text, and of
    fully equal (key, text) rows one stays. An empty table gives an empty result; helper names never clash.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    who = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.md5(body).alias("h"))
    found = classes(docs.select(who.alias("who"), body.alias("text")), "text", "who", size, radius)
    kept = found.where("who = component_id").groupBy("who").agg(F.count(F.lit(1)).alias("times"))
    return _rows_of(docs, body, key, kept.select("who.h", "who.key", "times"))


def keep_one(
    docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = 4, salts: tuple[int, ...] = (0, 1, 2, 3, 4, 5), size: int = 5, least: float = 0.8
) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: that with the least key, all columns as they were.

    Equal texts are one group; null texts count as empty, and texts without words are alike. Other texts are linked if the sets of their ``size``-word shingles
    have a Jaccard similarity of ``least`` or more, which is computed for all pairs that come within
    ``radius`` bits in the SimHash of their distinct words under any of the salts, or agree in a band of
    minimum hashes of their shingles. SimHash finds scattered edits; text that is appended, cut off or put in as one stretch
    moves it too far, the bands find that too. One text of
    each fingerprint is compared first, along a spanning forest where more than ``ALL_PAIRS`` fingerprints stand under one
    key, then what shares a band, then every other pair within ``radius`` bits that the similar ones have not joined.
    Null keys are the least. Of fully equal (key, text) rows one stays.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    hashed = docs.select(F.col(key).alias("key"), F.md5(body).alias("h"), body.alias("text"))
    marked = write_scratch(fingerprints(hashed, "text", ["key", "h"], 1, True, salts), "dedupe-fingerprints")
    nodes = marked.groupBy("h").agg(F.first("fps").alias("fps"), F.min(F.struct("key")).alias("first"))
    nodes = write_scratch(nodes.select("h", "fps", F.col("first.key").alias("first")), "dedupe-nodes")
    prints = write_scratch(nodes.select("h", F.posexplode("fps").alias("space", "fp")).groupBy("space", "fp").agg(F.min("h").alias("rep"), F.max("h").alias("other")), "dedupe-prints")
    found, probes = search(prints, radius)
    near = found.where("crowd is null").select("a", "b")
    shared = prints.where("rep <> other").select(F.col("space").alias("s"), F.col("fp").alias("f"), "rep")
    touched = near.select(F.col("a").alias("t")).union(near.select("b")).union(shared.select("f")).distinct()
    cells = nodes.select(F.posexplode("fps").alias("space", "fp"), "h").join(touched, F.col("fp") == F.col("t"), "left_semi")
    cells = write_scratch(cells, "dedupe-cells")  # the texts of all fingerprints that have company

    meetings = bands(hashed, "text", size)
    ends = cells.select("h").union(meetings.select("h")).distinct().join(nodes.select(F.col("h").alias("e"), "first"), F.col("h") == F.col("e")).select("e", "first")
    ends = write_scratch(ends, "dedupe-ends")
    same = (F.col("h") == F.col("e")) & F.col("key").eqNullSafe(F.col("first"))
    company = write_scratch(_shingle_sets(hashed.join(ends, same), "text", size).dropDuplicates(["h"]), "dedupe-shingles")

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()

    def alike(pairs: DataFrame) -> DataFrame:
        """Those of the written pairs whose shingle sets are similar enough, as ``a, b``."""
        ends = pairs.select(F.col("x").alias("e")).union(pairs.select("y")).distinct()
        sets = company.join(ends, F.col("h") == F.col("e"), "left_semi")
        both = pairs.join(sets.select(F.col("h").alias("x"), F.col("hashes").alias("p")), "x").join(sets.select(F.col("h").alias("y"), F.col("hashes").alias("q")), "y")
        common = F.size(F.array_intersect("p", "q"))
        similar = both.where(common >= F.lit(least) * (F.size("p") + F.size("q") - common))
        return write_scratch(similar.select(F.col("x").alias("a"), F.col("y").alias("b")), "dedupe-alike")

    # First one text stands for its fingerprint, which joins most of what belongs together.
    reps = prints.select("fp", "rep")
    across = near.join(reps.select(F.col("fp").alias("a"), F.col("rep").alias("x")), "a").join(reps.select(F.col("fp").alias("b"), F.col("rep").alias("y")), "b")
    within = cells.join(shared, (F.col("space") == F.col("s")) & (F.col("fp") == F.col("f"))).select(F.col("rep").alias("x"), F.col("h").alias("y"))
    pairs = write_scratch(ordered(across.select("x", "y").union(within)), "dedupe-pairs")
    joined, pairs = meet(meetings, alike(pairs), pairs, alike, least)
    roots = write_scratch(components(joined), "dedupe-roots")
    # Then every pair of texts within the radius that is neither compared nor joined.
    members = cells.select("fp", "h").distinct().join(roots, F.col("h") == F.col("node"), "left").select("fp", "h", F.coalesce("root", "h").alias("root"))
    members = write_scratch(members, "dedupe-members")
    tags = members.groupBy("fp").agg(F.min(F.xxhash64("root")).alias("tag"), F.max(F.xxhash64("root")).alias("other"))
    tags = write_scratch(tags.select("fp", F.when(F.col("tag") == F.col("other"), F.col("tag")).alias("tag")), "dedupe-tags")
    apart = near.union(tags.where("tag is null").select("fp", "fp"))
    if not found.where("crowd is not null").isEmpty():
        apart = apart.union(crossing(found, probes, tags, radius))
    groups = members.groupBy("fp", "root").agg(F.count(F.lit(1)).alias("texts"))
    left, right = (groups.select(F.col("fp").alias(f), F.col("root").alias(r)) for f, r in (("a", "u"), ("b", "v")))
    apart = apart.distinct().join(left, "a").join(right, "b").where("u <> v")
    more = apart.join(members.select(F.col("fp").alias("a"), F.col("root").alias("u"), F.col("h").alias("x")), ["a", "u"])
    more = more.join(members.select(F.col("fp").alias("b"), F.col("root").alias("v"), F.col("h").alias("y")), ["b", "v"])
    more = write_scratch(ordered(more.select("x", "y")).join(pairs, ["x", "y"], "left_anti"), "dedupe-more")
    if not more.isEmpty():
        roots = write_scratch(components(joined.union(alike(more))), "dedupe-roots")
    rooted = nodes.join(roots, F.col("h") == F.col("node"), "left").select("h", "first", F.coalesce("root", "h").alias("root"))
    kept = rooted.groupBy("root").agg(F.min(F.struct("first", "h")).alias("one")).select("one.first", "one.h")
    times = marked.groupBy(F.col("h").alias("g"), F.col("key").alias("k")).agg(F.count(F.lit(1)).alias("times"))
    kept = kept.join(times, (F.col("h") == F.col("g")) & F.col("first").eqNullSafe(F.col("k"))).select(F.col("h").alias("h"), "first", "times")
    return _rows_of(docs, body, key, kept)
