"""Periodic runs of words by a sparse dynamic programme over diagonals.

A diagonal is a lag: it matches at a word that equals the word so many places before. Word by word, the
earlier occurrences of a word open their lags, a lag that goes on matching has its length
increased, and one that ends is emitted at once if what it matched is long enough: m matches at lag q
make a stretch of m + q words with period q, and m >= q makes it a run. Multiples of
a period give the same stretch, of which the smallest lag is kept.

Only lags that can become runs are opened. A run of 12 words or more has at least 6 matches in a row, so a
lag opens where the next 6 words have stood before, where the word before differs, and where the
lag is at most as long as the longest repeat that starts there and as what is left of the text. Inside a
run of period q its multiples are not opened. All of that leaves every run in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from linkrisk.llm.common import modest_batches, remembered, with_fields

#: Words whose windows are looked up together; a longer text is taken alone, as a whole.
TOGETHER = 200_000
#: Words of the smallest run.
LEAST = 12


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Windows:
    """The windows of ``size`` words that their text holds twice.

    ``words`` are numbers unique to a text, ``ends`` the end of the text of each position. ``positions`` are where such
    windows start, and ``reach`` a length that no repeat from a position on reaches. Windows are
    compared by hash: a collision may name a window too many, never one too few.
    """

    def __init__(self, words: np.ndarray, ends: np.ndarray, size: int) -> None:
        n = len(words)
        at = np.flatnonzero(np.arange(n) + size <= ends)
        hashes = np.zeros(n, np.uint64)
        for k in range(size):
            hashes[at] = _mix(hashes[at] * np.uint64(3) + words[at + k].astype(np.uint64) + np.uint64(1))
        first, live, length = hashes, _twice(at, hashes), size
        self.positions = live
        self.reach = np.full(n, size, np.int64)
        while len(live):
            self.reach[live] = 2 * length
            longer = live[live + 2 * length <= ends[live]]
            doubled = np.zeros(n, np.uint64)
            doubled[longer] = _mix(hashes[longer] * np.uint64(5) + hashes[longer + length])
            # a window of twice the length stands twice only where both halves do
            alive = np.zeros(n, bool)
            alive[live] = True
            live = _twice(longer[alive[longer + length]], doubled)
            hashes, length = doubled, 2 * length
        # equal windows next to each other, by position; where each one and the first of its kind stand there
        self.ordered = self.positions[np.lexsort((self.positions, first[self.positions]))]
        same = np.append(False, first[self.ordered[1:]] == first[self.ordered[:-1]]) if len(self.ordered) else np.empty(0, bool)
        order = np.arange(len(same))
        self.place, self.head = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.place[self.ordered] = order
        self.head[self.ordered] = np.maximum.accumulate(np.where(same, 0, order))
        self.before = np.full(n, -1, np.int64)
        again = np.flatnonzero(same)
        self.before[self.ordered[again]] = self.ordered[again - 1]


def _twice(at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The positions, ascending, whose hash another one of them has."""
    by = at[np.argsort(hashes[at], kind="stable")]
    h = hashes[by]
    same = np.flatnonzero(h[1:] == h[:-1])
    twice = np.zeros(len(h), bool)
    twice[same] = twice[same + 1] = True
    return np.sort(by[twice])


def text_runs(words: np.ndarray, first: int, end: int, windows: Windows, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of the text at ``words[first:end]``, counted from its start, by start, then period."""
    here_all = np.arange(first, end)
    # a lag is shorter than the repeat from here on, and at most as long as what is left of the text
    bound = np.minimum(windows.reach[first:end] - 1, end - here_all)
    opening = here_all[(windows.before[first:end] >= 0) & (here_all - windows.before[first:end] <= bound)].tolist()
    if not opening:
        return []
    found: dict[tuple[int, int], int] = {}
    lags, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    here, next_ = first, 0
    while here <= end:
        if not len(lags):
            if next_ == len(opening):
                break
            here = opening[next_]
        same = words[here - lags] == words[here] if here < end else np.zeros(len(lags), bool)
        if same.all():
            counts += 1
        else:
            over = ~same
            for lag, count in zip(lags[over].tolist(), counts[over].tolist()):
                start, length = here - count - lag - first, count + lag
                if count >= lag and length >= least:
                    found[start, length] = min(lag, found.get((start, length), lag))
            lags, counts = lags[same], counts[same] + 1
        if next_ < len(opening) and opening[next_] == here:
            next_ += 1
            if len(lags) == 1 and windows.before[here] == here - (q := int(lags[0])) and (start := here - int(counts[0]) + 1 - q) + 2 * q <= here + 1:
                if windows.ordered[windows.head[here]] >= start:  # all earlier places lie in this run, periods apart
                    here += 1
                    continue
            new = _opened(words, first, here, int(bound[here - first]), windows, lags, counts)
            if len(new):
                lags, counts = np.append(lags, new), np.append(counts, np.ones(len(new), np.int64))
        here += 1
    return sorted((start, length, period) for (start, length), period in found.items())


def _opened(words: np.ndarray, first: int, here: int, bound: int, windows: Windows, lags: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The lags of at most ``bound`` that begin to match here and are not sure to give no run.

    Let both places lie in a run of period q that the lag exceeds. A multiple of q gives the same run. Any other
    lag would match for less than q words inside it, so it can only matter if the run ends within q words.
    """
    ordered, lo, hi = windows.ordered, windows.head[here], windows.place[here]
    lo += np.searchsorted(ordered[lo:hi], here - bound)
    parts = [(lo, hi)]
    odd = []
    for q, count in zip(lags[counts >= lags].tolist(), counts[counts >= lags].tolist()):
        start = here - count + 1 - q
        # where the window was last met one period ago, all its places in the run are periods apart
        if windows.before[here] == here - q or np.array_equal(words[here : here + q], words[here - q : here]):
            a, b = lo + np.searchsorted(ordered[lo:hi], start), lo + np.searchsorted(ordered[lo:hi], here - q, side="right")
            parts = [(x, y) for s, e in parts for x, y in ((s, min(e, a)), (max(s, b), e)) if x < y]
        else:
            odd.append((q, start))
    if not parts:
        return lags[:0]
    at = np.concatenate([ordered[a:b] for a, b in parts])
    begins = at == first
    begins |= words[at - 1] != words[here - 1]
    at = at[begins]
    for q, start in odd:
        at = at[((here - at) % q != 0) | (at < start)]
    return here - at


def collapsed(n: int, runs: Iterable[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when every run keeps its first period only."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) == 0


def batch_runs(texts: Iterable[list[bytes]], least: int = LEAST) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """The words of each text and its runs; texts are taken together up to ``TOGETHER`` words."""
    group: list[list[bytes]] = []
    total = 0
    for words in texts:
        if group and total + len(words) > TOGETHER:
            yield from _group_runs(group, least)
            group, total = [], 0
        group.append(words)
        total += len(words)
    yield from _group_runs(group, least)


def _group_runs(group: list[list[bytes]], least: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    sizes = np.array([len(w) for w in group], np.int64)
    bounds = np.append(0, np.cumsum(sizes))
    numbers: dict[bytes, int] = {}
    plain = np.fromiter((numbers.setdefault(w, len(numbers)) for words in group for w in words), np.int64, int(bounds[-1]))
    own = plain + np.repeat(np.arange(len(group)), sizes) * max(1, len(numbers))
    twice = Windows(own, np.repeat(bounds[1:], sizes), max(1, least // 2))
    some = np.searchsorted(twice.positions, bounds)
    for i, words in enumerate(group):
        # mostly no window of a text stands twice
        yield words, text_runs(plain, int(bounds[i]), int(bounds[i + 1]), twice, least) if some[i] < some[i + 1] else []


def best_run(runs: str = "runs") -> Column:
    """The longest run of an array as a struct, ties to the smallest start, then period; null if there is none."""
    return F.array_max(F.transform(runs, lambda r: F.struct(r["length"], (-r["start"]).alias("back"), (-r["period"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))


def find(
    docs: DataFrame, text: str = "text", keep: list[str] = ("doc_id",), rewrite: Callable[[list[bytes], int | None], list[bytes]] | None = None, by: Column | None = None
) -> DataFrame:
    """``keep`` and the runs of every whole text, its words counted from 0.

    ``n_words long, runs array<struct<start, length, period>>`` by start, then period, and ``collapsed``: the
    words that stay when each run keeps its first period only, joined by one space. A null or empty text
    has no words and no runs. Rows do not depend on each other, so equal rows give equal rows and
    an empty table an empty result. A kept column must not have one of these names. ``rewrite`` changes the
    words of a text before they are looked at, given the long ``by`` of its row. A text that repeats
    long stretches in many different ways takes time up to the square of its length, memory in proportion to it.
    """
    source = modest_batches(docs).select(*keep, (F.lit(None) if by is None else by).cast("long").alias("_by"), F.col(text).cast("binary").alias("_text"))
    schema = with_fields(docs.select(*keep), "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("runs")
        struct = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in batches:
            texts = ((t.as_py() or b"").split() for t in batch.columns[-1])
            if rewrite is not None:
                texts = (rewrite(words, b) for words, b in zip(texts, batch.columns[-2].to_pylist()))
            counts, rows, left = [], [], []
            for words, found in batch_runs(texts):
                counts.append(len(words))
                rows.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                left.append(b" ".join([words[i] for i in np.flatnonzero(collapsed(len(words), found)).tolist()] if found else words).decode())
            arrays = [pa.array(counts, pa.int64()), pa.array(rows, struct), pa.array(left, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *arrays], names=[*batch.schema.names[:-2], "n_words", "runs", "collapsed"])

    return source.mapInArrow(run, schema)
