"""Repetition within a text by suffix arrays of its words.

Suffixes are sorted by doubling prefix ranks; neighbours in that order share their longest
common prefix, and the intervals of equal prefixes are the maximal repeated substrings. The
deepest interval of a suffix is as long as the longer prefix it shares with a neighbour, so
the union of these stretches is the union of all repeats. Many texts share one array: a
word is numbered per text, so no prefix reaches from one text into another.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkrisk.llm.common import beside_text, remembered, with_fields

#: Words whose suffixes are sorted together; a longer text is sorted alone, as a whole.
TOGETHER = 200_000
SYMBOLS = "#*$%&|<>"
SPACES = (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")


def longest_repeats(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position the length of the longest stretch from there that its text holds twice.

    ``words`` are numbers unique to a text, ``ends`` the end of the text of each position.
    """
    n = len(words)
    found = np.zeros(n, dtype=np.int64)
    if n < 2:
        return found
    order = np.argsort(words, kind="stable")
    new = np.empty(n, dtype=bool)
    new[0] = True
    np.not_equal(words[order[1:]], words[order[:-1]], out=new[1:])
    starts = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = starts
    ranks, step = [rank.copy()], 1
    single = new & np.append(new[1:], True)
    active = order[~single]
    while len(active):
        ahead = active + step
        inside = ahead < ends[active]
        second = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        old = rank[active]
        at = np.arange(len(active))
        group = np.append(True, old[1:] != old[:-1])
        base = np.maximum.accumulate(np.where(group, at, 0))
        new = np.append(True, key[1:] != key[:-1])
        first = np.maximum.accumulate(np.where(new, at, 0))
        order[old + at - base] = active
        rank[active] = old + first - base
        active = active[~(new & np.append(new[1:], True))]
        step *= 2
        ranks.append(rank.copy())
    a, b = order[:-1], order[1:]
    some = np.nonzero(ranks[0][a] == ranks[0][b])[0]
    a, b = a[some], b[some]
    shared = np.zeros(len(some), dtype=np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        x, y = a + shared, b + shared
        inside = (x < ends[a]) & (y < ends[b])
        same = inside & (ranks[level][np.minimum(x, n - 1)] == ranks[level][np.minimum(y, n - 1)])
        shared += same * (1 << level)
    np.maximum.at(found, a, shared)
    np.maximum.at(found, b, shared)
    return found


def covered(found: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in a repeat of at least ``least`` words."""
    at = np.nonzero(found >= least)[0]
    edges = np.zeros(len(found) + 1, dtype=np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + found[at], -1)
    return np.cumsum(edges[:-1]) > 0


def spans(inside: np.ndarray) -> list[tuple[int, int]]:
    """Runs of covered positions as (start, end)."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def measure(texts: Iterable[bytes | None], least: int, with_spans: bool = False) -> list[tuple]:
    """Per text: words, words in repeated 3-word windows, words in repeats of ``least`` words, longest repeat, spans.

    Only the words of the texts that are sorted together are held at a time.
    """
    rows: list[tuple] = []
    group: list[list[bytes]] = []
    total = 0
    for text in texts:
        words = text.split() if text else []
        if group and total + len(words) > TOGETHER:
            rows.extend(_measure_together(group, least, with_spans))
            group, total = [], 0
        group.append(words)
        total += len(words)
    if group:
        rows.extend(_measure_together(group, least, with_spans))
    return rows


def _measure_together(split: list[list[bytes]], least: int, with_spans: bool) -> list[tuple]:
    rows: list[tuple] = []
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    words = np.fromiter((numbers[w] for text in split for w in text), dtype=np.int64, count=int(sizes.sum()))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    found = longest_repeats(words + np.repeat(np.arange(len(split)), sizes) * len(numbers), np.repeat(bounds[1:], sizes))
    windows, long_ = covered(found, 3), covered(found, least)
    sums = [np.concatenate(([0], np.cumsum(c)))[bounds] for c in (windows, long_)]
    for i, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        longest = int(found[lo:hi].max()) if hi > lo else 0
        own = spans(long_[lo:hi]) if with_spans else []
        rows.append((hi - lo, int(sums[0][i + 1] - sums[0][i]), int(sums[1][i + 1] - sums[1][i]), longest, own))
    return rows


def _base(text: str | None) -> tuple[int, int, int]:
    """Code points in words, symbols, and lines equal to an earlier line."""
    if not text:
        return 0, 0, 0
    raw = text.encode()
    lines = [line for line in text.split("\n") if line.strip(" \t\v\f\r")]
    return len(text) - sum(raw.count(s) for s in SPACES), sum(text.count(s) for s in SYMBOLS), len(lines) - len(set(lines))


def repeats(docs: DataFrame, text: str = "text", keep: list[str] = ("doc_id",), least: int = 10, with_spans: bool = True) -> DataFrame:
    """Measures of every whole text, next to the columns ``keep``.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words,
    longest_repeat, repeat_spans``: the spans are [start, end) word positions of the merged
    repeats of at least ``least`` words. A null or empty text has no words and zeros.
    A kept column must not have one of these names. Rows are independent of each
    other, so equal rows give equal rows and an empty table an empty result.
    """
    source, text_of = beside_text(docs, text, keep)
    kept = len(keep)
    schema = with_fields(
        docs.select(*keep),
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, "
        "longest_repeat long, repeat_spans array<struct<start: long, end: long>>",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("repetition")
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        names = "n_words word_chars n_symbols n_dup_lines n_repeat_words covered_words longest_repeat".split()
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = text_of(batch).to_pylist()
            base = [_base(t) for t in texts]
            found = measure((t.encode() if t else None for t in texts), least, with_spans)
            columns = [[r[0] for r in found], *zip(*base), *([r[k] for r in found] for k in (1, 2, 3))]
            arrays = [pa.array(list(c), pa.int64()) for c in columns]
            last = pa.array([[{"start": s, "end": e} for s, e in r[4]] for r in found], span)
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *arrays, last], names=[*batch.schema.names[:kept], *names, "repeat_spans"])

    return source.mapInArrow(run, schema)


def base_failed() -> "F.Column":
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def keeps(most_covered: float = 0.2, longest: int = 50) -> "F.Column":
    """The verdict: long enough, few repeated words, little text in long repeats, no very long repeat.

    A line or two that stand twice in a page of text pass; a fifth of the words in repeats of ten words or more, or one
    passage of over fifty words twice, does not.
    """
    return ~base_failed() & (F.col("covered_words") <= most_covered * F.col("n_words")) & (F.col("longest_repeat") <= longest)
