"""Periodic runs, directly addressable codes and hard negatives against brute force, on small nasty tables."""

from __future__ import annotations

import json
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkrisk.llm import directcodes, encoding, negatives, packing, runs
from linkrisk.llm.queries import planted_run
from linkrisk.session import scratch_path
from tests.llm.test_operators import EXTRA, SCHEMA, TEXTS


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, s, 0, "k", "h", 1, 2, 3, 4, "f", "s", 5, "z") for i, t, lang, s in TEXTS]
    return spark.createDataFrame(rows, f"{SCHEMA}, {EXTRA}").repartition(3).cache()


# --- runs ---------------------------------------------------------------------------------


def _all_runs(words, least=12):
    """Every lag over the whole text; of equal stretches the smallest lag."""
    out, n = {}, len(words)
    for lag in range(1, n // 2 + 1):
        at = lag
        while at < n:
            stop = at
            while stop < n and words[stop] == words[stop - lag]:
                stop += 1
            if stop - at >= lag and stop - at + lag >= least:
                out.setdefault((at - lag, stop - at + lag), lag)
            at = max(stop, at + 1)
    return sorted((start, length, lag) for (start, length), lag in out.items())


def _shapes(r):
    for _ in range(400):
        n = r.randint(0, 90)
        yield [r.choice("ab") for _ in range(n)]
        yield [r.choice("abc") for _ in range(n)]
        unit = [r.choice("abcd") for _ in range(r.randint(1, 20))]
        yield (unit * (n // len(unit) + 1))[:n] + [r.choice("abxy")] + (unit * 3)[:n]
        yield list("ab" * r.randint(0, 20) + "a" + "ab" * r.randint(0, 20) + "a")
        yield list("a" * 8 + "b") * r.randint(1, 9) + list("a" * r.randint(0, 12))
        short, long_ = ["a"], ["a", "b"]
        while len(long_) < n:
            short, long_ = long_, long_ + short
        yield long_[:n]
        yield [c for _ in range(n // 8) for c in [r.choice("abc") for _ in range(r.randint(1, 5))] * r.randint(1, 6)]


def test_runs_against_all_lags():
    texts = [[c.encode() for c in t] for t in _shapes(random.Random(7))]
    got = list(runs.batch_runs(texts))
    assert [w for w, _ in got] == texts
    assert all(found == _all_runs(words) for words, found in got) and sum(bool(f) for _, f in got) > 1000


def test_runs_of_long_texts():
    line = [b"%d" % i for i in range(10)]
    for words, want in (([b"a"] * 60_000, [(0, 60_000, 1)]), (line * 5_000, [(0, 50_000, 10)])):
        assert list(runs.batch_runs([words])) == [(words, want)]
    blocks = [x for i in range(2_000) for x in [b"a"] * 12 + [b"b%d" % i]]
    assert [f for _, f in runs.batch_runs([blocks])][0] == [(13 * i, 12, 1) for i in range(2_000)]


def test_runs_of_documents(docs, spark):
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = runs.find(docs, keep=["doc_id", "text"], rewrite=planted_run, by=key).withColumn("best", runs.best_run())
    rows = found.collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        h = None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode())
        plain = (r.text or "").encode().split()
        words, n = plain, len(plain)
        if h is not None and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [plain[i] if i < a else plain[a + (i - a) % p] for i in range(n)]
        assert r.n_words == n
        if n > 3_000:
            continue
        want = _all_runs(words)
        assert [tuple(x) for x in r.runs] == want
        dropped = {i for s, length, q in want for i in range(s + q, s + length)}
        assert r.collapsed == b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()
        best = min(want, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert (r.best and (r.best.start, r.best.length, r.best.period)) == best
    assert any(r.runs for r in rows)
    assert runs.find(docs.limit(0)).collect() == []


# --- token ids ----------------------------------------------------------------------------


@pytest.mark.parametrize("model, cutting", [("byte_bpe_50k.json", "spaces"), ("word_bpe_49k.json", "words")])
def test_ids_of_nasty_texts(monkeypatch, model, cutting):
    monkeypatch.setattr(encoding, "REMEMBERED", 50_000)  # forgets again and again
    r = random.Random(3)
    parts = [" ", " ", "  ", "a", "foo", "Bar", "'s", "'", "é", " ", "\n", "\t", "\x01", "1", "23", "!", "?.", "<|endoftext|>", "<|", "\U0001f600"]
    parts += ["İ", "Σ", "̈", "ſ", "\x1c", "\x85", "中文", "×", "\x00", "\r\n"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(5_000)]
    encoder = encoding.Encoder(model)
    assert encoder.cutting == cutting and encoder.known
    ids, counts = encoder.encode(pa.array([*texts, None, ""], pa.string()))
    bounds = np.append(0, np.cumsum(counts))
    want = [e.ids for e in encoder.model.encode_batch([*texts, "", ""], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want
    assert encoder.encode(pa.array([], pa.string()))[0].tolist() == []


def test_tokenizers_of_other_kinds_get_whole_texts(tmp_path):
    settings = json.loads(encoding.tokenizer("byte_bpe_50k.json").to_str())
    settings["normalizer"] = {"type": "Lowercase"}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(settings))
    encoder = encoding.Encoder(str(path))
    texts = ["Hello World again.", "Two  spaces,\nlines"]
    ids, counts = encoder.encode(pa.array(texts))
    assert encoder.cutting == "none" and not encoder.known
    assert ids.tolist() == [i for t in texts for i in encoder.model.encode(t).ids] and counts.sum() == len(ids)


def test_packing_with_another_tokenizer(spark):
    rows = spark.createDataFrame([(1, "Hello World again."), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in packing.pack(rows, model="byte_bpe_50k.json", end=0).where("start = 0").collect()}
    assert got[1].ids_crc32 == zlib.crc32(np.array([15496, 2159, 757, 13, 0][: got[1].length], "<u4").tobytes()) and got[1].doc_tokens == 5
    assert got[2].doc_tokens == 1


@pytest.mark.parametrize("widths", [None, [8, 8], [4, 4, 8], [16], [3, 5, 4, 4], [7, 9], [1] * 16])
def test_any_token_is_addressed(widths):
    r = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 511, 512, 513, 3_000):
        ids = (r.integers(0, 1 << 16, n) >> r.integers(0, 16, n)).astype(np.uint32)
        counts = np.diff(np.concatenate(([0], np.sort(r.integers(0, n + 1, 3)), [n])))
        data = directcodes.encode_segment(2, 7, [1, None, -5, 1], counts, ids, widths)
        found = directcodes.Segment(b"xyz" + data, 3)
        assert (found.part, found.number, found.keys, found.length) == (2, 7, [1, None, -5, 1], n)
        at = r.integers(0, max(n, 1), 40 if n else 0)
        assert found.tokens(at).tolist() == ids[at].tolist()
        stops = np.cumsum(counts)
        assert all(found.document(k).tolist() == ids[e - c : e].tolist() for k, (c, e) in enumerate(zip(counts, stops)))
        assert all(found.range(a, n).tolist() == ids[a:].tolist() for a in range(0, n, 97))
        with pytest.raises(ValueError):
            directcodes.Segment(data[:-1])
    with pytest.raises(ValueError):
        directcodes.encode_segment(0, 0, [1], np.array([1]), np.array([70_000]), [8, 8])


def test_widths_are_the_cheapest():
    r = np.random.default_rng(2)
    for scale in (3, 60, 900, 40_000):
        ids = np.minimum(r.exponential(scale, 5_000), 65_535).astype(np.uint32)
        best = directcodes.best_widths(ids)
        size = lambda w: sum(int((ids >> sum(w[:k]) > 0).sum() if k else len(ids)) * (x + (k < len(w) - 1)) for k, x in enumerate(w))
        top = int(ids.max()).bit_length()
        ways = [w for n in range(1, 5) for w in np.array(np.meshgrid(*[directcodes.WIDTHS] * n)).T.reshape(-1, n).tolist() if sum(w) >= top > sum(w[:-1])]
        assert sum(best) >= top and size(best) == min(map(size, ways))


def test_direct_codes_of_documents(docs, spark, monkeypatch):
    monkeypatch.setattr(directcodes, "SEGMENT", 500)
    monkeypatch.setattr(directcodes, "IN_FILE", 2)
    path = scratch_path(spark, "test-codes")
    directcodes.write(docs, path)
    rows = sorted(directcodes.read(spark, path).collect(), key=lambda r: r.start)
    model = encoding.tokenizer("byte_bpe_50k.json")
    want = Counter()
    for key, text, _, _ in TEXTS:
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want[key, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.key, r.n_tokens, r.ids_crc32) for r in rows) == want
    assert [r.start for r in rows] == np.append(0, np.cumsum([r.n_tokens for r in rows]))[:-1].tolist()
    keys = [(r.key is not None, r.key) for r in rows]
    assert keys == sorted(keys, key=lambda k: (k[0], k[1] or 0))
    assert directcodes.encode(docs.limit(0)).collect() == []


# --- hard negatives -----------------------------------------------------------------------


def _mined(rows):
    whole = {(k, l, tuple(math.floor(256 * x) for x in v)) for k, l, v in rows if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    order, out = (lambda t: (-t[0], t[1] is None, t[1] or 0)), []
    for key, label, vector in whole:
        if key is None or key % 50:
            continue
        scored = [(sum(a * b for a, b in zip(vector, w)), k, other) for k, other, w in whole]
        for score, positive, _ in sorted((t for t in scored if t[2] == label and t[1] != key), key=order)[:5]:
            near = sorted((t for t in scored if t[2] != label and 50 * score <= 100 * t[0] <= 95 * score), key=order)[:3]
            out += [(key, positive, rank, k, score, s) for rank, (s, k, _) in enumerate(near, 1)]
    return Counter(out)


@pytest.mark.parametrize("size", [8_192, 40])
def test_hard_negatives(spark, monkeypatch, size):
    monkeypatch.setattr(negatives, "SLICE", size)
    r, rows = random.Random(2), []
    for i in range(500):
        vector = [r.choice([-1.0, 0.0, 0.5, r.gauss(0, 1)]) for _ in range(7)]
        if i % 3 == 0:
            vector = [0.5, -0.5, 0.0, 0.25, 0.0, 1.0, 0.125]  # a third of the rows
        if i % 50 == 17:
            vector[2] = r.choice([None, math.nan, math.inf, -math.inf])
        rows.append((None if i % 83 == 1 else i, None if i % 41 == 1 else r.randrange(4), None if i % 59 == 3 else vector))
    rows += [*rows[:30], (50, 1, [0.0] * 7), (100, 2, [-1.0] * 7)]
    table = spark.createDataFrame([(*x, "k", 1.0, 2) for x in rows], "vec_id long, label int, embedding array<double>, key string, score double, slice int")
    got = negatives.mine(table.repartition(3))
    assert Counter(tuple(x) for x in got.collect()) == _mined(rows)
    assert negatives.mine(table.limit(0)).collect() == []


def test_the_threshold_ends_the_search_early():
    r = np.random.default_rng(4)
    vectors = r.integers(-20, 20, (4_000, 8))
    vectors[:10] += 400
    found = negatives.Slice(np.arange(4_000), np.zeros(4_000, np.int64), vectors)
    met = []
    scores = found.scores
    found.scores = lambda rows, anchor: (met.append(len(rows)), scores(rows, anchor))[1]
    [(rows, best)] = found.best(np.full(8, 100), np.ones(4_000, bool), [(-(1 << 62), 1 << 62)], 5)
    every = vectors @ np.full(8, 100)
    assert best.tolist() == np.sort(every)[::-1][:5].tolist() and sum(met) < 400
