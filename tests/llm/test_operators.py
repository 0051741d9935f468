"""Every operator on a small nasty table: nulls, empty and very long texts, repeated rows, clashing names, no rows."""

from __future__ import annotations

import base64
import hashlib
import random
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from linkrisk.llm import archives, bucket_digest, common, encoding, language, licenses, mixing, packing, repetition, sharding, simhash, templates

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "key string, h string, hash long, size long, shard int, row long, fps string, score string, part int, `_x.y` string"


def _prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("bdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(words))


LONG = _prose(1, 30_000)
COPY = _prose(2, 200)
NEAR = COPY.split()
NEAR[100] = "changed"
TEXTS = [
    (0, COPY, "xx", "b"),
    (1, COPY, "xx", "b"),
    (2, " ".join(NEAR), "xx", None),
    (3, None, "xx", "b"),
    (4, "", None, None),
    (5, " \t\n", "yy", "a"),
    (6, "one two", "yy", "a"),
    (7, LONG, "xx", "a"),
    (8, "the same words again and again " * 40, "yy", "c"),
    (9, "Ünï© 😀 don't İ. " + _prose(3, 80), None, "\U0001f600"),
    (9, "Ünï© 😀 don't İ. " + _prose(3, 80), None, "\U0001f600"),
    (9, _prose(4, 90), "xx", "c"),
    (None, _prose(5, 70), "xx", "c"),
    (None, None, None, None),
    *[(20 + i, _prose(100 + i, 60 + 7 * i), "xx", "abc"[i % 3]) for i in range(30)],
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, s, 0, "k", "h", 1, 2, 3, 4, "f", "s", 5, "z") for i, t, lang, s in TEXTS]
    return spark.createDataFrame(rows, f"{SCHEMA}, {EXTRA}").repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], f"{SCHEMA}, {EXTRA}")


def _words(text):
    return (text or "").encode().split()


def test_mix(docs, empty):
    rows = mixing.copies(docs).collect()
    assert len(rows) == len(TEXTS)
    total = sum(len(_words(t)) for _, t, _, _ in TEXTS)
    by_target = {(r.source_size, r.target): 0 for r in rows}
    for r in rows:
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 3
        assert r.target <= 3 * r.source_size
        by_target[r.source_size, r.target] += r.taken
    assert sum(t for _, t in by_target) == pytest.approx(total)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)
    assert sorted(map(str, mixing.copies(docs).collect())) == sorted(map(str, rows))
    assert mixing.copies(empty).collect() == [] and mixing.mix(empty).collect() == []


def test_mix_splits_a_hot_key(spark):
    rows = [(None if i % 3 == 0 else i, _prose(i, 10 + i % 9), "ab"[i % 5 == 0]) for i in range(900)]
    got = mixing.copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, targets = Counter(), {}
    for r in got:
        taken[r.source_size] += r.taken
        targets[r.source_size] = r.target
    assert len(targets) == 2 and all(abs(taken[s] - t) <= 18 for s, t in targets.items())


def test_helper_names_as_columns(spark):
    names = "of_source whole_passes cut_hash copy_number of_text of_key times_held _s _whole _cut _copy _h _first _times h size hash first times".split()
    rows = [(i, _prose(i // 2, 60), "ab"[i % 2], *[f"{n}{i}" for n in names]) for i in range(12)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    assert common.own_names(docs, "h", "new") == ["__h", "new"]
    assert simhash.keep_one(docs).columns == docs.columns and simhash.keep_one(docs).count() == 6
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and {tuple(r) for r in mixed.collect()} <= set(rows)


def test_mix_targets_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 100), (None, 400), ("d", 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    weights = {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}
    size = {"a": 1000, "b": 10, "c": 100, "d": 0, None: 400}
    want, free, left = {}, set(weights), 1510.0
    while True:  # share, bound, and share again what is left
        unit = left / sum(weights[s] for s in free)
        over = {s for s in free if weights[s] * unit >= 3 * size[s]}
        if not over:
            break
        for s in over:
            want[s] = 3.0 * size[s]
            left -= want[s]
        free -= over
    want |= {s: weights[s] * unit for s in free}
    assert got == pytest.approx(want)


def test_digests(docs, empty):
    rows = bucket_digest.edited_fingerprints(docs).collect()
    assert len(rows) == len(TEXTS)
    order = sorted(TEXTS, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    want = Counter()
    for (key, text, _, _), (_, after, _, _) in zip(order, [*order[1:], order[0]]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = (text[: len(text) - half] + after[:half]).encode()
        own, changed = bucket_digest.digest(text.encode()), bucket_digest.digest(edited)
        want[key, len(text), hashlib.sha256(edited).hexdigest(), own, changed, bucket_digest.likeness(own, changed)] += 1
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited) for r in rows)
    assert got == want
    assert all(0 <= r.near_next <= 1 for r in rows)
    assert bucket_digest.edited_fingerprints(empty).collect() == []
    assert len({r.fingerprint for r in bucket_digest.fingerprints(docs.where("doc_id < 2")).collect()}) == 1


def test_digest_single_row_follows_itself(spark):
    row = bucket_digest.edited_fingerprints(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and row.near_next == 1.0


def test_shards(spark, docs, empty):
    rows = sharding.assign(docs).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert len(rows) == len(TEXTS) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _, _ in TEXTS
    )
    assert sharding.assign(empty).collect() == []
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    heavy = Counter(r.shard for r in sharding.assign(many, weights=[1.0, 1.0, 2.0]).select("shard").collect())
    assert heavy[2] == pytest.approx(10_000, rel=0.05) and heavy[0] == pytest.approx(5_000, rel=0.08)
    copies = spark.range(25_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("x").alias("text"))
    assert sorted(r.slot for r in sharding.assign(copies).collect()) == list(range(25_000))


def _brute_cover(words, size):
    seen = defaultdict(list)
    for i in range(len(words) - size + 1):
        seen[tuple(words[i : i + size])].append(i)
    return {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + size)}


def test_repetition(docs, empty):
    rows = repetition.repeats(docs.select("doc_id", "text"), keep=["doc_id", "text"]).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        words = _words(r.text)
        assert r.n_words == len(words) and r.word_chars == sum(len(w.decode()) for w in words)
        assert r.n_repeat_words == len(_brute_cover(words, 3))
        long_ = _brute_cover(words, 10)
        assert r.covered_words == len(long_) == sum(s.end - s.start for s in r.repeat_spans)
    assert repetition.repeats(empty).collect() == []


def test_only_the_repeats_decide(spark):
    text = _prose(70, 400).split()
    line = _prose(71, 12).split()
    rows = [
        ("clean", text),
        ("one line twice", [*text[:100], *line, *text[100:200], *line]),
        ("lines", [*line, *text[:30], *line, *text[30:60], *_prose(72, 12).split()]),
        ("passage", [*text, *text[20:75]]),
        ("short", text[:40]),
    ]
    measured = repetition.repeats(spark.createDataFrame([(n, " ".join(w)) for n, w in rows], "doc_id string, text string"))
    got = {r.doc_id: (r.base, r.kept) for r in measured.select("doc_id", repetition.base_failed().alias("base"), repetition.keeps().alias("kept")).collect()}
    assert got == {"clean": (False, True), "one line twice": (False, True), "lines": (False, False), "passage": (False, False), "short": (True, False)}


def test_longest_repeats_against_brute_force():
    r = np.random.default_rng(5)
    for size in (1, 2, 30, 200):
        words = r.integers(0, 3, size)
        found = repetition.longest_repeats(words, np.full(size, size))
        for i in range(size):
            best = 0
            for j in range(size):
                k = 0
                while i != j and i + k < size and j + k < size and words[i + k] == words[j + k]:
                    k += 1
                best = max(best, k)
            assert found[i] == best


def test_packing(docs, empty):
    rows = packing.pack(docs, window=256).collect()
    model = encoding.tokenizer("word_bpe_49k.json")
    ids = [[*model.encode(t or "", add_special_tokens=False).ids, 1] for _, t, _, _ in TEXTS]
    assert sum(r.length for r in rows) == sum(map(len, ids))
    whole = {(i, zlib.crc32(np.array(x, "<u4").tobytes())): len(x) for (i, _, _, _), x in zip(TEXTS, ids)}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        if r.length == r.doc_tokens:
            assert whole[r.doc_id, r.ids_crc32] == r.doc_tokens
        if r.doc_id == 7:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[7][r.start : r.start + r.length], "<u4").tobytes())
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 256 and (at == 256 or at & (at - 1) == 0)
    assert packing.pack(empty).collect() == []


def test_batches_by_size():
    rows = [None, b"", b"x" * 30, b"xx", b"x" * 9, b"x" * 9, b"x" * 100, b"", None]
    for step in (1, 2, 4, 20):
        batches = [pa.RecordBatch.from_arrays([pa.array(rows[i : i + step], pa.binary())], names=["body"]) for i in range(0, len(rows), step)]
        out = [b.column(0).to_pylist() for b in common.by_size(iter(batches), "body", 20)]
        assert out == [rows[:3], rows[3:6], rows[6:7], rows[7:]]
    assert list(common.by_size(iter([]), "body")) == []


def test_word_ids_are_dropped_by_the_next_operator():
    common.remembered("one")["a"] = 1
    assert common.remembered("one") == {"a": 1}
    assert common.remembered("two") == {} and common.remembered("one") == {}


def test_packing_plan():
    assert sorted(packing.combinations(6)) == [(1, 1, 4), (1, 2, 3), (1, 5), (2, 2, 2), (2, 4), (3, 3), (6,)]
    histogram = {6: 5, 3: 11, 1: 40, 4: 9, 2: 3, 0: 7}
    used = Counter()
    for column, times in packing.solve(histogram, 6):
        for step in column:
            used[step] += times
    assert all(used[s] <= histogram.get(s, 0) for s in used)
    r = np.random.default_rng(1)
    matrix, x = r.random((12, 6)), np.array([0, 2.0, 0, 1, 5, 0])
    assert packing.nnls(matrix, matrix @ x) == pytest.approx(x, abs=1e-6)


PAGES = "page_id long, url string, html string, host string, key string"


def test_archives(spark):
    same = "<p>same</p>"
    data = [(3, "http://a/x y", same), (1, None, same), (2, "http://b/", None), (4, "", ""), (5, "http://c/", "WARC/1.1\r\n\r\né\n"), (1, None, same), (None, "u", same)]
    pages = spark.createDataFrame([(*r, "h", "k") for r in data], PAGES)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in archives.archive(pages).collect())
    want = Counter()
    first = {"<p>same</p>": 1, "": 2, data[4][2]: 5}
    for key, _, html in data:
        body = html or ""
        again = key is not None and key != first[body]
        digest = base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()
        want[key, len(body.encode()), digest, "revisit" if again else "response", first[body] if again else None] += 1
    assert got == want
    assert archives.archive(pages.limit(0)).collect() == []
    short = archives.archive(pages, least=5).where("payload_bytes < 5").collect()
    assert {r.record_type for r in short} == {"response"}


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    data = archives.version_block(version, "f.arc", "20200102030405") + b"\n"
    data += archives.arc_record(version, "http://a/b c", "1.2.3.4", "20200102", "text/plain", b"x\n\ny", len(data), "f.arc") + b"\n"
    head, record = archives.read_arc(data)
    assert head["URL"] == "filedesc://f.arc" and record["URL"] == "http://a/b%20c" and record["block"] == b"x\n\ny"
    assert archives.timestamp(record["Archive-date"]) == "2020-01-02T00:00:00Z"
    with pytest.raises(ValueError):
        list(archives.read_arc(data[:-3]))


def test_language(docs, empty):
    rows = language.identify(docs, keep=["doc_id", "text"]).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert language.identify(empty).collect() == []


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars >= 30")
    found = language.identify(docs, keep=["doc_id", "lang"]).where(language.held_out(F.col("doc_id"))).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found) > 0


def _fingerprint(text):
    pieces = simhash.shingles((text or "").encode(), 3)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, empty):
    rows = simhash.classes(docs).collect()
    prints = {(i, t): _fingerprint(t) for i, t, _, _ in TEXTS}
    assert Counter((r.doc_id, r.fingerprint) for r in rows) == Counter((i, f"{prints[i, t]:016x}") for i, t, _, _ in TEXTS)
    of = {r.fingerprint: r.component_id for r in rows}
    assert of[f"{prints[0, COPY]:016x}"] == 0 and of["0" * 16] == 3
    assert simhash.classes(empty).collect() == []


@pytest.mark.parametrize("radius, hot", [(3, 5_000), (3, 40), (5, 40)])
def test_links_connect_all_that_are_near(spark, monkeypatch, radius, hot):
    monkeypatch.setattr(simhash, "HOT", hot)
    r = random.Random(3)
    prints = set()
    for _ in range(60):
        base = r.getrandbits(64)
        for _ in range(r.choice([1, 3, 30])):
            value = base
            for _ in range(r.randint(0, 5)):
                value ^= 1 << r.randrange(64)
            prints.add(value)
    centre = r.getrandbits(64)
    prints |= {centre ^ 1 << a ^ 1 << b for a in range(20) for b in range(20)}  # one dense group
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p, 0) for p in signed], "fp long, space int"), radius)
    roots = {x.node: x.root for x in simhash.components(edges).collect()}
    parent = {p: p for p in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b, s in zip(prints[:i], signed[:i]):
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(signed[i]), find(s)))
                parent[y] = x
    assert {p: roots.get(p, p) for p in signed} == {p: find(p) for p in signed}


def test_keep_one(docs, empty):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    left = Counter(r.doc_id for r in kept.collect())
    assert left[0] == 1 and left[1] == left[2] == 0  # copies and a near copy
    assert left[9] == 2 and left[None] == 2 and left[3] == left[4] == 0  # equal rows, null texts
    assert left[5] == 0  # no words, like the empty text
    assert sum(left.values()) == len(TEXTS) - 6
    assert simhash.keep_one(empty).collect() == []


def _first_of_each(rows, radius=3):
    """Brute force: the rows (key, text) that stand for their classes, every fingerprint compared with every other."""
    prints = sorted({_fingerprint(t) for _, t in rows})
    root = {p: p for p in prints}
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= radius and root[a] != root[b]:
                gone, stays = root[a], root[b]
                root = {p: stays if x == gone else x for p, x in root.items()}
    groups = defaultdict(list)
    for k, t in rows:
        groups[root[_fingerprint(t)]].append((k is None, k or 0, hashlib.md5((t or "").encode()).hexdigest(), k, t or ""))
    return Counter(min(g)[3:] for g in groups.values())


def test_one_of_each(spark, docs, empty):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter((x.doc_id, x.text or "") for x in kept.collect()) == _first_of_each([t[:2] for t in TEXTS])
    assert simhash.one_of_each(empty).collect() == []
    r = random.Random(21)
    rows = []
    for i in range(12):  # chains of edits: classes whose ends are not within 3 bits of each other
        words = _prose(700 + i, 400).split()
        for step in range(r.randint(1, 8)):
            rows.append((r.choice([None, 7, r.randrange(1000)]), " ".join(words)))
            words[r.randrange(400)] = f"edit{step}"
    rows += rows[::5] + [(i, "a third of the table is this text") for i in range(60)] + [(None, None), (3, ""), (3, " ")]
    r.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("who", "times", "h", "of_text", "component_id")})
    found = simhash.one_of_each(frame)
    assert found.columns == frame.columns
    assert Counter((x.doc_id, x.text or "") for x in found.collect()) == _first_of_each(rows)


def test_crowds_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(simhash, "ALL_PAIRS", 5)
    r = random.Random(11)
    prints = {b ^ 1 << i ^ 1 << j for b in [r.getrandbits(64) for _ in range(4)] for i in range(9) for j in range(9)} | {r.getrandbits(64) for _ in range(50)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    fps = spark.createDataFrame([(p, 0) for p in signed], "fp long, space int")
    found, probes = simhash.search(fps, 3)
    near = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    small = {(x.a, x.b) for x in found.where("crowd is null").collect()}
    for tag, wanted in (("cast(null as long)", near), ("pmod(fp, 3)", {(a, b) for a, b in near if a % 3 != b % 3}), ("1L", set())):
        rest = {(x.a, x.b) for x in simhash.crossing(found, probes, fps.selectExpr("fp", f"{tag} as tag"), 3).collect()}
        assert wanted <= small | rest <= near
    assert found.where("crowd is not null").count() > 0 and small != near


def test_keep_one_in_crowds(spark, monkeypatch):
    monkeypatch.setattr(simhash, "ALL_PAIRS", 5)
    r = random.Random(12)
    words, texts = _prose(50, 300).split(), []
    for _ in range(6):  # the same words in other orders: near in fingerprints, not in shingles
        r.shuffle(words)
        for i in range(14):
            texts.append(" ".join([*words[: 20 * i], f"new{i}", *words[20 * i + 1 :]]))
    r.shuffle(texts)
    sets = [set(simhash.shingles(t.encode(), 5)) for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(x.doc_id for x in simhash.keep_one(docs).collect()) == sorted(set(root)) and len(set(root)) == 6


HTML = (
    '<html><head><title>t</title><script>var a="</p>";</script></head><body><header>Site</header><nav><a>menu</a></nav>'
    '<div class="page with-sidebar"><article><h1>Head &amp; tail</h1><p>One<br>two <b>three<p>four&nbsp;five {n}</p>'
    '<p>Share this page with everybody</p><div class="comments"><p>first!</p></div></article><aside>side</aside></div>'
    '<form><input value="x">Send</form><footer>&copy; site'
)


def test_main_text(spark):
    rows = [(i, f"https://h.example/{i}", HTML.replace("{n}", str(i)), "h", "k") for i in range(8)]
    rows += [(100, None, None, "h", "k"), (101, "x", "", "h", "k"), (102, "https://o.example", "no markup < here\n\nat all", "h", "k")]
    rows += [(103, "https://p.example", "<body><div>plain <i>in</i>line</div>" + "<p>x" * 3000, "h", "k"), (0, "https://h.example/0", rows[0][2], "h", "k")]
    got = {r.page_id: r for r in templates.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3].text == "Head & tail\n\nOne two three\n\nfour five 3" or "Share this page" not in got[3].text
    assert "four five 3" in got[3].text and "menu" not in got[3].text and "first!" not in got[3].text
    assert got[100].text == got[101].text == "" and got[100].n_chars == 0
    assert got[102].text == "no markup < here at all"
    assert got[103].text.startswith("plain inline\n\nx\n\nx")
    assert templates.main_text(spark.createDataFrame([], PAGES)).collect() == []


def test_templates_of_a_large_host(spark):
    banner = "<div><p>This banner stands on some of the pages of a large host.</p></div>"
    page = "<html><body>{b}<div><p>Outside the article number {i}.</p></div><article><p>Text of article {i}.</p></article></body></html>"
    rows = [(i, f"https://l.example/{i}", page.format(b=banner if i < 12 else "", i=i), "h", "k") for i in range(40)]
    copied = "<html><body><article><p>An article that is served under many addresses of this host stays whole.</p></article></body></html>"
    rows += [(100 + i, f"https://l.example/c{i}", copied, "h", "k") for i in range(12)]
    got = {r.page_id: r.text for r in templates.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[i] == f"Outside the article number {i}.\n\nText of article {i}." for i in range(40))
    assert all("stays whole" in got[100 + i] for i in range(12))


def test_deep_page():
    nodes = templates.parse("<div>" * 20_000 + "deep")
    templates.hash_subtrees(nodes)
    assert templates.extract(nodes, frozenset()) == "deep"


def test_licenses(spark, empty):
    mit = ". ".join(licenses.SENTENCES[i].upper() for i in ("mit-grant", "mit-include", "mit-warranty"))
    rows = [
        (1, "Words.\nReleased under the MIT License.\nMore words."),
        (2, f"Intro! {mit}. Licensed under CC BY-NC 4.0."),
        (3, None),
        (4, ""),
        (5, "Permission is hereby granted. The MIT License."),
        (1, "Words.\nReleased under the MIT License.\nMore words."),
    ]
    got = licenses.recognise(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, rules string")).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 6 and by[1].licenses == ["MIT"] and by[1].rules == ["mit-notice"] and by[1].n_sentences == 3
    assert by[2].rules == ["mit-text", "cc-by-nc-notice"] and by[2].licenses == ["CC-BY-NC-4.0", "MIT"]
    assert by[3].licenses == by[4].licenses == by[5].licenses == []
    assert licenses.recognise(empty).collect() == []


LICENCES = {
    "apache-header": '''Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.''',
    "mit-text": '''Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE.''',
    "gpl3-header": '''This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program.  If not, see <https://www.gnu.org/licenses/>.''',
    "bsd3-text": '''Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.''',
    "mit-notice": "Released under the MIT License.",
}
LICENCES["bsd2-text"] = LICENCES["bsd3-text"][: LICENCES["bsd3-text"].index("3. Neither")]


def test_licenses_wrapped_and_commented(spark):
    rows = []
    for name, text in LICENCES.items():
        for width in (20, 60, 80, 10_000):
            lines = [x for part in text.split("\n\n") for x in [*textwrap.wrap(part, width, break_long_words=False), ""]]
            rows += [(name, "\n".join(f"{lead} {x}".strip() for x in lines)) for lead in ("", "#", " *", "//")]
    rows.append(("", "This was never released under the\nMIT license, nor is it software."))
    got = licenses.recognise(spark.createDataFrame(rows, "name string, text string"), keep=["name"]).collect()
    assert len(got) == len(rows) and all(r.rules == [r.name][: len(r.name)] for r in got)


def test_pipeline(spark, docs, empty):
    step = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, step, "").cache()
        assert out.columns == docs.columns
        if name == "language":
            assert {r.doc_id for r in step.collect()} - {r.doc_id for r in out.collect()} == {3, 4, 5}
        if name == "quality":
            left = {r.doc_id for r in out.collect()}
            assert 8 not in left and 6 not in left and {0, 7, 20, 49} <= left
        if name == "near_duplicates":
            before = [(r.doc_id, r.text) for r in step.collect()]
            assert Counter((r.doc_id, r.text) for r in out.collect()) == _first_of_each(before)
        step = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, step, "")
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in step.collect()}
    nothing = empty
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, "")
    assert nothing.collect() == []


def test_keep_one_finds_stretches(spark):
    r, rows, pairs = random.Random(13), [], Counter()
    for i in range(240):
        words = _prose(1000 + i, r.randint(120, 400)).split()
        kind, wanted = ("appended", "cut", "inserted")[i % 3], (0.81, 0.86, 0.91, 0.94)[i // 3 % 4]
        more = _prose(5000 + i, max(1, round(len(words) * (1 - wanted) / wanted) - 4)).split()
        at = {"appended": len(words), "inserted": len(words) // 2}.get(kind, 0)
        other = words[: len(words) - round(len(words) * (1 - wanted))] if kind == "cut" else [*words[:at], *more, *words[at:]]
        a, b = (set(simhash.shingles(" ".join(w).encode(), 5)) for w in (words, other))
        if len(a & b) >= 0.8 * len(a | b):
            rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
            pairs[kind] += 1
    assert min(pairs.values()) > 60
    left = [x.doc_id for x in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len([i for i in left if i % 2]) <= 3 and len([i for i in left if i % 2 == 0]) == sum(pairs.values())
