"""Feeds, ranked lists, stored tables and views."""

from __future__ import annotations

import os
import urllib.parse

import pytest
from pyspark.sql import functions as F

from linkrisk.operators import dedupe, features
from linkrisk.sources import feeds, scans, tables


def write(root, name, text):
    folder = urllib.parse.urlparse(root).path
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="") as out:
        out.write(text)
    return f"{folder}/{name}"


def test_feed_over_several_files(spark, root):
    write(root, "b.txt", "http://2\n\n   \nhttps://1\nhttp://2\nftp://x\n")
    write(root, "a.txt", "https://1\nhttps://3\r\n HTTP://y\nhttp://4")
    manifest = write(root, "manifest", "b.txt\n\na.txt\nb.txt\n")
    listed = feeds.read_manifest(spark, manifest)
    assert [tuple(r) for r in listed.orderBy("file_no").collect()] == [(0, "b.txt"), (1, "a.txt")]
    urls = feeds.read_url_feed(spark, root, listed).orderBy("url_id").collect()
    assert [tuple(r) for r in urls] == [
        (0, "http://2", 1),
        (1, "https://1", 1),
        (2, "https://3\r", 1),
        (3, "http://4", 1),
    ]


def test_feed_order_across_input_splits(spark, root):
    lines = [f"http://host/{i}" for i in range(5000)] + ["http://host/0"]
    write(root, "big.txt", "\n".join(lines))
    manifest = write(root, "manifest", "big.txt")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        urls = feeds.read_url_feed(spark, root, feeds.read_manifest(spark, manifest)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [u.url for u in sorted(urls, key=lambda u: u.url_id)] == lines[:-1]


def test_empty_manifest(spark, root):
    manifest = write(root, "manifest", "\n \n")
    assert feeds.read_url_feed(spark, root, feeds.read_manifest(spark, manifest)).count() == 0


def test_ranked_domains(spark, root):
    path = write(root, "ranked", "1,a.com\n2,b,c.com\n\n3,a.com\n")
    assert {tuple(r) for r in feeds.read_ranked_domains(spark, path).collect()} == {("a.com", 3), ("b,c.com", 2)}


@pytest.mark.parametrize("text", ["x,a.com\n", "   \n", "a.com\n"])
def test_bad_rank_aborts(spark, root, text):
    path = write(root, "ranked", "1,b.com\n" + text)
    with pytest.raises(Exception):
        feeds.read_ranked_domains(spark, path).collect()


def test_missing_table_is_no_error(spark, root):
    assert tables.get_table(spark, root, "nothing") is None
    with pytest.raises(ValueError):
        tables.read_table(spark, root, "nothing")


def test_upsert_replaces_by_key_and_adds(spark, root):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    second = spark.createDataFrame([(2, "c"), (3, "d")], "k INT, v STRING")
    tables.upsert_table(first, root, "t", "k")
    tables.upsert_table(second, root, "t", "k")
    assert {tuple(r) for r in tables.read_table(spark, root, "t").collect()} == {(1, "a"), (2, "c"), (3, "d")}
    assert tables.get_table(spark, root, "t", 2) is None


def test_older_event_time_does_not_win(spark, root):
    tables.upsert_table(spark.createDataFrame([(1, 5, "new")], "k INT, t INT, v STRING"), root, "t", ["k"], event_time="t")
    stored = tables.upsert_table(spark.createDataFrame([(1, 3, "old")], "k INT, t INT, v STRING"), root, "t", ["k"], event_time="t")
    assert stored.first().v == "new"


def test_unfinished_snapshot_is_not_read(spark, root):
    tables.write_snapshot(spark.range(3), root, "t")
    path = tables.table_path(root, "t")
    half = f"{urllib.parse.urlparse(path).path}/snapshot=1"
    os.makedirs(half)
    assert tables.read_table(spark, root, "t").count() == 3


def test_repeated_batch_replaces_itself(spark, root):
    for _ in range(2):
        tables.write_batch(spark.range(3), root, "log", 0)
    tables.write_batch(spark.range(2), root, "log", 1)
    assert tables.read_table(spark, root, "log").groupBy("batch").count().count() == 2
    assert tables.read_table(spark, root, "log").count() == 5


def test_view_marks_labels(spark):
    rows = spark.createDataFrame([(1, 2, 0)], "a INT, b INT, y INT")
    view = tables.feature_view(rows, "some_view", ["a"], ["y"])
    assert view.columns == ["a", "y"] and view.schema["y"].metadata == {"label": True}
    assert spark.table("some_view").count() == 1


def test_search_is_capped_and_ordered(spark):
    rows = [('{"page": {"domain": "%s"}, "task": {"uuid": "u%d"}}' % ("a" if i % 2 else "b", i),) for i in range(9)]
    docs = scans.read_scan_documents(spark.createDataFrame(rows, "document STRING"))
    found = scans.search_scans(docs, "a", 2).select("doc.task.uuid").collect()
    assert [r.uuid for r in found] == ["u1", "u3"]


def test_anti_joins_and_nulls(spark):
    rows = spark.createDataFrame([("a",), (None,), ("b",)], "phishing_url STRING")
    seen = spark.createDataFrame([("a",), (None,)], "url STRING")
    assert {r[0] for r in dedupe.exclude_scanned(rows, seen).collect()} == {None, "b"}
    assert dedupe.exclude_scanned(rows, None).count() == 3
    ranked = spark.createDataFrame([("a", 1), (None, 2)], "domain STRING, rank INT")
    done = spark.createDataFrame([(None,)], "domain STRING")
    assert [r.domain for r in dedupe.new_domains(ranked, done).collect()] == ["a"]


def test_seen_urls_skip_tables_without_the_column(spark):
    with_url = spark.createDataFrame([("a",), ("a",), (None,)], "url STRING")
    assert [r.url for r in dedupe.seen_urls(with_url, None, spark.range(2)).collect()] == ["a"]
    assert dedupe.seen_urls(None, spark.range(2)) is None


def test_label_join_forms(spark):
    feats = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "url STRING, f INT")
    source = spark.createDataFrame([("a", 1), ("a", 1), (None, 0)], "phishing_url STRING, is_phishing INT")
    assert features.label_join(feats, source).count() == 4
    once = features.label_join(feats, source, keep_copies=False)
    assert {(r.url, r.is_phishing) for r in once.collect()} == {("a", 1), ("b", None), (None, None)}
    parity = features.label_join(feats, source, null_safe=True, keep_copies=False)
    assert {(r.url, r.is_phishing) for r in parity.collect()} == {("a", 1), ("b", None), (None, 0)}
    assert once.columns == ["url", "f", "is_phishing"]


def test_audit(spark):
    rows = spark.createDataFrame([("b", None), ("a", None), ("c", 1)], "url STRING, is_phishing INT")
    assert tuple(features.unlabeled_audit(rows).first()) == (2, 3, "a b")
    assert features.drop_unlabeled(rows).count() == 1


def test_missing_features_become_zero(spark):
    rows = spark.createDataFrame([(1, 2.0)], "has_tls INT, url_length DOUBLE")
    full = features.select_features(features.add_missing_features(rows)).first()
    assert len(full) == 8 and full.has_tls == 1.0 and full.url_length == 2.0 and full.umbrella_rank == 0.0


def test_upsert_replaces_the_partitions_it_meets(spark, root):
    import glob
    import os

    def files():
        return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tables.table_path(root, 't')}/**/*.parquet", recursive=True)}

    first = spark.createDataFrame([(i, f"v{i}") for i in range(500)] + [(None, "none")], "k BIGINT, v STRING")
    tables.upsert_table(first, root, "t", "k", parts=16)
    before = files()
    change = spark.createDataFrame([(3, "new", 1), (1_000, "added", 2), (None, "null", 3)], "k BIGINT, v STRING, more INT")
    stored = tables.upsert_table(change, root, "t", "k")
    met = {r[0] for r in change.selectExpr("pmod(xxhash64(k), 16)").collect()}
    after = files()
    part = lambda f: int(f.split("key_part=")[1].split("/")[0])
    assert all(after[f] == t for f, t in before.items()) and {part(f) for f in before} == set(range(16))
    assert {part(f) for f in after if f not in before} == met and len(met) <= 3
    read = [part(f) for f in stored.inputFiles() if "snapshot=0" in f]
    assert sorted(set(read)) == sorted(set(range(16)) - met)
    rows = {r.k: (r.v, r.more) for r in stored.collect()}
    assert len(rows) == 502 and stored.columns == ["k", "v", "more"]
    assert rows[3] == ("new", 1) and rows[1_000] == ("added", 2) and rows[None] == ("null", 3) and rows[4] == ("v4", None)
    tables.upsert_table(spark.createDataFrame([(7, "x")], "k BIGINT, v STRING"), root, "t", "k")  # other partitions, fewer columns
    assert tables.read_table(spark, root, "t").where("k = 3").collect() == [(3, "new", 1)]
    stored = tables.read_table(spark, root, "t")
    again = tables.upsert_table(change, root, "t", "k")
    assert sorted(map(str, again.collect())) == sorted(map(str, stored.collect()))


def test_upsert_takes_over_a_snapshot(spark, root):
    tables.write_snapshot(spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING"), root, "t")
    tables.upsert_table(spark.createDataFrame([(2, "c")], "k INT, v STRING"), root, "t", "k")
    assert sorted(map(tuple, tables.read_table(spark, root, "t").collect())) == [(1, "a"), (2, "c")]


def test_upsert_of_no_rows(spark, root):
    none = spark.createDataFrame([], "k INT, v STRING")
    assert tables.upsert_table(none, root, "t", "k").columns == ["k", "v"]
    tables.upsert_table(spark.createDataFrame([(2, "c")], "k INT, v STRING"), root, "t", "k")
    assert tables.upsert_table(none, root, "t", "k").collect() == [(2, "c")]
