"""Cases that once lost or bent data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from linkrisk import schemas
from linkrisk.functions import ordering, text
from linkrisk.operators import metrics
from linkrisk.plans import scanning
from linkrisk.sources import feeds
from linkrisk.sources.tables import get_table


@pytest.mark.parametrize("bin_rows", [1_000_000, 7])
def test_auc_ignores_rows_without_label_or_score(spark, monkeypatch, bin_rows):
    monkeypatch.setattr(ordering, "BIN_ROWS", bin_rows)
    rows = [("m", "s", i % 2, (i * 37 % 40) / 40) for i in range(40)]
    schema = "model string, split string, label int, score double"
    want = metrics.roc_auc(spark.createDataFrame(rows, schema)).first().roc_auc
    extra = [("m", "s", None, 0.1)] * 20 + [("m", "s", 1, None)] * 3 + [("m", "s", 0, None)]
    assert metrics.roc_auc(spark.createDataFrame(rows + extra, schema)).first().roc_auc == pytest.approx(want)


def test_clean_utf8_keeps_genuine_replacement_characters(spark):
    raw = [("a\ufffdb".encode(),), (b"a\xff" + "\ufffdb".encode(),), (b"\xffab",), (None,)]
    got = spark.createDataFrame(raw, "raw binary").select(text.clean_utf8(F.col("raw"))).collect()
    assert [r[0] for r in got] == ["a\ufffdb", "a\ufffdb", "ab", None]


def test_feed_files_with_special_names(spark, root):
    names = ["a b.txt", "plus+percent%25.txt"]
    for i, name in enumerate(names):
        lines = spark.createDataFrame([(f"http://host{i}/",)], "value string")
        lines.coalesce(1).write.text(f"{root}/feed/{name}")
    manifest = spark.createDataFrame(list(enumerate(f"{n}/*" for n in names)), "file_no bigint, file_name string")
    files = spark.read.text([f"{root}/feed/{n}" for n in names]).select("_metadata.file_path").distinct().collect()
    listed = [(i, r[0].rsplit("/feed/", 1)[1].replace("%20", " ").replace("%25", "%")) for i, r in enumerate(sorted(files))]
    manifest = spark.createDataFrame(listed, "file_no bigint, file_name string")
    got = feeds.read_url_feed(spark, f"{root}/feed", manifest)
    assert sorted(r.url for r in got.collect()) == ["http://host0/", "http://host1/"]


def test_reloaded_feed_keeps_urls_and_ids(spark, root):
    from linkrisk.plans import ingest

    for lines in (["http://a/", "http://b/", "http://c/"], ["http://b/", "http://d/", "http://c/"]):
        folder = f"{root}/feed{len(lines)}-{lines[0][7]}"
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{folder}/data")
        name = spark.read.text(f"{folder}/data").select("_metadata.file_name").first()[0]
        spark.createDataFrame([(f"data/{name}",)], "value string").coalesce(1).write.text(f"{folder}/manifest")
        stored = ingest.load_feed(spark, f"{root}/tables", folder, f"{folder}/manifest")
    assert sorted((r.url_id, r.url) for r in stored.collect()) == [(0, "http://a/"), (1, "http://b/"), (2, "http://c/"), (3, "http://d/")]


def test_seeded_keys_with_nulls_and_separators(spark):
    rows = [("a", "b"), ("a:b", None), ("a", None), ("a", ""), (None, "a"), ("a:", "b"), ("a\\", ":b"), ("a", ":b"), (None, None), ("", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(ordering.seeded_digest(["x", "y"])).distinct().count() == len(rows)
    assert df.select("y").distinct().select(ordering.seeded_digest("y")).distinct().count() == 5


def test_running_totals_keep_null_values(spark, monkeypatch):
    counted = spark.createDataFrame([("g", None, 2), *[("g", float(i), 1) for i in range(30)]], "g string, v double, n long")
    want = sorted(map(str, ordering.running_totals(counted, ["g"], "v", ["n"]).collect()))
    monkeypatch.setattr(ordering, "BIN_ROWS", 7)
    assert sorted(map(str, ordering.running_totals(counted, ["g"], "v", ["n"]).collect())) == want


def test_rounds_without_numbers_keep_each_other(spark, root):
    candidates = spark.createDataFrame([(i, f"http://h/{i}", i % 2) for i in range(20)], "id long, url string, is_phishing int")
    sent = candidates.select(F.md5("url").alias("uuid"), "url", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("submit_ts"), F.lit(None).cast("string").alias("submit_error"))
    document = F.concat(F.lit('{"task": {"url": "'), "url", F.lit('", "uuid": "'), "uuid", F.lit('"}}'))
    answers = sent.select("uuid", F.lit("2024-01-01 00:01:00").cast("timestamp").alias("response_ts"), F.lit(True).alias("ok"), F.lit(None).cast("string").alias("message"), document.alias("document"))
    for _ in range(2):
        scanning.scan_round(candidates, "id", sent, answers, root, sample_size=4).collect()
    ledger = get_table(spark, root, schemas.LEDGER_TABLE if hasattr(schemas, "LEDGER_TABLE") else scanning.LEDGER_TABLE)
    assert ledger.count() == ledger.select("url").distinct().count() == 16
    with pytest.raises(ValueError):
        scanning.scan_round(candidates, "id", sent, answers, root, 0, sample_size=4)


def test_scoring_fills_absent_columns(spark):
    from linkrisk.operators import models

    rows = spark.createDataFrame(
        [tuple(float(i * k % 7) for k in range(1, 9)) + (i % 2, str(i)) for i in range(40)],
        ", ".join(f"{c} double" for c in schemas.FEATURES) + ", label int, url string",
    )
    model = models.fit_model("Logistic Regression", rows)
    lacking = models.batch_score(model, rows.drop(schemas.FEATURES[2]), "url").collect()
    zero = models.batch_score(model, rows.withColumn(schemas.FEATURES[2], F.lit(0.0)), "url").collect()
    assert sorted(lacking) == sorted(zero) and len(lacking) == 40
