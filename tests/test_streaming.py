"""Scan rounds and streams: nothing is scanned twice, and repeated batches change nothing."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from linkrisk.operators import ledger
from linkrisk.plans import scanning
from linkrisk.session import scratch_path
from linkrisk.sources import tables
from linkrisk.streaming import incremental


def documents(spark, ids):
    rows = [
        (json.dumps({"original_url": f"u{i}", "task": {"url": f"u{i}", "uuid": f"s{i}"}, "page": {"domain": "a.b"}}),) for i in ids
    ]
    return spark.createDataFrame(rows, "document STRING")


def source(spark, n=20):
    return spark.createDataFrame([(f"u{i}", i % 2) for i in range(n)], "url STRING, is_phishing INT")


def test_stream_continues_behind_its_checkpoint(spark, root):
    landed, state = scratch_path(spark, "landed"), scratch_path(spark, "state")

    def run():
        incremental.incremental_scan(spark, landed, source(spark), root, state, 1).awaitTermination()

    documents(spark, range(5)).coalesce(1).write.parquet(landed)
    run()
    assert incremental.read_features(spark, root).count() == 5
    documents(spark, range(3, 25)).coalesce(1).write.mode("append").parquet(landed)
    run()
    rows = incremental.read_features(spark, root)
    assert rows.count() == 20 and rows.select("scan_uuid").distinct().count() == 20
    log = tables.read_table(spark, root, incremental.LEDGER_TABLE)
    assert log.count() == 25 and log.select("url").distinct().count() == 25  # unlabeled scans count as attempted


def test_a_batch_does_not_read_the_history(spark, root):
    landed, state = scratch_path(spark, "landed"), scratch_path(spark, "state")
    tables.write_batch(spark.createDataFrame([("u1", "success")], "url STRING, status STRING"), root, incremental.LEDGER_TABLE, 1_000)
    marks = []
    for i in range(4):
        documents(spark, range(10 * i, 10 * i + 12)).coalesce(1).write.mode("append").parquet(landed)
        run = incremental.incremental_scan(spark, landed, source(spark, 60), root, state, 1)
        run.awaitTermination()
        read = [0, 0, 0]
        for progress in run.recentProgress:
            for k, part in enumerate(progress["sources"]):
                read[k] += part["numInputRows"]
        marks.append(read)
    assert [r[0] for r in marks] == [12] * 4
    assert [r[1] for r in marks] == [0, 11, 10, 10] and [r[2] for r in marks] == [1, 11, 10, 10]  # what the run before has written
    urls = [r.url for r in incremental.read_features(spark, root).collect()]
    assert sorted(urls) == sorted(f"u{i}" for i in range(42) if i != 1)


def test_of_copies_in_a_batch_the_least_scan_counts(spark, root):
    landed, state = scratch_path(spark, "landed"), scratch_path(spark, "state")
    rows = [json.dumps({"original_url": "u", "task": {"url": "u", "uuid": f"s{i}"}, "page": {"domain": "a.b"}}) for i in (7, 3, 5)]
    broken = ["no document", "{}", None]
    spark.createDataFrame([(r,) for r in rows + rows + broken], "document STRING").coalesce(1).write.parquet(landed)
    incremental.incremental_scan(spark, landed, spark.createDataFrame([("u", 1)], "url STRING, is_phishing INT"), root, state).awaitTermination()
    assert [r.scan_uuid for r in incremental.read_features(spark, root).collect()] == ["s3"]


def test_new_attempts_against_a_stream_of_the_ledger(spark, root):
    landed, out, state = (scratch_path(spark, name) for name in ("landed", "out", "state"))
    when = F.lit("2024-01-01").cast("timestamp")

    def run(attempted, urls, batch):
        tables.write_batch(spark.createDataFrame([(u,) for u in attempted], "url STRING"), root, "log", batch)
        rows = spark.createDataFrame([(u,) for u in urls], "url STRING").withColumn("ts", when)
        rows.write.mode("append").parquet(landed)
        stream, log = spark.readStream.schema(rows.schema).parquet(landed), tables.stream_log(spark, root, "log", "url STRING")
        incremental.new_attempts(stream, log, "ts", "1 day", out, state).awaitTermination()
        return sorted(r.url for r in spark.read.schema("url STRING").parquet(out).collect())

    assert run(["a"], ["a", "b", "b", None], 1) == ["b"]
    assert run(["c"], ["c", "d", "b"], 2) == ["b", "d"]


def test_repeated_batch_changes_nothing(spark, root):
    for _ in range(2):
        incremental.process_scans(documents(spark, range(4)), 0, source(spark), root)
    assert incremental.read_features(spark, root).count() == 4
    incremental.process_scans(documents(spark, range(2, 6)), 1, source(spark), root)
    incremental.process_scans(documents(spark, range(2, 6)), 1, source(spark), root)
    assert incremental.read_features(spark, root).count() == 6
    assert tables.read_table(spark, root, incremental.LEDGER_TABLE).count() == 6


def test_unreadable_documents_and_copies_in_a_batch(spark, root):
    broken = spark.createDataFrame([("no document",), ("{}",), (None,)], "document STRING")
    docs = documents(spark, [1, 1, 2]).union(broken)
    incremental.process_scans(docs, 0, source(spark), root)
    log = tables.read_table(spark, root, incremental.LEDGER_TABLE)
    assert sorted(r.url for r in log.collect()) == ["u1", "u2"]
    assert sorted(r.url for r in tables.read_table(spark, root, incremental.FEATURE_TABLE).collect()) == ["u1", "u2"]


def test_new_attempts_read_the_ledger_in_every_batch(spark, root):
    landed, out, state = (scratch_path(spark, name) for name in ("landed", "out", "state"))
    ledger_rows = ["a"]
    rows = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "url STRING").withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    rows.write.parquet(landed)

    def run():
        stream = spark.readStream.schema(rows.schema).parquet(landed)
        seen = lambda: spark.createDataFrame([(u,) for u in ledger_rows], "url STRING")
        incremental.new_attempts(stream, seen, "ts", "1 day", out, state).awaitTermination()
        return sorted(r.url for r in spark.read.schema("url STRING").parquet(out).collect())

    assert run() == ["b"]
    ledger_rows.append("c")
    spark.createDataFrame([("c",), ("d",)], "url STRING").withColumn("ts", F.lit("2024-01-01").cast("timestamp")).write.mode("append").parquet(landed)
    assert run() == ["b", "d"]


def logs(spark):
    sent = spark.createDataFrame(
        [("a", "ua", 0, None), ("b", "ub", 0, None), ("c", "uc", 0, None), ("d", "ud", 0, "Rate limit"), ("e", "ue", 0, "Bad request"), ("f", "uf", 0, None)],
        "uuid STRING, url STRING, s INT, submit_error STRING",
    )
    answers = spark.createDataFrame(
        [
            ("a", 10, False, "not found or not ready"),
            ("a", 20, True, None),
            ("b", 30, False, "DNS error"),
            ("c", 400, True, None),
            ("f", 300, False, "server busy"),
        ],
        "uuid STRING, s INT, ok BOOLEAN, message STRING",
    )
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")

    def at(df, name):
        return df.withColumn(name, start + F.make_dt_interval(secs=F.col("s"))).drop("s")

    return at(sent, "submit_ts"), at(answers, "response_ts")


EXPECTED = {
    "a": ("success", "success"),
    "b": ("failed_permanent", "failed_permanent"),
    "c": (None, "timed_out"),
    "d": (None, "rate_limited"),
    "e": ("failed_permanent", "failed_permanent"),
    "f": (None, "rejected"),
}


def test_outcomes(spark):
    resolved = ledger.resolve_attempts(*logs(spark))
    assert {r.uuid: (r.status, r.outcome) for r in resolved.collect()} == EXPECTED
    assert {r.url for r in ledger.ledger_rows(resolved).collect()} == {"ua", "ub", "ue"}
    counts = ledger.batch_outcome_counts(resolved.withColumn("batch", F.lit(0))).first()
    assert (counts.submitted, counts.retrieved, counts.permanent, counts.timed_out) == (4, 1, 2, 1)
    longer = ledger.resolve_attempts(*logs(spark), max_wait=600)
    assert {r.uuid: r.outcome for r in longer.collect()}["c"] == "success"


def test_stream_resolves_like_the_batch(spark):
    sent, answers = logs(spark)
    paths = [scratch_path(spark, name) for name in ("sent", "answers", "out", "state")]
    late = F.lit("2024-01-02 00:00:00").cast("timestamp")
    answers = answers.unionByName(answers.where("ok").selectExpr("uuid", "response_ts + interval 5 seconds as response_ts", "false as ok", "'DNS error' as message"))
    # A day later another submission and answer move the watermark past all waiting times.
    sent.unionByName(sent.limit(1).select(F.lit("z").alias("uuid"), F.lit("uz").alias("url"), F.lit(None).cast("string").alias("submit_error"), late.alias("submit_ts"))).write.parquet(paths[0])
    answers.unionByName(answers.limit(1).select(F.lit("z").alias("uuid"), F.lit(True).alias("ok"), F.lit(None).cast("string").alias("message"), late.alias("response_ts"))).write.parquet(paths[1])
    streams = [spark.readStream.schema(df.schema).parquet(path) for df, path in zip((sent, answers), paths)]
    out = incremental.resolve_stream(*streams)
    run = out.writeStream.format("parquet").option("path", paths[2]).option("checkpointLocation", paths[3]).trigger(availableNow=True).start()
    run.awaitTermination()
    got = {r.uuid: (r.status, r.outcome) for r in spark.read.parquet(paths[2]).collect()}
    assert {k: v for k, v in got.items() if k != "z"} == EXPECTED
    settled = spark.read.parquet(paths[2])
    assert settled.count() == settled.select("uuid").distinct().count()
    logs_ = [spark.read.parquet(path) for path in paths[:2]]
    rest = incremental.settle_rest(*logs_, settled)
    assert sorted((r.uuid, r.outcome) for r in settled.select("uuid", "outcome").union(rest.select("uuid", "outcome")).collect()) == sorted([(k, v[1]) for k, v in EXPECTED.items()] + [("z", "success")])
    waiting = incremental.settle_rest(*logs_, settled.limit(0), F.lit("2024-01-01 12:00:00").cast("timestamp"))
    assert {r.uuid for r in waiting.collect()} == set(EXPECTED)


def test_rounds_never_scan_twice(spark, root):
    ids = list(range(40))
    candidates = spark.createDataFrame([(i, f"u{i}", i % 2) for i in ids], "id BIGINT, url STRING, is_phishing INT")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    sent = candidates.select(
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("uuid"), "url", start.alias("submit_ts"), F.lit(None).cast("string").alias("submit_error")
    )
    never = (4, 5)  # these get no answer and stay retryable
    docs = documents(spark, ids).withColumn("uuid", F.get_json_object("document", "$.task.uuid"))
    answers = docs.where(~F.col("uuid").isin(*[f"s{i}" for i in never])).select(
        "uuid", start.alias("response_ts"), F.lit(True).alias("ok"), F.lit(None).cast("string").alias("message"), "document"
    )
    for round_no in range(5):
        scanning.scan_round(candidates, "id", sent, answers, root, round_no, sample_size=6)
    log = {r.url for r in tables.read_table(spark, root, incremental.LEDGER_TABLE).collect()}
    assert tables.read_table(spark, root, incremental.LEDGER_TABLE).count() == len(log)
    assert not log & {f"u{i}" for i in never}
    rows = incremental.read_features(spark, root)
    assert {r.url for r in rows.collect()} == log and rows.count() == len(log)
    # What is left is offered again in equal numbers; a surplus of one class waits.
    left = [[i for i in ids if f"u{i}" not in log and i % 2 == cls] for cls in (0, 1)]
    plan = scanning.plan_round(candidates, "id", root).collect()
    assert len(plan) == 2 * min(len(left[0]), len(left[1])) and not {r.url for r in plan} & log
