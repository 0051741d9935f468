"""Structured Streaming forms of the scan loop: batches, timeouts and repeated URLs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from linkrisk import schemas
from linkrisk.functions import outcomes, scan
from linkrisk.operators import dedupe, features, ledger
from linkrisk.sources.scans import read_scan_documents
from linkrisk.sources.tables import get_table, stream_log, write_batch

FEATURE_TABLE = "scan_features"
LEDGER_TABLE = "attempted_scans"


def _earlier(spark: SparkSession, root: str, name: str, batch: int) -> DataFrame | None:
    """Rows of the batches before this one: a repeated batch must not see its own output."""
    found = get_table(spark, root, name)
    return None if found is None else found.where(F.col("batch") < batch)


def _one_per_url(docs: DataFrame) -> DataFrame:
    """(url, doc) of the readable documents, that with the least scan id for each URL."""
    parsed = read_scan_documents(docs)
    urls = parsed.withColumn("url", scan.submitted_url(F.col("doc"))).where("url is not null")
    return urls.withColumn("_uuid", scan.scan_uuid(F.col("doc"))).groupBy("url").agg(F.min_by("doc", F.struct("_uuid", F.xxhash64("doc"))).alias("doc"))


def _write_scans(todo: DataFrame, batch: int, source: DataFrame, root: str) -> None:
    todo = todo.persist()
    write_batch(features.labelled_features(todo, source), root, FEATURE_TABLE, batch)
    done = todo.select("url", F.lit(outcomes.STATUS_SUCCESS).alias("status"))
    write_batch(ledger.ledger_rows(done), root, LEDGER_TABLE, batch)
    todo.unpersist()


def process_scans(docs: DataFrame, batch: int, source: DataFrame, root: str) -> None:
    """One batch of scan documents: skip attempted URLs, write features, then the ledger.

    Documents that cannot be read or name no URL are left out, and of several with one URL
    that with the least scan id is taken.
    Features come first, as both tables count as seen: whatever fails in between
    is not scanned again. Every batch replaces its own folder, so it may be repeated.
    """
    spark = docs.sparkSession
    seen = dedupe.seen_urls(_earlier(spark, root, FEATURE_TABLE, batch), _earlier(spark, root, LEDGER_TABLE, batch))
    _write_scans(dedupe.exclude_scanned(_one_per_url(docs), seen), batch, source, root)


def unseen(stream: DataFrame, key: str, order: list[str], marks: list[DataFrame]) -> DataFrame:
    """The rows of a stream whose key no row of it and of the streams ``marks`` (key) had before, each key once.

    The keys live in the state store, so a micro-batch reads its own rows and the marks that are new, however long the
    history is. Of the rows of one micro-batch with one key that with the least ``order`` is taken, nulls
    last; a mark in the same micro-batch counts as earlier. Rows without a key are left out. Keep the rows narrow,
    they pass through Python.
    """
    columns = stream.columns
    rows = stream.where(F.col(key).isNotNull()).withColumn("_is_mark", F.lit(False))
    for mark in marks:
        rows = rows.unionByName(mark.where(F.col(key).isNotNull()).select(key, F.lit(True).alias("_is_mark")), allowMissingColumns=True)

    def first(_, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        best, known = None, state.exists
        for part in parts:
            known = known or bool(part["_is_mark"].any())
            if not known:
                part = part if best is None else pd.concat([best, part])
                best = part.sort_values(order, kind="stable").head(1)
        if not state.exists:
            state.update((True,))
        if not known and best is not None:
            yield best[columns]

    return rows.groupBy(key).applyInPandasWithState(first, stream.schema, "seen boolean", "append", "NoTimeout")


def incremental_scan(
    spark: SparkSession, landed: str, source: DataFrame, root: str, checkpoint: str, files_per_batch: int = 100
) -> StreamingQuery:
    """Process every landed document file once, in micro-batches, until none is left.

    ``landed`` holds Parquet files with a ``document`` column. A rerun with the same
    checkpoint continues behind the last finished batch. What was scanned before is kept by URL in the state of the
    stream. It learns from the features and the ledger as from streams, so what others write there counts too,
    and each row of them is read once. Documents are read again only in the batch in which their URL is new.
    """
    read = spark.readStream.option("maxFilesPerTrigger", files_per_batch).schema("document STRING")
    stream = read_scan_documents(read.parquet(landed).select("document", F.col("_metadata.file_path").alias("file")))
    keys = stream.select(scan.submitted_url(F.col("doc")).alias("url"), scan.scan_uuid(F.col("doc")).alias("scan"), F.xxhash64("doc").alias("h"), "file")
    marks = [stream_log(spark, root, name, "url STRING") for name in (FEATURE_TABLE, LEDGER_TABLE)]

    def run(new: DataFrame, batch: int) -> None:
        new = new.persist()
        files = [r.file for r in new.select("file").distinct().collect()]  # files_per_batch at most
        docs = spark.read.schema("document STRING").parquet(*files) if files else spark.createDataFrame([], "document STRING")
        todo = _one_per_url(docs).join(new.select("url"), "url", "left_semi")
        _write_scans(todo, batch, source, root)
        new.unpersist()

    return (
        unseen(keys, "url", ["scan", "h"], marks)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_features(spark: SparkSession, root: str) -> DataFrame:
    """The feature table: the newest row of every scan id."""
    found = get_table(spark, root, FEATURE_TABLE)
    if found is None:
        raise ValueError(f"no feature table below {root}")
    return dedupe.latest_by_key(found, ["scan_uuid"], ["batch"]).drop("batch")


def resolve_stream(
    submissions: DataFrame, results: DataFrame, max_wait: int = schemas.MAX_WAIT_BATCH, delay: str = "10 minutes"
) -> DataFrame:
    """Streaming ``resolve_attempts``: a submission is settled once the watermark passes its waiting time.

    ``submissions`` has (uuid, submit_ts, submit_error, ...); of several final answers in time the
    first counts. What the watermark has not passed when the stream ends, and rows that come
    more than ``delay`` late, are not emitted: ``settle_rest`` finds these.
    """
    answers = results.where(F.col("ok") | (outcomes.result_error(F.col("message")) != "pending"))
    answers = answers.select(F.col("uuid").alias("_uuid"), "response_ts", "ok", "message")
    left = submissions.withWatermark("submit_ts", delay)
    right = answers.withWatermark("response_ts", delay)
    # A literal interval: the state of the join is cleared by this range.
    in_time = F.expr(f"response_ts BETWEEN submit_ts AND submit_ts + INTERVAL {int(max_wait)} SECONDS")
    joined = left.join(right, (F.col("uuid") == F.col("_uuid")) & in_time, "leftOuter").drop("_uuid")
    first = joined.groupBy(*submissions.columns).agg(F.min(F.struct("response_ts", "ok", "message")).alias("_answer"))
    return ledger.with_outcome(first.select(*submissions.columns, "_answer.*"))


def settle_rest(
    submissions: DataFrame, results: DataFrame, settled: DataFrame, now: Column | None = None, max_wait: int = schemas.MAX_WAIT_BATCH
) -> DataFrame:
    """The outcomes of submissions that a finished or paused ``resolve_stream`` did not emit.

    ``settled`` holds what it has emitted. With ``now`` only those count whose waiting time is over by
    then; without it the logs are complete and all do. Batch work over the rest alone.
    """
    rest = submissions.join(settled.select("uuid"), "uuid", "left_anti").select(*submissions.columns)
    if now is not None:
        rest = rest.where(F.col("submit_ts") + F.make_dt_interval(secs=F.lit(max_wait)) < now)
    return ledger.resolve_attempts(rest, results, max_wait)


def new_attempts(
    stream: DataFrame, attempted: DataFrame | Callable[[], DataFrame | None], event_time: str, within: str, out: str, checkpoint: str
) -> StreamingQuery:
    """URLs of a stream that the ledger does not hold, each once, as batches below ``out``.

    ``attempted`` is the ledger as a stream: then the URLs of both live in the state store, a URL is let through once
    for all, and every row of the ledger is read once. Or it reads the ledger anew for every micro-batch, whose
    cost grows with the ledger; then a URL that comes again later than ``within`` is let through unless the ledger holds it
    by then.
    """
    if isinstance(attempted, DataFrame):
        once = unseen(stream.where("url is not null").select("url", event_time), "url", [event_time], [attempted])
    else:
        once = stream.where("url is not null").withWatermark(event_time, within).dropDuplicatesWithinWatermark(["url"])

    def run(batch_df: DataFrame, batch: int) -> None:
        rows = batch_df if isinstance(attempted, DataFrame) else dedupe.exclude_scanned(batch_df, attempted(), "url")
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return once.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
