"""Submissions, answers, the ledger and their streaming forms, over the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkrisk.catalog import base, features as feature_queries
from linkrisk.catalog.base import query, table
from linkrisk.functions import outcomes
from linkrisk.operators import ledger
from linkrisk.session import scratch_path
from linkrisk.sources import tables
from linkrisk.streaming import incremental

# Every event is a submission. 'error' events fail at once, purchases divisible by 5 are never answered,
# sign-ups get an error, and clicks first hear that their scan is not ready.
SUBMISSIONS = """submissions AS (SELECT md5(CAST(event_id AS VARCHAR)) AS uuid, event_id, event_id // 200 AS batch,
  'https://u' || user_id || '.example/' || event_id AS url, ts AS submit_ts,
  CASE WHEN event_type = 'error' THEN ['Rate limit exceeded', 'Bad Request: invalid URL', 'HTTP error 429', 'connection reset'][CAST(event_id % 4 + 1 AS INTEGER)] END AS submit_error,
  event_type FROM events)"""
RESULTS = """results AS (
  SELECT md5(CAST(event_id AS VARCHAR)) AS uuid, ts + to_seconds(CAST((event_id * 37) % 400 AS DOUBLE)) AS response_ts, event_type <> 'signup' AS ok,
    CASE WHEN event_type = 'signup' THEN ['Scan result not found or not ready', 'DNS error: no such host', 'server busy'][CAST(event_id % 3 + 1 AS INTEGER)] END AS message
  FROM events WHERE event_type <> 'error' AND NOT (event_type = 'purchase' AND event_id % 5 = 0)
  UNION ALL SELECT md5(CAST(event_id AS VARCHAR)), ts + INTERVAL 1 SECOND, false, 'Scan result not found or not ready' FROM events WHERE event_type = 'click')"""
RESOLVED = f"""{SUBMISSIONS}, {RESULTS}, final AS (SELECT * FROM results WHERE ok OR NOT contains(lower(message), 'not found or not ready')),
attempts AS (SELECT s.*, f.ok, f.message, f.response_ts,
  CASE WHEN s.submit_error IS NULL THEN NULL WHEN contains(lower(s.submit_error), 'rate limit') OR contains(lower(s.submit_error), '429') THEN 'retry'
    WHEN contains(lower(s.submit_error), 'bad request') OR contains(lower(s.submit_error), 'invalid') THEN 'permanent' ELSE 'unknown' END AS submit_class,
  CASE WHEN f.ok OR f.ok IS NULL THEN NULL WHEN contains(lower(f.message), 'dns') OR contains(lower(f.message), 'domain')
    OR contains(lower(f.message), 'unreachable') THEN 'permanent' ELSE 'unknown' END AS result_class
  FROM submissions s LEFT JOIN final f ON f.uuid = s.uuid AND f.response_ts BETWEEN s.submit_ts AND s.submit_ts + INTERVAL 300 SECOND),
resolved AS (SELECT *, CASE WHEN coalesce(ok, false) AND submit_error IS NULL THEN 'success'
    WHEN submit_class = 'permanent' OR result_class = 'permanent' THEN 'failed_permanent' END AS status,
  CASE WHEN coalesce(ok, false) AND submit_error IS NULL THEN 'success'
    WHEN submit_class = 'permanent' OR result_class = 'permanent' THEN 'failed_permanent'
    WHEN submit_class = 'retry' THEN 'rate_limited' WHEN submit_class IS NOT NULL OR result_class IS NOT NULL THEN 'rejected'
    ELSE 'timed_out' END AS outcome FROM attempts)"""


def submissions_of(events: DataFrame) -> DataFrame:
    event_id, user = F.col("event_id"), F.col("user_id").cast("string")
    errors = F.array(*[F.lit(m) for m in ("Rate limit exceeded", "Bad Request: invalid URL", "HTTP error 429", "connection reset")])
    return events.select(
        F.md5(event_id.cast("string")).alias("uuid"),
        "event_id",
        F.expr("event_id div 200").alias("batch"),
        F.concat(F.lit("https://u"), user, F.lit(".example/"), event_id.cast("string")).alias("url"),
        F.col("ts").cast("timestamp").alias("submit_ts"),
        F.when(F.col("event_type") == "error", F.get(errors, (event_id % 4).cast("int"))).alias("submit_error"),
    )


def results_of(events: DataFrame) -> DataFrame:
    event_id, kind, ts = F.col("event_id"), F.col("event_type"), F.col("ts").cast("timestamp")
    errors = F.array(*[F.lit(m) for m in ("Scan result not found or not ready", "DNS error: no such host", "server busy")])
    answered = (kind != "error") & ~((kind == "purchase") & (event_id % 5 == 0))
    final = F.struct(
        (ts + F.make_dt_interval(secs=(event_id * 37) % 400)).alias("response_ts"),
        (kind != "signup").alias("ok"),
        F.when(kind == "signup", F.get(errors, (event_id % 3).cast("int"))).alias("message"),
    )
    early = F.struct(
        (ts + F.make_dt_interval(secs=F.lit(1))).alias("response_ts"), F.lit(False).alias("ok"), errors[0].alias("message")
    )
    answers = F.array_compact(F.array(F.when(answered, final), F.when(kind == "click", early)))
    return events.select(F.md5(event_id.cast("string")).alias("uuid"), F.inline(answers))


def _logs(spark, sf):
    events = table(spark, sf, "events")
    return submissions_of(events), results_of(events)


@query("classify_submit_error", f"""WITH {RESOLVED} SELECT event_id, submit_class FROM resolved WHERE submit_error IS NOT NULL""")
def classify_submit_error(spark, sf):
    failed = _logs(spark, sf)[0].where(F.col("submit_error").isNotNull())
    return failed.select("event_id", outcomes.submit_error(F.col("submit_error")).alias("submit_class"))


@query("classify_result_error", f"""WITH {RESULTS} SELECT uuid, CASE WHEN contains(lower(message), 'not found or not ready') THEN 'pending'
  WHEN contains(lower(message), 'dns') THEN 'permanent' ELSE 'unknown' END AS result_class FROM results WHERE message IS NOT NULL""")
def classify_result_error(spark, sf):
    failed = _logs(spark, sf)[1].where(F.col("message").isNotNull())
    return failed.select("uuid", outcomes.result_error(F.col("message")).alias("result_class"))


@query("classify_http_status", """SELECT event_id, phase, code, CASE WHEN code < 400 THEN 'ok' WHEN phase = 'submit' AND code = 429 THEN 'rate_limit'
  WHEN phase = 'submit' AND code = 400 THEN 'bad_request' WHEN phase = 'result' AND code = 404 THEN 'not_ready' ELSE 'http_error' END AS outcome
FROM (SELECT event_id, CASE WHEN event_type = 'click' THEN 'submit' ELSE 'result' END AS phase,
  [200, 400, 404, 429, 500][CAST(event_id % 5 + 1 AS INTEGER)] AS code FROM events)""")
def classify_http_status(spark, sf):
    codes = F.array(*[F.lit(c) for c in (200, 400, 404, 429, 500)])
    log = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "click", "submit").otherwise("result").alias("phase"),
        F.get(codes, (F.col("event_id") % 5).cast("int")).alias("code"),
    )
    return log.withColumn("outcome", outcomes.http_status(F.col("phase"), F.col("code")))


@query("attempt_status", f"WITH {RESOLVED} SELECT event_id, status FROM resolved WHERE status IS NOT NULL")
def attempt_status(spark, sf):
    resolved = ledger.resolve_attempts(*_logs(spark, sf))
    return resolved.where(F.col("status").isNotNull()).select("event_id", "status")


@query("resolve_attempts", f"WITH {RESOLVED} SELECT event_id, url, status, outcome FROM resolved")
def resolve_attempts(spark, sf):
    return ledger.resolve_attempts(*_logs(spark, sf)).select("event_id", "url", "status", "outcome")


@query("submission_wait", f"WITH {RESOLVED} SELECT event_id, response_ts IS NOT NULL AS answered FROM resolved")
def submission_wait(spark, sf):
    return ledger.submission_wait(*_logs(spark, sf)).select("event_id", "answered")


@query("url_of_result", f"WITH {SUBMISSIONS}, {RESULTS} SELECT r.uuid, s.url, r.ok FROM results r JOIN submissions s ON s.uuid = r.uuid")
def url_of_result(spark, sf):
    submissions, results = _logs(spark, sf)
    return ledger.url_of_result(results, submissions).select("uuid", "url", "ok")


@query("batch_outcome_counts", f"""WITH {RESOLVED} SELECT batch, count(*) FILTER (submit_error IS NULL) AS submitted,
  count(*) FILTER (outcome = 'success') AS retrieved, count(*) FILTER (outcome = 'failed_permanent') AS permanent,
  count(*) FILTER (outcome = 'timed_out') AS timed_out FROM resolved GROUP BY batch""")
def batch_outcome_counts(spark, sf):
    return ledger.batch_outcome_counts(ledger.resolve_attempts(*_logs(spark, sf)))


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The event log as a file stream."""
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over all data there is and return what it wrote."""
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    query_run = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, f"{name}-state"))
        .trigger(availableNow=True)
        .start()
    )
    query_run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def late_copies(results: DataFrame) -> DataFrame:
    """The answers and a contradicting one 30 seconds after every final answer, which must not count."""
    late = results.where(F.col("ok")).select(
        "uuid", (F.col("response_ts") + F.make_dt_interval(secs=F.lit(30))).alias("response_ts"), F.lit(False).alias("ok"), F.lit("DNS error").alias("message")
    )
    return results.unionByName(late)


# A success that comes too late is followed by an error that comes too late as well, so the outcomes are those of resolve_attempts.
@query("resolve_attempts_stream", f"WITH {RESOLVED} SELECT event_id, status, outcome FROM resolved")
def resolve_attempts_stream(spark, sf):
    stream = event_stream(spark, sf)
    resolved = incremental.resolve_stream(submissions_of(stream), late_copies(results_of(stream)))
    written = run_to_table(resolved.select("uuid", "event_id", "status", "outcome"), "resolved")
    sent, answers = _logs(spark, sf)
    rest = incremental.settle_rest(sent, late_copies(answers), written)
    return written.unionByName(rest.select(*written.columns)).select("event_id", "status", "outcome")


@query("dedupe_attempted", """SELECT DISTINCT 'https://u' || user_id || '.example/' AS url FROM events
WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 100)""")
def dedupe_attempted(spark, sf):
    url = F.concat(F.lit("https://u"), F.col("user_id").cast("string"), F.lit(".example/")).alias("url")
    bought = (F.col("event_type") == "purchase") & (F.col("value") > 100)
    root = scratch_path(spark, "tables")
    tables.write_batch(ledger.ledger_rows(table(spark, sf, "events").where(bought).select(url, F.lit(outcomes.STATUS_SUCCESS).alias("status"))), root, "attempted_scans", 1)
    done = tables.stream_log(spark, root, "attempted_scans", "url STRING")
    stream = event_stream(spark, sf).select(url, F.col("ts").cast("timestamp").alias("ts"))
    out = scratch_path(spark, "fresh")
    incremental.new_attempts(stream, done, "ts", "60 days", out, scratch_path(spark, "fresh-state")).awaitTermination()
    return spark.read.schema("url STRING").parquet(out).select("url")


@query("incremental_scan", f"""WITH {feature_queries.LABELS_OF_PAGES}
SELECT DISTINCT {base.FEATURE_LIST}, url, scan_uuid, is_phishing FROM joined WHERE is_phishing IS NOT NULL""")
def incremental_scan(spark, sf):
    landed = scratch_path(spark, "landed")
    docs = base.scan_documents(spark, sf)
    # Two deliveries of the same documents: the second finds every URL in the ledger.
    twice = docs.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    twice.repartitionByRange(4, "delivery", "page_id").select("document").write.parquet(landed)
    root = scratch_path(spark, "tables")
    run = incremental.incremental_scan(
        spark, landed, feature_queries._source(spark, sf), root, scratch_path(spark, "scan-state"), files_per_batch=1
    )
    run.awaitTermination()
    return incremental.read_features(spark, root)
