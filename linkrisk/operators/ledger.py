"""Submissions, answers and the ledger of finished attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkrisk import schemas
from linkrisk.functions import outcomes


def url_of_result(results: DataFrame, submissions: DataFrame) -> DataFrame:
    """Answers with the submitted URL, found by scan id."""
    return results.join(submissions.select("uuid", "url"), "uuid")


def submission_wait(submissions: DataFrame, results: DataFrame, max_wait: int = schemas.MAX_WAIT_BATCH) -> DataFrame:
    """Every submission with ``answered``: did a final answer arrive within ``max_wait`` seconds?

    Answers that only say "not ready" are no final answer.
    """
    joined = _with_answers(submissions, results, max_wait)
    return joined.select(*submissions.columns, F.col("response_ts").isNotNull().alias("answered"))


def _with_answers(submissions: DataFrame, results: DataFrame, max_wait: int) -> DataFrame:
    """Submissions left-joined with the first final answer that came in time."""
    final = results.where(F.col("ok") | (outcomes.result_error(F.col("message")) != "pending"))
    answers = final.select("uuid", "response_ts", "ok", "message")
    joined = submissions.join(answers, "uuid", "left")
    wait = F.make_dt_interval(secs=F.lit(max_wait))
    in_time = F.col("response_ts").between(F.col("submit_ts"), F.col("submit_ts") + wait)
    answer = F.min(F.when(in_time, F.struct("response_ts", "ok", "message"))).alias("_answer")
    return joined.groupBy(*submissions.columns).agg(answer).select(*submissions.columns, "_answer.*")


def resolve_attempts(submissions: DataFrame, results: DataFrame, max_wait: int = schemas.MAX_WAIT_BATCH) -> DataFrame:
    """Outcome and ledger status of every submission.

    outcome: ``success``, ``failed_permanent``, ``rejected`` (error that is not
    recorded), ``rate_limited`` or ``timed_out``; only the first two have a status.
    """
    return with_outcome(_with_answers(submissions, results, max_wait))


def with_outcome(joined: DataFrame) -> DataFrame:
    """Adds ``status`` and ``outcome`` to submissions joined with their answers."""
    submit = F.when(F.col("submit_error").isNotNull(), outcomes.submit_error(F.col("submit_error")))
    result = F.when(~F.col("ok"), outcomes.result_error(F.col("message")))
    answered = F.coalesce(F.col("ok"), F.lit(False)) & F.col("submit_error").isNull()
    status = outcomes.attempt_status(answered, submit, result)
    outcome = (
        F.when(status.isNotNull(), status)
        .when(submit == "retry", "rate_limited")
        .when(submit.isNotNull() | result.isNotNull(), "rejected")
        .otherwise("timed_out")
    )
    return joined.withColumns({"status": status, "outcome": outcome})


def batch_outcome_counts(attempts: DataFrame) -> DataFrame:
    """Submitted, retrieved, permanent and timed-out attempts of every batch."""
    outcome = F.col("outcome")
    return attempts.groupBy("batch").agg(
        F.count_if(F.col("submit_error").isNull()).alias("submitted"),
        F.count_if(outcome == outcomes.STATUS_SUCCESS).alias("retrieved"),
        F.count_if(outcome == outcomes.STATUS_PERMANENT).alias("permanent"),
        F.count_if(outcome == "timed_out").alias("timed_out"),
    )


def ledger_rows(attempts: DataFrame) -> DataFrame:
    """What the ledger keeps: (url, status, timestamp), only attempts with a status.

    All rows written in one call carry the same time.
    """
    recorded = attempts.where(F.col("status").isNotNull())
    return recorded.select("url", "status", F.current_timestamp().alias("timestamp"))
