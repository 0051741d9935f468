"""Column expressions that classify answers, errors and predictions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from linkrisk import schemas

# Phrases that decide how an error is handled, tested in this order.
SUBMIT_PHRASES = [
    ("retry", ["rate limit", "429"]),
    ("permanent", ["bad request", "invalid"]),
]
RESULT_PHRASES = [
    ("pending", ["not found or not ready"]),
    ("permanent", ["dns", "domain", "unreachable"]),
]

# Ledger states of an attempt.
STATUS_SUCCESS = "success"
STATUS_PERMANENT = "failed_permanent"

# Accuracy gaps above which a model counts as over-fitted.
OVERFIT_BANDS = [(0.1, "red"), (0.05, "orange")]


def _by_phrase(message: Column, phrases: list, otherwise: str) -> Column:
    lowered = F.lower(message)
    outcome = F
    for name, words in phrases:
        found = F.lit(False)
        for word in words:
            found = found | F.contains(lowered, F.lit(word))
        outcome = outcome.when(found, name)
    return outcome.otherwise(otherwise)


def submit_error(message: Column) -> Column:
    return _by_phrase(message, SUBMIT_PHRASES, "unknown")


def result_error(message: Column) -> Column:
    return _by_phrase(message, RESULT_PHRASES, "unknown")


def http_status(phase: Column, code: Column) -> Column:
    """Outcome of an HTTP status code in the ``submit`` or ``result`` phase."""
    submit = F.when(code == 429, "rate_limit").when(code == 400, "bad_request")
    result = F.when(code == 404, "not_ready")
    return (
        F.when(code < 400, "ok")
        .when(phase == "submit", submit.otherwise("http_error"))
        .otherwise(result.otherwise("http_error"))
    )


def attempt_status(has_result: Column, submit_class: Column, result_class: Column) -> Column:
    """Ledger status of an attempt; null means that the URL may be tried again."""
    permanent = (submit_class == "permanent") | (result_class == "permanent")
    return F.when(has_result, STATUS_SUCCESS).when(permanent, STATUS_PERMANENT)


def prediction_label(prediction: Column) -> Column:
    return F.when(prediction == 1, schemas.LABEL_PHISHING).otherwise(schemas.LABEL_LEGITIMATE)


def prediction_confidence(prediction: Column, p_phishing: Column, p_legitimate: Column) -> Column:
    return F.when(prediction == 1, p_phishing).otherwise(p_legitimate)


def overfit_band(gap: Column) -> Column:
    band = F
    for limit, colour in OVERFIT_BANDS:
        band = band.when(gap > limit, colour)
    return band.otherwise("green")
