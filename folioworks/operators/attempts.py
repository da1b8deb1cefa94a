"""Download attempts: what happened, and was it only a certificate?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from folioworks.functions.binding import let
from folioworks.functions.text import is_blank

# ---- fixed values -------------------------------------------------------------------------------------------
_DISCOVERY_FAILED = "Dezoomer error: discovery failed: no discovery candidate accepted the input"
_REASON_LINE = r"(?s)^[ \t]*-[ \t]+[A-Za-z0-9_]+:[ \t]+(.+)\z"
_REQUEST_HEADS = (
    "error sending request for url (",
    "failed to download krpano metadata: error sending request for url (",
)
_REQUEST_END = "): "
_REQUEST_ERROR = "): error:"
_TLS_MARKS = (":SSL routines:", ":certificate verify failed:")
_MISMATCH_HEADS = ("not a ", "not an ")
_MISMATCH_TAILS = (" URL", " file", " template")


def _any_of(tests: list[Column]) -> Column:
    result = tests[0]
    for test in tests[1:]:
        result = result | test
    return result


def _is_certificate_reason(reason: Column) -> Column:
    after = F.substr(reason, F.instr(reason, _REQUEST_END) + F.lit(len(_REQUEST_END)))
    return (
        _any_of([reason.startswith(head) for head in _REQUEST_HEADS])
        & reason.contains(_REQUEST_ERROR)
        & after.contains(_TLS_MARKS[0])
        & after.contains(_TLS_MARKS[1])
    )


def _is_mismatch_reason(reason: Column) -> Column:
    return _any_of([reason.startswith(head) for head in _MISMATCH_HEADS]) & _any_of(
        [reason.endswith(tail) for tail in _MISMATCH_TAILS]
    )


def certificate_only(stderr: Column) -> Column:
    """True when a discovery failure lists certificate failures and format mismatches, and at least one former."""
    lines = F.transform(F.split(stderr, "\n"), lambda line: F.regexp_extract(line, _REASON_LINE, 1))
    # 0 no reason line, 1 certificate, 2 mismatch, 3 anything else
    codes = F.transform(
        lines,
        lambda reason: F.when(reason == "", 0)
        .when(_is_certificate_reason(reason), 1)
        .when(_is_mismatch_reason(reason), 2)
        .otherwise(3),
    )
    listed = let(F.array_distinct(codes), lambda seen: F.array_contains(seen, 1) & ~F.array_contains(seen, 3))
    verdict = F.when(stderr.contains(_DISCOVERY_FAILED), listed)
    return F.coalesce(verdict, F.lit(False))


def cert_logs(attempts: DataFrame) -> DataFrame:
    """Add ``certificate_only`` to rows with ``stderr``. The whole text is judged inside its row."""
    return attempts.withColumn("certificate_only", certificate_only(F.col("stderr")))


def attempt_outcomes(attempts: DataFrame) -> DataFrame:
    """Add ``outcome`` (``ok``, ``failed``, ``exception``) and ``reason`` to attempt rows.

    The error text is only judged for runs that ended badly and printed nothing.
    """
    certificate = is_blank(F.coalesce("stdout", F.lit(""))) & certificate_only(F.coalesce("stderr", F.lit("")))
    reason = (
        F.when(~F.col("tool_found"), "tool_missing")
        .when(F.col("exception"), "exception")
        .when(F.col("timed_out"), "timeout")
        .when(F.col("returncode") == 0, "ok")
        .when(certificate, "certificate")
        .otherwise("error")
    )
    outcome = (
        F.when(F.col("reason") == "ok", "ok").when(F.col("reason") == "exception", "exception").otherwise("failed")
    )
    return attempts.withColumn("reason", reason).withColumn("outcome", outcome)
