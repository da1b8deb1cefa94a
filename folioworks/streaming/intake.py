"""Growing URL lists and attempt logs: the stateless jobs on a streaming DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from folioworks.config import Library
from folioworks.operators.attempts import attempt_outcomes
from folioworks.operators.urls import assign_library, document_ids, url_manifest


def stream_documents(url_lines: DataFrame, libraries: Sequence[Library]) -> DataFrame:
    """Stream of ``(pos, line)`` to identified URLs; one projection, no state and no watermark."""
    return document_ids(assign_library(url_manifest(url_lines), libraries))


def stream_outcomes(attempts: DataFrame) -> DataFrame:
    """Stream of attempts to judged attempts."""
    return attempt_outcomes(attempts)
