"""Alerts: what they say, and handing them to a channel."""

from __future__ import annotations

from collections.abc import Callable

#: Subjects.
STEP_FAILURE = "Step Functions Failure"
HIGH_LAG = "High CDC Lag"
DATA_QUALITY = "Data Quality Failure"
SCHEMA_BREAK = "Schema-Breaking Change"
MANY_REJECTS = "Excessive Rejected Records"
SLA_BREACH = "SLA Breach"
SUBJECT_CHARS = 100
#: Fixed value: the text of a failure.
MESSAGE = """\
CDC Pipeline Failure

Pipeline: {}
Environment: {}
Stage: {}

Records received: {:,}
Processed: {:,}
Rejected: {:,}

Error:
{}

Retry attempts: {}

Action:
{}
"""


def failure_message(
    pipeline: str,
    environment: str,
    stage: str,
    records_received: int = 0,
    processed: int = 0,
    rejected: int = 0,
    error: str = "",
    retry_attempts: int = 0,
    action: str = "Manual investigation required",
) -> str:
    """The body of an operational alert, counts with thousands separators."""
    return MESSAGE.format(pipeline, environment, stage, records_received, processed, rejected, error, retry_attempts, action)


def publish(send: Callable[[str, str, str], str | None] | None, topic: str, subject: str, message: str) -> str | None:
    """send(topic, subject, message) with a subject of bounded length; nothing without a topic."""
    if not topic or send is None:
        return None
    return send(topic, subject[:SUBJECT_CHARS], message)
