from __future__ import annotations

from pyspark.sql import Column, functions as F

# Texts that identify a failure class.
REGISTERED_ONLY_TEXT = "This video is only available for registered users"
RATE_LIMIT_TEXT = "Cannot parse data"
NO_POST_ID_TEXT = "Could not extract post ID"
TIMEOUT_TEXT = "TimeoutExpired"
INTERRUPTED_TEXT = "Interrupted by user"

ERROR_CLASSES = [
    (REGISTERED_ONLY_TEXT, "registered_only"),
    (RATE_LIMIT_TEXT, "rate_limited"),
    (NO_POST_ID_TEXT, "no_post_id"),
    (TIMEOUT_TEXT, "timeout"),
    (INTERRUPTED_TEXT, "interrupted"),
]

# Fixed value: ``[time] [context] url | reason``, context optional.
_LOG_LINE = r"^\[([^\]]*)\] (?:\[([^\]]*)\] )?(.*?) \| (.*)$"


def classify_error(message: Column) -> Column:
    out = F.when(message.isNull() | (message == ""), F.lit(None).cast("string"))
    for text, label in ERROR_CLASSES:
        out = out.when(message.contains(text), label)
    return out.otherwise("other")


def missing_log_line(line: Column) -> dict[str, Column]:
    """The four fields of a missing-file log line, all NULL when the line has another shape."""
    fields = {}
    for group, name in enumerate(["logged_at", "context", "url", "reason"], start=1):
        value = F.regexp_extract(line, _LOG_LINE, group)
        fields[name] = F.nullif(value, F.lit("")) if name == "context" else F.when(
            F.regexp_like(line, F.lit(_LOG_LINE)), value
        )
    return fields
