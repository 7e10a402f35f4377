"""Built-in column expressions for trips and run metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's for the same results -------------------
# Payment codes and their labels; any other code (and NULL) is "other".
PAYMENT_LABELS: dict[int, str] = {1: "card", 2: "cash", 3: "no charge", 4: "dispute"}
# Pivot columns of the payment mix, in this order.
PAYMENT_ORDER: list[str] = ["card", "cash", "no charge", "dispute", "other"]
# Distance buckets: below 1 is short, below 5 is medium, anything else long.
DISTANCE_BUCKETS: list[tuple[float, str]] = [(1.0, "short"), (5.0, "medium")]
DISTANCE_BUCKET_ELSE = "long"
# A stage is skewed when it completed, has at least 4 tasks, its slowest task ran at
# least 1000 ms and more than 5 times the median task (median floored at 1 ms).
SKEW_RATIO = 5
SKEW_MIN_MAX_MS = 1000
SKEW_MIN_TASKS = 4
# How a missing location id is written in a route key.
NO_ID = "None"
# Per-app metrics offered for comparison, and which of them are whole counts.
COMPARE_METRICS: list[str] = [
    "duration_s", "tasks", "stages", "jobs", "input_MB", "shuffle_write_MB", "gc_s",
]
COUNT_METRICS: set[str] = {"tasks", "stages", "jobs"}
# Job status display labels; other statuses pass through unchanged.
JOB_STATUS_LABELS: dict[str, str] = {"SUCCEEDED": "✅ Succeeded", "FAILED": "❌ Failed"}
# -------------------------------------------------------------------------------------------


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration(start: str | Column, end: str | Column, unit_seconds: int = 60) -> Column:
    """Whole-second difference ``end - start`` expressed in units of ``unit_seconds``.

    Both ends are truncated to the second before subtracting (a 60.9 s trip
    that starts at .1 s is 60 s), as ``unix_timestamp`` does.
    """
    return (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))) / unit_seconds


def payment_method(code: str | Column) -> Column:
    """Label of a payment code; NULL and unlisted codes map to ``other``."""
    code = _c(code)
    expr = None
    for value, label in PAYMENT_LABELS.items():
        expr = F.when(code == value, label) if expr is None else expr.when(code == value, label)
    return expr.otherwise("other")


def tip_pct(code: str | Column, tip: str | Column, fare: str | Column) -> Column:
    """Tip as percent of fare, one decimal, for card trips only (NULL otherwise or for a zero fare)."""
    return F.when(_c(code) == 1, F.round(F.try_divide(_c(tip), _c(fare)) * 100, 1))


def distance_bucket(distance: str | Column) -> Column:
    """short / medium / long by distance, as a CASE chain with an else branch."""
    distance = _c(distance)
    expr = None
    for bound, label in DISTANCE_BUCKETS:
        expr = F.when(distance < bound, label) if expr is None else expr.when(distance < bound, label)
    return expr.otherwise(DISTANCE_BUCKET_ELSE)


def route_key(pu: str | Column, do: str | Column) -> Column:
    """``"{pu}->{do}"``, a NULL id written as ``None``, so routes that lack an id stay apart."""
    side = lambda c: F.coalesce(_c(c).cast("string"), F.lit(NO_ID))
    return F.concat(side(pu), F.lit("->"), side(do))


def half_up(x: str | Column, digits: int = 0) -> Column:
    """Round half away from zero at ``digits`` decimals, as double.

    The double is rounded as the decimal number its text shows (1.005 gives
    1.01 at two digits); infinities and NaN stay what they are.
    """
    return F.round(_c(x).cast("double"), digits)


def millis_to_timestamp(ms: str | Column) -> Column:
    """Epoch milliseconds to a UTC timestamp."""
    return F.timestamp_millis(_c(ms))


def gmt_to_timestamp(text: str | Column) -> Column:
    """REST-style time text such as ``2026-09-21T22:36:47.323GMT`` to a timestamp."""
    return F.to_timestamp(_c(text), "yyyy-MM-dd'T'HH:mm:ss.SSS'GMT'")


def seconds_between_ms(start_ms: str | Column, end_ms: str | Column) -> Column:
    """Seconds between two epoch-millisecond values, keeping the milliseconds."""
    return (_c(end_ms) - _c(start_ms)) / 1000.0


def stage_label(stage_id: str | Column) -> Column:
    """``Stage <id>`` label used on timelines."""
    return F.concat(F.lit("Stage "), _c(stage_id).cast("string"))


def text_or_fallback(text: str | Column, fallback: str | Column, width: int | None = None) -> Column:
    """``text`` unless NULL or empty, else ``fallback``; optionally cut to ``width`` characters."""
    out = F.coalesce(F.nullif(_c(text), F.lit("")), _c(fallback))
    return F.left(out, F.lit(width)) if width else out
