"""Column expressions shared by the operators (all JVM-side built-ins)."""

from fleetlens.functions.exact import mean_of, means_by, merged_sum, partial_sum, sum_of  # noqa: F401
from fleetlens.functions.scalars import (  # noqa: F401
    COMPARE_METRICS,
    COUNT_METRICS,
    DISTANCE_BUCKETS,
    JOB_STATUS_LABELS,
    PAYMENT_LABELS,
    PAYMENT_ORDER,
    SKEW_MIN_MAX_MS,
    SKEW_MIN_TASKS,
    SKEW_RATIO,
    distance_bucket,
    duration,
    gmt_to_timestamp,
    half_up,
    millis_to_timestamp,
    payment_method,
    route_key,
    seconds_between_ms,
    stage_label,
    text_or_fallback,
    tip_pct,
)
