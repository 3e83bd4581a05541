"""Error-text rules of the generation loop as Column functions."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .jsonx import _c, let, ustrip

# Lower-case markers searched in error texts, per error class.
RETRIABLE_MARKERS = (
    "http 408", "http 429", "http 500", "http 502", "http 503", "http 504",
    "rate limit", "resource_exhausted", "quota", "model_capacity_exhausted",
    "unavailable", "auth_unavailable", "timeout", "timed out", "read timed out",
    "connection timed out", "timeouterror", "temporarily",
)
QUOTA_MARKERS = (
    "http 429", "rate limit", "quota", "resource_exhausted", "quota_exhausted",
    "model_cooldown", "cooling down", "model_capacity_exhausted",
)
JSON_PARSE_MARKERS = (
    "expecting value", "jsondecodeerror", "invalid json", "not json",
    "json 解析失败", "解析失败", "不是 json", "不是json",
)
TIMEOUT_MARKERS = ("timed out", "timeout", "timeouterror", "read timed out", "connection timed out")
MODEL_UNAVAILABLE_MARKERS = (
    "no longer available", "model is no longer available", "please switch to", "switch to",
)
# Keys tried in order for a retry delay given as a duration text,
# then the integer key.
DELAY_KEYS = ("retryDelay", "quotaResetDelay", "reset_time", "resetTime")
SECONDS_KEY = "reset_seconds"

# Forms of a duration text.
NUM = "(\\d+(?:\\.\\d+)?)"
SECONDS_ONLY = f"^{NUM}s$"
HMS = f"^(?:{NUM}h)?(?:{NUM}m)?(?:{NUM}s)?$"


def has_marker(c, markers) -> Column:
    low = F.lower(_c(c))
    return F.coalesce(reduce(lambda a, b: a | b, [low.contains(m) for m in markers]), F.lit(False))


def is_retriable(c) -> Column:
    return has_marker(c, RETRIABLE_MARKERS)


def is_quota(c) -> Column:
    return has_marker(c, QUOTA_MARKERS)


def is_json_parse(c) -> Column:
    return has_marker(c, JSON_PARSE_MARKERS)


def is_timeout(c) -> Column:
    return has_marker(c, TIMEOUT_MARKERS)


def is_model_unavailable(c) -> Column:
    return has_marker(c, MODEL_UNAVAILABLE_MARKERS)


def _num(s: Column) -> Column:
    return F.nullif(s, F.lit("")).try_cast("double")


def _duration(t: Column) -> Column:
    h = _num(F.regexp_extract(t, HMS, 1))
    m = _num(F.regexp_extract(t, HMS, 2))
    s = _num(F.regexp_extract(t, HMS, 3))
    total = F.coalesce(h * 3600, F.lit(0.0)) + F.coalesce(m * 60, F.lit(0.0)) + F.coalesce(s, F.lit(0.0))
    by_parts = let(total, lambda x: F.when(x > 0, F.ceil(x).cast("bigint")))
    return (
        F.when(t == "", F.lit(None).cast("bigint"))
        .when(t.rlike(SECONDS_ONLY), F.ceil(_num(F.regexp_extract(t, SECONDS_ONLY, 1))).cast("bigint"))
        .when(t.rlike(HMS), by_parts)
    )


def parse_duration_seconds(c) -> Column:
    """``1.5s`` -> 2, ``1h2m3s`` -> 3723; blank, no match or total <= 0 -> NULL.

    A plain seconds value is taken as is, so ``0s`` gives 0 while ``0h`` gives
    NULL (R6).
    """
    return let(ustrip(_c(c)), _duration)


def parse_retry_delay_seconds(c) -> Column:
    """First duration under retryDelay / quotaResetDelay / reset_time / resetTime
    that parses, else the integer under reset_seconds, else NULL (R7)."""
    e = _c(c)
    tries = [parse_duration_seconds(F.regexp_extract(e, f'"{k}"\\s*:\\s*"([^"]+)"', 1)) for k in DELAY_KEYS]
    secs = F.nullif(F.regexp_extract(e, f'"{SECONDS_KEY}"\\s*:\\s*(\\d+)', 1), F.lit("")).try_cast("bigint")
    return F.coalesce(*tries, secs)
