"""Generation request-log analytics.

``request_log(run_id, seq, ts, attempt, batch_size, n_items, error)``: one row
per request attempt, ``error`` NULL on success. The retry loop's decisions
become row expressions (R8-R10); its running state becomes ordered running
aggregates per run (R11-R14) built with :func:`sifter.operators.seq.running`,
so a run of any size is spread over many tasks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import errors as E
from .clean import once
from .seq import running, seq_bucket

# Loop constants of the generator (defaults of the parameters).
BATCH_SIZE = 50
MIN_BATCH_ON_SHRINK = 5
GROW_STEP = 5
MAX_RETRIES = 5
BACKOFF_BASE_SECONDS = 5
MAX_CONSECUTIVE_FAILURES = 20
CHECKPOINT_EVERY = 100
MIN_REQUEST_INTERVAL_SECONDS = 1.0
TARGET_COUNT = 2000


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ (no time zone applied)."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def shrunk_batch(b: Column) -> Column:
    """Halve (not below 5); when that changes nothing, take one off (not below 1)."""
    half = F.greatest(F.lit(MIN_BATCH_ON_SHRINK), F.floor(b / 2).cast("int"))
    return F.when(half == b, F.greatest(F.lit(1), b - 1)).otherwise(half)


def grown_batch(b: Column, max_batch: int = BATCH_SIZE) -> Column:
    return F.when(b < max_batch, F.least(F.lit(max_batch), b + GROW_STEP)).otherwise(b)


def request_actions(
    log: DataFrame,
    pause_on_quota: bool = False,
    max_pause: int | None = None,
    max_retries: int = MAX_RETRIES,
    max_batch: int = BATCH_SIZE,
) -> DataFrame:
    """Add ``action``, ``wait_s``, ``next_batch_size``.

    Precedence: success; model unavailable -> stop; parse error or timeout
    with a batch that can shrink -> shrink (batches of 2-4 cannot: halving
    gives 5); quota -> wait or stop; retriable with attempts left -> backoff;
    else skip.
    """
    e, b = F.col("error"), F.col("batch_size")
    # classify the error text once, materialised before the CASE reads it
    staged = once(log.select(
        "*",
        E.parse_retry_delay_seconds(e).alias("_delay"),
        E.is_model_unavailable(e).alias("_unavail"),
        E.is_json_parse(e).alias("_parse"),
        E.is_timeout(e).alias("_timeout"),
        E.is_quota(e).alias("_quota"),
        E.is_retriable(e).alias("_retry"),
        shrunk_batch(b).alias("_smaller"),
    ))
    delay, smaller = F.col("_delay"), F.col("_smaller")
    can_shrink = (b > 1) & (smaller < b)
    quota_wait = F.coalesce(delay, F.lit(BACKOFF_BASE_SECONDS).cast("bigint"))
    if not pause_on_quota:
        quota_action = F.lit("stop")
    elif max_pause is None:
        quota_action = F.lit("wait")
    else:
        quota_action = F.when(quota_wait > max_pause, "stop").otherwise("wait")
    action = (
        F.when(e.isNull(), "success")
        .when(F.col("_unavail"), "stop")
        .when(F.col("_parse") & can_shrink, "shrink")
        .when(F.col("_timeout") & can_shrink, "shrink")
        .when(F.col("_quota"), quota_action)
        .when(F.col("_retry") & (F.col("attempt") < max_retries - 1), "backoff")
        .otherwise("skip")
    )
    staged = staged.withColumn("action", action)
    a = F.col("action")
    backoff_wait = F.coalesce(delay, ((F.col("attempt") + 1) * BACKOFF_BASE_SECONDS).cast("bigint"))
    wait = F.when(a == "wait", quota_wait).when(a == "backoff", backoff_wait)
    nxt = F.when(a == "success", grown_batch(b, max_batch)).when(a == "shrink", smaller).otherwise(b)
    out = staged.withColumn("wait_s", wait.cast("bigint")).withColumn("next_batch_size", nxt.cast("int"))
    return out.drop("_delay", "_unavail", "_parse", "_timeout", "_quota", "_retry", "_smaller")


def failure_streaks(
    log: DataFrame, limit: int = MAX_CONSECUTIVE_FAILURES, max_retries: int = MAX_RETRIES, **action_args
) -> DataFrame:
    """Add ``given_up`` (this attempt ended its batch without success), ``streak``
    (batches given up in a row up to this attempt, 0 on success) and
    ``stop_flag`` (a batch was given up and the streak reached ``limit``) (R11).

    An attempt that is retried, waits or shrinks its batch does not count. A
    batch is given up when it is skipped, or shrunk with no attempt left.
    """
    acted = request_actions(log, max_retries=max_retries, **action_args)
    last = (F.col("action") == "shrink") & (F.col("attempt") >= max_retries - 1)
    acted = acted.select(*log.columns, ((F.col("action") == "skip") | last).alias("given_up"))
    ok = F.col("error").isNull()
    lost = F.col("given_up").cast("bigint")
    r = running(acted, ["run_id"], ["seq"], seq_bucket(), sums={"_lost": lost})
    # the number given up by the last success so far: it never falls, so a running maximum finds it
    r = running(r, ["run_id"], ["seq"], seq_bucket(), maxes={"_at_ok": F.when(ok, F.col("_lost"))})
    streak = F.when(ok, F.lit(0)).otherwise(F.col("_lost") - F.coalesce("_at_ok", F.lit(0)))
    r = r.withColumn("streak", streak.cast("bigint"))
    return r.withColumn("stop_flag", F.col("given_up") & (F.col("streak") >= limit)).drop("_lost", "_at_ok")


def run_progress(log: DataFrame, target: int = TARGET_COUNT) -> DataFrame:
    """Add ``total`` (accepted so far, capped at ``target``), ``accepted``
    (rows kept from this request after the cap) and ``remaining`` (R12)."""
    got = F.when(F.col("error").isNull(), F.col("n_items")).otherwise(F.lit(0)).cast("bigint")
    r = running(log, ["run_id"], ["seq"], seq_bucket(), sums={"_run": got})
    total = F.least(F.col("_run"), F.lit(target).cast("bigint"))
    before = F.least(F.col("_run") - got, F.lit(target).cast("bigint"))
    return (
        r.withColumn("total", total)
        .withColumn("accepted", total - before)
        .withColumn("remaining", F.lit(target).cast("bigint") - total)
        .drop("_run")
    )


def checkpoint_marks(progress: DataFrame, every: int = CHECKPOINT_EVERY) -> DataFrame:
    """Requests after which progress is saved (R13): successes that added items
    and brought the running total to an exact multiple of ``every``, and, if
    ``progress`` has an ``action`` (R8), requests that stop the run."""
    full = F.col("error").isNull() & (F.col("accepted") > 0) & (F.col("total") % every == 0)
    return progress.filter(full | (F.col("action") == "stop") if "action" in progress.columns else full)


def rate_gaps(log: DataFrame, min_s: float = MIN_REQUEST_INTERVAL_SECONDS) -> DataFrame:
    """Add ``gap_s`` since the run's previous request start and ``wait_s``, the
    pause the rate guard needs before this start (R14)."""
    us = F.col("_us")
    staged = log.withColumn("_us", epoch_micros(F.col("ts")))
    r = running(staged, ["run_id"], ["seq"], seq_bucket(), lags={"_prev": us})
    gap = (F.col("_us") - F.col("_prev")) / F.lit(1e6)
    wait = F.when(gap < min_s, F.lit(min_s) - gap).otherwise(F.lit(0.0))
    return r.withColumn("gap_s", gap).withColumn("wait_s", wait).drop("_us", "_prev")
