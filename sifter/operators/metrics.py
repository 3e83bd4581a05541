"""Training metric series and smoothing.

``metric_log(run_id, step, row VARIANT)``: one logged row per step; a row may
hold ``loss``, ``eval_loss`` or both.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rank import global_rank, null_safe_join

# Series names read from a log row, smoothing factor.
SERIES = ("loss", "eval_loss")
FACTOR = 0.85
PART_BITS = 8  # 256 points, or 256 parts, are folded in one row


def metric_series(log: DataFrame, names=SERIES) -> DataFrame:
    """Unpivot present series values: (run_id, name, step, value) (A5).

    One pass over the log: each row yields one candidate per series name and
    the absent ones are dropped (a row may hold several series).
    """
    cands = F.array(
        *[F.struct(F.lit(n).alias("name"), F.try_variant_get(F.col("row"), f"$.{n}", "double").alias("value")) for n in names]
    )
    out = log.select("run_id", "step", F.inline(cands))
    return out.filter(F.col("value").isNotNull()).select("run_id", "name", "step", "value")


def _fold(steps: Column, kind: str, carry: list[str]) -> Column:
    """Running composition of the maps s -> a*s + b in order: each element
    gains (pa, pb), the composition up to and including it."""

    def add(done, x):
        last = F.try_element_at(done, F.lit(-1))
        pa = x["a"] * F.coalesce(last["pa"], F.lit(1.0))
        pb = x["a"] * F.coalesce(last["pb"], F.lit(0.0)) + x["b"]
        return F.concat(done, F.array(F.struct(*[x[c].alias(c) for c in carry], pa.alias("pa"), pb.alias("pb"))))

    return F.aggregate(steps, F.array().cast(kind), add)


def _scan(maps: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """``maps(keys, at, a, b, ...)`` with (pa, pb), the composition of a series' maps up to each one, in place of (a, b).

    Parts of 256 maps are folded on their own, their ends are scanned in turn
    (``depth`` levels of parts), and what comes in from earlier parts is
    applied to every element. Rows folded together are bounded but for the
    last level, which holds one map per 256^depth points.
    """
    part = [*keys, "_part"]
    types = dict(maps.dtypes)
    carry = ["at", *[c for c in maps.columns if c not in (*keys, "at", "a", "b")]]
    kind = "array<struct<" + ",".join(f"{c}:{types[c]}" for c in carry) + ",pa:double,pb:double>>"
    cut = maps.withColumn("_part", F.shiftright("at", PART_BITS) if depth else F.lit(0).cast("bigint"))
    steps = F.array_sort(F.collect_list(F.struct(*carry, "a", "b")))
    folded = cut.groupBy(*part).agg(_fold(steps, kind, carry).alias("_f"))
    rows = folded.select(*part, F.inline("_f"))
    if not depth:
        return rows.drop("_part")
    end = F.element_at("_f", -1)
    ends = folded.select(*keys, F.col("_part").alias("at"), end["pa"].alias("a"), end["pb"].alias("b"))
    before = _scan(ends, keys, depth - 1).select(*keys, (F.col("at") + 1).alias("_part"), F.col("pa").alias("ca"), F.col("pb").alias("cb"))
    first = ends.filter("at = 0").select(*keys, F.lit(0).cast("bigint").alias("_part"), F.lit(1.0).alias("ca"), F.lit(0.0).alias("cb"))
    j = null_safe_join(rows, before.unionByName(first), part)
    return j.select(*keys, *carry, (F.col("pa") * F.col("ca")).alias("pa"), (F.col("pa") * F.col("cb") + F.col("pb")).alias("pb"))


def smooth(series: DataFrame, factor: float = FACTOR) -> DataFrame:
    """Add ``smoothed``: the exponential moving average of ``value`` per (run_id, name).

    The recurrence s0 = p0, s = factor * s + (1 - factor) * p is a chain of
    maps s -> a*s + b (a = 0 at the first point), and such maps compose, so
    the series is scanned in parts: exact for any factor, no horizon, and a
    long run never lands in one task. Points at equal steps are taken by value.
    """
    keys = ["run_id", "name"]
    ranked = global_rank(series, ["step", "value"], F.shiftright(F.col("step"), 16), within=keys, name="_i")
    ranked = ranked.withColumn("at", F.col("_i") - 1).drop("_i")
    f = F.lit(float(factor))
    start = F.col("at") == 0
    a = F.when(start, F.lit(0.0)).otherwise(f)
    b = F.when(start, F.col("value")).otherwise((F.lit(1.0) - f) * F.col("value"))
    done = _scan(ranked.select(*keys, "at", "step", "value", a.alias("a"), b.alias("b")), keys, 2)
    return done.select(*keys, "step", "value", F.col("pb").alias("smoothed"))
