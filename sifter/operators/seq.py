"""Ordered running aggregates that stay parallel inside one huge group.

``sum(x) over (partition by run order by seq)`` puts a whole run in one task.
A run may hold a third of all rows, so instead each running value is built in
parts: a window inside a bounded bucket of the run (``seq div 2^16``), and what
is carried over from earlier buckets of the same run. The carried values come
from the bucket totals, again in two levels (see :mod:`.rank`), so no window
holds more than 2^16 buckets or bucket groups, however sparse the key. Sums add
what is carried, maxima take the larger value, ``lag`` falls back to the last
value before the bucket.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rank import NULL_BUCKET, null_safe_join, with_super

DEFAULT_BITS = 16


def seq_bucket(col: str = "seq", bits: int = DEFAULT_BITS) -> Column:
    return F.shiftright(F.col(col), bits)


def _larger(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.greatest(a, b))


def running(
    df: DataFrame,
    within: list[str],
    order: list[str],
    bucket: Column,
    sums: dict[str, Column] | None = None,
    maxes: dict[str, Column] | None = None,
    lags: dict[str, Column] | None = None,
) -> DataFrame:
    """Add running sums / running maxima / previous values, per ``within`` group.

    Running values include the current row (``rows unbounded preceding``);
    ``lags`` give the value on the previous row (NULL on the first row).
    ``bucket`` must be non-decreasing in ``order`` inside a group.
    """
    sums, maxes, lags = dict(sums or {}), dict(maxes or {}), dict(lags or {})
    keys = list(within) + ["_bkt"]
    staged = df.withColumn("_bkt", F.coalesce(bucket.cast("bigint"), F.lit(NULL_BUCKET)))
    for name, c in {**sums, **maxes, **lags}.items():
        staged = staged.withColumn(f"_v_{name}", c)
    w_run = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_lag = Window.partitionBy(*keys).orderBy(*order)
    local = staged.select(
        "*",
        *[F.sum(f"_v_{n}").over(w_run).alias(f"_l_{n}") for n in sums],
        *[F.max(f"_v_{n}").over(w_run).alias(f"_l_{n}") for n in maxes],
        *[F.lag(f"_v_{n}").over(w_lag).alias(f"_l_{n}") for n in lags],
        *([F.row_number().over(w_lag).alias("_first")] if lags else []),
    )
    order_key = F.struct(*order)

    def totals(rows: DataFrame, by: list[str], value: str, last: Column) -> DataFrame:
        return rows.groupBy(*by).agg(
            *[F.sum(f"{value}{n}").alias(f"_t_{n}") for n in sums],
            *[F.max(f"{value}{n}").alias(f"_t_{n}") for n in maxes],
            *[F.max_by(f"{value}{n}", last).alias(f"_t_{n}") for n in lags],
            F.count(F.lit(1)).alias("_cnt"),
        )

    def carried(rows: DataFrame, part: list[str], by: str, out: str) -> list[Column]:
        at = Window.partitionBy(*part).orderBy(by)
        prev = at.rowsBetween(Window.unboundedPreceding, -1)
        return [
            *[F.sum(f"_t_{n}").over(prev).alias(f"{out}{n}") for n in sums],
            *[F.max(f"_t_{n}").over(prev).alias(f"{out}{n}") for n in maxes],
            *[F.lag(f"_t_{n}").over(at).alias(f"{out}{n}") for n in lags],
            F.row_number().over(at).alias(f"{out}at"),
        ]

    # bucket totals: a map-side partial aggregate over the needed columns only
    tot = with_super(totals(staged, keys, "_v_", order_key))
    inner = tot.select("*", *carried(tot, [*within, "_sup"], "_bkt", "_i_"))
    groups = totals(tot, [*within, "_sup"], "_t_", F.col("_bkt"))
    outer = groups.select(*within, "_sup", *carried(groups, list(within), "_sup", "_p_"))
    off = null_safe_join(inner, outer, [*within, "_sup"]).select(
        *keys,
        *[(F.coalesce(f"_i_{n}", F.lit(0)) + F.coalesce(f"_p_{n}", F.lit(0))).alias(f"_o_{n}") for n in sums],
        *[_larger(F.col(f"_i_{n}"), F.col(f"_p_{n}")).alias(f"_o_{n}") for n in maxes],
        *[F.when(F.col("_i_at") == 1, F.col(f"_p_{n}")).otherwise(F.col(f"_i_{n}")).alias(f"_o_{n}") for n in lags],
    )
    j = null_safe_join(local, off, keys)
    out = [(F.col(f"_o_{n}") + F.col(f"_l_{n}")).alias(n) for n in sums]
    out += [_larger(F.col(f"_o_{n}"), F.col(f"_l_{n}")).alias(n) for n in maxes]
    out += [F.when(F.col("_first") == 1, F.col(f"_o_{n}")).otherwise(F.col(f"_l_{n}")).alias(n) for n in lags]
    return j.select(*df.columns, *out)
