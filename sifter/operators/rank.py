"""Dense 1-based rank over a whole table without a single-partition window.

``row_number() over (order by k)`` sends every row to one task. Instead:

1. give each row a bucket that is monotone in the order key and holds a
   bounded number of rows (``pos div 2^20``, a hex prefix of a hash, a file
   split start);
2. ``row_number`` inside each bucket (one shuffle by bucket, bounded groups);
3. count rows per bucket and take running sums in two levels: inside groups of
   2^16 neighbouring bucket numbers, then over those groups. The offsets table
   has one row per bucket that holds rows, up to one per row if the key is
   sparse, so no window may span it: a window holds at most 2^16 buckets, or
   the groups of one ``within`` value (2^16 at most for bucket numbers below
   2^32). AQE broadcasts the table only when it measures it small;
4. rank = offset + row number.

Exact and repeatable for any partitioning.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_BITS = 20  # 1,048,576 rows per bucket at most for a dense pos
SUPER_BITS = 16  # bucket numbers that share a group of the offsets windows


def pos_bucket(col: str = "pos", bits: int = DEFAULT_BUCKET_BITS) -> Column:
    return F.shiftright(F.col(col), bits)


NULL_BUCKET = -(2**63)  # NULL order keys sort first, so their bucket is the smallest


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where NULL matches NULL (no row is dropped)."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond, "inner").drop(*[f"_r_{k}" for k in keys])


def with_super(counts: DataFrame, bucket: str = "_bkt") -> DataFrame:
    """Add ``_sup``: the group of neighbouring buckets that offsets windows run in."""
    return counts.withColumn("_sup", F.shiftright(bucket, SUPER_BITS))


def global_rank(
    df: DataFrame,
    order_cols: list,
    bucket: Column | list[Column],
    within: list[str] | None = None,
    name: str = "rank",
    total: str | None = None,
) -> DataFrame:
    """Add ``name``: 1-based dense position of each row by ``order_cols``.

    ``bucket`` must be non-decreasing in ``order_cols``; a list of columns is
    ordered like a tuple (conversation, then part of it). ``within`` restarts
    the numbering per group (e.g. per file); the groups only appear in the
    offsets tables and as a prefix of the bucket key, so a huge group is still
    spread over many buckets. ``total`` names an optional column holding the
    group's row count. Rows with NULL keys are kept (ranked first).

    The bucket counts are a map-side partial aggregate over the key columns
    only (a column-pruned read).
    """
    within = list(within or [])
    buckets = bucket if isinstance(bucket, list) else [bucket]
    names = ["_bkt", *[f"_bkt{i}" for i in range(1, len(buckets))]]
    keys = within + names
    staged = df
    for n, b in zip(names, buckets):
        staged = staged.withColumn(n, F.coalesce(b.cast("bigint"), F.lit(NULL_BUCKET)))
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    numbered = staged.withColumn("_rn", F.row_number().over(w))
    counts = with_super(staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")))
    inside = Window.partitionBy(*within, "_sup").orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_in", F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
    groups = counts.groupBy(*within, "_sup").agg(F.sum("_rows").alias("_t"))
    before = Window.partitionBy(*within).orderBy("_sup").rowsBetween(Window.unboundedPreceding, -1)
    cols = [*within, "_sup", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_out")]
    if total:
        cols.append(F.sum("_t").over(Window.partitionBy(*within)).cast("bigint").alias(total))
    offsets = null_safe_join(counts, groups.select(*cols), [*within, "_sup"])
    offsets = offsets.select(*keys, (F.col("_in") + F.col("_out")).alias("_off"), *([total] if total else []))
    out = null_safe_join(numbered, offsets, keys)
    return out.withColumn(name, (F.col("_off") + F.col("_rn")).cast("bigint")).drop(*names, "_rn", "_off")

