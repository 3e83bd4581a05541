"""Distributed selection: the first k rows by a key, without ranking all rows.

The key is text of a fixed width (hexadecimal digits of a hash or a number).
A histogram of its next three digits, at most 4096 counts that tasks have
summed, tells which digits the k-th row has; only the rows behind those digits
are looked at again, until few are left. Rows before the cut are in, rows past
it are out by comparison alone; only the rows at the cut are sorted.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rank import global_rank

DIGITS = 3  # digits of a histogram: 16^3 counts at most
INSIDE_ROWS = 100_000  # rows at the cut that are sorted in one bucket


@dataclass(frozen=True)
class Cut:
    """The first rows are those whose key is below ``prefix`` (as text of its
    length), and ``take`` of the ``inside`` rows that start with it."""

    prefix: str
    take: int
    inside: int
    total: int


def number_key(col: str = "pos") -> Column:
    """16 digits in the order of a BIGINT column; NULL comes first."""
    flipped = F.col(col).cast("bigint").bitwiseXOR(F.lit(-(2**63)).cast("bigint"))
    return F.coalesce(F.lpad(F.hex(flipped), 16, "0"), F.lit("!" * 16))


def find_cut(df: DataFrame, key: Column, k: Callable[[int], int], width: int) -> Cut:
    """Where the first ``k(number of rows)`` rows of ``df`` end by ``key``."""
    keys = df.select(key.alias("_k"))
    prefix, want, total, inside = "", None, 0, 0
    while True:
        rows = keys.filter(F.col("_k").startswith(prefix)) if prefix else keys
        counts = rows.groupBy(F.substring("_k", len(prefix) + 1, DIGITS).alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
        if want is None:
            total = sum(r["n"] for r in counts)
            want = min(k(total), total)
            if want <= 0:
                return Cut("", 0, total, total)
        for r in sorted(counts, key=lambda r: r["d"]):
            if want <= r["n"]:
                break
            want -= r["n"]
        prefix, inside = prefix + r["d"], r["n"]
        if inside <= INSIDE_ROWS or want == inside or len(prefix) >= width:
            return Cut(prefix, want, inside, total)


def _row_order(df: DataFrame) -> list[Column]:
    """The whole row, as far as it can be ordered."""
    return [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.simpleString() not in ("variant",) and "map<" not in f.dataType.simpleString()]


def flag_first(df: DataFrame, key: Column, cut: Cut, name: str = "first") -> DataFrame:
    """``df`` with boolean ``name``: whether the row is among the first of ``cut``.

    Rows at the cut are taken by key, then by the whole row. Keys that more
    than ``INSIDE_ROWS`` rows share are taken by a hash of the row instead of
    the row, in buckets of it. All rows but these are only compared.
    """
    if cut.take == 0:
        return df.withColumn(name, F.lit(False))
    head = F.substring(key, 1, len(cut.prefix))
    if cut.take == cut.inside:
        return df.withColumn(name, head <= cut.prefix)
    outside = df.filter(head != cut.prefix).withColumn(name, head < cut.prefix)
    at = df.filter(head == cut.prefix)
    if cut.inside <= INSIDE_ROWS:
        ranked = global_rank(at.withColumn("_key", key), [F.col("_key"), *_row_order(df)], F.lit(0), name="_rank")
    else:
        hashed = at.withColumn("_key", F.xxhash64(*_row_order(df)))
        ranked = global_rank(hashed, [F.col("_key")], F.shiftright("_key", 44), name="_rank")
    return outside.unionByName(ranked.withColumn(name, F.col("_rank") <= cut.take).drop("_rank", "_key"))
