"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.jobs import drop_staged, stage

__all__ = ["stage", "drop_staged", "table", "text_or_empty", "whole_row", "slot_of", "slot_filter", "with_slot_flag", "with_fields", "SLOT_BITS"]

# Size of a slot filter: 2^22 bits = 128 rows of 4 KB, whatever the input size.
SLOT_BITS = 22
_ROW_BITS = 32768  # bits in one bitmap row of Spark's bitmap functions


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that working columns can't clash with theirs (``select("row.*")`` gives them back)."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def slot_of(keys: list[Column], bits: int = SLOT_BITS) -> Column:
    """Slot (from 1) of a composite key."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << bits)) + 1


def slot_filter(slots: DataFrame, at_least: int = 2) -> DataFrame:
    """Bitmap of the slots that hold ``at_least`` rows of ``slots(slot)``.

    One row of 4 KB per 32768 slots: the size depends on the number of slots
    alone, never on the data, so broadcasting it is safe. A key met
    ``at_least`` times always has its bit set; another key may share a slot,
    so a set bit means "look closer" and never decides anything.
    """
    full = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= at_least)
    return full.groupBy(F.bitmap_bucket_number("slot").alias("_bkt")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("_bits")
    )


def with_slot_flag(df: DataFrame, slot: Column, bitmap: DataFrame, name: str) -> DataFrame:
    """Add boolean ``name``: whether the row's slot is set in ``bitmap``."""
    b = bitmap.select(F.col("_bkt").alias(f"_b_{name}"), F.col("_bits").alias(f"_m_{name}"))
    d = df.withColumn(f"_s_{name}", slot)
    j = d.join(F.broadcast(b), F.bitmap_bucket_number(f"_s_{name}") == F.col(f"_b_{name}"), "left")
    pos = F.bitmap_bit_position(f"_s_{name}")
    byte = F.conv(F.hex(F.substring(F.col(f"_m_{name}"), (pos / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.coalesce(F.getbit(byte.cast("bigint"), (pos % 8).cast("int")) == 1, F.lit(False))
    return j.withColumn(name, bit).drop(f"_b_{name}", f"_m_{name}", f"_s_{name}")


def with_fields(df: DataFrame, **types: T.DataType) -> T.StructType:
    """The schema of ``df`` with more fields at its end."""
    return T.StructType([*df.schema.fields, *[T.StructField(name, kind) for name, kind in types.items()]])
