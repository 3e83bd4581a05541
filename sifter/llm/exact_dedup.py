"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Each level keeps only the rows whose group is still larger than one, so the
next, more costly, key is computed for those alone:

1. byte length of every text;
2. a hash of the first characters of texts whose length is shared;
3. SHA-256 of the whole of texts whose (length, prefix hash) is shared.

What a level hands to the next is a bitmap of fixed size over hashed keys
(``common.slot_filter``). It is broadcast, so texts are never shuffled to find
groups; a shared slot only costs one more hash.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLOT_BITS, slot_filter, slot_of, stage, text_or_empty, whole_row, with_slot_flag

PREFIX_CHARS = 128


def _identity(c: Column) -> Column:
    return c


def candidates(docs: DataFrame, text_col: str = "text", bits: int = SLOT_BITS, normalise=_identity) -> DataFrame:
    """``docs`` with ``_text`` (normalised, never NULL) and ``_hash``: the full
    hash of texts that may have a copy, NULL for texts that surely have none."""
    d = docs.withColumn("_text", normalise(text_or_empty(text_col)))
    length = F.octet_length("_text").cast("bigint")
    by_length = [length]
    by_prefix = [length, F.xxhash64(F.substring("_text", 1, PREFIX_CHARS))]
    lengths = slot_filter(d.select(slot_of(by_length, bits).alias("slot")))
    d1 = with_slot_flag(d, slot_of(by_length, bits), lengths, "_same_length")
    prefixes = slot_filter(d1.filter("_same_length").select(slot_of(by_prefix, bits).alias("slot")))
    d2 = with_slot_flag(
        d1, F.when(F.col("_same_length"), slot_of(by_prefix, bits)), prefixes, "_same_prefix"
    )
    return d2.withColumn("_hash", F.when(F.col("_same_prefix"), F.sha2(F.col("_text"), 256))).drop("_same_length", "_same_prefix")


def groups(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(``_hash``, keep_id, group_size) of the texts held by more than one row; pre-aggregated, so a hot text is one row per task."""
    return (
        found.filter(F.col("_hash").isNotNull())
        .groupBy("_hash")
        .agg(F.max(id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
    )


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=_identity) -> DataFrame:
    """One row per document: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal when their normalised forms are identical (default: no
    change; NULL is the empty text). The largest id of a group stays; of rows
    that repeat both id and text one stays. A NULL id is below every other.
    Other columns are not read; an empty table gives no rows.
    """
    found = candidates(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), normalise=normalise)
    narrow = stage(found.select("doc_id", "_hash", F.coalesce("_hash", F.sha2("_text", 256)).alias("text_sha256")), "exact")
    rows = narrow.groupBy("doc_id", "text_sha256", "_hash").agg(F.count(F.lit(1)).alias("_m"))
    rows = rows.withColumn("_hash", F.coalesce("_hash", F.concat(F.lit("-"), F.xxhash64("doc_id").cast("string"))))
    j = rows.join(stage(groups(narrow), "exact-groups"), "_hash", "left")  # staged: AQE can split a hot text
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_m"))).alias("_k")
    return j.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"), "text_sha256", copies).select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("bigint").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_k") == 1)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=_identity, keep=F.max) -> DataFrame:
    """``docs`` with one row of each text: the one that ``dedup_report`` keeps (``keep=F.min``: the smallest id).

    Texts that surely have no copy pass straight through; only candidate rows
    are moved to meet their group's decision. Extra columns are carried.
    """
    packed = docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = candidates(packed, normalise=normalise)
    alone = found.filter(F.col("_hash").isNull()).select("row")
    maybe = found.filter(F.col("_hash").isNotNull())
    narrow = stage(maybe.select(F.col("id").alias("_id"), "_hash"), "exact")
    stays = stage(narrow.groupBy(F.col("_hash").alias("_h")).agg(keep("_id").alias("_keep")), "exact-groups")
    j = maybe.join(stays, (F.col("_hash") == F.col("_h")) & F.col("id").eqNullSafe(F.col("_keep")))
    return alone.unionByName(j.dropDuplicates(["_h"]).select("row")).select("row.*")
