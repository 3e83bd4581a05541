"""Seed + generated datasets: checkpoint, resume, finalise.

Counts that steer a step (how many seed rows, how many rows to keep) are
scalar subqueries: one number computed once, no join of the data with it.
"""
from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .rank import global_rank, pos_bucket
from .select import find_cut, flag_first, number_key

log = logging.getLogger(__name__)
TARGET_COUNT = 2000


def _with_source(df: DataFrame, source: str) -> DataFrame:
    return df if "source" in df.columns else df.withColumn("source", F.lit(source))


def checkpoint_rows(seed: DataFrame, generated: DataFrame) -> DataFrame:
    """Seed rows followed by generated rows; generated ``pos`` continues after the seed.

    Write the result to a new directory (Parquet) so a failed write never
    replaces the previous checkpoint.
    """
    n_seed = seed.select(F.count(F.lit(1))).scalar()
    g = global_rank(generated, ["pos"], pos_bucket("pos"), name="_r")
    g = g.withColumn("pos", n_seed + F.col("_r") - 1).drop("_r")
    return _with_source(seed, "seed").unionByName(_with_source(g, "generated"), allowMissingColumns=True)


def resume_generated(ckpt: DataFrame, seed: DataFrame) -> DataFrame:
    """Generated rows of a checkpoint: rows past the seed count, only when the
    checkpoint holds at least the seed count; ``pos`` restarts at 0 (S6)."""
    n_seed = seed.select(F.count(F.lit(1))).scalar()
    n_ckpt = ckpt.select(F.count(F.lit(1))).scalar()
    kept = ckpt.filter((n_ckpt >= n_seed) & (F.col("pos") >= n_seed))
    return kept.withColumn("pos", F.col("pos") - n_seed)


def finalize_dataset(seed: DataFrame, generated: DataFrame, target: int = TARGET_COUNT) -> DataFrame:
    """Seed rows plus the first ``target`` generated rows in ``pos`` order.

    Rows that share a position are taken in the order of the whole row. The cut
    is found from histograms of the positions (:mod:`.select`), whatever the
    target; only kept rows are numbered.
    """
    key = number_key("pos")
    first = flag_first(generated, key, find_cut(generated, key, lambda n: target, 16), "_first")
    return checkpoint_rows(seed, first.filter("_first").drop("_first"))


def resume_from(spark, path: str, seed: DataFrame) -> DataFrame:
    """Generated rows of the checkpoint table at ``path`` (Parquet). A missing
    or corrupt checkpoint is ignored with a warning (no generated rows); any
    other failure to read it is raised (S6)."""
    ckpt = read_table(spark, path)
    if ckpt is None:
        log.warning("no readable checkpoint at %s: starting over", path)
        return seed.limit(0)
    return resume_generated(ckpt, seed)
