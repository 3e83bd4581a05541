"""Connected components by alternating large-star and small-star rounds (DataFrame functions only).

Each round groups by node with map-side minima and joins the minimum back;
a node with very many links is split by AQE's skew join. The edges of every
round are written to the shared checkpoint folder, so no round replays
another. Rounds grow with the logarithm of the longest chain.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _mins(both: DataFrame) -> DataFrame:
    return both.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), F.least("_u", "_m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    j = both.join(_mins(both), F.col("u") == F.col("_u"))
    return j.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    j = down.join(_mins(down), F.col("u") == F.col("_u"))
    links = j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(j.select("u", F.col("m").alias("v")))
    return links.filter("u > v").distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)`` (bigint); ``root`` is the smallest node it reaches.

    Self links, repeated links and either direction are allowed; links with a
    NULL end are ignored; no edges give no rows.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    e = stage(e, "edges")
    seen = _print(e)
    while seen[0]:
        e = stage(_small_star(_large_star(e)), "edges")
        now = _print(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
