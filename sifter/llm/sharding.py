"""Sharding by a hierarchical weighted hash tree (region / rack / shard). DataFrame functions only.

Every node of the tree draws for the row's key: an exponential arrival time
with the node's weight as its rate, taken from a hash of (seed, key, node). An
inner node's weight is the sum of those below it. The row descends: of the
regions it takes the one that arrives first, of that region's racks the first,
of that rack's shards the first. Draws of one level know nothing of the levels
below, so a change of weights that leaves a node's sum as it was moves nothing
into or out of that node, and any other change moves rows only into nodes whose
weight grew and out of nodes whose weight shrank. A new shard comes in as a
region of its own (:func:`grow`), so it takes rows only into itself.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import stage, text_or_empty

SEED = 42
BUCKET_ROWS = 20_000  # rows aimed at in one numbering bucket

Tree = dict[str, dict[str, dict[int, float]]]


def default_tree(shards: int = 16, racks: int = 4, regions: int = 2) -> Tree:
    """Equal shards dealt to racks in turn, racks to regions."""
    tree: Tree = {}
    for s in range(shards):
        rack = s % racks
        tree.setdefault(f"region{rack % regions}", {}).setdefault(f"rack{rack}", {})[s] = 1.0
    return tree


def grow(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """``tree`` with one more shard, in a region and a rack of its own."""
    return {**tree, f"region+{shard}": {f"rack+{shard}": {shard: weight}}}


def _arrival(key: Column, node: str, weight: float, seed: int) -> Column:
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed).cast("bigint"), key, F.lit(node)), 11)
    u = (h.cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(u) / F.lit(float(weight))


def _first(key: Column, nodes: list[tuple[str, float, Column]], seed: int) -> Column:
    """The value of the node (name, weight, value) that arrives first; ties go to the earlier one."""
    if len(nodes) == 1:
        return nodes[0][2]
    at = F.least(*[F.struct(_arrival(key, name, weight, seed).alias("t"), F.lit(i).alias("i")) for i, (name, weight, _) in enumerate(nodes)])["i"]
    out = F
    for i, (*_, value) in enumerate(nodes):
        out = out.when(at == i, value)
    return out


def placement(key: Column, tree: Tree, seed: int = SEED) -> Column:
    """struct(shard, rack, region) of the leaf that the key descends to.

    Shards of weight 0 or less take no rows. Ties (of probability 2^-53 a
    pair) go to the node that sorts first. A NULL key is a key like any other.
    """
    regions = []
    for region in sorted(tree):
        racks = []
        for rack in sorted(tree[region]):
            shards = [
                (f"{region}/{rack}/{s}", w, F.struct(F.lit(s).alias("shard"), F.lit(rack).alias("rack"), F.lit(region).alias("region")))
                for s, w in sorted(tree[region][rack].items())
                if w > 0
            ]
            if shards:
                racks.append((f"{region}/{rack}", sum(w for _, w, _ in shards), _first(key, shards, seed)))
        if racks:
            regions.append((region, sum(w for _, w, _ in racks), _first(key, racks, seed)))
    if not regions:
        raise ValueError("the tree has no shard of positive weight")
    return _first(key, regions, seed)


def number_within(rows: DataFrame, group: str, key_cols: list[str], name: str = "slot") -> DataFrame:
    """Add ``name``: 0-based gapless position of each row of a group (rows staged by the caller).

    Rows are counted and numbered in hashed buckets of bounded size; a bucket's
    offset is the number of rows in the group's earlier buckets. Identical rows
    are collapsed before the shuffle and expanded after it, so one row repeated
    many times is a single row in its bucket.
    """
    cols = rows.columns
    n = rows.count()
    buckets = max(1, -(-n // BUCKET_ROWS))
    uniq = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
    b = uniq.withColumn("_b", F.pmod(F.xxhash64(*key_cols), F.lit(buckets)))
    counts = rows.withColumn("_b", F.pmod(F.xxhash64(*key_cols), F.lit(buckets))).groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(group, "_b").orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    local = b.withColumn("_at", F.coalesce(F.sum("_m").over(inside), F.lit(0)))
    j = local.join(offsets, [group, "_b"])
    k = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_m") - 1)).alias("_k")
    return j.select(*cols, "_off", "_at", k).select(*cols, (F.col("_off") + F.col("_at") + F.col("_k")).alias(name))


def shard_documents(
    docs: DataFrame, tree: Tree | None = None, grown: Tree | None = None, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED
) -> DataFrame:
    """Place every row: (id, size, text_crc32, region, rack, shard, grown_shard, slot).

    ``size`` is the text's UTF-8 length plus 1 (NULL text: 1); ``grown_shard``
    is the shard under the ``grown`` tree. The id and the tree alone decide the
    shard, so repeated ids stay together. An empty table gives no rows; other
    columns are not read.
    """
    tree = tree or default_tree(16)
    grown = grown or grow(tree, 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards))
    key = F.col(id_col)
    t = text_or_empty(text_col)
    placed = docs.select(
        key.alias("doc_id"),
        (F.octet_length(t) + 1).cast("bigint").alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"),
        placement(key, tree, seed).alias("_p"),
        placement(key, grown, seed)["shard"].alias("grown_shard"),
    )
    narrow = placed.select("doc_id", "size", "text_crc32", F.col("_p.region").alias("region"), F.col("_p.rack").alias("rack"), F.col("_p.shard").alias("shard"), "grown_shard")
    return number_within(stage(narrow, "shards"), "shard", ["doc_id", "text_crc32", "size"])
