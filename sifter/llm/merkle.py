"""Merkle manifest of a dataset by butterfly exchange.

Every row is a leaf: the SHA-256 of its columns. The leaves of one language, in
ascending id, form a tree of fanout 8; the languages' roots form one more tree
above them. Each row gets the digest of its proof (the siblings on the way to
the root), and its proof can be folded again from a changed leaf.

1. Rows are numbered within their tree by a range-partitioned sort; offsets
   come from the counts of the partitions, so a language that holds most rows
   is spread like any other.
2. A partition of the tree is an aligned block of ``fanout ** block_levels``
   leaves. It hashes its own subtree.
3. Butterfly: in round r, blocks that differ in digit r of their number alone
   swap the roots they hold, at most ``fanout`` of them a group, and each
   hashes the common ancestor for itself. After log(blocks) rounds every block
   holds the root and all siblings above it; nothing is handed down again. At
   the ragged right edge, where a subtree has fewer blocks than its partners,
   its blocks serve the missing places in turn.
4. A block, with what it holds, derives its leaves' proofs.
"""
from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_staged, stage

FANOUT = 8
BLOCK_LEVELS = 3  # a block holds 8^3 = 512 leaves
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEP = "struct<digit:int,others:array<string>>"


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Hex SHA-256 over the columns in order: ``-`` if NULL, else byte count, ``:``, value."""
    parts = []
    for c in columns.values():
        s = c.cast("string")
        parts.append(F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat(*parts), 256)


def place_in_tree(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (staged by the caller) with ``pos``, 0-based within ``tree`` by
    ``order``, and ``total``, the rows of the tree. ``tree`` is never NULL."""
    at = F.monotonically_increasing_id()
    spread = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("_at", at)
    spread = stage(spread, "merkle-sorted")
    part = F.shiftright("_at", 33)
    counts = spread.groupBy("tree", part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    off = counts.select(  # one row for each partition and tree that meet: as few as partitions and trees together
        "tree", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"), F.sum("_n").over(Window.partitionBy("tree")).alias("total")
    )
    j = spread.withColumn("_part", part).join(off, ["tree", "_part"])
    return j.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_off")).drop("_at", "_part", "_first", "_off")


def subtree(digests: list[str], fanout: int, steps: int) -> list[list[str]]:
    """The levels of a block, leaves first, each of ``steps`` levels above from runs of ``fanout``."""
    levels = [digests]
    for _ in range(steps):
        below = levels[-1]
        levels.append([_digest("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return levels


def steps_inside(total: int, fanout: int, block_levels: int) -> int:
    """Levels hashed within a block of a tree of ``total`` leaves: until one node remains, ``block_levels`` at most."""
    steps, nodes = 0, total
    while nodes > 1 and steps < block_levels:
        nodes, steps = -(-nodes // fanout), steps + 1
    return steps


_BLOCK = "tree string, block bigint, total bigint, payload binary, leaves binary, changed binary, digest string"


def _pack_block(fanout: int, block_levels: int):
    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by([("pos", "ascending")])
        leaves = t.column("leaf").to_pylist()
        total = t.column("total")[0].as_py()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("payload", t.schema.field("payload").type)])) as w:
            w.write_table(pa.table({"payload": t.column("payload").combine_chunks()}))
        root = subtree(leaves, fanout, steps_inside(total, fanout, block_levels))[-1][0]
        changed = [c or x for c, x in zip(t.column("changed").to_pylist(), leaves)]
        return pa.table(
            {
                "tree": t.column("tree").slice(0, 1), "block": t.column("block").slice(0, 1), "total": pa.array([total], pa.int64()),
                "payload": pa.array([sink.getvalue().to_pybytes()], pa.binary()), "leaves": pa.array([bytes.fromhex("".join(leaves))], pa.binary()),
                "changed": pa.array([bytes.fromhex("".join(changed))], pa.binary()), "digest": pa.array([root], pa.string()),
            }
        )

    return run


def swap_round(nodes: DataFrame, r: int, fanout: int) -> DataFrame:
    """One butterfly round over ``nodes(tree, block, blocks, digest, proof)``:
    the digest becomes that of the ancestor one level up, the proof gains a step."""
    span = fanout**r
    node, low = F.expr(f"block div {span}"), F.col("block") % span
    held = F.least(F.lit(span).cast("bigint"), F.col("blocks") - node * span)  # blocks of this subtree
    active = F.col("blocks") > span
    # a full subtree's block serves its own place; blocks of a ragged one serve the places beyond it too
    serves = F.when(active & (held < span), F.sequence(low, F.lit(span - 1).cast("bigint"), held)).otherwise(F.array(low))
    sent = nodes.select("*", node.alias("_node"), low.alias("_low"), active.alias("_up"), F.explode(serves).alias("_to"))
    mine = F.col("_to") == F.col("_low")
    member = F.struct(
        (F.col("_node") % fanout).cast("int").alias("digit"), "digest", F.when(mine, F.col("block")).alias("block"), F.when(mine, F.col("proof")).alias("proof")
    )
    met = sent.groupBy("tree", "blocks", "_up", F.expr(f"_node div {fanout}").alias("_parent"), "_to").agg(F.sort_array(F.collect_list(member)).alias("_m"))
    up = F.sha2(F.array_join(F.transform("_m", lambda m: m["digest"]), ""), 256)
    one = F.explode(F.filter("_m", lambda m: m["block"].isNotNull())).alias("_one")
    out = met.select("tree", "blocks", "_up", "_m", up.alias("_digest"), one)
    others = F.transform(F.filter("_m", lambda m: m["digit"] != F.col("_one.digit")), lambda m: m["digest"])
    step = F.struct(F.col("_one.digit").alias("digit"), others.alias("others"))
    return out.select(
        "tree",
        F.col("_one.block").alias("block"),
        "blocks",
        F.when(F.col("_up"), F.col("_digest")).otherwise(F.col("_one.digest")).alias("digest"),
        F.when(F.col("_up"), F.concat("_one.proof", F.array(step))).otherwise(F.col("_one.proof")).alias("proof"),
    )


def butterfly(blocks: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    """(tree, block, digest, proof) of ``blocks(tree, block, total, digest)``:
    the root of its tree and the steps from the block's root to it."""
    size = fanout**block_levels
    count = F.ceil(F.col("total") / size).cast("bigint")
    nodes = blocks.select("tree", "block", count.alias("blocks"), "digest", F.array().cast(f"array<{_STEP}>").alias("proof"))
    most = nodes.agg(F.max("blocks")).first()[0] or 0
    r, used = 0, []
    while fanout**r < most:
        nodes = stage(swap_round(nodes, r, fanout), "merkle-round")
        used.append(nodes)
        r += 1
    if used[:-1]:
        drop_staged(blocks.sparkSession, *used[:-1])
    return nodes.select("tree", "block", "digest", "proof")


def forest(rows: DataFrame, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """Trees over ``rows(tree, pos, total, leaf, changed, payload)`` -> (packed
    blocks, (tree, block, digest, proof)). A group of the packing has at most
    ``fanout ** block_levels`` rows."""
    blocked = rows.withColumn("block", F.expr(f"pos div {fanout**block_levels}"))
    blocks = stage(blocked.groupBy("tree", "block").applyInArrow(_pack_block(fanout, block_levels), _BLOCK), "merkle-blocks")
    return blocks, butterfly(blocks.select("tree", "block", "total", "digest"), fanout, block_levels)


def _fold(digest: str, steps: list[tuple[int, list[str]]]) -> str:
    for digit, others in steps:
        digest = _digest("".join([*others[:digit], digest, *others[digit:]]))
    return digest


def _local_steps(levels: list[list[str]], i: int, fanout: int) -> list[tuple[int, list[str]]]:
    steps = []
    for level in levels[:-1]:
        lo, digit = i - i % fanout, i % fanout
        run = level[lo : lo + fanout]
        steps.append((digit, run[:digit] + run[digit + 1 :]))
        i //= fanout
    return steps


def _proofs(fanout: int, block_levels: int):
    """From a block and what it holds of the levels above: one row per leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                raw, changed = r["leaves"].hex(), r["changed"].hex()
                leaves = [raw[i : i + 64] for i in range(0, len(raw), 64)]
                levels = subtree(leaves, fanout, steps_inside(r["total"], fanout, block_levels))
                above = [(s["digit"], s["others"]) for s in r["above"]]
                tail = "".join(x for _, others in above for x in others)
                proof, folded = [], []
                for i in range(len(leaves)):
                    steps = _local_steps(levels, i, fanout)
                    proof.append(_digest("".join(x for _, others in steps for x in others) + tail))
                    folded.append(_fold(_fold(changed[64 * i : 64 * i + 64], steps), above))
                kept = pa.ipc.open_stream(r["payload"]).read_all().column("payload").combine_chunks()
                n = len(leaves)
                cols = [kept, pa.array(leaves), pa.array([r["subroot"]] * n, pa.string()), pa.array([r["root"]] * n, pa.string()), pa.array(proof), pa.array(folded)]
                yield pa.RecordBatch.from_arrays(cols, ["payload", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    return run


def manifest(
    docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", tree_col: str = "lang", text_col: str = "text",
    tampered: Column | None = None, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per document: (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified).

    ``tampered`` marks rows whose leaf is recomputed with the text's A-Z in
    lower case before its proof is folded (default: 3 divides the CRC-32 of the
    id in decimals); a NULL text stays NULL, so such a row still verifies. NULL
    in any column is ``-`` in the leaf; a NULL id comes first in its tree and is
    not tampered with; the NULL language is the first tree. Rows that repeat an
    id are ordered by their leaves; equal rows are leaves of their own. Long
    texts are hashed by Spark where they lie. An empty table gives no rows.
    Columns other than the named ones are not read.
    """
    spark = docs.sparkSession
    key = F.col(id_col)
    if tampered is None:
        tampered = F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 0, F.lit(False))
    values = {c: F.col(c) for c in columns}
    lowered = values | {text_col: F.translate(F.col(text_col), UPPER, LOWER)}
    tree = F.coalesce(F.concat(F.lit("1"), F.col(tree_col)), F.lit("0"))  # NULL below every value, and never NULL
    leaves = docs.select(
        F.struct(key.alias("doc_id")).alias("payload"), tree.alias("tree"), leaf_digest(values).alias("leaf"), F.when(tampered, leaf_digest(lowered)).alias("changed")
    )
    leaves = stage(leaves, "merkle-leaves")
    placed = place_in_tree(leaves.withColumn("_id", F.col("payload.doc_id")), ["_id", "leaf"])
    blocks, above = forest(placed, fanout, block_levels)
    subroots = above.filter("block = 0").select(F.lit("").alias("tree"), F.col("digest").alias("leaf"), F.struct(F.col("tree").alias("of")).alias("payload"))
    subroots = stage(subroots.withColumn("changed", F.lit(None).cast("string")), "merkle-subroots")
    top_blocks, top_above = forest(place_in_tree(subroots.withColumn("_of", F.col("payload.of")), ["_of"]), fanout, block_levels)
    top = stage(_top_proofs(top_blocks, top_above, fanout, block_levels), "merkle-top")
    joined = (
        blocks.drop("digest")
        .join(above.withColumnRenamed("digest", "subroot"), ["tree", "block"])
        .join(top, "tree")
        .select("total", "payload", "leaves", "changed", "subroot", "root", F.concat("proof", "top").alias("above"))
    )
    schema = f"payload struct<doc_id:{docs.schema[id_col].dataType.simpleString()}>, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    rows = joined.mapInArrow(_proofs(fanout, block_levels), schema)
    return rows.select("payload.doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _top_proofs(blocks: DataFrame, above: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    """(tree, top, root): for every language the steps from its root to the root of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                raw = r["leaves"].hex()
                leaves = [raw[i : i + 64] for i in range(0, len(raw), 64)]
                levels = subtree(leaves, fanout, steps_inside(r["total"], fanout, block_levels))
                of = [p["of"] for p in pa.ipc.open_stream(r["payload"]).read_all().column("payload").to_pylist()]
                steps = [[{"digit": d, "others": o} for d, o in _local_steps(levels, i, fanout)] + r["proof"] for i in range(len(leaves))]
                kind = pa.list_(pa.struct([("digit", pa.int32()), ("others", pa.list_(pa.string()))]))
                yield pa.RecordBatch.from_arrays([pa.array(of, pa.string()), pa.array(steps, kind), pa.array([r["root"]] * len(of), pa.string())], ["tree", "top", "root"])

    joined = blocks.drop("digest").join(above.withColumnRenamed("digest", "root"), ["tree", "block"]).select("total", "payload", "leaves", "proof", "root")
    return joined.mapInArrow(run, f"tree string, top array<{_STEP}>, root string")


def manifest_sql(levels: int = 8, top_levels: int = 3, fanout: int = FANOUT) -> str:
    """The same rows in DuckDB SQL, for trees of at most ``fanout ** levels`` leaves."""

    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(text if c == "text" else c) for c in COLUMNS) + ")"

    def climb(name: str, first: str, n: int) -> list[str]:
        out = [f"{name}0 AS ({first})"]
        for k in range(n):
            out.append(
                f"{name}s{k} AS (SELECT a.g, a.pos, a.n, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, "
                f"coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r "
                f"FROM {name}{k} a JOIN {name}{k} b ON a.g = b.g AND a.pos // {fanout} = b.pos // {fanout} GROUP BY a.g, a.pos, a.n)"
            )
            out.append(
                f"{name}{k + 1} AS (SELECT g, pos // {fanout} AS pos, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h, "
                f"CASE WHEN n > 1 THEN (n + {fanout - 1}) // {fanout} ELSE 1 END AS n FROM {name}{k} GROUP BY g, pos // {fanout}, n)"
            )
        return out

    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    crc_table = "list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
    crc = "xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"
    parts = [
        f"crc AS MATERIALIZED (SELECT {crc_table} AS t)",
        f"d AS MATERIALIZED (SELECT doc_id, coalesce('1' || lang, '0') AS g, {leaf('text')} AS leaf, "
        f"CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} END AS changed FROM documents, crc)",
        "p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d)",
        *climb("l", "SELECT g, pos, leaf AS h, n FROM p", levels),
        *climb("t", f"SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, h, count(*) OVER () AS n FROM l{levels}", top_levels),
        f"f0 AS (SELECT p.*, l.h AS subroot, (SELECT h FROM t{top_levels}) AS root, (SELECT count(DISTINCT g) FROM l{levels} x WHERE x.g < p.g) AS tp, "
        f"'' AS proof, coalesce(changed, leaf) AS x FROM p JOIN l{levels} l USING (g))",
    ]
    at = 0
    for name, n, pos, g in (("l", levels, "f.pos", "f.g"), ("t", top_levels, "f.tp", "''")):
        for k in range(n):
            parts.append(
                f"f{at + 1} AS (SELECT f.* REPLACE (f.proof || s.l || s.r AS proof, CASE WHEN s.n > 1 THEN sha256(s.l || f.x || s.r) ELSE f.x END AS x) "
                f"FROM f{at} f JOIN {name}s{k} s ON s.g = {g} AND s.pos = {pos} // {fanout**k})"
            )
            at += 1
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, x AS folded_root, x = root AS verified FROM f{at}"
    )
