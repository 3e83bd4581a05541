"""SimHash near-dedup with a pigeonring filter.

A fingerprint's 64 bits are cut into five segments on a ring. If two
fingerprints differ in at most 4 bits, there is a segment from which every
chain of l consecutive segments has a cumulative difference within its
proportional budget floor(4 l / 5): 0, 1, 2, 3, 4. So from that segment on,

* the first segment is equal and the second differs in at most one bit: this
  pair of segments (26 or 25 bits) is the join key. Each fingerprint stands
  under its own five keys and probes the keys with one more bit set in the
  second segment, so a pair meets under one key per viable start;
* the rest of the chain is checked before the full Hamming distance.

Equal fingerprints are collapsed first. Pairs are not emitted: the members of
a key are linked to spanning links there (numpy over sorted Arrow batches).
Keys with more than ``BLOCK`` members are dealt out as pairs of blocks, each
its own group, so no task holds an unbounded group and no pair is left out.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slot_filter, slot_of, stage, text_or_empty, whole_row, with_slot_flag
from .components import components

WIDTHS = (13, 13, 13, 13, 12)
MAX_BITS = 4
SHINGLE_WORDS = 4
BLOCK = 4096
SMALL = 16  # keys with more members than this are reduced to spanning links

_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLACE = (np.arange(8) * 256).astype(np.int32)
_START = np.concatenate([[0], np.cumsum(WIDTHS)[:-1]])


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = 42) -> int:
    """SimHash of a UTF-8 text over its word shingles, repeats included (no words: 0)."""
    words = text.translate(_LOWER).split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n <= shingle_words:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (h(joined[a:b], seed) for a, b in zip(starts, ends[shingle_words - 1 :].tolist())), np.uint64, n - shingle_words + 1
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded scratch for very long texts
        part = hashes[at : at + (1 << 16)].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        counts = np.bincount((part.astype(np.int32) + _PLACE).ravel(), minlength=2048).reshape(8, 256)
        ones += (counts @ _BITS).ravel()
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp bigint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("t"))
    return d.mapInArrow(run, "doc_id bigint, fp bigint")


def _segment(fp: np.ndarray, i: int) -> np.ndarray:
    i %= 5
    return (fp >> np.uint64(_START[i])) & np.uint64((1 << WIDTHS[i]) - 1)


def _viable(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Chain check on ``x`` = a XOR b: from ``start`` on, each prefix of the
    ring stays within its budget; the whole ring is the Hamming distance."""
    per = np.stack([np.bitwise_count(_segment(x, i)) for i in range(5)], axis=-1).astype(np.int64)
    order = (np.asarray(start)[..., None] + np.arange(5)) % 5
    chain = np.cumsum(np.take_along_axis(per, np.broadcast_to(order, per.shape), axis=-1), axis=-1)
    return (chain <= (MAX_BITS * np.arange(1, 6)) // 5).all(axis=-1)


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own and probing keys of each fingerprint; a key is (start, segment pair)."""
    for b in batches:
        for at in range(0, b.num_rows, 20_000):
            part = b.slice(at, 20_000)
            node = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            fp = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            keys, nodes, fps, probes = [], [], [], []

            def put(key, mask, probe):
                keys.append(key[mask].astype(np.int64))
                nodes.append(node[mask])
                fps.append(fp[mask].view(np.int64))
                probes.append(np.full(int(mask.sum()), probe, bool))

            everything = np.ones(len(fp), bool)
            for i in range(5):
                first, second = _segment(fp, i), _segment(fp, i + 1)
                base = np.uint64(i << 26) | (first << np.uint64(13))
                put(base | second, everything, False)
                for bit in range(WIDTHS[(i + 1) % 5]):
                    flag = np.uint64(1 << bit)
                    put(base | second | flag, (second & flag) == 0, True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in (keys, nodes, fps, probes)], ["key", "node", "fp", "probe"]
            )


def _spanning(fp: np.ndarray, node: np.ndarray, probe: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of one key's members (at most a pair of blocks)."""
    label = np.arange(len(fp))
    while True:
        new = label.copy()
        for at in range(0, len(fp), 256):
            rows = slice(at, at + 256)
            ok = np.bitwise_count(fp[rows, None] ^ fp[None, :]) <= MAX_BITS
            ok &= ~(probe[rows, None] & probe[None, :])
            r, c = np.nonzero(ok)
            good = _viable(fp[rows][r] ^ fp[c], np.full(len(r), start))
            r, c = r[good] + at, c[good]
            np.minimum.at(new, r, label[c])
            np.minimum.at(new, c, label[r])
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(fp))
    return node[far], node[label[far]]


def _link_sorted(key, node, fp, probe):
    """Links among the members of every key of a sorted batch."""
    out_u, out_v = [], []
    cuts = np.flatnonzero(np.diff(key)) + 1
    starts = np.concatenate([[0], cuts])
    sizes = np.diff(np.concatenate([starts, [len(key)]]))
    size_of = np.repeat(sizes, sizes)
    at = np.flatnonzero(size_of <= SMALL)
    shift = 1
    while len(at):
        at = at[at + shift < len(key)]
        at = at[key[at] == key[at + shift]]
        if not len(at):
            break
        a, b = at, at + shift
        near = np.bitwise_count(fp[a] ^ fp[b]) <= MAX_BITS
        near &= ~(probe[a] & probe[b])
        a, b = a[near], b[near]
        ok = _viable(fp[a] ^ fp[b], key[a] >> 26)
        out_u.append(node[a[ok]])
        out_v.append(node[b[ok]])
        shift += 1
    for s in np.flatnonzero(sizes > SMALL):
        rows = slice(starts[s], starts[s] + sizes[s])
        if probe[rows].all():
            continue
        u, v = _spanning(fp[rows], node[rows], probe[rows], int(key[starts[s]] >> 26))
        out_u.append(u)
        out_v.append(v)
    if not out_u:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_u), np.concatenate(out_v)


_LINK_SCHEMA = "u bigint, v bigint, key bigint, fp bigint, probe boolean"


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of small keys; the members of keys over ``BLOCK`` are passed on as they are (u = node, v NULL)."""

    def links(u, v):
        n = len(u)
        e = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)], axis=1), axis=0)
        e = e[e[:, 0] != e[:, 1]]
        n = len(e)
        return pa.RecordBatch.from_arrays(
            [pa.array(e[:, 0]), pa.array(e[:, 1]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_())],
            ["u", "v", "key", "fp", "probe"],
        )

    def members(key, node, fp, probe):
        return pa.RecordBatch.from_arrays(
            [pa.array(node), pa.nulls(len(node), pa.int64()), pa.array(key), pa.array(fp.view(np.int64)), pa.array(probe)],
            ["u", "v", "key", "fp", "probe"],
        )

    held = None  # rows of the last key, which the next batch may continue
    hot = None  # a key whose members are being passed on
    for b in batches:
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        cols[2] = cols[2].view(np.uint64)
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            held = None
        key = cols[0]
        if not len(key):
            continue
        if hot is not None:
            n = int(np.searchsorted(key, hot, "right"))
            if n:
                yield members(*[c[:n] for c in cols])
            cols = [c[n:] for c in cols]
            if not len(cols[0]):
                continue
            hot, key = None, cols[0]
        last = int(np.searchsorted(key, key[-1], "left"))
        done, tail = [c[:last] for c in cols], [c[last:] for c in cols]
        if len(done[0]):
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(done[0])) + 1, [len(done[0])]])
            sizes = np.diff(cuts)
            big = np.repeat(sizes > BLOCK, sizes)
            if big.any():
                yield members(*[c[big] for c in done])
                done = [c[~big] for c in done]
            u, v = _link_sorted(*done)
            if len(u):
                yield links(u, v)
        if len(tail[0]) > BLOCK:
            yield members(*tail)
            hot = int(tail[0][0])
        else:
            held = tail
    if held is not None and len(held[0]):
        u, v = _link_sorted(*held)
        if len(u):
            yield links(u, v)


def links(distinct: DataFrame) -> DataFrame:
    """Links (u, v) that connect the nodes of ``distinct(node, fp)`` just as
    all pairs within 4 bits would."""
    keyed = distinct.select("node", "fp").mapInArrow(_key_rows, "key bigint, node bigint, fp bigint, probe boolean")
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = stage(
        keyed.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_link_batches, _LINK_SCHEMA), "simhash-links"
    )
    small = found.filter(F.col("v").isNotNull()).select("u", "v")
    hot = found.filter(F.col("v").isNull())
    blocks = hot.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n"))
    own = hot.join(blocks, "key").withColumn("b", F.pmod(F.xxhash64("u", "probe"), F.col("n")).cast("int"))
    dealt = own.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("o"))
    dealt = dealt.select("key", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"), "u", "fp", "probe")

    def block_pair(pdf):
        import pandas as pd

        fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        u, v = _spanning(fp, pdf["u"].to_numpy(np.int64), pdf["probe"].to_numpy(bool), int(pdf["key"].iloc[0] >> 26))
        return pd.DataFrame({"u": u, "v": v})

    return small.unionByName(dealt.groupBy("key", "lo", "hi").applyInPandas(block_pair, "u bigint, v bigint"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: (doc_id, fingerprint, component_id).

    ASCII letters are lower-cased; words are runs without ASCII white space;
    NULL and empty texts have fingerprint 0 and link like any other. Documents
    link at 4 or fewer differing bits; ``component_id`` is the smallest doc_id
    reachable. Rows without an id get a component only through equal or near
    fingerprints of rows that have one. Other columns are not read; an empty
    table gives no rows.
    """
    fps = stage(fingerprints(docs, id_col, text_col, shingle_words), "simhash")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("node"))
    nodes = stage(nodes.filter(F.col("node").isNotNull()), "simhash-nodes")
    # two fingerprints may share their smallest id when ids repeat: such a node joins both
    roots = components(links(nodes))
    named = nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    j = fps.join(named, "fp", "left")
    return j.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with
    the smallest id. Rows without an id stay; rows that repeat an id count as
    one document, which goes if any of them is near one of a smaller id. Only
    rows of groups larger than one are moved; all others pass straight through."""
    found = stage(near_groups(docs, id_col, text_col, shingle_words).select("doc_id", "component_id"), "simhash-groups")
    drop = found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    again = found.filter(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    touched = slot_filter(drop.unionByName(again.select("doc_id")).select(slot_of([F.col("doc_id")]).alias("slot")), at_least=1)
    packed = docs.select(whole_row(docs).alias("row"), F.col(id_col).cast("bigint").alias("id"))
    flagged = with_slot_flag(packed, slot_of([F.col("id")]), touched, "near").withColumn("near", F.col("near") & F.col("id").isNotNull())
    alone = flagged.filter(~F.col("near")).select("row")
    left = flagged.filter("near").select("row", "id").join(drop.select(F.col("doc_id").alias("id")), "id", "left_anti")
    return alone.unionByName(left.dropDuplicates(["id"]).select("row")).select("row.*")
