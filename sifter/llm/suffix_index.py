"""Repeated passages by a logarithmic family of suffix arrays.

Looked for are byte strings of ``LONG`` bytes that also start in a document
with a smaller id. Arrays over all suffixes would shuffle many times the
input, so they hold sampled ones: in every string of ``LONG`` bytes the start
of its least ``SEED``-byte substring (by hash), an *anchor*. Equal strings have
the same anchor at the same place, so a repeat can't hide between samples.

1. Each batch of distinct texts gets suffix arrays of its anchors, ordered by
   the hash of the suffix's first ``SEED`` bytes and cut into shards by it.
2. In a shard, arrays enter a logarithmic family one batch at a time: the new
   array is scanned against every level for equal entries and then becomes a
   level, where levels of equal size are merged, again and again. What is
   found is the set of anchors with a match elsewhere.
3. Around each such anchor lies the group of strings that it stands for, one
   short run of text. A run that also occurs, whole, in a smaller document is
   removed. Where runs with the same anchor differ, their single strings are
   compared, once for each distinct run, in the task that has the anchor's runs
   (of an anchor with over ``SEED_RUNS``, in tasks by string).
4. The covered ranges go back to their document, which is cut.

All matching after step 2 is by 128-bit hashes of whole strings.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, slot_filter, slot_of, stage, text_or_empty, with_slot_flag
from .exact_dedup import drop_copies
from .features import _mix, _powers

LONG = 50
SEED = 26
CHUNK = 1 << 18  # bytes hashed at once
BATCH_BYTES = 4 << 20  # text of one batch
SHARD_BYTES = 4 << 20  # text whose anchors one shard holds, about
SEED_RUNS = 1 << 13  # runs of a seed that one task compares; those of a seed with more go to tasks string by string
_P = np.uint64(0xD1342543DE82EF95)
_POW = _powers(_P, CHUNK + LONG + 1)
_INV = _powers(np.uint64(pow(int(_P), -1, 1 << 64)), CHUNK + LONG + 1)
_AT = np.uint64((1 << 21) - 1)
NO_ID = -(2**63)  # stands for a NULL id, so it is below every other


def window_anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each start of a ``LONG``-byte window of ``data`` (at most ``CHUNK``
    + ``LONG`` bytes): its anchor's place; and the hashes of all seeds."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POW[: len(data)], out=sums[1:])
    n = len(data) - SEED + 1
    h = _mix((sums[SEED:] - sums[:n]) * _INV[:n])
    least = (h & ~_AT) | np.arange(n, dtype=np.uint64)
    width, have = LONG - SEED + 1, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return (least & _AT).astype(np.int64), h


def windows_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Yield (start of window, its anchor, hash of the anchor's seed), places
    counted over the texts laid end to end; windows lie inside one text. Short
    texts are handled together, long ones in chunks that overlap."""
    at = 0  # place of the first byte held
    held: list[bytes] = []
    size = 0

    def flush():
        data = np.frombuffer(b"".join(held), np.uint8)
        if len(data) >= LONG:
            anchor, h = window_anchors(data)
            ends = np.cumsum([len(t) for t in held])
            start = np.arange(len(anchor))
            inside = start + LONG <= ends[np.searchsorted(ends, start, "right")]
            start, anchor = start[inside], anchor[inside]
            yield start + at, anchor + at, h[anchor]

    for t in texts:
        if size and size + len(t) > CHUNK:
            yield from flush()
            at, held, size = at + size, [], 0
        if len(t) <= CHUNK:
            held.append(t)
            size += len(t)
            continue
        for cut in range(0, len(t) - LONG + 1, CHUNK):
            anchor, h = window_anchors(np.frombuffer(t, np.uint8)[cut : cut + CHUNK + LONG - 1])
            yield np.arange(len(anchor)) + at + cut, anchor + at + cut, h[anchor]
        at += len(t)
    yield from flush()


def _pack(a: np.ndarray) -> bytes:
    """Bytes of an array, place by place, so that small numbers compress."""
    return a.view(np.uint8).reshape(len(a), -1).T.tobytes()


def _unpack(raw: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def suffix_arrays(texts: DataFrame, shards: int) -> DataFrame:
    """Arrays of every batch of ``texts(did, th, t)``: rows (shard, batch, keys, places);
    the row with shard -1 has the batch's documents (ids, text hashes, first bytes)."""
    bits = shards.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        did: list[int] = []
        th: list[int] = []
        texts: list[bytes] = []
        size = 0

        def arrays():
            firsts = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]]).astype(np.int64)
            name = xxhash.xxh3_64_intdigest(b"%d %d %d" % (did[0], th[0], len(did))) >> 1
            keys, places = [], []
            for _, anchor, h in windows_of(texts):
                new = np.concatenate([[True], anchor[1:] != anchor[:-1]]) if len(anchor) else np.empty(0, bool)
                keys.append(h[new])
                places.append(anchor[new])
            key, place = (np.concatenate(x) for x in (keys, places)) if keys else (np.empty(0, np.uint64), np.empty(0, np.int64))
            order = np.argsort(key, kind="stable")
            key, place = key[order], place[order].astype("<u4")
            cuts = np.searchsorted(key, np.arange(1, shards, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
            rows = [(-1, name, np.array(did, np.int64).tobytes() + np.array(th, np.int64).tobytes(), firsts.tobytes())]
            for s, (k, p) in enumerate(zip(np.split(key, cuts), np.split(place, cuts))):
                if len(k):
                    rows.append((s, name, _pack(np.diff(k, prepend=np.uint64(0))), _pack(p)))
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())],
                ["shard", "batch", "keys", "places"],
            )

        for b in batches:
            for d, x, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                t = t.as_py()
                if len(t) < LONG:
                    continue
                if size and size + len(t) > BATCH_BYTES:
                    yield arrays()
                    did, th, texts, size = [], [], [], 0
                did.append(d)
                th.append(x)
                texts.append(t)
                size += len(t)
        if texts:
            yield arrays()

    return texts.mapInArrow(run, "shard int, batch bigint, keys binary, places binary")


def _merge(a: tuple, b: tuple) -> tuple:
    """One level of two: distinct keys, with whether they were ever matched."""
    key, hit = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    order = np.argsort(key, kind="stable")
    key, hit = key[order], hit[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.logical_or.reduceat(hit, first)


def matched(arrays: list[np.ndarray]) -> np.ndarray:
    """Sorted keys that occur twice or more among the batches' sorted arrays,
    found as the arrays enter a logarithmic family of levels."""
    levels: list[tuple[int, np.ndarray, np.ndarray]] = []  # (batches held, keys, hit)
    for key in arrays:
        if not len(key):
            continue
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        hit = np.diff(np.append(first, len(key))) > 1
        key = key[first]
        for _, old, old_hit in levels:
            at = np.searchsorted(old, key)
            same = np.zeros(len(key), bool)
            ok = at < len(old)
            same[ok] = old[at[ok]] == key[ok]
            hit |= same
            old_hit[at[same]] = True
        new = (1, key, hit)
        while levels and levels[-1][0] == new[0]:
            n, *old = levels.pop()
            new = (2 * n, *_merge(tuple(old), new[1:]))
        levels.append(new)
    found = [k[h] for _, k, h in levels]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


def _matches_of_shard(shard: pa.Table) -> pa.Table:
    """Of one shard's arrays: each batch's places whose key occurs elsewhere."""
    shard = shard.sort_by("batch")
    arrays = [np.cumsum(_unpack(k.as_buffer(), "<u8"), dtype=np.uint64) for k in shard["keys"]]
    shared = matched(arrays)
    batches, found = [], []
    for batch, key, places in zip(shard["batch"].to_pylist(), arrays, shard["places"]):
        at = np.minimum(np.searchsorted(shared, key), max(0, len(shared) - 1))
        hit = shared[at] == key if len(shared) else np.zeros(len(key), bool)
        if hit.any():
            batches.append(batch)
            found.append(_pack(np.sort(_unpack(places.as_buffer(), "<u4")[hit])))
    return pa.table([pa.array(batches, pa.int64()), pa.array(found, pa.binary())], names=["batch", "places"])


def _by_document(meta: pa.Table, found: pa.Table) -> pa.Table:
    """A batch's matched places, dealt to its documents as places inside them."""
    did, th = np.frombuffer(meta["keys"][0].as_buffer(), np.int64).reshape(2, -1)
    firsts = np.frombuffer(meta["places"][0].as_buffer(), np.int64)
    place = [_unpack(p.as_buffer(), "<u4").astype(np.int64) for p in found["places"]]
    place = np.sort(np.concatenate([np.empty(0, np.int64), *place]))
    parts = np.split(place, np.searchsorted(place, firsts[1:]))
    have = [i for i, p in enumerate(parts) if len(p)]
    inside = [(parts[i] - firsts[i]).astype("<u4").tobytes() for i in have]
    return pa.table([pa.array(did[have]), pa.array(th[have]), pa.array(inside, pa.binary())], names=["did", "th", "places"])


def with_text(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows(did, th, ...)`` with their text; only texts whose key may be among them are moved."""
    keys = [F.col("did"), F.col("th")]
    wanted = slot_filter(rows.select(slot_of(keys).alias("slot")), at_least=1)
    near = with_slot_flag(texts, slot_of(keys), wanted, "_near").filter("_near").drop("_near")
    return near.join(rows, ["did", "th"])


_RUN_SCHEMA = "did bigint, th bigint, lo bigint, n int, seed bigint, r1 bigint, r2 bigint, t binary"


def _digests(parts: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """128-bit hashes, as two columns of whole numbers."""
    h = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), "<i8").reshape(-1, 2)
    return pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1]))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (did, th, t, places): the run of text around each matched anchor, with its hash."""
    for b in batches:
        texts = b.column(2).to_pylist()
        firsts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        want = np.concatenate(
            [np.frombuffer(p.as_py(), "<u4").astype(np.int64) + at for p, at in zip(b.column(3), firsts)] or [np.empty(0, np.int64)]
        )
        for start, anchor, h in windows_of(texts):
            new = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
            first = np.flatnonzero(np.concatenate([[True], new])) if len(anchor) else np.empty(0, np.int64)
            last = np.append(first[1:], len(anchor)) - 1
            at = np.searchsorted(want, anchor[first])
            hit = want[np.minimum(at, len(want) - 1)] == anchor[first] if len(want) else np.zeros(len(first), bool)
            first, last = first[hit], last[hit]
            doc = np.searchsorted(firsts, start[first], "right") - 1
            lo, hi = start[first] - firsts[doc], start[last] + LONG - firsts[doc]
            cut = [texts[d][a:z] for d, a, z in zip(doc.tolist(), lo.tolist(), hi.tolist())]
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(take), b.column(1).take(take), pa.array(lo), pa.array((hi - lo).astype(np.int32)),
                    pa.array(h[first].view(np.int64)), *_digests(cut), pa.array(cut, pa.binary()),
                ],
                ["did", "th", "lo", "n", "seed", "r1", "r2", "t"],
            )


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (did, th, lo, t): the single ``LONG``-byte strings of a run."""
    for b in batches:
        texts = b.column(3).to_pylist()
        n = np.array([len(t) - LONG + 1 for t in texts], np.int64)
        row = np.repeat(np.arange(len(n)), n)
        lo = b.column(2).to_numpy()[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        names = _digests([t[k : k + LONG] for t, m in zip(texts, n.tolist()) for k in range(m)])
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(lo), *names], ["did", "th", "lo", "s1", "s2"])


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (s1, s2, did): those whose string a smaller did has. Only a batch and the last string's least did are held."""
    name, least = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        did, s1, s2 = (b.column(i).to_numpy() for i in (0, 3, 4))
        new = np.concatenate([[(s1[0], s2[0]) != name], (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])])
        start = np.maximum.accumulate(np.where(new, np.arange(len(did)), -1))
        first = np.where(start >= 0, did[start], least)
        name, least = (s1[-1], s2[-1]), first[-1]
        at = pa.array(np.flatnonzero(did > first))
        lo = b.column(2).take(at)
        hi = pa.array(lo.to_numpy() + LONG)
        yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), lo, hi], ["did", "th", "lo", "hi"])


def _later_in(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Of runs (did, th, lo, seed, t), all of their seeds: the ranges of strings that a smaller did has."""
    texts = rows.column(4).to_pylist()
    n = np.array([len(t) - LONG + 1 for t in texts], np.int64)
    row = np.repeat(np.arange(len(n)), n)
    lo = rows.column(2).to_numpy()[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    did = rows.column(0).to_numpy()[row]
    h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(t[k : k + LONG]) for t, m in zip(texts, n.tolist()) for k in range(m)), "<i8").reshape(-1, 2)
    one, two = np.ascontiguousarray(h[:, 0]), np.ascontiguousarray(h[:, 1])
    order = np.argsort(one)
    new = one[order[1:]] != one[order[:-1]]
    if (~new & (two[order[1:]] != two[order[:-1]])).any():  # the first half alone does not tell these strings apart
        order = np.lexsort((two, one))
        new = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
    new = np.concatenate([[True], new])
    least = np.minimum.reduceat(did[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    at = np.sort(order[did[order] > least])
    # neighbours of one run are one range
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])]) if len(at) else np.empty(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    take = pa.array(row[at[first]])
    return pa.RecordBatch.from_arrays(
        [rows.column(0).take(take), rows.column(1).take(take), pa.array(lo[at[first]]), pa.array(lo[at[last]] + LONG)], ["did", "th", "lo", "hi"]
    )


def _later_by_seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """:func:`_later_in` over rows sorted by seed. A batch and the rows of its last seed are held."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        seed = b.column(3).to_numpy()
        if held and held[0].column(3)[0].as_py() != seed[0]:
            yield _later_in(pa.concat_batches(held))
            held = []
        cut = int(np.searchsorted(seed, seed[-1]))  # the last seed may go on in the next batch
        if cut:
            yield _later_in(pa.concat_batches([*held, b.slice(0, cut)]))
            held = []
        held.append(b.slice(cut))
    if held:
        yield _later_in(pa.concat_batches(held))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (did, th, t, ranges): what is left of each text."""
    for b in batches:
        if not b.num_rows:
            continue
        texts, ranges = b.column(2).to_pylist(), b.column(3)
        # places in all texts of the batch, one apart, so that no range touches one of the next text
        base = np.cumsum([0] + [len(t) + 1 for t in texts])
        n = np.diff(ranges.offsets.to_numpy())
        lo, hi = (x.to_numpy() + np.repeat(base[:-1], n) for x in ranges.flatten().flatten())
        order = np.argsort(lo, kind="stable")
        lo, reach = lo[order], np.maximum.accumulate(hi[order])
        new = np.flatnonzero(np.concatenate([[True], lo[1:] > reach[:-1]]))
        lo, hi = lo[new], reach[np.append(new[1:], len(lo)) - 1]
        first = np.searchsorted(lo, base)
        size = np.concatenate([[0], np.cumsum(hi - lo)])
        removed, spans, kept = np.diff(size[first]), np.diff(first), []
        lo, hi = (lo - base[:-1].repeat(spans)).tolist(), (hi - base[:-1].repeat(spans)).tolist()
        for t, i, j in zip(texts, first[:-1].tolist(), first[1:].tolist()):
            kept.append(b"".join([t[a:z] for a, z in zip([0, *hi[i:j]], [*lo[i:j], len(t)])]))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            ["did", "th", "n_removed", "n_spans", "kept"],
        )


def repeated_ranges(texts: DataFrame, total_bytes: int) -> tuple[DataFrame, list[DataFrame]]:
    """(did, th, lo, hi) byte ranges of ``texts(did, th, t)``, distinct texts,
    that repeat strings of smaller ids; and the staged tables they are read from."""
    shards = 1 << max(0, (total_bytes // SHARD_BYTES).bit_length())
    arrays = stage(suffix_arrays(texts, shards), "suffix-arrays")
    found = arrays.filter("shard >= 0").groupBy("shard").applyInArrow(_matches_of_shard, "batch bigint, places binary")
    meta = arrays.filter("shard < 0").select("batch", "keys", "places")
    docs = meta.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(_by_document, "did bigint, th bigint, places binary")
    docs = stage(docs, "suffix-matches")
    drop_staged(texts.sparkSession, arrays)
    runs = with_text(texts, docs).select("did", "th", "t", "places").mapInArrow(_runs, _RUN_SCHEMA)
    runs = stage(runs, "suffix-runs")
    # what a join looks up is staged: its other side is then read straight from the shuffle, where AQE can split a hot key
    owner = runs.groupBy("r1", "r2").agg(F.min("did").alias("owner"), F.count(F.lit(1)).alias("held")).filter("held > 1")
    owner = stage(owner.select("r1", "r2", "owner"), "suffix-owners")
    whole = runs.select("did", "th", "lo", "n", "r1", "r2").join(owner, ["r1", "r2"]).filter("did > owner")
    whole = stage(whole.select("did", "th", "lo", (F.col("lo") + F.col("n")).alias("hi")), "suffix-whole")
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("r1", "r2") for f in (F.min, F.max)]
    several = runs.groupBy("seed").agg(*ends, F.count(F.lit(1)).alias("held")).filter("min_r1 < max_r1 OR min_r2 < max_r2")
    several = several.select("seed", (F.col("held") > SEED_RUNS).alias("many"))
    several = stage(several, "suffix-seeds")
    # a bitmap first, so that only runs that may have such a seed are moved with their text
    seed = [F.col("seed")]
    first = with_slot_flag(runs, slot_of(seed), slot_filter(several.select(slot_of(seed).alias("slot")), at_least=1), "_near").filter("_near")
    first = first.join(several, "seed").join(owner, ["r1", "r2"], "left").filter("owner IS NULL OR did = owner")
    first = stage(first.select("did", "th", "lo", "seed", "t", "many"), "suffix-first")
    drop_staged(texts.sparkSession, docs, runs, owner, several)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = "did bigint, th bigint, lo bigint, hi bigint"
    # equal strings have one seed, so its runs are compared where they meet; strings of a seed with many runs meet by their hash
    few = first.filter("NOT many").select("did", "th", "lo", "seed", "t").repartition(parts, "seed").sortWithinPartitions("seed")
    strings = first.filter("many").select("did", "th", "lo", "t").mapInArrow(_strings, "did bigint, th bigint, lo bigint, s1 bigint, s2 bigint")
    strings = strings.repartition(parts, "s1").sortWithinPartitions("s1", "s2", "did").mapInArrow(_later, found)
    single = stage(few.mapInArrow(_later_by_seed, found).unionByName(strings), "suffix-single")
    return whole.unionByName(single), [whole, first, single]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(rows, cut)``: one row per document (doc_id, did, th, n_bytes, whole,
    text_sha256) and the texts that lose a part but not all of it (did, th,
    n_removed, n_spans, kept).

    Every whole text is taken as UTF-8 bytes (NULL: empty). A byte goes if a
    ``LONG``-byte string over it also starts in a document with a smaller id,
    judged on the input; a NULL id is below every other, rows that share an id
    do not count against each other. ``whole`` marks copies of a text that a
    smaller id holds: they lose everything, or nothing if shorter than ``LONG``.
    """
    did = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))
    t = text_or_empty(text_col)
    keyed = docs.select(F.col(id_col).alias("doc_id"), did.alias("did"), F.xxhash64(t).alias("th"), t.alias("text"))
    narrow = stage(
        keyed.select("doc_id", "did", "th", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256")), "suffix-docs"
    )
    total = narrow.agg(F.sum("n_bytes")).first()[0] or 0
    distinct = drop_copies(keyed, "did", "text", keep=F.min).select("did", "th", F.col("text").cast("binary").alias("t"))
    every = keyed.select("did", "th", F.col("text").cast("binary").alias("t"))
    ranges, used = repeated_ranges(distinct, int(total))
    per_doc = stage(ranges.groupBy("did", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "suffix-ranges")
    drop_staged(docs.sparkSession, *used)
    cut = with_text(every, per_doc).select("did", "th", "t", "ranges").dropDuplicates(["did", "th"])
    cut = cut.mapInArrow(_cut, "did bigint, th bigint, n_removed bigint, n_spans bigint, kept binary")
    first = narrow.groupBy("text_sha256").agg(F.min("did").alias("first"), F.max("did").alias("last")).filter("first < last")
    rows = narrow.join(first.select("text_sha256", "first"), "text_sha256", "left")
    return rows.withColumn("whole", F.coalesce(F.col("did") > F.col("first"), F.lit(False))).drop("first"), cut


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    rows, cut = remove_repeats(docs, id_col, text_col)
    digest = cut.select("did", "th", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    j = rows.join(digest, ["did", "th"], "left")
    gone = F.col("whole") & (F.col("n_bytes") >= LONG)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return j.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(gone, nothing).otherwise(F.coalesce("kept_sha256", "text_sha256")).alias("kept_sha256"),
    )
