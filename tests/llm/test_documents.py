"""Document operators against brute force, on the smallest tables and on edge cases."""
import collections
import hashlib
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sifter.llm import exact_dedup, packing, sharding, simhash, suffix_index
from sifter.llm.common import table
from sifter.llm.components import components
from sifter.llm.queries import QUERIES

from .conftest import SF001


def texts_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module", params=["table", "edge", "none"])
def docs(request, spark, edge_docs, no_docs):
    return {"table": table(spark, SF001, "documents"), "edge": edge_docs, "none": no_docs}[request.param]


def least(i):
    return (i is not None, i)


def test_exact_dedup(docs):
    rows = texts_of(docs)
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    got = exact_dedup.dedup_report(docs).collect()
    assert len(got) == len(rows)
    want = collections.Counter()
    for t, ids in groups.items():
        keep = max(ids, key=least)
        for i in ids:
            want[(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest())] += 1
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = collections.Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) <= {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop_copies_carries_columns(docs):
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    rows = left.collect()
    best = {}
    for i, t in texts_of(docs):
        best[t] = max(best.get(t, i), i, key=least)
    assert sorted(((r["text"] or "", r["doc_id"]) for r in rows), key=repr) == sorted(best.items(), key=repr)
    assert {tuple(r) for r in rows} <= {tuple(r) for r in docs.collect()}


def reference_fingerprint(text):
    words = text.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    ones = np.zeros(64, int)
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        ones += np.array([(h >> b) & 1 for b in range(64)])
    return sum(1 << b for b in range(64) if shingles and 2 * ones[b] > len(shingles))


def roots(n, links):
    up = list(range(n))

    def find(a):
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_simhash_groups(docs):
    rows = sorted(texts_of(docs), key=lambda r: (r[0] is None, r[0] or 0))
    fps = [reference_fingerprint(t) for _, t in rows]
    ids = [i for i, _ in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 4]
    links += [(a, b) for a in range(len(rows)) for b in range(a) if ids[a] is not None and ids[a] == ids[b]]
    root = roots(len(rows), links)
    got = simhash.near_groups(docs).collect()
    want = [(i, "%016x" % f, ids[r]) for i, f, r in zip(ids, fps, root)]
    assert sorted(map(repr, [(r.doc_id, r.fingerprint, r.component_id) for r in got])) == sorted(map(repr, want))
    left = simhash.keep_one(docs)
    assert left.columns == docs.columns
    keep = {i for i, r in zip(ids, root) if i is not None and i == ids[r]}
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(keep)


@pytest.mark.parametrize("block,small", [(4096, 16), (8, 2)])
def test_simhash_links_of_dense_groups(spark, monkeypatch, block, small):
    """Clusters around a few centres, with keys over the block size: the same components as all pairs."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = np.random.default_rng(5)
    fps = {0, 1, 3}
    for _ in range(6):
        centre = int(rng.integers(0, 1 << 63))
        for _ in range(60):
            f = centre
            for b in rng.integers(0, 64, int(rng.integers(0, 6))):
                f ^= 1 << int(b)
            fps.add(f)
    fps = sorted(fps)
    rows = [(n, f - (1 << 64) if f >> 63 else f) for n, f in enumerate(fps)]
    # in one process: workers do not see the patched sizes
    def batches(step, got):
        return step(iter(got))

    import pyarrow as pa

    distinct = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["node", "fp"])
    keyed = pa.Table.from_batches(batches(simhash._key_rows, [distinct])).sort_by("key")
    links, hot = [], collections.defaultdict(list)
    for out in simhash._link_batches(iter(b for b in keyed.to_batches(max_chunksize=37))):
        for u, v, key, f, probe in zip(*[c.to_pylist() for c in out.columns]):
            if v is None:
                hot[key].append((u, f, probe))
            else:
                links.append((u, v))
    assert (block == 8) == bool(hot)
    for key, members in hot.items():
        u, f, p = (np.array(c) for c in zip(*members))
        half = len(u) // 2
        for part in ([*range(half)], [*range(half, len(u))], [*range(len(u))]):
            a, b = simhash._spanning(f[part].astype(np.int64).view(np.uint64), u[part], p[part].astype(bool), int(key >> 26))
            links += list(zip(a.tolist(), b.tolist()))
    want = [(a, b) for a in range(len(fps)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 4]
    assert roots(len(fps), links) == roots(len(fps), want)


def test_simhash_hot_keys_in_spark(spark):
    """One key held by more fingerprints than a block: all of them near one centre through bits outside the key."""
    rng = np.random.default_rng(1)
    fps = set()
    while len(fps) < simhash.BLOCK + 300:
        f = 0
        for b in rng.integers(26, 64, 4):
            f ^= 1 << int(b)
        fps.add(f - (1 << 64) if f >> 63 else f)
    far = [((0b1111111 << 30) | (1 << 3)) << 3]
    d = spark.createDataFrame([(n, f) for n, f in enumerate([*sorted(fps), *far])], "node bigint, fp bigint")
    got = {r.node: r.root for r in components(simhash.links(d)).collect()}
    assert len([n for n, r in got.items() if r == min(got.values())]) >= len(fps) - 1


def reference_repeats(rows):
    first = {}
    enc = [(i, t.encode()) for i, t in rows]
    for i, t in enc:
        for p in range(len(t) - 49):
            s = t[p : p + 50]
            if s not in first or least(i) < least(first[s]):
                first[s] = i
    out = []
    for i, t in enc:
        mark = np.zeros(len(t) + 51, int)
        for p in range(len(t) - 49):
            if least(first[t[p : p + 50]]) < least(i):
                mark[p] += 1
                mark[p + 50] -= 1
        gone = np.cumsum(mark)[: len(t)] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats(docs):
    got = [tuple(r) for r in suffix_index.repeat_report(docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, reference_repeats(texts_of(docs))))


def test_repeats_of_every_kind(spark):
    rng = np.random.default_rng(3)
    word = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    passage, tail = word(200), word(80)
    texts = [
        word(300) + passage + word(40),
        word(20) + passage[3:120] + word(30) + passage[60:] + tail,
        passage[:49],
        passage[:50],
        passage[10:60] + "x" + passage[61:],
        tail + tail,
        "a" * 500,
        "b" + "a" * 120,
        word(10) + tail[5:70],
        passage + passage,
        "",
        "ü" * 40,
        "x" + "ü" * 30,
    ]
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [tuple(r) for r in suffix_index.repeat_report(d).collect()]
    assert sorted(got) == sorted(reference_repeats(rows))


def test_strings_of_a_seed_are_compared_where_its_runs_meet(spark, monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(9)
    word = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8))
    cores = [word(26) for _ in range(6)]
    sides = [(word(24), word(24)) for _ in range(4)]
    rows = []
    for i in range(120):
        seed, (l, r) = int(rng.integers(0, 6)), sides[int(rng.integers(0, 4))]
        a, z = int(rng.integers(12, 25)), int(rng.integers(12, 25))
        rows.append((int(rng.integers(0, 40)), i, 7 * i, seed - 3, (l[-a:] + cores[seed] + r[:z])))
    rows.sort(key=lambda x: x[3])
    strings = [(t[k : k + 50], did, th, lo + k) for did, th, lo, _, t in rows for k in range(len(t) - 49)]
    least = {}
    for s, did, *_ in strings:
        least[s] = min(did, least.get(s, did))
    want = {(th, lo + n) for s, did, th, lo in strings if did > least[s] for n in range(50)}
    b = pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == 4 else pa.int64()) for n, c in enumerate(zip(*rows))], ["did", "th", "lo", "seed", "t"])
    for step in (1, 7, 50, 120):
        parts = [b.slice(at, step) for at in range(0, 120, step)]
        got = [r for out in suffix_index._later_by_seed([b.slice(0, 0), *parts]) for r in out.to_pylist()]
        assert {(r["th"], n) for r in got for n in range(r["lo"], r["hi"])} == want
        assert 0 < len(got) <= len(rows)  # a range a run, not a row a string
    passage = "".join(chr(97 + int(c)) for c in rng.integers(0, 26, 130))
    docs = [(i, passage[i % 7 : 60 + 9 * (i % 5)] + str(i) * 20 + passage[i % 3 * 20 :]) for i in range(30)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    for runs in (1 << 13, 12, 0):
        monkeypatch.setattr(suffix_index, "SEED_RUNS", runs)
        assert sorted(map(tuple, suffix_index.repeat_report(d).collect())) == sorted(reference_repeats(docs))


def test_logarithmic_family_finds_what_sets_find():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 7, 16):
        arrays = [np.sort(rng.integers(0, 300, int(rng.integers(0, 60)))).astype(np.uint64) for _ in range(n)]
        count = collections.Counter(np.concatenate(arrays).tolist()) if arrays else {}
        assert suffix_index.matched(arrays).tolist() == sorted(k for k, c in count.items() if c > 1)


def test_cut_lays_out_the_ranges_of_a_batch():
    import time

    import pyarrow as pa

    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))

    def cut(texts, ranges):
        ranges = pa.array([[{"lo": a, "hi": z} for a, z in r] for r in ranges], kind)
        n = pa.array(range(len(texts)), pa.int64())
        b = pa.RecordBatch.from_arrays([n, n, pa.array(texts, pa.binary()), ranges], ["did", "th", "t", "ranges"])
        start = time.process_time()
        rows = [tuple(r.values())[2:] for out in suffix_index._cut([b, b.slice(0, 0), b.slice(1)]) for r in out.to_pylist()]
        return rows, time.process_time() - start

    # a whole text, one up to its end, one from its start, overlapping and touching ranges out of order
    got, _ = cut([b"abcd", b"efgh", b"ijkl", b"mnopqr"], [[(0, 4)], [(2, 4)], [(0, 1), (2, 3)], [(3, 4), (1, 3), (1, 2), (5, 6)]])
    want = [(4, 1, b""), (2, 1, b"ef"), (2, 2, b"jl"), (4, 2, b"mq")]
    assert got == want + want[1:]
    # a range a byte, as many single strings leave it
    rows, seconds = cut([b"x" * 1000] * 500, [[(i, i + 50) for i in range(0, 950)]] * 500)
    assert set(rows) == {(999, 1, b"x")} and seconds < 1


def test_anchors_do_not_depend_on_chunks(monkeypatch):
    text = bytes(np.random.default_rng(2).integers(97, 101, 5000).astype(np.uint8))
    whole = [(s.tolist(), a.tolist()) for s, a, _ in suffix_index.windows_of([text])][0]
    monkeypatch.setattr(suffix_index, "CHUNK", 700)
    start, anchor = [], []
    for s, a, _ in suffix_index.windows_of([b"short", text, b"z" * 49]):
        start += (s - 5).tolist()
        anchor += (a - 5).tolist()
    assert (start, anchor) == whole


def check_packing(rows, got, window=1024):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_paths()[0])
    pieces, seqs = collections.Counter(), collections.defaultdict(list)
    for r in got:
        pieces[(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)] += 1
        seqs[r.sequence_id].append((r.offset, r.length))
    for at in seqs.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= window
    want = collections.Counter()
    for i, t in rows:
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), window):
            want[(i, at, len(ids[at : at + window]), zlib.crc32(ids[at : at + window].tobytes()), len(ids))] += 1
    assert pieces == want
    return sum(r.length for r in got), len(seqs)


def test_packing(docs):
    tokens, seqs = check_packing(texts_of(docs), packing.pack(docs).collect())
    if tokens > 100_000:
        assert 1 - tokens / 1024 / seqs < 0.02


def test_packed_ids_round_trip(spark):
    d = table(spark, SF001, "documents").filter("doc_id < 30")
    whole = {r.doc_id: [] for r in d.collect()}
    placed = packing.cut_pieces(d, keep_ids=True).collect()
    for r in sorted(placed, key=lambda r: (r.doc_id, r.start)):
        whole[r.doc_id] += r.ids
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_paths()[0])
    for r in d.collect():
        assert whole[r.doc_id][-1] == 0 and tok.decode(whole[r.doc_id][:-1]) == r.text
    seqs = packing.sequences(d).collect()
    assert all(len(r.ids) == 1024 and r.n_tokens <= 1024 for r in seqs)
    assert sum(r.n_tokens for r in seqs) == sum(map(len, whole.values()))


@pytest.mark.parametrize("kind", ["uniform", "short", "one length", "few", "none"])
def test_packing_plan(kind):
    rng = np.random.default_rng(4)
    lengths = {
        "uniform": rng.integers(1, 1025, 30_000), "short": np.clip(rng.geometric(1 / 40, 30_000), 1, 1024),
        "one length": np.full(9_999, 600), "few": np.array([1, 1024, 700, 324, 5]), "none": np.empty(0, int),
    }[kind]
    h = np.bincount(lengths, minlength=1025)
    plan = packing.make_plan(h)
    used = collections.defaultdict(list)
    for length in np.flatnonzero(h):
        for rank in range(h[length]):
            at = np.searchsorted(plan.key, (int(length) << 40) | rank, "right") - 1
            j = rank - (plan.key[at] & ((1 << 40) - 1))
            used[int(plan.base[at] + j // plan.times[at])].append((int(plan.offset[at] + length * (j % plan.times[at])), int(length)))
    assert len(used) == plan.sequences
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    if kind in ("uniform", "short"):
        assert plan.sequences * 1024 < 1.02 * lengths.sum()


def reference_shard(doc_id, tree, seed=42):
    """Descend the tree: at each level the child that arrives first, its rate the weights below it."""
    import struct

    def weight(node):
        return sum(map(weight, node.values())) if isinstance(node, dict) else max(node, 0)

    def arrival(name, w):
        h = 42
        for v in (struct.pack("<q", seed), None if doc_id is None else struct.pack("<q", doc_id), name.encode()):
            if v is not None:
                h = xxhash.xxh64_intdigest(v, h)
        return -np.log(((h >> 11) + 0.5) / float(1 << 53)) / w

    node, path = tree, ""
    while isinstance(node, dict):
        child = min((arrival(f"{path}{c}", weight(x)), c) for c, x in node.items() if weight(x) > 0)[1]
        node, path = node[child], f"{path}{child}/"
    return child


def test_sharding(docs):
    rows = texts_of(docs)
    old = sharding.default_tree(16)
    new = sharding.grow(old, 16)
    got = sharding.shard_documents(docs).collect()
    where = {i: reference_shard(i, old) for i, _ in rows}
    grown = {i: reference_shard(i, new) for i, _ in rows}
    want = [(i, len(t.encode()) + 1, zlib.crc32(t.encode()), where[i], grown[i]) for i, t in rows]
    assert sorted(map(repr, [(r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got])) == sorted(map(repr, want))
    assert all(r.grown_shard in (r.shard, 16) for r in got)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def placements(spark, *trees, n=40_000):
    key = F.col("doc_id")
    d = spark.range(n).select(F.col("id").alias("doc_id"))
    cols = [sharding.placement(key, t)[c].alias(f"{c}{i}") for i, t in enumerate(trees) for c in ("region", "rack", "shard")]
    return d.select(key, *cols).collect()


def test_weight_changes_stay_in_their_subtree(spark):
    tree = {"a": {"r0": {0: 1.0, 1: 2.0}, "r1": {2: 1.0}}, "b": {"r2": {3: 3.0, 4: 1.0}, "r3": {5: 0.0}}}
    balanced = {**tree, "b": {"r2": {3: 1.5, 4: 2.5}, "r3": {5: 0.0}}}  # the rack's sum stays
    inside = {**tree, "a": {"r0": {0: 1.0, 1: 1.0}, "r1": {2: 2.0}}}  # the region's sum stays
    rows = placements(spark, tree, balanced, inside, sharding.grow(tree, 9, 4.0))
    share = collections.Counter(r.shard0 for r in rows)
    for s, w in ((0, 1), (1, 2), (2, 1), (3, 3), (4, 1), (5, 0)):
        assert abs(share[s] / len(rows) - w / 8) < 0.01
    moved = [r for r in rows if r.shard0 != r.shard1]
    assert moved and all((r.rack0, r.shard0, r.shard1) == ("r2", 3, 4) and r.rack1 == "r2" for r in moved)
    moved = [r for r in rows if r.shard0 != r.shard2]
    assert moved and all(r.region0 == r.region2 == "a" for r in moved)
    assert all(r.rack0 == r.rack2 or (r.rack0, r.rack2) == ("r0", "r1") for r in moved)
    moved = [r for r in rows if r.shard0 != r.shard3]
    assert all(r.shard3 == 9 for r in moved) and abs(len(moved) / len(rows) - 1 / 3) < 0.01


def test_the_tree_decides_and_not_its_leaves_alone(spark):
    flat = {"all": {"one": {s: 1.0 for s in range(8)}}}
    rows = placements(spark, flat, sharding.default_tree(8), n=4000)
    assert sum(r.shard0 != r.shard1 for r in rows) > 2000
    want = [(reference_shard(r.doc_id, flat), reference_shard(r.doc_id, sharding.default_tree(8))) for r in rows]
    assert [(r.shard0, r.shard1) for r in rows] == want


def test_components(spark):
    rng = np.random.default_rng(7)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    want = roots(6000, edges)
    assert got == {n: want[n] for e in edges for n in e if e[0] != e[1]}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_queries_read_whole_tables(spark):
    n = table(spark, SF001, "documents").count()
    for name in ("op2_exact_dedup", "op5_toxicity_ftrl", "op6_simhash_near_dedup", "op7_suffix_index_dedup", "op9_hash_tree_sharding"):
        assert QUERIES[name](spark, SF001).count() == n, name
