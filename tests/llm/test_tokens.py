"""Manifest, token files and token alignment against brute force."""
import collections
import hashlib
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sifter.llm import merkle, token_align, token_files
from sifter.llm.common import table

from .conftest import SF001

ODD = [
    (1, "<|endoftext|> and <|startoftext|> in a text, <s> too</s><unk><0x41>"),
    (2, "It's 42% OFF!!  two  spaces\tand\ttabs\n\n\nnew lines 'll 're'd"),
    (3, "Grüße, naïve café — ΣΊΣΥΦΟΣ İstanbul ﬁn é     　x"),
    (4, "中文字符，日本語テキスト 한국어 🙂🙃👩‍👩‍👧 ́"),
    (5, "a\x00b\x1c\x1d\x1e\x1f c \x85 d ​ e ﻿"),
    (6, "▁ is the mark of a space"),
    (7, " leading and trailing  "),
    (8, "=" * 3001 + " " * 777 + "a" * 1999),
    (9, "don't DON'T 'S 's 'ſ ''s <| <|endoftext|"),
]


@pytest.fixture(scope="module", params=["table", "edge", "none", "odd"])
def docs(request, spark, edge_docs, no_docs):
    odd = spark.createDataFrame([(i, "x", None, 1, t) for i, t in ODD], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    return {"table": table(spark, SF001, "documents"), "edge": edge_docs, "none": no_docs, "odd": odd}[request.param]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def proof_steps(leaves, fanout):
    """Per leaf: (place in its run, siblings) of each level; and the root."""
    steps, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, place in enumerate(at):
            lo = place - place % fanout
            run = nodes[lo : lo + fanout]
            steps[i].append((place - lo, run[: place - lo] + run[place - lo + 1 :]))
            at[i] = place // fanout
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return steps, nodes[0]


def reference_manifest(rows, fanout=8):
    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return h(enc(r["doc_id"]), enc(r["source"]), enc(r["lang"]), enc(r["n_chars"]), enc(text))

    trees = collections.defaultdict(list)
    for r in rows:
        trees[r["lang"]].append((r, leaf(r, r["text"])))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    per = {}
    for lang in order:
        trees[lang].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        per[lang] = proof_steps([x[1] for x in trees[lang]], fanout)
    if not order:
        return []
    top, root = proof_steps([per[x][1] for x in order], fanout)
    out = []
    for t, lang in enumerate(order):
        for (r, own), steps in zip(trees[lang], per[lang][0]):
            x = own
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                x = leaf(r, r["text"].translate({c: c + 32 for c in range(65, 91)}))
            for digit, others in steps + top[t]:
                x = h(*others[:digit], x, *others[digit:])
            proof = h(*[s for _, others in steps + top[t] for s in others])
            out.append((r["doc_id"], own, per[lang][1], root, proof, x, x == root))
    return out


@pytest.mark.parametrize("block_levels", [1, 3])
def test_manifest(docs, block_levels):
    want = collections.Counter(reference_manifest([r.asDict() for r in docs.collect()]))
    got = merkle.manifest(docs, block_levels=block_levels)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert collections.Counter(map(tuple, got.collect())) == want


@pytest.mark.parametrize("n,langs,fanout,levels", [(700, 1, 2, 1), (1, 1, 8, 1), (9, 1, 8, 1), (730, 3, 3, 1), (513, 2, 8, 1), (40, 40, 4, 2)])
def test_manifest_of_ragged_trees(spark, n, langs, fanout, levels):
    d = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), (F.col("id") % langs).cast("string").alias("lang"),
        F.col("id").alias("n_chars"), F.concat(F.lit("Text "), F.col("id")).alias("text"),
    )
    want = collections.Counter(reference_manifest([r.asDict() for r in d.collect()], fanout))
    assert collections.Counter(map(tuple, merkle.manifest(d, fanout=fanout, block_levels=levels).collect())) == want


def test_manifest_verifies_but_for_changed_texts(spark):
    d = table(spark, SF001, "documents")
    rows = {r.doc_id: r.verified for r in merkle.manifest(d).collect()}
    texts = {r.doc_id: r.text for r in d.collect()}
    changed = {i for i, t in texts.items() if zlib.crc32(str(i).encode()) % 3 == 0 and t != t.lower()}
    assert changed and {i for i, ok in rows.items() if not ok} <= changed
    assert all(rows[i] for i in rows if i not in changed)


def whole_ids(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(token_files.default_path())
    return [np.array([*e.ids, 2], "<u4") for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_token_files(docs):
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect()), key=lambda r: r[:2])
    ids = whole_ids([t for *_, t in rows])
    got = sorted(token_files.token_report(docs, file_ids=60_000).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i if known else None for known, i, _ in rows]
    want = collections.Counter((i if known else None, len(x), zlib.crc32(x.tobytes())) for (known, i, _), x in zip(rows, ids))
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens


def test_token_files_are_ranked_and_read_back(spark, scratch):
    d = table(spark, SF001, "documents")
    token_files.token_files(d, scratch, file_ids=50_000)
    back = {r.doc_id: r.ids for r in token_files.read_ids(spark, scratch, keep_ids=True).collect()}
    texts = [(r.doc_id, r.text) for r in d.collect()]
    whole = dict(zip([i for i, _ in texts], whole_ids([t for _, t in texts])))
    assert {i: bytes(x) for i, x in back.items()} == {i: x.tobytes() for i, x in whole.items()}
    blob = bytes(spark.read.format("binaryFile").load(f"{scratch}/ranks").first().content)
    order = next(token_files.read_blocks(blob))[2]
    n = collections.Counter(np.concatenate(list(whole.values())).tolist())
    assert order.tolist() == sorted(n, key=lambda i: (-n[i], i))
    size = spark.read.format("binaryFile").load(f"{scratch}/ids").agg(F.sum("length"), F.count("*")).first()
    assert size[1] > 1 and size[0] < 2 * sum(n.values())  # several files, under two bytes an id
    assert len(set(n.values())) > 1


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], list(range(0, 70_000, 7))])
def test_packed_values_round_trip(values):
    v = np.array(values, "<u4")
    control, data = token_files.pack_values(v)
    assert len(control) == -(-len(v) // 4)
    assert len(data) == sum(max(1, -(-int(x).bit_length() // 8)) for x in v.tolist())
    two = [np.frombuffer(x + x, np.uint8) for x in (control, data)]
    assert token_files.unpack_values(*two, np.array([len(v), len(v)])).tolist() == 2 * v.tolist()


def test_remembered_words_make_no_difference(monkeypatch):
    texts = [t for _, t in ODD] * 3
    monkeypatch.setattr(token_files, "KEPT", 5)
    words = token_files.WordIds(token_files.default_path())
    want = [x[:-1].tolist() for x in whole_ids(texts)]
    assert [words([t])[0].tolist() for t in texts] == want
    assert [x.tolist() for x in words(texts)] == want


def reference_alignment(texts):
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        vocab = {i: t for t, i in json.load(f)["model"]["vocab"].items()}
    letters = token_align.byte_letters()

    def bytes_a(i):
        return bytes(letters[c] for c in vocab[i])

    def bytes_b(i):
        return bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()

    docs, n = [], collections.Counter()
    for text in texts:
        groups = []
        if text:
            raw = (" " + text).encode()
            a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            if b"".join(map(bytes_a, a)) == raw == b"".join(map(bytes_b, b)):
                at_a = at_b = i = j = 0
                left, right = [], []
                while i < len(a) or j < len(b):
                    if at_a <= at_b:
                        left.append(a[i])
                        at_a += len(bytes_a(a[i]))
                        i += 1
                    else:
                        right.append(b[j])
                        at_b += len(bytes_b(b[j]))
                        j += 1
                    if at_a == at_b:
                        groups.append((left, right))
                        left, right = [], []
        docs.append(groups)
        n.update({(x, y) for left, right in groups for x in set(left) for y in set(right)})
    best = {}
    for (x, _), k in n.items():
        best[x] = max(best.get(x, 0), k)
    out = []
    for groups in docs:
        n_links = n_best = total = 0
        for left, right in groups:
            for (x, y), k in collections.Counter((x, y) for x in left for y in right).items():
                n_links += k
                n_best += k * (n[(x, y)] == best[x])
                total += k * n[(x, y)]
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), n_links, n_best, total, digest))
    return out, n


@pytest.fixture(scope="module")
def aligned_table(request, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want, n = reference_alignment([t for _, t in rows])
    return collections.Counter((i, *w) for (i, _), w in zip(rows, want)), n


@pytest.mark.parametrize("most", [token_align.TOP_PAIRS, 300, 0])
def test_alignment(docs, aligned_table, most):
    want, n = aligned_table
    report, counts = token_align.align_corpus(docs, most=most)
    assert report.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert collections.Counter(map(tuple, report.collect())) == want
    same = token_align.load_sides(*token_align.default_paths()).same
    assert {(r.a, int(same[r.a]) if r.b is None else r.b): r.n for r in counts.collect()} == dict(n)


def test_large_groups_are_counted_by_distinct_ids(docs, aligned_table, monkeypatch):
    monkeypatch.setattr(token_align, "EXPAND", 2)
    sides = token_align.load_sides(*token_align.default_paths())
    texts = [r.text or "" for r in docs.select("text").collect()]
    got = list(token_align.aligned(texts, sides)) if texts else []
    monkeypatch.setattr(token_align, "EXPAND", 4096)
    for x, y in zip(got, token_align.aligned(texts, sides) if texts else []):
        assert all(np.array_equal(x[k], y[k]) for k in x)
