"""Alignment of two tokenizers' ids over a corpus, and how often id pairs meet.

A encodes a space and the text, B encodes the text (and puts the space there
itself). Byte offsets where tokens of both end cut the two sequences into
groups; every token of A in a group is linked to every token of B in it.

1. Identity map: for each A id the B id of the same bytes, one array as long as
   A's vocabulary, made on the driver from the two vocabulary files.
2. Every text is encoded once, where it lies, and its groups are found with
   numpy on the running byte lengths. Links that follow the identity map, which
   are nearly all, are kept as A ids alone; only other links are kept as pairs.
3. Documents that hold an identity link are counted in vectors as long as the
   vocabulary; other pairs are counted within a task before they are shuffled.
4. The counts come back to the documents: the vectors, and the most frequent
   pairs up to ``TOP_PAIRS``, whose number is fixed, go to every task. Other
   pairs are joined; none of them is frequent, so no key of that join is hot.
"""
from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, stage, text_or_empty

CHUNK_BYTES = 1 << 19  # text aligned at once; a longer text is a chunk of its own
EXPAND = 4096  # links of one group that are written out before counting; larger groups are counted by distinct ids
TOP_PAIRS = 1 << 18  # pairs sent to every task
HELD_PAIRS = 1 << 20  # distinct pairs that a counting task holds
_BITS = 20  # an id is below 2^20
_LOW = (1 << _BITS) - 1


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies spell bytes with: printable
    Latin-1 stands for itself, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@dataclass
class Sides:
    """Both tokenizers: their encoders, the bytes of every id, the identity map."""

    encode_a: object
    encode_b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    same: np.ndarray

    def __post_init__(self):
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # spelling of an id before another one of its side and group, then at the side's end
        self.spelled = [
            b"%d%s" % (i, mark) for n, marks in ((len(self.bytes_a), (b",", b"|")), (len(self.bytes_b), (b",", b";"))) for mark in marks for i in range(n)
        ]


def identity_map(bytes_a: list[bytes], bytes_b: list[bytes]) -> np.ndarray:
    """B id with the bytes of each A id, -1 if there is none. Of B ids with the same bytes, the largest (a piece, not a byte)."""
    of = {x: i for i, x in enumerate(bytes_b) if x}
    return np.array([of.get(x, -1) for x in bytes_a], np.int64)


@lru_cache(maxsize=2)
def load_sides(json_path: str, ranks_path: str | None, model_path: str) -> Sides:
    """Read the vocabulary files. With a ranks file, which holds A's vocabulary
    for a library that encodes several times as fast, A encodes by that."""
    import sentencepiece

    with open(json_path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    entries = {i: bytes(letters[c] for c in token) for token, i in spec["model"]["vocab"].items()}
    entries |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
    bytes_a = [entries.get(i, b"") for i in range(max(entries) + 1)]
    if ranks_path is None:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(json_path)
        tok.encode_special_tokens = True
        encode_a = lambda texts: [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    else:
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        encode_a = lambda texts: [fast.encode_ordinary(t) for t in texts]
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)

    def piece(i: int) -> bytes:
        text = sp.id_to_piece(i)
        if sp.is_byte(i):
            return bytes([int(text[3:5], 16)])
        return b"" if sp.is_control(i) or sp.is_unknown(i) else text.replace("▁", " ").encode()

    bytes_b = [piece(i) for i in range(sp.get_piece_size())]
    return Sides(encode_a, lambda texts: sp.encode(texts, num_threads=1), bytes_a, bytes_b, identity_map(bytes_a, bytes_b))


def default_paths() -> tuple[str, str, str]:
    import public_tokenizers

    return tuple(public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start."""
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.empty(0, np.int64)


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``keys``, ascending, with the sum of their ``n``."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    at = _runs(keys)
    return keys[at], (np.add.reduceat(n, at) if len(at) else n)


def align(a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group (from 0) of each token, from the byte offsets where tokens end."""
    at = np.searchsorted(end_b, end_a)
    cut_a = end_b[np.minimum(at, len(end_b) - 1)] == end_a
    cut_b = np.zeros(len(b), bool)
    cut_b[at[cut_a]] = True
    return np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b


def links(a: np.ndarray, b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, p: np.ndarray, q: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(group, a, b, how often) of the links of groups of ``p`` by ``q`` tokens;
    small groups link by link, large ones by distinct ids."""
    small = p * q <= EXPAND
    g = np.flatnonzero(small)
    n = p[g] * q[g]
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    width = np.repeat(q[g], n)
    at_a = np.repeat(first_a[g], n) + inside // width
    at_b = np.repeat(first_b[g], n) + inside % width
    yield np.repeat(g, n), a[at_a], b[at_b], np.ones(len(at_a), np.int64)
    for g in np.flatnonzero(~small).tolist():
        ids_a, n_a = np.unique(a[first_a[g] : first_a[g] + p[g]], return_counts=True)
        ids_b, n_b = np.unique(b[first_b[g] : first_b[g] + q[g]], return_counts=True)
        for x, times in zip(ids_a.tolist(), n_a.tolist()):
            yield np.full(len(ids_b), g), np.full(len(ids_b), x), ids_b, times * n_b


def aligned(texts: list[str], sides: Sides) -> Iterator[dict]:
    """For each text, in order: its counts, digest and links (identity: ``ia``,
    ``im``; others ``pa``, ``pb``, ``pm``; sorted, each distinct link once)."""
    raw = [(" " + t).encode() if t else b"" for t in texts]
    tok_a = sides.encode_a([" " + t for t in texts])
    tok_b = sides.encode_b(texts)
    ok = [
        bool(r) and b"".join([sides.bytes_a[i] for i in x]) == r and b"".join([sides.bytes_b[i] for i in y]) == r for r, x, y in zip(raw, tok_a, tok_b)
    ]
    tok_a, tok_b = ([x if k else [] for x, k in zip(side, ok)] for side in (tok_a, tok_b))
    n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (tok_a, tok_b))
    a, b = (np.array([i for x in side for i in x], np.int64) for side in (tok_a, tok_b))
    docs = np.arange(len(texts))
    zero = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""} | {k: np.empty(0, np.int64) for k in ("ia", "im", "pa", "pb", "pm")}
    if not len(a):
        yield from (zero for _ in texts)
        return
    # texts are laid end to end; each ends with a cut, so no group spans two
    group_a, group_b = align(a, b, np.cumsum(sides.len_a[a]), np.cumsum(sides.len_b[b]))
    p, q = np.bincount(group_a), np.bincount(group_b)
    first_a, first_b = np.cumsum(p) - p, np.cumsum(q) - q
    doc = np.repeat(docs, n_a)[first_a]
    n_groups = np.bincount(doc, minlength=len(texts))
    n_links = np.zeros(len(texts), np.int64)
    np.add.at(n_links, doc, p * q)

    one = (p == 1) & (q == 1)
    one_a, one_b = a[first_a[one]], b[first_b[one]]
    fits = sides.same[one_a] == one_b
    ident = [((doc[one][fits] << _BITS) | one_a[fits], np.ones(int(fits.sum()), np.int64))]
    other = [((doc[one][~fits] << 2 * _BITS) | (one_a[~fits] << _BITS) | one_b[~fits], np.ones(int((~fits).sum()), np.int64))]
    many = ~one
    of = doc[many]
    for g, x, y, n in links(a, b, first_a[many], first_b[many], p[many], q[many]):
        fits = sides.same[x] == y
        ident.append(((of[g[fits]] << _BITS) | x[fits], n[fits]))
        other.append(((of[g[~fits]] << 2 * _BITS) | (x[~fits] << _BITS) | y[~fits], n[~fits]))
    ident_key, ident_n = summed(*(np.concatenate(x) for x in zip(*ident)))
    other_key, other_n = summed(*(np.concatenate(x) for x in zip(*other)))
    ident_cut = np.searchsorted(ident_key, np.arange(len(texts) + 1) << _BITS)
    other_cut = np.searchsorted(other_key, np.arange(len(texts) + 1) << 2 * _BITS)

    # spelling: A's tokens of a group, then B's
    size_a, size_b = len(sides.bytes_a), len(sides.bytes_b)
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[first_a + p - 1] = True
    last_b[first_b + q - 1] = True
    spell = np.empty(len(a) + len(b), np.int64)
    spell[np.arange(len(a)) + first_b[group_a]] = a + size_a * last_a
    spell[np.arange(len(b)) + (first_a + p)[group_b]] = b + 2 * size_a + size_b * last_b
    ends = np.cumsum(n_a + n_b)
    for d, end in enumerate(ends.tolist()):
        if not ok[d]:
            yield zero
            continue
        text = b"".join([sides.spelled[i] for i in spell[end - n_a[d] - n_b[d] : end].tolist()])
        i, j = ident_cut[d : d + 2]
        k, m = other_cut[d : d + 2]
        yield {
            "n_a": int(n_a[d]), "n_b": int(n_b[d]), "n_groups": int(n_groups[d]), "n_links": int(n_links[d]), "groups_sha256": sha256(text[:-1]).hexdigest(),
            "ia": ident_key[i:j] & _LOW, "im": ident_n[i:j], "pa": (other_key[k:m] >> _BITS) & _LOW, "pb": other_key[k:m] & _LOW, "pm": other_n[k:m],
        }


_COUNTS = "rid bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_LINKS = "ia array<int>, im array<int>, pa array<int>, pb array<int>, pm array<int>"


def _int_lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(p) for p in parts])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts).astype(np.int32)))


def aligned_docs(docs: DataFrame, paths: tuple[str, str | None, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its counts and its distinct links."""
    paths = paths or default_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = load_sides(*paths)
        for b in batches:
            texts = b.column(2).to_pylist()
            lo = 0
            while lo < len(texts):
                hi, size = lo + 1, len(texts[lo])
                while hi < len(texts) and size + len(texts[hi]) <= CHUNK_BYTES:
                    size += len(texts[hi])
                    hi += 1
                rows = list(aligned(texts[lo:hi], sides))
                part = b.slice(lo, hi - lo)
                cols = [part.column(0), part.column(1)]
                cols += [pa.array([r[k] for r in rows], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")]
                cols.append(pa.array([r["groups_sha256"] for r in rows], pa.string()))
                cols += [_int_lists([r[k] for r in rows]) for k in ("ia", "im", "pa", "pb", "pm")]
                yield pa.RecordBatch.from_arrays(cols, [f.split()[0] for f in f"{_COUNTS}, {_LINKS}".split(", ")])
                lo = hi

    d = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("t"))
    return d.mapInArrow(run, f"{_COUNTS}, {_LINKS}")


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def pair_counts(found: DataFrame) -> DataFrame:
    """(a, b, n, best): in how many documents each linked id pair occurs, and
    whether no pair of that A id occurs in more. ``b`` is NULL for the identity pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "n"]
        vector = np.zeros(0, np.int64)
        keys, n = np.empty(0, np.int64), np.empty(0, np.int64)

        def pairs():
            return pa.RecordBatch.from_arrays([pa.array(keys >> _BITS), pa.array(keys & _LOW), pa.array(n)], names)

        for b in batches:
            more = np.bincount(_flat(b.column(0)), minlength=len(vector))
            more[: len(vector)] += vector
            vector = more
            new = (_flat(b.column(1)) << _BITS) | _flat(b.column(2))
            keys, n = summed(np.concatenate([keys, new]), np.concatenate([n, np.ones(len(new), np.int64)]))
            if len(keys) > HELD_PAIRS:
                yield pairs()
                keys, n = keys[:0], n[:0]
        yield pairs()
        at = np.flatnonzero(vector)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.nulls(len(at), pa.int64()), pa.array(vector[at])], names)

    counted = found.select("ia", "pa", "pb").mapInArrow(run, "a bigint, b bigint, n bigint")
    counted = stage(counted.groupBy("a", "b").agg(F.sum("n").alias("n")), "align-counted")
    most = counted.groupBy("a").agg(F.max("n").alias("_most"))
    out = stage(counted.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("_most")).alias("best")), "align-counts")
    drop_staged(found.sparkSession, counted)
    return out


def frequent_pairs(counts: DataFrame, most: int = TOP_PAIRS) -> DataFrame:
    """The pairs of ``counts`` (identity pairs aside) that occur most, at most
    ``most`` of them: those of the highest classes of frequency that fit in."""
    grade = F.floor(F.log2(F.col("n").cast("double")) * 16)  # at most 1024 classes
    pairs = counts.filter(F.col("b").isNotNull())
    left, least = most, None
    for r in sorted(pairs.groupBy(grade.alias("g")).count().collect(), key=lambda r: -r["g"]):
        left -= r["count"]
        if left < 0:
            break
        least = r["g"]
    return pairs.filter(F.lit(False)) if least is None else pairs.filter(grade >= least)


def _scored(vector: tuple[np.ndarray, np.ndarray], top: tuple[np.ndarray, ...]):
    """Sums over each document's links of known count; pairs that are not among them are handed on."""
    v_n, v_best = vector
    t_key, t_n, t_best = top

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            def per_doc(values: np.ndarray, of: np.ndarray) -> np.ndarray:
                out = np.zeros(b.num_rows, np.int64)
                np.add.at(out, of, values)
                return out

            doc = np.repeat(np.arange(b.num_rows), np.diff(b.column(1).offsets.to_numpy()))
            a, m = _flat(b.column(1)), _flat(b.column(2))
            total, best = per_doc(m * v_n[a], doc), per_doc(m * v_best[a], doc)
            doc = np.repeat(np.arange(b.num_rows), np.diff(b.column(3).offsets.to_numpy()))
            key, m = (_flat(b.column(3)) << _BITS) | _flat(b.column(4)), _flat(b.column(5))
            at = np.minimum(np.searchsorted(t_key, key), max(0, len(t_key) - 1))
            known = t_key[at] == key if len(t_key) else np.zeros(len(key), bool)
            at = at[known]
            total += per_doc(m[known] * t_n[at], doc[known])
            best += per_doc(m[known] * t_best[at], doc[known])
            rest = ~known
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc[rest], minlength=b.num_rows))])
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x[rest])) for x in (key >> _BITS, key & _LOW, m)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best), pa.array(total), *lists], ["rid", "best0", "sum0", "xa", "xb", "xm"])

    return run


def align_corpus(
    docs: DataFrame, paths: tuple[str, str | None, str] | None = None, id_col: str = "doc_id", text_col: str = "text", most: int = TOP_PAIRS
) -> tuple[DataFrame, DataFrame]:
    """``(report, counts)``: per document (doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups_sha256), and :func:`pair_counts` over the corpus.

    NULL and empty texts, and texts whose joined bytes of A or B are not those
    of the spaced text, have no tokens: zeros and an empty digest. NULL ids are
    carried; repeated rows are documents of their own and count each. Very long
    texts are aligned whole. Ties for an A id's best pair are all best. An empty
    table gives empty tables. Other columns are not read.
    """
    spark = docs.sparkSession
    found = stage(aligned_docs(docs, paths, id_col, text_col), "align-docs")
    counts = pair_counts(found)
    rows = counts.filter(F.col("b").isNull()).collect()  # at most one row per A id
    size = len(load_sides(*(paths or default_paths())).bytes_a)
    vector = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r in rows:
        vector[0][r["a"]], vector[1][r["a"]] = r["n"], r["best"]
    t = frequent_pairs(counts, most).select(F.expr(f"shiftleft(a, {_BITS}) | b").alias("k"), "n", "best").toArrow()  # at most ``most`` rows
    key, n, best = (t.column(c).to_numpy().astype(np.int64) for c in ("k", "n", "best"))
    order = np.argsort(key)
    fields = "rid bigint, best0 bigint, sum0 bigint, xa array<bigint>, xb array<bigint>, xm array<bigint>"
    known = found.select("rid", "ia", "im", "pa", "pb", "pm").mapInArrow(_scored(vector, (key[order], n[order], best[order])), fields)
    known = stage(known, "align-known")
    rest = known.filter(F.size("xa") > 0).select("rid", F.explode(F.arrays_zip("xa", "xb", "xm")).alias("x"))
    rest = rest.select("rid", F.col("x.xa").alias("a"), F.col("x.xb").alias("b"), F.col("x.xm").alias("m")).join(counts, ["a", "b"])
    rest = rest.groupBy("rid").agg(F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("best1"), F.sum(F.col("m") * F.col("n")).alias("sum1"))
    narrow = found.select(*[f.split()[0] for f in _COUNTS.split(", ")])
    sums = known.select("rid", "best0", "sum0").join(rest, "rid", "left")
    report = narrow.join(sums, "rid").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("best0") + F.coalesce("best1", F.lit(0))).cast("bigint").alias("n_best"),
        (F.col("sum0") + F.coalesce("sum1", F.lit(0))).cast("bigint").alias("count_sum"),
        "groups_sha256",
    )
    return report, counts


def align_report(docs: DataFrame, **options) -> DataFrame:
    """The first result of :func:`align_corpus`."""
    return align_corpus(docs, **options)[0]
