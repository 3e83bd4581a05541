"""Packing token sequences by non-negative least squares on the length histogram.

1. Every document is tokenised once, where it lies, and cut at multiples of
   the window: full windows and one shorter tail.
2. The histogram of piece lengths (at most one row per length) goes to the
   driver. Combinations of up to three lengths that fill a window exactly are
   the columns of a matrix; their repeat counts are the non-negative least
   squares solution against the histogram, rounded, never beyond what is there.
3. What is left is packed greedily on the histogram, longest first.
4. The plan, a table of ranges of ranks for each length, is bounded by the
   window alone. Each piece gets its rank among the pieces of its length (in
   hashed buckets, so a very common length is many groups) and looks its
   sequence and offset up.
"""
from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage, text_or_empty, with_fields
from .sharding import number_within

WINDOW = 1024
END_ID = 0
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=4)
def _encoder(json_path: str, ranks_path: str | None):
    """text -> ids. The ranks file holds the same vocabulary as the JSON file in
    the form of a library that encodes several times as fast; a text that
    spells a special token goes to the JSON file's own tokenizer."""
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(json_path)
    slow = lambda text: full.encode(text, add_special_tokens=False).ids
    if ranks_path is None:
        return slow
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: slow(text) if SPECIAL in text else fast.encode_ordinary(text)


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def cut_pieces(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", paths: tuple[str, str | None] | None = None, keep_ids: bool = False
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): each document's ids and its end id, cut at multiples of ``window``."""
    json_path, ranks_path = paths or default_paths()
    fields = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(json_path, ranks_path)
        for b in batches:
            doc, start, length, crc, total, kept = [], [], [], [], [], []
            for d, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.array([*encode(text.as_py()), END_ID], "<u4")
                raw = memoryview(ids.tobytes())
                for at in range(0, len(ids), window):
                    doc.append(d)
                    start.append(at)
                    length.append(min(window, len(ids) - at))
                    crc.append(zlib.crc32(raw[4 * at : 4 * (at + window)]))
                    total.append(len(ids))
                    if keep_ids:
                        kept.append(ids[at : at + window].astype(np.int32))
            cols = [pa.array(c, pa.int64()) for c in (doc, start, length, crc, total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                cols.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("t"))
    return d.mapInArrow(run, fields)


def combinations(window: int, present: np.ndarray) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c >= 0, of present lengths that sum to ``window`` (0: no part)."""
    out = [np.array([[window, 0, 0]])] if present[window] else []
    a = np.arange(1, window)
    two = a[(a >= window - a) & present[a] & present[window - a]]
    out.append(np.stack([two, window - two, np.zeros_like(two)], axis=1))
    for c in np.flatnonzero(present[1 : window // 3 + 1]) + 1:
        b = np.arange(c, (window - c) // 2 + 1)
        a = window - c - b
        ok = present[b] & present[a]
        out.append(np.stack([a[ok], b[ok], np.full(ok.sum(), c)], axis=1))
    return np.concatenate(out)


def repeat_counts(parts: np.ndarray, histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """Non-negative least squares: min ||A x - histogram|| over x >= 0, by accelerated projected gradient."""
    if not len(parts):
        return np.zeros(0)
    n = len(histogram)
    b = histogram.astype(float)
    b[0] = 0.0

    def forward(x):
        y = np.bincount(parts.ravel(), np.repeat(x, 3), minlength=n)
        y[0] = 0.0
        return y

    def back(r):
        return r[parts].sum(axis=1)

    v = np.ones(len(parts))
    for _ in range(20):
        v = back(forward(v))
        size = np.linalg.norm(v)
        v /= size
    x = y = np.zeros(len(parts))
    t = 1.0
    for _ in range(steps):
        r = b - forward(y)
        r[0] = 0.0
        new = np.maximum(0.0, y + back(r) / (1.05 * size))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


@dataclass
class Plan:
    """Ranges of ranks: piece ``rank`` of ``length`` in [first, ...) goes to
    sequence ``base + (rank - first) // times`` at ``offset + length * ((rank - first) % times)``."""

    key: np.ndarray  # length << 40 | first rank, sorted
    times: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    sequences: int


def make_plan(histogram: np.ndarray, window: int = WINDOW) -> Plan:
    """Deal all pieces of ``histogram`` (counts by length, place 0 unused) to sequences of at most ``window``."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    patterns: list[tuple[list[int], int]] = []

    def take(parts: list[int], most: int) -> None:
        kinds = {p: parts.count(p) for p in parts}
        n = min([most, *(int(left[p]) // m for p, m in kinds.items())])
        if n > 0:
            for p, m in kinds.items():
                left[p] -= n * m
            patterns.append((parts, n))

    if left[window]:
        take([window], int(left[window]))
    rows = combinations(window, left > 0)
    x = repeat_counts(rows, left)
    for i in np.argsort(-x, kind="stable"):
        if x[i] < 0.5:
            break
        take([int(p) for p in rows[i] if p], int(x[i] + 0.5))
    while left.any():
        room, parts, spare = window, [], left.copy()
        while room:
            fit = np.flatnonzero(spare[: room + 1])
            if not len(fit):
                break
            p = int(fit[-1])
            m = min(room // p, int(spare[p]))
            parts += [p] * m
            spare[p] -= m
            room -= m * p
        take(parts, int(left.max()))
    key, times, base, offset = [], [], [], []
    used = np.zeros(window + 1, np.int64)
    sequences = 0
    for parts, n in patterns:
        at = 0
        for p in dict.fromkeys(parts):
            m = parts.count(p)
            key.append((p << 40) | int(used[p]))
            times.append(m)
            base.append(sequences)
            offset.append(at)
            used[p] += n * m
            at += m * p
        sequences += n
    order = np.argsort(np.array(key, np.int64))
    as_array = lambda c: np.array(c, np.int64)[order]
    return Plan(as_array(key), as_array(times), as_array(base), as_array(offset), sequences)


def assign(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` (staged; with ``length`` and the columns of ``cut_pieces``) with sequence_id and offset."""
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most one row per length
    histogram = np.zeros(window + 1, np.int64)
    for r in counts:
        histogram[r["length"]] = r["n"]
    plan = make_plan(histogram, window)
    ranked = number_within(pieces, "length", ["doc_id", "start", "ids_crc32"], name="_rank")
    schema = with_fields(pieces, sequence_id=T.LongType(), offset=T.LongType())
    names = [f.name for f in schema]
    place, last = names.index("length"), len(names) - 2

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column(place).to_numpy(zero_copy_only=False)
            rank = b.column(last).to_numpy(zero_copy_only=False)
            at = np.searchsorted(plan.key, (length << 40) | rank, "right") - 1
            j = rank - (plan.key[at] & ((1 << 40) - 1)) if len(at) else rank
            seq, off = plan.base[at] + j // plan.times[at], plan.offset[at] + length * (j % plan.times[at])
            yield pa.RecordBatch.from_arrays([*b.columns[:last], pa.array(seq), pa.array(off)], names)

    return ranked.mapInArrow(look_up, schema)


def pack(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", paths: tuple[str, str | None] | None = None) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    NULL and empty texts hold the end id alone. Rows that repeat an id are
    packed each on its own. Other columns are not read; no documents give no
    pieces.
    """
    return assign(stage(cut_pieces(docs, window, id_col, text_col, paths), "pieces"), window)


def sequences(docs: DataFrame, window: int = WINDOW, pad_id: int = END_ID, **kw) -> DataFrame:
    """(sequence_id, ids, n_tokens): the packed ids themselves, padded to ``window``."""
    whole = stage(cut_pieces(docs, window, keep_ids=True, **kw), "pieces")
    key = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    placed = assign(whole.drop("ids"), window)
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(*key))
    left = placed.withColumn("_n", nth)
    right = whole.select(*key, "ids").withColumn("_n", nth)
    cond = [left[k].eqNullSafe(right[k]) for k in [*key, "_n"]]
    rows = left.join(right, cond).select("sequence_id", "offset", "ids")
    packed = rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.flatten(F.transform("p", lambda p: p["ids"]))
    padded = F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(window) - F.size(ids)))
    return packed.select("sequence_id", padded.alias("ids"), F.size(ids).alias("n_tokens"))
