"""Secret scans: findings by a broad pattern, false positives removed by a random forest.

Findings are, without overlap and in this order of precedence: known key formats
wherever they stand, also inside longer runs; the value after a secret's name
and ``=`` or ``:``, of any length and any characters (quoted: up to the quote;
else up to white space, closing punctuation trimmed); and any run of 12 or more
key-like characters with a digit in it. Nothing is rejected here: that is the
forest's task. Features are the length, shares of character classes, shares of
each of the 16 transitions between classes, coverage by a dictionary of the
corpus's frequent words, and how the path (source) and the neighbouring words
fared among the labelled findings. The forest is grown on a bounded sample of
labelled findings and scores every finding of every whole text.

Labels: ``rule_label`` marks findings of a known key format or assignment as
secrets and other well-known forms (e-mail, card and phone numbers, addresses,
dates) as not; the rest is unlabelled and only scored. A column of reviewed
labels can take its place.
"""
from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage, text_or_empty, with_fields
from .toxicity import held_out

SAMPLE_ROWS = 8_000  # bound on the labelled findings that the forest is grown on
DICTIONARY_WORDS = 20_000  # the most frequent words of the corpus
TREES = 40
DEPTH = 8

FINDING = re.compile(rb"[A-Za-z0-9][A-Za-z0-9_+/.@\-]{11,}={0,2}")
_DIGIT = re.compile(rb"[0-9]")
_WORD = re.compile(rb"[A-Za-z\x80-\xff]+")
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_CLASS = np.full(256, 3, np.uint8)
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123] = 0, 1, 2

# Public formats that label a finding.
SECRET_FORMATS = (
    rb"AKIA[0-9A-Z]{16}", rb"ASIA[0-9A-Z]{16}", rb"gh[pousr]_[A-Za-z0-9]{36,}", rb"xox[abprs]-[A-Za-z0-9\-]{10,}",
    rb"AIza[0-9A-Za-z_\-]{35}", rb"sk_live_[0-9a-zA-Z]{16,}", rb"glpat-[0-9A-Za-z_\-]{20,}",
)
SECRET_NAMES = rb"(?:password|passwd|pwd|secret|token|api_?key|access_?key|auth)"
OTHER_FORMATS = (
    rb"[0-9.\-]+", rb"[^@]+@[^@]+\.[A-Za-z]+", rb"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", rb"[0-9]{4}-[0-9]{2}-[0-9]{2}.*", rb"[a-z]+[0-9]{1,3}",
)
CLOSING = b".,;:!?)]}>"  # trimmed from the end of values without quotes
_SECRET = re.compile(b"|".join(SECRET_FORMATS))
_ASSIGNED = re.compile(SECRET_NAMES + rb"""[\"']?[ \t]*[=:][ \t]*(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"']\S*))""", re.I)
_NAMED = re.compile(SECRET_NAMES + rb"[\"']?[ \t]*[=:][ \t]*[\"']?$", re.I)
_OTHER = re.compile(b"|".join(OTHER_FORMATS))

NUMERIC = ("length", "digits", "upper", "lower", "other", "changes", *(f"{a}_{b}" for a in "dulo" for b in "dulo"), "distinct", "entropy", "longest_digits", "coverage", "assigned", "quoted")
CONTEXT = ("path", "before", "after")


def rule_label(value: bytes, before: bytes) -> int | None:
    """1: of a secret's format, or assigned to a secret's name and of 16 bytes or of
    8 bytes in two classes of characters; 0: another known form; None: neither, so only scored."""
    if _SECRET.fullmatch(value):
        return 1
    if _NAMED.search(before) and (len(value) >= 16 or len(value) >= 8 and len(set(_CLASS[np.frombuffer(value, np.uint8)])) > 1):
        return 1
    return 0 if _OTHER.fullmatch(value) else None


def spans(text: bytes) -> list[tuple[int, int]]:
    """Places of the findings of a text, ascending, without overlap."""
    named = []
    for m in _ASSIGNED.finditer(text):
        lo, hi = m.span(m.lastindex)
        if m.lastindex == 3:
            hi = lo + len(text[lo:hi].rstrip(CLOSING + b"\"'"))
        named.append((lo, hi))
    runs = []
    for m in FINDING.finditer(text):
        v = m.group().rstrip(b".-/")
        if _DIGIT.search(v):
            runs.append((m.start(), m.start() + len(v)))
    kept: list[tuple[int, int]] = []
    for found in ([m.span() for m in _SECRET.finditer(text)], named, runs):
        starts = [lo for lo, _ in kept]
        new = []
        for lo, hi in found:
            at = bisect_left(starts, hi)  # of the kept ones, which do not overlap, only the last that starts before hi can reach in
            if hi > lo and not (at and kept[at - 1][1] > lo):
                new.append((lo, hi))
        kept = sorted(kept + new)
    return kept


def frequent_words(docs: DataFrame, text_col: str = "text", words: int = DICTIONARY_WORDS) -> frozenset[bytes]:
    """The most frequent words (three letters or more) of all texts, at most ``words``; ties to the smaller word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                seen.update(t.as_py().translate(_LETTERS).split())
                if len(seen) > 500_000:  # bounded memory: hand on what was counted so far
                    yield _counted(seen)
                    seen.clear()
        yield _counted(seen)

    d = docs.select(text_or_empty(text_col).cast("binary").alias("t"))
    total = d.mapInArrow(count, "w binary, n bigint").groupBy("w").agg(F.sum("n").alias("n"))
    # staged, so that tasks' candidates meet in a task; the driver gets the chosen words alone
    top = stage(total.orderBy(F.desc("n"), "w").limit(words), "dictionary").collect()
    return frozenset(bytes(r["w"]) for r in top)


def _counted(seen: Counter) -> pa.RecordBatch:
    kept = [(w, n) for w, n in seen.items() if len(w) > 2]
    return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.binary()), pa.array([n for _, n in kept], pa.int64())], ["w", "n"])


def describe(value: bytes, words: frozenset[bytes]) -> list[float]:
    a = np.frombuffer(value, np.uint8)
    kind = _CLASS[a]
    n = len(a)
    share = np.bincount(kind, minlength=4) / n
    steps = np.bincount(kind[:-1].astype(int) * 4 + kind[1:], minlength=16) / max(1, n - 1)
    counts = np.bincount(a)
    p = counts[counts > 0] / n
    digits = max(map(len, re.findall(rb"[0-9]+", value)), default=0)
    covered = sum(len(w) for w in _WORD.findall(value) if w.lower() in words)
    changes = float(steps.sum() - steps[[0, 5, 10, 15]].sum())
    return [n, *share, changes, *steps, len(p) / n, float(-(p * np.log2(p)).sum()), digits / n, covered / n]


def findings(docs: DataFrame, words: frozenset[bytes], id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(doc_id, start, length, value_crc32, label, numbers, path, before, after) of every finding; places in bytes of UTF-8.

    The value itself is not handed on. A NULL path is the empty path.
    """
    schema = "doc_id bigint, start bigint, length int, value_crc32 bigint, label int, x array<float>, path string, before string, after string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for d, t, path in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                t = t.as_py()
                for lo, hi in spans(t):
                    v, lead, tail = t[lo:hi], t[max(0, lo - 48) : lo], t[hi : hi + 32]
                    near, then = _WORD.findall(lead), _WORD.findall(tail)
                    assigned = lead.rstrip(b" \t\"'")[-1:] in (b"=", b":")
                    quoted = lead[-1:] in (b'"', b"'")
                    x = [*describe(v, words), float(assigned), float(quoted)]
                    rows.append(
                        (d, lo, len(v), zlib.crc32(v), rule_label(v, lead), x, path, (near[-1] if near else b"").lower().decode("utf-8", "replace"), (then[0] if then else b"").lower().decode("utf-8", "replace"))
                    )
            cols = list(zip(*rows)) if rows else [()] * 9
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.float32()), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "start", "length", "value_crc32", "label", "x", "path", "before", "after"]
            )

    d = docs.select(F.col(id_col).cast("bigint"), text_or_empty(text_col).cast("binary").alias("t"), F.coalesce(F.col(path_col).cast("string"), F.lit("")))
    return d.mapInArrow(run, schema)


@dataclass
class Forest:
    rate: float  # share of secrets among the labelled findings
    context: tuple[dict[str, float], ...]  # by CONTEXT: value -> smoothed share of secrets
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # feature (-1: leaf), cut, left child, value

    def matrix(self, x: np.ndarray, context: list[list[str]]) -> np.ndarray:
        known = [[t.get(v, self.rate) for v in values] for t, values in zip(self.context, context)]
        return np.column_stack([x, *known])

    def score(self, m: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.full(len(m), self.rate)
        total = np.zeros(len(m))
        for feature, cut, left, value in self.trees:
            at = np.zeros(len(m), np.int64)
            while True:
                f = feature[at]
                inner = np.flatnonzero(f >= 0)
                if not len(inner):
                    break
                here = at[inner]
                at[inner] = left[here] + (m[inner, f[inner]] > cut[here])
            total += value[at]
        return total / len(self.trees)


def _grow(m: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int = DEPTH, least: int = 4):
    feature, cut, left, value = [], [], [], []
    todo = [(np.arange(len(y)), 0, 0)]
    feature.append(-1), cut.append(0.0), left.append(0), value.append(0.0)
    while todo:
        rows, node, level = todo.pop()
        p = y[rows].mean()
        value[node] = float(p)
        if level == depth or len(rows) < 2 * least or p in (0.0, 1.0):
            continue
        best = (p * (1 - p) * len(rows) - 1e-9, None)
        for f in rng.permutation(m.shape[1])[: max(1, int(np.sqrt(m.shape[1])) + 1)]:
            order = np.argsort(m[rows, f], kind="stable")
            v, hits = m[rows[order], f], np.cumsum(y[rows[order]])
            n = np.arange(1, len(rows))
            a, b = hits[:-1], hits[-1] - hits[:-1]
            impurity = a * (n - a) / n + b * (len(rows) - n - b) / (len(rows) - n)
            impurity[(v[1:] == v[:-1]) | (n < least) | (len(rows) - n < least)] = np.inf
            k = int(np.argmin(impurity))
            if impurity[k] < best[0]:
                best = (impurity[k], (f, (v[k] + v[k + 1]) / 2))
        if best[1] is None:
            continue
        feature[node], cut[node] = best[1]
        low = m[rows, best[1][0]] <= best[1][1]
        left[node] = len(feature)
        for part in (rows[low], rows[~low]):
            todo.append((part, len(feature), level + 1))
            feature.append(-1), cut.append(0.0), left.append(0), value.append(0.0)
    return np.array(feature), np.array(cut), np.array(left), np.array(value)


def train_forest(found: DataFrame, rows: int = SAMPLE_ROWS, trees: int = TREES, seed: int = 42) -> Forest:
    """Grow the forest on at most ``rows`` labelled findings outside the
    held-out fold, taken in hash order. No labelled findings: every score is 0."""
    lab = found.filter(F.col("label").isNotNull() & ~held_out())
    some = lab.orderBy(F.xxhash64("doc_id", "start", "value_crc32"), "doc_id", "start", "value_crc32").limit(rows)
    data = stage(some.select("label", "x", *CONTEXT), "forest-sample").collect()  # bounded by ``rows``
    if not data:
        return Forest(0.0, tuple({} for _ in CONTEXT), [])
    y = np.array([r["label"] for r in data], float)
    x = np.array([r["x"] for r in data], float)
    rng = np.random.default_rng(seed)
    rate = float(y.mean())
    halves = rng.integers(0, 2, len(y))
    tables, encoded = [], []
    for c in CONTEXT:
        values = [r[c] for r in data]

        def shares(rows):
            n, hits = Counter(), Counter()
            for i in rows:
                n[values[i]] += 1
                hits[values[i]] += y[i]
            return {v: (hits[v] + 2 * rate) / (n[v] + 2) for v in n if n[v] > 1}

        # a row is encoded from the other half, so its own label is not among its features
        other = [shares(np.flatnonzero(halves != h)) for h in (0, 1)]
        encoded.append([other[h].get(v, rate) for h, v in zip(halves, values)])
        tables.append(shares(range(len(y))))
    m = np.column_stack([x, *encoded])
    grown = []
    for _ in range(trees if 0 < rate < 1 else 0):
        pick = rng.integers(0, len(y), len(y))
        grown.append(_grow(m[pick], y[pick], rng))
    return Forest(rate, tuple(tables), grown)


def score_findings(found: DataFrame, forest: Forest) -> DataFrame:
    schema = with_fields(found, score=T.DoubleType())
    names = [f.name for f in schema]
    at = [names.index(c) for c in ("x", *CONTEXT)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(at[0]).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            m = forest.matrix(x, [b.column(i).to_pylist() for i in at[1:]])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(forest.score(m))], names)

    return found.mapInArrow(run, schema)


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """One row per finding: (doc_id, start, length, value_crc32, label, held_out, score, is_secret).

    Whole texts are scanned, however long; NULL and empty ones have no findings.
    Rows that repeat an id are scanned each on its own, equal findings are rows
    each. The sample of labelled findings is taken in hash order, ties by id and
    place. An empty table, and one without labelled findings, has no forest:
    scores are 0. Other columns are not read, so their names do not matter.
    """
    words = frequent_words(docs, text_col)
    found = stage(findings(docs, words, id_col, text_col, path_col), "findings")
    scored = score_findings(found, train_forest(found))
    return scored.select(
        "doc_id", "start", "length", "value_crc32", "label", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).alias("is_secret")
    )
