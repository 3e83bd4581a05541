"""Toxicity scores: logistic regression trained by FTRL-proximal on hashed word n-grams and skip-grams.

A feature is present in a document or not. Training visits a bounded sample
of labelled rows one at a time; each coordinate has its own learning rate and
an L1 term keeps all but the telling coordinates at zero, so the model sent to
the tasks is a short list of (feature, weight) pairs, at most 2^BITS.
Scoring reads every whole text in Arrow batches.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage, text_or_empty, whole_row, with_fields
from .features import gram_features

BITS = 20
SAMPLE_ROWS = 12_000  # bound on labelled rows that training sees
FOLDS = 5


@dataclass
class Model:
    bias: float
    index: np.ndarray  # sorted feature numbers
    weight: np.ndarray
    bits: int = BITS

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.bits, np.float32)
        w[self.index] = self.weight
        return w


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept for evaluation: crc32 of the id's text divisible by ``FOLDS`` (a NULL id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def ftrl(
    rows: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = 10, alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0, l2: float = 0.0, least_rows: int = 3, seed: int = 42
) -> Model | None:
    """FTRL-proximal over (present features, label) rows; the last place is the bias, free of penalties.

    Features of fewer than ``least_rows`` rows are left out: they could only
    learn those rows by heart.
    """
    if not rows:
        return None
    size = 1 << bits
    held_by = np.zeros(size, np.int32)
    for at, _ in rows:
        held_by[at] += 1
    for i, (at, y) in enumerate(rows):  # in place: the full features can go
        rows[i] = (at[held_by[at] >= least_rows], y)
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at):
        zi, ni = z[at], n[at]
        pen, reg = np.full(len(at), l1), np.full(len(at), l2)
        pen[-1] = reg[-1] = 0.0
        w = -(zi - np.sign(zi) * pen) / ((beta + np.sqrt(ni)) / alpha + reg)
        return np.where(np.abs(zi) <= pen, 0.0, w)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, y = rows[i]
            at = np.append(at.astype(np.int64), size)
            w = weights(at)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            ni = n[at]
            z[at] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[at] = ni + g * g
    live = np.append(np.flatnonzero(np.abs(z[:size]) > l1), size)
    w = weights(live)
    return Model(float(w[-1]), live[:-1], w[:-1].astype(np.float32), bits)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, t, y) of at most ``rows`` labelled documents outside the held-out fold, taken in hash order of the id.

    Labels other than 0 and 1 and NULL ids are left out; of repeated labels the larger counts.
    """
    lab = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("y")).filter("_id IS NOT NULL AND y IN (0, 1)")
    lab = lab.filter(~held_out("_id")).groupBy("_id").agg(F.max("y").alias("y"))
    some = lab.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    d = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).cast("binary").alias("t"))
    return d.join(F.broadcast(some), d["doc_id"] == some["_id"]).select("doc_id", "t", "y")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, rows: int = SAMPLE_ROWS, **ftrl_args) -> Model | None:
    """Fit on a bounded labelled sample: features are made where the texts lie, one task then runs the updates."""

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[] for _ in range(b.num_rows)]
            for doc, feat in gram_features((t.as_py() for t in b.column(1)), bits):
                both = np.unique((doc.astype(np.int64) << 32) | feat)
                cut = np.searchsorted(both >> 32, np.arange(b.num_rows + 1))
                for i in np.unique(doc):
                    found[i].append((both[cut[i] : cut[i + 1]] & 0xFFFFFFFF).astype(np.uint32))
            feats = [np.unique(np.concatenate(f)).tobytes() if f else b"" for f in found]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(feats, pa.binary())], ["doc_id", "y", "f"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = []
        for b in batches:
            data += zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist())
        data.sort()
        # of repeated ids all rows count; features stay 32 bits wide, as they are most of the task's memory
        rows = [(np.frombuffer(f, np.uint32), y) for _, y, f in data]
        del data
        m = ftrl(rows, bits, **ftrl_args)
        if m is not None:
            index = pa.array(np.append(m.index, -1).astype(np.int64))
            yield pa.RecordBatch.from_arrays([index, pa.array(np.append(m.weight, m.bias).astype(np.float64))], ["i", "w"])

    sample = labelled_sample(docs, labels, id_col, text_col, rows)
    feats = sample.mapInArrow(featurise, with_fields(sample.select("doc_id", "y"), f=T.BinaryType()))
    got = stage(stage(feats, "toxicity-features").repartition(1).mapInArrow(fit, "i bigint, w double"), "toxicity-model")
    got = got.toPandas().sort_values("i")
    if got.empty:
        return None
    i, w = got["i"].to_numpy(), got["w"].to_numpy()
    return Model(float(w[0]), i[1:], w[1:].astype(np.float32), bits)


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """(row, score): every row of ``docs`` as a struct and the score (0 to 1) of
    its whole text, NULL and empty texts included (the bias alone). Without a
    model every score is 0."""
    packed = docs.select(whole_row(docs).alias("row"))
    schema = with_fields(packed, score=T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.dense() if model is not None else None
        for b in batches:
            if w is None:
                p = np.zeros(b.num_rows)
            else:
                hits = []
                texts = (t.as_py() for t in b.column(0).field(text_col).cast(pa.binary()))
                for doc, feat in gram_features(texts, model.bits):
                    live = w[feat] != 0
                    hits.append((doc[live].astype(np.int64) << 32) | feat[live])
                both = np.unique(np.concatenate(hits)) if hits else np.empty(0, np.int64)
                z = model.bias + np.bincount(both >> 32, w[both & 0xFFFFFFFF].astype(np.float64), b.num_rows)
                p = 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], ["row", "score"])

    return packed.mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **train_args) -> DataFrame:
    """One row per document: (doc_id, held_out, score, predicted)."""
    model = train(docs, labels, id_col, text_col, **train_args)
    d = score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), model).select("row.doc_id", "score")
    return d.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, **train_args) -> DataFrame:
    """``docs`` without the rows scored at ``threshold`` or more."""
    model = train(docs, labels, id_col, text_col, **train_args)
    return score(docs, model, text_col).filter(F.col("score") < threshold).select("row.*")
