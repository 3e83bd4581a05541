"""JSON-array files of any size, read in many tasks.

One array file is cut at the commas between its elements. Spark's text reader,
told to end lines at commas, reads byte ranges of a file in parallel, so a line
never holds more than one element. What a byte means depends on all bytes
before it (inside a string? how deep?), so the file is scanned twice:

1. each split says what it does to that state for either way it may start
   (outside or inside a string); running sums over the few split rows give
   every split its true start: in a string or not, depth, elements before;
2. each split cuts its elements. An element that crosses splits is put
   together from its pieces; all others stay where they were read.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import jsonx as J
from .tables import empty_files

SPLITS_BROADCAST = 100_000  # splits whose start states are broadcast; beyond, they are joined by shuffle
MAX_DEPTH = 1024  # commas are counted by depth up to this; the JSON parser takes no deeper element
JSON_SPACE = " \t\n\r"

_QUOTE, _BACKSLASH, _COMMA, _OPEN, _CLOSE = 1, 2, 3, 4, 5
_KIND = np.zeros(256, np.uint8)
for _kind, _chars in ((_QUOTE, b'"'), (_BACKSLASH, b"\\"), (_COMMA, b","), (_OPEN, b"[{"), (_CLOSE, b"]}")):
    _KIND[list(_chars)] = _kind


def structure(data: bytes):
    """Places of quotes, brackets and commas in ``data``, their kinds, and how
    many string ends and starts lie up to each (escaped quotes left out)."""
    kinds = _KIND[np.frombuffer(data, np.uint8)]
    at = np.flatnonzero(kinds)
    kind = kinds[at]
    slashes = at[kind == _BACKSLASH]
    if len(slashes):
        first = np.flatnonzero(np.diff(slashes, prepend=-2) != 1)
        length = np.diff(first, append=len(slashes))
        escaped = slashes[first][length % 2 == 1] + length[length % 2 == 1]
        keep = (kind != _BACKSLASH) & ~((kind == _QUOTE) & np.isin(at, escaped))
        at, kind = at[keep], kind[keep]
    return at, kind, np.cumsum(kind == _QUOTE)


def depths(kind, quotes, inside: bool):
    """Depth after each place, relative to the start, and whether it lies outside strings."""
    outside = (quotes + inside) % 2 == 0
    step = np.where(kind == _OPEN, 1, np.where(kind == _CLOSE, -1, 0))
    return np.cumsum(np.where(outside, step, 0)), outside


def _pieces(batches, columns):
    """(key, bytes) for each run of rows of one split, in reading order, with the
    commas that the reader took off put back before the lines they end before."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = set()
        for name in ("file", "split"):
            ends.update(pc.run_end_encode(batch.column(name)).run_ends.to_pylist())
        lo = 0
        for hi in sorted(ends):
            key = tuple(batch.column(c)[lo].as_py() for c in columns)
            data = b",".join(batch.column("value").slice(lo, hi - lo).to_pylist())
            yield key, data if key[:2] != last and key[1] == 0 else b"," + data
            last, lo = key[:2], hi


SUMMARY = pa.schema([
    ("file", pa.string()), ("split", pa.int64()), ("size", pa.int64()), ("n_bytes", pa.int64()), ("quotes", pa.int64()),
    *[(f"{name}_{way}", kind) for way in ("out", "in") for name, kind in (("depth", pa.int64()), ("commas", pa.map_(pa.int64(), pa.int64())))],
])
SUMMARY_DDL = (
    "file string, split long, size long, n_bytes long, quotes long, "
    "depth_out long, commas_out map<long, long>, depth_in long, commas_in map<long, long>"
)


def _summaries(batches):
    """One row for each split: its effect on the state, for either start."""
    key, n_bytes, quotes, ways = None, 0, 0, None

    def row():
        out = {"file": key[0], "split": key[1], "size": key[2], "n_bytes": n_bytes, "quotes": quotes}
        for way, (depth, commas) in zip(("out", "in"), ways):
            out[f"depth_{way}"], out[f"commas_{way}"] = depth, sorted(commas.items())
        return pa.RecordBatch.from_pylist([out], SUMMARY)

    for k, data in _pieces(batches, ("file", "split", "size")):
        if k != key:
            if key is not None:
                yield row()
            key, n_bytes, quotes, ways = k, 0, 0, [(0, {}), (0, {})]
        _, kind, seen = structure(data)
        for inside in (0, 1):
            depth, commas = ways[inside]
            rel, outside = depths(kind, seen, (quotes + inside) % 2)
            at, n = np.unique(rel[outside & (kind == _COMMA)] + depth, return_counts=True)
            for d, c in zip(at.tolist(), n.tolist()):
                if abs(d) <= MAX_DEPTH:
                    commas[d] = commas.get(d, 0) + c
            ways[inside] = depth + (int(rel[-1]) if len(rel) else 0), commas
        n_bytes += len(data)
        quotes += int(seen[-1]) if len(seen) else 0
    if key is not None:
        yield row()


CUT = pa.schema([("file", pa.string()), ("pos", pa.int64()), ("last", pa.int64()), ("split", pa.int64()), ("text", pa.string())])
CUT_DDL = "file string, pos long, last long, split long, text string"


def _cutter(edges: bool):
    """Element texts of each split: those that lie wholly inside it, or (``edges``)
    the pieces of those that cross its ends."""

    def cut(batches):
        key, inside, depth, pos, started, pending = None, 0, 0, 0, False, []

        def rows(texts, first):
            n = len(texts)
            return pa.RecordBatch.from_arrays([
                pa.array([key[0]] * n), pa.array(range(first, first + n), pa.int64()), pa.array([key[5]] * n, pa.int64()),
                pa.array([key[1]] * n, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string()),
            ], schema=CUT)

        def tail():  # the piece that goes on in the next split, or ends the file
            text = b"".join(pending)
            if edges and (started or text):
                yield rows([text], pos)

        for k, data in _pieces(batches, ("file", "split", "inside", "depth", "pos", "last")):
            if k != key:
                if key is not None:
                    yield from tail()
                key, pending = k, []
                inside, depth, pos, started = int(k[2]), k[3], k[4], k[1] == 0
            at, kind, quotes = structure(data)
            rel, outside = depths(kind, quotes, inside)
            cuts = at[outside & (kind == _COMMA) & (rel + depth == 1)].tolist()
            if cuts:
                pending.append(data[: cuts[0]])
                head = b"".join(pending)
                whole = [data[a + 1 : b] for a, b in zip(cuts, cuts[1:])]
                if not started:  # ends an element of an earlier split
                    if edges and head:
                        yield rows([head], pos)
                elif not edges:
                    yield rows([head], pos)
                if whole and not edges:
                    yield rows(whole, pos + 1)
                pos, started, pending = pos + len(cuts), True, [data[cuts[-1] + 1 :]]
            else:
                pending.append(data)
            if len(rel):
                inside, depth = (inside + int(quotes[-1])) % 2, depth + int(rel[-1])
        if key is not None:
            yield from tail()

    return cut


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", ",").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"),
    )


def split_starts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, split, inside, depth, pos, last): the state in which each split starts,
    the element it starts in, and the file's last element."""
    from ..plans.jobs import stage

    found = stage(_lines(spark, paths).mapInArrow(_summaries, SUMMARY_DDL), "array-splits")
    whole = Window.partitionBy("file")
    before = whole.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    sum_before = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    way = lambda name: F.when(F.col("inside"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))
    s = found.withColumn("inside", sum_before("quotes") % 2 == 1).withColumn("depth", sum_before(way("depth")))
    s = s.withColumn("n", F.coalesce(F.try_element_at(way("commas"), 1 - F.col("depth")), F.lit(0)))
    # bytes the reader leaves out: a comma after the array, a byte order mark
    packed = F.col("file").rlike("\\.(gz|bz2|zst|lz4|snappy|deflate)$")
    short = ~packed & (F.sum("n_bytes").over(whole) != F.col("size"))
    last = F.when(short, _no_list()).otherwise(F.sum("n").over(whole))
    return s.select("file", "split", "inside", "depth", sum_before("n").alias("pos"), last.alias("last"))


def _no_list():
    return F.raise_error(F.concat(F.lit("Dataset file must be a JSON list: "), F.col("file")))


def read_large_arrays(spark: SparkSession, paths) -> DataFrame:
    """JSON-array files of any size -> (file, pos, item, text).

    Rows are those of :func:`sifter.sources.records.read_records`, ``text``
    being the element as written. A file is read in as many tasks as it has
    splits (``spark.sql.files.maxPartitionBytes``), whether it is pretty-printed
    or one line; only one element, not one file, must stay below 2 GB. The
    file is read three times: for the states of its splits, for the elements
    inside splits, and for those that cross them; only the latter are shuffled.

    A file that is not exactly one JSON array fails (no bytes, another value, a
    broken element, text after the array): it is an array if and only if it
    starts with ``[``, ends with ``]`` and every text between the cuts is one
    JSON value. An empty array has no rows. Texts must be UTF-8 without a byte
    order mark. Packed files (gzip and others) are read whole where their codec
    cannot be split; a comma after the array is not noticed in them.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    empty = empty_files(spark, paths)
    if empty:
        raise ValueError(f"Dataset file is empty, not a JSON list: {empty[0]}")
    from ..plans.jobs import stage

    starts = stage(split_starts(spark, paths), "array-starts")
    lines = _lines(spark, paths).drop("size")
    if starts.count() <= SPLITS_BROADCAST:
        lines = lines.join(F.broadcast(starts), ["file", "split"])
    else:  # by shuffle, then back in reading order
        lines = lines.withColumn("_line", F.monotonically_increasing_id())
        lines = lines.join(starts, ["file", "split"]).sortWithinPartitions("file", "split", "_line").drop("_line")
    inner = lines.mapInArrow(_cutter(edges=False), CUT_DDL).drop("split")
    crossing = lines.mapInArrow(_cutter(edges=True), CUT_DDL).groupBy("file", "pos", "last").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "text"))), lambda p: p["text"]), "").alias("text")
    )
    text, first, last = F.col("text"), F.col("pos") == 0, F.col("pos") == F.col("last")
    begin, end = f"^[{JSON_SPACE}]*\\[", f"\\][{JSON_SPACE}]*\\z"
    opened = F.when(~first, text).when(text.rlike(begin), F.regexp_replace(text, begin, "")).otherwise(_no_list())
    closed = F.when(~last, text).when(text.rlike(end), F.regexp_replace(text, end, "")).otherwise(_no_list())
    out = inner.unionByName(crossing).withColumn("text", opened).withColumn("text", closed)
    out = out.withColumn("text", F.btrim("text", F.lit(JSON_SPACE)))
    out = out.filter((F.col("last") > 0) | (F.col("text") != ""))
    item = J.strict_json("text")
    return out.select("file", "pos", F.when(item.isNull(), _no_list()).otherwise(item).alias("item"), "text")
