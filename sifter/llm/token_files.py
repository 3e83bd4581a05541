"""Token ids as binary files: frequency-ranked, variable-length, byte-aligned.

Every text is encoded and ended with an end id. Ids are replaced by their rank
in the corpus (the most frequent is 0) and written with 1 to 4 bytes each; the
2-bit lengths of four values share a control byte, and control bytes stand
apart from the data, so that a block is decoded by numpy table lookups without
a branch.

File format (little-endian). ``ids/part-NNNNN-*.txt``: blocks, each followed
by one newline byte, documents in ascending id over the files in name order::

    4 bytes  magic "FRV1"
    u32      documents d        u64  ids n        u64  data bytes m
    i64[d]   document ids       u8[d]  1 where the document id is NULL
    u32[d]   ids of each document
    u8[..]   control bytes, ceil(ids / 4) for each document, lowest bits first:
             bytes of the value - 1 (0 in places without a value)
    u8[m]    ranks, lowest byte first

``ranks/``: the same block form with one document that holds the vocabulary's
ids in order of rank, each coded as it is.

Both are written by Spark's own sink (task commit, any file system) as rows of
raw bytes and read back with its binary file source.
"""
from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.seq import running
from .common import drop_staged, stage, text_or_empty

END_ID = 2
MAGIC = b"FRV1"
BLOCK_IDS = 1 << 16  # a block ends with the document that reaches so many ids
FILE_IDS = 1 << 23  # ids aimed at in one file: a reading task holds a file several times over
KEPT = 1 << 18  # pieces of a generation that a worker remembers
CHUNK_CHARS = 1 << 21  # text encoded at once; a longer text is a chunk of its own
_HEAD = "<4sIQQ"

# Decoding tables, by control byte: the four lengths.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
_MASK = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit ``values``."""
    v = np.ascontiguousarray(values, "<u4")
    size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    codes = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    codes[: len(v)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.tobytes(), data.tobytes()


def unpack_values(control: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The values of :func:`pack_values`, laid end to end, of documents of ``lengths`` values."""
    slots = -(-lengths // 4) * 4
    size = _LENGTHS[control].reshape(-1)
    if len(size):
        filled = np.repeat(np.cumsum(slots) - slots + lengths, slots) > np.arange(len(size))
        size = size[filled]
    at = np.cumsum(size, dtype=np.int64) - size
    d = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    words = d[at] | d[at + 1] << np.uint32(8) | d[at + 2] << np.uint32(16) | d[at + 3] << np.uint32(24)
    return words & _MASK[size]


def write_block(docs: list[int | None], lengths: list[int], control: list[bytes], data: list[bytes]) -> bytes:
    """A block of documents whose values :func:`pack_values` has packed."""
    head = struct.pack(_HEAD, MAGIC, len(docs), sum(lengths), sum(map(len, data)))
    ids = np.array([d or 0 for d in docs], "<i8").tobytes()
    null = np.array([d is None for d in docs], np.uint8).tobytes()
    return b"".join([head, ids, null, np.array(lengths, "<u4").tobytes(), *control, *data])


def read_blocks(raw: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(document ids, values of each, values) of every block of a file."""
    at, view = 0, np.frombuffer(raw, np.uint8)
    while at < len(raw):
        magic, d, n, m = struct.unpack_from(_HEAD, raw, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        at += struct.calcsize(_HEAD)
        ids = np.frombuffer(raw, "<i8", d, at).tolist()
        null = view[at + 8 * d : at + 9 * d]
        lengths = np.frombuffer(raw, "<u4", d, at + 9 * d).astype(np.int64)
        at += 13 * d
        control = view[at : at + int((-(-lengths // 4)).sum())]
        at += len(control)
        values = unpack_values(control, view[at : at + m], lengths)
        if len(values) != n:
            raise ValueError("a block's lengths do not add up")
        at += m + 1  # the newline after the block
        yield [None if x else i for i, x in zip(ids, null)], lengths, values


class WordIds:
    """Ids of whole texts, by the pieces that the tokenizer itself splits them into.

    The tokenizer lower-cases, drops white space and joins nothing across the
    pieces of its split (letter runs, single digits, runs of signs), so a text's
    ids are those of its pieces in order. The pieces of a batch are numbered by
    Arrow; each distinct one is looked up among those that the worker has met
    lately, new ones go to the tokenizer, and numpy lays the ids out.
    The split is repeated here for texts of plain characters (``NOT_PLAIN``),
    whose classes and lower case are beyond doubt. Of other texts, and of those
    that may spell a special token, the words between white space go to the
    tokenizer as they are.
    """

    # Characters of plain texts, the tokenizer's own split in classes of those, its word-end mark, its special tokens' start.
    NOT_PLAIN = re.compile("[^\t-\r -~\xa1-\u012f\u0131-\u024f\u2010-\u2027\u20ac]")
    _LETTER, _NUMBER = "a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe"
    PIECE = f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\t-\r {_LETTER}{_NUMBER}]+"
    WORDS = re.compile(r"[^ \t\n\x0b\x0c\r]+")
    WORD_END = "</w>"
    SPECIAL = "<|"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values(), default=0) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith(self.WORD_END)]] = True
        self.now: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}  # the generation before

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Encode distinct plain pieces. They are split and in lower case already, so
        those in ASCII, whose bytes are their own letters, go to the tokenizer's model
        itself; others go through all of it, as one spaced text, and each ends with
        its word-end token."""
        encode = self.tokenizer.model.tokenize
        self.now.update((p, np.array([t.id for t in encode(p)], "<u4").tobytes()) for p in pieces if p.isascii())
        others = [p for p in pieces if not p.isascii()]
        for i in range(0, len(others), 4096):
            new = others[i : i + 4096]
            ids = np.array(self.tokenizer.encode(" ".join(new), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(new):
                self.now.update((p, self._whole(p)) for p in new)
                continue
            raw, start = ids.tobytes(), 0
            for piece, end in zip(new, (4 * cuts).tolist()):
                self.now[piece] = raw[start:end]
                start = end

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        if len(self.now) > KEPT:
            self.now, self.before = {"": b""}, self.now
        now, before = self.now, self.before
        self._learn([p for p in pieces if p not in now and not (p in before and now.setdefault(p, before[p]) is not None)])
        return [now[p] for p in pieces]

    def _of_words(self, text: str) -> np.ndarray:
        words = self.WORDS.findall(text)
        own = {w: self._whole(w) for w in set(words)}
        return np.frombuffer(b"".join([own[w] for w in words]), "<u4")

    def _of_plain(self, texts: list[str]) -> list[np.ndarray]:
        spaced = pc.replace_substring_regex(pa.array([t.lower() for t in texts], pa.large_string()), self.PIECE, "\\0 ")
        split = pc.ascii_split_whitespace(spaced)
        numbered = split.flatten().dictionary_encode()
        if not len(numbered):
            return [np.empty(0, "<u4") for _ in texts]
        ids = self._ids_of(numbered.dictionary.to_pylist())
        of, size = numbered.indices.to_numpy(), np.array([len(x) // 4 for x in ids])
        first, flat = np.cumsum(size) - size, np.frombuffer(b"".join(ids), "<u4")
        n = size[of]
        ends = np.concatenate([[0], np.cumsum(n)])
        laid = flat[np.repeat(first[of] - ends[:-1], n) + np.arange(ends[-1])]
        cuts = ends[split.offsets.to_numpy()]
        return [laid[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        plain = [i for i, t in enumerate(texts) if not (self.NOT_PLAIN.search(t) or self.SPECIAL in t)]
        out = dict(zip(plain, self._of_plain([texts[i] for i in plain]))) if plain else {}
        return [out[i] if i in out else self._of_words(t) for i, t in enumerate(texts)]


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _kind(width: int) -> str:
    return f"<u{width}"


def encode_texts(docs: DataFrame, path: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, width, ids): the ids of every whole text (NULL: empty)
    with the end id, as little-endian unsigned integers of ``width`` bytes (2 if
    the vocabulary allows it, else 4)."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _word_ids(path)
        width = 2 if max(encode.size, end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], _kind(width))
        for b in batches:
            texts = b.column(1).to_pylist()
            lo = 0
            while lo < len(texts):
                hi, size = lo + 1, len(texts[lo])
                while hi < len(texts) and size + len(texts[hi]) <= CHUNK_CHARS:
                    size += len(texts[hi])
                    hi += 1
                ids = [np.concatenate([x.astype(_kind(width)), end]) for x in encode(texts[lo:hi])]
                cols = [b.column(0).slice(lo, hi - lo), pa.array([len(x) for x in ids], pa.int64()), pa.array([width] * len(ids), pa.int32())]
                cols.append(pa.array([x.tobytes() for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "width", "ids"])
                lo = hi

    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("t"))
    return d.mapInArrow(run, "doc_id bigint, n_tokens bigint, width int, ids binary")


def id_counts(encoded: DataFrame) -> DataFrame:
    """(id, n): occurrences of each id; tasks count in a vector as long as the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(0, np.int64)
        for b in batches:
            for width, x in zip(b.column(0).to_pylist(), b.column(1)):
                more = np.bincount(np.frombuffer(x.as_py(), _kind(width)), minlength=len(n))
                more[: len(n)] += n
                n = more
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], ["id", "n"])

    return encoded.select("width", "ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def rank_order(encoded: DataFrame) -> np.ndarray:
    """Ids in order of frequency, ties to the smaller id (at most one entry per vocabulary entry)."""
    rows = id_counts(encoded).collect()
    return np.array([r["id"] for r in sorted(rows, key=lambda r: (-r["n"], r["id"]))], "<u4")


def write_ids(encoded: DataFrame, order: np.ndarray, path: str, files: int) -> None:
    """Write ``encoded`` (staged by the caller) under ``path`` in ascending id
    over ``files`` files; rows that share an id are ordered by a hash of their
    ids and then the ids themselves, so a repeated id is spread over files too."""
    rank = np.zeros(int(order.max()) + 1 if len(order) else 1, "<u4")
    rank[order] = np.arange(len(order), dtype="<u4")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def block():
            return pa.RecordBatch.from_arrays([pa.array([write_block(*zip(*held))], pa.binary())], ["block"])

        for b in batches:
            for d, width, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                ids = np.frombuffer(x.as_py(), _kind(width))
                held.append((d, len(ids), *pack_values(rank[ids])))
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    keyed = encoded.select("doc_id", "width", "ids", F.xxhash64("ids").alias("_h"))
    ordered = keyed.repartitionByRange(files, "doc_id", "_h").sortWithinPartitions("doc_id", "_h", "ids").drop("_h")
    _write_raw(ordered.mapInArrow(blocks, "block binary"), f"{path}/ids")
    control, data = pack_values(order)
    table = encoded.sparkSession.createDataFrame([(write_block([0], [len(order)], [control], [data]),)], "block binary")
    _write_raw(table, f"{path}/ranks")


def _write_raw(blocks: DataFrame, path: str) -> None:
    """Rows of raw bytes, a newline after each: the text sink writes a string's bytes as they are."""
    blocks.select(F.col("block").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "none").text(path)


def read_ids(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """Decode the files under ``path``: (doc_id, start, n_tokens, ids_crc32[, ids]),
    where ``start`` counts the ids of all documents before."""
    blob = spark.read.format("binaryFile").load(f"{path}/ranks").filter("length > 0").select("content")
    order = next(read_blocks(bytes(blob.first()[0])))[2]  # one entry per vocabulary entry at most
    fields = "file string, offset bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, raw in zip(b.column(0).to_pylist(), b.column(1)):
                at = 0
                for docs, lengths, values in read_blocks(raw.as_py()):
                    ids = memoryview(order[values].astype("<u4").tobytes())
                    ends = np.cumsum(lengths, dtype=np.int64)
                    cut = [ids[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                    cols = [
                        pa.array([name] * len(docs)), pa.array(ends - lengths + at), pa.array(docs, pa.int64()),
                        pa.array(lengths), pa.array([zlib.crc32(c) for c in cut], pa.int64()),
                    ]
                    if keep_ids:
                        cols.append(pa.array([bytes(c) for c in cut], pa.binary()))
                    yield pa.RecordBatch.from_arrays(cols, ["file", "offset", "doc_id", "n_tokens", "ids_crc32", "ids"][: len(cols)])
                    at += int(ends[-1])

    files = spark.read.format("binaryFile").load(f"{path}/ids")
    number = F.regexp_extract("path", r"part-(\d+)", 1)
    # one row of a file is its whole content, so a task takes one file at a time
    rows = files.filter("length > 0").select(number.alias("file"), "content").mapInArrow(run, fields)
    rows = stage(rows, "token-rows")
    # one row a file, summed in two levels
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("_n")).withColumn("_no", F.col("file").cast("bigint"))
    firsts = running(totals, [], ["_no"], F.shiftright("_no", 10), sums={"_end": F.col("_n")})
    firsts = firsts.select("file", (F.col("_end") - F.col("_n")).alias("_first"))
    out = rows.join(firsts, "file").withColumn("start", (F.col("_first") + F.col("offset")).cast("bigint"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if keep_ids else []))


def token_files(
    docs: DataFrame, out: str, path: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS
) -> None:
    """Encode every whole text of ``docs`` and write the files of this format under ``out``.

    NULL and empty texts are a document of the end id alone. Very long texts are
    one block of their own. NULL ids come first and stay NULL; repeated rows are
    documents of their own, in an order that their content alone decides. An
    empty table gives no block. Other columns are not read.
    """
    encoded = stage(encode_texts(docs, path, end_id, id_col, text_col), "token-ids")
    total = encoded.agg(F.sum("n_tokens")).first()[0] or 0
    write_ids(encoded, rank_order(encoded), out, max(1, -(-int(total) // file_ids)))
    drop_staged(docs.sparkSession, encoded)


def token_report(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read them back:
    (doc_id, start, n_tokens, ids_crc32); see :func:`token_files` for the cases."""
    import uuid

    from ..session import checkpoint_dir

    spark = docs.sparkSession
    out = f"{checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex[:12]}"
    token_files(docs, out, path, **options)
    return read_ids(spark, out)
