"""Record sources and sinks.

A dataset is a list of JSON values. On disk it can be one JSON array per file
(the small-scale form), JSON Lines, or Parquet with ``pos`` and the record.
In memory it is ``(file, pos, item VARIANT)``; ``pos`` carries the list order,
so nothing later depends on partition order.
"""
from __future__ import annotations

import json
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import jsonx as J
from .tables import MISSING, empty_files, read_table

SPACE = re.compile(r"[ \t\n\r]*")  # JSON white space


def strict_array(text) -> "F.Column":
    """Elements of a text that is exactly one JSON array, else NULL.

    ``from_json(t, 'array<variant>')`` ignores text after the array (``[1] x``
    parses). The text must also parse inside ``[...]`` and as the value of
    ``{"v": ...}``: a tail can end one wrapper early, never both (the same
    argument as :func:`sifter.functions.jsonx.strict_json`). ``from_json``
    has no size cap, unlike a single VARIANT value.
    """
    t = F.col(text) if isinstance(text, str) else text
    outer = F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<array<variant>>")
    inner = F.from_json(F.concat(F.lit('{"v":'), t, F.lit("}")), "struct<v:array<variant>>")
    return F.when(outer.isNotNull(), inner["v"])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _element_texts(files: pd.Series) -> pd.Series:
    """The elements of JSON-array texts, each as it is written."""
    decoder = json.JSONDecoder()

    def one(text):
        if text is None:
            return None
        out, at = [], SPACE.match(text, text.index("[") + 1).end()
        while text[at] != "]":
            _, end = decoder.raw_decode(text, at)
            out.append(text[at:end])
            at = SPACE.match(text, end).end()
            if text[at] == ",":
                at = SPACE.match(text, at + 1).end()
        return out

    return files.map(one)


def read_records(spark: SparkSession, paths, partitions: int | None = None, with_text: bool = False) -> DataFrame:
    """JSON-array files -> (file, pos, item), or (file, pos, item, text).

    Each file is one task (an array is not splittable), parsed strictly with
    :func:`strict_array`, which keeps scalars, nulls and order. ``text`` is the
    element's own text, numbers and key order as written (cut out by Python's
    scanner in an Arrow UDF). A file that is not
    exactly one JSON array (another value, broken JSON, text after the array,
    no bytes at all) fails, never yields zero rows. A file is one text value,
    so it must stay below 2 GB. Rows are spread over ``partitions`` tasks
    after the explode when there are fewer files than that.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    empty = empty_files(spark, paths)
    if empty:
        raise ValueError(f"Dataset file is empty, not a JSON list: {empty[0]}")
    read = spark.read.text(paths, wholetext=True)
    raw = read.select(F.col("_metadata.file_path").alias("file"), "value")
    arr = strict_array("value")
    checked = raw.select(
        "file",
        F.when(arr.isNull(), F.raise_error(F.concat(F.lit("Dataset file must be a JSON list: "), F.col("file"))))
        .otherwise(arr)
        .alias("item"),
        *([_element_texts(F.when(arr.isNotNull(), F.col("value"))).alias("text")] if with_text else []),
    )
    zipped = F.arrays_zip("item", "text") if with_text else F.arrays_zip("item")
    out = checked.select("file", F.posexplode(zipped).alias("pos", "_e")).select("file", F.col("pos").cast("bigint").alias("pos"), "_e.*")
    n = partitions or spark.sparkContext.defaultParallelism
    return out if len(read.inputFiles()) >= n else out.repartition(n, "file", "pos")


SPLITS_BROADCAST = 100_000  # splits whose line counts are broadcast; beyond, they are joined by shuffle


def read_records_lines(spark: SparkSession, paths, fmt: str = "json") -> DataFrame:
    """JSON Lines (one record per line) or Parquet (pos, item as text/VARIANT).

    -> (file, pos, item, text), ``text`` being the line as written. JSON Lines
    are splittable. ``pos`` is the line's order inside its file (blank lines
    count): its place in the split plus the lines of the splits before. Only
    split line counts are joined to the lines, so the text is not shuffled. A
    line that is not valid JSON becomes a NULL item (later ``invalid_item``).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "parquet":
        df = spark.read.parquet(*paths)
        if dict(df.dtypes).get("item") == "string":
            df = df.withColumn("text", F.col("item")).withColumn("item", J.strict_json(F.col("item")))
        if "file" not in df.columns:
            df = df.withColumn("file", F.col("_metadata.file_path"))
        return df.select("file", F.col("pos").cast("bigint"), "item", *(["text"] if "text" in df.columns else []))
    # A split is read in line order by one task, and its start offset orders
    # the splits of a file; ids rise inside a split, so an id minus the
    # split's least id is the place in the split.
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_line"),
        "value",
    )
    splits = lines.groupBy("file", "_split").agg(F.min("_line").alias("_least"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "_split", "_least", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    few = splits.count() <= SPLITS_BROADCAST
    j = lines.join(F.broadcast(splits) if few else splits, ["file", "_split"])
    return j.filter(~J.is_blank("value")).select(
        "file", (F.col("_off") + F.col("_line") - F.col("_least")).alias("pos"), J.strict_json("value").alias("item"), F.col("value").alias("text")
    )


def write_records(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite", item: str = "item", text: str = "text") -> None:
    """Write records (S3).

    ``jsonl``: one record per line (what :func:`read_records_lines` reads): the
    ``text`` column where there is one, so numbers and key order stay as they
    were written, else the VARIANT rendered as JSON (numbers normalised, keys
    sorted). ``json``: one JSON object per row with every column (VARIANT
    columns as JSON text). ``parquet``. Spark's writers leave non-ASCII
    characters unescaped.
    """
    types = dict(df.dtypes)
    if fmt == "jsonl":
        rendered = F.to_json(item) if types.get(item) == "variant" else F.col(item)
        # a record written over several lines takes one here
        own = F.when(~F.col(text).contains("\n") & ~F.col(text).contains("\r"), F.col(text)) if text in types else F.lit(None).cast("string")
        one_line = J.minify_json(F.col(text)) if text in types else F.lit(None).cast("string")
        df.select(F.coalesce(own, one_line, rendered).alias("value")).write.mode(mode).text(path)
        return
    out = df
    if fmt == "json":
        out = df.select(*[F.to_json(c).alias(c) if t == "variant" else F.col(c) for c, t in df.dtypes])
    out.write.mode(mode).format(fmt).save(path)


def append_batch(base: DataFrame, batch: DataFrame) -> DataFrame:
    """Append ``batch`` after ``base``; batch positions follow the base.

    The offset is ``max(base.pos) + 1`` (the base count when dense) taken as a
    scalar subquery: one number, no join. Items are not validated, as in the
    contract. Columns are matched by name.
    """
    offset = base.select(F.coalesce(F.max("pos") + 1, F.lit(0)).cast("bigint")).scalar()
    shifted = batch.withColumn("pos", F.col("pos") + offset)
    return base.unionByName(shifted, allowMissingColumns=True)


@dataclass(frozen=True)
class Appended:
    """What :func:`append_batch_to` did: rows appended, rows now held, the table."""

    appended: int
    total: int
    table: DataFrame


def _array_target(spark: SparkSession, path: str, on_corrupt: str, columns: list[str]) -> DataFrame | None:
    """Rows of the JSON-array files at ``path``; None if there are none or, by ``on_corrupt="empty"``, if they are no JSON."""
    try:
        files = spark.read.text(path, wholetext=True)
        files.schema  # noqa: B018 - resolved now: a missing path shows here
    except PySparkException as exc:
        if MISSING in str(exc):
            return None
        raise
    # not a list: either valid JSON of another kind, or not JSON at all
    bad = files.filter(strict_array("value").isNull()).select(J.strict_json(F.col("value")).isNotNull().alias("json"))
    kinds = {r["json"] for r in bad.distinct().collect()}  # at most two booleans
    if True in kinds:
        raise ValueError(f"Dataset file is not a JSON list: {path}")
    if False in kinds:
        if on_corrupt != "empty":
            raise ValueError(f"Dataset file is not valid JSON: {path}")
        return None
    return read_records(spark, path, with_text="text" in columns).select(*[c for c in ("file", "pos", "item", "text") if c in columns])


def append_batch_to(spark: SparkSession, path: str, batch: DataFrame, on_corrupt: str = "fail", fmt: str = "parquet", write_to: str | None = None) -> Appended:
    """Append ``batch`` to the dataset at ``path`` and write it.

    ``fmt="parquet"``: the batch's rows, with positions after the last one
    held, are added as new files; rows already there are not rewritten. A
    missing target counts as empty. A corrupt one fails unless
    ``on_corrupt="empty"`` (the small-scale tool silently started over, losing
    the old rows; available, never the default), which replaces it.
    ``fmt="array"`` reads JSON-array files: a target that is valid JSON but no
    list always fails. Such a file can't take rows, so the whole dataset is
    written as Parquet to ``write_to``, which is required.
    """
    if fmt == "array":
        if write_to is None:
            raise ValueError("an array file can't be appended to in place: give write_to")
        base = _array_target(spark, path, on_corrupt, batch.columns)
        append_batch(batch.limit(0) if base is None else base, batch).write.mode("errorifexists").parquet(write_to)
        path, appended = write_to, batch.count()
    else:
        base = read_table(spark, path, corrupt_as_none=on_corrupt == "empty")
        offset = 0 if base is None else base.select(F.coalesce(F.max("pos") + 1, F.lit(0)).cast("bigint")).first()[0]
        fresh = base is None
        out = batch.withColumn("pos", F.col("pos") + F.lit(offset).cast("bigint"))
        appended = batch.count()
        out.write.mode("overwrite" if fresh else "append").parquet(path)
    table = spark.read.parquet(path)
    return Appended(appended, table.count(), table)


BATCH_ID = re.compile(r"[A-Za-z0-9-][A-Za-z0-9_-]*")  # a folder name that readers do not hide


def append_once(spark: SparkSession, path: str, batch: DataFrame, batch_id: str) -> Appended:
    """Append ``batch`` to the Parquet dataset at ``path`` under a name of its own.

    The rows are one folder ``batch_id=<name>``, whose success mark says that
    it is whole. A replay of a whole batch writes nothing and does not compute
    ``batch``; what a stopped run left of one is replaced. Positions follow
    those of all other batches, so a batch that is written again after a later
    one comes behind it. Appends must not run at the same time: both would
    start at the same position.

    -> rows of this batch, rows now held, the table (with ``batch_id``). An
    empty batch is a batch of no rows; NULL positions stay NULL.
    """
    if not BATCH_ID.fullmatch(batch_id):
        raise ValueError(f"not a batch name (letters, digits, - and _): {batch_id!r}")
    if "batch_id" in batch.columns:
        raise ValueError("the batch has a column batch_id, which names the batches here")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    folder = f"{path.rstrip('/')}/batch_id={batch_id}"
    own = F.col("batch_id") == batch_id
    held = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("batch_id", T.StringType())]))
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
        last = held.parquet(path).filter(~own).agg(F.max("pos")).first()[0] if fs.exists(root) else None
        offset = F.lit(0 if last is None else last + 1).cast("bigint")
        batch.withColumn("pos", F.col("pos") + offset).write.mode("overwrite").parquet(folder)
    table = held.parquet(path)
    n = table.agg(F.count_if(own).alias("own"), F.count(F.lit(1)).alias("every")).first()
    return Appended(n["own"], n["every"], table)
