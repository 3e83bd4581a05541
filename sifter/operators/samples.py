"""Records -> masked, truncated, split, batched and padded token samples.

Input: ``(pos, instruction, input, output)`` text columns. Every step up to
the split is row-local (projections and array higher-order functions inside
codegen). The split and the batches need a dense order over the whole table,
taken with :func:`sifter.operators.rank.global_rank` (no single-partition
window). Padding is a window per batch, and a batch holds at most
``batch_size`` rows.
"""
from __future__ import annotations

import json
import math
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import jsonx as J
from ..functions.jsonx import ustrip
from .clean import once
from .rank import global_rank, pos_bucket
from .select import find_cut, flag_first

# Defaults of the sample builder.
DEFAULT_SYSTEM_PROMPT = "You are a helpful assistant."
IGNORE_INDEX = -100
MAX_LENGTH = 1024
EVAL_RATIO = 0.02
SPLIT_SEED = 42

# A chat template: per-role prefix and suffix, plus the generation prompt and
# the end-of-sequence text appended to answers. This one is ChatML; pass your
# tokenizer's own template to ``render_prompt``.
CHATML = {
    "prefix": {"system": "<|im_start|>system\n", "user": "<|im_start|>user\n", "assistant": "<|im_start|>assistant\n"},
    "suffix": "<|im_end|>\n",
    "generation": "<|im_start|>assistant\n",
    "eos": "<|im_end|>",
}

MESSAGE = "array<struct<role:string,content:string>>"


def normalize(df: DataFrame) -> DataFrame:
    """Add stripped ``instruction``/``input``/``output`` and ``drop_reason``.

    Missing instruction/input become ""; a missing output drops the record
    (``output_missing``), as does one that is blank after stripping
    (``output_blank``). A ``drop_reason`` that the rows already have stays.
    """
    ins = ustrip(F.coalesce(F.col("instruction"), F.lit("")))
    inp = ustrip(F.coalesce(F.col("input"), F.lit("")))
    out = ustrip(F.col("output"))
    staged = df.withColumn("instruction", ins).withColumn("input", inp).withColumn("output", out)
    reason = F.when(F.col("output").isNull(), "output_missing").when(F.col("output") == "", "output_blank")
    known = F.col("drop_reason") if "drop_reason" in df.columns else F.lit(None).cast("string")
    return staged.withColumn("drop_reason", F.coalesce(known, reason))


def _falsy(v: Column) -> Column:
    """Python falsiness of a JSON value: null or absent, "", 0, false, [] or {}."""
    sv = F.schema_of_variant(v)
    is_str, is_bool = sv == "STRING", sv == "BOOLEAN"
    is_arr, is_obj = sv.startswith("ARRAY<"), sv.startswith("OBJECT<")
    is_num = ~(is_str | is_bool | is_arr | is_obj | (sv == "VOID"))
    empty = (
        (is_str & (F.try_variant_get(v, "$", "string") == ""))
        | (is_bool & ~F.try_variant_get(v, "$", "boolean"))
        | (is_num & (F.try_variant_get(v, "$", "double") == 0))
        | (is_arr & (F.size(F.try_variant_get(v, "$", "array<variant>")) == 0))
        | (is_obj & (F.size(F.try_variant_get(v, "$", "map<string,variant>")) == 0))
    )
    return v.isNull() | (sv == "VOID") | F.coalesce(empty, F.lit(False))


def records_from_items(raw: DataFrame, item: str = "item") -> DataFrame:
    """Raw records (VARIANT items) -> stripped text columns + ``drop_reason``.

    Non-object items are dropped (``invalid_item``); a null or absent output
    drops the record (``output_missing``), a blank one too (``output_blank``);
    falsy instruction/input values (null, "", 0, false, [], {}) become "".
    Other non-string values become JSON text (the small-scale tool used
    Python ``str()``).
    """
    it = F.col(item)
    keys = [c for c in ("file", "pos") if c in raw.columns]

    def text(v: Column) -> Column:
        return F.when(J.is_kind(v, "string"), F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))

    ins, inp, out = J.field(it, "instruction"), J.field(it, "input"), J.field(it, "output")
    staged = once(
        raw.select(
            *keys,
            J.is_kind(it, "object").alias("_obj"),
            F.when(_falsy(ins), F.lit("")).otherwise(text(ins)).alias("instruction"),
            F.when(_falsy(inp), F.lit("")).otherwise(text(inp)).alias("input"),
            F.when(out.isNotNull() & ~J.is_kind(out, "null"), text(out)).alias("output"),
        )
    )
    n = normalize(staged)
    reason = F.when(~F.col("_obj"), F.lit("invalid_item")).otherwise(F.col("drop_reason"))
    return n.withColumn("drop_reason", reason).drop("_obj")


def _msg(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def build_messages(
    df: DataFrame,
    system_prompt: str | None = DEFAULT_SYSTEM_PROMPT,
    instruction_as_system: bool = False,
) -> DataFrame:
    """Add ``messages`` (array of role/content) to normalised rows.

    Merged mode: optional system prompt, then one user message of
    instruction + blank line + input; the instruction is left out when it
    equals the stripped system prompt. Instruction-as-system mode needs both
    parts. Rows that cannot form a prompt get ``drop_reason``.
    """
    ins, inp = F.col("instruction"), F.col("input")
    if instruction_as_system:
        ok = (ins != "") & (inp != "")
        msgs = F.array(_msg("system", ins), _msg("user", inp))
        reason = F.when(~ok, "empty_prompt")
    else:
        use_ins = ins != ""
        if system_prompt:
            use_ins = use_ins & (ins != F.lit(system_prompt.strip()))
        merged = (
            F.when(use_ins & (inp == ""), ins)
            .when(use_ins, F.concat(ins, F.lit("\n\n"), inp))
            .otherwise(inp)
        )
        head = [_msg("system", F.lit(system_prompt))] if system_prompt else []
        msgs = F.array(*head, _msg("user", merged))
        reason = F.when(merged == "", "empty_prompt")
    return df.withColumn("drop_reason", F.coalesce(F.col("drop_reason"), reason)).withColumn(
        "messages", F.when(F.col("drop_reason").isNull(), msgs)
    )


def render_prompt(df: DataFrame, template: dict = CHATML) -> DataFrame:
    """Add ``prompt`` (messages through the chat template plus the generation
    prompt) and ``answer`` (output + end-of-sequence text) (T4, T5)."""
    pre = F.create_map(*[x for r, p in template["prefix"].items() for x in (F.lit(r), F.lit(p))])

    def prefix(role: Column) -> Column:
        # a role that the template lacks must not vanish from the prompt
        return F.coalesce(F.try_element_at(pre, role), F.raise_error(F.concat(F.lit("Role not in the chat template: "), role)).cast("string"))

    body = F.array_join(
        F.transform("messages", lambda m: F.concat(prefix(m["role"]), m["content"], F.lit(template["suffix"]))),
        "",
    )
    return df.withColumn("prompt", F.concat(body, F.lit(template["generation"]))).withColumn(
        "answer", F.concat(F.col("output"), F.lit(template["eos"]))
    )


def code_points(c: Column) -> Column:
    """Text -> array of Unicode code points (the default encoder, T6); no text, no tokens."""
    return F.when(c == "", F.array().cast("array<int>")).otherwise(F.transform(F.split(c, ""), lambda ch: F.ascii(ch)))


def tokenizer_udf(fn: Callable[[list[str]], list[list[int]]]):
    """Wrap a batch tokenizer (texts -> id lists) as an Arrow pandas UDF (T6 hook)."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def _enc(s: pd.Series) -> pd.Series:
        return pd.Series(fn(s.tolist()))

    return _enc


WORDS_KEPT = 1 << 17  # words whose ids a Python worker keeps
LONG_WORD = 64  # characters from which a word's ids are not kept
# White space and what follows it, up to the next white space. U+001C to U+001F are white space to Python alone.
_WORD = re.compile("\\s*[\\S\x1c-\x1f]+|\\s+")


def _splits_at_spaces(tokenizer) -> bool:
    """Whether ids of a text are those of its words (``_WORD``) in order: a
    byte-level BPE whose own split has white space at the start of pieces alone,
    with nothing before or after it that reads across words."""
    spec = json.loads(tokenizer.to_str())
    split, model = spec["pre_tokenizer"] or {}, spec["model"]
    return (
        split.get("type") == "ByteLevel" and split.get("use_regex") is True and split.get("add_prefix_space") is False
        and model.get("type") == "BPE" and not model.get("dropout")
        and not any(spec.get(k) for k in ("normalizer", "truncation", "padding"))
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search("\\s", t["content"]) for t in spec["added_tokens"])
    )


class _Vocabulary:
    """Ids of texts by a tokenizer, as bytes of int32. Where the tokenizer allows
    it, each distinct word of a run of texts goes to it once, and ids of words
    met lately are kept; else it gets the texts."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.by_word = _splits_at_spaces(tokenizer)
        self.kept: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.int32).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._whole(texts)
        if len(self.kept) > WORDS_KEPT:
            self.kept = {}
        words = [_WORD.findall(t) for t in texts]
        new = list(set().union(*words).difference(self.kept))
        self.kept.update(zip(new, self._whole(new)))
        out = [b"".join(map(self.kept.__getitem__, w)) for w in words]
        for w in new:
            if len(w) > LONG_WORD:
                del self.kept[w]
        return out


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> _Vocabulary:
    """The tokenizer of a vocabulary file, loaded once per Python worker; one thread, as Spark fills the cores."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return _Vocabulary(Tokenizer.from_file(path))


BATCH_CHARS = 1 << 22  # characters given to the tokenizer at once


def _text_groups(texts: list):
    """``texts`` in runs of about ``BATCH_CHARS`` characters (a longer text is a run of its own)."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > BATCH_CHARS:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def vocabulary_encoder(path: str):
    """Encoder for :func:`encode` from a ``tokenizers`` vocabulary file.

    An Arrow iterator UDF: each Python worker loads ``path`` (a file that every
    executor has) once and keeps it over batches and tasks. No special tokens
    are added, as the chat template writes its own. NULL stays NULL, empty text
    has no tokens, and a text of any length is encoded whole.
    """

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def _ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = _vocabulary(path)
        for texts in batches:
            ids, ends = [], [np.zeros(1, np.int64)]
            for run in _text_groups(texts.fill_null("").to_pylist()):
                found = vocabulary(run)
                ends.append(ends[-1][-1] + np.cumsum([len(f) // 4 for f in found], dtype=np.int64))
                ids.extend(found)
            offsets = np.concatenate(ends)
            values = pa.array(np.frombuffer(b"".join(ids), np.int32))
            mask = texts.is_null() if texts.null_count else None
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=mask)

    return _ids


def encode(df: DataFrame, encoder: Callable[[Column], Column] = code_points, max_length: int = MAX_LENGTH) -> DataFrame:
    """Encode prompt and answer, mask the prompt, keep the last ``max_length``
    tokens, drop samples with nothing left to learn (T6-T9).

    Adds ``input_ids``, ``attention_mask``, ``labels`` (equal-length int
    arrays) and the prompt/answer token counts.
    """
    if max_length < 1:
        raise ValueError("max_length must be at least 1")
    none = F.lit("")  # rows dropped before have no prompt, and no tokens
    staged = once(df.withColumn("_p", encoder(F.coalesce("prompt", none))).withColumn("_a", encoder(F.coalesce("answer", none))))
    ids = F.concat(F.col("_p"), F.col("_a"))
    labels = F.concat(F.array_repeat(F.lit(IGNORE_INDEX), F.size("_p")), F.col("_a"))

    def tail(x: Column) -> Column:
        start = F.greatest(F.size(x) - max_length, F.lit(0)) + 1
        return F.slice(x, start, F.lit(max_length))

    staged = staged.select(
        *[c for c in df.columns],
        F.size("_p").alias("n_prompt"),
        F.size("_a").alias("n_answer"),
        tail(ids).alias("input_ids"),
        tail(labels).alias("labels"),
    )
    learn = F.exists("labels", lambda x: x != IGNORE_INDEX)
    return staged.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids"))).withColumn(
        "drop_reason", F.coalesce(F.col("drop_reason"), F.when(~learn, "all_masked"))
    )


def build_samples(
    records: DataFrame,
    max_length: int = MAX_LENGTH,
    system_prompt: str | None = DEFAULT_SYSTEM_PROMPT,
    instruction_as_system: bool = False,
    template: dict = CHATML,
    encoder: Callable[[Column], Column] = code_points,
):
    """Whole sample build -> ``(samples, drops)``.

    ``samples``: pos (and file, if the records have one), n_tokens, n_masked
    (leading tokens with no label), input_ids, attention_mask, labels.
    ``drops``: one row per drop reason with its count (map-side partial
    aggregation). Records may come with a ``drop_reason`` of their own
    (:func:`records_from_items`); it is kept and counted.
    """
    keys = [c for c in ("file", "pos") if c in records.columns]
    known = [c for c in ("drop_reason",) if c in records.columns]
    # a reason is computed once per step: a filter on it would else be pushed below, and copy, all steps before
    n = once(normalize(records.select(*keys, "instruction", "input", "output", *known)))
    m = once(build_messages(n, system_prompt, instruction_as_system))
    enc = once(encode(render_prompt(m, template), encoder, max_length))
    samples = enc.filter(F.col("drop_reason").isNull()).select(
        *keys,
        F.size("input_ids").alias("n_tokens"),
        F.size(F.filter("labels", lambda x: x == IGNORE_INDEX)).alias("n_masked"),
        "input_ids",
        "attention_mask",
        "labels",
    )
    drops = enc.filter(F.col("drop_reason").isNotNull()).groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))
    return samples, drops


def split_exact(df: DataFrame, ratio: float = EVAL_RATIO, seed: int = SPLIT_SEED) -> DataFrame:
    """Add ``split``: exactly ``floor(n * ratio)`` rows are ``eval``, the rest ``train``.

    Eval rows are the first by ``md5(seed:pos)`` (ties by the whole row), so the
    split is the same for any partitioning. The place of the cut comes from
    histograms of the hash (:mod:`.select`), so rows are compared with it and
    only the few at the cut are sorted: no exchange of all rows.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("pos").cast("string"), F.lit(""))))
    cut = find_cut(df, h, lambda n: math.floor(n * float(ratio)), 32)
    flagged = flag_first(df, h, cut, "_eval")
    return flagged.withColumn("split", F.when(F.col("_eval"), "eval").otherwise("train")).drop("_eval")


def assign_batches(df: DataFrame, size: int, within: list[str] | None = None) -> DataFrame:
    """Add ``batch_id``: consecutive runs of ``size`` rows in ``pos`` order."""
    ranked = global_rank(df, ["pos"], pos_bucket("pos"), within=within, name="_r")
    return ranked.withColumn("batch_id", F.floor((F.col("_r") - 1) / size).cast("bigint")).drop("_r")


def split_sizes(df: DataFrame) -> DataFrame:
    """Rows per split (A4)."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def dense_positions(samples: DataFrame) -> DataFrame:
    """Replace (file, pos) by one dense ``pos`` over all files, so that rows of
    many files never share a position. Files follow each other in hash order,
    rows of a file in ``pos`` order; rows without a ``file`` are ordered by
    ``pos`` alone. Repeated positions get their own numbers, NULL ones come first."""
    part = pos_bucket("pos")
    if "file" in samples.columns:
        h = F.shiftrightunsigned(F.xxhash64("file"), 33)
        placed = global_rank(samples, [h, part, "file", "pos"], [h, part], name="_r").drop("file")
    else:
        placed = global_rank(samples, ["pos"], part, name="_r")
    return placed.withColumn("pos", F.col("_r") - 1).drop("_r")


def collate_plan(samples: DataFrame, batch_size: int, ratio: float = EVAL_RATIO, seed: int = SPLIT_SEED) -> DataFrame:
    """Split, batches and batch widths from the narrow columns only.

    Reads ``pos`` and ``n_tokens`` (from a written samples table that is a
    column-pruned scan), so the ranking shuffles move two numbers per row,
    not the token arrays. ``pos`` must be unique (:func:`dense_positions`).
    Output: pos, split, batch_id, width.
    """
    keys = samples.select("pos", "n_tokens")
    planned = assign_batches(split_exact(keys, ratio, seed), batch_size, within=["split"])
    w = Window.partitionBy("split", "batch_id")
    return planned.withColumn("width", F.max("n_tokens").over(w)).drop("n_tokens")


def collate(samples: DataFrame, plan: DataFrame, pad_id: int | None = 0, eos_id: int | None = None) -> DataFrame:
    """Join the plan to the samples (the one shuffle that moves tokens) and
    right-pad every row to its batch width (T13): ids with ``pad_id``
    (``eos_id`` when there is no pad id), attention with 0, labels with -100.

    Only ``pos``, ``n_masked`` and ``input_ids`` cross the shuffle: the mask
    and the labels follow from them.
    """
    pad = pad_id if pad_id is not None else eos_id
    if pad is None:
        raise ValueError("need a pad id or an eos id")
    j = samples.select("pos", "n_masked", "input_ids").join(plan, "pos", "inner")
    n = F.size("input_ids")
    gap = F.col("width") - n
    learn = F.slice("input_ids", F.col("n_masked") + 1, n - F.col("n_masked"))
    return j.select(
        "pos",
        "split",
        "batch_id",
        "width",
        F.concat("input_ids", F.array_repeat(F.lit(pad), gap)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), gap)).alias("attention_mask"),
        F.concat(F.array_repeat(F.lit(IGNORE_INDEX), F.col("n_masked")), learn, F.array_repeat(F.lit(IGNORE_INDEX), gap)).alias("labels"),
    )
