"""Generated-response parsing: envelope -> content -> items + per-response stats.

Input: ``responses(run_id, request_id, body)`` where ``body`` is the chat
completion envelope as text. Everything is row-local except the per-run
rollup (A2), which is a partial + final hash aggregate.
"""
from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import jsonx as J
from ..functions import text as X
from .clean import RECORD_KEYS, once

# Envelope error labels and response statuses.
ERR_CHOICES = "choices"
ERR_CONTENT = "message.content"
PARSE_ERROR = "parse_error"
NO_VALID_ITEMS = "no_valid_items"
OK = "ok"
REQUEST_ERROR = "request_error"  # the request itself failed, there is no response


def response_content(df: DataFrame, col: str = "body") -> DataFrame:
    """Add ``content`` and ``envelope_error`` (G1).

    ``choices`` missing, null or empty (or not a list) -> ``choices``; first
    message content not a non-blank string -> ``message.content``.
    """
    parsed = once(df.select("*", J.strict_json(F.col(col)).alias("_env")))
    env = F.col("_env")
    choices = F.try_variant_get(env, "$.choices", "array<variant>")
    content = F.try_variant_get(env, "$.choices[0].message.content", "variant")
    text = F.when(J.is_kind(content, "string"), F.try_variant_get(content, "$", "string"))
    staged = parsed.select(*df.columns, F.coalesce(n_elements(choices), F.lit(0)).alias("_nchoices"), text.alias("_text"))
    err = (
        F.when(F.col("_nchoices") == 0, ERR_CHOICES)
        .when(F.col("_text").isNull() | J.is_blank("_text"), ERR_CONTENT)
    )
    out = staged.select(
        *df.columns,
        F.when(err.isNull(), F.col("_text")).alias("content"),
        err.alias("envelope_error"),
    )
    return out


def json_text(df: DataFrame, col: str = "content") -> DataFrame:
    """Add ``stripped`` (G2), ``extracted`` and ``parsed`` (G3), the text and value
    of a response's JSON part: :func:`sifter.functions.text.extract_json_text` with
    each step computed once per row, and each candidate parsed once."""
    cols = [c for c in df.columns if c not in ("stripped", "extracted", "parsed")]
    step = once(df.select(*cols, J.ustrip(col).alias("_trimmed")))
    step = once(step.select(*cols, X.drop_fence(F.col("_trimmed")).alias("stripped")))
    step = once(step.select(*cols, "stripped", J.strict_json("stripped").alias("_whole")))
    whole, span = F.col("_whole"), X.json_span(F.col("stripped"))
    step = once(step.select(*cols, "stripped", "_whole", F.when(whole.isNull(), span).alias("_span")))
    return step.select(
        *cols,
        "stripped",
        F.when(whole.isNotNull(), F.col("stripped")).otherwise(F.coalesce("_span", "stripped")).alias("extracted"),
        F.coalesce(whole, J.strict_json("_span")).alias("parsed"),
    )


def n_elements(arr: Column) -> Column:
    """Array length, NULL for a NULL array under any ANSI setting (plain
    ``size`` returns -1 for NULL when ANSI mode is off)."""
    return F.when(arr.isNotNull(), F.size(arr))


def _items_array(parsed: Column) -> Column:
    return (
        F.when(J.is_kind(parsed, "object"), F.array(parsed))
        .when(J.is_kind(parsed, "array"), F.try_variant_get(parsed, "$", "array<variant>"))
    )


def coerce_output(v: Column) -> Column:
    """Item output as text: strings as they are, anything else as compact JSON
    text from the VARIANT (object keys sorted, numbers normalised) (G6)."""
    as_str = F.when(J.is_kind(v, "string"), F.try_variant_get(v, "$", "string"))
    return F.coalesce(as_str, F.to_json(v))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _outputs_exact(text: pd.Series) -> pd.Series:
    """Per response: each item's output as Python's ``json`` would give it back (key order and numbers as written)."""

    def one(t):
        if t is None:
            return None
        try:
            doc = json.loads(t)
        except ValueError:
            return None
        outs = [i.get("output") if isinstance(i, dict) else None for i in (doc if isinstance(doc, list) else [doc])]
        return [o if isinstance(o, str) else json.dumps(o, ensure_ascii=False) for o in outs]

    return text.map(one)


def _item_ok(it: Column) -> Column:
    """An item is kept when it is an object holding all three record keys."""
    ok = J.is_kind(it, "object")
    for k in RECORD_KEYS:
        ok = ok & J.field(it, k).isNotNull()
    return F.coalesce(ok, F.lit(False))


def _text(v: Column) -> Column:
    return F.when(J.is_kind(v, "string"), F.try_variant_get(v, "$", "string")).otherwise(
        F.when(~J.is_kind(v, "null"), F.to_json(v))
    )


def parse_responses(df: DataFrame, col: str = "body", exact: bool = False):
    """-> ``(items, stats)``.

    ``items``: one row per accepted item: the response keys, ``item_idx``
    (position in the returned list), instruction/input/output text.
    ``stats``: one row per response: ``n_items``, ``n_dropped``, ``status``
    (ok / parse_error / no_valid_items / an envelope error). Both are
    row-local: counts come from higher-order functions over the item array,
    so no shuffle is needed. ``exact=True`` takes an output that is not text
    from the response as written (Python's ``json`` in an Arrow UDF), not from
    the VARIANT.
    """
    keys = [c for c in df.columns if c != col]
    env = response_content(df, col)
    # the parse is materialised once (generator barrier) because the item
    # array reads it in several CASE branches, which codegen cannot share
    written = [F.col("extracted").alias("_written")] if exact else []
    parsed = once(json_text(env.select(*keys, "envelope_error", "content")).select(*keys, "envelope_error", F.col("parsed").alias("_parsed"), *written))
    written = [_outputs_exact("_written").alias("_exact")] if exact else []
    parsed = once(parsed.select(*keys, "envelope_error", _items_array(F.col("_parsed")).alias("_items"), *written))
    n_ok = n_elements(F.filter("_items", _item_ok))
    stats = parsed.select(
        *keys,
        F.coalesce(n_ok, F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce(n_elements(F.col("_items")) - n_ok, F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("envelope_error").isNotNull(), F.col("envelope_error"))
        .when(F.col("_items").isNull(), PARSE_ERROR)
        .when(n_ok == 0, NO_VALID_ITEMS)
        .otherwise(OK)
        .alias("status"),
    )
    exploded = parsed.select(*keys, *(["_exact"] if exact else []), F.posexplode("_items").alias("item_idx", "item"))
    it = F.col("item")
    output = coerce_output(J.field(it, "output"))
    if exact:
        output = F.coalesce(F.try_element_at("_exact", F.col("item_idx") + 1), output)
    items = exploded.filter(_item_ok(it)).select(
        *keys,
        F.col("item_idx").cast("bigint").alias("item_idx"),
        _text(J.field(it, "instruction")).alias("instruction"),
        _text(J.field(it, "input")).alias("input"),
        output.alias("output"),
    )
    return items, stats


def dropped_per_run(stats: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Dropped items and responses per run (A2)."""
    return stats.groupBy(run_col).agg(
        F.count(F.lit(1)).alias("n_responses"),
        F.sum("n_items").alias("n_items"),
        F.sum("n_dropped").alias("n_dropped"),
        F.count_if(F.col("status") != OK).alias("n_failed"),
    )
