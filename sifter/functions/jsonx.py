"""JSON and whitespace scalars shared by every operator family.

All functions map Columns to Columns built from Spark SQL built-ins, so they
stay inside whole-stage codegen / the JVM. The optional ``exact`` paths run
Python's own ``json`` module in an Arrow-batched pandas UDF.
"""
from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Python's str.strip() treats as whitespace
# (str.isspace() is True). Written as a regex class valid in Java and RE2.
WS_CLASS = (
    "[\\t-\\r\\x1c-\\x20\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)
WS_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())  # the same characters, one by one
NOT_WS_PATTERN = "[^" + WS_CLASS[1:]  # any character outside the class

# Quoted JSON string (unrolled loop, possessive: no per-character recursion in
# java.util.regex) or a run of JSON whitespace outside strings.
MINIFY_PATTERN = '("[^"\\\\]*+(?:\\\\.[^"\\\\]*+)*+")|[ \\t\\n\\r]++'

# JSON whitespace before the first token of a value.
OBJECT_START = "^[ \\t\\n\\r]*\\{"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` evaluated once per row (bound as the
    variable of a one-element higher-order function), however often ``fn``
    refers to it. Spark shares repeated subexpressions only outside
    conditional branches; this keeps expensive text work single."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def ustrip(c) -> Column:
    """Python ``str.strip()`` over the full Unicode whitespace set (F3), reading the two ends only."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def is_blank(c) -> Column:
    """True when the string is empty or whitespace only; NULL stays NULL."""
    return ~_c(c).rlike(NOT_WS_PATTERN)


def strict_json(c) -> Column:
    """Parse text as exactly one JSON value, or NULL (F1).

    ``try_parse_json`` ignores text after the first value. Parsing the text
    wrapped as ``[t]`` and as ``{"v":t}`` closes that hole: a tail can end the
    array early or the object early, never both, and a second value or key
    breaks the other wrapper. When both parse, the text is one value.
    """
    t = _c(c)
    arr = F.try_parse_json(F.concat(F.lit("["), t, F.lit("]")))
    obj = F.try_parse_json(F.concat(F.lit('{"v":'), t, F.lit("}")))
    # the object wrapper is parsed only when the array parse succeeded; pass a
    # column or a bound variable (see ``let``), not a long computed expression
    return F.when(arr.isNotNull(), F.try_variant_get(obj, "$.v", "variant"))


def json_kind(v) -> Column:
    """object / array / string / number / boolean / null for a VARIANT (F2)."""
    s = F.schema_of_variant(_c(v))
    return (
        F.when(_c(v).isNull(), F.lit(None).cast("string"))
        .when(s.startswith("OBJECT<"), "object")
        .when(s.startswith("ARRAY<"), "array")
        .when(s == "STRING", "string")
        .when(s == "BOOLEAN", "boolean")
        .when(s == "VOID", "null")
        .otherwise("number")
    )


def is_kind(v, kind: str) -> Column:
    """Cheap type test for one JSON kind; never true for SQL NULL."""
    v = _c(v)
    if kind == "object":
        return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()
    if kind == "array":
        return F.try_variant_get(v, "$", "array<variant>").isNotNull()
    if kind == "string":
        return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))
    if kind == "null":
        return F.coalesce(F.is_variant_null(v), F.lit(False))
    return F.coalesce(json_kind(v) == kind, F.lit(False))


def field(v, key: str) -> Column:
    """Value under a top-level key as VARIANT; SQL NULL when the key is absent."""
    return F.try_variant_get(_c(v), "$." + key if key.isidentifier() else f"$['{key}']", "variant")


def minify_json(c) -> Column:
    """Drop whitespace outside strings; key order, numbers and escapes kept.

    Apply to text that is strictly valid JSON. For Python-identical output
    (escapes rewritten, ``1E2`` -> ``100.0``) use :func:`minify_json_exact`.
    """
    return F.regexp_replace(_c(c), MINIFY_PATTERN, "$1")


def _dumps_series(s: pd.Series, separators) -> pd.Series:
    def one(x):
        if x is None:
            return None
        try:
            return json.dumps(json.loads(x), ensure_ascii=False, separators=separators)
        except ValueError:
            return None

    return s.map(one)


@F.pandas_udf(T.StringType())
def _minify_exact_udf(s: pd.Series) -> pd.Series:
    return _dumps_series(s, (",", ":"))


@F.pandas_udf(T.StringType())
def _redump_exact_udf(s: pd.Series) -> pd.Series:
    return _dumps_series(s, (", ", ": "))


def minify_json_exact(c) -> Column:
    """Python ``json.dumps(json.loads(t), ensure_ascii=False, separators=(',',':'))``."""
    return _minify_exact_udf(_c(c))


def dumps_exact(c) -> Column:
    """Python ``json.dumps(json.loads(t), ensure_ascii=False)`` (``, `` / ``: ``)."""
    return _redump_exact_udf(_c(c))
