"""Record contract check: classify, clean, quarantine, minify, report.

One label per row, first failure wins, in this fixed order:
invalid_item, missing_keys, output_json_error, output_missing_keys,
output_invalid_types, else valid. The label is a single CASE over columns
projected once, so each ``output`` string is parsed once per row.
"""
from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import jsonx as J

# Record keys, the output document's required keys with their
# JSON kinds, and the label names in check order.
RECORD_KEYS = ("instruction", "input", "output")
REQUIRED_OUTPUT = {"task_type": "string", "agents_config": "array", "rl_parameters": "object"}
ERROR_LABELS = (
    "invalid_item",
    "missing_keys",
    "output_json_error",
    "output_missing_keys",
    "output_invalid_types",
)
VALID = "valid"


def _output_text(item: Column) -> Column:
    o = J.field(item, "output")
    return F.when(J.is_kind(o, "string"), F.try_variant_get(o, "$", "string"))


_PY_KINDS = {"string": str, "array": list, "object": dict}


def _doc_label_udf(required: dict):
    """Arrow UDF: the output-document part of the label with Python's json
    (duplicate keys: last wins; NaN/Infinity accepted)."""
    kinds = {k: _PY_KINDS[v] for k, v in required.items()}

    def one(text):
        if text is None:
            return None
        try:
            doc = json.loads(text)
        except ValueError:
            return "output_json_error"
        if not isinstance(doc, dict):
            return "output_json_error"
        if not set(kinds).issubset(doc.keys()):
            return "output_missing_keys"
        if any(not isinstance(doc.get(k), t) for k, t in kinds.items()):
            return "output_invalid_types"
        return VALID

    @F.pandas_udf("string")
    def label(s: pd.Series) -> pd.Series:
        return s.map(one)

    return label


def classify(raw: DataFrame, item: str = "item", required: dict | None = None, exact: bool = False) -> DataFrame:
    """Add ``label`` (C7) and ``doc`` (the parsed output document, VARIANT).

    ``raw`` holds one VARIANT per record in column ``item`` (S1/S2 output or an
    adapter). JSON null under a record key counts as present (presence test),
    as in the contract; a missing key does not. ``exact=True`` judges the
    output document with Python's ``json`` in an Arrow UDF (parity for
    duplicate keys and NaN; ``doc`` is then NULL).
    """
    required = dict(REQUIRED_OUTPUT if required is None else required)
    if exact:
        return _classify_exact(raw, item, required)
    it = F.col(item)
    cols = raw.columns
    staged = raw.select(
        *cols,
        J.is_kind(it, "object").alias("_is_obj"),
        F.greatest(*[J.field(it, k).isNull() for k in RECORD_KEYS]).alias("_missing"),
        _output_text(it).alias("_out"),
    )
    # parse once; the object test reads the first token, not the whole value
    staged = staged.select(
        *cols,
        "_is_obj",
        "_missing",
        "_out",
        F.when(F.col("_out").rlike(J.OBJECT_START), J.strict_json("_out")).alias("doc"),
    )
    doc = F.col("doc")
    missing_req = F.greatest(*[J.field(doc, k).isNull() for k in required])
    bad_type = F.greatest(*[~J.is_kind(J.field(doc, k), kind) for k, kind in required.items()])
    label = (
        F.when(~F.col("_is_obj"), "invalid_item")
        .when(F.col("_missing"), "missing_keys")
        .when(F.col("_out").isNull() | J.is_blank("_out"), "output_json_error")
        .when(doc.isNull(), "output_json_error")
        .when(missing_req, "output_missing_keys")
        .when(bad_type, "output_invalid_types")
        .otherwise(VALID)
    )
    return once(staged.select(*cols, "doc", label.alias("label")))


def once(df: DataFrame) -> DataFrame:
    """Materialise every column of ``df`` exactly once per row.

    Catalyst pushes a filter on a computed column down through projections
    and exchanges, substituting the column's definition; a later projection of
    the same columns then evaluates the parse a second time. A filter cannot
    move below a row generator, so emitting the row through a one-element
    ``inline`` keeps the label computed once, where the projection runs.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def _classify_exact(raw: DataFrame, item: str, required: dict) -> DataFrame:
    it = F.col(item)
    cols = raw.columns
    staged = raw.select(
        *cols,
        J.is_kind(it, "object").alias("_is_obj"),
        F.greatest(*[J.field(it, k).isNull() for k in RECORD_KEYS]).alias("_missing"),
        _output_text(it).alias("_out"),
    )
    py = _doc_label_udf(required)
    label = (
        F.when(~F.col("_is_obj"), "invalid_item")
        .when(F.col("_missing"), "missing_keys")
        .when(F.col("_out").isNull() | J.is_blank("_out"), "output_json_error")
        .otherwise(py(F.col("_out")))
    )
    return once(staged.select(*cols, F.lit(None).cast("variant").alias("doc"), label.alias("label")))


def clean(classified: DataFrame) -> DataFrame:
    """Rows labelled valid, every original column kept."""
    return classified.filter(F.col("label") == VALID)


def quarantine(classified: DataFrame) -> DataFrame:
    """Rejected rows with their label."""
    return classified.filter(F.col("label") != VALID)


def minify(df: DataFrame, col: str = "output", exact: bool = False) -> DataFrame:
    """Rewrite one JSON text column compactly.

    Native mode removes whitespace outside strings and keeps everything else
    byte for byte; ``exact=True`` re-serialises with Python's json module.
    """
    fn = J.minify_json_exact if exact else J.minify_json
    return df.withColumn(col, fn(F.col(col)))


@F.pandas_udf(T.StringType())
def _with_output(text: pd.Series, output: pd.Series) -> pd.Series:
    def one(t, o):
        record = json.loads(t)
        record["output"] = o
        return json.dumps(record, ensure_ascii=False)

    return pd.Series([one(t, o) if t is not None else None for t, o in zip(text, output)])


def rewrite_output(df: DataFrame, text: str = "text", col: str = "output") -> DataFrame:
    """Put the (minified) output back into the record's own text; key order and the other values stay as written."""
    return df.withColumn(text, _with_output(F.col(text), F.col(col)))


def project_record(df: DataFrame, item: str = "item", keep_item: bool = False) -> DataFrame:
    """Typed view of a record: instruction/input/output as text (JSON text for non-strings)."""
    it = F.col(item)

    def text(k):
        v = J.field(it, k)
        return F.when(J.is_kind(v, "string"), F.try_variant_get(v, "$", "string")).otherwise(
            F.when(~J.is_kind(v, "null"), F.to_json(v))
        )

    keep = [c for c in df.columns if keep_item or c != item]
    return df.select(*keep, *[text(k).alias(k) for k in RECORD_KEYS])


def validation_report(classified: DataFrame) -> DataFrame:
    """One row: total, valid, ratio (percent, 0.0 when empty), one count per class (A1).

    Every class appears even at 0. Partial aggregation runs map-side, so only
    one small row per task crosses the shuffle.
    """
    lab = F.col("label")
    total = F.count(F.lit(1))
    valid = F.count_if(lab == VALID)
    aggs = [total.alias("total"), valid.alias("valid")]
    aggs += [F.count_if(lab == name).alias(name) for name in ERROR_LABELS]
    rep = classified.agg(*aggs)
    ratio = F.when(F.col("total") > 0, F.round(F.col("valid") * 100.0 / F.col("total"), 2)).otherwise(F.lit(0.0))
    return rep.select("total", "valid", ratio.alias("valid_pct"), *ERROR_LABELS)


def report_text(report: DataFrame, title: str = "Dataset Validation Report") -> DataFrame:
    """The validation report as one text value (total, valid with its percent
    to two decimals, then every class, zeros included) (A1)."""
    rule = F.lit("=" * 40)
    lines = [
        rule,
        F.lit(title),
        rule,
        F.format_string("Total:  %d", F.col("total")),
        F.format_string("Valid:  %d (%.2f%%)", F.col("valid"), F.col("valid_pct")),
        F.lit("-" * 40),
        *[F.format_string(f"{name}: %d", F.col(name)) for name in ERROR_LABELS],
    ]
    return report.select(F.concat_ws("\n", *lines).alias("report"))
