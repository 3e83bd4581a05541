"""Scalar functions against Python's own behaviour (FIXTURES.md §4)."""
import json

import pytest
from pyspark.sql import functions as F

from sifter.functions import errors as E
from sifter.functions import jsonx as J
from sifter.functions import text as X


def one_col(spark, values, expr, name="t"):
    df = spark.createDataFrame([(v,) for v in values], f"{name} string")
    return [r[0] for r in df.select(expr(F.col(name))).collect()]


def py_strict(t):
    try:
        return json.loads(t)
    except ValueError:
        return "<error>"


STRICT_CASES = [
    '{"a":1}', '{"a":1} x', '{"a":1}] x', "1, 2", "", "  ", "[1]", '{"a":1}, "x": 2', '1}, {"a": 2',
    '"s"', "null", "{'a':1}", '{"a":1,}', "[1,]", ' {"b": [1, {"c": null}]} ', "01", "1e5", "-0.5", "tru",
    '{"a":"\\u4e2d"}', '{"a": "x\\"y"}', "[[[]]]", '{"a":{}}]',
]


@pytest.mark.parametrize("t", STRICT_CASES)
def test_strict_json_matches_python(spark, t):
    got = one_col(spark, [t], lambda c: J.strict_json(c).isNotNull())[0]
    assert got == (py_strict(t) != "<error>"), t


def test_strict_json_declared_differences(spark):
    # duplicate keys and NaN parse in Python; the native check rejects them
    got = one_col(spark, ['{"a":1,"a":2}', "NaN"], lambda c: J.strict_json(c).isNotNull())
    assert got == [False, False]


def test_ustrip_equals_python_strip_on_bmp_whitespace(spark):
    ws = [chr(c) for c in range(0x10000) if chr(c).isspace()]
    texts = [w + "a" + w + "b" + w for w in ws] + ["".join(ws) + "x" + "".join(ws), "".join(ws)]
    got = one_col(spark, texts, J.ustrip)
    assert got == [t.strip() for t in texts]
    blank = one_col(spark, texts, J.is_blank)
    assert blank == [t.strip() == "" for t in texts]


def test_json_kind(spark):
    vals = ['{"a":1}', "[1]", '"s"', "1", "1.5", "true", "null"]
    got = one_col(spark, vals, lambda c: J.json_kind(F.parse_json(c)))
    assert got == ["object", "array", "string", "number", "number", "boolean", "null"]


DOCS = [
    '{"task_type": "t", "agents_config": [{"role": "a b", "count": 3}], "rl_parameters": {"x": -1.5, "s": "x\\"y, z: w"}}',
    '{\n  "a" : [ 1 , 2 ],\n\t"b": "中 文"\n}',
    "[ ]",
]


def test_minify_matches_python_and_is_idempotent(spark):
    once = one_col(spark, DOCS, J.minify_json)
    assert once == [json.dumps(json.loads(d), ensure_ascii=False, separators=(",", ":")) for d in DOCS]
    assert one_col(spark, once, J.minify_json) == once
    assert [json.loads(x) for x in once] == [json.loads(d) for d in DOCS]


def test_minify_exact_rewrites_like_python(spark):
    docs = ['{"a": "\\u4e2d", "b": 1E2}']
    assert one_col(spark, docs, J.minify_json_exact) == ['{"a":"中","b":100.0}']


FENCES = [
    ("```json\n[1]\n```", "[1]", "[1]"),
    ('pre [1,{"a":[2]}] post', 'pre [1,{"a":[2]}] post', '[1,{"a":[2]}]'),
    ('Here: {"a":[1]}', 'Here: {"a":[1]}', "[1]"),
    ('Here: {"a":1}', 'Here: {"a":1}', '{"a":1}'),
    ("nothing", "nothing", "nothing"),
    ("  ```\n{\"a\": 1}\n```  ", '{"a": 1}', '{"a": 1}'),
]


@pytest.mark.parametrize("text,stripped,extracted", FENCES)
def test_fence_and_extract(spark, text, stripped, extracted):
    assert one_col(spark, [text], X.strip_fence) == [stripped]
    assert one_col(spark, [text], X.extract_json_text) == [extracted]


DURATIONS = [("1.5s", 2), ("0s", 0), ("1h2m3s", 3723), ("1h2.5m3s", 3753), ("0h", None), ("", None), ("500ms", None), ("5", None), (" 2m ", 120)]


@pytest.mark.parametrize("text,expected", DURATIONS)
def test_parse_duration(spark, text, expected):
    assert one_col(spark, [text], E.parse_duration_seconds) == [expected]


def test_parse_retry_delay(spark):
    got = one_col(
        spark,
        ['{"retryDelay": "x", "resetTime": "2s"}', '{"reset_seconds": 7}', "no delay here", '{"quotaResetDelay": "1m"}'],
        E.parse_retry_delay_seconds,
    )
    assert got == [2, 7, None, 60]


def test_markers(spark):
    texts = ["HTTP 429 Too Many", "Read timed out", "JSON 解析失败: x", "Please switch to model b", "HTTP 400"]
    assert one_col(spark, texts, E.is_retriable) == [True, True, False, False, False]
    assert one_col(spark, texts, E.is_quota) == [True, False, False, False, False]
    assert one_col(spark, texts, E.is_json_parse) == [False, False, True, False, False]
    assert one_col(spark, texts, E.is_timeout) == [False, True, False, False, False]
    assert one_col(spark, texts, E.is_model_unavailable) == [False, False, False, True, False]
    assert one_col(spark, [None], E.is_retriable) == [False]


def test_code_points(spark):
    from sifter.operators.samples import code_points

    texts = ["aé中", "x"]
    assert one_col(spark, texts, code_points) == [[ord(c) for c in t] for t in texts]


def test_let_evaluates_once(spark):
    df = spark.range(200)
    bound = df.select(J.let(F.rand(7), lambda x: x - x).alias("d")).agg(F.max(F.abs("d"))).first()[0]
    assert bound == 0.0
