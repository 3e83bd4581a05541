"""Property tests: random JSON documents through the native JSON functions."""
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from sifter.functions import jsonx as J

text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=8)
scalars = st.none() | st.booleans() | st.integers(-10**6, 10**6) | text
docs = st.recursive(scalars, lambda kids: st.lists(kids, max_size=4) | st.dictionaries(text, kids, max_size=4), max_leaves=12)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(docs, st.sampled_from([None, 0, 1, 2, "\t"])), min_size=60, max_size=60))
def test_strict_parse_and_minify_match_python(spark, batch):
    texts = [json.dumps(d, ensure_ascii=False, indent=ind) for d, ind in batch]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select(
        "i", J.strict_json("t").isNotNull().alias("ok"), J.minify_json("t").alias("m")
    ).orderBy("i").collect()
    for (d, _), r in zip(batch, rows):
        assert r.ok
        assert r.m == json.dumps(d, ensure_ascii=False, separators=(",", ":"))
    again = spark.createDataFrame([(r.m,) for r in rows], "t string").select(J.minify_json("t").alias("m")).collect()
    assert [r.m for r in again] == [r.m for r in rows]
    broken = spark.createDataFrame([(t + " x",) for t in texts], "t string").select(J.strict_json("t").isNull().alias("bad")).collect()
    assert all(r.bad for r in broken)
