"""Array files read in splits: equal to the whole-file reader and to Python's json."""
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from sifter.sources import arrays as R
from sifter.sources import records as IO


@pytest.fixture
def small_splits(spark):
    """Splits of 96 bytes, so that most elements cross some."""
    names = {"spark.sql.files.maxPartitionBytes": "96", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def value(rng, depth=0):
    kind = rng.randrange(9 if depth < 4 else 6)
    if kind == 0:
        return rng.choice([None, True, False])
    if kind == 1:
        return rng.randrange(-(10**6), 10**6)
    if kind < 6:
        return "".join(rng.choice('ab,[]{}":\\\n é漢😀') for _ in range(rng.randrange(30)))
    if kind == 6:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i},": value(rng, depth + 1) for i in range(rng.randrange(4))}


def write(path, text):
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


@pytest.mark.parametrize("layout", [{}, {"indent": 2, "ensure_ascii": False}, {"separators": (",", ":")}])
def test_equal_to_json_for_any_split(spark, small_splits, tmp_path, layout):
    rng = random.Random(str(layout))
    want = {}
    for n in range(3):
        data = [value(rng) for _ in range(rng.randrange(20, 40))]
        write(tmp_path / f"{n}.json", json.dumps(data, **layout) + "\n" * (n % 2))
        want.update({(f"{n}.json", i): x for i, x in enumerate(data)})
    rows = R.read_large_arrays(spark, str(tmp_path)).collect()
    got = {(os.path.basename(r.file), r.pos): json.loads(r.text) for r in rows}
    assert len(rows) == len(want) and got == want
    assert all(r.text == r.text.strip() for r in rows)


def test_equal_to_the_whole_file_reader(spark, small_splits, tmp_path):
    rng = random.Random(5)
    path = write(tmp_path / "a.json", json.dumps([value(rng) for _ in range(60)], indent=1))
    cols = ["pos", F.to_json("item").alias("item"), "text", F.is_variant_null("item").alias("null")]
    assert R._lines(spark, [path]).rdd.getNumPartitions() > 20
    got = R.read_large_arrays(spark, path).select(*cols).collect()
    assert sorted(got, key=lambda r: r.pos) == sorted(IO.read_records(spark, path, with_text=True).select(*cols).collect(), key=lambda r: r.pos)


def test_start_states_joined_by_shuffle(spark, small_splits, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "SPLITS_BROADCAST", 0)
    data = [{"a": ["x, ]", i], "b": "\\\"," * (i % 7)} for i in range(60)]
    write(tmp_path / "a.json", json.dumps(data))
    rows = R.read_large_arrays(spark, str(tmp_path)).collect()
    assert [json.loads(r.text) for r in sorted(rows, key=lambda r: r.pos)] == data


@pytest.mark.parametrize("text", [
    "", " ", '{"a": [1, 2]}', "[1, 2", "[1, 2]]", "[1],", "[1], [2]", "x [1]", "[1,]", "[1,,2]",
    '["a\\", 1]', "[[1, 2], [3]", "\ufeff[1]",
    '["' + "long, " * 40 + "]",
])
def test_other_texts_fail(spark, small_splits, tmp_path, text):
    path = write(tmp_path / "a.json", text)
    with pytest.raises(Exception, match="JSON list"):
        R.read_large_arrays(spark, path).collect()


def test_small_arrays(spark, small_splits, tmp_path):
    texts = ["[]", " [ \n ] \n", "[null]", ' [""]', "[[]]", '["' + "a, " * 500 + '"]']
    for n, text in enumerate(texts):
        write(tmp_path / f"{n}.json", text)
    rows = R.read_large_arrays(spark, str(tmp_path)).collect()
    for n, text in enumerate(texts):
        assert [json.loads(r.text) for r in rows if r.file.endswith(f"/{n}.json")] == json.loads(text)


def test_clean_job_reads_large_arrays(spark, small_splits, tmp_path):
    from sifter.plans import jobs

    good = [{"instruction": f"do {i}", "input": "a, b", "output": '{"task_type": "t", "agents_config": [], "rl_parameters": {}}'} for i in range(20)]
    path = write(tmp_path / "a.json", json.dumps([*good, 7, {"instruction": "no"}]))
    found = {}
    for fmt in ("array", "large_array"):
        report = jobs.clean_files(spark, path, str(tmp_path / fmt), fmt=fmt).collect()
        found[fmt] = sorted(map(str, report)), sorted(r.value for r in spark.read.text(str(tmp_path / fmt / "clean")).collect())
    assert found["array"] == found["large_array"] and len(found["array"][1]) == 20
