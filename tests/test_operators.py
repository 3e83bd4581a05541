"""Operators against FIXTURES.md unit rows and brute-force Python references."""
import json
import os
import random
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from sifter.operators import chat as H
from sifter.operators import checkpoints as K
from sifter.operators import clean as C
from sifter.operators import metrics as M
from sifter.operators import prompts as P
from sifter.operators import requests as Q
from sifter.operators import responses as R
from sifter.operators import samples as S
from sifter.operators.rank import global_rank
from sifter.operators.seq import running
from sifter.sources import records as IO

D = json.dumps({"task_type": "t", "agents_config": [], "rl_parameters": {}})


def rec(output, **kw):
    base = {"instruction": "a", "input": "b", "output": output}
    base.update(kw)
    return base


CLEAN_CASES = [
    (3, "invalid_item"), ("x", "invalid_item"), (None, "invalid_item"), ([1], "invalid_item"),
    ({"instruction": "a", "output": D}, "missing_keys"),
    ({"instruction": None, "input": None, "output": D}, "valid"),
    (rec(None), "output_json_error"), (rec({}), "output_json_error"), (rec(""), "output_json_error"),
    (rec("　"), "output_json_error"), (rec("[1]"), "output_json_error"), (rec("3"), "output_json_error"),
    (rec(D + " x"), "output_json_error"), (rec("{'a':1}"), "output_json_error"), (rec('{"a":1,}'), "output_json_error"),
    (rec('{"a":1}'), "output_missing_keys"),
    (rec(json.dumps({"task_type": 1, "agents_config": [], "rl_parameters": {}})), "output_invalid_types"),
    (rec(json.dumps({"task_type": "t", "agents_config": {}, "rl_parameters": {}})), "output_invalid_types"),
    (rec(json.dumps({"task_type": "t", "agents_config": [], "rl_parameters": []})), "output_invalid_types"),
    (rec(json.dumps({"task_type": None, "agents_config": [], "rl_parameters": {}})), "output_invalid_types"),
    (rec(json.dumps({"task_type": "t", "agents_config": [], "rl_parameters": {}, "extra": 1})), "valid"),
    (rec(D, meta={"k": 1}), "valid"),
]


def write_array(path, items):
    with open(path, "w", encoding="utf-8") as f:
        json.dump(items, f, ensure_ascii=False, indent=2)


def test_read_and_classify_json_array(spark, scratch):
    path = os.path.join(scratch, "data.json")
    write_array(path, [c[0] for c in CLEAN_CASES])
    raw = IO.read_records(spark, path)
    got = {r["pos"]: r["label"] for r in C.classify(raw).select("pos", "label").collect()}
    assert got == {i: c[1] for i, c in enumerate(CLEAN_CASES)}
    rep = C.validation_report(C.classify(raw)).collect()[0].asDict()
    assert rep["total"] == len(CLEAN_CASES)
    assert rep["valid"] + sum(rep[k] for k in C.ERROR_LABELS) == rep["total"]
    assert rep["valid"] == 3 and rep["valid_pct"] == round(3 * 100.0 / len(CLEAN_CASES), 2)


def test_report_on_empty_input_shows_all_classes(spark):
    empty = spark.createDataFrame([], "pos bigint, item_text string").select("pos", F.parse_json("item_text").alias("item"))
    row = C.validation_report(C.classify(empty)).collect()[0].asDict()
    assert row == {"total": 0, "valid": 0, "valid_pct": 0.0, **{k: 0 for k in C.ERROR_LABELS}}


def test_non_list_file_fails(spark, scratch):
    path = os.path.join(scratch, "obj.json")
    with open(path, "w") as f:
        json.dump({"a": 1}, f)
    with pytest.raises(Exception, match="JSON list"):
        IO.read_records(spark, path).collect()


def test_json_lines_positions_and_roundtrip(spark, scratch):
    items = [{"instruction": "i", "input": str(i), "output": D} for i in range(300)] + ["not json {"]
    src = os.path.join(scratch, "lines.jsonl")
    with open(src, "w", encoding="utf-8") as f:
        for it in items[:-1]:
            f.write(json.dumps(it, ensure_ascii=False) + "\n")
        f.write(items[-1] + "\n")
    df = IO.read_records_lines(spark, src)
    rows = sorted((r["pos"], r["inp"]) for r in df.select("pos", F.try_variant_get("item", "$.input", "string").alias("inp")).collect())
    assert rows[:300] == [(i, str(i)) for i in range(300)]
    assert rows[300] == (300, None)
    out = os.path.join(scratch, "out")
    kept, _, _ = __import__("sifter.plans.jobs", fromlist=["clean_job"]).clean_job(df.select("pos", "item"), minify_output=True)
    IO.write_records(kept.select("pos", "instruction", "input", "output"), out, "json")
    back = spark.read.json(out)
    assert back.count() == 300
    assert back.filter(F.col("output").contains(" ")).count() == 0


def test_append_batch(spark):
    base = spark.createDataFrame([(0, "a"), (1, "b")], "pos bigint, v string")
    batch = spark.createDataFrame([(0, "c"), (1, "d"), (2, "e")], "pos bigint, v string")
    got = sorted(tuple(r) for r in IO.append_batch(base, batch).collect())
    assert got == [(0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "e")]
    empty = base.limit(0)
    assert sorted(tuple(r) for r in IO.append_batch(empty, batch).collect()) == [(0, "c"), (1, "d"), (2, "e")]


def test_checkpoint_resume_finalize(spark):
    seed = spark.createDataFrame([(i, f"s{i}") for i in range(3)], "pos bigint, v string")
    gen = spark.createDataFrame([(i * 10, f"g{i}") for i in range(5)], "pos bigint, v string")
    ck = K.checkpoint_rows(seed, gen)
    assert sorted((r.pos, r.v) for r in ck.collect()) == [(0, "s0"), (1, "s1"), (2, "s2")] + [(3 + i, f"g{i}") for i in range(5)]
    res = K.resume_generated(ck, seed)
    assert sorted((r.pos, r.v) for r in res.collect()) == [(i, f"g{i}") for i in range(5)]
    short = ck.filter("pos < 2")
    assert K.resume_generated(short, seed).count() == 0
    fin = K.finalize_dataset(seed, gen, 2)
    assert sorted(r.v for r in fin.collect()) == ["g0", "g1", "s0", "s1", "s2"]


def envelope(content):
    return json.dumps({"choices": [{"message": {"content": content}}]})


def test_parse_responses(spark):
    good = {"instruction": "i", "input": "x", "output": "o"}
    rows = [
        (1, envelope(json.dumps([good, good]))),
        (2, envelope("```json\n" + json.dumps([good, 3, {"instruction": "x"}]) + "\n```")),
        (3, envelope(json.dumps({**good, "output": {"k": 1}}))),
        (4, envelope("42")),
        (5, envelope("nothing here")),
        (6, envelope(json.dumps([1, 2]))),
        (7, json.dumps({"error": "x"})),
        (8, envelope("   ")),
    ]
    df = spark.createDataFrame(rows, "request_id bigint, body string")
    items, stats = R.parse_responses(df)
    st = {r.request_id: (r.n_items, r.n_dropped, r.status) for r in stats.collect()}
    assert st == {
        1: (2, 0, "ok"), 2: (1, 2, "ok"), 3: (1, 0, "ok"), 4: (0, 0, "parse_error"), 5: (0, 0, "parse_error"),
        6: (0, 2, "no_valid_items"), 7: (0, 0, "choices"), 8: (0, 0, "message.content"),
    }
    outs = {(r.request_id, r.item_idx): r.output for r in items.collect()}
    assert outs[(3, 0)] == '{"k":1}'
    items_exact, _ = R.parse_responses(df, exact=True)
    assert {(r.request_id, r.item_idx): r.output for r in items_exact.collect()}[(3, 0)] == '{"k": 1}'


def test_batch_size_rules(spark):
    df = spark.createDataFrame([(b,) for b in [50, 11, 10, 6, 5, 4, 3, 2, 25, 48]], "b int")
    got = [(r.b, r.s, r.g) for r in df.select("b", Q.shrunk_batch(F.col("b")).alias("s"), Q.grown_batch(F.col("b")).alias("g")).collect()]
    assert got == [(50, 25, 50), (11, 5, 16), (10, 5, 15), (6, 5, 11), (5, 4, 10), (4, 5, 9), (3, 5, 8), (2, 5, 7), (25, 12, 30), (48, 24, 50)]


def test_request_actions(spark):
    rows = [
        (1, 0, 10, None), (2, 0, 10, "model is no longer available"), (3, 0, 10, "JSON 解析失败"), (4, 0, 3, "JSON 解析失败"),
        (5, 0, 10, 'HTTP 429 "retryDelay": "3s"'), (6, 1, 10, "HTTP 503"), (7, 4, 10, "HTTP 503"), (8, 0, 10, "boom"),
    ]
    log = spark.createDataFrame(rows, "seq bigint, attempt int, batch_size int, error string")
    got = {r.seq: (r.action, r.wait_s, r.next_batch_size) for r in Q.request_actions(log).collect()}
    assert got == {
        1: ("success", None, 15), 2: ("stop", None, 10), 3: ("shrink", None, 5), 4: ("skip", None, 3),
        5: ("stop", None, 10), 6: ("backoff", 10, 10), 7: ("skip", None, 10), 8: ("skip", None, 10),
    }
    paused = {r.seq: (r.action, r.wait_s) for r in Q.request_actions(log, pause_on_quota=True, max_pause=2).collect()}
    assert paused[5] == ("stop", None)  # needs 3 s, above the 2 s limit
    assert {r.seq: r.wait_s for r in Q.request_actions(log, pause_on_quota=True).collect()}[5] == 3


def test_rank_and_running_match_windows_under_skew(spark):
    rng = random.Random(7)
    # one hot group holding most rows, tiny buckets to force many bucket boundaries
    rows = [(0 if rng.random() < 0.6 else rng.randrange(1, 6), i, rng.randrange(0, 5)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g bigint, seq bigint, x bigint")
    ranked = global_rank(df, ["seq"], F.shiftright("seq", 4), within=["g"], name="r", total="n")
    exp = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("seq")))
    exp = exp.withColumn("n", F.count("*").over(Window.partitionBy("g")))
    assert sorted(map(tuple, ranked.select("g", "seq", "r", "n").collect())) == sorted(map(tuple, exp.select("g", "seq", "r", "n").collect()))
    run = running(df, ["g"], ["seq"], F.shiftright("seq", 3), sums={"s": F.col("x")}, maxes={"m": F.col("x") * (F.col("seq") % 7)}, lags={"p": F.col("x")})
    w = Window.partitionBy("g").orderBy("seq")
    exp = df.select(
        "g", "seq", F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
        F.max(F.col("x") * (F.col("seq") % 7)).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m"),
        F.lag("x").over(w).alias("p"),
    )
    assert sorted(map(tuple, run.select("g", "seq", "s", "m", "p").collect())) == sorted(map(tuple, exp.collect()))


def test_messages_fixture(spark):
    sp = "S"
    rows = [(1, "A", "B"), (2, "S", "B"), (3, "A", ""), (4, "S", ""), (5, "", "B")]
    df = spark.createDataFrame([(p, i, x, "o") for p, i, x in rows], "pos bigint, instruction string, input string, output string")
    m = S.build_messages(S.normalize(df), system_prompt=sp)
    got = {r.pos: (r.drop_reason, r.messages[-1]["content"] if r.messages else None) for r in m.collect()}
    assert got == {1: (None, "A\n\nB"), 2: (None, "B"), 3: (None, "A"), 4: ("empty_prompt", None), 5: (None, "B")}
    m2 = S.build_messages(S.normalize(df), instruction_as_system=True)
    assert {r.pos for r in m2.collect() if r.drop_reason is None} == {1, 2}


def test_mask_truncate_and_collate(spark):
    df = spark.createDataFrame([(0, [1, 2, 3], [4, 5])], "pos bigint, p array<int>, a array<int>")
    enc = lambda c: F.when(c == "P", F.array(*[F.lit(i) for i in (1, 2, 3)])).otherwise(F.array(F.lit(4), F.lit(5)))
    base = spark.createDataFrame([(0, "P", "A", None)], "pos bigint, prompt string, answer string, drop_reason string")
    r = S.encode(base, encoder=enc, max_length=9).collect()[0]
    assert (r.input_ids, r.labels, r.attention_mask) == ([1, 2, 3, 4, 5], [-100, -100, -100, 4, 5], [1] * 5)
    r = S.encode(base, encoder=enc, max_length=3).collect()[0]
    assert (r.input_ids, r.labels) == ([3, 4, 5], [-100, 4, 5])
    r = S.encode(base, encoder=enc, max_length=2).collect()[0]
    assert r.drop_reason is None and r.labels == [4, 5]
    # an answer without tokens leaves nothing to learn
    none = lambda c: F.when(c == "P", F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    assert S.encode(base, encoder=none).first().drop_reason == "all_masked"
    b = spark.createDataFrame([(0, 3, 1, [1, 2, 3]), (1, 1, 0, [4])], "pos bigint, n_tokens int, n_masked int, input_ids array<int>")
    plan = spark.createDataFrame([(0, "train", 0, 3), (1, "train", 0, 3)], "pos bigint, split string, batch_id bigint, width int")
    got = {r.pos: (r.input_ids, r.attention_mask, r.labels, r.width) for r in S.collate(b, plan, pad_id=0).collect()}
    assert got[1] == ([4, 0, 0], [1, 0, 0], [4, -100, -100], 3)
    assert got[0] == ([1, 2, 3], [1, 1, 1], [-100, 2, 3], 3)


@pytest.mark.parametrize("n,expected", [(2000, 40), (50, 1), (49, 0)])
def test_split_sizes(spark, n, expected):
    df = spark.range(n).withColumnRenamed("id", "pos")
    sizes = {r.split: r.n for r in S.split_sizes(S.split_exact(df)).collect()}
    assert sizes.get("eval", 0) == expected and sizes["train"] == n - expected


def test_split_independent_of_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "pos")
    a = {r.pos for r in S.split_exact(df.repartition(1)).filter("split = 'eval'").collect()}
    b = {r.pos for r in S.split_exact(df.repartition(32)).filter("split = 'eval'").collect()}
    assert a == b and len(a) == 100


def test_batches(spark):
    df = spark.range(23).withColumnRenamed("id", "pos")
    got = sorted((r.pos, r.batch_id) for r in S.assign_batches(df.repartition(5), 8).collect())
    assert got == [(i, i // 8) for i in range(23)]


def smooth_py(points, factor=0.85):
    out = []
    for i, p in enumerate(points):
        out.append(p if i == 0 else out[-1] * factor + p * (1 - factor))
    return out


def test_smoothing_fixture_and_long_series(spark):
    df = spark.createDataFrame([(1, "loss", i + 1, float(v)) for i, v in enumerate([1, 2, 3])], "run_id bigint, name string, step bigint, value double")
    got = [r.smoothed for r in M.smooth(df).orderBy("step").collect()]
    assert [round(x, 12) for x in got] == [1.0, 1.15, 1.4275]
    rng = random.Random(3)
    vals = [rng.random() * 10 for _ in range(9000)]
    long = spark.createDataFrame([(7, "loss", i + 1, v) for i, v in enumerate(vals)], "run_id bigint, name string, step bigint, value double")
    got = [r.smoothed for r in M.smooth(long).orderBy("step").collect()]
    exp = smooth_py(vals)
    assert len(got) == len(exp)
    assert max(abs(a - b) for a, b in zip(got, exp)) < 1e-9


def test_chat_lines_and_histories(spark):
    rows = [
        (1, 0, "system", "sys"), (1, 1, "user", " hi "), (1, 2, "assistant", "yo"), (1, 3, "user", "/reset"),
        (1, 4, "user", "  "), (1, 5, "user", "again"), (1, 6, "assistant", "ok"), (1, 7, "user", "quit"), (1, 8, "user", "late"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    lines = {r.turn: (r.kind, r.active) for r in H.chat_lines(df).collect()}
    assert lines[3] == ("reset", True) and lines[4] == ("blank", True) and lines[7] == ("exit", False) and lines[8][1] is False
    hist = {r.turn: [(m.role, m.content) for m in r.history] for r in H.histories(df).collect()}
    assert hist == {
        1: [("system", "sys"), ("user", "hi")],
        2: [("system", "sys"), ("user", "hi"), ("assistant", "yo")],
        5: [("system", "sys"), ("user", "again")],
        6: [("system", "sys"), ("user", "again"), ("assistant", "ok")],
    }
    recs = H.transcript_to_records(df).collect()
    assert sorted((r.input, r.output, r.instruction) for r in recs) == [(" hi ", "yo", "sys"), ("again", "ok", "sys")]
    ch = spark.createDataFrame([(1, 1, "b "), (1, 0, " a"), (2, 0, "x")], "doc_id bigint, seq bigint, chunk string")
    assert {r.doc_id: r.text for r in H.join_chunks(ch).collect()} == {1: "ab", 2: "x"}


def test_sample_seeds_without_replacement(spark):
    seeds = spark.createDataFrame([(i * 3, f"in{i}", f"out{i}") for i in range(5)], "pos bigint, input string, output string")
    prompts = spark.range(400).withColumnRenamed("id", "prompt_id")
    got = P.sample_seeds(prompts, seeds, k=3).collect()
    by = {}
    for r in got:
        by.setdefault(r.prompt_id, []).append((r.rank, r.pos))
    assert len(by) == 400
    assert all(sorted(x[0] for x in v) == [1, 2, 3] and len({x[1] for x in v}) == 3 for v in by.values())
    firsts = {}
    for v in by.values():
        p = dict(v)[1]
        firsts[p] = firsts.get(p, 0) + 1
    assert set(firsts) == {0, 3, 6, 9, 12}  # every seed can come first
    with pytest.raises(Exception, match="seed pool"):
        P.sample_seeds(prompts, seeds.limit(2), k=3).collect()


def test_procedural_ranges(spark):
    g = P.generate_count(spark, 3000).collect()
    types = {r.task_type for r in g}
    assert types == {t["task_type"] for t in P.TASKS}
    for r in g:
        doc = json.loads(r.output)
        assert doc["task_type"] == r.task_type and r.instruction == P.PROC_INSTRUCTION
        if r.task_type == "simple_tag":
            pred, prey = doc["agents_config"][0]["count"], doc["agents_config"][1]["count"]
            assert 2 <= pred <= 6 and 1 <= prey <= 3
            assert f"释放{prey}架诱饵机" in r.input and f"出动{pred}架拦截机" in r.input
            assert doc["rl_parameters"]["capture_reward"] in (40.0, 60.0, 80.0, 100.0)
            assert '"capture_reward": ' in r.output and ".0" in r.output
        if r.task_type == "survival_evasion":
            assert doc["agents_config"][0]["count"] == "all"
        assert r.output == json.dumps(doc, ensure_ascii=False)


def test_apply_generator_captures_errors(spark):
    def gen(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("HTTP 503 upstream")
        return [t.upper() for t in texts]

    df = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, "fine")], "prompt_id bigint, prompt string")
    got = {r.prompt_id: (r.body, r.error) for r in P.apply_generator(df, gen).collect()}
    assert got == {1: ("OK", None), 2: (None, "HTTP 503 upstream"), 3: ("FINE", None)}


def test_answers_survive_a_restart(spark, scratch):
    """Calls are counted in a folder: one file per prompt asked."""
    calls, path = os.path.join(scratch, "calls"), os.path.join(scratch, "answers")
    os.makedirs(calls)
    rows = [(i, f"prompt {i}") for i in range(40)] + [(3, "prompt 3"), (3, "a second text"), (None, "no key"), (90, None), (2**60 + 1, "long key")]
    df = spark.createDataFrame(rows, "prompt_id bigint, prompt string")

    def generator(stopped, refused):
        def gen(texts):
            if any(t in refused for t in texts):
                raise RuntimeError("HTTP 429")
            for t in texts:
                with open(os.path.join(calls, uuid.uuid4().hex), "w") as f:
                    f.write(str(t))
                if t == stopped:
                    raise SystemExit("lost")  # no answer: the whole run ends
            return [f"<{t}>" for t in texts]

        return gen

    def asked():
        return sorted(open(os.path.join(calls, f)).read() for f in os.listdir(calls))

    waves = df.select("prompt", F.pmod(F.xxhash64("prompt_id"), F.lit(4)).alias("w")).filter("prompt LIKE 'prompt%'")
    last = waves.orderBy(F.desc("w"), "prompt").first()["prompt"]  # in the last wave
    with pytest.raises(PySparkException):
        P.answer_prompts(df, generator(last, ("prompt 7",)), path, waves=4, at_once=2, batch=1)
    held = {r.prompt_id for r in spark.read.parquet(path).filter("error IS NULL").collect()}
    before = asked()
    assert held and len(held) < 43
    got = P.answer_prompts(df, generator(None, ()), path, waves=4, at_once=2, batch=1).collect()
    again = asked()
    assert len(again) - len(before) == 43 - len(held)  # what is held is not asked again
    answers = {r.prompt_id: (r.body, r.error) for r in got}
    want = {i: (f"<prompt {i}>", None) for i in range(40)}
    assert len(got) == 43 and answers == {**want, 3: ("<a second text>", None), None: ("<no key>", None), 90: ("<None>", None), 2**60 + 1: ("<long key>", None)}
    assert {r.attempt for r in got if r.prompt_id not in held} == {2}
    P.answer_prompts(df, generator(None, ()), path, waves=4, batch=1)
    assert asked() == again  # nothing is left to ask
    none = P.answer_prompts(df.limit(0), generator(None, ()), os.path.join(scratch, "empty"))
    assert none.columns == ["prompt_id", "body", "error", "attempt"] and none.count() == 0


def test_waves_grow_with_the_prompts(spark, scratch, monkeypatch):
    monkeypatch.setattr(P, "CALL_BYTES", 2000)
    df = spark.range(400).select(F.col("id").alias("prompt_id"), F.rpad(F.concat(F.lit("p"), "id"), 100, "x").alias("prompt")).union(
        spark.createDataFrame([(None, "no key"), (7, "a"), (401, None)], "prompt_id bigint, prompt string")
    )

    def gen(texts):
        if any(t and t.startswith("p1") for t in texts):
            raise RuntimeError("HTTP 429")
        return [f"<{t}>" for t in texts]

    path = os.path.join(scratch, "answers")
    asked = lambda: spark.read.parquet(path).groupBy("attempt", "wave", F.input_file_name().alias("f")).count().collect()
    P.answer_prompts(df, gen, path, waves=1, at_once=2)
    first = asked()
    assert sum(r["count"] for r in first) == 402 and max(r["count"] for r in first) <= 60  # 20 on average, by a hash
    assert {sum(r.wave == w for r in first) for w in range(10)} <= {1, 2}  # tasks of a wave
    got = P.answer_prompts(df, lambda texts: [f"<{t}>" for t in texts], path, waves=1, at_once=2).collect()
    assert {r.prompt_id: r.body for r in got} == {r.prompt_id: f"<{r.prompt}>" for r in df.groupBy("prompt_id").agg(F.min("prompt").alias("prompt")).collect()}
    refused = [r for r in asked() if r.attempt == 2]
    assert sum(r["count"] for r in refused) == 111 and len({r.wave for r in refused}) == 3  # fewer are left, so fewer waves


def test_plan_requests(spark):
    t = spark.createDataFrame([(1, 120), (2, 0), (3, 50)], "run_id bigint, target bigint")
    got = sorted(tuple(r) for r in P.plan_requests(t, 50).collect())
    assert got == [(1, 0, 0, 50), (1, 1, 50, 50), (1, 2, 100, 20), (3, 0, 0, 50)]


def test_rank_and_running_keep_null_keys(spark):
    df = spark.createDataFrame([(None, None, 1), (1, None, 2), (1, 5, 3), (None, 2, 4), (1, 1, 5)], "g bigint, seq bigint, x bigint")
    r = global_rank(df, ["seq"], F.shiftright("seq", 1), within=["g"], name="r")
    got = {(row.g, row.seq): row.r for row in r.collect()}
    assert got[(1, None)] == 1 and got[(1, 1)] == 2 and got[(1, 5)] == 3
    assert got[(None, None)] == 1 and got[(None, 2)] == 2
    assert r.count() == 5
    run = running(df, ["g"], ["seq"], F.shiftright("seq", 1), sums={"s": F.col("x")})
    assert run.count() == 5
    assert {(row.g, row.seq): row.s for row in run.collect()}[(1, 5)] == 10


def test_append_once(spark, scratch):
    path = os.path.join(scratch, "named")
    a = spark.createDataFrame([(0, "a"), (1, "b")], "pos bigint, v string")
    b = spark.createDataFrame([(0, "c"), (1, "d"), (2, None)], "pos bigint, v string")

    def rows():
        return sorted((r.pos, r.v, r.batch_id) for r in spark.read.parquet(path).collect())

    done = IO.append_once(spark, path, a, "one")
    assert (done.appended, done.total) == (2, 2)
    # a run that was stopped: some rows of the batch, no success mark
    marks = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    b.limit(1).write.option(marks, "false").parquet(os.path.join(path, "batch_id=two"))
    done = IO.append_once(spark, path, a, "three")
    assert (done.appended, done.total) == (2, 5)
    done = IO.append_once(spark, path, b, "two")
    assert (done.appended, done.total) == (3, 7)
    held = rows()
    assert held == [(0, "a", "one"), (1, "b", "one"), (2, "a", "three"), (3, "b", "three"), (4, "c", "two"), (5, "d", "two"), (6, None, "two")]
    never = a.withColumn("v", F.raise_error(F.lit("computed again")).cast("string"))
    done = IO.append_once(spark, path, never, "one")  # a replay
    assert (done.appended, done.total) == (2, 7) and rows() == held
    done = IO.append_once(spark, path, a.limit(0), "none")
    assert (done.appended, done.total) == (0, 7) and sorted(done.table.columns) == ["batch_id", "pos", "v"]
    for name in ("", "a/b", "_x", "a=b"):
        with pytest.raises(ValueError):
            IO.append_once(spark, path, a, name)
    with pytest.raises(ValueError):
        IO.append_once(spark, path, a.withColumn("batch_id", F.lit(1)), "four")


def test_append_to_path_and_parquet_landing(spark, scratch):
    batch = spark.createDataFrame([(0, "c"), (1, "d")], "pos bigint, v string")
    missing = os.path.join(scratch, "nothing-here")
    done = IO.append_batch_to(spark, missing, batch)
    assert (done.appended, done.total) == (2, 2) and sorted(map(tuple, done.table.collect())) == [(0, "c"), (1, "d")]
    target = os.path.join(scratch, "ds")
    spark.createDataFrame([(0, "a")], "pos bigint, v string").write.parquet(target)
    done = IO.append_batch_to(spark, target, batch)
    assert (done.appended, done.total) == (2, 3)
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(0, "a"), (1, "c"), (2, "d")]
    assert IO.append_batch_to(spark, target, batch).total == 5
    corrupt = os.path.join(scratch, "corrupt")
    os.makedirs(corrupt)
    with open(os.path.join(corrupt, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        IO.append_batch_to(spark, corrupt, batch)
    assert IO.append_batch_to(spark, corrupt, batch, on_corrupt="empty").total == 2
    land = os.path.join(scratch, "land")
    spark.createDataFrame([(0, json.dumps({"instruction": "i", "input": "x", "output": D}))], "pos bigint, item string").write.parquet(land)
    got = IO.read_records_lines(spark, land, fmt="parquet")
    assert [r.label for r in C.classify(got).collect()] == ["valid"]


def test_generation_and_sample_jobs(spark):
    from sifter.plans import jobs

    seeds = spark.createDataFrame([(i, "ins", f"in{i}", D) for i in range(4)], "pos bigint, instruction string, input string, output string")
    prompts = spark.createDataFrame([(p, 2) for p in range(5)], "prompt_id bigint, n_items int")
    ds, stats = jobs.generation_job(prompts, seeds, P.echo_generator, target=3)
    rows = ds.collect()
    assert len(rows) == 4 + 3 and sum(r.source == "generated" for r in rows) == 3
    assert {r.status for r in stats.collect()} == {"ok"}
    recs = spark.createDataFrame([(i, "", f"question {i}", f"answer {i}") for i in range(20)], "pos bigint, instruction string, input string, output string")
    batches, drops = jobs.sample_job(recs, batch_size=4)
    b = batches.collect()
    assert len(b) == 20 and drops.count() == 0
    for r in b:
        assert len(r.input_ids) == len(r.labels) == len(r.attention_mask) == r.width
    widths = {}
    for r in b:
        widths.setdefault((r.split, r.batch_id), set()).add(r.width)
    assert all(len(v) == 1 for v in widths.values())


def test_classify_exact_matches_python_on_traps(spark, scratch):
    dup = '{"task_type": "t", "agents_config": [], "rl_parameters": {}, "task_type": "u"}'
    nan = '{"task_type": "t", "agents_config": [], "rl_parameters": {"x": NaN}}'
    items = [c[0] for c in CLEAN_CASES] + [rec(dup), rec(nan)]
    path = os.path.join(scratch, "traps.json")
    write_array(path, items)
    raw = IO.read_records(spark, path)
    exact = {r.pos: r.label for r in C.classify(raw, exact=True).collect()}
    native = {r.pos: r.label for r in C.classify(raw).collect()}
    n = len(CLEAN_CASES)
    assert [exact[i] for i in range(n)] == [c[1] for c in CLEAN_CASES]
    assert exact[n] == "valid" and exact[n + 1] == "valid"
    assert native[n] == "output_json_error" and native[n + 1] == "output_json_error"


def test_tokenizer_hook_in_encode(spark):
    def words(texts):
        return [[len(w) for w in t.split()] for t in texts]

    enc = S.tokenizer_udf(words)
    df = spark.createDataFrame([(0, "aa bbb c", "dd e", None)], "pos bigint, prompt string, answer string, drop_reason string")
    r = S.encode(df, encoder=enc, max_length=4).collect()[0]
    assert r.input_ids == [3, 1, 2, 1] and r.labels == [-100, -100, 2, 1] and r.attention_mask == [1, 1, 1, 1]
    assert (r.n_prompt, r.n_answer) == (3, 2)


def test_records_from_items_falsy_rules(spark, scratch):
    items = [
        {"instruction": 0, "input": False, "output": "  ok "},
        {"instruction": [], "input": {}, "output": 0},
        {"instruction": None, "input": "x", "output": None},
        {"instruction": "i", "output": "o"},
        {"instruction": {"a": 1}, "input": 5, "output": [1]},
        {"instruction": "i", "input": "x", "output": "   "},
        "not a record",
    ]
    path = os.path.join(scratch, "items.json")
    write_array(path, items)
    got = {r.pos: (r.instruction, r.input, r.output, r.drop_reason) for r in S.records_from_items(IO.read_records(spark, path)).collect()}
    assert got[0] == ("", "", "ok", None)
    assert got[1] == ("", "", "0", None)
    assert got[2][3] == "output_missing"
    assert got[3] == ("i", "", "o", None)
    assert got[4] == ('{"a":1}', "5", "[1]", None)
    assert got[5][3] == "output_blank"
    assert got[6][3] == "invalid_item"


def test_resume_from_path(spark, scratch):
    seed = spark.createDataFrame([(0, "s")], "pos bigint, v string")
    assert K.resume_from(spark, os.path.join(scratch, "missing"), seed).count() == 0
    ck = os.path.join(scratch, "ck")
    spark.createDataFrame([(0, "s"), (1, "g")], "pos bigint, v string").write.parquet(ck)
    assert [tuple(r) for r in K.resume_from(spark, ck, seed).collect()] == [(0, "g")]


def test_append_to_array_file(spark, scratch):
    batch = spark.createDataFrame([(0, '{"a": 1}')], "pos bigint, t string").select("pos", F.parse_json("t").alias("item"))
    good = os.path.join(scratch, "good.json")
    write_array(good, [{"x": 1}, 2])
    done = IO.append_batch_to(spark, good, batch, fmt="array", write_to=os.path.join(scratch, "appended"))
    assert sorted(r.pos for r in done.table.collect()) == [0, 1, 2]
    with pytest.raises(ValueError):
        IO.append_batch_to(spark, good, batch, fmt="array")
    obj = os.path.join(scratch, "obj.json")
    with open(obj, "w") as f:
        json.dump({"a": 1}, f)
    for mode in ("fail", "empty"):
        with pytest.raises(ValueError, match="not a JSON list"):
            IO.append_batch_to(spark, obj, batch, on_corrupt=mode, fmt="array", write_to=os.path.join(scratch, "never"))
    broken = os.path.join(scratch, "broken.json")
    with open(broken, "w") as f:
        f.write("[{\"a\": 1},")
    with pytest.raises(ValueError, match="not valid JSON"):
        IO.append_batch_to(spark, broken, batch, fmt="array", write_to=os.path.join(scratch, "never"))
    assert IO.append_batch_to(spark, broken, batch, on_corrupt="empty", fmt="array", write_to=os.path.join(scratch, "anew")).total == 1
    assert IO.append_batch_to(spark, os.path.join(scratch, "none.json"), batch, fmt="array", write_to=os.path.join(scratch, "first")).total == 1


def test_report_text(spark, scratch):
    path = os.path.join(scratch, "r.json")
    write_array(path, [c[0] for c in CLEAN_CASES])
    text = C.report_text(C.validation_report(C.classify(IO.read_records(spark, path)))).first()["report"]
    lines = text.split("\n")
    assert lines[3] == f"Total:  {len(CLEAN_CASES)}"
    assert lines[4] == f"Valid:  3 ({3 / len(CLEAN_CASES) * 100:.2f}%)"
    assert lines[6:] == ["invalid_item: 4", "missing_keys: 1", "output_json_error: 9", "output_missing_keys: 1", "output_invalid_types: 4"]


def test_sample_properties_on_real_transcripts(spark):
    from sifter.sources import adapters as A

    from .conftest import SF001

    samples, drops = S.build_samples(A.sft_records(spark, SF001), max_length=256)
    rows = samples.collect()
    assert rows
    for r in rows:
        assert len(r.input_ids) == len(r.labels) == len(r.attention_mask) == r.n_tokens <= 256
        assert any(x != -100 for x in r.labels)
        k = next(i for i, x in enumerate(r.labels) if x != -100)
        assert all(x == -100 for x in r.labels[:k]) and r.labels[k:] == r.input_ids[k:]


@pytest.mark.parametrize("parts", [1, 4, 32])
def test_batches_and_finalize_independent_of_partitioning(spark, parts):
    df = spark.range(0, 3000, 3).withColumnRenamed("id", "pos").withColumn("v", F.col("pos") * 2).repartition(parts)
    got = sorted((r.pos, r.batch_id) for r in S.assign_batches(df, 7).collect())
    assert got == [(p, i // 7) for i, p in enumerate(range(0, 3000, 3))]
    seed = spark.createDataFrame([(0, -1)], "pos bigint, v bigint")
    fin = K.finalize_dataset(seed, df, 10).collect()
    assert sorted(r.v for r in fin if r.source == "generated") == [p * 2 for p in range(0, 30, 3)]


def test_json_lines_positions_across_many_splits(spark, scratch):
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "2048")  # cut each file into many splits
    try:
        paths = []
        for f in range(2):
            p = os.path.join(scratch, f"part{f}.jsonl")
            with open(p, "w", encoding="utf-8") as fh:
                for i in range(400):
                    fh.write(json.dumps({"instruction": "i", "input": f"{f}:{i}", "output": D}, ensure_ascii=False) + "\n")
            paths.append(p)
        assert spark.read.text(paths).rdd.getNumPartitions() > 10  # many splits per file
        df = IO.read_records_lines(spark, paths)
        rows = df.select("file", "pos", F.try_variant_get("item", "$.input", "string").alias("inp")).collect()
        for r in rows:
            f, i = r.inp.split(":")
            assert r.file.endswith(f"part{f}.jsonl") and r.pos == int(i)
        assert len(rows) == 800
    finally:
        spark.conf.set(key, old)


@pytest.mark.parametrize("text", ["[1,2] x", "[1,2]]", "[1,2] [3]", "[1,", " "])
def test_array_files_must_be_exactly_one_array(spark, scratch, text):
    path = os.path.join(scratch, "bad.json")
    with open(path, "w") as f:
        f.write(text)
    with pytest.raises(Exception, match="JSON list"):
        IO.read_records(spark, path).collect()


def test_array_file_with_whitespace_and_scalars(spark, scratch):
    path = os.path.join(scratch, "ok.json")
    with open(path, "w") as f:
        f.write(' \n [1, "a", null, {"x": [2]}] \n')
    got = sorted((r.pos, r.k) for r in IO.read_records(spark, path).select("pos", C.J.json_kind(F.col("item")).alias("k")).collect())
    assert got == [(0, "number"), (1, "string"), (2, "null"), (3, "object")]


def test_offsets_stay_bounded_for_sparse_keys_and_hot_runs(spark, monkeypatch):
    """One run holds most rows and every row has a bucket of its own: no window of the offsets spans the run."""
    from sifter.operators import rank, seq

    n, hot = 6000, 5000
    df = spark.range(n).select(
        F.when(F.col("id") < hot, F.lit(1)).otherwise(F.col("id")).cast("bigint").alias("run_id"),
        (F.col("id") * 7919 % n * (1 << 20)).alias("seq"), (F.col("id") % 7).alias("x"),
    )
    bucket = F.shiftright("seq", 20)
    counts = rank.with_super(df.groupBy("run_id", bucket.alias("_bkt")).count())
    assert counts.filter("run_id = 1").count() == hot  # the table of counts is as long as the run
    monkeypatch.setattr(rank, "SUPER_BITS", 6)
    counts = rank.with_super(df.groupBy("run_id", bucket.alias("_bkt")).count())
    inside = counts.groupBy("run_id", "_sup").count().agg(F.max("count")).first()[0]
    across = counts.select("run_id", "_sup").distinct().groupBy("run_id").count().agg(F.max("count")).first()[0]
    assert inside <= 64 and across <= -(-n // 64)
    w = Window.partitionBy("run_id").orderBy("seq")
    got = global_rank(df, ["seq"], bucket, within=["run_id"], name="r").withColumn("w", F.row_number().over(w))
    assert got.filter("r <> w").count() == 0
    run = seq.running(df, ["run_id"], ["seq"], bucket, sums={"s": F.col("x")}, maxes={"m": F.col("x")}, lags={"l": F.col("x")})
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = run.select("*", F.sum("x").over(upto).alias("s2"), F.max("x").over(upto).alias("m2"), F.lag("x").over(w).alias("l2"))
    assert want.filter("s <> s2 OR m <> m2 OR NOT l <=> l2").count() == 0


@pytest.mark.parametrize("factor", [0.0, 0.85, 0.99, 0.999])
def test_smoothing_has_no_horizon(spark, factor):
    vals = [100.0] * 500 + [float(i % 13) for i in range(4500)]
    df = spark.createDataFrame([(1, "loss", 3 * i, v) for i, v in enumerate(vals)], "run_id bigint, name string, step bigint, value double")
    got = [r.smoothed for r in M.smooth(df, factor).orderBy("step").collect()]
    assert max(abs(a - b) for a, b in zip(got, smooth_py(vals, factor))) < 1e-9 and len(got) == len(vals)


def test_records_across_gaps_and_large_turns(spark):
    rows = [(0, 0, "user", "q0"), (0, 2, "assistant", "a0"), (0, 1_000_000, "user", "q1"), (0, 1_000_007, "assistant", "a1"), (1, 0, "user", "q2"), (1, 1, "system", "s"), (1, 2, "assistant", "lost"), (1, 3, "user", "q3"), (1, 5, "assistant", "a3")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted(tuple(r) for r in H.transcript_to_records(df).collect())
    assert got == [(0, "", "q0", "a0"), (1, "", "q1", "a1"), (2, "s", "q3", "a3")]


def test_many_files_keep_their_rows(spark, scratch):
    from sifter.plans import jobs

    for name in ("a", "b"):
        with open(os.path.join(scratch, f"{name}.json"), "w") as f:
            json.dump([{"instruction": "", "input": f"{name}{i}", "output": f"answer {name}{i}"} for i in range(2)] + [3], f)
    raw = IO.read_records(spark, scratch)
    batches, drops = jobs.sample_job(raw, batch_size=3)
    rows = batches.collect()
    assert len(rows) == 4 and sorted(r.pos for r in rows) == [0, 1, 2, 3]
    assert [tuple(r) for r in drops.collect()] == [("invalid_item", 2)]
    with pytest.raises(ValueError):
        jobs.sample_job(raw.filter("pos = 2"))
    assert jobs.drop_staged(spark) > 0


def test_streak_counts_batches_given_up(spark):
    timeout, bad = "timed out", "HTTP 400: bad request"
    log = [(1, s, None, s % 5, 50 if s % 5 < 4 else 5, 0, timeout) for s in range(20)]  # four batches, five attempts each
    log += [(2, 0, None, 0, 1, 0, bad), (2, 1, None, 0, 1, 1, None), (2, 2, None, 0, 1, 0, bad), (2, 3, None, 0, 1, 0, bad)]
    df = spark.createDataFrame(log, "run_id bigint, seq bigint, ts timestamp_ntz, attempt int, batch_size int, n_items int, error string")
    got = {(r.run_id, r.seq): (r.given_up, r.streak, r.stop_flag) for r in Q.failure_streaks(df, limit=4).collect()}
    assert got[(1, 19)] == (True, 4, True) and got[(1, 18)] == (False, 3, False) and got[(1, 4)] == (True, 1, False)
    assert [got[(2, s)][1] for s in range(4)] == [1, 0, 1, 2]


def test_checkpoint_marks_once_per_total(spark):
    log = [(1, s, None, 0, 50, 50, None) for s in range(45)]
    df = spark.createDataFrame(log, "run_id bigint, seq bigint, ts timestamp_ntz, attempt int, batch_size int, n_items int, error string")
    got = sorted((r.seq, r.total) for r in Q.checkpoint_marks(Q.run_progress(df)).collect())
    assert got == [(2 * k - 1, 100 * k) for k in range(1, 21)]
    stop = df.withColumn("error", F.when(F.col("seq") == 3, F.lit("model is no longer available")))
    marks = Q.checkpoint_marks(Q.run_progress(Q.request_actions(stop), target=100_000))
    assert (3, "stop") in {(r.seq, r.action) for r in marks.collect()}


def test_written_records_are_the_read_ones(spark, scratch):
    from sifter.plans import jobs

    doc = json.dumps({"task_type": "t", "agents_config": [], "rl_parameters": {"z": 1.50, "a": 100.0}})
    texts = ['{"b": 100.0, "a": 1.50, "n": 123456789012345678901234567890, "instruction": "i", "input": "x", "output": %s}' % json.dumps(doc), '"text"', "null", "7.0"]
    src, lines = os.path.join(scratch, "in.json"), os.path.join(scratch, "lines")
    with open(src, "w") as f:
        f.write("[" + ",\n ".join(texts) + "]")
    raw = IO.read_records(spark, src, with_text=True)
    assert [r.text for r in raw.orderBy("pos").collect()] == texts
    IO.write_records(raw, lines, "jsonl")
    assert sorted(r.text for r in IO.read_records_lines(spark, lines).collect()) == sorted(texts)
    report = jobs.clean_files(spark, src, os.path.join(scratch, "out"), fmt="array").first()
    assert (report.total, report.valid, report.invalid_item) == (4, 1, 3)
    assert [r.value for r in spark.read.text(os.path.join(scratch, "out", "clean")).collect()] == [texts[0]]
    assert sorted(r.text for r in spark.read.json(os.path.join(scratch, "out", "quarantine")).collect()) == sorted(texts[1:])
    jobs.clean_files(spark, src, os.path.join(scratch, "small"), fmt="array", minify_output=True)
    kept = json.loads(spark.read.text(os.path.join(scratch, "small", "clean")).first().value)
    assert list(kept) == list(json.loads(texts[0])) and kept["output"] == json.dumps(json.loads(doc), separators=(",", ":"))


def test_empty_array_file_fails(spark, scratch):
    open(os.path.join(scratch, "zero.json"), "w").close()
    with pytest.raises(ValueError):
        IO.read_records(spark, scratch)


def test_exact_output_keeps_keys_and_numbers(spark):
    item = '[{"instruction": "i", "input": "x", "output": {"b": 100.0, "a": [1, 2.50], "n": 12345678901234567890123}}]'
    body = json.dumps({"choices": [{"message": {"content": item}}]})
    items, _ = R.parse_responses(spark.createDataFrame([(1, body)], "request_id bigint, body string"), exact=True)
    assert items.first().output == '{"b": 100.0, "a": [1, 2.5], "n": 12345678901234567890123}'


def test_failed_prompts_are_in_the_stats(spark):
    from sifter.plans import jobs

    calls = []

    def flaky(texts):
        if any("生成 7 条" in t for t in texts):
            raise RuntimeError("no luck")
        return P.echo_generator(texts)

    seeds = spark.createDataFrame([(i, "ins", f"in{i}", D) for i in range(4)], "pos bigint, instruction string, input string, output string")
    prompts = spark.createDataFrame([(p, 7 if p == 2 else 2) for p in range(5)], "prompt_id bigint, n_items int")
    ds, stats = jobs.generation_job(prompts, seeds, flaky, target=10)
    got = {r.prompt_id: (r.status, r.error) for r in stats.collect()}
    assert got == {p: ("request_error", "no luck") if p == 2 else ("ok", None) for p in range(5)}
    assert ds.filter("source = 'generated'").count() == 4 and not calls
    short = P.apply_generator(spark.createDataFrame([(1, "p")], "id bigint, prompt string"), lambda t: [], keys=["id"]).first()
    assert short.body is None and "0 bodies for 1" in short.error


def test_unknown_role_and_empty_text(spark):
    df = spark.createDataFrame([(0, "o", None)], "pos bigint, output string, drop_reason string")
    msgs = df.withColumn("messages", F.array(F.struct(F.lit("tool").alias("role"), F.lit("x").alias("content"))))
    with pytest.raises(Exception, match="chat template"):
        S.render_prompt(msgs).collect()
    assert spark.range(1).select(S.code_points(F.lit("")).alias("c")).first().c == []


def test_resume_raises_what_is_not_a_missing_table(spark, scratch):
    seed = spark.createDataFrame([(0, "s")], "pos bigint, input string")
    with pytest.raises(Exception):
        K.resume_from(spark, "nosuchscheme://x/y", seed)
    broken = os.path.join(scratch, "broken")
    os.makedirs(broken)
    with open(os.path.join(broken, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    assert K.resume_from(spark, broken, seed).count() == 0
