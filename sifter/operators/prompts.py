"""Few-shot prompts, request plans, a generator hook and template generation.

Randomness is a hash: ``draw(seed, key, slot) = int(md5("seed:key:slot")[:8], 16)``.
It is repeatable for any partitioning and states the same in any SQL engine.
It does not reproduce Python's ``random`` stream (no engine can do that in
parallel); ranges, choices and without-replacement guarantees are the same.
"""
from __future__ import annotations

import string
from collections.abc import Callable

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import MISSING
from .rank import global_rank, pos_bucket

# Sampling and plan defaults of the generator.
SAMPLE_SIZE = 3
BATCH_SIZE = 50
REQUEST_BLOCK = 10_000  # requests planned from one array
CALL_BYTES = 64 << 20  # prompt text that one task of a wave is given, about
SEED = 42

# The few-shot prompt text, as format strings.
PROMPT_TEMPLATE = {
    "header": (
        "你是一个强化学习与具身智能领域的数据生成专家。"
        "请模仿下面示例的格式，生成 {n} 条全新的无人机集群调度任务数据。\n\n"
        "要求：\n"
        "1. input 必须是自然语言战术意图。\n"
        "2. output 必须是严格 JSON 字符串，且与 input 对应。\n"
        "3. 不要与示例重复，场景可创新（如反潜、电磁静默、诱捕、搜救、星际探索等）。\n"
        "4. 输出必须是严格 JSON 数组，每个元素是 JSON 对象。\n\n"
        "### 示例开始 ###\n"
    ),
    "example": "【例子 {idx}】\nInput: {input}\nOutput: {output}\n\n",
    "footer": (
        "### 示例结束 ###\n\n"
        "请只输出 JSON 数组，数组元素仅包含 instruction、input、output 三个字段。"
        "不要输出任何额外解释。"
    ),
}


def draw(seed: int, key: Column, slot) -> Column:
    """A 60-bit hash draw for (seed, key, slot) as BIGINT."""
    slot_c = slot if isinstance(slot, Column) else F.lit(str(slot))
    h = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"), F.lit(":"), slot_c.cast("string")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def fill(template: str, values: dict[str, Column]) -> Column:
    """Render a ``str.format``-style template with Column values (no re-scanning
    of inserted text, so values may contain braces)."""
    parts = []
    for literal, field, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(values[field].cast("string"))
    return F.concat(*parts) if parts else F.lit("")


# ------------------------------------------------------------------ P1, P2


POOL_BYTES = 64 << 20  # a seed pool whose columns take up to this many bytes (checked) is broadcast


def _picks(prompts: DataFrame, pool: DataFrame, k: int, seed: int, key: str) -> DataFrame:
    """``prompts`` with ``_picks``: k distinct indices of the pool, in sample order."""
    m = pool.select(F.count(F.lit(1))).scalar()
    p = prompts.withColumn("_m", m)
    p = p.withColumn(
        "_m",
        F.when(F.col("_m") < k, F.raise_error(F.lit(f"seed pool smaller than sample size {k}"))).otherwise(F.col("_m")),
    )

    def step(acc, j):
        r = draw(seed, F.col(key), j) % (F.col("_m") - j)
        pick = F.aggregate(F.array_sort(acc), r, lambda x, c: x + F.when(x >= c, 1).otherwise(0))
        return F.concat(acc, F.array(pick))

    picks = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), F.array().cast("array<bigint>"), step)
    return p.withColumn("_picks", picks).drop("_m")


def _indexed(seeds: DataFrame) -> DataFrame:
    return global_rank(seeds, ["pos"], pos_bucket("pos"), name="_idx").withColumn("_idx", F.col("_idx") - 1)


def _small(pool: DataFrame) -> bool:
    """Whether all columns of the pool together stay within ``POOL_BYTES`` (one aggregate over the pool)."""
    size = F.lit(0).cast("bigint")
    for c, t in pool.dtypes:
        size = size + (F.coalesce(F.octet_length(c), F.lit(0)) if t == "string" else F.lit(16))
    return (pool.agg(F.sum(size)).first()[0] or 0) <= POOL_BYTES


def sample_seeds(prompts: DataFrame, seeds: DataFrame, k: int = SAMPLE_SIZE, seed: int = SEED, key: str = "prompt_id") -> DataFrame:
    """k distinct seed records per prompt, uniformly without replacement.

    Draw j picks uniformly among the m - j seeds not chosen yet (one hash per
    draw, mapped past the earlier picks), so each prompt yields k distinct
    seed indices. The picks meet the seed pool by an equi-join on the index: a
    broadcast one if the pool is small (checked), so the prompts are not
    shuffled. Fails when the pool has fewer than k seeds. Output: key,
    ``rank`` (1..k, sample order), seed columns.
    """
    pool = _indexed(seeds)
    chosen = _picks(prompts.select(key), seeds, k, seed, key).select(key, F.posexplode("_picks").alias("_j", "_idx"))
    out = chosen.join(F.broadcast(pool) if _small(seeds) else pool, "_idx", "inner")
    return out.select(key, (F.col("_j") + 1).alias("rank"), *[c for c in seeds.columns]).drop("_idx")


def _example(template: dict, rank, input_: Column, output: Column) -> Column:
    return fill(template["example"], {"idx": rank, "input": input_, "output": output})


def _prompt_text(template: dict, n: Column, body: Column) -> Column:
    return F.concat(fill(template["header"], {"n": n}), body, F.lit(template["footer"]))


def build_prompts(sampled: DataFrame, prompts: DataFrame, template: dict = PROMPT_TEMPLATE, key: str = "prompt_id", n_col: str = "n_items") -> DataFrame:
    """One few-shot prompt per prompt row: header with n, numbered examples in
    sample order, footer (P2). A prompt's group holds only its k samples."""
    ex = sampled.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "input", "output"))).alias("_ex"))
    body = F.array_join(F.transform("_ex", lambda e: _example(template, e["rank"], e["input"], e["output"])), "")
    joined = prompts.select(key, n_col).join(ex, key, "inner")
    return joined.select(key, n_col, _prompt_text(template, F.col(n_col), body).alias("prompt"))


def sampled_prompts(
    prompts: DataFrame, seeds: DataFrame, k: int = SAMPLE_SIZE, seed: int = SEED, template: dict = PROMPT_TEMPLATE, key: str = "prompt_id", n_col: str = "n_items"
) -> DataFrame:
    """P1 and P2 together: (key, n_items, prompt).

    With a small pool (checked) every prompt row looks up its k seeds in a
    broadcast table, one lookup per sample, and is finished where it lies: no
    shuffle. A larger pool takes the join of :func:`sample_seeds`.
    """
    if not _small(seeds):
        return build_prompts(sample_seeds(prompts, seeds, k, seed, key), prompts, template, key, n_col)
    pool = _indexed(seeds).select("_idx", "input", "output")
    rows = _picks(prompts.select(key, n_col), seeds, k, seed, key)
    for j in range(k):
        one = pool.select(F.col("_idx").alias(f"_i{j}"), _example(template, F.lit(j + 1), F.col("input"), F.col("output")).alias(f"_e{j}"))
        rows = rows.withColumn("_at", F.element_at("_picks", j + 1)).join(F.broadcast(one), F.col("_at") == F.col(f"_i{j}"))
    body = F.concat(*[F.col(f"_e{j}") for j in range(k)])
    return rows.select(key, n_col, _prompt_text(template, F.col(n_col), body).alias("prompt"))


# ---------------------------------------------------------------------- P3


def plan_requests(targets: DataFrame, batch: int = BATCH_SIZE) -> DataFrame:
    """Requests of ``min(batch, remaining)`` items until each run's target.

    ``targets(run_id, target)`` -> ``(run_id, request_no, before, batch_size)``.
    """
    n = F.ceil(F.col("target") / batch).cast("bigint")
    parts = targets.select("run_id", "target", n.alias("_n")).filter(F.col("target") > 0)
    # in two steps, so a huge run is no single huge array
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(REQUEST_BLOCK).cast("bigint")))
    parts = parts.select("run_id", "target", "_n", first.alias("_from"))
    upto = F.least(F.col("_from") + REQUEST_BLOCK, F.col("_n")) - 1
    rows = parts.select("run_id", "target", F.explode(F.sequence("_from", upto)).alias("request_no"))
    before = (F.col("request_no") * batch).cast("bigint")
    return rows.select(
        "run_id",
        F.col("request_no").cast("bigint").alias("request_no"),
        before.alias("before"),
        F.least(F.lit(batch).cast("bigint"), F.col("target") - before).alias("batch_size"),
    )


# ---------------------------------------------------------------------- P4


def apply_generator(
    df: DataFrame, fn: Callable[[list[str]], list[str]], col: str = "prompt", keys: list[str] | None = None, batch: int = 64
) -> DataFrame:
    """Run a user generator over prompts, ``batch`` at a time.

    ``fn`` maps a list of prompts to a list of response bodies, one each. A
    call that raises, or that returns another number of bodies, is an error of
    its prompts: a batch of one is recorded with the error text, a larger one
    is asked again in halves, so prompts already answered are not asked twice
    beyond their failed batch. Output: keys, ``body``, ``error``. Write the
    result before parsing it, so a retried task does not call the generator
    for rows already answered.
    """
    keys = keys or [c for c in df.columns if c != col]
    key_schema = ", ".join(f"`{c}` {t}" for c, t in df.select(*keys).dtypes)
    schema = f"{key_schema}, body string, error string"

    def ask(texts):
        try:
            bodies = list(fn(texts))
            if len(bodies) != len(texts):
                raise ValueError(f"generator returned {len(bodies)} bodies for {len(texts)} prompts")
            return [(b, None) for b in bodies]
        except Exception as exc:  # noqa: BLE001 - error text is data
            if len(texts) == 1:
                return [(None, str(exc))]
        half = len(texts) // 2
        return ask(texts[:half]) + ask(texts[half:])

    def run(batches):
        for b in batches:
            texts = b.column(len(keys)).to_pylist()
            answers = [a for at in range(0, len(texts), batch) for a in ask(texts[at : at + batch])]
            told = [pa.array([a[i] for a in answers], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], *told], [*keys, "body", "error"])

    return df.select(*keys, col).mapInArrow(run, schema)


def _held_answers(prompts: DataFrame, key: str, path: str) -> DataFrame | None:
    """Answers written under ``path`` so far, None if there is no such folder."""
    kind = dict(prompts.dtypes)[key]
    schema = f"`{key}` {kind}, body string, error string, attempt int, wave int"
    try:
        return prompts.sparkSession.read.schema(schema).parquet(path)
    except PySparkException as exc:
        if MISSING in str(exc):
            return None
        raise


def answer_prompts(
    prompts: DataFrame,
    fn: Callable[[list[str]], list[str]],
    path: str,
    key: str = "prompt_id",
    col: str = "prompt",
    waves: int = 16,
    at_once: int = 8,
    batch: int = 64,
) -> DataFrame:
    """Answers to ``prompts``, kept in a table at ``path`` so that a restarted
    run asks only for what is missing (P4, S6).

    Prompts are dealt to waves by a hash of their key: to ``waves``, or to more
    if a task would else get over ``CALL_BYTES`` of text. A wave is one job
    with at most ``at_once`` tasks, so at most that many calls are under way;
    its answers are written to their own folder when it ends. A run that is
    stopped has lost the wave under way alone: the next one takes the prompts
    that an anti-join with the table leaves, and writes to a folder of a new
    attempt, so it replaces nothing. An error is written too, and asked again
    by the next run. The table is never taken for empty because it can't be
    read: that is raised.

    -> (key, body, error, attempt), one row per key: its answer, else its last
    error. Rows that share a key (NULL is one) are asked once, with the least
    prompt; a NULL prompt is passed to ``fn`` as None.
    """
    spark = prompts.sparkSession
    held = _held_answers(prompts, key, path)
    last = held.agg(F.max("attempt")).first()[0] if held is not None else None

    def missing(rows):
        if held is None:
            return rows
        done = held.filter("error IS NULL").select(F.col(key).alias("_done"))
        return rows.join(done, F.col(key).eqNullSafe(F.col("_done")), "left_anti")

    size = missing(prompts.select(key, F.octet_length(col).alias("_n"))).agg(F.sum("_n")).first()[0] or 0
    waves = max(waves, -(-size // (at_once * CALL_BYTES)))
    todo = missing(prompts.select(key, col)).groupBy(key).agg(F.min(col).alias(col))
    todo_path = f"{path.rstrip('/')}-todo"
    h = F.xxhash64(key)
    wave = F.pmod(h, F.lit(waves)).cast("int")
    part = F.pmod(F.xxhash64(h), F.lit(at_once)).cast("int")  # of a wave: one task writes it, and asks it
    dealt = todo.withColumn("wave", wave).repartitionById(waves * at_once, F.col("wave") * at_once + part)
    dealt.write.mode("overwrite").partitionBy("wave").parquet(todo_path)
    schema = f"`{key}` {dict(prompts.dtypes)[key]}, `{col}` string, wave int"
    todo = spark.read.schema(schema).parquet(todo_path)
    for w in sorted(r[0] for r in todo.select("wave").distinct().collect()):  # at most `waves` numbers
        asked = todo.filter(F.col("wave") == w).coalesce(at_once)
        apply_generator(asked, fn, col, [key], batch).write.parquet(f"{path.rstrip('/')}/attempt={(last or 0) + 1}/wave={w}")
    held = _held_answers(prompts, key, path)
    if held is None:
        return prompts.select(key, *[F.lit(None).cast(t).alias(c) for c, t in (("body", "string"), ("error", "string"), ("attempt", "int"))]).limit(0)
    best = F.min_by(F.struct("body", "error", "attempt"), F.struct(F.col("error").isNotNull(), -F.col("attempt")))
    return held.groupBy(key).agg(best.alias("_a")).select(key, "_a.*")


def echo_generator(texts: list[str]) -> list[str]:
    """A deterministic stand-in generator: one item describing the prompt."""
    import hashlib
    import json

    out = []
    for t in texts:
        doc = '{"task_type": "echo", "agents_config": [], "rl_parameters": {"chars": %d}}' % len(t)
        item = {"instruction": "echo", "input": "prompt " + hashlib.md5(t.encode()).hexdigest()[:8], "output": doc}
        content = json.dumps([item], ensure_ascii=False)
        out.append(json.dumps({"choices": [{"message": {"role": "assistant", "content": content}}]}, ensure_ascii=False))
    return out


# ------------------------------------------------------------------ P5, P6

# The procedural generator's instruction, task types, input
# texts, output documents (json.dumps layout) and parameter ranges/choices.
PROC_INSTRUCTION = (
    "你是一个具身智能无人机集群的战术指挥中枢，请将用户的自然语言战术意图"
    "转换为结构化 JSON 调度指令。只输出 JSON，不要额外解释。"
)
TASKS = [
    {
        "task_type": "simple_tag",
        "input": "演练开始，敌方释放{prey}架诱饵机，我方出动{predators}架拦截机进行追击。要求左右包抄，先压缩逃逸空间再捕获；尽量避免友机碰撞。",
        "output": '{{"task_type": "simple_tag", "agents_config": [{{"role": "predator", "count": {predators}, "strategy": "pincer_and_compress"}}, {{"role": "prey", "count": {prey}, "strategy": "evasion"}}], "rl_parameters": {{"capture_reward": {capture_reward}, "collision_penalty": {collision_penalty}}}}}',
        "params": [
            ("predators", "int", (2, 6)),
            ("prey", "int", (1, 3)),
            ("capture_reward", "choice", ("40.0", "60.0", "80.0", "100.0")),
            ("collision_penalty", "choice", ("-10.0", "-20.0", "-50.0", "-100.0")),
        ],
    },
    {
        "task_type": "regional_capture",
        "input": "启动区域控制任务，派遣无人机在 Alpha 区进行网格化巡逻搜索；任意一架发现目标后其余立刻收缩合围。",
        "output": '{{"task_type": "regional_capture", "agents_config": [{{"role": "patrol", "count": {n}, "strategy": "grid_search_and_surround"}}], "rl_parameters": {{"coverage_reward": 20.0, "cooperative_capture_reward": 80.0, "collision_penalty": -10.0}}}}',
        "params": [("n", "int", (3, 8))],
    },
    {
        "task_type": "escort_and_navigate",
        "input": "我方运输机穿越峡谷，派护航无人机组成三角队形伴飞。途中允许开启强化避障算法，优先保证安全，其次保持队形。",
        "output": '{{"task_type": "escort_and_navigate", "agents_config": [{{"role": "vip", "count": 1, "strategy": "follow_waypoints"}}, {{"role": "escort", "count": {escorts}, "strategy": "triangle_formation"}}], "rl_parameters": {{"formation_keeping_reward": 15.0, "obstacle_avoidance_penalty": -30.0}}}}',
        "params": [("escorts", "int", (2, 5))],
    },
    {
        "task_type": "urban_search",
        "input": "目标进入城市密集建筑区，所有无人机切换低空静默模式，单机独立搜索。发现目标后上报并保持跟踪，不要依赖队友通信。",
        "output": '{{"task_type": "urban_search", "agents_config": [{{"role": "searcher", "count": {n}, "strategy": "independent_stealth"}}], "rl_parameters": {{"discovery_reward": 50.0, "comm_dependency_penalty": -5.0, "altitude_limit": "low"}}}}',
        "params": [("n", "int", (3, 10))],
    },
    {
        "task_type": "survival_evasion",
        "input": "集群遭遇强电磁干扰，立刻解散当前队形，所有无人机执行随机规避动作。优先保证生存，碰撞惩罚设为最高。",
        "output": '{{"task_type": "survival_evasion", "agents_config": [{{"role": "all", "count": "all", "strategy": "random_evasion_no_comm"}}], "rl_parameters": {{"survival_reward_per_step": 1.0, "collision_penalty": -100.0}}}}',
        "params": [],
    },
    {
        "task_type": "tactical_breach",
        "input": "对敌方基地进行模拟突防：多架无人机作为诱饵吸引火力，主攻机趁机隐蔽渗透突防。成功突防奖励最高，诱饵损失惩罚较低。",
        "output": '{{"task_type": "tactical_breach", "agents_config": [{{"role": "decoy", "count": {decoys}, "strategy": "draw_fire"}}, {{"role": "attacker", "count": 1, "strategy": "stealth_penetration"}}], "rl_parameters": {{"breach_success_reward": 200.0, "decoy_sacrifice_penalty": -10.0}}}}',
        "params": [("decoys", "int", (2, 4))],
    },
]


def _param_value(seed: int, key: Column, slot: int, kind: str, spec) -> Column:
    d = draw(seed, key, slot)
    if kind == "int":
        lo, hi = spec
        return (F.lit(lo) + d % (hi - lo + 1)).cast("string")
    return F.element_at(F.array(*[F.lit(v) for v in spec]), (d % len(spec) + 1).cast("int"))


def generate_from_templates(ids: DataFrame, seed: int = SEED, id_col: str = "id", tasks: list[dict] = TASKS) -> DataFrame:
    """One record per id: task type by draw slot 0, parameters by slots 1...

    Row-local: no join, no shuffle. The output document is rendered as text
    in ``json.dumps`` layout (``, `` / ``: ``, floats as ``40.0``).
    """
    key = F.col(id_col)
    t = draw(seed, key, 0) % len(tasks)
    task_type = F.lit(None).cast("string")
    inp = F.lit(None).cast("string")
    out = F.lit(None).cast("string")
    for i in reversed(range(len(tasks))):
        spec = tasks[i]
        vals = {name: _param_value(seed, key, s + 1, kind, rng) for s, (name, kind, rng) in enumerate(spec["params"])}
        task_type = F.when(t == i, F.lit(spec["task_type"])).otherwise(task_type)
        inp = F.when(t == i, fill(spec["input"], vals)).otherwise(inp)
        out = F.when(t == i, fill(spec["output"], vals)).otherwise(out)
    return ids.select(
        F.col(id_col).alias("id"),
        task_type.alias("task_type"),
        F.lit(PROC_INSTRUCTION).alias("instruction"),
        inp.alias("input"),
        out.alias("output"),
    )


def generate_count(spark, count: int, seed: int = SEED) -> DataFrame:
    """``count`` records with ids 0..count-1 (the command-line form of P5)."""
    return generate_from_templates(spark.range(count), seed)
