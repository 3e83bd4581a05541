"""Deterministic record views over the benchmark tables.

The driver's tables hold no instruction records, so each operator family gets
a view derived row by row from a real table; its size grows with the table.
``sifter/plans/oracle.py`` states the same rules in DuckDB SQL.

Only the columns a view needs are read, so the Parquet scan prunes the rest.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def _s(x) -> Column:
    return F.lit(x) if isinstance(x, str) else x


def cat(*parts) -> Column:
    return F.concat(*[_s(p) for p in parts])


def esc(c: Column) -> Column:
    """Escape text for use inside a JSON string literal (no backslashes in inputs)."""
    return F.replace(c, F.lit('"'), F.lit('\\"'))


def qs(c) -> Column:
    """JSON string literal of a text column."""
    return cat('"', esc(_s(c)), '"')


# ---------------------------------------------------------------- raw_records
# One record per event, shaped by event_id % 20 into every contract case.

SPREAD_ROWS = 100_000  # events of one task where a view is spread
INSTRUCTION = "Convert the tactical intent into a JSON scheduling document."


def _doc(e: DataFrame, task_type: Column | str = None, agents: Column | str = None, params: Column | str = None) -> Column:
    tt = qs(F.col("event_type")) if task_type is None else _s(task_type)
    ag = (
        cat(
            '[{"role": "predator", "count": ',
            (F.col("user_id") % 7 + 1).cast("string"),
            ', "strategy": "包抄_',
            F.col("event_type"),
            '"}]',
        )
        if agents is None
        else _s(agents)
    )
    pr = F.col("props") if params is None else _s(params)
    return cat('{"task_type": ', tt, ', "agents_config": ', ag, ', "rl_parameters": ', pr, "}")


def raw_records_text(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """(pos, item_text): one JSON record text per event. ``spread`` deals the
    events evenly to tasks of at most ``SPREAD_ROWS``, for costly steps that
    would else get as many tasks as the file has row groups."""
    e = table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "props"])
    if spread:
        e = e.repartition(max(spark.sparkContext.defaultParallelism, -(-e.count() // SPREAD_ROWS)))
    # shared pieces first, so the CASE below refers to them instead of
    # repeating the builders in every branch (keeps generated code small)
    e = e.select(
        "event_id",
        "user_id",
        "event_type",
        "props",
        _doc(e).alias("d"),
        qs(cat("Intent ", F.col("event_type"), " from user ", F.col("user_id").cast("string"))).alias("inp"),
    ).withColumn("qd", qs(F.col("d")))
    m = F.col("event_id") % 20
    ins = qs(F.lit(INSTRUCTION))
    inp = F.col("inp")
    d = F.col("d")
    qd = F.col("qd")

    def rec(output: Column, instruction: Column = ins, input_: Column = inp, extra: Column | None = None) -> Column:
        parts = ['{"instruction": ', instruction, ', "input": ', input_, ', "output": ', output]
        if extra is not None:
            parts += [", ", extra]
        return cat(*parts, "}")

    item = (
        F.when(m == 0, qs(F.col("event_type")))
        .when(m == 1, cat("[", F.col("props"), "]"))
        .when(m == 2, cat('{"instruction": ', ins, ', "output": ', qd, "}"))
        .when(m == 3, rec(F.lit('" \u3000\\t "')))
        .when(m == 4, rec(F.lit("null")))
        .when(m == 5, rec(F.col("props")))
        .when(m == 6, rec(qs(cat('{"task_type": "', F.col("event_type"), '"'))))
        .when(m == 7, rec(qs(cat(d, " trailing"))))
        .when(m == 8, rec(qs(F.col("props"))))
        .when(m == 9, rec(qs(_doc(e, task_type=F.col("user_id").cast("string")))))
        .when(m == 10, rec(qs(_doc(e, agents=F.col("props")))))
        .when(m == 11, rec(qs(_doc(e, params=F.lit("null")))))
        .when(m == 12, rec(qd, instruction=F.lit("null"), input_=F.lit("null")))
        .when(m == 13, rec(qd, extra=cat('"meta": ', F.col("props"))))
        .when(m == 14, rec(qs(cat(F.substring(d, F.lit(1), F.length(d) - 1), ', "note": "额外"}'))))
        .when(m == 15, rec(qs(cat("[", d, "]"))))
        .otherwise(rec(qd))
    )
    return e.select(F.col("event_id").alias("pos"), item.alias("item_text"))


def raw_records(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """(pos, item VARIANT) — the raw_records view."""
    return raw_records_text(spark, sf_dir, spread).select("pos", F.parse_json("item_text").alias("item"))


# ------------------------------------------------------------------ responses
# One chat-completion envelope per event, content shaped by event_id % 10.


def jstr(c) -> Column:
    """JSON string literal of any text (backslash, quote and newline escaped)."""
    c = _s(c)
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit('"'), F.lit('\\"'))
    c = F.replace(c, F.lit("\n"), F.lit("\\n"))
    return cat('"', c, '"')


def written_output() -> Column:
    """An output object with unsorted keys, floats and a number beyond doubles, as a model would write it."""
    return cat(
        '{"score": ', F.col("user_id").cast("string"), '.0, "props": ', F.col("props"), ', "ids": [1, 2.5, 12345678901234567890', F.col("event_id").cast("string"), "]}"
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, request_id, body): run = user, request = event."""
    e = table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "props"])
    e = e.select("event_id", "user_id", "event_type", "props", jstr(_doc(e)).alias("od"))

    def good(n: int) -> Column:
        return cat(
            '{"instruction": ', jstr(F.lit(INSTRUCTION)),
            ', "input": ', jstr(cat("Intent ", F.col("event_type"), f" #{n} from user ", F.col("user_id").cast("string"))),
            ', "output": ', F.col("od"), "}",
        )

    arr = cat("[", good(1), ", ", good(2), "]")
    m = F.col("event_id") % 10
    content = (
        F.when(m == 0, arr)
        .when(m == 1, cat("```json\n", arr, "\n```"))
        .when(m == 2, cat("Here are the items:\n", arr, "\nDone."))
        .when(m == 3, good(1))
        .when(m == 4, cat("[", good(1), ', 3, {"instruction": "x"}]'))
        .when(m == 5, cat('[{"instruction": ', jstr(F.lit(INSTRUCTION)), ', "input": "coerce ', F.col("event_id").cast("string"), '", "output": ', written_output(), "}]"))
        .when(m == 6, F.lit('[{"instruction": "x", '))
        .when(F.col("user_id") % 2 == 0, F.lit("42"))
        .otherwise(cat('Here: {"a":[', F.col("user_id").cast("string"), "]}"))
    )
    body = (
        F.when(m == 8, F.lit('{"error": {"message": "quota exceeded"}}'))
        .when(m == 9, F.lit('{"choices": [{"message": {"role": "assistant", "content": "  "}}]}'))
        .otherwise(cat('{"choices": [{"message": {"role": "assistant", "content": ', jstr(content), "}}]}"))
    )
    return e.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("request_id"), body.alias("body"))


# ---------------------------------------------------------------- request_log
# One request attempt per event; run = user, order = (ts, event_id).

# Error texts chosen by event_id % 12 (NULL = success).
ERROR_TEXTS = (
    None,
    None,
    'HTTP 429: {"error": {"status": "RESOURCE_EXHAUSTED", "details": [{"retryDelay": "1.5s"}]}}',
    'HTTP 503: {"error": "model_cooldown", "quotaResetDelay": "1h2m3s"}',
    "JSON 解析失败: Expecting value: line 1 column 1 (char 0); 片段: abc",
    "Network error: <urlopen error timed out>",
    'HTTP 404: {"error": "The model is no longer available, please switch to another"}',
    'HTTP 500: internal error "reset_seconds": 7',
    "HTTP 400: bad request",
    'HTTP 502: upstream "retryDelay": "x", "resetTime": "2s"',
    "Read timed out. (read timeout=300)",
    'Rate limit reached: "reset_time": "0s"',
)


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, seq, ts, attempt, batch_size, n_items, error)."""
    from ..operators.rank import global_rank
    from ..operators.requests import epoch_micros

    e = table(spark, sf_dir, "events", ["event_id", "ts", "user_id"])
    m = F.col("event_id") % len(ERROR_TEXTS)
    err = F.lit(None).cast("string")
    for i in reversed(range(len(ERROR_TEXTS))):
        if ERROR_TEXTS[i] is not None:
            err = F.when(m == i, F.lit(ERROR_TEXTS[i])).otherwise(err)
    b = (F.col("event_id") % 50 + 1).cast("int")
    log = e.select(
        F.col("user_id").alias("run_id"),
        "event_id",
        "ts",
        (F.col("event_id") % 5).cast("int").alias("attempt"),
        b.alias("batch_size"),
        F.when(err.isNull(), b).otherwise(F.lit(0)).cast("int").alias("n_items"),
        err.alias("error"),
    )
    # order inside a run by (ts, event_id); buckets of about 72 minutes
    ranked = global_rank(log, ["ts", "event_id"], F.shiftright(epoch_micros(F.col("ts")), 32), within=["run_id"], name="seq")
    return ranked.select("run_id", "seq", "ts", "attempt", "batch_size", "n_items", "error")


# ----------------------------------------------------------------- transcript
# Conversations as chat transcripts: every conv_id % 5 = 0 has its turn 2
# replaced by "/reset", every conv_id % 7 = 0 its turn 4 by "/exit"
# (commands are typed by the user).


def transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    reset = (F.col("conv_id") % 5 == 0) & (F.col("turn") == 2)
    exit_ = (F.col("conv_id") % 7 == 0) & (F.col("turn") == 4)
    return c.select(
        "conv_id",
        "turn",
        F.when(reset | exit_, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(reset, F.lit("/reset")).when(exit_, F.lit("/exit")).otherwise(F.col("text")).alias("text"),
    )


def sft_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, instruction, input, output) from conversations (H5)."""
    from ..operators.chat import transcript_to_records

    c = table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    return transcript_to_records(c)


# --------------------------------------------------------------------- chunks
# Documents streamed as 100-character chunks.

CHUNK_CHARS = 100


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", ["doc_id", "text"])
    n = F.greatest(F.ceil(F.length("text") / CHUNK_CHARS), F.lit(1)).cast("int")
    # the text is cut inside its row, so each exploded row carries its piece only
    cut = lambda i: F.substring(F.col("text"), i * CHUNK_CHARS + 1, F.lit(CHUNK_CHARS))
    pieces = d.select("doc_id", F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), cut)).alias("seq", "chunk"))
    return pieces.select("doc_id", F.col("seq").cast("bigint").alias("seq"), "chunk")


# -------------------------------------------------------------- seeds, prompts
# Seed records from benchmark items; one few-shot prompt per event.

SEED_INSTRUCTION = "Turn the benchmark passage into a scheduling document."


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark", ["item_id", "text"])
    doc = cat(
        '{"task_type": "bench_', F.col("item_id").cast("string"), '", "agents_config": [], "rl_parameters": {"item": ',
        F.col("item_id").cast("string"), "}}",
    )
    return b.select(
        F.col("item_id").alias("pos"), F.lit(SEED_INSTRUCTION).alias("instruction"), F.col("text").alias("input"), doc.alias("output")
    )


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", ["event_id"])
    return e.select(F.col("event_id").alias("prompt_id"), (F.col("event_id") % 50 + 1).cast("int").alias("n_items"))


def generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Procedural records, one per event (pos = event_id)."""
    from ..operators.prompts import generate_from_templates

    e = table(spark, sf_dir, "events", ["event_id"])
    g = generate_from_templates(e, id_col="event_id")
    return g.select(F.col("id").alias("pos"), "instruction", "input", "output")


def run_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: a generation target of 25 items per event."""
    e = table(spark, sf_dir, "events", ["user_id"])
    return e.groupBy(F.col("user_id").alias("run_id")).agg((F.count(F.lit(1)) * 25).alias("target"))


# ----------------------------------------------------------------- metric_log
# run = user, step = position by (ts, event_id); every 10th event logs eval_loss.


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.rank import global_rank
    from ..operators.requests import epoch_micros

    e = table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    v = F.col("value").cast("string")
    row = F.when(F.col("event_id") % 10 == 0, cat('{"eval_loss": ', v, "}")).otherwise(cat('{"loss": ', v, ', "learning_rate": 0.0002}'))
    log = e.select(F.col("user_id").alias("run_id"), "event_id", "ts", F.parse_json(row).alias("row"))
    ranked = global_rank(log, ["ts", "event_id"], F.shiftright(epoch_micros(F.col("ts")), 32), within=["run_id"], name="step")
    return ranked.select("run_id", "step", "row")
