"""Structured Streaming forms of the cleaner and the chat state.

The row-local operators run unchanged on a streaming DataFrame. Sinks are
written per micro-batch with ``foreachBatch`` into folders partitioned by
``batch_id`` with dynamic partition overwrite, so a micro-batch replayed after
a failure replaces its own output instead of appending a copy. Checkpoints
live under the cluster's shared checkpoint folder (``spark.checkpoint.dir``).
"""
from __future__ import annotations

import uuid
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions.jsonx import strict_json
from ..operators import clean as C
from ..operators.chat import EXIT_COMMANDS, RESET_COMMAND
from ..session import checkpoint_dir


def stream_location(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming query under the shared checkpoint dir."""
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def stream_clean(stream: DataFrame, out: str, ckpt: str, trigger: dict | None = None, minify_output: bool = False):
    """Continuous clean (X1): valid rows -> ``out/clean``, rejected rows with
    their label -> ``out/quarantine``, one report row per micro-batch ->
    ``out/reports``. ``stream`` has ``pos`` and ``item`` (VARIANT or JSON text).
    Returns the started query."""
    if dict(stream.dtypes).get("item") == "string":
        stream = stream.withColumn("item", strict_json(F.col("item")))

    def per_batch(df: DataFrame, batch_id: int) -> None:
        # three sinks read the same labels: classify the micro-batch once
        classified = C.classify(df.select("pos", "item")).drop("doc").persist()
        try:
            kept = C.project_record(C.clean(classified).drop("label"))
            if minify_output:
                kept = C.minify(kept, "output")
            _write_batch(kept, f"{out}/clean", batch_id)
            _write_batch(C.quarantine(classified).select("pos", F.to_json("item").alias("item"), "label"), f"{out}/quarantine", batch_id)
            _write_batch(C.validation_report(classified), f"{out}/reports", batch_id)
        finally:
            classified.unpersist()

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def stream_report(stream: DataFrame):
    """Running label counts over a record stream (X2): a streaming aggregate
    (state holds one count per label), to be written in ``complete`` mode."""
    if dict(stream.dtypes).get("item") == "string":
        stream = stream.withColumn("item", strict_json(F.col("item")))
    return C.classify(stream.select("pos", "item")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


HISTORY_SCHEMA = "conv_id long, turn long, episode long, role string, line string, history array<struct<role:string,content:string>>"
MESSAGE_SCHEMA = "conv_id long, turn long, episode long, idx long, role string, content string, system_text string, n_messages int"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Typed state lives in RocksDB: names that state store while queries are
    started, where the cluster has not chosen one itself."""
    key = "spark.sql.streaming.stateStore.providerClass"
    chosen = spark.conf.get(key, None)
    set_here = not chosen or chosen.endswith("HDFSBackedStateStoreProvider")
    if set_here:
        spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        if set_here:
            spark.conf.unset(key) if chosen is None else spark.conf.set(key, chosen)


class _Chat(StatefulProcessor):
    """State variables of a conversation, and the rules for its lines.

    ``chat`` (a value: episode, exited, system text, messages so far) is read
    and written once per micro-batch. With ``lists`` the current episode's
    messages are a list state, to which new ones are appended; what is stored is
    not written again. With ``idle_ms`` a timer, moved on by every micro-batch
    that brings lines, forgets the conversation.
    """

    CHAT = "episode long, exited boolean, system string, n long"
    LINE = "role string, content string"

    def __init__(self, lists: bool, idle_ms: int | None):
        self.lists, self.idle_ms = lists, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.chat = handle.getValueState("chat", self.CHAT)
        self.messages = handle.getListState("messages", self.LINE) if self.lists else None

    def handleInputRows(self, key, rows, timerValues):
        episode, exited, system, n = self.chat.get() if self.chat.exists() else (0, False, None, 0)
        stored = self.lists and n > 0  # the list state holds messages of this episode
        held = [{"role": r, "content": c} for r, c in self.messages.get()] if stored else []
        new, out = [], []
        for turn, role, line in _lines(rows):
            if exited or not line:
                continue
            leaves = role == "user" and line in EXIT_COMMANDS
            if leaves or (role == "user" and line == RESET_COMMAND):
                exited, episode = leaves, episode + (not leaves)
                held, new, n = [], [], 0
                if stored:
                    self.messages.clear()
                    stored = False
            elif role == "system":
                system = line
            else:
                n += 1
                if self.lists:
                    new.append((role, line))
                    held = [*held, {"role": role, "content": line}]
                    head = [{"role": "system", "content": system}] if system else []
                    out.append((key[0], turn, episode, role, line, head + held))
                else:
                    out.append((key[0], turn, episode, n, role, line, system, n + (1 if system else 0)))
        if new:
            self.messages.appendList(new)
        self.chat.update((episode, exited, system, n))
        if self.idle_ms is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        if out:
            yield pd.DataFrame(out, columns=_names(HISTORY_SCHEMA if self.lists else MESSAGE_SCHEMA))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.chat.clear()
        if self.lists:
            self.messages.clear()
        yield from ()

    def close(self) -> None:
        pass


def _lines(batches):
    """A conversation's lines of this micro-batch, in turn order."""
    rows = [r for pdf in batches for r in zip(pdf["turn"], pdf["role"], pdf["text"])]
    for turn, role, text in sorted(rows, key=lambda r: r[0]):
        yield int(turn), role, (text or "").strip()


def _names(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.replace("<role:string,content:string>", "").split(", ")]


def _with_state(stream: DataFrame, lists: bool, schema: str, state_days: float | None) -> DataFrame:
    # Spark plans micro-batches for ever while processing-time timers are on, so an available-now run, which has to end, goes without
    idle, mode = (None, "None") if state_days is None else (int(state_days * 86_400_000), "ProcessingTime")
    return stream.groupBy("conv_id").transformWithStateInPandas(_Chat(lists, idle), schema, "Append", mode)


def stream_histories(stream: DataFrame, state_days: float | None = None) -> DataFrame:
    """Stateful chat histories (X3), keyed by ``conv_id``, as message lists.

    Lines are applied in turn order inside a micro-batch, and batches must
    bring a conversation's lines in order. State per conversation is the
    current episode's messages as a list state (``/reset`` and an exit clear
    it), so prefer :func:`stream_messages` where a row per message is enough.
    With ``state_days`` a timer forgets a conversation without lines for so
    long (for continuous triggers; an available-now run would not end). Start
    the query under :func:`rocksdb_state`, or set that state store on the
    cluster. Whitespace handling uses Python ``str.strip``, the same set as
    ``sifter.functions.jsonx.ustrip``.
    """
    return _with_state(stream, True, HISTORY_SCHEMA, state_days)


def stream_messages(stream: DataFrame, state_days: float | None = None) -> DataFrame:
    """Streaming form of :func:`sifter.operators.chat.message_table` (X3): one
    row per message, and four values of state per conversation, whatever its
    length. ``state_days`` and state store as in :func:`stream_histories`."""
    return _with_state(stream, False, MESSAGE_SCHEMA, state_days)


def run_to_table(spark: SparkSession, streaming: DataFrame, name: str, mode: str = "append", base: str | None = None) -> DataFrame:
    """Run a streaming DataFrame to completion (available-now trigger) into a
    Parquet table under the shared checkpoint folder and read it back. With the
    ``base`` folder of an earlier run it goes on from that run's checkpoint."""
    base = base or stream_location(spark, name)
    path, ckpt = f"{base}/table", f"{base}/checkpoint"

    if mode == "complete":
        def sink(df, batch_id):
            df.write.mode("overwrite").parquet(path)

        q = streaming.writeStream.outputMode("complete").foreachBatch(sink)
    else:
        def sink(df, batch_id):
            _write_batch(df, path, batch_id)

        q = streaming.writeStream.outputMode("append").foreachBatch(sink)
    with rocksdb_state(spark):
        q = q.option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    schema = streaming.schema if mode == "complete" else streaming.schema.add("batch_id", "long")  # a run without rows leaves no file to infer it from
    return spark.read.schema(schema).parquet(path)


__all__ = ["stream_clean", "stream_report", "stream_histories", "stream_messages", "rocksdb_state", "run_to_table", "stream_location"]
