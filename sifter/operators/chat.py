"""Conversation transcripts as tables (H1-H5).

``transcript(conv_id, turn, role, text)``: one line per turn. Running state
of the chat loop (ended by an exit command, episodes cut by ``/reset``, the
current system message) is a running aggregate per conversation, computed
with :func:`sifter.operators.seq.running` so a long conversation is spread
over many tasks. Only the materialised history (H3) and the reassembled
reply (H4) hold a whole group in one row, because the row *is* that group.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jsonx import ustrip
from .rank import global_rank
from .seq import running, seq_bucket

# Chat commands.
EXIT_COMMANDS = ("/exit", "exit", "quit")
RESET_COMMAND = "/reset"


def _classify_lines(df: DataFrame) -> DataFrame:
    line = ustrip(F.col("text"))
    is_user = F.col("role") == "user"
    kind = (
        F.when(line.isNull() | (line == ""), "blank")
        .when(is_user & line.isin(*EXIT_COMMANDS), "exit")
        .when(is_user & (line == RESET_COMMAND), "reset")
        .when(F.col("role") == "system", "system")
        .otherwise("message")
    )
    return df.withColumn("line", line).withColumn("kind", kind)


def chat_state(df: DataFrame) -> DataFrame:
    """Lines with ``line``, ``kind``, ``active``, ``episode`` and ``system_text``
    (H1 + H2) from one running-aggregate pass per conversation."""
    staged = _classify_lines(df)
    r = running(
        staged,
        ["conv_id"],
        ["turn"],
        seq_bucket("turn"),
        sums={"episode": (F.col("kind") == "reset").cast("bigint")},
        maxes={
            "_exited": (F.col("kind") == "exit").cast("int"),
            "_sys": F.when(F.col("kind") == "system", F.struct(F.col("turn"), F.col("line").alias("text"))),
        },
    )
    return (
        r.withColumn("active", F.col("_exited") == 0)
        .withColumn("system_text", F.col("_sys.text"))
        .drop("_exited", "_sys")
    )


def chat_lines(df: DataFrame) -> DataFrame:
    """Add ``line`` (stripped text), ``kind`` and ``active`` (H1).

    kind: ``blank`` (ignored), ``exit`` (ends the conversation), ``reset``
    (a marker, not a turn), ``system`` or ``message``. ``active`` is false
    from the first exit line on.
    """
    return chat_state(df).drop("episode", "system_text")


def episodes(lines: DataFrame) -> DataFrame:
    """Add ``episode`` (number of ``/reset`` lines so far in the conversation)
    and ``system_text`` (latest system line so far) (H2)."""
    return chat_state(lines.select("conv_id", "turn", "role", "text"))


def histories(df: DataFrame, system: str | None = None, last_k: int | None = None) -> DataFrame:
    """Message lists at each active message line (H3, materialised form).

    The history is the optional system message (the transcript's latest
    system line, else ``system``), then every message of the current episode
    up to and including this line. It grows with the episode (quadratic
    output per episode, as the chat itself resends it); ``last_k`` keeps only
    the last k messages. For whole tables prefer :func:`message_table`,
    which is linear in size.
    """
    ep = chat_state(df)
    msgs = ep.filter(F.col("active") & (F.col("kind") == "message"))
    frame = Window.partitionBy("conv_id", "episode").orderBy("turn")
    frame = frame.rowsBetween(-(last_k - 1) if last_k else Window.unboundedPreceding, Window.currentRow)
    so_far = F.collect_list(F.struct(F.col("role"), F.col("line").alias("content"))).over(frame)
    sys_text = F.coalesce(F.col("system_text"), F.lit(system) if system and system.strip() else F.lit(None).cast("string"))
    sys_msg = F.when(sys_text.isNotNull() & (ustrip(sys_text) != ""), F.array(F.struct(F.lit("system").alias("role"), sys_text.alias("content"))))
    hist = F.concat(F.coalesce(sys_msg, F.array().cast("array<struct<role:string,content:string>>")), so_far)
    return msgs.select("conv_id", "turn", "episode", "role", "line", hist.alias("history"))


def message_table(df: DataFrame) -> DataFrame:
    """Histories in linear size (H3): one row per active message line.

    (conv_id, turn, episode, idx, role, content, system_text, n_messages): the
    history sent at a line is the system message, if there is one, and the
    messages of its episode with ``idx`` up to its own; ``n_messages`` is that
    history's length. ``idx`` is a running count per episode, so a long
    episode spreads over many tasks. :func:`histories` makes the lists.
    """
    ep = chat_state(df)
    msgs = ep.filter(F.col("active") & (F.col("kind") == "message"))
    r = running(msgs, ["conv_id", "episode"], ["turn"], seq_bucket("turn"), sums={"idx": F.lit(1).cast("bigint")})
    has_sys = F.col("system_text").isNotNull() & (ustrip(F.col("system_text")) != "")
    return r.select(
        "conv_id",
        "turn",
        "episode",
        "idx",
        "role",
        F.col("line").alias("content"),
        F.when(has_sys, F.col("system_text")).alias("system_text"),
        (F.col("idx") + F.when(has_sys, 1).otherwise(0)).cast("int").alias("n_messages"),
    )


def join_chunks(chunks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Concatenate streamed chunks in ``seq`` order and strip: one reply per key (H4)."""
    parts = F.array_sort(F.collect_list(F.struct(F.col("seq"), F.col("chunk"))))
    return chunks.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_chunks"),
        ustrip(F.array_join(F.transform(parts, lambda p: p["chunk"]), "")).alias("text"),
    )


def transcript_to_records(df: DataFrame) -> DataFrame:
    """(system, user, next assistant) triples as instruction records (H5).

    The next turn is the next one that exists in the conversation (a gap in
    the numbers does not matter), taken as the previous value in reverse
    order; the latest system line is a running maximum. Both run in bounded
    buckets, so a long conversation does not land in one task. ``pos`` is the
    record's place in the list, ordered by (conv_id, turn), from 0.
    """
    base = df.select("conv_id", "turn", "role", "text")
    sys = running(
        base,
        ["conv_id"],
        ["turn"],
        seq_bucket("turn"),
        maxes={"_sys": F.when(F.col("role") == "system", F.struct(F.col("turn"), F.col("text")))},
    )
    back = sys.withColumn("_back", -F.col("turn"))
    nxt = running(back, ["conv_id"], ["_back"], seq_bucket("_back"), lags={"_next": F.struct("role", "text")})
    pairs = nxt.filter((F.col("role") == "user") & (F.col("_next.role") == "assistant"))
    rec = pairs.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("_sys.text"), F.lit("")).alias("instruction"),
        F.col("text").alias("input"),
        F.col("_next.text").alias("output"),
    )
    placed = global_rank(rec, ["conv_id", "turn"], [F.col("conv_id"), seq_bucket("turn")], name="_r")
    return placed.select((F.col("_r") - 1).alias("pos"), "instruction", "input", "output")
