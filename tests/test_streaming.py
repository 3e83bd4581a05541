"""Stream = batch: the streaming forms give the batch operators' results."""
import os

from pyspark.sql import functions as F

from sifter.operators import chat as H
from sifter.operators import clean as C
from sifter.sources import adapters as A
from sifter.streaming import streams as X

from .conftest import SF001


def test_stream_clean_equals_batch(spark, scratch):
    land = os.path.join(scratch, "land")
    A.raw_records_text(spark, SF001).repartition(4).write.parquet(land)
    stream = spark.readStream.schema("pos long, item_text string").option("maxFilesPerTrigger", 1).parquet(land)
    q = X.stream_clean(stream.select("pos", F.col("item_text").alias("item")), f"{scratch}/out", f"{scratch}/ck")
    q.awaitTermination()
    got = spark.read.parquet(f"{scratch}/out/clean")
    assert got.select("batch_id").distinct().count() >= 2
    batch = C.project_record(C.clean(C.classify(A.raw_records(spark, SF001))).select("pos", "item"))
    cols = ["pos", "instruction", "input", "output"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))
    reports = spark.read.parquet(f"{scratch}/out/reports")
    assert reports.agg(F.sum("total")).first()[0] == A.raw_records(spark, SF001).count()
    quarantined = spark.read.parquet(f"{scratch}/out/quarantine").count()
    assert quarantined + got.count() == A.raw_records(spark, SF001).count()


def test_stream_report_equals_batch(spark, scratch):
    land = os.path.join(scratch, "land")
    A.raw_records_text(spark, SF001).repartition(3).write.parquet(land)
    stream = spark.readStream.schema("pos long, item_text string").option("maxFilesPerTrigger", 1).parquet(land)
    rep = X.run_to_table(spark, X.stream_report(stream.select("pos", F.col("item_text").alias("item"))), "t-report", mode="complete")
    batch = C.classify(A.raw_records(spark, SF001)).groupBy("label").count()
    assert sorted(map(tuple, rep.collect())) == sorted(map(tuple, batch.collect()))


def test_stream_histories_equal_batch_across_batches(spark, scratch):
    land = os.path.join(scratch, "land")
    t = A.transcript(spark, SF001)
    for lo in range(0, 10, 2):  # turn order across micro-batches
        t.filter((F.col("turn") >= lo) & (F.col("turn") < lo + 2)).coalesce(1).write.mode("append").parquet(land)
    stream = spark.readStream.schema("conv_id long, turn long, role string, text string").option("maxFilesPerTrigger", 1).parquet(land)
    got = X.run_to_table(spark, X.stream_histories(stream), "t-hist")
    assert got.select("batch_id").distinct().count() >= 3
    exp = H.histories(t)

    def norm(df):
        return sorted((r.conv_id, r.turn, r.episode, tuple((m.role, m.content) for m in r.history)) for r in df.collect())

    assert norm(got) == norm(exp)


def test_stream_messages_equal_batch(spark, scratch):
    land = os.path.join(scratch, "land")
    t = A.transcript(spark, SF001)
    for lo in range(0, 10, 2):
        t.filter((F.col("turn") >= lo) & (F.col("turn") < lo + 2)).coalesce(1).write.mode("append").parquet(land)
    stream = spark.readStream.schema("conv_id long, turn long, role string, text string").option("maxFilesPerTrigger", 1).parquet(land)
    got = X.run_to_table(spark, X.stream_messages(stream), "t-messages")
    exp = H.message_table(t)
    assert sorted(map(repr, got.select(*exp.columns).collect())) == sorted(map(repr, exp.collect()))


def test_stream_clean_restarts_from_checkpoint_without_duplicates(spark, scratch):
    land = os.path.join(scratch, "land")
    recs = A.raw_records_text(spark, SF001)
    recs.filter("pos < 500").repartition(2).write.parquet(land)
    schema = "pos long, item_text string"
    out, ck = f"{scratch}/out", f"{scratch}/ck"

    def run():
        stream = spark.readStream.schema(schema).parquet(land).select("pos", F.col("item_text").alias("item"))
        X.stream_clean(stream, out, ck).awaitTermination()

    run()
    first = spark.read.parquet(f"{out}/clean").count()
    recs.filter("pos >= 500").repartition(2).write.mode("append").parquet(land)
    run()  # restart: only the new files are read
    got = spark.read.parquet(f"{out}/clean").select("pos")
    batch = C.clean(C.classify(A.raw_records(spark, SF001))).select("pos")
    assert 0 < first < got.count()
    assert got.count() == got.distinct().count() == batch.count()
    assert sorted(r.pos for r in got.collect()) == sorted(r.pos for r in batch.collect())


def test_stage_uses_the_session_checkpoint_dir(spark):
    from sifter.plans.jobs import stage
    from sifter.session import checkpoint_dir

    df = stage(spark.range(3), "probe")
    files = df.inputFiles()
    assert files and all(checkpoint_dir(spark).rstrip("/").split(":")[-1] in f for f in files)


def test_stream_messages_on_rocksdb_state(spark, scratch):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        land = os.path.join(scratch, "land")
        t = A.transcript(spark, SF001)
        for lo in range(0, 10, 4):
            t.filter((F.col("turn") >= lo) & (F.col("turn") < lo + 4)).coalesce(1).write.mode("append").parquet(land)
        stream = spark.readStream.schema("conv_id long, turn long, role string, text string").option("maxFilesPerTrigger", 1).parquet(land)
        got = X.run_to_table(spark, X.stream_messages(stream), "t-rocks")
        exp = H.message_table(t)
        assert sorted(map(repr, got.select(*exp.columns).collect())) == sorted(map(repr, exp.collect()))
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def test_stream_state_is_loaded_after_a_restart(spark, scratch):
    """Three runs over one checkpoint, one turn range each: every later run starts from stored state."""
    land, t = os.path.join(scratch, "land"), A.transcript(spark, SF001)
    schema = "conv_id long, turn long, role string, text string"
    for build, batch, name in ((X.stream_messages, H.message_table, "messages"), (X.stream_histories, H.histories, "histories")):
        base = f"{scratch}/{name}"
        for lo in (0, 3, 6):
            t.filter((F.col("turn") >= lo) & (F.col("turn") < (lo + 3 if lo < 6 else 10**9))).repartition(3, "conv_id").write.mode("append").parquet(f"{land}/{name}")
            got = X.run_to_table(spark, build(spark.readStream.schema(schema).parquet(f"{land}/{name}")), name, base=base)
        assert got.select("batch_id").distinct().count() >= 3
        exp = batch(t)
        rows = lambda df: sorted(repr(r.asDict(recursive=True)) for r in df.select(*exp.columns).collect())
        assert rows(got) == rows(exp)


def test_stream_state_handles_commands_over_batches(spark, scratch):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "user", "/reset"), (1, 3, "user", "b"), (1, 4, "user", "/exit"), (1, 5, "user", "c"), (2, 0, "user", " "), (2, 5, "user", "d"), (2, 6, "assistant", None)]
    schema, base = "conv_id long, turn long, role string, text string", f"{scratch}/run"
    for turn in range(7):
        spark.createDataFrame([r for r in turns if r[1] == turn] or [(9, turn, "user", None)], schema).coalesce(1).write.mode("append").parquet(f"{scratch}/land")
        got = X.run_to_table(spark, X.stream_histories(spark.readStream.schema(schema).parquet(f"{scratch}/land")), "cmd", base=base)
    rows = sorted((r.conv_id, r.turn, r.episode, tuple(m.content for m in r.history)) for r in got.collect())
    assert rows == [(1, 1, 0, ("s", "a")), (1, 3, 1, ("s", "b")), (2, 5, 0, ("d",))]


class _Handle:
    """State variables and timers of one key, in memory."""

    class Var:
        def __init__(self):
            self.held = []

        def exists(self):
            return bool(self.held)

        def get(self):
            return self.held[-1] if self.single else iter(list(self.held))

        def update(self, v):
            self.held = [v]

        def appendList(self, v):
            self.held += v

        def clear(self):
            self.held = []

    def __init__(self):
        self.timers, self.vars = [], {}

    def _var(self, name, single):
        v = self.vars[name] = self.Var()
        v.single = single
        return v

    def getValueState(self, name, schema):
        return self._var(name, True)

    def getListState(self, name, schema):
        return self._var(name, False)

    def listTimers(self):
        return iter(list(self.timers))

    def deleteTimer(self, at):
        self.timers.remove(at)

    def registerTimer(self, at):
        self.timers.append(at)


class _Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentProcessingTimeInMs(self):
        return self.ms


def test_idle_conversations_are_forgotten():
    import pandas as pd

    for lists in (False, True):
        chat, handle = X._Chat(lists, 1000), _Handle()
        chat.init(handle)
        lines = lambda turn, text: iter([pd.DataFrame({"turn": [turn], "role": ["user"], "text": [text]})])
        first = [r for pdf in chat.handleInputRows((1,), lines(0, "a"), _Now(0)) for r in pdf.values.tolist()]
        again = [r for pdf in chat.handleInputRows((1,), lines(1, "b"), _Now(500)) for r in pdf.values.tolist()]
        assert handle.timers == [1500] and len(first) == len(again) == 1  # moved on by the lines
        assert list(chat.handleExpiredTimer((1,), _Now(1500), None)) == []
        assert not any(v.exists() for v in handle.vars.values())
        new = [r for pdf in chat.handleInputRows((1,), lines(2, "c"), _Now(2000)) for r in pdf.values.tolist()]
        assert new[0][5] == ([{"role": "user", "content": "c"}] if lists else "c")
        assert lists or new[0][3] == 1
