"""Registered queries: one per operator family row of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole input
tables (through the views in ``sifter.sources.adapters``). Column names match
the DuckDB statements in ``sifter.plans.oracle``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import errors as E
from ..operators import chat as H
from ..operators import checkpoints as K
from ..operators import clean as C
from ..operators import metrics as M
from ..operators import prompts as P
from ..operators import requests as Q
from ..operators import responses as R
from ..operators import samples as S
from ..sources import adapters as A
from ..streaming import streams as X_
from . import jobs as J

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


# ------------------------------------------------------------------ cleaner


def _classified(spark, sf):
    return C.classify(A.raw_records(spark, sf))


@query("a1_validation_report")
def a1_validation_report(spark, sf):
    return C.validation_report(_classified(spark, sf))


@query("c7_classify")
def c7_classify(spark, sf):
    return _classified(spark, sf).select("pos", "label")


@query("c8_clean")
def c8_clean(spark, sf):
    return C.project_record(C.clean(_classified(spark, sf)).select("pos", "item"))


@query("c10_quarantine")
def c10_quarantine(spark, sf):
    return C.quarantine(_classified(spark, sf)).select("pos", "label")


@query("c9_minify")
def c9_minify(spark, sf):
    rec = C.project_record(C.clean(_classified(spark, sf)).select("pos", "item"))
    return C.minify(rec.select("pos", "output"))


@query("c11_clean_job")
def c11_clean_job(spark, sf):
    """The job from path to path: records landed as JSON Lines, cleaned files read back."""
    from ..sources.records import read_records_lines, write_records

    base = X_.stream_location(spark, "c11")
    write_records(A.raw_records_text(spark, sf).withColumnRenamed("item_text", "item"), f"{base}/in", "jsonl")
    J.clean_files(spark, f"{base}/in", f"{base}/out", minify_output=True)
    kept = C.project_record(read_records_lines(spark, f"{base}/out/clean"), keep_item=True)
    return kept.select("instruction", "input", "output", C.J.field(F.col("item"), "meta").isNotNull().alias("has_extra"))


# ---------------------------------------------------------------- responses


@query("g1_response_content")
def g1_response_content(spark, sf):
    return R.response_content(A.responses(spark, sf)).select("run_id", "request_id", "envelope_error", "content")


@query("g3_extract_json_text")
def g3_extract_json_text(spark, sf):
    c = R.response_content(A.responses(spark, sf)).select("request_id", "content")
    return R.json_text(c).select("request_id", "stripped", "extracted")


@query("g6_items")
def g6_items(spark, sf):
    items, _ = R.parse_responses(A.responses(spark, sf), exact=True)
    return items


@query("g7_response_stats")
def g7_response_stats(spark, sf):
    _, stats = R.parse_responses(A.responses(spark, sf))
    return stats


@query("a2_dropped_per_run")
def a2_dropped_per_run(spark, sf):
    _, stats = R.parse_responses(A.responses(spark, sf))
    return R.dropped_per_run(stats)


# -------------------------------------------------------------- request log


@query("r5_error_markers")
def r5_error_markers(spark, sf):
    log = A.request_log(spark, sf)
    e = F.col("error")
    return log.select(
        "run_id", "seq",
        E.is_retriable(e).alias("is_retriable"),
        E.is_quota(e).alias("is_quota"),
        E.is_json_parse(e).alias("is_json_parse"),
        E.is_timeout(e).alias("is_timeout"),
        E.is_model_unavailable(e).alias("is_model_unavailable"),
    )


@query("r6_durations")
def r6_durations(spark, sf):
    log = A.request_log(spark, sf).filter(F.col("error").isNotNull())
    txt = F.regexp_extract("error", '"(?:retryDelay|quotaResetDelay|reset_time|resetTime)"\\s*:\\s*"([^"]+)"', 1)
    return log.select("run_id", "seq", txt.alias("duration_text"), E.parse_duration_seconds(txt).alias("seconds"))


@query("r7_retry_delay")
def r7_retry_delay(spark, sf):
    return A.request_log(spark, sf).select("run_id", "seq", E.parse_retry_delay_seconds("error").alias("delay_s"))


@query("r8_actions")
def r8_actions(spark, sf):
    return Q.request_actions(A.request_log(spark, sf)).select("run_id", "seq", "action", "wait_s", "next_batch_size")


@query("r11_failure_streaks")
def r11_failure_streaks(spark, sf):
    return Q.failure_streaks(A.request_log(spark, sf)).select("run_id", "seq", "given_up", "streak", "stop_flag")


@query("r12_run_progress")
def r12_run_progress(spark, sf):
    return Q.run_progress(A.request_log(spark, sf)).select("run_id", "seq", "total", "accepted", "remaining")


@query("r13_checkpoint_marks")
def r13_checkpoint_marks(spark, sf):
    progress = Q.run_progress(Q.request_actions(A.request_log(spark, sf)))
    return Q.checkpoint_marks(progress).select("run_id", "seq", "action", "total")


@query("r14_rate_gaps")
def r14_rate_gaps(spark, sf):
    return Q.rate_gaps(A.request_log(spark, sf)).select("run_id", "seq", "gap_s", "wait_s")


# ------------------------------------------------------------ conversations


@query("h1_chat_lines")
def h1_chat_lines(spark, sf):
    return H.chat_lines(A.transcript(spark, sf)).select("conv_id", "turn", "kind", "active")


@query("h2_episodes")
def h2_episodes(spark, sf):
    return H.episodes(A.transcript(spark, sf)).select("conv_id", "turn", "episode", "system_text")


@query("h3_histories")
def h3_histories(spark, sf):
    return H.message_table(A.transcript(spark, sf))


@query("h4_join_chunks")
def h4_join_chunks(spark, sf):
    return H.join_chunks(A.chunks(spark, sf))


@query("h5_transcript_records")
def h5_transcript_records(spark, sf):
    return A.sft_records(spark, sf)


# ------------------------------------------------------------------ samples


def _md5_ints(c):
    return F.md5(F.array_join(F.col(c).cast("array<string>"), ","))


@query("t1_normalize")
def t1_normalize(spark, sf):
    return S.normalize(A.sft_records(spark, sf)).select("pos", "instruction", "input", "output", "drop_reason")


@query("t4_render_prompt")
def t4_render_prompt(spark, sf):
    m = S.build_messages(S.normalize(A.sft_records(spark, sf)))
    r = S.render_prompt(m.filter(F.col("drop_reason").isNull()))
    return r.select(
        "pos", F.md5("prompt").alias("prompt_md5"), F.length("prompt").alias("prompt_chars"), F.md5("answer").alias("answer_md5")
    )


def _samples(spark, sf):
    return S.build_samples(A.sft_records(spark, sf))


@query("t10_samples")
def t10_samples(spark, sf):
    n = S.normalize(A.sft_records(spark, sf))
    enc = S.encode(S.render_prompt(S.build_messages(n).filter(F.col("drop_reason").isNull())))
    enc = enc.filter(F.col("drop_reason").isNull())
    return enc.select(
        "pos",
        "n_prompt",
        "n_answer",
        F.size("input_ids").alias("n_tokens"),
        F.size(F.filter("labels", lambda x: x != S.IGNORE_INDEX)).alias("n_learn"),
        _md5_ints("input_ids").alias("ids_md5"),
        _md5_ints("labels").alias("labels_md5"),
    )


@query("t6_vocabulary_samples")
def t6_vocabulary_samples(spark, sf):
    """Samples of all raw records, with the ids of a byte-pair vocabulary."""
    import public_tokenizers

    encoder = S.vocabulary_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    samples, _ = S.build_samples(S.records_from_items(A.raw_records(spark, sf, spread=True)), encoder=encoder)
    return samples.select("pos", "n_tokens", "n_masked", _md5_ints("input_ids").alias("ids_md5"), _md5_ints("labels").alias("labels_md5"))


@query("a3_sample_drops")
def a3_sample_drops(spark, sf):
    _, drops = S.build_samples(S.records_from_items(A.raw_records(spark, sf)))
    return drops


def _staged_samples(spark, sf, *columns):
    """The samples' columns that a query needs, tokenised once."""
    samples, _ = _samples(spark, sf)
    return J.stage(samples.select("pos", "n_tokens", *columns), "samples")


@query("t11_split")
def t11_split(spark, sf):
    return S.split_exact(_staged_samples(spark, sf).select("pos")).select("pos", "split")


@query("a4_split_sizes")
def a4_split_sizes(spark, sf):
    return S.split_sizes(S.split_exact(_staged_samples(spark, sf).select("pos")))


@query("t13_padded_batches")
def t13_padded_batches(spark, sf):
    samples = _staged_samples(spark, sf, "n_masked", "input_ids")
    b = S.collate(samples, S.collate_plan(samples, 8))
    return b.select(
        "split", "batch_id", "pos", "width",
        _md5_ints("input_ids").alias("ids_md5"), _md5_ints("attention_mask").alias("mask_md5"), _md5_ints("labels").alias("labels_md5"),
    )


# --------------------------------------------------------------- generation


@query("p1_sample_seeds")
def p1_sample_seeds(spark, sf):
    s = P.sample_seeds(A.prompts(spark, sf), A.seeds(spark, sf))
    return s.select("prompt_id", F.col("rank").cast("int").alias("rank"), "pos")


def _prompts(spark, sf):
    return P.sampled_prompts(A.prompts(spark, sf), A.seeds(spark, sf))


@query("p2_build_prompts")
def p2_build_prompts(spark, sf):
    return _prompts(spark, sf).select(
        "prompt_id", "n_items", F.md5("prompt").alias("prompt_md5"), F.length("prompt").alias("prompt_chars")
    )


@query("p3_plan_requests")
def p3_plan_requests(spark, sf):
    return P.plan_requests(A.run_targets(spark, sf), batch=50)


@query("p4_generate_parse")
def p4_generate_parse(spark, sf):
    bodies = P.apply_generator(_prompts(spark, sf), P.echo_generator, keys=["prompt_id"])
    items, _ = R.parse_responses(bodies.select("prompt_id", "body"))
    return items


@query("p4_resume_answers")
def p4_resume_answers(spark, sf):
    """A run whose generator refuses every prompt with an odd number of characters, then one that answers the rest."""

    def busy(texts):
        if any(len(t) % 2 for t in texts):
            raise RuntimeError("HTTP 503 busy")
        return P.echo_generator(texts)

    path = X_.stream_location(spark, "p4")
    prompts = _prompts(spark, sf)
    P.answer_prompts(prompts, busy, path, waves=2)
    answers = P.answer_prompts(prompts, P.echo_generator, path, waves=2)
    items, _ = R.parse_responses(answers.select("prompt_id", "attempt", "body"))
    return items


@query("p5_procedural")
def p5_procedural(spark, sf):
    from ..operators.prompts import generate_from_templates

    e = A.table(spark, sf, "events", ["event_id"])
    return generate_from_templates(e, id_col="event_id")


# ------------------------------------------------------------- checkpoints


@query("s4_append_batch")
def s4_append_batch(spark, sf):
    """Seeds written, the generated batch appended to them, the table read back."""
    from ..sources.records import append_batch_to

    path = X_.stream_location(spark, "s4")
    A.seeds(spark, sf).select("pos", "input", "output").write.parquet(path)
    return append_batch_to(spark, path, A.generated(spark, sf).select("pos", "input", "output")).table


@query("s4_append_once")
def s4_append_once(spark, sf):
    """The seeds and the generated batch appended under names, the first one twice."""
    from ..sources.records import append_once

    path = X_.stream_location(spark, "s4")
    seeds = A.seeds(spark, sf).select("pos", "input", "output")
    append_once(spark, path, seeds, "seeds")
    append_once(spark, path, A.generated(spark, sf).select("pos", "input", "output"), "generated")
    return append_once(spark, path, seeds, "seeds").table.drop("batch_id")


@query("s5_checkpoint")
def s5_checkpoint(spark, sf):
    return K.checkpoint_rows(A.seeds(spark, sf), A.generated(spark, sf)).select("pos", "source", "input", "output")


@query("s6_resume")
def s6_resume(spark, sf):
    seeds = A.seeds(spark, sf)
    ckpt = K.checkpoint_rows(seeds, A.generated(spark, sf))
    return K.resume_generated(ckpt, seeds).select("pos", "input", "output")


@query("s7_finalize")
def s7_finalize(spark, sf):
    return K.finalize_dataset(A.seeds(spark, sf), A.generated(spark, sf), 2000).select("pos", "source", "input", "output")


# ------------------------------------------------------------------ metrics


@query("a5_metric_series")
def a5_metric_series(spark, sf):
    return M.metric_series(A.metric_log(spark, sf))


@query("f4_smooth")
def f4_smooth(spark, sf):
    s = M.smooth(M.metric_series(A.metric_log(spark, sf)))
    return s.select("run_id", "name", "step", F.round("smoothed", 9).alias("smoothed"))


@query("t3_instruction_as_system")
def t3_instruction_as_system(spark, sf):
    m = S.build_messages(S.normalize(A.sft_records(spark, sf)), instruction_as_system=True)
    r = S.render_prompt(m.filter(F.col("drop_reason").isNull()))
    return r.select("pos", F.md5("prompt").alias("prompt_md5"))


# ---------------------------------------------------------------- streaming


def _landed_records(spark, sf):
    land = X_.stream_location(spark, "landing-records")
    A.raw_records_text(spark, sf).write.parquet(land)
    return spark.readStream.schema("pos long, item_text string").option("maxFilesPerTrigger", 2).parquet(land).select(
        "pos", F.col("item_text").alias("item")
    )


@query("x1_stream_clean")
def x1_stream_clean(spark, sf):
    base = X_.stream_location(spark, "x1")
    q = X_.stream_clean(_landed_records(spark, sf), f"{base}/out", f"{base}/checkpoint")
    q.awaitTermination()
    one = F.lit(1).cast("bigint").alias("n")
    none = [F.lit(None).cast("string").alias(c) for c in C.RECORD_KEYS]
    kept = spark.read.parquet(f"{base}/out/clean").select(F.lit("clean").alias("output_of"), "pos", F.lit("valid").alias("label"), *C.RECORD_KEYS, one)
    rejected = spark.read.parquet(f"{base}/out/quarantine").select(F.lit("quarantine").alias("output_of"), "pos", "label", *none, one)
    labels = ("valid", *C.ERROR_LABELS)
    counts = F.inline(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("n")) for c in labels]))
    report = spark.read.parquet(f"{base}/out/reports").select(counts).groupBy("label").agg(F.sum("n").alias("n")).filter("n > 0")
    report = report.select(F.lit("report").alias("output_of"), F.lit(None).cast("bigint").alias("pos"), "label", *none, "n")
    return kept.unionByName(rejected).unionByName(report)


@query("x2_stream_report")
def x2_stream_report(spark, sf):
    return X_.run_to_table(spark, X_.stream_report(_landed_records(spark, sf)), "x2", mode="complete")


@query("x3_stream_histories")
def x3_stream_histories(spark, sf):
    """Turns land in three ranges; the stream is started after each with the
    same checkpoint, so later runs load the state that earlier ones stored."""
    base = X_.stream_location(spark, "x3")
    t = J.stage(A.transcript(spark, sf), "transcript")
    third = (t.agg(F.max("turn")).first()[0] or 0) // 3 + 1
    for part in range(3):
        t.filter(F.expr(f"turn div {third}") == part).repartition("conv_id").write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema("conv_id long, turn long, role string, text string").parquet(f"{base}/landing")
        out = X_.run_to_table(spark, X_.stream_messages(stream), "x3", base=base)
    return out.drop("batch_id")


# ------------------------------------------------------------ file sources


@query("s1_read_array_files")
def s1_read_array_files(spark, sf):
    """Land the records as JSON-array files (one bounded array per file, in
    position order), read them back with the array reader: places, labels, texts."""
    from ..sources.records import read_records

    land = X_.stream_location(spark, "landing-arrays")
    rec = A.raw_records_text(spark, sf).withColumn("chunk", F.floor(F.col("pos") / 1000).cast("bigint"))
    arrays = rec.groupBy("chunk").agg(
        F.concat(
            F.lit("["),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "item_text"))), lambda x: x["item_text"]), ",\n"),
            F.lit("]"),
        ).alias("value")
    )
    arrays.write.partitionBy("chunk").text(land)
    raw = read_records(spark, f"{land}/*/*.txt", with_text=True)
    chunk = F.regexp_extract("file", "chunk=([0-9]+)", 1).cast("bigint").alias("chunk")
    return C.classify(raw).select(chunk, "pos", "label", F.md5("text").alias("text_md5"))


@query("s1_read_large_array")
def s1_read_large_array(spark, sf):
    """Land the records as array files of up to 100,000 records each (a file is
    written row by row), read them back in splits: places, labels, texts."""
    from ..sources.arrays import read_large_arrays

    land = X_.stream_location(spark, "landing-large-arrays")
    rec = A.raw_records_text(spark, sf).withColumn("chunk", F.floor(F.col("pos") / 100_000).cast("bigint"))
    places = Window.partitionBy("chunk").orderBy("pos")
    lines = rec.select(
        "chunk", "pos",
        F.concat(
            F.when(F.row_number().over(places) == 1, "[").otherwise(","),
            "item_text",
            F.when(F.lead("pos").over(places).isNull(), "]").otherwise(""),
        ).alias("value"),
    )
    lines.repartition("chunk").sortWithinPartitions("chunk", "pos").select("chunk", "value").write.partitionBy("chunk").text(land)
    raw = read_large_arrays(spark, f"{land}/*/*.txt")
    chunk = F.regexp_extract("file", "chunk=([0-9]+)", 1).cast("bigint").alias("chunk")
    return C.classify(raw).select(chunk, "pos", "label", F.md5("text").alias("text_md5"))


@query("s2_read_lines")
def s2_read_lines(spark, sf):
    """Write the records as JSON Lines (S3), read them back line by line (S2): labels and texts."""
    from ..sources.records import read_records_lines, write_records

    land = X_.stream_location(spark, "landing-lines")
    write_records(A.raw_records_text(spark, sf).withColumnRenamed("item_text", "item"), land, "jsonl")
    raw = read_records_lines(spark, land)
    return C.classify(raw).groupBy("label", F.md5("text").alias("text_md5")).agg(F.count(F.lit(1)).alias("n"))


@query("t1_items_normalize")
def t1_items_normalize(spark, sf):
    return S.records_from_items(A.raw_records(spark, sf)).select("pos", "instruction", "input", "output", "drop_reason")
