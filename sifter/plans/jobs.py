"""Whole jobs composed from the operators (C11, G8, T10 and friends)."""
from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..session import checkpoint_dir

_STAGED: list[str] = []
# Settings while a stage is written. Shuffle files go when its query ends, as
# later steps read only what it wrote; Arrow batches are kept to a few MB, as
# documents can be long and each Python worker holds a batch several times over.
STAGE_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


@contextmanager
def _stage_settings(spark: SparkSession):
    old = {k: spark.conf.get(k, None) for k in STAGE_SETTINGS}
    for k, v in STAGE_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage (a lost executor re-reads the table instead of
    recomputing it) and lets later steps read only the columns they need.
    :func:`drop_staged` deletes what was staged."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    with _stage_settings(df.sparkSession):
        df.write.parquet(path)
    _STAGED.append(path)
    out = df.sparkSession.read.parquet(path)
    out.staged_path = path
    return out


def drop_staged(spark: SparkSession, *tables: DataFrame) -> int:
    """Delete staged ``tables``, or all that this process has staged; returns
    how many. Call it once what was made of them is written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [t.staged_path for t in tables] if tables else list(_STAGED)
    for path in paths:
        _STAGED.remove(path)
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)


def clean_job(raw: DataFrame, minify_output: bool = False, exact: bool = False, required: dict | None = None):
    """read -> classify -> keep valid (-> minify output) ; plus quarantine and report (C11).

    Returns ``(clean, quarantine, report)``, lazily: each is one pass over
    ``raw``. ``clean`` keeps the original VARIANT ``item`` (and ``text``, if
    ``raw`` has it) next to typed instruction/input/output. To write all three
    from one pass use :func:`clean_files`.
    """
    classified = C.classify(raw, required=required, exact=exact)
    return _outputs(classified, minify_output, exact)


def _outputs(classified: DataFrame, minify_output: bool, exact: bool):
    kept = C.project_record(C.clean(classified).drop("label", "doc"), keep_item=True)
    if minify_output:
        kept = C.minify(kept, "output", exact=exact)
        if "text" in kept.columns:
            kept = C.rewrite_output(kept)
    return kept, C.quarantine(classified).drop("doc"), C.validation_report(classified)


def clean_files(
    spark: SparkSession, source, target: str, fmt: str = "json", minify_output: bool = False, exact: bool = False, required: dict | None = None
) -> DataFrame:
    """The clean job from path to path (C11): read ``source`` (``array`` files,
    ``large_array`` files read in splits, or JSON Lines, ``json``), classify once, write ``target``/clean (JSON Lines
    in position order of each file, records as they were written),
    ``target``/quarantine (JSON Lines with the label and the record's text) and
    ``target``/report; returns the report.

    The classified rows are staged, so the input is read and parsed once.
    """
    from ..sources import records as IO
    from ..sources.arrays import read_large_arrays

    if fmt == "large_array":
        raw = read_large_arrays(spark, source)
    else:
        raw = IO.read_records(spark, source, with_text=True) if fmt == "array" else IO.read_records_lines(spark, source)
    classified = C.classify(raw, required=required, exact=exact)
    kept, rejected, report = _outputs(stage(classified.drop("doc"), "classified"), minify_output, exact)
    IO.write_records(kept.select("file", "pos", "item", "text").sortWithinPartitions("file", "pos"), f"{target}/clean", "jsonl")
    rejected.select("file", "pos", "label", "text").write.mode("overwrite").json(f"{target}/quarantine")
    report.write.mode("overwrite").json(f"{target}/report")
    return spark.read.schema(report.schema).json(f"{target}/report")


def generation_job(prompts: DataFrame, seeds: DataFrame, generator, target: int, k: int = 3, seed: int = 42, write_to: str | None = None):
    """Few-shot generation end to end (lifecycle E2) -> ``(dataset, stats)``.

    prompts(prompt_id, n_items) -> k seeds each (P1) -> prompt text (P2) ->
    ``generator`` over Arrow batches (P4) -> items + per-response stats (G8)
    -> seed rows plus the first ``target`` generated items (S7). ``stats`` has
    one row per prompt: a prompt whose call failed has status
    ``request_error``, no items and the error text.

    The generator's answers are written (``write_to``, default a fresh table
    under the shared checkpoint folder) before parsing, so a retried task
    never asks the generator again.
    """
    from ..operators import checkpoints as K
    from ..operators import prompts as P
    from ..operators import responses as R
    from ..operators.rank import global_rank, pos_bucket

    bodies = P.apply_generator(P.sampled_prompts(prompts, seeds, k, seed), generator, keys=["prompt_id"])
    if write_to:
        bodies.write.mode("overwrite").parquet(write_to)
        bodies = bodies.sparkSession.read.parquet(write_to)
    else:
        bodies = stage(bodies, "responses")
    items, stats = R.parse_responses(bodies.filter(F.col("error").isNull()).select("prompt_id", "body"))
    zero = F.lit(0).cast("bigint")
    failed = bodies.filter(F.col("error").isNotNull()).select(
        "prompt_id", zero.alias("n_items"), zero.alias("n_dropped"), F.lit(R.REQUEST_ERROR).alias("status"), "error"
    )
    stats = stats.withColumn("error", F.lit(None).cast("string")).unionByName(failed)
    # generated order: prompt, then position in the answer, as a dense place
    placed = global_rank(items, ["prompt_id", "item_idx"], [pos_bucket("prompt_id", 12), pos_bucket("item_idx")], name="_r")
    gen = placed.select((F.col("_r") - 1).alias("pos"), "instruction", "input", "output")
    return K.finalize_dataset(seeds.select("pos", "instruction", "input", "output"), gen, target), stats


def sample_job(records: DataFrame, batch_size: int = 8, max_length: int = 1024, ratio: float = 0.02, seed: int = 42, pad_id: int = 0, **kw):
    """Records -> padded train/eval batches (lifecycle E3) -> ``(batches, drops)``.

    ``records`` are text columns, or raw VARIANT items (``item``): these are
    normalised first, and items that are no objects are counted as dropped. A
    dataset of many files is numbered through. Samples are staged once as
    Parquet; the split and batch plan is computed on (pos, n_tokens) only and
    joined back, so the tokens cross one shuffle. A dataset without a usable
    sample fails.
    """
    from ..operators import samples as S

    if "item" in records.columns and "output" not in records.columns:
        records = S.records_from_items(records)
    samples, drops = S.build_samples(records, max_length=max_length, **kw)
    keys = [c for c in ("file", "pos") if c in samples.columns]
    samples = stage(S.dense_positions(samples.select(*keys, "n_tokens", "n_masked", "input_ids")), "samples")
    if samples.isEmpty():
        raise ValueError("no usable sample in the dataset")
    plan = S.collate_plan(samples, batch_size, ratio, seed)
    return S.collate(samples, plan, pad_id=pad_id), drops
