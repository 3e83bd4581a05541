"""Mixing sources to target weights by hierarchical budgeting. DataFrame functions only.

A tree domain > language > source has a whole-number weight at every node. The
token budget of the root is dealt down level by level: siblings share by
weight, no node gets more than its leaves can supply (their tokens times
``max_epochs``), and what a node can't take goes to its siblings. As a node
first fills all of its own children, a shortage reaches an ancestor's siblings
only when the whole subtree is full.

A leaf's budget is taken as whole epochs of its documents plus a token-prefix
of one more epoch, in the seeded order of that epoch. The cut of the prefix is
found from token sums of hashed buckets of the order; only the bucket that
holds the cut is sorted, so a leaf with a third of all rows is no single group.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_or_empty, whole_row

LEVELS = ("domain", "lang", "source")
BUCKET_ROWS = 20_000
BROADCAST_LEAVES = 10_000  # leaf tables up to this many rows are broadcast, larger ones joined by shuffle
NONE = "(none)"

# Weights of the registered query; a node not named weighs 1.
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}


def weight(col: str, weights: dict[str, int]) -> Column:
    out = F.lit(1).cast("bigint")
    for name, w in weights.items():
        out = F.when(F.col(col) == name, F.lit(int(w)).cast("bigint")).otherwise(out)
    return out


def source_domain(col: str = "source") -> Column:
    """Domain of a source: ``d`` and its trailing number modulo 4 (no number: ``d0``)."""
    n = F.regexp_extract(F.col(col), "([0-9]{1,9})$", 1)
    return F.concat(F.lit("d"), F.coalesce(n.try_cast("int") % 4, F.lit(0)).cast("string"))


def count_words(col: Column) -> Column:
    return F.regexp_count(col, F.lit("[^ \\t\\n\\x0B\\f\\r]+")).cast("bigint")


def _deal(nodes: DataFrame, parent: list[str], name: str, weights: Column) -> DataFrame:
    """Deal each parent's ``budget`` to its children (column ``name``, supply ``cap``): adds ``share``.

    Children are taken by rising supply per weight; child i is full if, with
    the level at its own supply per weight, the siblings would need no more
    than the budget. The rest share what is left by weight, rounded down.
    """
    n = nodes.withColumn("_w", weights).filter("_w > 0")
    by = Window.partitionBy(*parent).orderBy((F.col("cap") / F.col("_w")).asc(), name)
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everyone = Window.partitionBy(*parent)
    big = lambda c: F.col(c).cast("decimal(38,0)")
    n = n.select("*", F.sum("cap").over(upto).alias("_pc"), F.sum("_w").over(upto).alias("_pw"), F.sum("_w").over(everyone).alias("_tw"))
    full = big("_pc") * big("_w") + big("cap") * (F.col("_tw") - F.col("_pw")).cast("decimal(38,0)") <= big("budget") * big("_w")
    n = n.withColumn("_full", full)
    taken = F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(everyone)
    weight_left = F.sum(F.when(F.col("_full"), 0).otherwise(F.col("_w"))).over(everyone)
    n = n.withColumn("_left", F.col("budget") - taken).withColumn("_wl", weight_left)
    return n.withColumn("share", F.when(F.col("_full"), F.col("cap")).otherwise(F.expr("(_left * _w) div _wl"))).drop(
        "_w", "_pc", "_pw", "_tw", "_full", "_left", "_wl"
    )


def leaf_budgets(supply: DataFrame, budget: int, weights: dict[str, Column], max_epochs: int) -> DataFrame:
    """(levels..., tokens, n_docs, budget) of every leaf of ``supply(levels..., tokens, n_docs)``."""
    levels = list(weights)
    leaves = supply.withColumn("cap", F.col("tokens") * max_epochs)
    upper: DataFrame | None = None
    for depth, name in enumerate(levels):
        path = levels[: depth + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap"))
        if upper is None:
            nodes = nodes.withColumn("_root", F.lit(0)).withColumn("budget", F.lit(int(budget)).cast("bigint"))
            dealt = _deal(nodes, ["_root"], name, weights[name]).drop("_root")
        else:
            dealt = _deal(nodes.join(upper, path[:-1]), path[:-1], name, weights[name])
        upper = dealt.select(*path, F.col("share").cast("bigint").alias("budget"))
    return leaves.join(upper, levels).select(*levels, "tokens", "n_docs", "budget")


def _order(seed: int, epoch: Column, id_col: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))


def _bucket(order: Column, buckets: Column) -> Column:
    return F.floor(F.conv(F.substring(order, 1, 8), 16, 10).cast("bigint") * buckets / F.lit(float(1 << 32))).cast("bigint")


def plan(narrow: DataFrame, budget: int, weights: dict[str, Column], max_epochs: int, seed: int) -> DataFrame:
    """One row a leaf: (levels..., epochs, rest, cut_order, cut_id, cut_tokens).

    ``narrow`` is (levels..., doc_id, tokens > 0), staged. A document is in the
    epochs before ``epochs`` whole; in epoch ``epochs`` it is in if
    (order, id, tokens) is before the cut, and at the cut up to the tokens left there.
    """
    levels = list(weights)
    supply = narrow.groupBy(*levels).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs"))
    leaves = leaf_budgets(supply, budget, weights, max_epochs)
    leaves = leaves.select(
        *levels, F.expr("budget div tokens").alias("epochs"), F.expr("budget % tokens").alias("rest"),
        (F.expr(f"n_docs div {BUCKET_ROWS}") + 1).alias("buckets"),
    )
    leaves = stage(leaves, "mix-leaves")
    rows = with_leaf(narrow, leaves, levels)
    rows = rows.filter("rest > 0").withColumn("_order", _order(seed, F.col("epochs"), F.col("doc_id")))
    rows = rows.withColumn("_b", _bucket(F.col("_order"), F.col("buckets")))
    sums = rows.groupBy(*levels, "rest", "_b").agg(F.sum("tokens").alias("n"))
    before = Window.partitionBy(*levels).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    edge = sums.filter("_before < rest AND _before + n >= rest").select(*levels, F.col("_b").alias("_edge"), "_before")
    inside = with_leaf(rows, edge, levels).filter("_b = _edge")
    upto = Window.partitionBy(*levels).orderBy("_order", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("_at", F.col("_before") + F.coalesce(F.sum("tokens").over(upto), F.lit(0)))
    cut = inside.filter("_at < rest AND _at + tokens >= rest").select(
        *levels, F.col("_order").alias("cut_order"), F.col("doc_id").alias("cut_id"), F.col("tokens").alias("cut_size"), (F.col("rest") - F.col("_at")).alias("cut_tokens")
    )
    return leaves.join(cut, levels, "left").select(*levels, "epochs", "rest", "cut_order", "cut_id", "cut_size", "cut_tokens")


def with_leaf(rows: DataFrame, leaves: DataFrame, levels: list[str]) -> DataFrame:
    """Join rows to their leaf: broadcast where the leaf table is small (checked), else by shuffle with AQE's skew split."""
    few = leaves.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
    return rows.join(F.broadcast(leaves) if few else leaves, levels)


def chosen(rows: DataFrame, planned: DataFrame, levels: list[str], seed: int, whole: bool = False) -> DataFrame:
    """``rows`` (levels..., doc_id, tokens and others) once per epoch they are in, with ``epoch`` and ``take_tokens``.

    Rows that equal the cut row in order, id and tokens share its place: the
    tokens left there go to one of them. ``whole`` takes the cut row whole.
    """
    r = with_leaf(rows, planned, levels).withColumn("_order", _order(seed, F.col("epochs"), F.col("doc_id")))
    mine = F.struct(F.col("_order"), F.col("doc_id"), F.col("tokens"))
    cut = F.struct(F.col("cut_order"), F.col("cut_id"), F.col("cut_size"))
    more = F.when(F.col("cut_order").isNull(), F.lit(0)).when(mine < cut, F.col("tokens")).when(mine == cut, F.col("tokens") if whole else F.col("cut_tokens")).otherwise(0)
    r = r.withColumn("_more", F.coalesce(more, F.lit(0)).cast("bigint"))
    last = F.col("epochs") + F.when(F.col("_more") > 0, 1).otherwise(0) - 1
    r = r.filter(last >= 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    take = F.when(F.col("epoch") < F.col("epochs"), F.col("tokens")).otherwise(F.col("_more"))
    return r.withColumn("take_tokens", take).drop("epochs", "rest", "cut_order", "cut_id", "cut_size", "cut_tokens", "_order", "_more")


def _levels(docs: DataFrame) -> DataFrame:
    named = docs.withColumn("domain", source_domain())
    for name in ("lang", "source"):
        named = named.withColumn(name, F.coalesce(F.col(name).cast("string"), F.lit(NONE)))
    return named.withColumn("domain", F.coalesce("domain", F.lit(NONE)))


def default_weights() -> dict[str, Column]:
    return {"domain": weight("domain", DOMAIN_WEIGHTS), "lang": weight("lang", LANG_WEIGHTS), "source": F.lit(1).cast("bigint")}


def mix(docs: DataFrame, share: float = 0.5, max_epochs: int = 4, weights: dict[str, Column] | None = None, seed: int = 42) -> DataFrame:
    """One row per document and epoch taken: (doc_id, domain, lang, source, epoch, tokens, take_tokens).

    The budget is ``share`` of all tokens (words between white space). NULL
    lang and source count as ``(none)``; documents without words are never
    taken; the document at a leaf's cut gives only its first ``take_tokens``.
    Rows that repeat an id are documents each on its own. An empty table gives
    no rows.
    """
    weights = weights or default_weights()
    d = _levels(docs.select("doc_id", "lang", "source", "text"))
    narrow = stage(d.select("doc_id", *weights, count_words(text_or_empty()).alias("tokens")).filter("tokens > 0"), "mix")
    total = narrow.agg(F.sum("tokens")).first()[0] or 0
    planned = stage(plan(narrow, int(total * share), weights, max_epochs, seed), "mix-plan")
    return chosen(narrow, planned, list(weights), seed).select("doc_id", *weights, "epoch", "tokens", "take_tokens")


def mix_rows(docs: DataFrame, share: float = 0.9, max_epochs: int = 1, weights: dict[str, Column] | None = None, seed: int = 42) -> DataFrame:
    """The rows of ``docs`` that ``mix`` takes, whole (one per epoch), with
    the columns of ``docs``. The plan is made from ids and token counts; texts
    are then filtered where they lie."""
    weights = weights or default_weights()
    d = _levels(docs.select("doc_id", "lang", "source", "text", whole_row(docs).alias("_row")))
    d = d.select("_row", "doc_id", *weights, count_words(text_or_empty()).alias("tokens")).filter("tokens > 0")
    narrow = stage(d.select("doc_id", *weights, "tokens"), "mix")
    total = narrow.agg(F.sum("tokens")).first()[0] or 0
    planned = stage(plan(narrow, int(total * share), weights, max_epochs, seed), "mix-plan")
    return chosen(d, planned, list(weights), seed, whole=True).select("_row.*")
