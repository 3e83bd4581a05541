"""Distributed selection against sorting, on ties, sparse and hot keys."""
import math

import pytest
from pyspark.sql import functions as F

from sifter.operators import checkpoints as K
from sifter.operators import samples as S
from sifter.operators import select as L


def positions(n):
    return [None if i % 50 == 49 else (i * 7919) % 1009 - 300 + (2**40 if i % 9 == 0 else 0) for i in range(n)]


@pytest.mark.parametrize("inside", [100_000, 40, 0])
@pytest.mark.parametrize("k", [0, 1, 7, 333, 999, 1000, 5000])
def test_first_rows_by_number(spark, monkeypatch, inside, k):
    monkeypatch.setattr(L, "INSIDE_ROWS", inside)
    pos = positions(1000)
    df = spark.createDataFrame([(p, f"r{i}") for i, p in enumerate(pos)], "pos bigint, first_of string")
    cut = L.find_cut(df, L.number_key(), lambda n: k, 16)
    got = L.flag_first(df, L.number_key(), cut, "in_").collect()
    taken = [r for r in got if r.in_]
    assert len(got) == 1000 and len(taken) == min(k, 1000)
    order = lambda p: (p is not None, p or 0)
    assert sorted(order(r.pos) for r in taken) == sorted(map(order, pos))[:k]


@pytest.mark.parametrize("n", [0, 1, 49, 50, 51, 2000])
def test_split_has_the_exact_size_under_ties(spark, n):
    df = spark.range(n).select((F.col("id") % 40).alias("pos"), F.col("id").alias("row"))
    rows = S.split_exact(df).collect()
    assert len(rows) == n and len({r.row for r in rows}) == n
    assert sum(r.split == "eval" for r in rows) == math.floor(n * 0.02)


def test_hot_key_at_the_cut(spark, monkeypatch):
    monkeypatch.setattr(L, "INSIDE_ROWS", 10)
    df = spark.range(3000).select(F.lit(5).cast("bigint").alias("pos"), F.col("id").alias("row"))
    cut = L.find_cut(df, L.number_key(), lambda n: 1234, 16)
    assert L.flag_first(df, L.number_key(), cut).filter("first").count() == 1234


def test_split_moves_no_rows(spark):
    """No exchange in the plan reads more than the rows at the cut."""
    df = spark.range(0, 300_000, 1, 8).select(F.col("id").alias("pos"))
    split = S.split_exact(df)
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("Union")[1].splitlines()
    assert "Union" in plan and not any("Window" in line or "Join" in line for line in above[1:2])
    h = F.md5(F.concat(F.lit("42:"), F.col("pos").cast("string")))
    best = {r.pos for r in df.orderBy(h).limit(6000).collect()}
    assert {r.pos for r in split.filter("split = 'eval'").collect()} == best


def test_finalize_takes_ties_by_the_whole_row(spark):
    seed = spark.createDataFrame([(0, "s")], "pos bigint, output string")
    gen = spark.createDataFrame([(i // 3, f"g{i % 3}") for i in range(30)], "pos bigint, output string")
    for parts in (1, 5):
        got = K.finalize_dataset(seed, gen.repartition(parts), 7).filter("source = 'generated'").collect()
        assert sorted(r.output for r in got) == sorted(["g0", "g1", "g2", "g0", "g1", "g2", "g0"])
