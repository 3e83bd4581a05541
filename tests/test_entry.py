"""Driver contract: entry() and every registered query run at sf0.001 with a
stable schema, and every query has its SQL statement."""
import pytest

import __spark_entry__ as E
from sifter.plans.catalog import QUERIES

from .conftest import SF001


NO_SQL = {"t6_vocabulary_samples"}  # a tokenizer; tests/test_vocabulary.py compares every row with its library


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["total"] > 0
    assert df.columns == E.entry(spark).columns


def test_every_sql_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) - NO_SQL <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_smoke(spark, name):
    fn = E.queries()[name]
    df = fn(spark, SF001)
    first = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    df.write.format("noop").mode("overwrite").save()
    again = [(f.name, f.dataType.simpleString()) for f in fn(spark, SF001).schema.fields]
    assert first == again
    assert len({n for n, _ in first}) == len(first)
