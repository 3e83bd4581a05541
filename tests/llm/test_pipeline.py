"""The pipeline: stages keep columns, decide as their operators do, and feed each other."""
import collections

import corpus_pipeline as P
from sifter.llm.common import table

from .conftest import SF001
from .test_documents import check_packing, reference_fingerprint, roots


def test_stages_on_a_small_table(spark):
    docs = table(spark, SF001, "documents")
    sizes = []
    for name, step in P.STAGES[:-1]:
        before, docs_in = docs.count(), docs
        docs = P.stage(step(spark, docs, SF001), f"test-{name}")
        assert docs.columns == docs_in.columns and docs.dtypes == docs_in.dtypes
        rows = {tuple(r) for r in docs.collect()}
        assert rows <= {tuple(r) for r in docs_in.collect()} and docs.count() == len(rows)
        sizes.append((name, before, len(rows)))
        if name == "exact_dedup":
            best = collections.defaultdict(int)
            for r in docs_in.collect():
                best[r.text] = max(best[r.text], r.doc_id)
            assert {r.doc_id for r in docs.collect()} == set(best.values())
        if name == "simhash_near_dedup":
            held = sorted((r.doc_id, reference_fingerprint(r.text)) for r in docs_in.collect())
            links = [(a, b) for a in range(len(held)) for b in range(a) if bin(held[a][1] ^ held[b][1]).count("1") <= 4]
            assert {r.doc_id for r in docs.collect()} == {held[r][0] for r in roots(len(held), links)}
    packed = P.packing(spark, docs, SF001).collect()
    check_packing([(r.doc_id, r.text or "") for r in docs.collect()], packed)
    assert all(after <= before for _, before, after in sizes) and sizes[1][2] < sizes[1][1]


def test_edge_cases(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, step in P.STAGES:
            docs = P.stage(step(spark, docs, SF001), f"edge-{name}")
        assert docs.columns[:3] == ["doc_id", "start", "length"]


def test_run_is_registered(spark):
    import __spark_entry__ as E

    assert E.queries()["pipeline"] is P.run and "pipeline" not in E.oracle_sql()
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "mixing", "packing"]
    assert P.run(spark, SF001).count() > 0
