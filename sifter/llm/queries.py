"""Registered queries of this subpackage: one per operator over its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


@query(
    "op2_exact_dedup",
    """
    SELECT doc_id,
           max(doc_id) OVER (PARTITION BY t) AS keep_id,
           count(*) OVER (PARTITION BY t) AS group_size,
           row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept,
           sha256(t) AS text_sha256
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
    """,
)
def op2_exact_dedup(spark, sf):
    from .exact_dedup import dedup_report

    return dedup_report(table(spark, sf, "documents"))


@query("op9_hash_tree_sharding")
def op9_hash_tree_sharding(spark, sf):
    from pyspark.sql import functions as F

    from .sharding import shard_documents

    placed = shard_documents(table(spark, sf, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "region", "rack")


@query("op6_simhash_near_dedup")
def op6_simhash_near_dedup(spark, sf):
    from .simhash import near_groups

    return near_groups(table(spark, sf, "documents"))


@query("op5_toxicity_ftrl")
def op5_toxicity_ftrl(spark, sf):
    from .toxicity import toxicity_scores

    return toxicity_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op4_nnls_packing")
def op4_nnls_packing(spark, sf):
    from .packing import pack

    return pack(table(spark, sf, "documents"))


@query("op1_multi_index_search")
def op1_multi_index_search(spark, sf):
    from pyspark.sql import functions as F

    from .multi_index import search

    return search(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


_MIX_SQL = """
WITH d AS (
  SELECT doc_id, 'd' || (coalesce(try_cast(regexp_extract(source, '([0-9]{1,9})$', 1) AS INT) % 4, 0))::VARCHAR AS domain,
         coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+'))::BIGINT AS tokens
  FROM documents),
n AS (SELECT * FROM d WHERE tokens > 0),
leaf AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, (4 * sum(tokens))::BIGINT AS cap FROM n GROUP BY ALL),
l1 AS (SELECT domain, sum(cap)::HUGEINT AS cap, (SELECT floor(sum(tokens) * 0.5)::HUGEINT FROM n) AS budget,
       CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END::HUGEINT AS w FROM leaf GROUP BY ALL),
f1 AS (SELECT *, sum(cap) OVER u * w + cap * (sum(w) OVER () - sum(w) OVER u) <= budget * w AS full_
       FROM l1 WINDOW u AS (ORDER BY cap / w::DOUBLE, domain ROWS UNBOUNDED PRECEDING)),
s1 AS (SELECT domain, CASE WHEN full_ THEN cap ELSE ((budget - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER ()) * w)
       // sum(CASE WHEN full_ THEN 0 ELSE w END) OVER () END::HUGEINT AS budget FROM f1),
l2 AS (SELECT domain, lang, sum(cap)::HUGEINT AS cap, any_value(budget) AS budget,
       CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END::HUGEINT AS w FROM leaf JOIN s1 USING (domain) GROUP BY domain, lang),
f2 AS (SELECT *, sum(cap) OVER u * w + cap * (sum(w) OVER (PARTITION BY domain) - sum(w) OVER u) <= budget * w AS full_
       FROM l2 WINDOW u AS (PARTITION BY domain ORDER BY cap / w::DOUBLE, lang ROWS UNBOUNDED PRECEDING)),
s2 AS (SELECT domain, lang, CASE WHEN full_ THEN cap ELSE ((budget - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER p) * w)
       // sum(CASE WHEN full_ THEN 0 ELSE w END) OVER p END::HUGEINT AS budget FROM f2 WINDOW p AS (PARTITION BY domain)),
f3 AS (SELECT *, sum(cap) OVER u + cap * (count(*) OVER (PARTITION BY domain, lang) - count(*) OVER u) <= budget AS full_
       FROM leaf JOIN s2 USING (domain, lang) WINDOW u AS (PARTITION BY domain, lang ORDER BY cap::DOUBLE, source ROWS UNBOUNDED PRECEDING)),
s3 AS (SELECT domain, lang, source, tokens, CASE WHEN full_ THEN cap ELSE (budget - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER p)
       // sum(CASE WHEN full_ THEN 0 ELSE 1 END) OVER p END::BIGINT AS budget FROM f3 WINDOW p AS (PARTITION BY domain, lang)),
b AS (SELECT domain, lang, source, budget // tokens AS epochs, budget % tokens AS rest FROM s3),
o AS (SELECT n.*, epochs, rest, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source
        ORDER BY md5('42:' || epochs::VARCHAR || ':' || doc_id::VARCHAR), doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_
      FROM n JOIN b USING (domain, lang, source)),
m AS (SELECT *, greatest(0, least(tokens, rest - before_)) AS more FROM o),
e AS (SELECT *, unnest(range(0, (epochs + CASE WHEN more > 0 THEN 1 ELSE 0 END)::BIGINT)) AS epoch FROM m)
SELECT doc_id, domain, lang, source, epoch, tokens, CASE WHEN epoch < epochs THEN tokens ELSE more END::BIGINT AS take_tokens FROM e
"""


@query("op3_hierarchical_mixing", _MIX_SQL)
def op3_hierarchical_mixing(spark, sf):
    from .mixing import mix

    return mix(table(spark, sf, "documents"))


@query("op7_suffix_index_dedup")
def op7_suffix_index_dedup(spark, sf):
    from .suffix_index import repeat_report

    return repeat_report(table(spark, sf, "documents"))


@query("op10_fuzzy_lines")
def op10_fuzzy_lines(spark, sf):
    from .fuzzy_lines import line_report

    return line_report(table(spark, sf, "documents"), letters_only=False)


@query("op8_secret_forest")
def op8_secret_forest(spark, sf):
    from .secret_forest import secret_report

    return secret_report(table(spark, sf, "documents"))


def _manifest_sql() -> str:
    from .merkle import manifest_sql

    return manifest_sql()


@query("op11_merkle_manifest", _manifest_sql())
def op11_merkle_manifest(spark, sf):
    from .merkle import manifest

    return manifest(table(spark, sf, "documents"))


@query("op12_token_files")
def op12_token_files(spark, sf):
    from .token_files import token_report

    return token_report(table(spark, sf, "documents"))


@query("op13_token_align")
def op13_token_align(spark, sf):
    from .token_align import align_report

    return align_report(table(spark, sf, "documents"))
