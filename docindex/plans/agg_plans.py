"""Registered plans for aggregations and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from docindex import fixtures as fx
from docindex.functions.scoring import bm25
from docindex.operators import aggs as G
from docindex.operators import search as S
from docindex.plans.registry import register
from docindex.session import scratch_path
from docindex.sources.postings import bm25_postings, read_postings, write_postings
from docindex.plans.views import DOCS, LINES, with_


@register("g1_terms_agg", with_(DOCS) + """,
g AS (SELECT source AS key, count(*) AS doc_count, CAST(sum(n_chars) AS BIGINT) AS sum_n_chars,
             round(avg(n_chars), 6) AS avg_n_chars FROM docs WHERE NOT _deleted AND source IS NOT NULL GROUP BY source),
t AS (SELECT * FROM g ORDER BY doc_count DESC, key ASC LIMIT 5)
SELECT *, FALSE AS is_other FROM t
UNION ALL
SELECT NULL, CAST(COALESCE(sum(doc_count), 0) AS BIGINT), NULL, NULL, TRUE FROM g WHERE key NOT IN (SELECT key FROM t)""")
def g1_terms_agg(spark, sf):
    out = G.terms_agg(S.match_all(fx.docs(spark, sf)), "source", 5, metric_field="n_chars")
    return out.withColumn("avg_n_chars", F.round("avg_n_chars", 6))


@register("g1_terms_agg_lines", with_(LINES) + """,
g AS (SELECT l_returnflag AS key, count(*) AS doc_count FROM lines_ix WHERE NOT _deleted GROUP BY 1),
t AS (SELECT * FROM g ORDER BY doc_count DESC, key ASC LIMIT 2)
SELECT *, FALSE AS is_other FROM t
UNION ALL SELECT NULL, CAST(COALESCE(sum(doc_count), 0) AS BIGINT), TRUE FROM g WHERE key NOT IN (SELECT key FROM t)""")
def g1_terms_agg_lines(spark, sf):
    return G.terms_agg(S.match_all(fx.lineitem_children(spark, sf)), "l_returnflag", 2)


@register("g2_metric_agg", with_(LINES) + """
SELECT count(l_extendedprice) AS count, round(sum(l_extendedprice), 4) AS sum, min(l_extendedprice) AS min,
       max(l_extendedprice) AS max, round(avg(l_extendedprice), 6) AS avg FROM lines_ix WHERE NOT _deleted""")
def g2_metric_agg(spark, sf):
    m = G.metric_agg(S.match_all(fx.lineitem_children(spark, sf)), "l_extendedprice")
    return m.select("count", F.round("sum", 4).alias("sum"), "min", "max", F.round("avg", 6).alias("avg"))


@register("g3_filtered_agg", with_(DOCS) + """,
g AS (SELECT lang AS key, count(*) AS doc_count FROM docs WHERE NOT _deleted AND n_chars > 2000 GROUP BY 1),
t AS (SELECT * FROM g ORDER BY doc_count DESC, key ASC LIMIT 3)
SELECT *, FALSE AS is_other FROM t
UNION ALL SELECT NULL, CAST(COALESCE(sum(doc_count), 0) AS BIGINT), TRUE FROM g WHERE key NOT IN (SELECT key FROM t)""")
def g3_filtered_agg(spark, sf):
    # The page is 5 hits, but the buckets cover every match.
    res = S.search(fx.docs(spark, sf), F.col("n_chars") > 2000, from_=0, size=5)
    return G.filtered_agg(res.matches, "lang", 3)


_TERMS = ["und", "the", "les", "que"]


def _bm25_sql(per_shard: bool) -> str:
    tf = ",\n".join(f"len(list_filter(toks, lambda x: x = '{t}')) AS tf{i}" for i, t in enumerate(_TERMS))
    dfs = ", ".join(f"count(*) FILTER (WHERE tf{i} > 0) AS df{i}" for i in range(len(_TERMS)))
    grp = "GROUP BY _index, shard" if per_shard else ""
    key = "_index, shard, " if per_shard else ""
    join = "JOIN st USING (_index, shard)" if per_shard else "CROSS JOIN st"
    terms = " + ".join(
        f"CASE WHEN tf{i} > 0 THEN ln(1.0 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} / "
        f"(tf{i} + 1.2 * (0.25 + 0.75 * dl / (len_ / n))) ELSE 0.0 END" for i in range(len(_TERMS)))
    anytf = " OR ".join(f"tf{i} > 0" for i in range(len(_TERMS)))
    return with_(DOCS) + f""",
tk AS (SELECT *, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS toks FROM docs WHERE NOT _deleted AND text IS NOT NULL),
tt AS (SELECT * EXCLUDE (toks), len(toks) AS dl, {tf} FROM tk),
st AS (SELECT {key} CAST(count(*) AS DOUBLE) AS n, CAST(sum(dl) AS DOUBLE) AS len_, {dfs} FROM tt {grp}),
sc AS (SELECT tt.*, {terms} AS score FROM tt {join} WHERE {anytf})
"""


@register("r10_bm25_dfs", _bm25_sql(False) + """
SELECT _index, _id, round(score, 6) AS _score FROM sc ORDER BY score DESC, _index, _id LIMIT 20""")
def r10_bm25_dfs(spark, sf):
    hits = bm25(S.match_all(fx.docs(spark, sf)), "text", _TERMS, "dfs_query_then_fetch")
    page = S.search(hits, size=20).hits
    return page.select("_index", "_id", F.round("_score", 6).alias("_score"))


@register("r10_bm25_per_shard", _bm25_sql(True) + """
SELECT _index, _id, shard, round(score, 6) AS _score FROM sc""")
def r10_bm25_per_shard(spark, sf):
    hits = bm25(S.match_all(fx.docs(spark, sf)), "text", _TERMS, "query_then_fetch")
    return hits.select("_index", "_id", "shard", F.round("_score", 6).alias("_score"))


def _postings(spark, sf):
    root = scratch_path(spark, "postings")
    write_postings(fx.docs(spark, sf), "text", root)
    return root


@register("r10_bm25_postings", _bm25_sql(False) + """
SELECT _index, _id, shard, round(score, 6) AS _score FROM sc""")
def r10_bm25_postings(spark, sf):
    return bm25_postings(spark, _postings(spark, sf), _TERMS).withColumn("_score", F.round("_score", 6))


@register("r10_bm25_postings_per_shard", _bm25_sql(True) + """
SELECT _index, _id, shard, round(score, 6) AS _score FROM sc""")
def r10_bm25_postings_per_shard(spark, sf):
    return bm25_postings(spark, _postings(spark, sf), _TERMS, "query_then_fetch").withColumn("_score", F.round("_score", 6))


@register("r4_term_postings", with_(DOCS) + r"""
SELECT _index, _id FROM docs WHERE NOT _deleted AND list_contains(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), 'les')""")
def r4_term_postings(spark, sf):
    return read_postings(spark, _postings(spark, sf), ["les"]).select("_index", "_id")


@register("r11_max_score", _bm25_sql(False) + """
SELECT round(max(score), 6) AS max_score, count(*) AS total FROM sc""")
def r11_max_score(spark, sf):
    hits = bm25(S.match_all(fx.docs(spark, sf)), "text", _TERMS)
    m = S.with_max_score(hits)
    return m.select(F.round("max_score", 6).alias("max_score"), "total")


@register("r11_max_score_unscored", with_(DOCS) + """
SELECT CAST(NULL AS DOUBLE) AS max_score, count(*) AS total FROM docs WHERE NOT _deleted AND lang = 'fr'""")
def r11_max_score_unscored(spark, sf):
    return S.search(fx.docs(spark, sf), F.col("lang") == "fr").max_score()
