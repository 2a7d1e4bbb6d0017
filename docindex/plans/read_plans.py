"""Registered plans for reads, search and analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from docindex import fixtures as fx
from docindex.functions.analyze import analyze, analyze_by_mapping
from docindex.operators import search as S
from docindex.plans.registry import register
from docindex.plans.views import DOCS, LINES, ORDERS, with_

DOC_COLS = "_index, _id, _version, _routing, _parent, _deleted, _seq, text, lang, source, n_chars, shard"


@register("r1_get_doc", with_(DOCS) + "SELECT * FROM docs WHERE _index = 'docs_en' AND _id = '7' AND NOT _deleted")
def r1_get_doc(spark, sf):
    return S.get_doc(fx.docs(spark, sf), "docs_en", "7")


@register("r1_get_doc_routed", with_(DOCS) + """
SELECT _index, _id, _version, _routing, _parent, _deleted, _seq, shard, lang, n_chars
FROM docs WHERE _index = 'docs_en' AND _id = '7' AND NOT _deleted
  AND shard = CAST(CAST(('0x' || substr(md5('src7'), 1, 8)) AS BIGINT) % 4 AS INTEGER)""")
def r1_get_doc_routed(spark, sf):
    # Routed get: the shard of routing key 'src7' is computed once on the driver
    # and pruned in the scan; a document routed elsewhere is simply not found.
    return S.get_doc(fx.docs(spark, sf), "docs_en", "7", routing="src7", n_shards=fx.DOC_SHARDS,
                     fields=["lang", "n_chars"])


@register("r2_mget_labels", with_(DOCS) + """
SELECT CAST(l.doc_id AS BIGINT) AS pos, 'docs_en' AS _index, CAST(l.doc_id AS VARCHAR) AS _id,
       d._id IS NOT NULL AS found, d._version, d._routing, d._parent, d._deleted, d._seq,
       d.text, d.lang, d.source, d.n_chars, d.shard
FROM labels l LEFT JOIN (SELECT * FROM docs WHERE NOT _deleted) d
  ON d._index = 'docs_en' AND d._id = CAST(l.doc_id AS VARCHAR)""")
def r2_mget_labels(spark, sf):
    return S.mget(fx.docs(spark, sf), fx.mget_keys_from_labels(spark, sf))


@register("r2_mget_orders", with_(ORDERS) + """,
keys AS (SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS BIGINT) AS pos,
                'orders' AS _index, CAST(l_orderkey AS VARCHAR) AS _id FROM lineitem)
SELECT k.pos, k._index, k._id, o._id IS NOT NULL AS found, o._version, o._routing, o._parent,
       o._deleted, o._seq, o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice,
       o.o_orderdate, o.o_orderpriority, o.shard
FROM keys k LEFT JOIN (SELECT * FROM orders_ix WHERE NOT _deleted) o ON o._index = k._index AND o._id = k._id""")
def r2_mget_orders(spark, sf):
    return S.mget(fx.orders_index(spark, sf), fx.mget_keys_from_lineitem(spark, sf))


@register("r3_match_all", with_(DOCS) + "SELECT * FROM docs WHERE NOT _deleted")
def r3_match_all(spark, sf):
    return S.match_all(fx.docs(spark, sf))


@register("r4_term_keyword", with_(DOCS) + "SELECT * FROM docs WHERE NOT _deleted AND lang = 'en'")
def r4_term_keyword(spark, sf):
    return S.term(fx.docs(spark, sf), "lang", "en")


@register("r4_term_text", with_(DOCS) + r"""
SELECT * FROM docs WHERE NOT _deleted
  AND list_contains(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), 'und')""")
def r4_term_text(spark, sf):
    return S.term(fx.docs(spark, sf), "text", "und", text_fields=("text",))


@register("r4_term_text_tokens", with_(DOCS) + r"""
SELECT * FROM docs WHERE NOT _deleted
  AND list_contains(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), 'les')""")
def r4_term_text_tokens(spark, sf):
    # Same query through a token table (the inverted-index form): semi-join on the token.
    d = fx.docs(spark, sf)
    toks = analyze(d, "text", "standard")
    return S.term(d, "text", "les", text_fields=("text",), tokens=toks)


@register("r5_search_page", with_(DOCS) + """
SELECT *, CAST(NULL AS DOUBLE) AS _score FROM docs WHERE NOT _deleted AND lang = 'en'
ORDER BY _id LIMIT 20 OFFSET 20""")
def r5_search_page(spark, sf):
    return S.search(fx.docs(spark, sf), F.col("lang") == "en", from_=20, size=20, order=["_id"]).hits


@register("r5_search_default_page", with_(DOCS) + """
SELECT *, CAST(NULL AS DOUBLE) AS _score FROM docs WHERE NOT _deleted AND source = 'src3'
ORDER BY _index, _id LIMIT 20""")
def r5_search_default_page(spark, sf):
    return S.search(fx.docs(spark, sf), F.col("source") == "src3").hits


@register("r5_deep_page", with_(LINES) + """
SELECT *, CAST(NULL AS DOUBLE) AS _score FROM lines_ix WHERE NOT _deleted ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity LIMIT 500 OFFSET 12000""")
def r5_deep_page(spark, sf):
    return S.search(fx.lineitem_children(spark, sf), from_=12_000, size=500, order=["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]).hits


@register("r5_search_total", with_(DOCS) + """
SELECT count(*) AS value, 'eq' AS relation FROM docs WHERE NOT _deleted AND lang = 'en'""")
def r5_search_total(spark, sf):
    return S.search(fx.docs(spark, sf), F.col("lang") == "en", size=20).total


@register("r6_multi_index", with_(DOCS, ORDERS) + """
SELECT _index, _id, _version, lang, n_chars, CAST(NULL AS VARCHAR) AS o_orderstatus,
       CAST(NULL AS DOUBLE) AS o_totalprice FROM docs WHERE NOT _deleted
UNION ALL
SELECT _index, _id, _version, CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), o_orderstatus, o_totalprice
FROM orders_ix WHERE NOT _deleted""")
def r6_multi_index(spark, sf):
    both = S.multi_index([fx.docs(spark, sf), fx.orders_index(spark, sf)])
    return S.match_all(both).select("_index", "_id", "_version", "lang", "n_chars", "o_orderstatus", "o_totalprice")


@register("r7_select_source", with_(DOCS) + """
SELECT _index, _id, _version, _routing, _parent, _deleted, _seq, shard, lang, n_chars
FROM docs WHERE NOT _deleted""")
def r7_select_source(spark, sf):
    return S.select_source(S.match_all(fx.docs(spark, sf)), ["lang", "n_chars"])


@register("r7_no_source", with_(DOCS) + """
SELECT _index, _id, _version, _routing, _parent, _deleted, _seq, shard FROM docs WHERE NOT _deleted""")
def r7_no_source(spark, sf):
    return S.select_source(S.match_all(fx.docs(spark, sf)), source=False)


@register("r8_terminate_after", with_(DOCS) + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY _index, shard ORDER BY _id) AS rn FROM docs WHERE NOT _deleted)
WHERE rn <= 5""")
def r8_terminate_after(spark, sf):
    return S.terminate_after(S.match_all(fx.docs(spark, sf)), 5)


@register("r9_scroll", with_(DOCS) + """
SELECT * EXCLUDE (rn), CAST(rn AS BIGINT) AS rank, CAST((rn - 1) // 10 AS BIGINT) AS page FROM (
  SELECT *, row_number() OVER (ORDER BY _index, _id) AS rn FROM docs WHERE NOT _deleted) t""")
def r9_scroll(spark, sf):
    return S.scroll(S.match_all(fx.docs(spark, sf)), 10)


@register("r9_scroll_pages", with_(DOCS) + """
SELECT CAST((rn - 1) // 10 AS BIGINT) AS page, count(*) AS hits, min(_id) AS first_id, max(_id) AS last_id
FROM (SELECT _id, row_number() OVER (ORDER BY _index, _id) AS rn FROM docs WHERE NOT _deleted AND lang = 'en') t
GROUP BY 1""")
def r9_scroll_pages(spark, sf):
    pages = S.scroll(S.term(fx.docs(spark, sf), "lang", "en"), 10)
    return pages.groupBy("page").agg(F.count(F.lit(1)).alias("hits"), F.min("_id").alias("first_id"),
                                     F.max("_id").alias("last_id"))


@register("r12_parent_child", with_(ORDERS, LINES) + """
SELECT c.*, p._index AS parent_index, p._id AS parent_id, p._version AS parent_version,
       p.o_orderkey AS parent_o_orderkey, p.o_custkey AS parent_o_custkey,
       p.o_orderstatus AS parent_o_orderstatus, p.o_totalprice AS parent_o_totalprice,
       p.o_orderdate AS parent_o_orderdate, p.o_orderpriority AS parent_o_orderpriority
FROM lines_ix c JOIN orders_ix p ON c._parent = p._id WHERE NOT c._deleted AND NOT p._deleted""")
def r12_parent_child(spark, sf):
    return S.parent_child(fx.orders_index(spark, sf), fx.lineitem_children(spark, sf), parent_index="orders")


@register("r12_has_child", with_(ORDERS, LINES) + """
SELECT * FROM orders_ix p WHERE NOT _deleted AND o_orderstatus = 'F'
  AND EXISTS (SELECT 1 FROM lines_ix c WHERE c._parent = p._id AND NOT c._deleted AND c.l_returnflag = 'R')""")
def r12_has_child(spark, sf):
    parents = fx.orders_index(spark, sf).where(F.col("o_orderstatus") == "F")
    kids = fx.lineitem_children(spark, sf).where(F.col("l_returnflag") == "R")
    return S.parent_child(parents, kids, how="has_child", parent_index="orders")


@register("r12_has_no_child", with_(ORDERS, LINES) + """
SELECT * FROM orders_ix p WHERE NOT _deleted
  AND NOT EXISTS (SELECT 1 FROM lines_ix c WHERE c._parent = p._id AND NOT c._deleted AND c.l_quantity > 45)""")
def r12_has_no_child(spark, sf):
    kids = fx.lineitem_children(spark, sf).where(F.col("l_quantity") > 45)
    return S.parent_child(fx.orders_index(spark, sf), kids, how="has_no_child", parent_index="orders")


# ------------------------------------------------------------------ analysis
_T1 = r"""d AS (SELECT 'docs_' || lang AS _index, CAST(doc_id AS VARCHAR) AS _id, {col} AS v FROM documents),
p AS (SELECT _index, _id, regexp_extract_all(v, '{pat}', 1) AS seps, regexp_extract_all(v, '{pat}', 2) AS toks FROM d),
u AS (SELECT _index, _id, unnest(seps) AS sep, unnest(toks) AS tok, unnest(generate_series(0, len(toks) - 1)) AS pos FROM p),
e AS (SELECT *, sum(length(sep) + length(tok)) OVER (PARTITION BY _index, _id ORDER BY pos
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS endo FROM u)
SELECT _index, _id, '{col}' AS field, {tokexpr} AS token, CAST(endo - length(tok) AS INTEGER) AS start_offset,
       CAST(endo AS INTEGER) AS end_offset, {typeexpr} AS type, CAST(pos AS INTEGER) AS position FROM e"""

_STD = r"([^\p{L}\p{N}]*)([\p{L}\p{N}]+)"
_WS = r"(\s*)(\S+)"
_STD_TYPE = r"CASE WHEN regexp_full_match(tok, '\p{N}+') THEN '<NUM>' ELSE '<ALPHANUM>' END"


def _t_sql(col, pat, tokexpr, typeexpr):
    return "WITH " + _T1.format(col=col, pat=pat, tokexpr=tokexpr, typeexpr=typeexpr)


@register("t1_analyze_standard", _t_sql("text", _STD, "lower(tok)", _STD_TYPE))
def t1_analyze_standard(spark, sf):
    return analyze(fx.docs(spark, sf), "text", "standard")


# The same rules without look-around, for text of letters with case: letters with inner marks, numbers with theirs, connectors.
_DOT = ":\u00b7"
_MIDS = "." + "''" + "\u2018\u2019"
_UNI = rf"(?s)(.*?)(\p{{Pc}}*(?:\p{{L}}[\p{{L}}\p{{M}}]*(?:[{_MIDS}{_DOT}]\p{{L}}[\p{{L}}\p{{M}}]*)*|\p{{Nd}}+(?:[{_MIDS},;]\p{{Nd}}+)*)(?:\p{{L}}[\p{{L}}\p{{M}}]*(?:[{_MIDS}{_DOT}]\p{{L}}[\p{{L}}\p{{M}}]*)*|\p{{Nd}}+(?:[{_MIDS},;]\p{{Nd}}+)*|\p{{Pc}})*)"


@register("t1_analyze_unicode", _t_sql("text", _UNI, "lower(tok)", r"CASE WHEN regexp_full_match(tok, '\p{N}+') THEN '<NUM>' ELSE '<ALPHANUM>' END"))
def t1_analyze_unicode(spark, sf):
    return analyze(fx.docs(spark, sf), "text", "unicode")


@register("t2_analyze_whitespace", _t_sql("text", _WS, "tok", "'word'"))
def t2_analyze_whitespace(spark, sf):
    return analyze(fx.docs(spark, sf), "text", "whitespace")


@register("t3_analyze_keyword", """
SELECT 'docs_' || lang AS _index, CAST(doc_id AS VARCHAR) AS _id, 'source' AS field, source AS token,
       0 AS start_offset, CAST(length(source) AS INTEGER) AS end_offset, 'word' AS type, 0 AS position
FROM documents WHERE source IS NOT NULL""")
def t3_analyze_keyword(spark, sf):
    return analyze(fx.docs(spark, sf), "source", "keyword")


@register("t4_analyze_by_mapping", _t_sql("text", _STD, "lower(tok)", _STD_TYPE) + """
UNION ALL
SELECT 'docs_' || lang, CAST(doc_id AS VARCHAR), 'lang', lang, 0, CAST(length(lang) AS INTEGER), 'word', 0
FROM documents WHERE lang IS NOT NULL""")
def t4_analyze_by_mapping(spark, sf):
    return analyze_by_mapping(fx.docs(spark, sf), {"text": "standard", "lang": "keyword"})
