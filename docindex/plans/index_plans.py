"""Registered plans of the read paths that prepare something first: layouts, pages, families, history, block bounds, standing queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from docindex import fixtures as fx
from docindex.operators import aggs as A
from docindex.operators import history as H
from docindex.operators import mapping as M
from docindex.operators import search as S
from docindex.operators.colocate import Families
from docindex.operators.pages import KeysetScroll, deep_page
from docindex.plans.registry import register
from docindex.plans.views import DOCS, LINES, OPS, ORDERS, with_
from docindex.plans.write_plans import replay_sql_ctes
from docindex.session import scratch_path
from docindex.sources import postings, store
from docindex.streaming import percolate as P


def _orders_store(spark, sf):
    root = scratch_path(spark, "store")
    store.write_index(fx.orders_index(spark, sf), root, n_shards=fx.ORDER_SHARDS)
    return store.read_index(spark, root)


# ------------------------------------------------------------------ R1 / R2 point reads
@register("r1_get_bloom", with_(ORDERS) + "SELECT * FROM orders_ix WHERE _id = (SELECT CAST(max(l_orderkey) AS VARCHAR) FROM lineitem)")
def r1_get_bloom(spark, sf):
    """One order by id, from one shard's row groups that can hold it."""
    wanted = fx.table(spark, sf, "lineitem").agg(F.max("l_orderkey")).first()[0]
    return S.get_doc(_orders_store(spark, sf), "orders", str(wanted), n_shards=fx.ORDER_SHARDS)


_SUPPLIER_KEYS = "k AS (SELECT CAST(s_suppkey AS BIGINT) AS pos, 'orders' AS _index, CAST(s_suppkey * 7 AS VARCHAR) AS _id FROM supplier)"


@register("r2_mget_bloom", with_(ORDERS, _SUPPLIER_KEYS) + """
SELECT k.pos, k._index, k._id, o._id IS NOT NULL AS found, o.* EXCLUDE (_index, _id) FROM k LEFT JOIN orders_ix o ON o._index = k._index AND o._id = k._id""")
def r2_mget_bloom(spark, sf):
    """As many orders as there are suppliers, by ids that are pushed into the scan; some are missing."""
    keys = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("long").alias("pos"), F.lit("orders").alias("_index"),
                                                  (F.col("s_suppkey") * 7).cast("string").alias("_id"))
    return S.mget(_orders_store(spark, sf), keys, push=True)


# ------------------------------------------------------------------ R5 / R9 deep pages
_LINE_ORDER = [("l_shipdate", False), ("l_orderkey", True), ("l_linenumber", True), ("l_partkey", True), ("l_quantity", True)]
_LINE_SQL = "l_shipdate DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_quantity"


@register("r5_deep_select", with_(LINES) + f"""
SELECT * FROM lines_ix WHERE NOT _deleted ORDER BY {_LINE_SQL} LIMIT 500 OFFSET (SELECT count(*) * 2 // 3 FROM lineitem)""")
def r5_deep_select(spark, sf):
    """A page two thirds down the line items, by counted key ranges."""
    lines = S.live(fx.lineitem_children(spark, sf))
    n = lines.count()
    return deep_page(lines, _LINE_ORDER, n * 2 // 3, 500, total=n)


@register("r9_keyset_scroll", with_(DOCS) + """
SELECT * EXCLUDE (rn, n), CAST((rn - 1) // greatest(1, n // 7) AS INTEGER) AS page FROM (
  SELECT *, row_number() OVER (ORDER BY lang DESC NULLS LAST, source, _id) AS rn, count(*) OVER () AS n FROM docs WHERE NOT _deleted)""")
def r9_keyset_scroll(spark, sf):
    """All documents in pages of a seventh, each read from its cursor; language and source tie many times."""
    docs = S.live(fx.docs(spark, sf))
    scroll = KeysetScroll.of(docs, [("lang", False), ("source", True), ("_id", True)])
    size = max(1, sum(n for _, n in scroll.counts) // 7)
    pages = [p.withColumn("page", F.lit(k)) for k, p in enumerate(scroll.pages(size))]
    return reduce(lambda a, b: a.unionByName(b), pages)


# ------------------------------------------------------------------ R12 families
_FAMILY_SQL = with_(ORDERS, LINES) + """
SELECT c.*, p._index AS parent_index, p._id AS parent_id, p._version AS parent_version,
       p.o_orderkey AS parent_o_orderkey, p.o_custkey AS parent_o_custkey,
       p.o_orderstatus AS parent_o_orderstatus, p.o_totalprice AS parent_o_totalprice,
       p.o_orderdate AS parent_o_orderdate, p.o_orderpriority AS parent_o_orderpriority
FROM lines_ix c JOIN orders_ix p ON c._parent = p._id WHERE NOT c._deleted AND NOT p._deleted"""


def _families(spark, sf):
    return Families.of(fx.orders_index(spark, sf), fx.lineitem_children(spark, sf), parent_index="orders")


@register("r12_colocated", _FAMILY_SQL)
def r12_colocated(spark, sf):
    """Children with their parents from bucketed tables: no exchange."""
    return _families(spark, sf).join()


@register("r12_colocated_has_no_child", with_(ORDERS, LINES) + """
SELECT * FROM orders_ix p WHERE NOT _deleted
  AND NOT EXISTS (SELECT 1 FROM lines_ix c WHERE c._parent = p._id AND NOT c._deleted AND c.l_quantity > 45)""")
def r12_colocated_has_no_child(spark, sf):
    return _families(spark, sf).parents_with(F.col("l_quantity") > 45, without=True)


# ------------------------------------------------------------------ R13 as-of reads
_CUTS = """cuts AS (SELECT unnest([n // 4, n // 2, n]) AS cut FROM (SELECT count(*) AS n FROM events)),
cops AS (SELECT cut || '/' || _index AS _index, _id, seq, op, value, props FROM ops, cuts WHERE seq <= cut)"""


@register("r13_as_of", with_(OPS, _CUTS) + replay_sql_ctes(source="cops") + """
SELECT CAST(split_part(_index, '/', 1) AS BIGINT) AS cut, split_part(_index, '/', 2) AS _index, _id, _version, value, props FROM final WHERE NOT _deleted""")
def r13_as_of(spark, sf):
    """One table of states, read at a quarter, the half and the end of the log."""
    n = fx.ops_count(spark, sf)
    states = H.history(None, fx.ops(spark, sf), chunk_rows=1_000)
    cuts = [H.as_of(states, c).withColumn("cut", F.lit(c).cast("long")) for c in (n // 4, n // 2, n)]
    return reduce(lambda a, b: a.unionByName(b), cuts).select("cut", "_index", "_id", "_version", "value", "props")


@register("r13_history", with_(OPS) + replay_sql_ctes() + """,
ok AS (SELECT *, lead(seq) OVER (PARTITION BY _index, _id ORDER BY seq) AS nxt FROM rc WHERE ok)
SELECT _index, _id, CAST(ver AS BIGINT) AS _version, op = 'delete' AS _deleted, seq AS valid_from, nxt AS valid_to FROM ok""")
def r13_history(spark, sf):
    """All states of the log with the positions in which each holds."""
    states = H.history(None, fx.ops(spark, sf), chunk_rows=700)
    return states.select("_index", "_id", "_version", "_deleted", "valid_from", "valid_to")


# ------------------------------------------------------------------ R10 top k
_TOP_TERMS = ["the", "house", "water"]


@register("r10_topk_blockmax", """
WITH t AS (SELECT 'docs_' || lang AS _index, CAST(doc_id AS VARCHAR) AS _id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n, sum(len(w)) AS l FROM t),
q AS (SELECT unnest(['the', 'house', 'water']) AS term),
h AS (SELECT _index, _id, len(w) AS dl, term, len(list_filter(w, lambda x: x = term)) AS tf FROM t, q),
df AS (SELECT term, count(*) FILTER (tf > 0) AS df FROM h GROUP BY term),
x AS (SELECT _index, _id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / (l / n)))) AS sc
      FROM h JOIN df USING (term), s WHERE tf > 0 GROUP BY _index, _id)
SELECT _index, _id, round(sc, 6) AS _score FROM x ORDER BY sc DESC, _index, _id LIMIT 25""")
def r10_topk_blockmax(spark, sf):
    """The 25 best documents of three terms (a top-k report), by block bounds over the written token table."""
    root = scratch_path(spark, "postings")
    postings.write_postings(fx.docs(spark, sf), "text", root)
    return postings.bm25_top(spark, root, _TOP_TERMS, 25).hits.select("_index", "_id", F.round("_score", 6).alias("_score"))


# ------------------------------------------------------------------ G1 many values
@register("g1_terms_exact_topk", """
SELECT l_partkey AS key, count(*) AS doc_count FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""")
def g1_terms_exact_topk(spark, sf):
    return A.terms_topk(fx.table(spark, sf, "lineitem"), "l_partkey", 50)


# ------------------------------------------------------------------ S4 standing queries
_STANDING_SQL = r"""tok AS (SELECT _index, _id, unnest(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))) AS term FROM docs WHERE NOT _deleted),
top AS (SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) AS rn FROM tok GROUP BY term QUALIFY rn <= 100)"""


def _standing(docs):
    """Fixture: the 100 tokens that most documents hold, each a standing query, and each with its successor as one more."""
    tokens = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), 0))).alias("term"))
    top = [r["term"] for r in tokens.groupBy("term").count().orderBy(F.desc("count"), "term").limit(100).collect()]
    rows = [(t, t) for t in top] + [(f"{a}+{b}", x) for a, b in zip(top, top[1:]) for x in (a, b)]
    return docs.sparkSession.createDataFrame(rows, "query string, term string")


@register("s4_percolate", with_(DOCS, _STANDING_SQL) + """
SELECT t.term AS query, _index, _id FROM tok t JOIN top USING (term)
UNION ALL SELECT a.term || '+' || b.term, x._index, x._id FROM top a JOIN top b ON b.rn = a.rn + 1
  JOIN tok x ON x.term = a.term JOIN tok y ON y.term = b.term AND y._index = x._index AND y._id = x._id""")
def s4_percolate(spark, sf):
    """199 standing queries over the documents as a stream of two micro-batches; the source is read once."""
    out = scratch_path(spark, "hits")
    P.percolate_stream(fx.docs_stream(spark, sf), _standing(fx.docs(spark, sf)), "text", out, scratch_path(spark, "ckpt")).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


# ------------------------------------------------------------------ M1 nested misfits
# Fixture: bodies with objects and arrays, made of the events' columns; a field misfits when its number does not divide.
_NESTED_MAPPING = {"properties": {
    "user": {"properties": {"id": {"type": "long"}, "score": {"type": "double"}, "seen": {"type": "date", "format": "yyyy-MM-dd"}}},
    "items": {"type": "nested", "properties": {"n": {"type": "long"}, "tag": {"type": "keyword"}}},
    "kind": {"type": "keyword"}}}


def _nested_docs(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    i = F.col("event_id")
    user = F.concat(F.lit('{"id":'), F.when(i % 5 == 0, F.lit('"abc"')).otherwise(F.col("user_id").cast("string")),
                    F.lit(',"score":'), F.when(i % 7 == 0, F.lit('"high"')).otherwise(F.lit("0.5")),
                    F.lit(',"seen":"'), F.when(i % 11 == 0, F.lit("yesterday")).otherwise(F.lit("2024-03-05")), F.lit('"}'))
    items = F.concat(F.lit('[{"n":1,"tag":"a"},'), F.when(i % 3 == 0, F.lit('{"n":"two"}')).otherwise(F.lit('{"n":2}')), F.lit(","),
                     F.when(i % 13 == 0, F.lit('"loose"')).otherwise(F.lit('{"tag":"b"}')), F.lit("]"))
    body = F.concat(F.lit('{"user":'), F.when(i % 17 == 0, F.lit('"text"')).otherwise(user), F.lit(',"items":'), items, F.lit(',"kind":"'), "event_type", F.lit('"}'))
    return ev.select("event_id", body.alias("json"))


@register("m1_rejects_nested", """
WITH e AS (SELECT event_id, event_id % 17 = 0 AS flat FROM events)
SELECT event_id, 'user' AS field, 'text' AS value FROM e WHERE flat
UNION ALL SELECT event_id, 'user.id', 'abc' FROM e WHERE NOT flat AND event_id % 5 = 0
UNION ALL SELECT event_id, 'user.score', 'high' FROM e WHERE NOT flat AND event_id % 7 = 0
UNION ALL SELECT event_id, 'user.seen', 'yesterday' FROM e WHERE NOT flat AND event_id % 11 = 0
UNION ALL SELECT event_id, 'items.n', 'two' FROM e WHERE event_id % 3 = 0
UNION ALL SELECT event_id, 'items', 'loose' FROM e WHERE event_id % 13 = 0""")
def m1_rejects_nested(spark, sf):
    return M.apply_mapping(_nested_docs(spark, sf), "json", _NESTED_MAPPING, ["event_id"]).rejects


@register("m1_apply_mapping_nested", """
SELECT event_id, event_type AS kind, CASE WHEN event_id % 17 <> 0 AND event_id % 5 <> 0 THEN CAST(user_id AS BIGINT) END AS user_id,
       CASE WHEN event_id % 17 <> 0 AND event_id % 7 <> 0 THEN 0.5::DOUBLE END AS score,
       CASE WHEN event_id % 17 <> 0 AND event_id % 11 <> 0 THEN DATE '2024-03-05' END AS seen,
       CAST(1 + CASE WHEN event_id % 3 = 0 THEN 0 ELSE 2 END AS BIGINT) AS n_sum, CAST(3 AS INTEGER) AS n_items
FROM events""")
def m1_apply_mapping_nested(spark, sf):
    """The typed side: fitting values of the same objects stay, dates inside objects are dates."""
    rows = M.apply_mapping(_nested_docs(spark, sf), "json", _NESTED_MAPPING, ["event_id"]).rows
    return rows.select("event_id", "kind", F.col("user.id").alias("user_id"), F.col("user.score").alias("score"), F.to_date("user.seen").alias("seen"),
                       F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["n"], F.lit(0).cast("long"))).alias("n_sum"),
                       F.size("items").alias("n_items"))
