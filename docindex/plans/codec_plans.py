"""Registered plans for sources, sinks and reply decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from docindex import fixtures as fx
from docindex.operators import search as S
from docindex.operators import write as W
from docindex.operators.rank import batch_numbers
from docindex.plans.registry import register
from docindex.plans.views import DOCS, OPS, with_
from docindex.plans.write_plans import ITEMS_SELECT, replay_sql_ctes
from docindex.sources import codec as C

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _json_docs(spark, sf):
    ev = fx.table(spark, sf, "events")
    return ev.select(F.col("event_id").alias("key"),
                     F.to_json(F.struct(*ev.columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("json"))


@register("i1_documents_as", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def i1_documents_as(spark, sf):
    return C.documents_as(_json_docs(spark, sf), "json", EVENTS_SCHEMA).rows


def _mixed(spark, sf):
    # Valid objects (events.props) and prose that is not JSON (conversation turns).
    ev = fx.table(spark, sf, "events").select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("key"),
                                              F.col("props").alias("body"))
    cv = fx.table(spark, sf, "conversations").select(
        F.concat_ws("-", F.lit("c"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("key"),
        F.col("text").alias("body"))
    return ev.unionByName(cv)


_MIXED_SQL = """m AS (SELECT 'e' || CAST(event_id AS VARCHAR) AS key, props AS body FROM events
            UNION ALL SELECT 'c-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), text FROM conversations)"""


@register("i1_documents_as_mixed", with_(_MIXED_SQL) + """
SELECT key, CAST(json_extract(body, '$.k') AS INTEGER) AS k FROM m
WHERE CASE WHEN json_valid(body) THEN json_type(body) END = 'OBJECT'""")
def i1_documents_as_mixed(spark, sf):
    return C.documents_as(_mixed(spark, sf), "body", "k int", keep=["key"]).rows


@register("i1_rejects", with_(_MIXED_SQL) + """
SELECT key, body FROM m WHERE COALESCE(CASE WHEN json_valid(body) THEN json_type(body) END, '') <> 'OBJECT'""")
def i1_rejects(spark, sf):
    return C.documents_as(_mixed(spark, sf), "body", "k int", keep=["key"]).rejects


@register("i2_bulk_encode", with_(OPS) + f""",
o AS (SELECT *, CAST((row_number() OVER (ORDER BY seq) - 1) // 10 AS BIGINT) AS batch_no FROM ops),
l AS (SELECT batch_no, seq, CAST(json_object(op, json_object('_index', _index, '_id', _id)) AS VARCHAR) AS a,
             CASE WHEN op <> 'delete' THEN CAST(json_object('value', value, 'props', props) AS VARCHAR) END AS b FROM o)
SELECT batch_no, count(*) AS ops,
       string_agg(CASE WHEN b IS NULL THEN a ELSE a || chr(10) || b END, chr(10) ORDER BY seq) || chr(10) AS payload
FROM l GROUP BY batch_no""")
def i2_bulk_encode(spark, sf):
    return C.bulk_encode(fx.ops(spark, sf), 10, ["value", "props"])


@register("i3_decode_bulk", with_(OPS) + replay_sql_ctes() + f""",
it AS ({ITEMS_SELECT}),
bt AS (SELECT *, CAST((row_number() OVER (ORDER BY seq) - 1) // 10 AS BIGINT) AS batch_no FROM it)
SELECT batch_no, 1 AS took, bool_or(status >= 300) OVER (PARTITION BY batch_no) AS errors,
       CAST(row_number() OVER (PARTITION BY batch_no ORDER BY seq) - 1 AS INTEGER) AS pos,
       op, _index, _id, _version, status, error_type, result FROM bt""")
def i3_decode_bulk(spark, sf):
    out = C.decode_bulk_responses(_bulk_replies(spark, sf), "reply", keep=["batch_no"])
    return out.drop("error_reason", "shards_total", "shards_successful", "shards_failed")


def _bulk_replies(spark, sf):
    """Replies to the whole log, ten ops each."""
    return fx.bulk_replies(batch_numbers(W.bulk_replay(None, fx.ops(spark, sf)).items, "seq", 10))


_TALK_SQL = "SELECT -conv_id * 100000 - turn - 1 AS key, text AS value FROM conversations WHERE text IS NOT NULL"


def _with_talk(spark, sf, replies, key):
    """Replies and, between them, conversation texts, which are none."""
    talk = fx.table(spark, sf, "conversations").select((-F.col("conv_id") * 100_000 - F.col("turn") - 1).alias("key"), F.col("text").alias("reply"))
    return replies.select(F.col(key).cast("long").alias("key"), "reply").unionByName(talk)


@register("i3_rejects", _TALK_SQL)
def i3_rejects(spark, sf):
    return C.reply_rejects(_with_talk(spark, sf, _bulk_replies(spark, sf), "batch_no"), "reply", "bulk", ["key"])


@register("i4_rejects", _TALK_SQL)
def i4_rejects(spark, sf):
    return C.reply_rejects(_with_talk(spark, sf, _search_replies(spark, sf), "page"), "reply", "search", ["key"])


@register("i6_rejects", _TALK_SQL)
def i6_rejects(spark, sf):
    return C.reply_rejects(_with_talk(spark, sf, _mget_replies(spark, sf), "reply_no"), "reply", "get", ["key"])


@register("i4_aggregations", with_(DOCS) + """
SELECT _index, CAST(row_number() OVER (PARTITION BY _index ORDER BY count(*) DESC, source) - 1 AS INTEGER) AS pos,
       source AS key, count(*) AS doc_count, 2 AS shards_total FROM docs WHERE NOT _deleted GROUP BY _index, source""")
def i4_aggregations(spark, sf):
    """Aggregations and shard counts of one search reply per index."""
    counts = S.match_all(fx.docs(spark, sf)).groupBy("_index", F.col("source").alias("key")).agg(F.count(F.lit(1)).alias("doc_count"))
    listed = counts.groupBy("_index").agg(F.array_sort(F.collect_list(F.struct((-F.col("doc_count")).alias("o"), "key", "doc_count"))).alias("b"))
    buckets = F.transform("b", lambda x: F.struct(x["key"].alias("key"), x["doc_count"].alias("doc_count")))
    reply = F.to_json(F.struct(F.struct(F.lit(2).alias("total"), F.lit(2).alias("successful")).alias("_shards"),
                               F.struct(F.struct(buckets.alias("buckets")).alias("sources")).alias("aggregations"),
                               F.struct(F.expr("CAST(array() AS array<struct<_id:string>>)").alias("hits")).alias("hits")))
    decoded = C.decode_search_responses(listed.select("_index", reply.alias("reply")).withColumnRenamed("_index", "ix"), "reply", keep=["ix"])
    return C.aggregation_buckets(decoded, "sources", keep=["ix", "shards_total"]).withColumnRenamed("ix", "_index")


def _search_replies(spark, sf):
    docs = S.match_all(fx.docs(spark, sf))
    total = docs.count()  # one number, as the server reports it in every page
    pages = S.scroll(docs, 10)
    hit = F.struct("_index", "_id", F.lit(None).cast("double").alias("_score"),
                   F.struct("lang", "source", "n_chars").alias("_source"))
    g = pages.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("rank", hit.alias("h")))).alias("_hs"))
    hits = F.transform("_hs", lambda x: x["h"])
    gen7 = F.struct(F.struct(F.lit(total).alias("value"), F.lit("eq").alias("relation")).alias("total"),
                   F.lit(None).cast("double").alias("max_score"), hits.alias("hits"))
    gen6 = F.struct(F.lit(total).alias("total"), F.lit(None).cast("double").alias("max_score"), hits.alias("hits"))

    def reply(h):
        return F.to_json(F.struct(F.lit(1).alias("took"), F.lit(False).alias("timed_out"),
                                  F.concat(F.lit("page-"), F.col("page").cast("string")).alias("_scroll_id"),
                                  h.alias("hits")))

    return g.select("page", F.when(F.col("page") % 2 == 0, reply(gen7)).otherwise(reply(gen6)).alias("reply"))


_I4_SQL = with_(DOCS) + """,
r AS (SELECT *, row_number() OVER (ORDER BY _index, _id) AS rn FROM docs WHERE NOT _deleted)
SELECT CAST((rn - 1) // 10 AS BIGINT) AS page, 1 AS took, FALSE AS timed_out,
       (SELECT count(*) FROM docs WHERE NOT _deleted) AS total, 'eq' AS relation, CAST(NULL AS DOUBLE) AS max_score,
       'page-' || CAST((rn - 1) // 10 AS VARCHAR) AS scroll_id, CAST((rn - 1) % 10 AS INTEGER) AS pos,
       _index, _id, CAST(NULL AS DOUBLE) AS _score, {cols} FROM r"""


@register("i4_decode_search", _I4_SQL.format(cols="lang, source, n_chars"))
def i4_decode_search(spark, sf):
    hits = C.decode_search_responses(_search_replies(spark, sf), "reply", keep=["page"])
    hits = hits.drop("_type", "aggregations", "shards_total", "shards_successful", "shards_failed")
    return C.hits_as(hits, "lang string, source string, n_chars bigint")


@register("i5_hits_as", with_(DOCS) + """,
r AS (SELECT *, row_number() OVER (ORDER BY _index, _id) AS rn FROM docs WHERE NOT _deleted)
SELECT CAST((rn - 1) // 10 AS BIGINT) AS page, CAST((rn - 1) % 10 AS INTEGER) AS pos, n_chars, lang FROM r""")
def i5_hits_as(spark, sf):
    hits = C.decode_search_responses(_search_replies(spark, sf), "reply", keep=["page"])
    return C.hits_as(hits.select("page", "pos", "_source"), "n_chars bigint, lang string")


def _mget_replies(spark, sf):
    found = S.mget(fx.docs(spark, sf), fx.mget_keys_from_labels(spark, sf))
    numbered = batch_numbers(found, "pos", 50, out_col="reply_no")
    doc = F.when(F.col("found"), F.struct("_index", "_id", "_version", F.col("found"),
                                          F.struct("lang", "n_chars").alias("_source"))) \
        .otherwise(F.struct("_index", "_id", F.lit(None).cast("long").alias("_version"), F.col("found"),
                            F.lit(None).cast("struct<lang:string,n_chars:bigint>").alias("_source")))
    g = numbered.groupBy("reply_no").agg(F.array_sort(F.collect_list(F.struct("pos", doc.alias("d")))).alias("_ds"))
    return g.select("reply_no", F.to_json(F.struct(F.transform("_ds", lambda x: x["d"]).alias("docs"))).alias("reply"))


@register("i6_decode_get", with_(DOCS) + """,
k AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM labels)
SELECT CAST((k.rn - 1) // 50 AS BIGINT) AS reply_no, CAST((k.rn - 1) % 50 AS INTEGER) AS pos,
       'docs_en' AS _index, CAST(k.doc_id AS VARCHAR) AS _id, d._version, d._id IS NOT NULL AS found,
       d.lang, d.n_chars
FROM k LEFT JOIN (SELECT * FROM docs WHERE NOT _deleted) d ON d._index = 'docs_en' AND d._id = CAST(k.doc_id AS VARCHAR)""")
def i6_decode_get(spark, sf):
    return C.decode_get_responses(_mget_replies(spark, sf), "reply", "lang string, n_chars bigint", keep=["reply_no"])


def _shard_replies(spark, sf):
    d = fx.docs(spark, sf)
    failed = F.col("n_chars") > 10000
    fail_list = F.when(failed, F.array(F.struct(F.col("shard"), F.col("_index").alias("index"),
                                                F.lit("replica unavailable").alias("reason"))))
    sh = F.struct(F.lit(2).alias("total"), F.when(failed, 1).otherwise(2).alias("successful"),
                  F.when(failed, 1).otherwise(0).alias("failed"), fail_list.alias("failures"))
    return d.select(F.to_json(F.struct(F.col("_index"), sh.alias("_shards"))).alias("reply"))


@register("i7_shard_summary", with_(DOCS) + """
SELECT _index, CAST(2 * count(*) AS BIGINT) AS total,
       CAST(sum(CASE WHEN n_chars > 10000 THEN 1 ELSE 2 END) AS BIGINT) AS successful,
       CAST(sum(CASE WHEN n_chars > 10000 THEN 1 ELSE 0 END) AS BIGINT) AS failed,
       CAST(sum(CASE WHEN n_chars > 10000 THEN 1 ELSE 0 END) AS BIGINT) AS failures
FROM docs GROUP BY _index""")
def i7_shard_summary(spark, sf):
    totals, _failures = C.shard_summary(_shard_replies(spark, sf), "reply")
    return totals


@register("i7_shard_failures", with_(DOCS) + """
SELECT _index, shard, 'replica unavailable' AS reason FROM docs WHERE n_chars > 10000""")
def i7_shard_failures(spark, sf):
    _totals, failures = C.shard_summary(_shard_replies(spark, sf), "reply")
    return failures


_SHARDS_OF_BULK = with_(OPS) + replay_sql_ctes() + f""",
it AS ({ITEMS_SELECT}),
bt AS (SELECT *, (row_number() OVER (ORDER BY seq) - 1) // 100 AS batch_no, CAST(('0x' || substr(md5(_id), 1, 8)) AS BIGINT) % 4 AS shard FROM it),
sh AS (SELECT batch_no, _index, shard, arg_min(COALESCE(error_type, result), seq) FILTER (status >= 300) AS reason FROM bt GROUP BY ALL)
"""


def _bulk_shard_replies(spark, sf):
    """What the shards answer to the whole log, a hundred ops a batch: from the replay's own item results."""
    items = W.bulk_replay(None, fx.ops(spark, sf)).items
    return C.encode_shards(batch_numbers(items, "seq", 100), 4)


@register("i7_shard_summary_bulk", _SHARDS_OF_BULK + """
SELECT _index, CAST(count(*) AS BIGINT) AS total, CAST(count(*) - count(reason) AS BIGINT) AS successful, CAST(count(reason) AS BIGINT) AS failed,
       CAST(count(reason) AS BIGINT) AS failures FROM sh GROUP BY _index""")
def i7_shard_summary_bulk(spark, sf):
    return C.shard_summary(_bulk_shard_replies(spark, sf), "reply")[0]


@register("i7_shard_failures_bulk", _SHARDS_OF_BULK + "SELECT _index, CAST(shard AS INTEGER) AS shard, reason FROM sh WHERE reason IS NOT NULL")
def i7_shard_failures_bulk(spark, sf):
    return C.shard_summary(_bulk_shard_replies(spark, sf), "reply")[1]


@register("u1_map_documents", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def u1_map_documents(spark, sf):
    ev = fx.table(spark, sf, "events").select("event_id", "props")
    return C.map_documents(ev, "props", "k long", {"k": lambda doc: doc["k"]}, keep=["event_id"])


@register("u1_map_encode", """
SELECT event_id, '{"half":' || CAST(CAST(json_extract(props, '$.k') AS BIGINT) // 2 AS VARCHAR) || ',"kind":"' ||
  CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) % 2 = 0 THEN 'even' ELSE 'odd' END || '"}' AS body FROM events""")
def u1_map_encode(spark, sf):
    """Bodies decoded, two fields made of each, and encoded again."""
    ev = fx.table(spark, sf, "events").select("event_id", "props")
    made = {"half": lambda doc: F.expr("doc.k div 2"), "kind": lambda doc: F.when(doc["k"] % 2 == 0, "even").otherwise("odd")}
    return C.map_documents(ev, "props", "k long", made, keep=["event_id"], body="body")
