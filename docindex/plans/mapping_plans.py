"""Registered plans for schema operations (M1-M7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docindex import fixtures as fx
from docindex.operators import mapping as M
from docindex.plans.registry import register
from docindex.plans.views import DOCS, with_

# The date format (weekday, month, day, time, zone, week-year) and the ``te*`` pattern below are the ones
# that a template test pins.
EVENT_MAPPING = {"properties": {
    "event_id": {"type": "long"}, "user_id": {"type": "long"}, "event_type": {"type": "keyword"},
    "value": {"type": "double"}, "props": {"type": "text"},
    "created_at": {"type": "date", "format": "EEE MMM dd HH:mm:ss Z YYYY"},
    "k": {"type": "long"},
}}


def _event_json(spark, sf):
    # Fixture: error events carry a malformed date, view events a non-numeric k.
    ev = fx.table(spark, sf, "events")
    created = F.when(F.col("event_type") == "error", F.lit("not a date")).otherwise(
        F.concat(F.date_format("ts", "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format("ts", "yyyy")))
    k = F.when(F.col("event_type") == "view", F.concat(F.lit("n"), F.col("user_id").cast("string"))) \
        .otherwise(F.col("user_id").cast("string"))
    body = F.to_json(F.struct("event_id", "user_id", "event_type", "value", "props",
                              created.alias("created_at"), F.lit("__K__").alias("k")))
    # k goes in as a JSON number or string as the data has it.
    body = F.when(F.col("event_type") == "view",
                  F.regexp_replace(body, '"__K__"', F.concat(F.lit('"'), k, F.lit('"')))) \
        .otherwise(F.regexp_replace(body, '"__K__"', k))
    return ev.select(F.col("event_id").alias("key"), body.alias("json"))


@register("m1_apply_mapping", """
SELECT event_id AS key, event_id, user_id, event_type, value, props,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(epoch(date_trunc('second', ts)) AS BIGINT) END AS created_epoch,
       CASE WHEN event_type = 'view' THEN NULL ELSE user_id END AS k
FROM events""")
def m1_apply_mapping(spark, sf):
    mapped = M.apply_mapping(_event_json(spark, sf), "json", EVENT_MAPPING, keep=["key"])
    return mapped.rows.select("key", "event_id", "user_id", "event_type", "value", "props",
                              F.unix_timestamp("created_at").alias("created_epoch"), "k")


@register("m1_rejects", """
SELECT event_id AS key, 'created_at' AS field, 'not a date' AS value FROM events WHERE event_type = 'error'
UNION ALL
SELECT event_id, 'k', 'n' || CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'view'""")
def m1_rejects(spark, sf):
    return M.apply_mapping(_event_json(spark, sf), "json", EVENT_MAPPING, keep=["key"]).rejects


def _inv_sql():
    parts = [("event_id", "long"), ("ts", "text"), ("user_id", "long"), ("event_type", "text"),
             ("value", "double"), ("props", "text")]
    sql = " UNION ALL ".join(f"SELECT '{f}' AS field, '{t}' AS type, count({f}) AS docs FROM events" for f, t in parts)
    return sql + " UNION ALL SELECT 'k', 'long', count(*) FROM events"


@register("m1_date_formats", """
SELECT o_orderkey AS key, CAST(epoch(CAST(o_orderdate AS TIMESTAMP)) AS BIGINT) AS at FROM orders""")
def m1_date_formats(spark, sf):
    """Each order's date in one of three formats that the mapping lists."""
    o = fx.table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("timestamp")
    text = (F.when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "dd/MM/yyyy")).when(F.col("o_orderkey") % 3 == 1, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
            .otherwise((F.unix_timestamp(day) * 1000).cast("string")))
    docs = o.select(F.col("o_orderkey").alias("key"), F.to_json(F.struct(text.alias("at"))).alias("json"))
    mapping = {"properties": {"at": {"type": "date", "format": "dd/MM/yyyy||yyyy-MM-dd'T'HH:mm:ss||epoch_millis"}}}
    return M.apply_mapping(docs, "json", mapping, keep=["key"]).rows.select("key", F.unix_timestamp("at").alias("at"))


def _mixed_json(spark, sf):
    """Event documents and, between them, conversation texts, which are no JSON."""
    talk = fx.table(spark, sf, "conversations").select((-F.col("conv_id") * 100_000 - F.col("turn") - 1).alias("key"), F.col("text").alias("json"))
    return _event_json(spark, sf).unionByName(talk)


@register("m1_rejects_malformed", """
SELECT event_id AS key, 'created_at' AS field, 'not a date' AS value FROM events WHERE event_type = 'error'
UNION ALL SELECT event_id, 'k', 'n' || CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'view'
UNION ALL SELECT -conv_id * 100000 - turn - 1, '_source', text FROM conversations WHERE text IS NOT NULL""")
def m1_rejects_malformed(spark, sf):
    return M.apply_mapping(_mixed_json(spark, sf), "json", EVENT_MAPPING, keep=["key"]).rejects


@register("m2_rejects", "SELECT -conv_id * 100000 - turn - 1 AS key, text AS value FROM conversations WHERE text IS NOT NULL")
def m2_rejects(spark, sf):
    return M.infer_rejects(_mixed_json(spark, sf), "json", ["key"])


def _deep_sql():
    levels = [("a", "object"), ("a.b", "object"), ("a.b.c", "object"), ("a.b.c.d", "object"), ("a.b.c.d.e", "object"), ("a.b.c.d.e.f", "long"),
              ("lines", "array"), ("lines[]", "object"), ("lines[].nr", "long"), ("lines[].tags", "array"), ("lines[].tags[]", "text")]
    return " UNION ALL ".join(f"SELECT '{f}' AS field, '{t}' AS type, count(*) AS docs FROM orders" for f, t in levels)


@register("m2_infer_mapping_deep", _deep_sql())
def m2_infer_mapping_deep(spark, sf):
    """Orders as documents of six levels, with arrays of objects that hold arrays."""
    o = fx.table(spark, sf, "orders")
    deep = F.col("o_orderkey").alias("f")
    for name in "edcba":
        deep = F.struct(deep).alias(name)
    line = lambda nr: F.struct(F.lit(nr).alias("nr"), F.array(F.col("o_orderpriority"), F.lit("x")).alias("tags"))
    return M.infer_mapping(o.select(F.to_json(F.struct(deep, F.array(line(1), line(2)).alias("lines"))).alias("j")), "j")


@register("m2_infer_mapping", _inv_sql())
def m2_infer_mapping(spark, sf):
    ev = fx.table(spark, sf, "events")
    docs = ev.select(F.to_json(F.struct(*ev.columns)).alias("j")).unionByName(ev.select(F.col("props").alias("j")))
    return M.infer_mapping(docs, "j")


def _generations(spark, sf):
    d = fx.docs(spark, sf)
    old = d.where(F.col("lang").isin("en", "fr")).select("_index", "_id", "lang", "n_chars")
    new = d.where(F.col("lang").isin("de", "es")).select(
        "_index", "_id", "lang", F.col("n_chars").cast("string").alias("n_chars"), "source")
    return old, new


@register("m3_evolve_update_all_types", with_(DOCS) + """
SELECT _index, _id, lang, CAST(n_chars AS VARCHAR) AS n_chars, CAST(NULL AS VARCHAR) AS source FROM docs WHERE lang IN ('en', 'fr')
UNION ALL SELECT _index, _id, lang, CAST(n_chars AS VARCHAR), source FROM docs WHERE lang IN ('de', 'es')""")
def m3_evolve_update_all_types(spark, sf):
    old, new = _generations(spark, sf)
    ch = M.evolve_mapping(old.schema, new.schema, update_all_types=True)
    return M.evolve_data(old, new, ch, keep=["_index", "_id"])


@register("m3_evolve_refused", with_(DOCS) + """
SELECT _index, _id, lang, n_chars FROM docs WHERE lang IN ('en', 'fr')
UNION ALL SELECT _index, _id, lang, n_chars FROM docs WHERE lang IN ('de', 'es')""")
def m3_evolve_refused(spark, sf):
    old, new = _generations(spark, sf)
    ch = M.evolve_mapping(old.schema, new.schema, update_all_types=False)
    return M.evolve_data(old, new, ch, keep=["_index", "_id"])


def _nested_generations(spark, sf):
    d = fx.docs(spark, sf)
    old = d.where(F.col("lang").isin("en", "fr")).select("_id", F.struct("lang", F.col("source").alias("size")).alias("u"))
    new = d.where(F.col("lang").isin("de", "es")).select("_id", F.struct(F.col("n_chars").alias("size"), F.col("source").alias("from")).alias("u"))
    return old, new, M.evolve_mapping(old.schema, new.schema, update_all_types=True)


@register("m3_evolve_nested", with_(DOCS) + """
SELECT _id, lang, CAST(NULL AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS origin FROM docs WHERE lang IN ('en', 'fr')
UNION ALL SELECT _id, NULL, n_chars, source FROM docs WHERE lang IN ('de', 'es')""")
def m3_evolve_nested(spark, sf):
    old, new, change = _nested_generations(spark, sf)
    return M.evolve_data(old, new, change, ["_id"]).select("_id", "u.lang", "u.size", F.col("u.from").alias("origin"))


@register("m3_rejects", with_(DOCS) + "SELECT _id, 'u.size' AS field, source AS value FROM docs WHERE lang IN ('en', 'fr') AND source IS NOT NULL")
def m3_rejects(spark, sf):
    old, _new, change = _nested_generations(spark, sf)
    return M.rewrite_rejects(old, change.schema, ["_id"])


@register("m4_field_inventory", with_(DOCS) + """
SELECT _index, 'text' AS field, 'string' AS type, count(*) AS docs, count(text) AS non_null FROM docs WHERE NOT _deleted GROUP BY _index
UNION ALL SELECT _index, 'lang', 'string', count(*), count(lang) FROM docs WHERE NOT _deleted GROUP BY _index
UNION ALL SELECT _index, 'source', 'string', count(*), count(source) FROM docs WHERE NOT _deleted GROUP BY _index
UNION ALL SELECT _index, 'n_chars', 'bigint', count(*), count(n_chars) FROM docs WHERE NOT _deleted GROUP BY _index""")
def m4_field_inventory(spark, sf):
    return M.field_inventory(fx.docs(spark, sf))


TEMPLATES = [
    {"name": "docs_all", "index_patterns": ["docs_*"], "order": 0},
    {"name": "docs_e", "index_patterns": ["docs_e*"], "order": 1},
    {"name": "te", "index_patterns": ["te*"], "order": 0},
]


@register("m5_apply_templates", with_(DOCS) + """,
t(name, pat, ord) AS (VALUES ('docs_all', 'docs_*', 0), ('docs_e', 'docs_e*', 1), ('te', 'te*', 0)),
m AS (SELECT d._index, d._id, t.name, t.ord,
             row_number() OVER (PARTITION BY d._index, d._id ORDER BY t.ord DESC, t.name DESC) AS rn
      FROM docs d JOIN t ON d._index GLOB t.pat)
SELECT d._index, d._id, d.lang, m.name AS _template, m.ord AS _template_order
FROM docs d LEFT JOIN m ON m._index = d._index AND m._id = d._id AND m.rn = 1""")
def m5_apply_templates(spark, sf):
    d = fx.docs(spark, sf).select("_index", "_id", "lang")
    return M.apply_templates(d, TEMPLATES)


ALIAS_ACTIONS = [(1, "add", "docs_en", "english"), (2, "add", "docs_fr", "romance"),
                 (3, "add", "docs_es", "romance"), (4, "add", "docs_de", "german"),
                 (5, "remove", "docs_fr", "romance"), (6, "add", "docs_fr", "french")]


@register("m6_expand_aliases", with_(DOCS) + """,
a(seq, action, idx, alias) AS (VALUES (1, 'add', 'docs_en', 'english'), (2, 'add', 'docs_fr', 'romance'),
    (3, 'add', 'docs_es', 'romance'), (4, 'add', 'docs_de', 'german'), (5, 'remove', 'docs_fr', 'romance'),
    (6, 'add', 'docs_fr', 'french')),
l AS (SELECT idx, alias FROM (SELECT *, row_number() OVER (PARTITION BY idx, alias ORDER BY seq DESC) AS rn FROM a)
      WHERE rn = 1 AND action = 'add')
SELECT d._index, d._id, d.lang, l.alias AS _alias FROM docs d JOIN l ON l.idx = d._index""")
def m6_expand_aliases(spark, sf):
    actions = spark.createDataFrame(ALIAS_ACTIONS, "seq int, action string, index string, alias string")
    d = fx.docs(spark, sf).select("_index", "_id", "lang")
    return M.expand_aliases(d, actions)


@register("m7_drop_source", "SELECT doc_id AS key, lang, source, n_chars FROM documents")
def m7_drop_source(spark, sf):
    docs = fx.table(spark, sf, "documents")
    js = docs.select(F.col("doc_id").alias("key"), F.to_json(F.struct("doc_id", "lang", "source", "n_chars")).alias("j"))
    mapping = {"_source": {"enabled": False},
               "properties": {"lang": {"type": "keyword"}, "source": {"type": "keyword"}, "n_chars": {"type": "long"}}}
    return M.apply_mapping(js, "j", mapping, keep=["key"], drop_source=True).rows


# Templates of three orders for indices named after the event type: a higher order types a field anew.
FIELD_TEMPLATES = [
    {"name": "all", "index_patterns": ["ev_*"], "order": 0, "mappings": {"properties": {"event_id": {"type": "long"}, "user_id": {"type": "keyword"}}}},
    {"name": "c", "index_patterns": ["ev_c*", "ev_p*"], "order": 1, "mappings": {"properties": {"value": {"type": "double"}}}},
    {"name": "view", "index_patterns": ["*_view"], "order": 2, "mappings": {"properties": {"k": {"type": "long"}}}},
    {"name": "view_low", "index_patterns": ["*_view"], "order": 1, "mappings": {"properties": {"k": {"type": "keyword"}}}},
]


def _typed_events(spark, sf):
    docs = _event_json(spark, sf).withColumn("_index", F.concat(F.lit("ev_"), F.get_json_object("json", "$.event_type")))
    return M.apply_template_mappings(docs, "json", FIELD_TEMPLATES)


@register("m5_template_mappings", """
SELECT 'ev_' || event_type AS _index, CAST(event_id AS BIGINT) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
       CASE WHEN event_type LIKE 'c%' OR event_type LIKE 'p%' THEN value END AS value, CAST(NULL AS BIGINT) AS k FROM events""")
def m5_template_mappings(spark, sf):
    """Documents cast by the merged mapping of their index; the numbers that a view event has for k do not fit."""
    return _typed_events(spark, sf).rows.select("_index", "event_id", "user_id", "value", "k")


@register("m5_template_rejects", """
SELECT 'ev_view' AS _index, 'k' AS field, 'n' || CAST(user_id AS VARCHAR) AS value FROM events WHERE event_type = 'view'""")
def m5_template_rejects(spark, sf):
    return _typed_events(spark, sf).rejects
