"""Registered plans for writes and bulk."""

from __future__ import annotations

from pyspark.sql import functions as F

from docindex import fixtures as fx
from docindex.functions.route import route
from docindex.operators import write as W
from docindex.operators.rank import batch_numbers
from docindex.plans.registry import register
from docindex.plans.views import CUT, DOCS, OPS, with_


def replay_sql_ctes(where: str = "TRUE", source: str = "ops") -> str:
    """Oracle replay: the same per-key semantics as plain windows over the whole log."""
    return r""",
log AS (SELECT *, CASE WHEN op IN ('index', 'create') THEN TRUE WHEN op = 'delete' THEN FALSE END AS eff
        FROM """ + source + " WHERE " + where + r"""),
ra AS (SELECT *, COALESCE(last_value(eff IGNORE NULLS) OVER (PARTITION BY _index, _id ORDER BY seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS exb FROM log),
rb AS (SELECT *, CASE op WHEN 'index' THEN TRUE WHEN 'create' THEN NOT exb ELSE exb END AS ok FROM ra),
rc AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER w AS ver,
              sum(CASE WHEN op IN ('index', 'delete') OR (op = 'create' AND ok) THEN 1 ELSE 0 END) OVER w AS seg,
              ok AND op IN ('index', 'create', 'update') AS contrib
       FROM rb WINDOW w AS (PARTITION BY _index, _id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rf AS (SELECT _index, _id, seq, ver, COALESCE(eff, exb) AS exa,
              last_value(CASE WHEN contrib THEN value END IGNORE NULLS) OVER s AS fv,
              last_value(CASE WHEN contrib THEN props END IGNORE NULLS) OVER s AS fp,
              max(CASE WHEN ok THEN seq END) OVER (PARTITION BY _index, _id) AS lastok,
              row_number() OVER (PARTITION BY _index, _id ORDER BY seq DESC) AS rn
       FROM rc WINDOW s AS (PARTITION BY _index, _id, seg ORDER BY seq
                            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
final AS (SELECT _index, _id, CAST(ver AS BIGINT) AS _version, NOT exa AS _deleted, CAST(lastok AS BIGINT) AS _seq,
                 CASE WHEN exa THEN fv END AS value, CASE WHEN exa THEN fp END AS props
          FROM rf WHERE rn = 1 AND ver > 0)
"""


ITEMS_SELECT = """
SELECT seq, op, _index, _id, CASE WHEN ok THEN CAST(ver AS BIGINT) END AS _version,
       CAST(CASE op WHEN 'index' THEN CASE WHEN exb THEN 200 ELSE 201 END
                    WHEN 'create' THEN CASE WHEN ok THEN 201 ELSE 409 END
                    ELSE CASE WHEN ok THEN 200 ELSE 404 END END AS INTEGER) AS status,
       CASE op WHEN 'index' THEN CASE WHEN exb THEN 'updated' ELSE 'created' END
               WHEN 'create' THEN CASE WHEN ok THEN 'created' END
               WHEN 'update' THEN CASE WHEN ok THEN 'updated' END
               ELSE CASE WHEN ok THEN 'deleted' ELSE 'not_found' END END AS result,
       CASE WHEN op = 'create' AND NOT ok THEN 'version_conflict_engine_exception'
            WHEN op = 'update' AND NOT ok THEN 'document_missing_exception' END AS error_type
FROM rc"""


def _stored(spark, sf):
    """(stored table = first half replayed, second half of the log)."""
    _first, second = fx.ops_halves(spark, sf)
    return fx.stored(spark, sf), second


@register("w8_bulk_replay", with_(OPS) + replay_sql_ctes() + "SELECT * FROM final")
def w8_bulk_replay(spark, sf):
    stored, second = _stored(spark, sf)
    return W.bulk_replay(stored, second).table


@register("w8_bulk_replay_single_pass", with_(OPS) + replay_sql_ctes() + "SELECT * FROM final")
def w8_bulk_replay_single_pass(spark, sf):
    # The whole log from an empty index in one pass must equal the two-step replay.
    return W.bulk_replay(None, fx.ops(spark, sf)).table


@register("w9_bulk_items", with_(OPS) + replay_sql_ctes() + ITEMS_SELECT + f" WHERE seq > {CUT}")
def w9_bulk_items(spark, sf):
    stored, second = _stored(spark, sf)
    return W.bulk_replay(stored, second).items


@register("r13_visible_at", with_(OPS) + replay_sql_ctes(f"seq <= {CUT}") + """
SELECT _index, _id, _version, _deleted, _seq, value, props FROM final WHERE NOT _deleted AND value > 50""")
def r13_visible_at(spark, sf):
    # A search sees the state as of the last refresh (seq <= cut); later writes are invisible.
    return visible_at(fx.ops(spark, sf), fx.ops_count(spark, sf) // 2).where(F.col("value") > 50)


visible_at = W.visible_at


@register("w1_index_docs", with_(OPS) + """
SELECT _index, _id, CAST(count(*) AS BIGINT) AS _version, FALSE AS _deleted, max(seq) AS _seq,
       arg_max(value, seq) AS value, arg_max(props, seq) AS props
FROM ops GROUP BY _index, _id""")
def w1_index_docs(spark, sf):
    delta = fx.ops(spark, sf).drop("op")
    return W.index_docs(None, delta).table


_FIRST_INDEXED = f"""idx AS (SELECT DISTINCT _index, _id FROM ops WHERE seq <= {CUT})"""


@register("w3_create_docs", with_(OPS, _FIRST_INDEXED) + f""",
c AS (SELECT *, row_number() OVER (PARTITION BY _index, _id ORDER BY seq) AS rn FROM ops),
d AS (SELECT c.*, (rn = 1 AND NOT EXISTS (SELECT 1 FROM idx WHERE idx._index = c._index AND idx._id = c._id)) AS ok FROM c)
SELECT seq, 'create' AS op, _index, _id, CASE WHEN ok THEN CAST(1 AS BIGINT) END AS _version,
       CAST(CASE WHEN ok THEN 201 ELSE 409 END AS INTEGER) AS status,
       CASE WHEN ok THEN 'created' END AS result,
       CASE WHEN NOT ok THEN 'version_conflict_engine_exception' END AS error_type FROM d""")
def w3_create_docs(spark, sf):
    # The first half indexed, then the whole log as create calls.
    first, _second = fx.ops_halves(spark, sf)
    stored = W.index_docs(None, first.drop("op")).table
    delta = fx.ops(spark, sf).drop("op")
    return W.create_docs(stored, delta).items


@register("w3_create_docs_table", with_(OPS, _FIRST_INDEXED) + f""",
c AS (SELECT *, row_number() OVER (PARTITION BY _index, _id ORDER BY seq) AS rn FROM ops),
newrows AS (SELECT _index, _id, CAST(1 AS BIGINT) AS _version, FALSE AS _deleted, seq AS _seq, value, props
            FROM c WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM idx WHERE idx._index = c._index AND idx._id = c._id)),
old AS (SELECT _index, _id, CAST(count(*) AS BIGINT) AS _version, FALSE AS _deleted, max(seq) AS _seq,
               arg_max(value, seq) AS value, arg_max(props, seq) AS props
        FROM ops WHERE seq <= {CUT} GROUP BY _index, _id)
SELECT * FROM old UNION ALL SELECT * FROM newrows""")
def w3_create_docs_table(spark, sf):
    # The first half indexed, then the whole log as create calls.
    first, _second = fx.ops_halves(spark, sf)
    stored = W.index_docs(None, first.drop("op")).table
    delta = fx.ops(spark, sf).drop("op")
    return W.create_docs(stored, delta).table


@register("w4_update_docs", with_(OPS) + replay_sql_ctes(f"seq <= {CUT}") + f""",
u AS (SELECT o.seq, o._index, o._id, o.value, o.props, f._version AS v0,
             COALESCE(NOT f._deleted, FALSE) AS live,
             COALESCE(lag(o.value) OVER w, f.value) AS pv, COALESCE(lag(o.props) OVER w, f.props) AS pp
      FROM ops o LEFT JOIN final f ON f._index = o._index AND f._id = o._id
      WINDOW w AS (PARTITION BY o._index, o._id ORDER BY o.seq)),
n AS (SELECT *, live AND value IS NOT DISTINCT FROM pv AND props IS NOT DISTINCT FROM pp AS noop FROM u),
m AS (SELECT *, v0 + sum(CASE WHEN live AND NOT noop THEN 1 ELSE 0 END)
                  OVER (PARTITION BY _index, _id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ver FROM n)
SELECT seq, 'update' AS op, _index, _id, CASE WHEN live THEN CAST(ver AS BIGINT) END AS _version,
       CAST(CASE WHEN live THEN 200 ELSE 404 END AS INTEGER) AS status,
       CASE WHEN noop THEN 'noop' WHEN live THEN 'updated' END AS result,
       CASE WHEN NOT live THEN 'document_missing_exception' END AS error_type FROM m""")
def w4_update_docs(spark, sf):
    # The first half replayed, then the whole log as update calls.
    stored, delta = fx.stored(spark, sf), fx.ops(spark, sf).drop("op")
    return W.update_docs(stored, delta, detect_noop=True).items


@register("w5_delete_docs", with_(OPS) + replay_sql_ctes(f"seq <= {CUT}") + f""",
d AS (SELECT o.seq, o._index, o._id, f._version AS v0, COALESCE(NOT f._deleted, FALSE) AS live,
             row_number() OVER (PARTITION BY o._index, o._id ORDER BY o.seq) AS rn
      FROM ops o LEFT JOIN final f ON f._index = o._index AND f._id = o._id)
SELECT seq, 'delete' AS op, _index, _id, CASE WHEN live AND rn = 1 THEN CAST(v0 + 1 AS BIGINT) END AS _version,
       CAST(CASE WHEN live AND rn = 1 THEN 200 ELSE 404 END AS INTEGER) AS status,
       CASE WHEN live AND rn = 1 THEN 'deleted' ELSE 'not_found' END AS result,
       CAST(NULL AS VARCHAR) AS error_type FROM d""")
def w5_delete_docs(spark, sf):
    return W.delete_docs(fx.stored(spark, sf), fx.ops(spark, sf).select("_index", "_id", "seq")).items


@register("w2_auto_ids", with_(OPS) + """
SELECT seq, COALESCE(CASE WHEN value < 10 THEN NULL ELSE _id END,
                     sha256(_index || '|' || CAST(seq AS VARCHAR))) AS _id, _index, op, value, props
FROM ops""")
def w2_auto_ids(spark, sf):
    # Fixture: ops with a small value are POSTed without an id.
    o = fx.ops(spark, sf).withColumn("_id", F.when(F.col("value") >= 10, F.col("_id")))
    return W.with_auto_ids(o).select("seq", "_id", "_index", "op", "value", "props")


_VOPS = f"""vops AS (SELECT *, CAST(trunc(value) AS BIGINT) AS version FROM ops)"""


def _external_sql(cmp: str) -> str:
    return with_(OPS, _VOPS) + f""",
a AS (SELECT *, max(version) OVER (PARTITION BY _index, _id ORDER BY seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM vops)
SELECT seq, 'index' AS op, _index, _id, CASE WHEN mx IS NULL OR version {cmp} mx THEN version END AS _version,
       CAST(CASE WHEN mx IS NULL THEN 201 WHEN version {cmp} mx THEN 200 ELSE 409 END AS INTEGER) AS status,
       CASE WHEN NOT (mx IS NULL OR version {cmp} mx) THEN 'version_conflict_engine_exception' END AS error_type
FROM a"""


@register("w6a_external", _external_sql(">"))
def w6a_external(spark, sf):
    return W.write_external(None, fx.versioned_ops(spark, sf).drop("op")).items


@register("w6a_external_gte", _external_sql(">="))
def w6a_external_gte(spark, sf):
    return W.write_external(None, fx.versioned_ops(spark, sf).drop("op"), gte=True).items


@register("w6a_external_table", with_(OPS, _VOPS) + """
SELECT _index, _id, max(version) AS _version, FALSE AS _deleted,
       arg_max(seq, (version, -seq)) AS _seq, arg_max(value, (version, -seq)) AS value,
       arg_max(props, (version, -seq)) AS props
FROM vops GROUP BY _index, _id""")
def w6a_external_table(spark, sf):
    # Strict external versions: among equal versions the first one wins (later equals are refused).
    return W.write_external(None, fx.versioned_ops(spark, sf).drop("op")).table


@register("w6c_force", with_(OPS, _VOPS) + """
SELECT _index, _id, arg_max(version, seq) AS _version, FALSE AS _deleted, max(seq) AS _seq,
       arg_max(value, seq) AS value, arg_max(props, seq) AS props
FROM vops GROUP BY _index, _id""")
def w6c_force(spark, sf):
    return W.write_force(None, fx.versioned_ops(spark, sf).drop("op")).table


@register("w7_route", with_(DOCS) + """
SELECT _routing, count(DISTINCT shard) AS shards, min(shard) AS shard, count(*) AS docs FROM docs GROUP BY _routing""")
def w7_route(spark, sf):
    routed = route(fx.docs(spark, sf).drop("shard"), fx.DOC_SHARDS, repartition=True)
    return routed.groupBy("_routing").agg(F.countDistinct("shard").alias("shards"), F.min("shard").alias("shard"),
                                          F.count(F.lit(1)).alias("docs"))


@register("w7_route_children", """
SELECT CAST(l_orderkey AS VARCHAR) AS _parent,
       CAST(CAST(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 8 AS INTEGER) AS shard,
       count(*) AS children FROM lineitem GROUP BY 1, 2""")
def w7_route_children(spark, sf):
    # Children routed by their parent id land on the parent's shard.
    kids = route(fx.lineitem_children(spark, sf).drop("shard"), fx.ORDER_SHARDS)
    return kids.groupBy("_parent", "shard").agg(F.count(F.lit(1)).alias("children"))


@register("w10_default_index", with_(OPS) + """
SELECT seq, CASE WHEN op = 'delete' THEN 'events' ELSE 'fallback' END AS _index, _id, op FROM ops""")
def w10_default_index(spark, sf):
    # Fixture: only delete ops name their index; the others take the caller's.
    o = fx.ops(spark, sf).withColumn("_index", F.when(F.col("op") == "delete", F.col("_index")))
    return W.default_index_of(o, "fallback").select("seq", "_index", "_id", "op")


@register("b1_batch_ops", with_(OPS) + f"""
SELECT seq, CAST((row_number() OVER (ORDER BY seq) - 1) // 10 AS BIGINT) AS batch_no FROM ops""")
def b1_batch_ops(spark, sf):
    return batch_numbers(fx.ops(spark, sf).select("seq"), "seq", 10)


@register("b2_batch_summary", with_(OPS) + replay_sql_ctes() + f""",
it AS ({ITEMS_SELECT} WHERE seq > {CUT}),
bt AS (SELECT *, CAST((row_number() OVER (ORDER BY seq) - 1) // 10 AS BIGINT) AS batch_no FROM it)
SELECT batch_no, count(*) AS items, count(*) FILTER (WHERE status >= 300) AS failed,
       bool_or(status >= 300) AS errors FROM bt GROUP BY batch_no""")
def b2_batch_summary(spark, sf):
    stored, second = _stored(spark, sf)
    items = W.bulk_replay(stored, second).items
    return W.bulk_batch_summary(batch_numbers(items, "seq", 10))


_CAS_OPS = """cops AS (SELECT _index, _id, seq, value, props,
                  CASE WHEN op = 'index' AND value >= 100 THEN NULL ELSE CAST(trunc(value / 10) AS BIGINT) END AS version
           FROM ops)"""


def _cas_ops(spark, sf):
    # Fixture: index ops with a large value carry no version; the others ask for value/10.
    o = fx.ops(spark, sf)
    v = F.when((F.col("op") == "index") & (F.col("value") >= 100), F.lit(None)).otherwise(
        (F.col("value") / 10).cast("long"))
    return o.withColumn("version", v.cast("long")).drop("op")


@register("w6b_internal", "WITH RECURSIVE " + OPS + ",\n" + _CAS_OPS + """,
r AS (SELECT *, row_number() OVER (PARTITION BY _index, _id ORDER BY seq) AS rn FROM cops),
rec(_index, _id, rn, seq, ver, ok) AS (
  SELECT DISTINCT _index, _id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BOOLEAN) FROM r
  UNION ALL
  SELECT r._index, r._id, r.rn, r.seq,
         CASE WHEN r.version IS NULL OR r.version = rec.ver THEN rec.ver + 1 ELSE rec.ver END,
         r.version IS NULL OR r.version = rec.ver
  FROM rec JOIN r ON r._index = rec._index AND r._id = rec._id AND r.rn = rec.rn + 1)
SELECT seq, 'index' AS op, _index, _id, CASE WHEN ok THEN ver END AS _version,
       CAST(CASE WHEN ok THEN CASE WHEN ver = 1 THEN 201 ELSE 200 END ELSE 409 END AS INTEGER) AS status,
       CASE WHEN NOT ok THEN 'version_conflict_engine_exception' END AS error_type
FROM rec WHERE rn > 0""")
def w6b_internal(spark, sf):
    return W.write_internal(None, _cas_ops(spark, sf)).items


_TYPED_OPS = """tops AS (SELECT _index || '/' || CASE WHEN value >= 50 THEN 'big' ELSE 'small' END AS _index,
                 _id, seq, op, value, props FROM ops)"""


@register("w8_bulk_replay_typed", with_(OPS, _TYPED_OPS) + replay_sql_ctes(source="tops") + """
SELECT split_part(_index, '/', 1) AS _index, split_part(_index, '/', 2) AS _type, _id, _version, _deleted,
       _seq, value, props FROM final""")
def w8_bulk_replay_typed(spark, sf):
    # Generation-6 style: the same id lives once per type; the type comes from the op's value.
    from docindex.operators.types import with_types

    typed = fx.ops(spark, sf).withColumn("_type", F.when(F.col("value") >= 50, "big").otherwise("small"))
    return with_types(W.bulk_replay, None, typed).table


def _json_ops(spark, sf):
    # Fixture: index bodies carry value and props, creates add a flag, updates send only value.
    o = fx.ops(spark, sf)
    body = (F.when(F.col("op") == "index", F.to_json(F.struct("value", "props")))
            .when(F.col("op") == "create", F.to_json(F.struct("value", "props", F.lit(True).alias("new_user"))))
            .when(F.col("op") == "update", F.to_json(F.struct("value"))))
    return o.select("_index", "_id", "seq", "op", body.alias("_source"))


_JSON_OPS = """jops AS (SELECT _index, _id, seq, op,
    CASE op WHEN 'index' THEN CAST(json_object('value', value, 'props', props) AS VARCHAR)
            WHEN 'create' THEN CAST(json_object('value', value, 'props', props, 'new_user', TRUE) AS VARCHAR)
            WHEN 'update' THEN CAST(json_object('value', value) AS VARCHAR) END AS body,
    CAST(NULL AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS props FROM ops)"""


@register("w8_bulk_replay_json", with_(OPS, _JSON_OPS) + replay_sql_ctes(source="jops") + """,
ent AS (SELECT _index, _id, seq, seg, unnest(json_keys(body)) AS k, body FROM rc WHERE contrib),
ev AS (SELECT _index, _id, k, arg_max(json_extract(body, '$."' || k || '"'), seg * 1000000000 + seq) AS v,
              max(seg) AS kseg FROM ent GROUP BY ALL),
last AS (SELECT _index, _id, max(seg) AS mseg FROM rc GROUP BY ALL),
bodies AS (SELECT ev._index, ev._id,
                  '{' || string_agg(CAST(to_json(k) AS VARCHAR) || ':' || CAST(v AS VARCHAR), ',' ORDER BY k) || '}' AS body
           FROM ev JOIN last USING (_index, _id) WHERE kseg = mseg GROUP BY ALL)
SELECT f._index, f._id, f._version, f._deleted, f._seq,
       CASE WHEN NOT f._deleted THEN COALESCE(b.body, '{}') END AS _source
FROM final f LEFT JOIN bodies b USING (_index, _id)""")
def w8_bulk_replay_json(spark, sf):
    first, second = fx.ops_halves(spark, sf)
    stored = W.bulk_replay_json(None, _json_ops(spark, sf).where(F.col("seq") <= fx.ops_count(spark, sf) // 2)).table
    return W.bulk_replay_json(stored, _json_ops(spark, sf).where(F.col("seq") > fx.ops_count(spark, sf) // 2)).table


@register("w4_update_docs_table", with_(OPS) + replay_sql_ctes(f"seq <= {CUT}") + f""",
u AS (SELECT o.seq, o._index, o._id, o.value, o.props,
             COALESCE(lag(o.value) OVER w, f.value) AS pv, COALESCE(lag(o.props) OVER w, f.props) AS pp
      FROM ops o JOIN final f ON f._index = o._index AND f._id = o._id
      WHERE NOT f._deleted
      WINDOW w AS (PARTITION BY o._index, o._id ORDER BY o.seq)),
c AS (SELECT _index, _id, count(*) FILTER (WHERE NOT (value IS NOT DISTINCT FROM pv AND props IS NOT DISTINCT FROM pp)) AS n,
             max(seq) FILTER (WHERE NOT (value IS NOT DISTINCT FROM pv AND props IS NOT DISTINCT FROM pp)) AS lastseq,
             arg_max(value, seq) AS lv, arg_max(props, seq) AS lp FROM u GROUP BY ALL)
SELECT f._index, f._id, f._version + COALESCE(c.n, 0) AS _version, f._deleted, COALESCE(c.lastseq, f._seq) AS _seq,
       COALESCE(c.lv, f.value) AS value, COALESCE(c.lp, f.props) AS props
FROM final f LEFT JOIN c USING (_index, _id)""")
def w4_update_docs_table(spark, sf):
    # The first half replayed, then the whole log as update calls.
    stored, delta = fx.stored(spark, sf), fx.ops(spark, sf).drop("op")
    return W.update_docs(stored, delta, detect_noop=True).table


# Hot key: every view event writes the same document (about a fifth of the log),
# replayed in chunks of 1000 ops so the hot key's ops span many tasks and the
# cross-chunk carry is exercised on the driver tables.
HOT_CHUNK_ROWS = 1000

_HOT_SQL = r"""hot AS (
  SELECT 'events' AS _index, CASE WHEN event_type = 'view' THEN 'hot' ELSE CAST(user_id AS VARCHAR) END AS _id,
         CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT) AS seq,
         CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete'
                         WHEN 'click' THEN 'update' ELSE 'index' END AS op,
         value, props
  FROM events)"""


@register("w8_bulk_replay_hot_key", "WITH " + _HOT_SQL + replay_sql_ctes(source="hot") + "SELECT * FROM final")
def w8_bulk_replay_hot_key(spark, sf):
    return W.bulk_replay(None, fx.hot_ops(spark, sf), chunk_rows=HOT_CHUNK_ROWS).table


@register("w9_bulk_items_hot_key", "WITH " + _HOT_SQL + replay_sql_ctes(source="hot") + ITEMS_SELECT)
def w9_bulk_items_hot_key(spark, sf):
    return W.bulk_replay(None, fx.hot_ops(spark, sf), chunk_rows=HOT_CHUNK_ROWS).items


# Ops without a key: every tenth op comes without an id, every thirtieth without an index as well; the log spans many chunks.
KEYLESS_CHUNK_ROWS = 500

_KEYLESS_SQL = r"""kops AS (
  SELECT CASE WHEN seq % 30 = 0 THEN NULL ELSE _index END AS _index, seq, op, value, props,
         CASE WHEN seq % 10 <> 0 THEN _id WHEN op IN ('index', 'create')
              THEN sha256(CASE WHEN seq % 30 = 0 THEN '' ELSE _index || '|' END || CAST(seq AS VARCHAR)) END AS _id
  FROM ops),
keyed AS (SELECT * FROM kops WHERE _index IS NOT NULL AND _id IS NOT NULL)"""

_KEYLESS_ITEMS = """
UNION ALL SELECT seq, op, _index, _id, CAST(NULL AS BIGINT), CAST(CASE WHEN _index IS NULL THEN 400 ELSE 404 END AS INTEGER),
       CASE WHEN _index IS NOT NULL AND op = 'delete' THEN 'not_found' END,
       CASE WHEN _index IS NULL THEN 'action_request_validation_exception' WHEN op = 'update' THEN 'document_missing_exception' END
FROM kops WHERE _index IS NULL OR _id IS NULL"""


def _keyless_ops(spark, sf):
    return (fx.ops(spark, sf).withColumn("_id", F.when(F.col("seq") % 10 != 0, F.col("_id")))
            .withColumn("_index", F.when(F.col("seq") % 30 != 0, F.col("_index"))))


@register("w9_bulk_items_keyless", with_(OPS, _KEYLESS_SQL) + replay_sql_ctes(source="keyed") + ITEMS_SELECT + _KEYLESS_ITEMS)
def w9_bulk_items_keyless(spark, sf):
    return W.bulk_replay(None, _keyless_ops(spark, sf), chunk_rows=KEYLESS_CHUNK_ROWS).items


@register("w8_bulk_replay_keyless", with_(OPS, _KEYLESS_SQL) + replay_sql_ctes(source="keyed") + "SELECT * FROM final")
def w8_bulk_replay_keyless(spark, sf):
    return W.bulk_replay(None, _keyless_ops(spark, sf), chunk_rows=KEYLESS_CHUNK_ROWS).table


@register("w4_update_noop_keyless", with_(OPS) + replay_sql_ctes(f"seq <= {CUT}") + """
SELECT seq, CAST(CASE WHEN _index IS NULL THEN 400 WHEN _id IS NULL OR COALESCE(_deleted, TRUE) THEN 404 ELSE 200 END AS INTEGER) AS status,
       CASE WHEN _index IS NULL THEN 'action_request_validation_exception' WHEN _id IS NULL OR COALESCE(_deleted, TRUE) THEN 'document_missing_exception' END AS error_type
FROM (SELECT o.seq, CASE WHEN seq % 30 = 0 THEN NULL ELSE o._index END AS _index, CASE WHEN seq % 10 <> 0 THEN o._id END AS _id, f._deleted
      FROM ops o LEFT JOIN final f ON f._index = o._index AND f._id = o._id)""")
def w4_update_noop_keyless(spark, sf):
    delta = _keyless_ops(spark, sf).drop("op")
    return W.update_docs(fx.stored(spark, sf), delta, detect_noop=True, chunk_rows=KEYLESS_CHUNK_ROWS).items.select("seq", "status", "error_type")


# Versioned logs of several op types. Every seventh op has no key, every eleventh no version.
_VMIXED = """vm AS (SELECT seq, op, _index, CASE WHEN seq % 7 <> 0 THEN _id WHEN op IN ('index', 'create') THEN sha256(_index || '|' || CAST(seq AS VARCHAR)) END AS _id,
    value, props, CASE WHEN seq % 11 <> 0 THEN CAST(trunc(value) AS BIGINT) END AS version FROM ops),
judged AS (SELECT *, max(version) FILTER (op IN ('index', 'delete')) OVER (PARTITION BY _index, _id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx
  FROM vm WHERE _id IS NOT NULL),
acc AS (SELECT *, op IN ('index', 'delete') AND version IS NOT NULL AND (mx IS NULL OR version > mx) AS ok FROM judged),
lived AS (SELECT *, last_value(CASE WHEN ok THEN op = 'index' END IGNORE NULLS) OVER (PARTITION BY _index, _id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS live FROM acc)"""


def _mixed_versions(spark, sf):
    o = fx.ops(spark, sf).withColumn("version", F.when(F.col("seq") % 11 != 0, F.col("value").cast("long")))
    return o.withColumn("_id", F.when(F.col("seq") % 7 != 0, F.col("_id")))


@register("w6a_external_mixed", with_(OPS, _VMIXED) + """
SELECT seq, op, _index, _id, CASE WHEN ok THEN version END AS _version,
       CAST(CASE WHEN op IN ('create', 'update') THEN 400 WHEN NOT ok THEN 409 WHEN op = 'index' THEN CASE WHEN mx IS NULL THEN 201 ELSE 200 END
                 WHEN COALESCE(live, FALSE) THEN 200 ELSE 404 END AS INTEGER) AS status,
       CASE WHEN op IN ('create', 'update') THEN 'action_request_validation_exception' WHEN NOT ok THEN 'version_conflict_engine_exception' END AS error_type
FROM lived
UNION ALL SELECT seq, op, _index, _id, CAST(NULL AS BIGINT), CAST(404 AS INTEGER), CASE WHEN op = 'update' THEN 'document_missing_exception' END FROM vm WHERE _id IS NULL""")
def w6a_external_mixed(spark, sf):
    """Deletes take part in external versions; what cannot have them is refused; an op without a key still has its item."""
    return W.write_external(None, _mixed_versions(spark, sf), chunk_rows=KEYLESS_CHUNK_ROWS).items


@register("w6a_external_mixed_table", with_(OPS, _VMIXED) + """
SELECT _index, _id, max(version) AS _version, arg_max(op, nr) = 'delete' AS _deleted, max(seq) AS _seq,
       CASE WHEN arg_max(op, nr) = 'index' THEN arg_max(value, nr) END AS value, CASE WHEN arg_max(op, nr) = 'index' THEN arg_max(props, nr) END AS props
FROM (SELECT *, CASE WHEN op = 'delete' AND NOT COALESCE(live, FALSE) THEN NULL ELSE nr END AS seq FROM (SELECT * RENAME (seq AS nr) FROM lived WHERE ok))
GROUP BY _index, _id""")
def w6a_external_mixed_table(spark, sf):
    return W.write_external(None, _mixed_versions(spark, sf), chunk_rows=KEYLESS_CHUNK_ROWS).table


@register("w6c_force_items", with_(OPS) + """
SELECT seq, 'index' AS op, _index, _id, version AS _version,
       CAST(CASE WHEN version IS NULL THEN 409 WHEN seq > first THEN 200 ELSE 201 END AS INTEGER) AS status,
       CASE WHEN version IS NULL THEN 'version_conflict_engine_exception' END AS error_type
FROM (SELECT *, min(CASE WHEN version IS NOT NULL THEN seq END) OVER (PARTITION BY _index, _id) AS first
      FROM (SELECT *, CASE WHEN seq % 11 <> 0 THEN CAST(trunc(value) AS BIGINT) END AS version FROM ops))""")
def w6c_force_items(spark, sf):
    """The first write of a key is 201; an op without a version is refused."""
    o = fx.ops(spark, sf).withColumn("version", F.when(F.col("seq") % 11 != 0, F.col("value").cast("long")))
    return W.write_force(None, o.drop("op")).items


@register("w6b_internal_mixed", "WITH RECURSIVE " + OPS + ",\n" + _CAS_OPS.replace("props,\n", "props, op,\n") + """,
r AS (SELECT *, row_number() OVER (PARTITION BY _index, _id ORDER BY seq) AS rn FROM cops WHERE op <> 'create'),
rec(_index, _id, rn, seq, op, ver, ok, live, was) AS (
  SELECT DISTINCT _index, _id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(0 AS BIGINT), CAST(NULL AS BOOLEAN), FALSE, FALSE FROM r
  UNION ALL
  SELECT r._index, r._id, r.rn, r.seq, r.op, CASE WHEN r.version IS NULL OR r.version = rec.ver THEN rec.ver + 1 ELSE rec.ver END,
         r.version IS NULL OR r.version = rec.ver,
         CASE WHEN r.version IS NULL OR r.version = rec.ver THEN CASE r.op WHEN 'index' THEN TRUE WHEN 'delete' THEN FALSE ELSE rec.live END ELSE rec.live END, rec.live
  FROM rec JOIN r ON r._index = rec._index AND r._id = rec._id AND r.rn = rec.rn + 1)
SELECT seq, op, _index, _id, CASE WHEN ok THEN ver END AS _version,
       CAST(CASE WHEN NOT ok THEN 409 WHEN op = 'index' THEN CASE WHEN ver = 1 THEN 201 ELSE 200 END WHEN was THEN 200 ELSE 404 END AS INTEGER) AS status,
       CASE WHEN NOT ok THEN 'version_conflict_engine_exception' WHEN op = 'update' AND NOT was THEN 'document_missing_exception' END AS error_type
FROM rec WHERE rn > 0
UNION ALL SELECT seq, op, _index, _id, CAST(NULL AS BIGINT), CAST(400 AS INTEGER), 'action_request_validation_exception' FROM cops WHERE op = 'create'""")
def w6b_internal_mixed(spark, sf):
    """Compare-and-set updates and deletes beside index ops; creates have no version."""
    ops = _cas_ops(spark, sf).join(fx.ops(spark, sf).select("seq", "op"), "seq")
    return W.write_internal(None, ops, chunk_rows=KEYLESS_CHUNK_ROWS).items
