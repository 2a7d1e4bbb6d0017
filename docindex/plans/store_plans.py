"""Registered plans for the store, maintenance and streaming.

Streaming plans run their query with ``trigger(availableNow=True)`` over files
written to a fresh folder under the checkpoint root, wait for it, and return the
sink read back, so the driver sees a static frame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from docindex import fixtures as fx
from docindex.operators import search as S
from docindex.operators import write as W
from docindex.plans.registry import register
from docindex.plans.views import CUT, DOCS, OPS, with_
from docindex.plans.write_plans import ITEMS_SELECT, replay_sql_ctes
from docindex.session import scratch_path
from docindex.sources import store
from docindex.streaming import bulk as SB

OPS_STREAM_SCHEMA = "_index string, _id string, seq long, op string, value double, props string"
N_PARTS = 4


@register("i8_store_roundtrip", with_(DOCS) + "SELECT * EXCLUDE (shard) FROM docs WHERE _index IN ('docs_en', 'docs_fr')")
def i8_store_roundtrip(spark, sf):
    root = scratch_path(spark, "store")
    store.write_index(fx.docs(spark, sf), root, n_shards=fx.DOC_SHARDS)
    return store.read_index(spark, root, ["docs_en", "docs_fr"]).drop("shard")


@register("r1_get_doc_store", with_(DOCS) + """
SELECT * FROM docs WHERE _index = 'docs_en' AND _id = '7' AND NOT _deleted
  AND shard = CAST(CAST(('0x' || substr(md5('src7'), 1, 8)) AS BIGINT) % 4 AS INTEGER)""")
def r1_get_doc_store(spark, sf):
    # From the store: _index and shard are directories, so the read opens one shard's files.
    root = scratch_path(spark, "store")
    store.write_index(fx.docs(spark, sf), root, n_shards=fx.DOC_SHARDS)
    return S.get_doc(store.read_index(spark, root), "docs_en", "7", routing="src7", n_shards=fx.DOC_SHARDS)


def _seeded_store(spark, sf):
    """The first half replayed and written, then the second half committed to the partitions it touches."""
    first, second = fx.ops_halves(spark, sf)
    root = scratch_path(spark, "store")
    store.write_index(W.bulk_replay(None, first).table, root)
    store.commit_replay(spark, root, second)
    return root


@register("i8_store_commit_replay", with_(OPS) + replay_sql_ctes() + "SELECT * FROM final")
def i8_store_commit_replay(spark, sf):
    root = _seeded_store(spark, sf)
    return store.read_index(spark, root).drop("shard")


@register("i8_commit_routed", with_(DOCS, OPS) + """,
u AS (SELECT _id, count(*) AS n, max(seq) AS s, arg_max(value, seq) AS value FROM ops GROUP BY _id)
SELECT d._index, d._id, d._version + COALESCE(u.n, 0) AS _version, d._routing, d._parent, d._deleted,
       COALESCE(u.s, d._seq) AS _seq, d.text, d.lang, d.source, d.n_chars, u.value
FROM docs d LEFT JOIN u ON d._id = u._id AND d._index = 'docs_en'""")
def i8_commit_routed(spark, sf):
    """Documents routed by source; then every event updates the English document of its user's number, without routing."""
    root = scratch_path(spark, "store")
    store.write_index(fx.docs(spark, sf), root, n_shards=fx.DOC_SHARDS)
    store.commit_replay(spark, root, fx.ops(spark, sf).select(F.lit("docs_en").alias("_index"), "_id", "seq", F.lit("update").alias("op"), "value"))
    return store.read_index(spark, root).drop("shard")


@register("i8_commit_post", with_(DOCS, OPS) + """
SELECT _index, _id, _version, _routing, _parent, _deleted, _seq, text, lang, source, n_chars FROM docs
UNION ALL SELECT 'docs_en', sha256('docs_en|' || CAST(seq AS VARCHAR)), 1, NULL, NULL, FALSE, seq, props, NULL, NULL, NULL FROM ops""")
def i8_commit_post(spark, sf):
    """Every event posted without an id into the documents."""
    root = scratch_path(spark, "store")
    store.write_index(fx.docs(spark, sf), root, n_shards=fx.DOC_SHARDS)
    store.commit_replay(spark, root, fx.ops(spark, sf).select(F.lit("docs_en").alias("_index"), "seq", F.lit("index").alias("op"), F.col("props").alias("text")))
    return store.read_index(spark, root).drop("shard")


@register("i8_commit_new_field", with_(OPS) + replay_sql_ctes() + """
SELECT f._index, f._id, f._version + COALESCE(l.n, 0) AS _version, f._deleted, CASE WHEN l.n > 0 THEN l.s ELSE f._seq END AS _seq, f.value, f.props, l.city
FROM final f LEFT JOIN (SELECT _id, count(*) AS n, max(seq) + 1000000000 AS s, 'c' || _id AS city FROM ops GROUP BY _id) l ON l._id = f._id AND NOT f._deleted""")
def i8_commit_new_field(spark, sf):
    """The log committed, then an update per event that brings a new field."""
    root, ops = scratch_path(spark, "store"), fx.ops(spark, sf)
    store.commit_replay(spark, root, ops)
    store.commit_replay(spark, root, ops.select("_index", "_id", (F.col("seq") + 1_000_000_000).alias("seq"), F.lit("update").alias("op"),
                                                F.concat(F.lit("c"), "_id").alias("city")))
    return store.read_index(spark, root).drop("shard")


@register("i8_numeric_index", """
SELECT CASE WHEN event_id % 2 = 0 THEN '2024.1' ELSE '2024.10' END AS _index, CAST(event_id AS VARCHAR) AS _id, CAST(1 AS BIGINT) AS _version,
       FALSE AS _deleted, event_id AS _seq, value FROM events""")
def i8_numeric_index(spark, sf):
    """Index names that look like equal numbers stay apart."""
    root = scratch_path(spark, "store")
    ev = fx.table(spark, sf, "events")
    name = F.when(F.col("event_id") % 2 == 0, "2024.1").otherwise("2024.10")
    store.commit_replay(spark, root, ev.select(name.alias("_index"), F.col("event_id").cast("string").alias("_id"), F.col("event_id").cast("long").alias("seq"),
                                               F.lit("index").alias("op"), "value"))
    return store.read_index(spark, root).drop("shard")


@register("x1_index_stats", with_(OPS) + replay_sql_ctes() + """
SELECT _index, count(*) FILTER (WHERE NOT _deleted) AS live_docs, count(*) FILTER (WHERE _deleted) AS deleted_docs,
       CAST(COALESCE(sum(CASE WHEN NOT _deleted THEN strlen(CAST(json_object('value', value, 'props', props) AS VARCHAR)) END), 0) AS BIGINT) AS body_bytes,
       max(_version) AS max_version
FROM final GROUP BY _index""")
def x1_index_stats(spark, sf):
    _first, second = fx.ops_halves(spark, sf)
    table = W.bulk_replay(fx.stored(spark, sf), second).table
    return store.index_stats(table, ["value", "props"])


@register("x2_compact", with_(OPS) + replay_sql_ctes() + "SELECT * FROM final WHERE NOT _deleted")
def x2_compact(spark, sf):
    root = _seeded_store(spark, sf)
    store.compact(spark, root, max_files=2)
    return store.read_index(spark, root).drop("shard")


@register("x2_compact_expunge", with_(OPS) + replay_sql_ctes() + "SELECT * FROM final WHERE NOT _deleted")
def x2_compact_expunge(spark, sf):
    root = _seeded_store(spark, sf)
    store.compact(spark, root, expunge_only=True)
    return store.read_index(spark, root).drop("shard")


# ---------------------------------------------------------------- streaming
PART_FILE_ROWS = 250_000  # ops of one file of a part, about


def _write_parts(ops, path, n_parts, lo, n) -> int:
    """Fixture: the log as ``n_parts`` folders written one after another, in seq order; returns the files of a folder.

    All folders have that many files (rows are dealt round robin, many to each), so a trigger of as many takes one part.
    """
    files = max(1, n // n_parts // PART_FILE_ROWS)
    parted = ops.withColumn("part", F.floor((F.col("seq") - lo - 1) * n_parts / n).cast("int"))
    for p in range(n_parts):
        part = parted.where(F.col("part") == p).drop("part")
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.mode("overwrite").parquet(f"{path}/{p:02d}")
    return files


def _stream_second_half(spark, sf):
    first, second = fx.ops_halves(spark, sf)
    n, cut = fx.ops_count(spark, sf), fx.ops_count(spark, sf) // 2
    src = scratch_path(spark, "ops-stream")
    files = _write_parts(second, src, N_PARTS, cut, n - cut)
    root = scratch_path(spark, "store")
    store.write_index(W.bulk_replay(None, first).table, root)
    q, paths = SB.bulk_stream(spark, SB.read_ops_stream(spark, f"{src}/*", OPS_STREAM_SCHEMA, files), root,
                              checkpoint=scratch_path(spark, "ckpt"))
    q.awaitTermination()
    return paths


@register("s1_bulk_stream", with_(OPS) + replay_sql_ctes() + "SELECT * FROM final")
def s1_bulk_stream(spark, sf):
    paths = _stream_second_half(spark, sf)
    return store.read_index(spark, paths.root).drop("shard")


@register("s1_bulk_stream_items", with_(OPS) + replay_sql_ctes() + ITEMS_SELECT + f" WHERE seq > {CUT}")
def s1_bulk_stream_items(spark, sf):
    paths = _stream_second_half(spark, sf)
    return spark.read.parquet(paths.items_path).drop("batch_id")


@register("s3_stream_batch_summary", with_(OPS) + replay_sql_ctes() + f""",
it AS ({ITEMS_SELECT} WHERE seq > {CUT}),
n AS (SELECT count(*) AS n FROM events),
bt AS (SELECT it.*, CAST(((seq - n // 2 - 1) * {N_PARTS}) // (n - n // 2) AS BIGINT) AS batch_no FROM it, n)
SELECT batch_no, count(*) AS items, count(*) FILTER (WHERE status >= 300) AS failed,
       bool_or(status >= 300) AS errors FROM bt GROUP BY batch_no""")
def s3_stream_batch_summary(spark, sf):
    paths = _stream_second_half(spark, sf)
    return spark.read.parquet(paths.summary_path).select("batch_no", "items", "failed", "errors")


@register("s2_bulk_stateful", with_(OPS) + replay_sql_ctes() + ITEMS_SELECT)
def s2_bulk_stateful(spark, sf):
    ops = fx.ops(spark, sf)
    src = scratch_path(spark, "ops-stream")
    files = _write_parts(ops, src, 2 * N_PARTS, 0, fx.ops_count(spark, sf))
    out = scratch_path(spark, "items")
    SB.bulk_stateful(spark, SB.read_ops_stream(spark, f"{src}/*", OPS_STREAM_SCHEMA, files), out, scratch_path(spark, "ckpt")).awaitTermination()
    return spark.read.parquet(out)


@register("s4_search_stream", with_(DOCS) + """
SELECT * EXCLUDE (shard), shard, 0 AS consumer FROM docs WHERE NOT _deleted AND lang = 'fr'
UNION ALL SELECT * EXCLUDE (shard), shard, 1 FROM docs WHERE NOT _deleted AND lang = 'fr'""")
def s4_search_stream(spark, sf):
    stream = fx.docs_stream(spark, sf)
    sinks = [scratch_path(spark, "hits"), scratch_path(spark, "hits")]
    qs = SB.search_stream(stream, F.col("lang") == "fr", sinks,
                          [scratch_path(spark, "ckpt"), scratch_path(spark, "ckpt")])
    for q in qs:
        q.awaitTermination()
    out = spark.read.parquet(sinks[0]).withColumn("consumer", F.lit(0))
    return out.unionByName(spark.read.parquet(sinks[1]).withColumn("consumer", F.lit(1)))
