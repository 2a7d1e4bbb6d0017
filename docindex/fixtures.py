"""Views that turn the driver's tables into engine inputs (FIXTURES.md §D).

These only rename and project columns into the engine's schemas; none of them
does an operator's work. The one exception is the ``ops`` log position ``seq``,
which is the global rank of events by ``(ts, event_id)`` and is computed with the
scalable rank (no single-partition window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docindex.functions.route import route
from docindex.operators.rank import global_rank
from docindex.session import scratch_path

DOC_SHARDS = 4
ORDER_SHARDS = 8

# event_type -> bulk op, fixed by the fixture definition.
OP_OF_EVENT = {"signup": "create", "error": "delete", "click": "update"}
DEFAULT_OP = "index"

_memo: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as a doc_table: one index per language, routed by source."""
    d = table(spark, sf_dir, "documents")
    out = d.select(
        F.concat(F.lit("docs_"), F.col("lang")).alias("_index"),
        F.col("doc_id").cast("string").alias("_id"),
        F.lit(1).cast("long").alias("_version"),
        F.col("source").alias("_routing"),
        F.lit(None).cast("string").alias("_parent"),
        F.lit(False).alias("_deleted"),
        F.col("doc_id").cast("long").alias("_seq"),
        "text", "lang", "source", "n_chars",
    )
    return route(out, DOC_SHARDS)


def docs_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as a stream of two micro-batches: English and German ones, then the rest.

    Each half is a folder of as many files as Spark writes; the larger half's number of files bounds a trigger, so that
    neither the tasks of the write nor the micro-batches depend on the number of files.
    """
    d, src = docs(spark, sf_dir), scratch_path(spark, "docs-stream")
    first = F.col("lang").isin("en", "de")
    files = []
    for i, part in enumerate([first, ~first]):
        d.where(part).write.parquet(f"{src}/{i}")
        files.append(len(spark.read.schema(d.schema).parquet(f"{src}/{i}").inputFiles()))
    return spark.readStream.schema(d.schema).option("maxFilesPerTrigger", max(1, *files)).parquet(f"{src}/*")


def op_expr():
    e = F.lit(DEFAULT_OP)
    for ev, op in reversed(list(OP_OF_EVENT.items())):
        e = F.when(F.col("event_type") == ev, F.lit(op)).otherwise(e)
    return e


def ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as an ops log: one op per event, in (ts, event_id) order."""
    key = (spark.sparkContext.applicationId, sf_dir, "ops")
    if key in _memo:
        return _memo[key]
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    ranked = global_rank(ev, ["ts", "event_id"], "seq")
    out = ranked.select(
        F.lit("events").alias("_index"),
        F.col("user_id").cast("string").alias("_id"),
        F.col("seq").cast("long").alias("seq"),
        op_expr().alias("op"),
        "value", "props",
    )
    _memo[key] = out
    return out


def hot_ops(spark: SparkSession, sf_dir: str, hot_id: str = "hot") -> DataFrame:
    """The ops log with every view event writing one document (a hot key, ~1/5 of the log)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    ranked = global_rank(ev, ["ts", "event_id"], "seq")
    return ranked.select(
        F.lit("events").alias("_index"),
        F.when(F.col("event_type") == "view", F.lit(hot_id)).otherwise(F.col("user_id").cast("string")).alias("_id"),
        F.col("seq").cast("long").alias("seq"), op_expr().alias("op"), "value", "props")


def ops_count(spark: SparkSession, sf_dir: str) -> int:
    key = (spark.sparkContext.applicationId, sf_dir, "ops_count")
    if key not in _memo:
        _memo[key] = table(spark, sf_dir, "events").count()
    return _memo[key]


def ops_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(first half, second half) of the ops log by ``seq``; the cut is ``count // 2``."""
    o = ops(spark, sf_dir)
    cut = ops_count(spark, sf_dir) // 2
    return o.where(F.col("seq") <= cut), o.where(F.col("seq") > cut)


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIXTURES ``stored``: the first half of the ops log replayed, written once.

    The replay is the library's own (``write.bulk_replay``); the result is
    materialised under the checkpoint folder and reused as the stored table of
    the write, bulk and stats plans.
    """
    key = (spark.sparkContext.applicationId, sf_dir, "stored")
    if key not in _memo:
        from docindex.operators.rank import materialize
        from docindex.operators.write import bulk_replay

        first, _second = ops_halves(spark, sf_dir)
        _memo[key] = materialize(bulk_replay(None, first).table, "stored")
    return _memo[key]


def versioned_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops(spark, sf_dir).withColumn("version", F.col("value").cast("long"))


def orders_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as parent documents of index ``orders``."""
    o = table(spark, sf_dir, "orders")
    out = o.select(
        F.lit("orders").alias("_index"),
        F.col("o_orderkey").cast("string").alias("_id"),
        F.lit(1).cast("long").alias("_version"),
        F.lit(None).cast("string").alias("_routing"),
        F.lit(None).cast("string").alias("_parent"),
        F.lit(False).alias("_deleted"),
        F.col("o_orderkey").cast("long").alias("_seq"),
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
    )
    return route(out, ORDER_SHARDS)


def lineitem_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as child documents whose parent is their order."""
    li = table(spark, sf_dir, "lineitem")
    out = li.select(
        F.lit("lineitems").alias("_index"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("_id"),
        F.lit(1).cast("long").alias("_version"),
        F.lit(None).cast("string").alias("_routing"),
        F.col("l_orderkey").cast("string").alias("_parent"),
        F.lit(False).alias("_deleted"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_returnflag", "l_shipdate",
    )
    return route(out, ORDER_SHARDS)


def mget_keys_from_labels(spark: SparkSession, sf_dir: str, index: str = "docs_en") -> DataFrame:
    """Request list: every labelled doc id, asked of one index, in doc_id order."""
    lab = table(spark, sf_dir, "labels")
    return lab.select(F.col("doc_id").cast("long").alias("pos"),
                      F.lit(index).alias("_index"),
                      F.col("doc_id").cast("string").alias("_id"))


def mget_keys_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request list: the order of every line item, duplicates kept, in line order."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    ranked = global_rank(li, ["l_orderkey", "l_linenumber"], "pos")
    return ranked.select("pos", F.lit("orders").alias("_index"),
                         F.col("l_orderkey").cast("string").alias("_id"))


def bulk_replies(items: DataFrame, took: int = 1) -> DataFrame:
    """Stand-in bulk reply texts (``batch_no, reply``) from item rows with ``batch_no``."""
    item = F.to_json(F.create_map(F.col("op"), F.struct(
        "_index", "_id", "_version", "result", F.col("status").alias("status"),
        F.when(F.col("error_type").isNotNull(), F.struct(F.col("error_type").alias("type"))).alias("error"))))
    g = items.groupBy("batch_no").agg(
        F.array_sort(F.collect_list(F.struct(F.col("seq"), item.alias("it")))).alias("_its"),
        F.bool_or(F.col("status") >= 300).alias("errors"))
    reply = F.concat(F.lit(f'{{"took":{int(took)},"errors":'), F.col("errors").cast("string"), F.lit(',"items":['),
                     F.array_join(F.transform("_its", lambda x: x["it"]), ","), F.lit("]}"))
    return g.select("batch_no", reply.alias("reply"))
