"""Streaming bulk and search.

S1 applies an ordered ops stream to the store one micro-batch at a time (``foreachBatch`` runs batches strictly in
order, like the reference's one-request-in-flight flow). A batch is prepared first: its new partitions, items and
summary are written to folders of the stream, the table stays as it is; then a marker names the batch as prepared, and
the partitions are put in place. A batch that is run again after a failure is prepared again if it has no marker, else
only put in place again, so it takes effect once. The stream's name is kept inside its checkpoint: another checkpoint
is another stream, whatever its folder is called.

S2 keeps (exists, version) of each key in Spark's own state store (RocksDB) and needs no table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docindex.operators import write as W
from docindex.operators.rank import batch_numbers
from docindex.sources import store

ITEM_SCHEMA = ("seq long, op string, _index string, _id string, _version long, status int, "
               "result string, error_type string")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class BulkStream:
    root: str
    items_path: str
    summary_path: str


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The name that a checkpoint holds; a new checkpoint gets one."""
    path = f"{checkpoint.rstrip('/')}/stream_name"
    found = store.read_if_there(spark, path, "name string")
    if found is None:
        spark.createDataFrame([(uuid.uuid4().hex,)], "name string").coalesce(1).write.parquet(path)
        found = spark.read.schema("name string").parquet(path)
    return found.first()["name"]


def _prepared(spark: SparkSession, own: str) -> int:
    """The last batch that was prepared, or -1. The two newest are kept in turn."""
    marks = [store.read_if_there(spark, f"{own}/prepared/{k}", "batch_id long") for k in (0, 1)]
    return max([r["batch_id"] for m in marks if m is not None for r in m.collect()], default=-1)


def _batch_fn(spark: SparkSession, root: str, n_shards: int, own: str, paths: BulkStream, batch_size: int | None = None,
              default_index: str | None = None):
    """Apply one micro-batch of the stream whose folder is ``own``."""
    done: list = []  # the last batch that was prepared, read once

    def apply(batch: DataFrame, batch_id: int) -> None:
        items_dir, staged = f"{paths.items_path}/batch_id={batch_id}", f"{own}/staged/{batch_id % 2}"
        last = done[0] if done else _prepared(spark, own)
        if last > batch_id:
            raise ValueError(f"batch {batch_id} comes after batch {last} of this stream: was its checkpoint put back?")
        if last < batch_id:
            store.prepare(spark, root, W._prepare_ops(batch, None, default_index), staged, n_shards,
                          on_items=lambda items: items.write.mode("overwrite").parquet(items_dir))
            # S3: bulk responses of this micro-batch, from the written items: one, or one per ``batch_size`` ops.
            written = spark.read.schema(ITEM_SCHEMA).parquet(items_dir)
            numbered = batch_numbers(written, "seq", batch_size) if batch_size else written.withColumn("batch_no", F.lit(batch_id).cast("long"))
            W.bulk_batch_summary(numbered).write.mode("overwrite").parquet(f"{paths.summary_path}/batch_id={batch_id}")
            spark.createDataFrame([(batch_id,)], "batch_id long").coalesce(1).write.mode("overwrite").parquet(f"{own}/prepared/{batch_id % 2}")
        done[:] = [batch_id]
        store.publish(spark, root, staged)
    return apply


def bulk_stream(spark: SparkSession, source: DataFrame, root: str, checkpoint: str,
                n_shards: int = store.DEFAULT_SHARDS, available_now: bool = True, batch_size: int | None = None,
                default_index: str | None = None):
    """S1 (+S3): start the stream; returns (query, BulkStream paths).

    ``source`` is a streaming DataFrame of ops (``readStream`` with a size bound such as ``maxFilesPerTrigger``); all
    its columns but the op's own are body fields. The store at ``root`` may hold documents already; the stream is its
    only writer while it runs. With ``batch_size`` each micro-batch answers one response per that many ops.
    """
    name, base = stream_name(spark, checkpoint), root.rstrip("/")
    paths = BulkStream(root, f"{base}/_items/{name}", f"{base}/_summary/{name}")
    apply = _batch_fn(spark, root, n_shards, f"{base}/_streams/{name}", paths, batch_size, default_index)
    writer = source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    q = (writer.trigger(availableNow=True) if available_now else writer).start()
    return q, paths


def stream_batch_summary(items_stream: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """S3: B2 on a stream of item results, one summary row per micro-batch.

    Each micro-batch's items are aggregated inside ``foreachBatch`` and written to
    ``path/batch_id=<k>`` (overwritten on a replay of the batch, so idempotent).
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        summary = W.bulk_batch_summary(batch.withColumn("batch_no", F.lit(batch_id).cast("long")))
        summary.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    w = items_stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def read_ops_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    """An ops stream from a folder of Parquet files, in file arrival order."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


# ---------------------------------------------------------------- S2
def _fold(op, exists: bool, version: int):
    """(existed before, succeeded, version) of a key's ops in order, as arrays; numpy, no loop over ops."""
    import numpy as np

    is_index, is_create, is_delete = op == "index", op == "create", op == "delete"
    eff = np.where(is_index | is_create, 1, np.where(is_delete, 0, -1))
    at = np.maximum.accumulate(np.where(eff >= 0, np.arange(len(eff)), -1))
    after = np.where(at >= 0, eff[at] == 1, exists)
    before = np.append(exists, after[:-1])
    done = is_index | (is_create & ~before) | (before & ((op == "update") | is_delete))
    return before, done, version + np.cumsum(done), bool(after[-1])


def stateful_items(ops_stream: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """The item results of an ops stream, with (exists, version) of each key in Spark's state store.

    The ops of a key in one micro-batch are one group, bounded by the micro-batch. An op without a key is a group of
    its own and leaves no state. With ``ttl_ms`` a key that has had no op for that long is forgotten, as if it had never
    been written; without it the state grows with the number of keys.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    ops = W._prepare_ops(ops_stream.select(*[c for c in ("_index", "_id", "seq", "op") if c in ops_stream.columns]), None, None)
    no_key = F.col("_index").isNull() | F.col("_id").isNull()
    ops = ops.withColumn("_k", F.when(no_key, F.concat(F.lit("\0"), F.col("seq").cast("string"))).otherwise(F.col("_id")))

    def run(key, parts, state):
        import numpy as np
        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        # A key has a few ops in a micro-batch: what counts is the cost of a call, so columns are sorted as arrays.
        parts = list(parts)
        rows = parts[0] if len(parts) == 1 else pd.concat(parts)
        seq = rows["seq"].to_numpy()
        order = np.argsort(seq, kind="stable")
        ops_of, ids = rows["op"].to_numpy(dtype=object)[order], rows["_id"].to_numpy(dtype=object)[order]
        op = ops_of.astype(str)
        known, version = state.get if state.exists else (False, 0)
        before, done, versions, last = _fold(op, known, version)
        is_index, is_create, is_delete = op == "index", op == "create", op == "delete"
        status = np.where(is_index, np.where(before, 200, 201), np.where(is_create, np.where(done, 201, 409), np.where(done, 200, 404)))
        result = np.where(is_index, np.where(before, "updated", "created"),
                          np.where(is_create, "created", np.where(is_delete, "deleted", "updated"))).astype(object)
        result[~done] = None
        result[~done & is_delete] = "not_found"
        error = np.full(len(op), None, dtype=object)
        error[~done & is_create], error[~done & (op == "update")] = W.ERR_CONFLICT, W.ERR_MISSING
        if key[0] is None:  # no index: refused
            status[:], result[:], error[:], done = W.STATUS_BAD, None, W.ERR_REQUEST, np.zeros(len(op), dtype=bool)
        elif done.any():
            state.update((last, int(versions[-1])))
        if ttl_ms is not None and state.exists:
            state.setTimeoutDuration(ttl_ms)
        yield pd.DataFrame({"seq": seq[order], "op": ops_of, "_index": rows["_index"].to_numpy(dtype=object), "_id": ids,
                            "_version": pd.arrays.IntegerArray(versions.astype("int64"), ~done),
                            "status": status.astype("int32"), "result": result, "error_type": error})

    timeout = GroupStateTimeout.NoTimeout if ttl_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return ops.groupBy("_index", "_k").applyInPandasWithState(run, ITEM_SCHEMA, "exists boolean, version long", "append", timeout)


def bulk_stateful(spark: SparkSession, ops_stream: DataFrame, items_path: str, checkpoint: str, ttl_ms: int | None = None,
                  available_now: bool = True):
    """Write the item results of an ops stream to Parquet files; returns the query.

    The session's state store provider is set to RocksDB, which keeps state on disk and change logs in the checkpoint.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    writer = stateful_items(ops_stream, ttl_ms).writeStream.format("parquet").option("path", items_path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


# ---------------------------------------------------------------- S4
def search_stream(docs_stream: DataFrame, predicate, sinks: list[str], checkpoints: list[str],
                  available_now: bool = True):
    """Continuous hits of a predicate, delivered to several consumers (one query each)."""
    if len(sinks) != len(checkpoints):
        raise ValueError("one checkpoint per sink")
    hits = docs_stream.where(~F.col("_deleted")).where(predicate)
    queries = []
    for path, ck in zip(sinks, checkpoints):
        w = hits.writeStream.format("parquet").option("path", path).option("checkpointLocation", ck)
        w = w.trigger(availableNow=True) if available_now else w
        queries.append(w.start())
    return queries
