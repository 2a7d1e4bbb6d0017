"""Scalable global rank (dense 1..N position in a total order).

A ``Window.orderBy`` without ``partitionBy`` moves every row into one task.
Instead the frame is range-partitioned on the order keys (Spark samples the
keys, so one hot leading key is split across partitions by the tie-breakers),
sorted inside each partition, and written once to the shared checkpoint folder
together with its partition number and local position. The written table is
the cut in lineage: the ranks cannot shift if a task is re-run or an executor is
lost, because they are read back, not re-derived from a new range sample.
Per-partition counts (one row per partition, never per data row) give the
cumulative offsets, which are joined back with a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docindex.session import scratch_path

PARTITION_BYTES = 256 << 20  # input bytes that one range partition takes, about


def _order_cols(order: list) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def materialize(df: DataFrame, kind: str = "table") -> DataFrame:
    """Write ``df`` to a fresh folder under the checkpoint root and read it back."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, kind)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Bytes of the inputs of ``df``, as far as they are known."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < 1 << 60)  # an input without statistics reports the largest long


def range_partitions(df: DataFrame) -> int:
    """Range partitions for ``df``: by the bytes of its inputs, and no fewer than the session's shuffle partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), input_bytes(df) // PARTITION_BYTES)


def global_rank(df: DataFrame, order: list, rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based position of each row in ``order``.

    ``order`` must be a total order (append a unique key as the last tie-breaker);
    with ties the rank among tied rows is arbitrary but fixed once written.
    """
    spark = df.sparkSession
    cols = _order_cols(order)
    n = num_partitions or range_partitions(df)
    ranged = (df.repartitionByRange(n, *cols)
              .sortWithinPartitions(*cols)
              .withColumn("_rk_pid", F.spark_partition_id())
              .withColumn("_rk_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    written = materialize(ranged, "rank")
    counts = written.groupBy("_rk_pid").agg(F.count(F.lit(1)).alias("_rk_n"))
    # One number per partition goes to the driver; the data never does.
    rows = sorted((r["_rk_pid"], r["_rk_n"]) for r in counts.collect())
    offsets, acc = [], 0
    for pid, cnt in rows:
        offsets.append((pid, acc))
        acc += cnt
    off_df = spark.createDataFrame(offsets or [(0, 0)], "_rk_pid int, _rk_off long")
    out = (written.join(F.broadcast(off_df), "_rk_pid")
           .withColumn(rank_col, F.col("_rk_off") + F.col("_rk_local") + F.lit(1))
           .drop("_rk_pid", "_rk_local", "_rk_off"))
    return out


def dense_positions(df: DataFrame, seq_col: str, out_col: str = "pos") -> DataFrame:
    """1-based position of each row by a unique ``seq_col`` (tie-broken by itself)."""
    return global_rank(df, [seq_col], out_col)


def batch_numbers(df: DataFrame, seq_col: str, batch_size: int,
                  out_col: str = "batch_no") -> DataFrame:
    """B1: split a log ordered by ``seq_col`` into groups of ``batch_size`` (last one short)."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    ranked = global_rank(df, [seq_col], "_b_rank")
    return (ranked.withColumn(out_col, F.floor((F.col("_b_rank") - 1) / batch_size).cast("long"))
            .drop("_b_rank"))


batch_ops = batch_numbers  # SURVEY name (B1)
