"""Aggregations over search matches.

Buckets and metrics are ordinary grouped aggregates, so Spark runs them as a
partial (map-side) aggregate, one shuffle of at most one row per key per task,
and a final aggregate. A hot key costs one row per task, not its row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docindex.operators.rank import materialize

_FOLD_ROWS = 500_000  # rows of a task that are grouped together

METRICS = ("count", "sum", "min", "max", "avg")


def _metric_cols(field: str, metrics=METRICS, prefix: str = "") -> list[Column]:
    c = F.col(field)
    fns = {"count": F.count(c), "sum": F.sum(c), "min": F.min(c), "max": F.max(c), "avg": F.avg(c)}
    return [fns[m].alias(f"{prefix}{m}") for m in metrics]


def metric_agg(df: DataFrame, field: str, metrics=METRICS) -> DataFrame:
    """Count, sum, min, max, avg of ``field`` over the matches (one row)."""
    return df.agg(*_metric_cols(field, metrics))


def terms_agg(df: DataFrame, field: str, size: int = 10, metric_field: str | None = None,
              metrics=("sum", "avg")) -> DataFrame:
    """G1: one bucket per value of ``field``: the top ``size`` by doc count, then key.

    Rows: ``key, doc_count, is_other`` (+ ``<metric>_<field>``). A last row with
    ``is_other = true`` and a null key carries the count of every document in the
    remaining buckets (``sum_other_doc_count``). Documents without the field are
    not bucketed. The top buckets (at most ``size`` rows) are written once; the rest is
    the count of all bucketed documents less theirs.
    """
    keyed = df.where(F.col(field).isNotNull())
    aggs = [F.count(F.lit(1)).alias("doc_count")]
    if metric_field:
        c = F.col(metric_field)
        fns = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}
        aggs += [fns[m](c).alias(f"{m}_{metric_field}") for m in metrics]
    grouped = keyed.groupBy(F.col(field).alias("key")).agg(*aggs)
    top = materialize(grouped.orderBy(F.col("doc_count").desc(), F.col("key").asc()).limit(size), "top-buckets")
    counts = keyed.agg(F.count(F.lit(1)).alias("doc_count")).unionAll(top.select(-F.col("doc_count")))
    other = counts.agg(F.sum("doc_count").alias("doc_count"))
    other = other.select(F.lit(None).cast(grouped.schema["key"].dataType).alias("key"), "doc_count",
                         *[F.lit(None).cast(grouped.schema[c].dataType).alias(c)
                           for c in grouped.columns if c not in ("key", "doc_count")])
    return (top.withColumn("is_other", F.lit(False))
            .unionByName(other.withColumn("is_other", F.lit(True))))


def _counted():
    """Per task: every key with its count (``mapInArrow``; Arrow's own grouping, batch by batch)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        held, rows, kept = [], 0, 0  # tables, their rows, and those that the last grouping left

        def folded():
            return pa.concat_tables(held).group_by("key").aggregate([("n", "sum")]).rename_columns(["key", "n"])

        for batch in batches:
            held.append(pa.Table.from_batches([batch]).append_column("n", pa.array(np.ones(batch.num_rows, dtype=np.int64))))
            rows += batch.num_rows
            if rows > max(_FOLD_ROWS, 2 * kept):  # as many new rows as groups: each row is grouped a few times at most
                held = [folded()]
                rows = kept = held[0].num_rows
        if rows:
            yield from folded().to_batches()
    return run


def terms_topk(df: DataFrame, field: str, size: int = 10) -> DataFrame:
    """G1 for fields of very many values: the exact top ``size`` buckets (``key, doc_count``), by a threshold algorithm.

    Each task counts its own rows and writes the counts; they are not shuffled. Three looks at them follow. (1) The sum of
    every task's own ``size`` best gives lower bounds; their ``size``-th largest is T. (2) A value that reaches T in all has
    T / tasks in some task: those are the candidates. (3) Only the candidates are summed over all tasks. What is shuffled is
    a few rows a task and the candidates' counts, not a row a value.
    """
    from pyspark.sql import Window

    kind = df.schema[field].dataType
    keyed = df.where(F.col(field).isNotNull()).select(F.col(field).alias("key"))
    own = keyed.mapInArrow(_counted(), f"key {kind.simpleString()}, n long").withColumn("task", F.spark_partition_id())
    counts = materialize(own, "term-counts")
    tasks = counts.agg(F.count_distinct("task")).first()[0]
    if not tasks:
        return counts.select("key", F.col("n").alias("doc_count")).limit(0)
    best = F.row_number().over(Window.partitionBy("task").orderBy(F.desc("n"), "key"))  # a WindowGroupLimit below the exchange
    local = counts.withColumn("rank", best).where(F.col("rank") <= size).groupBy("key").agg(F.sum("n").alias("low"))
    low = local.orderBy(F.desc("low")).offset(size - 1).limit(1).first()
    share = 1 if low is None else -(-low["low"] // tasks)
    if share > 1:  # else every value is a candidate
        candidates = counts.where(F.col("n") >= share).select("key").distinct()
        counts = counts.join(candidates, "key", "left_semi")
    exact = counts.groupBy("key").agg(F.sum("n").alias("doc_count"))
    return exact.orderBy(F.desc("doc_count"), "key").limit(size)


def filtered_agg(matches: DataFrame, field: str, size: int = 10, metric_field: str | None = None) -> DataFrame:
    """Buckets over every match of a query, independent of the page (from/size)."""
    return terms_agg(matches, field, size, metric_field)
