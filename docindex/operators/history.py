"""Validity intervals of documents: as-of reads without a replay.

Every op that takes effect ends the state before it and begins one of its own. ``history`` works all states of a log
out in one pass, with the interval ``[valid_from, valid_to)`` of log positions in which each holds; an as-of read is
then a filter on the interval.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docindex.operators.write import CHUNK_ROWS, KEY, _aligned, _evaluate, _prepare_ops, log_stats, split_keyless, split_touched, with_untouched


def history(table: DataFrame | None, ops: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows ``_index, _id, _version, _deleted, valid_from, valid_to`` and the body fields: all states of all documents.

    Stored documents hold from position -1 (before the log) on; ``valid_to`` is null for the state after the log. A
    key's ops are cut into chunks as in the replay: within a chunk windows carry the fields on, between chunks a fold
    over one row a chunk and segment does, so a hot key is spread over many tasks.
    """
    table, ops, fields = _aligned(table, _prepare_ops(ops, table, None))
    stats = log_stats(ops)
    ops, _ = split_keyless(ops, stats)
    table, untouched = split_touched(table, ops, stats.rows)
    # Several chunks always, so that every row has its chunk number.
    rows = _evaluate(table, ops, chunk_rows, stats).where("succ")
    contrib = F.col("op").isin("index", "create", "update")
    inside = Window.partitionBy(*KEY, "seg", "_chunk").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for f in fields:
        rows = rows.withColumn(f"_in_{f}", F.last(F.when(contrib, F.col(f)), ignorenulls=True).over(inside))
    # What earlier chunks of the same segment leave in each field.
    ends = rows.groupBy(*KEY, "seg", "_chunk").agg(*[F.max_by(f, F.when(contrib & F.col(f).isNotNull(), F.col("seq"))).alias(f"_end_{f}") for f in fields])
    earlier = Window.partitionBy(*KEY, "seg").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*KEY, "seg", "_chunk", *[F.last(f"_end_{f}", ignorenulls=True).over(earlier).alias(f"_far_{f}") for f in fields])
    # The next state of a key begins in this chunk, or in the next one that has any.
    heads = rows.groupBy(*KEY, "_chunk").agg(F.min("seq").alias("_head"))
    following = heads.select(*KEY, "_chunk", F.lead("_head").over(Window.partitionBy(*KEY).orderBy("_chunk")).alias("_next_head"))
    rows = rows.withColumn("_next", F.lead("seq").over(Window.partitionBy(*KEY, "_chunk").orderBy("seq")))
    rows = rows.join(carried, [*KEY, "seg", "_chunk"]).join(following, [*KEY, "_chunk"])
    was = table.select(*KEY, *[F.col(f).alias(f"_was_{f}") for f in fields if f in table.columns])
    rows = rows.join(was, KEY, "left")
    live = F.coalesce(F.col("_eff"), F.col("exists_before"))
    body = [F.when(live, F.coalesce(F.col(f"_in_{f}"), F.col(f"_far_{f}"), *([F.when(F.col("seg") == 0, F.col(f"_was_{f}"))] if f in table.columns else []))).alias(f)
            for f in fields]
    states = rows.select(*KEY, F.col("version").alias("_version"), (~live).alias("_deleted"), F.col("seq").alias("valid_from"),
                         F.coalesce("_next", "_next_head").alias("valid_to"), *body)
    first = rows.groupBy(*KEY).agg(F.min("seq").alias("valid_to"))
    stored = table.select(*KEY, "_version", "_deleted", F.lit(-1).cast("long").alias("valid_from"),
                          *[F.col(f) if f in table.columns else F.lit(None).cast(ops.schema[f].dataType).alias(f) for f in fields])
    states = states.unionByName(stored.join(first, KEY, "left"))
    rest = None if untouched is None else untouched.withColumn("valid_from", F.lit(-1).cast("long")).withColumn("valid_to", F.lit(None).cast("long"))
    return with_untouched(states, rest)


def as_of(states: DataFrame, seq) -> DataFrame:
    """The live documents after the op at position ``seq`` (a number or a column)."""
    at = F.lit(seq) if isinstance(seq, int) else seq
    held = (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at))
    return states.where(held & ~F.col("_deleted"))
