"""Reverse search: many standing queries over a document stream in one pass.

The standing queries are a table of (query, term), a query matching a document that holds all of its terms. Each
micro-batch is analysed once; its distinct tokens meet the terms in one join, which Spark broadcasts if the terms are
few, and a document's matched terms are counted for each query. The cost follows the tokens and the matches, not
the number of queries times the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docindex.functions.analyze import standard_tokens

KEY = ["_index", "_id"]


def percolate(docs: DataFrame, queries: DataFrame, field: str) -> DataFrame:
    """Rows (query, _index, _id): the live documents that hold every term of a standing query, in a static frame."""
    live = docs.where(~F.col("_deleted")) if "_deleted" in docs.columns else docs
    tokens = live.select(*KEY, F.explode(F.array_distinct(standard_tokens(F.col(field)))).alias("term"))
    asked = queries.select("query", "term").distinct()
    needed = asked.groupBy("query").agg(F.count(F.lit(1)).alias("needed"))
    matched = tokens.join(asked.join(needed, "query"), "term").groupBy("query", "needed", *KEY).agg(F.count_distinct("term").alias("n"))
    return matched.where(F.col("n") == F.col("needed")).select("query", *KEY)


def percolate_stream(docs_stream: DataFrame, queries: DataFrame, field: str, path: str, checkpoint: str, available_now: bool = True):
    """Hits of all standing queries, written for each micro-batch to ``path/batch_id=<k>``; one read of the source.

    A micro-batch that is run again rewrites its own folder. Returns the query.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        percolate(batch, queries, field).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    w = docs_stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
