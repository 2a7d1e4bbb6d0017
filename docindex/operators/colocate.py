"""Parent and child documents in buckets of one key: joins without a shuffle.

Both sides are written once as bucketed tables, by the parent's index and id; a bucket of children then stands beside
the bucket of its parents, and a join, has-child or has-no-child query reads both without an exchange. One very large
family makes its bucket large: a bucket is read by one task. ``parent_child`` of ``operators.search``, which shuffles, splits such a
family over tasks.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docindex.operators.rank import range_partitions
from docindex.operators.search import live
from docindex.session import scratch_path


def _bucketed(df: DataFrame, keys: list[str], n: int, kind: str) -> DataFrame:
    """``df`` as a table of ``n`` buckets by ``keys``, one file a bucket, in the shared folder."""
    spark, name = df.sparkSession, f"{kind}_{uuid.uuid4().hex}"
    (df.repartition(n, *keys).write.option("path", scratch_path(spark, kind)).bucketBy(n, *keys).sortBy(*keys).saveAsTable(name))
    return spark.table(name)


@dataclass
class Families:
    """Bucketed parents and children."""

    parents: DataFrame
    children: DataFrame

    @classmethod
    def of(cls, parents: DataFrame, children: DataFrame, parent_index: str | None = None, buckets: int | None = None) -> "Families":
        """Live documents of both sides; a child's parent is in ``parent_index``, or in the child's own index."""
        p, c = live(parents), live(children).where(F.col("_parent").isNotNull())
        n = buckets or max(range_partitions(p), range_partitions(c))
        of = F.lit(parent_index) if parent_index is not None else F.col("_index")
        return cls(_bucketed(p, ["_index", "_id"], n, "parents"), _bucketed(c.withColumn("_parent_index", of), ["_parent_index", "_parent"], n, "children"))

    def _on(self, p: DataFrame, c: DataFrame):
        return (c["_parent_index"] == p["_index"]) & (c["_parent"] == p["_id"])

    def join(self, parent_prefix: str = "parent_") -> DataFrame:
        """Children with their parent's fields."""
        p, c = self.parents.alias("p"), self.children.alias("c")
        fields = [F.col(f"p.{x}").alias(parent_prefix + x.lstrip("_")) for x in self.parents.columns if x not in ("_routing", "_parent", "_deleted", "_seq", "shard")]
        joined = c.join(p.hint("merge"), (F.col("c._parent_index") == F.col("p._index")) & (F.col("c._parent") == F.col("p._id")))
        return joined.select(*[F.col(f"c.{x}") for x in self.children.columns if x != "_parent_index"], *fields)

    def parents_with(self, children=None, without: bool = False) -> DataFrame:
        """Parents with at least one child that meets the condition ``children`` (or with none)."""
        c = self.children if children is None else self.children.where(children)
        p = self.parents
        return p.join(c.hint("merge"), self._on(p, c), "left_anti" if without else "left_semi")
