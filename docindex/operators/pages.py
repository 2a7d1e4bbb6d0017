"""Deep pages without sorting or copying every match.

``deep_page`` (R5) selects by rank: rows are counted in key ranges, only the ranges that hold the page are looked at
again, and the few rows left are sorted. ``KeysetScroll`` (R9) writes the matches once, range-partitioned by the sort
key, one folder a range; a page is then read alone, from the folders after its cursor that hold enough rows.

An order is a list of (column, ascending); nulls come first ascending and last descending, as Spark sorts them. It must
be total: end it with the document's key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docindex.operators.rank import range_partitions
from docindex.session import scratch_path

BOUNDS = 32  # ranges counted at once
SAMPLED = 2_000  # sort keys, about, that are looked at for the bounds of a round
SORTED = 10_000  # rows that may be left for the final sort beside the page's own


def sort_columns(order: list) -> list[Column]:
    return [F.col(name).asc_nulls_first() if up else F.col(name).desc_nulls_last() for name, up in order]


def after(order: list, values) -> Column:
    """Whether a row comes after the one with these key values."""
    out, equal = F.lit(False), F.lit(True)
    for (name, up), v in zip(order, values):
        c = F.col(name)
        if up:
            later = c.isNotNull() if v is None else F.coalesce(c > F.lit(v), F.lit(False))
        else:
            later = F.lit(False) if v is None else F.coalesce(c < F.lit(v), F.lit(True))
        out = out | (equal & later)
        equal = equal & c.eqNullSafe(F.lit(v))
    return out


def deep_page(df: DataFrame, order: list, from_: int, size: int, total: int | None = None) -> DataFrame:
    """Rows ``from_`` .. ``from_ + size`` of ``df`` in order, by counting key ranges.

    A round draws a few sort keys, counts the rows between them (one partial aggregate, no shuffle of rows) and keeps
    the ranges that the page lies in; a few rounds narrow a table of any size down to the page and ``SORTED`` rows.
    """
    names, cols = [name for name, _ in order], sort_columns(order)
    left, n = df, df.count() if total is None else total
    while n > SORTED + size and from_ < n:
        drawn = left.select(*names).sample(min(1.0, SAMPLED / n), seed=7).limit(8 * SAMPLED).orderBy(*cols).collect()
        step = max(1, len(drawn) // BOUNDS)
        bounds = list(dict.fromkeys(tuple(r) for r in drawn[step - 1:: step]))[:BOUNDS]
        if not bounds:
            break
        nr = F.lit(0)
        for b in bounds:
            nr = nr + after(order, b).cast("int")
        counts = dict(left.groupBy(nr.alias("nr")).count().collect())  # at most BOUNDS + 1 rows
        before, first, kept, last = 0, None, 0, None
        for k in range(len(bounds) + 1):
            rows = counts.get(k, 0)
            if first is None and before + rows <= from_:
                before += rows
                continue
            first = k if first is None else first
            kept += rows
            last = k
            if before + kept >= from_ + size:
                break
        if first is None or kept == n:
            break
        if first > 0:
            left = left.where(after(order, bounds[first - 1]))
        if last < len(bounds):
            left = left.where(~after(order, bounds[last]))
        from_, n = from_ - before, kept
    return left.orderBy(*cols).offset(from_).limit(size)


@dataclass
class KeysetScroll:
    """Pages of a written, range-partitioned snapshot, each read by itself from its cursor."""

    spark: SparkSession
    path: str
    schema: T.StructType
    order: list
    counts: list  # (range, rows) in key order: one row a range

    @classmethod
    def of(cls, df: DataFrame, order: list, path: str | None = None) -> "KeysetScroll":
        spark, path = df.sparkSession, path or scratch_path(df.sparkSession, "scroll")
        cols = sort_columns(order)
        place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
        (df.repartitionByRange(range_partitions(df), *cols).sortWithinPartitions(*cols)
         .withColumn("_place", place).withColumn("_range", F.spark_partition_id()).write.partitionBy("_range").parquet(path))
        added = [T.StructField("_place", T.LongType()), T.StructField("_range", T.IntegerType())]
        out = cls(spark, path, T.StructType([*df.schema.fields, *added]), order, [])
        out.counts = [tuple(r) for r in out._rows().groupBy("_range").count().orderBy("_range").collect()]
        return out

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def page(self, cursor: tuple | None, size: int) -> DataFrame:
        """The first ``size`` rows after ``cursor`` (None: from the start), with their range.

        A cursor is a row's range and sort key. Only the folders from its range on that hold ``size`` more rows are read.
        The page is cut by the rows' places in their ranges, so a page of any size is sorted by many tasks.
        """
        start, skip = (cursor[0], self._passed(*cursor)) if cursor else (-1, 0)
        read, left, last = [], size, None
        for part, rows in self.counts:
            if part < start or left <= 0:
                continue
            first = skip if part == start else 0
            read.append(part)
            left, last = left - (rows - first), (part, first + left)
        df = self._rows().where(F.col("_range").isin(read) if read else F.lit(False))
        if cursor:
            df = df.where((F.col("_range") > start) | (F.col("_place") >= skip))
        if last:
            df = df.where((F.col("_range") < last[0]) | (F.col("_place") < last[1]))
        df = df.orderBy(*sort_columns(self.order))
        return (df.limit(size) if size <= SORTED else df).drop("_place")

    def _passed(self, part: int, values) -> int:
        """How many rows of a range lie up to the key ``values``: rows that are equal to it count as well."""
        rows = self._rows().where(F.col("_range") == part)
        return rows.where(~after(self.order, values)).count()

    def cursor_after(self, page: DataFrame) -> tuple | None:
        """The cursor behind a page's last row; None for an empty page."""
        back = [F.col(name).desc_nulls_last() if up else F.col(name).asc_nulls_first() for name, up in self.order]
        last = page.select("_range", *(name for name, _ in self.order)).orderBy(*back).first()
        return None if last is None else (last[0], tuple(last[1:]))

    def pages(self, size: int) -> Iterator[DataFrame]:
        """All pages in turn; only the cursor comes to the driver."""
        cursor = None
        while True:
            page = self.page(cursor, size)
            cursor = self.cursor_after(page)
            if cursor is None:
                return
            yield page.drop("_range")
