"""Server generation 5/6 mapping types as an adapter over the typeless operators.

With types a document key is ``(_index, _type, _id)`` and the same id may exist
once per type. ``fold_types`` packs the type into the index name
(``index/type``, the reference's ``name / type`` sugar) so every operator keys
by ``(_index, _id)`` unchanged; ``unfold_types`` splits it back. Writes and
gets without a type are refused, as the generation-6 client does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEP = "/"


def require_types(df: DataFrame) -> DataFrame:
    """Fail when any row lacks ``_type`` (the reference raises IllegalArgumentException)."""
    missing = df.where(F.col("_type").isNull()).limit(1).count()
    if missing:
        raise ValueError("a mapping type is required for get/index/update/delete")
    return df


def fold_types(df: DataFrame) -> DataFrame:
    return df.withColumn("_index", F.concat_ws(SEP, F.col("_index"), F.col("_type"))).drop("_type")


def unfold_types(df: DataFrame) -> DataFrame:
    parts = F.split(F.col("_index"), SEP, 2)
    return df.withColumn("_type", parts.getItem(1)).withColumn("_index", parts.getItem(0))


def with_types(op, *frames: DataFrame, **kwargs):
    """Run a typeless operator on typed frames: fold, apply, unfold every result frame."""
    folded = [fold_types(require_types(f)) if f is not None else None for f in frames]
    res = op(*folded, **kwargs)
    if isinstance(res, DataFrame):
        return unfold_types(res)
    for name in ("table", "items"):
        if hasattr(res, name):
            setattr(res, name, unfold_types(getattr(res, name)))
    return res


def type_filter(df: DataFrame, types: list[str]) -> DataFrame:
    """Search restricted to some types (``where(_type isin ...)``)."""
    return df.where(F.col("_type").isin(list(types)))
