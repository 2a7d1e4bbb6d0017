"""Tables written to the shared scratch folder: they cut lineage and outlive a lost executor."""

from __future__ import annotations

from pyspark.sql import DataFrame

from docindex.session import scratch_path


def stored(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` as Parquet under the session's checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
