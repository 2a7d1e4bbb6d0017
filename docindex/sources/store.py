"""Documents on plain partitioned Parquet.

Layout under ``root``::

    root/_index=<name>/shard=<n>/part-*.parquet   documents, tombstones included
    root/_settings/part-*.parquet                 kind, name, value: shard count, schema, mappings, templates, aliases

A commit replays a log against the partitions that it can change and replaces those with the DataFrame writer's dynamic
partition overwrite; all others stay as they are. Spark cannot overwrite what it reads, so the new partitions are first
written to a folder of their own (``prepare``) and then from there (``publish``), which can be repeated after a failure.
Every replaced partition holds one filler row without an id, so that a partition that has lost all its documents is
replaced as well; reads leave fillers out.

Plain Parquet has no transactions: a table has one writer at a time, and a reader should not run during a publish. For
concurrent writers keep the documents in a table format instead: the operators take and return DataFrames of any source.

Files are sorted by id, with small row groups, a page index and a Bloom filter on ``_id``: a get, or an mget of keys that
are pushed into the scan (``search.pushed``), reads the row groups and pages that can hold the ids and skips the rest of
a shard.

Reads use the schema in the settings: a field that a later commit added is null in older files, and index names stay
strings whatever they look like.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docindex.functions.route import route, shard_of
from docindex.session import scratch_path

DEFAULT_SHARDS = 4
PARTS = ("_index", "shard")
_SETTINGS = "kind string, name string, value string"
ROW_GROUP_BYTES = 8 << 20
IDS_OF_ROW_GROUP = 50_000  # what a Bloom filter is sized for
_LAYOUT = {"parquet.block.size": str(ROW_GROUP_BYTES), "parquet.bloom.filter.enabled#_id": "true",
           "parquet.bloom.filter.expected.ndv#_id": str(IDS_OF_ROW_GROUP), "parquet.page.row.count.limit": "2000"}


# ---------------------------------------------------------------- settings
def read_if_there(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The Parquet table at a path, or None if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _settings_path(root: str) -> str:
    return f"{root.rstrip('/')}/_settings"


def _load(spark: SparkSession, root: str) -> dict:
    """{(kind, name): value} of a store: a catalog, a row for each name."""
    found = read_if_there(spark, _settings_path(root), _SETTINGS)
    return {(r["kind"], r["name"]): json.loads(r["value"]) for r in found.collect()} if found is not None else {}


def _save(spark: SparkSession, root: str, values: dict) -> None:
    rows = [(kind, name, json.dumps(value)) for (kind, name), value in sorted(values.items())]
    spark.createDataFrame(rows, _SETTINGS).coalesce(1).write.mode("overwrite").parquet(_settings_path(root))


def settings(spark: SparkSession, root: str, kind: str) -> dict:
    """Named settings of a store: kind is mappings, templates or aliases."""
    return {name: value for (k, name), value in _load(spark, root).items() if k == kind}


def put_setting(spark: SparkSession, root: str, kind: str, name: str, change, n_shards: int = DEFAULT_SHARDS) -> None:
    """Keep ``change(current value or None)`` as the setting ``name``; None removes it. The data stays as it is."""
    values = _load(spark, root) or {("store", "n_shards"): n_shards}
    value = change(values.pop((kind, name), None))
    if value is not None:
        values[(kind, name)] = value
    _save(spark, root, values)


def shard_count(spark: SparkSession, root: str, default: int = DEFAULT_SHARDS) -> int:
    """The shard count that the store was created with; ``default`` for a store that is not there yet."""
    return _load(spark, root).get(("store", "n_shards"), default)


def exists(spark: SparkSession, root: str) -> bool:
    """Whether documents were ever written."""
    return ("store", "schema") in _load(spark, root)


def merged_schema(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Fields of both; a field that both have must have one type (evolve the mapping first otherwise)."""
    out = {f.name: f for f in (old.fields if old else [])}
    for f in new.fields:
        if f.name in out and out[f.name].dataType != f.dataType and not isinstance(f.dataType, T.NullType):
            raise ValueError(f"field {f.name} is stored as {out[f.name].dataType.simpleString()}, written as {f.dataType.simpleString()}")
        out.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    return T.StructType([f for f in out.values() if f.name not in PARTS])


def _full_schema(values: dict) -> T.StructType:
    body = T.StructType.fromJson(values[("store", "schema")])
    return T.StructType([*body.fields, T.StructField("_index", T.StringType()), T.StructField("shard", T.IntegerType())])


# ---------------------------------------------------------------- reads
def among(pairs: set) -> Column:
    """Condition on the partition columns: (index, shard) is one of ``pairs`` (prunes folders)."""
    by_index: dict = {}
    for index, shard in sorted(pairs, key=str):
        by_index.setdefault(index, []).append(shard)
    out = F.lit(False)
    for index, shards in by_index.items():
        out = out | ((F.col("_index") == index) & F.col("shard").isin(*shards))
    return out


def read_index(spark: SparkSession, root: str, indices: list[str] | None = None, pairs: set | None = None) -> DataFrame:
    """I8 (read): the documents; an empty list or None means all indices.

    Only the folders of the asked indices (or of the (index, shard) ``pairs``) are read.
    """
    return _read(spark, root, _load(spark, root), indices, pairs)


def _read(spark: SparkSession, root: str, values: dict, indices=None, pairs=None) -> DataFrame:
    if ("store", "schema") not in values:
        raise FileNotFoundError(f"no documents under {root}")
    out = spark.read.schema(_full_schema(values)).parquet(root).where(F.col("_id").isNotNull())
    if indices:
        out = out.where(F.col("_index").isin(*indices))
    return out if pairs is None else out.where(among(pairs))


# ---------------------------------------------------------------- writes
def _overwrite(data: DataFrame, root: str, mode: str = "dynamic") -> None:
    """Replace the partitions that ``data`` holds ("dynamic") or the whole table ("static"), rows in order of their ids."""
    data.sortWithinPartitions(*PARTS, "_id").write.options(**_LAYOUT).mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*PARTS).parquet(root)


def _stage(data: DataFrame, staged: str) -> None:
    """Write new partitions to a folder of their own. AQE splits a hot shard over several writers and merges small ones."""
    _overwrite(data.hint("rebalance", *PARTS), staged, "static")


def _with_fillers(data: DataFrame, pairs: set) -> DataFrame:
    """``data`` and one row without an id for each (index, shard)."""
    rows = data.sparkSession.createDataFrame(sorted(pairs, key=str), "_index string, shard int")
    return data.unionByName(rows, allowMissingColumns=True)


def write_index(df: DataFrame, root: str, n_shards: int | None = None) -> None:
    """I8 (write): ``df`` becomes the whole table. ``n_shards`` defaults to the store's own count.

    Earlier folders of the table are removed by the writer, settings other than the schema stay.
    """
    spark = df.sparkSession
    values = _load(spark, root)
    shards = n_shards or values.get(("store", "n_shards"), DEFAULT_SHARDS)
    staged = scratch_path(spark, "table")
    _stage(route(df.drop("shard"), shards), staged)
    schema = merged_schema(None, df.drop("shard").schema)
    if ("store", "schema") in values:  # partitions that are not in the new table are emptied
        old = {(r["_index"], r["shard"]) for r in _read(spark, root, values).select(*PARTS).distinct().collect()}
    else:
        old = set()
    values.update({("store", "n_shards"): shards, ("store", "schema"): schema.jsonValue()})
    _overwrite(_with_fillers(spark.read.schema(_full_schema(values)).parquet(staged), old), root)
    _save(spark, root, values)


def _routing(df: DataFrame) -> Column:
    return F.coalesce(*[F.col(c) for c in ("_routing", "_parent", "_id") if c in df.columns])


def touched_pairs(spark: SparkSession, root: str, ops: DataFrame, values: dict) -> set:
    """(index, shard) pairs that a log can change: where its ops are routed, and where its keys are stored now.

    The second part is needed as an op may lack the routing that its document was stored with. It reads the
    key columns of the log's indices only, and only if the store has routed documents. Bounded by indices x shards.
    Keys meet by their hashes, so that no id is shuffled; a collision would rewrite a partition more.
    """
    from docindex.operators import write as W

    own = ops.select("_index", shard_of(_routing(ops), values[("store", "n_shards")]).alias("shard")).distinct()
    found = {(r["_index"], r["shard"]) for r in own.collect() if r["shard"] is not None and r["_index"] is not None}  # others fail
    if ("store", "schema") not in values:
        return found
    stored = _read(spark, root, values, sorted({i for i, _ in found}))
    if found and {"_routing", "_parent"} & set(stored.columns):
        keys = ops.where("_index IS NOT NULL AND _id IS NOT NULL").select(W.key_hash().alias("_h")).distinct()
        at = stored.select("_index", "shard", W.key_hash().alias("_h")).join(keys, "_h", "left_semi").select("_index", "shard").distinct()
        found |= {(r["_index"], r["shard"]) for r in at.collect()}
    return found


def prepare(spark: SparkSession, root: str, ops: DataFrame, staged: str, n_shards: int | None = None, on_items=None, apply=None,
            undo: str | None = None, chunk_rows: int | None = None) -> None:
    """Replay a log against the stored table; the new partitions go to the folder ``staged``, the table stays as it is.

    ``on_items`` gets the item results. ``apply(table, ops)`` replaces the replay, for writes with their own versions.
    The stored rows of the log's keys are written to ``undo`` (keys that were not stored have a null version there).
    """
    from docindex.operators import write as W

    before = _load(spark, root)
    values = {("store", "n_shards"): n_shards or DEFAULT_SHARDS, **before}
    pairs = touched_pairs(spark, root, ops, values)
    has_data = ("store", "schema") in values
    table = _read(spark, root, values, pairs=pairs).drop("shard") if has_data else None
    kept: list = []

    def keep(rows: DataFrame) -> DataFrame:
        kept.append(rows.persist())  # read by the items and by the table; a lost block is computed again from the unchanged table
        return kept[-1]

    res = apply(table, ops) if apply else W.bulk_replay(table, ops, keep_rows=keep, **({"chunk_rows": chunk_rows} if chunk_rows else {}))
    if on_items is not None:
        on_items(res.items)
    if undo is not None:
        keys = ops.where("_index IS NOT NULL AND _id IS NOT NULL").select("_index", "_id").distinct()
        old = keys.join(table, ["_index", "_id"], "left") if table is not None else keys.withColumn("_version", F.lit(None).cast("long"))
        old.write.parquet(undo)
    new = route(res.table, values[("store", "n_shards")])
    schema = merged_schema(T.StructType.fromJson(values[("store", "schema")]) if has_data else None, new.schema)
    _stage(_with_fillers(new, pairs), staged)
    for rows in kept:
        rows.unpersist()
    values[("store", "schema")] = schema.jsonValue()
    if values != before:
        _save(spark, staged, values)


def publish(spark: SparkSession, root: str, staged: str) -> None:
    """Put prepared partitions in place. Doing it again gives the same table."""
    changed = _load(spark, staged)
    if changed:
        _save(spark, root, changed)
    values = changed or _load(spark, root)
    _overwrite(spark.read.schema(_full_schema(values)).parquet(staged), root)


def commit_replay(spark: SparkSession, root: str, ops: DataFrame, n_shards: int | None = None, chunk_rows: int | None = None,
                  default_index: str | None = None, apply=None, undo: str | None = None) -> DataFrame:
    """Apply an ops log to the stored table, reading and rewriting only the partitions it touches; returns the item results."""
    from docindex.operators import write as W

    staged, items = scratch_path(spark, "staged"), scratch_path(spark, "items")
    prepare(spark, root, W._prepare_ops(ops, None, default_index), staged, n_shards, lambda df: df.write.parquet(items), apply, undo, chunk_rows)
    publish(spark, root, staged)
    return spark.read.parquet(items)


# ---------------------------------------------------------------- X1 / X2
def index_stats(table: DataFrame, body: list[str] | None = None) -> DataFrame:
    """Per index: live docs, deleted docs, body bytes of live docs, max version."""
    body = body or [c for c in table.columns if not c.startswith("_") and c != "shard"]
    size = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in body])))
    return table.groupBy("_index").agg(
        F.count_if(~F.col("_deleted")).alias("live_docs"),
        F.count_if(F.col("_deleted")).alias("deleted_docs"),
        F.coalesce(F.sum(F.when(~F.col("_deleted"), size)), F.lit(0)).cast("long").alias("body_bytes"),
        F.max("_version").alias("max_version"))


def compact(spark: SparkSession, root: str, max_files: int | None = None, expunge_only: bool = False) -> None:
    """Rewrite the table without its tombstones; live rows are unchanged.

    Files get the session's advisory partition size (a hot shard is written by several tasks), or with ``max_files`` at
    most that many a shard. With ``expunge_only`` only partitions that hold tombstones are rewritten. Dropping a
    tombstone forgets its version: a later write of that id starts at 1.
    """
    values = _load(spark, root)
    table = _read(spark, root, values)
    if expunge_only:
        table = table.where(F.col("_deleted"))
    pairs = {(r["_index"], r["shard"]) for r in table.select(*PARTS).distinct().collect()}  # one row a partition
    if not pairs:
        return
    live = _read(spark, root, values, pairs=pairs).where(~F.col("_deleted"))
    staged = scratch_path(spark, "compacted")
    whole = _with_fillers(live, pairs)
    if max_files is None:
        _stage(whole, staged)
    else:  # at most max_files tasks write each partition: hash the id into max_files buckets (the filler's is one of them)
        _overwrite(whole.repartition(*PARTS, F.pmod(F.xxhash64("_id"), F.lit(max_files))), staged, "static")
    _overwrite(spark.read.schema(_full_schema(values)).parquet(staged), root)
