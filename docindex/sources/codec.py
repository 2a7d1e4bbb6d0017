"""JSON codecs as jobs over columns of JSON texts.

The reference decodes one reply at a time on the client. Here a column (or a
file set) of reply/document texts is decoded by ``from_json`` with a fixed
schema and exploded, so decoding is a per-row JVM expression that runs where
the data is. Malformed texts become rejects (never failures).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


CORRUPT = "_corrupt_record"


@dataclass
class Decoded:
    rows: DataFrame     # decoded rows
    rejects: DataFrame  # input rows whose text did not parse


JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"}


def documents_as(df: DataFrame, json_col: str, schema, keep: list[str] | None = None,
                 options: dict | None = None) -> Decoded:
    """Decode JSON bodies to typed columns; malformed rows go to ``rejects``.

    PERMISSIVE parsing with a corrupt-record column: a text that is not valid
    JSON (or not an object) keeps its raw value in ``_corrupt_record``.
    """
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    with_corrupt = T.StructType(st.fields + [T.StructField(CORRUPT, T.StringType())])
    keep = keep or []
    parsed = df.select(*keep, F.col(json_col).alias("_json"),
                       F.from_json(F.col(json_col), with_corrupt,
                                   {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
                                    **JSON_OPTIONS, **(options or {})}).alias("_d"))
    bad = F.col(f"_d.{CORRUPT}").isNotNull() | F.col("_d").isNull()
    rows = parsed.where(~bad).select(*keep, *[F.col(f"_d.{f.name}").alias(f.name) for f in st.fields])
    rejects = parsed.where(bad).select(*keep, F.col("_json").alias(json_col))
    return Decoded(rows, rejects)


def read_documents(spark, path: str, schema) -> Decoded:
    """I1 for files: newline-delimited JSON documents read with a fixed schema.

    Lines are read as text and decoded by ``documents_as``, so a malformed line
    becomes a reject carrying its raw text (``_corrupt_record``).
    """
    res = documents_as(spark.read.text(path), "value", schema)
    return Decoded(res.rows, res.rejects.withColumnRenamed("value", CORRUPT))


# ---------------------------------------------------------------- I2
def bulk_lines(ops: DataFrame, fields: list[str]) -> Column:
    """The NDJSON lines of one op: an action line, then a body line unless it is a delete.

    ``to_json`` drops null fields, so an absent ``_index``/``_id`` is omitted.
    """
    action = F.to_json(F.create_map(F.col("op"), F.struct(F.col("_index").alias("_index"), F.col("_id").alias("_id"))))
    body = F.when(F.col("op") != "delete", F.to_json(F.struct(*[F.col(f) for f in fields])))
    return F.array_compact(F.array(action, body))


def bulk_encode(ops: DataFrame, batch_size: int, fields: list[str] | None = None) -> DataFrame:
    """Ops log -> one NDJSON payload per batch (lines joined by newline, one trailing newline).

    Batches come from the scalable rank (B1). Each batch is assembled from at most
    ``batch_size`` rows, so the per-batch collect is bounded by the caller's size.
    """
    from docindex.operators.rank import batch_numbers
    from docindex.operators.write import META

    fields = fields if fields is not None else [c for c in ops.columns if c not in META]
    numbered = batch_numbers(ops.withColumn("_lines", bulk_lines(ops, fields)), "seq", batch_size)
    grouped = numbered.groupBy("batch_no").agg(
        F.array_sort(F.collect_list(F.struct(F.col("seq"), F.col("_lines")))).alias("_l"),
        F.count(F.lit(1)).alias("ops"))
    payload = F.concat(F.array_join(F.flatten(F.transform("_l", lambda x: x["_lines"])), "\n"), F.lit("\n"))
    return grouped.select("batch_no", "ops", payload.alias("payload"))


# ---------------------------------------------------------------- I3
_SHARDS = T.StructType([
    T.StructField("total", T.IntegerType()), T.StructField("successful", T.IntegerType()),
    T.StructField("failed", T.IntegerType()), T.StructField("failures", T.ArrayType(T.StringType()))])
_BULK_RESULT = T.StructType([
    T.StructField("_index", T.StringType()), T.StructField("_id", T.StringType()),
    T.StructField("_version", T.LongType()), T.StructField("result", T.StringType()),
    T.StructField("_shards", _SHARDS), T.StructField("status", T.IntegerType()),
    T.StructField("error", T.StructType([T.StructField("type", T.StringType()),
                                         T.StructField("reason", T.StringType())]))])
BULK_REPLY = T.StructType([
    T.StructField("took", T.IntegerType()), T.StructField("errors", T.BooleanType()),
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField(op, _BULK_RESULT) for op in ("index", "create", "update", "delete")])))])


#: What each kind of reply must hold to be one, as JSON paths of which one must be there.
REPLY_SHAPES = {"bulk": ("$.items",), "search": ("$.hits",), "get": ("$.docs", "$._id"), "shards": ("$._shards",)}


def is_reply(json_text: Column, kind: str) -> Column:
    """Whether a text is a JSON object of the given reply kind; never null."""
    body = F.try_parse_json(json_text)
    held = F.lit(False)
    for path in REPLY_SHAPES[kind]:
        held = held | F.try_variant_get(body, path, "variant").isNotNull()
    return F.coalesce(F.schema_of_variant(body).startswith("OBJECT") & held, F.lit(False))


def reply_rejects(df: DataFrame, json_col: str, kind: str, keep: list[str] | None = None) -> DataFrame:
    """Texts that the decoder of ``kind`` (bulk, search, get, shards) cannot read: ``keep`` columns and the raw text."""
    return df.where(F.col(json_col).isNotNull() & ~is_reply(F.col(json_col), kind)).select(*(keep or []), F.col(json_col).alias("value"))


def decode_bulk_responses(df: DataFrame, json_col: str, keep: list[str] | None = None) -> DataFrame:
    """Bulk reply texts -> one row per item, in reply order (``pos``).

    Other texts give no row here; ``reply_rejects(df, json_col, "bulk")`` returns them.
    """
    keep = keep or []
    r = df.where(is_reply(F.col(json_col), "bulk")).select(*keep, F.from_json(F.col(json_col), BULK_REPLY).alias("_r"))
    ex = r.select(*keep, F.col("_r.took").alias("took"), F.col("_r.errors").alias("errors"),
                  F.posexplode(F.col("_r.items")).alias("pos", "_it"))
    ops = ("index", "create", "update", "delete")
    op = F.lit(None).cast("string")
    for o in reversed(ops):
        op = F.when(F.col(f"_it.{o}").isNotNull(), F.lit(o)).otherwise(op)
    res = F.coalesce(*[F.col(f"_it.{o}") for o in ops])
    return ex.select(*keep, "took", "errors", F.col("pos").cast("int").alias("pos"), op.alias("op"),
                     res["_index"].alias("_index"), res["_id"].alias("_id"), res["_version"].alias("_version"),
                     res["status"].alias("status"), res["error"]["type"].alias("error_type"),
                     res["result"].alias("result"), res["error"]["reason"].alias("error_reason"),
                     *[res["_shards"][c].alias(f"shards_{c}") for c in ("total", "successful", "failed")])


# ---------------------------------------------------------------- I4 / I5
_HIT = T.StructType([
    T.StructField("_index", T.StringType()), T.StructField("_type", T.StringType()),
    T.StructField("_id", T.StringType()), T.StructField("_score", T.DoubleType()),
    T.StructField("_source", T.StringType())])
SEARCH_REPLY = T.StructType([
    T.StructField("took", T.IntegerType()), T.StructField("timed_out", T.BooleanType()),
    T.StructField("_scroll_id", T.StringType()), T.StructField("aggregations", T.StringType()),
    T.StructField("_shards", _SHARDS),
    T.StructField("hits", T.StructType([
        T.StructField("max_score", T.DoubleType()),
        T.StructField("hits", T.ArrayType(_HIT))]))])


def decode_search_responses(df: DataFrame, json_col: str, keep: list[str] | None = None) -> DataFrame:
    """I4: search reply texts -> hit rows; ``total`` read as a generation-7 object or a generation-5/6 integer.

    A reply with no hits still yields one row (null ``pos``) so its envelope is kept. ``aggregations`` is the JSON text
    of that part (see ``aggregation_buckets``). Other texts give no row; ``reply_rejects`` returns them.
    """
    keep = keep or []
    j = F.col(json_col)
    total = F.coalesce(F.get_json_object(j, "$.hits.total.value"), F.get_json_object(j, "$.hits.total")).cast("long")
    relation = F.coalesce(F.get_json_object(j, "$.hits.total.relation"), F.lit("eq"))
    df = df.where(is_reply(j, "search"))
    r = df.select(*keep, F.from_json(j, SEARCH_REPLY).alias("_r"), total.alias("total"), relation.alias("relation"))
    ex = r.select(*keep, F.col("_r.took").alias("took"), F.col("_r.timed_out").alias("timed_out"),
                  "total", "relation", F.col("_r.hits.max_score").alias("max_score"),
                  F.col("_r._scroll_id").alias("scroll_id"), F.col("_r.aggregations").alias("aggregations"),
                  *[F.col(f"_r._shards.{c}").alias(f"shards_{c}") for c in ("total", "successful", "failed")],
                  F.posexplode_outer(F.col("_r.hits.hits")).alias("pos", "_h"))
    return ex.select(*keep, "took", "timed_out", "total", "relation", "max_score", "scroll_id",
                     F.col("pos").cast("int").alias("pos"),
                     F.col("_h._index").alias("_index"), F.col("_h._id").alias("_id"),
                     F.col("_h._score").alias("_score"), F.col("_h._source").alias("_source"),
                     F.col("_h._type").alias("_type"), "aggregations", "shards_total", "shards_successful", "shards_failed")


def aggregation_buckets(df: DataFrame, name: str, json_col: str = "aggregations", keep: list[str] | None = None) -> DataFrame:
    """Buckets (``key, doc_count``) of the terms aggregation ``name`` in the decoded aggregations text."""
    shape = "struct<buckets:array<struct<key:string,doc_count:bigint>>>"
    part = F.from_json(F.col(json_col), f"map<string,{shape}>")[name]
    return df.where(F.col(json_col).isNotNull()).select(*(keep or []), F.posexplode(part["buckets"]).alias("pos", "_b")).select(
        *(keep or []), "pos", "_b.key", "_b.doc_count")


def hits_as(hits: DataFrame, schema, source_col: str = "_source") -> DataFrame:
    """Typed bodies of hits; all other columns (reply key, ``pos``) kept for order."""
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    keep = [c for c in hits.columns if c != source_col]
    return hits.select(*keep, F.from_json(F.col(source_col), st).alias("_b")).select(
        *keep, *[F.col(f"_b.{f.name}").alias(f.name) for f in st.fields])


# ---------------------------------------------------------------- I6
_GET = T.StructType([
    T.StructField("_index", T.StringType()), T.StructField("_id", T.StringType()),
    T.StructField("_version", T.LongType()), T.StructField("found", T.BooleanType()),
    T.StructField("_source", T.StringType())])
MGET_REPLY = T.StructType([T.StructField("docs", T.ArrayType(_GET))])


def decode_get_responses(df: DataFrame, json_col: str, source_schema=None,
                         keep: list[str] | None = None) -> DataFrame:
    """Get and mget reply texts -> rows; missing docs kept with ``found = false``.

    A single-get reply (an object with ``_id`` at the top) is treated as a
    one-document mget reply, so both shapes decode through the same plan. Other
    texts give no row; ``reply_rejects`` returns them.
    """
    keep = keep or []
    j = F.col(json_col)
    df = df.where(is_reply(j, "get"))
    as_list = F.when(F.get_json_object(j, "$.docs").isNotNull(), j).otherwise(
        F.concat(F.lit('{"docs":['), j, F.lit("]}")))
    r = df.select(*keep, F.from_json(as_list, MGET_REPLY).alias("_r"))
    ex = r.select(*keep, F.posexplode(F.col("_r.docs")).alias("pos", "_d"))
    out = ex.select(*keep, F.col("pos").cast("int").alias("pos"), F.col("_d._index").alias("_index"),
                    F.col("_d._id").alias("_id"), F.col("_d._version").alias("_version"),
                    F.coalesce(F.col("_d.found"), F.lit(False)).alias("found"),
                    F.col("_d._source").alias("_source"))
    return hits_as(out, source_schema) if source_schema is not None else out


# ---------------------------------------------------------------- I7
SHARDS_REPLY = T.StructType([
    T.StructField("_index", T.StringType()),
    T.StructField("_shards", T.StructType([
        T.StructField("total", T.IntegerType()), T.StructField("successful", T.IntegerType()),
        T.StructField("failed", T.IntegerType()),
        T.StructField("failures", T.ArrayType(T.StructType([
            T.StructField("shard", T.IntegerType()), T.StructField("index", T.StringType()),
            T.StructField("reason", T.StringType())])))]))])


def shard_summary(df: DataFrame, json_col: str) -> tuple[DataFrame, DataFrame]:
    """``_shards`` blocks -> (totals per index, one row per failure).

    An absent ``failures`` list counts as empty.
    """
    r = df.where(is_reply(F.col(json_col), "shards")).select(F.from_json(F.col(json_col), SHARDS_REPLY).alias("_r"))
    flat = r.select(F.col("_r._index").alias("_index"), F.col("_r._shards.total").alias("total"),
                    F.col("_r._shards.successful").alias("successful"), F.col("_r._shards.failed").alias("failed"),
                    F.coalesce(F.col("_r._shards.failures"), F.array()).alias("failures"))
    totals = flat.groupBy("_index").agg(
        F.sum("total").cast("long").alias("total"), F.sum("successful").cast("long").alias("successful"),
        F.sum("failed").cast("long").alias("failed"), F.sum(F.size("failures")).cast("long").alias("failures"))
    failures = flat.select("_index", F.explode("failures").alias("_f")).select(
        "_index", F.col("_f.shard").alias("shard"), F.col("_f.reason").alias("reason"))
    return totals, failures


def encode_shards(items: DataFrame, n_shards: int) -> DataFrame:
    """``_shards`` replies of bulk batches (``batch_no, reply``), one for each batch and index, from its item results.

    A shard that an op of the batch went to counts; it has failed if one of its ops has, for the reason of the first.
    A reply lists a few shards, so the grouped lists are bounded by ``n_shards``.
    """
    from docindex.functions.route import shard_of

    placed = items.where("_index IS NOT NULL AND _id IS NOT NULL").withColumn("shard", shard_of(F.col("_id"), n_shards))
    bad = F.when(F.col("status") >= 300, F.col("seq"))
    shards = placed.groupBy("batch_no", "_index", "shard").agg(F.min_by(F.coalesce("error_type", "result"), bad).alias("reason"))
    failed = F.sort_array(F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("shard", F.col("_index").alias("index"), "reason"))))
    lists = shards.groupBy("batch_no", "_index").agg(F.count(F.lit(1)).cast("int").alias("total"), F.count("reason").cast("int").alias("failed"), failed.alias("failures"))
    block = F.struct("total", (F.col("total") - F.col("failed")).alias("successful"), "failed", F.when(F.size("failures") > 0, F.col("failures")).alias("failures"))
    return lists.select("batch_no", F.to_json(F.struct("_index", block.alias("_shards"))).alias("reply"))


# ---------------------------------------------------------------- U1
def map_documents(df: DataFrame, json_col: str, schema, columns: dict, keep: list[str] | None = None, body: str | None = None) -> DataFrame:
    """A user's decode and encode of every document, as expressions.

    The reader is ``schema``: each body is decoded to a typed ``doc`` (null for a text that is no JSON object). ``columns``
    are the user's functions, each from ``doc`` to a column; they run inside the JVM, one after another, so that a later one
    may use an earlier one's column. The writer encodes them back to one JSON body ``body`` if that is named (nulls are
    left out), else they stay columns. ``keep`` columns are passed through.
    """
    out = df.select(*(keep or []), F.from_json(F.col(json_col), schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)).alias("doc"))
    for name, fn in columns.items():
        out = out.withColumn(name, fn(F.col("doc")))
    if body is not None:
        return out.select(*(keep or []), F.to_json(F.struct(*columns)).alias(body))
    return out.drop("doc")
