"""Document writes: ops-log replay and the single-op write calls.

Data shapes
-----------
``doc_table``: ``_index, _id, _version, _deleted`` + body fields (optionally
``_routing, _parent, _seq, shard``). Tombstones stay (``_deleted = true``) so a
later write continues the version count.

``ops``: ``_index, _id, seq, op`` + body fields, ``op`` in
index/create/update/delete, ``seq`` unique per key (its log position).

Replay semantics (``bulk_replay`` / ``bulk_item_results``), per key in ``seq`` order
----------------------------------------------------------------------------
* index: always succeeds, replaces the body; 201 if the doc did not exist, else 200.
* create: succeeds (201) only if the doc does not exist, else 409
  ``version_conflict_engine_exception`` and nothing changes.
* update: merges its non-null fields over the body (200), 404
  ``document_missing_exception`` if the doc does not exist. Null means absent.
* delete: 200 and a tombstone if the doc exists, else 404 ``not_found``.
* every success adds 1 to the version; failures and noops do not (tier P).

How it runs at scale (no UDF, no per-key collect)
-------------------------------------------------
A key's ops are cut into chunks ``floor(seq / chunk_rows)``, so one task never
holds more than ``chunk_rows`` ops of one key however hot the key is. Existence
before an op depends only on the last index/create/delete before it (``eff``),
never on whether that op succeeded, so each chunk is evaluated once per possible
entry state (exists / not) with windows over ``(key, chunk)``. A tiny per-chunk
summary is folded across chunks with a window over ``(key)`` on the summary
rows only (one row per key-chunk), seeded from the stored row, and joined back.
The final body per key is an aggregate (partial aggregation before the shuffle)
that picks, per field, the last contributing value of the last segment that
starts at a reset (successful index/create or a delete).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["_index", "_id"]
OPS = ("index", "create", "update", "delete")
CHUNK_ROWS = 1 << 20  # ops of one key evaluated together in one task, at most
REPLAY_BROADCAST_KEYS = 2_000_000  # distinct touched keys that may be broadcast against the stored table
META = {"_index", "_id", "seq", "op", "_version", "_deleted", "_seq", "shard", "version",
        "version_type", "routing", "parent", "pos", "batch_no"}

PLACE = ("_routing", "_parent")  # what a document is routed by, before its id

# Fixed values of the item contract: error types and HTTP-style statuses.
ERR_CONFLICT = "version_conflict_engine_exception"
ERR_MISSING = "document_missing_exception"
ERR_PARSING = "mapper_parsing_exception"
ERR_REQUEST = "action_request_validation_exception"
STATUS_OK, STATUS_CREATED, STATUS_BAD, STATUS_NOT_FOUND, STATUS_CONFLICT = 200, 201, 400, 404, 409


@dataclass
class ReplayResult:
    table: DataFrame  # new doc_table
    items: DataFrame  # one row per op: seq, op, _index, _id, _version, status, result, error_type


def body_fields(ops: DataFrame, table: DataFrame | None = None) -> list[str]:
    fields = [c for c in ops.columns if c not in META]
    if table is not None:
        # A stored document's own columns come along, routing and parent included.
        fields += [c for c in table.columns if c not in META and c not in fields]
    return fields


def empty_table(ops: DataFrame, fields: list[str]) -> DataFrame:
    """A doc_table with no rows and the body types of ``ops``."""
    spark = ops.sparkSession
    proto = ops.select(
        F.col("_index"), F.col("_id"), F.lit(0).cast("long").alias("_version"),
        F.lit(False).alias("_deleted"), F.lit(0).cast("long").alias("_seq"),
        *[F.col(f) for f in fields])
    return spark.createDataFrame([], proto.schema)


def _chunk_of(chunk_rows: int) -> Column:
    """Chunk number of an op: ``seq div chunk_rows`` (integer arithmetic, exact for any long)."""
    return F.expr(f"seq div {int(chunk_rows)}")


def _eff(op: Column) -> Column:
    return (F.when(op.isin("index", "create"), F.lit(True))
            .when(op == "delete", F.lit(False)))


def _succ(op: Column, before: Column) -> Column:
    return (F.when(op == "index", F.lit(True))
            .when(op == "create", ~before)
            .when(op.isin("update", "delete"), before)
            .otherwise(F.lit(False)))


def _reset(op: Column, succ: Column) -> Column:
    return (op == "index") | (op == "delete") | ((op == "create") & succ)


def _stored_state(table: DataFrame) -> DataFrame:
    return table.select(*KEY, (~F.col("_deleted")).alias("_st_exists"), F.col("_version").alias("_st_version"))


@dataclass
class LogStats:
    rows: int
    lo: int | None
    hi: int | None
    keyless: int = 0


def _no_key() -> Column:
    return F.col("_index").isNull() | F.col("_id").isNull()


def log_stats(ops: DataFrame) -> LogStats:
    """Row count, ``seq`` range and number of ops without a key of a log in one small aggregate."""
    r = ops.agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.count_if(_no_key()).alias("k")).collect()[0]
    return LogStats(r["n"], r["lo"], r["hi"], r["k"])


def split_keyless(ops: DataFrame, stats: LogStats) -> tuple[DataFrame, DataFrame | None]:
    """(ops that name a document, items of the others or None).

    An op without a key touches nothing, so it needs no evaluation and takes no part in a join on the key: without an
    index it is refused (400); an update or delete without an id finds no document (404). Index and create ops have
    their id by now.
    """
    if not stats.keyless:
        return ops, None
    op, placed = F.col("op"), F.col("_index").isNotNull()
    items = ops.where(_no_key()).select(
        "seq", "op", *KEY, F.lit(None).cast("long").alias("_version"),
        F.when(placed, STATUS_NOT_FOUND).otherwise(STATUS_BAD).cast("int").alias("status"),
        F.when(placed & (op == "delete"), F.lit("not_found")).alias("result"),
        F.when(~placed, F.lit(ERR_REQUEST)).when(op == "update", F.lit(ERR_MISSING)).alias("error_type"))
    return ops.where(~_no_key()), items


def _with_items(items: DataFrame, more: DataFrame | None) -> DataFrame:
    return items if more is None else items.unionByName(more.select(*items.columns))


def split_touched(table: DataFrame, ops: DataFrame,
                  n_rows: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(stored rows whose key the log touches, the untouched rest or None).

    With a key set within ``REPLAY_BROADCAST_KEYS`` the split is a broadcast
    semi-join and anti-join: the stored table is not shuffled and untouched rows
    pass through as they are. The bound is proven by the log's row count when
    given (distinct keys never exceed rows), else by counting distinct keys.
    Beyond it the caller's key-partitioned joins take the whole table (None).
    """
    keys = ops.select(*KEY).distinct()
    if (n_rows is not None and n_rows <= REPLAY_BROADCAST_KEYS) or keys.count() <= REPLAY_BROADCAST_KEYS:
        bk = F.broadcast(keys)
        return table.join(bk, KEY, "left_semi"), table.join(bk, KEY, "left_anti")
    return table, None


def key_hash() -> Column:
    """Eight bytes for a key: keys with different hashes are different, equal hashes only may be the same key."""
    return F.xxhash64(*KEY)


def split_lone(table: DataFrame, ops: DataFrame, stats: LogStats) -> tuple[DataFrame, DataFrame | None, DataFrame, DataFrame | None]:
    """(ops to replay, lone ops or None, stored rows that the replay needs, the untouched rest or None).

    A lone op is the only one of its key, and the key is not stored: it is evaluated by itself, so neither its id nor its
    body is shuffled. The proof is a count of key hashes over log and table. Hashes of several ops, or of an op and a
    stored row, go the long way with all their ops, so a collision costs time only; an op without a position does too.
    Within ``REPLAY_BROADCAST_KEYS`` rows, or with more such hashes than that, there is no such split.
    """
    if stats.rows <= REPLAY_BROADCAST_KEYS:
        return ops, None, *split_touched(table, ops, stats.rows)
    from docindex.operators.rank import materialize

    seen = ops.select(key_hash().alias("_h"), F.lit(1).alias("n"), F.col("seq").isNull().alias("met")).unionByName(
        table.where(~_no_key()).select(key_hash().alias("_h"), F.lit(0).alias("n"), F.lit(True).alias("met")))
    shared = materialize(seen.groupBy("_h").agg(F.sum("n").alias("n"), F.max("met").alias("met"))
                         .where((F.col("n") > 1) | ((F.col("n") > 0) & F.col("met"))).select("_h", "n"), "shared-keys")
    r = shared.agg(F.count(F.lit(1)).alias("hashes"), F.sum("n").alias("ops")).collect()[0]
    if r["hashes"] > REPLAY_BROADCAST_KEYS:
        return ops, None, table, None
    among = F.broadcast(shared.select("_h"))

    def part(rows: DataFrame, how: str) -> DataFrame:
        return rows.withColumn("_h", key_hash()).join(among, "_h", how).drop("_h")

    touched, untouched = part(table, "left_semi"), part(table, "left_anti")
    if (r["ops"] or 0) == stats.rows - stats.keyless:
        return ops, None, touched, untouched
    return part(ops, "left_semi"), part(ops, "left_anti"), touched, untouched


def _evaluate_lone(ops: DataFrame) -> DataFrame:
    """What ``_evaluate`` gives for ops whose key has no other op and is not stored."""
    succ = _succ(F.col("op"), F.lit(False))
    return ops.withColumn("exists_before", F.lit(False)).withColumn("succ", succ).withColumn("version", succ.cast("long"))


def with_lone(final: DataFrame, rows: DataFrame | None) -> DataFrame:
    """``final`` plus the documents that lone ops wrote."""
    if rows is None:
        return final
    meta = {"_version": F.col("version"), "_deleted": F.lit(False), "_seq": F.col("seq")}
    return final.unionByName(rows.where("succ").select(*[meta.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in final.schema]))


def with_untouched(final: DataFrame, untouched: DataFrame | None) -> DataFrame:
    """``final`` plus the untouched stored rows, projected onto ``final``'s columns."""
    if untouched is None:
        return final
    ucols = set(untouched.columns)
    return untouched.select(*[F.col(c) if c in ucols else F.lit(None).cast(final.schema[c].dataType).alias(c)
                              for c in final.columns]).unionByName(final)


def _single_chunk(stats: LogStats, chunk_rows: int) -> bool:
    """True when every op falls in one chunk."""
    return stats.lo is None or (stats.lo // chunk_rows) == (stats.hi // chunk_rows)


def _evaluate(table: DataFrame, ops: DataFrame, chunk_rows: int, stats: LogStats | None = None) -> DataFrame:
    """Per-op rows with exact ``exists_before, succ, version, seg`` (see module doc)."""
    op = F.col("op")
    single = _single_chunk(stats or log_stats(ops), chunk_rows)
    o = ops.withColumn("_eff", _eff(op)).withColumn("_chunk", _chunk_of(chunk_rows))
    # One chunk: windows per key, and the stored state is the only carry (no summary fold).
    w = Window.partitionBy(*KEY).orderBy("seq") if single else Window.partitionBy(*KEY, "_chunk").orderBy("seq")
    before_rows = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    o = o.withColumn("_prev", F.last("_eff", ignorenulls=True).over(before_rows))
    for tag, entry in (("T", True), ("F", False)):
        before = F.coalesce(F.col("_prev"), F.lit(entry))
        o = o.withColumn(f"_succ{tag}", _succ(op, before))
        o = o.withColumn(f"_rst{tag}", _reset(op, F.col(f"_succ{tag}")))
    for tag in ("T", "F"):
        o = (o.withColumn(f"_cnt{tag}", F.sum(F.col(f"_succ{tag}").cast("long")).over(upto))
             .withColumn(f"_seg{tag}", F.sum(F.col(f"_rst{tag}").cast("long")).over(upto)))

    if single:
        st = _stored_state(table)
        e = F.coalesce(F.col("_st_exists"), F.lit(False))
        base = F.coalesce(F.col("_st_version"), F.lit(0).cast("long"))
        return (o.join(st, KEY, "left")
                .withColumn("_entry", e)
                .withColumn("exists_before", F.coalesce(F.col("_prev"), e))
                .withColumn("succ", F.when(e, F.col("_succT")).otherwise(F.col("_succF")))
                .withColumn("version", base + F.when(e, F.col("_cntT")).otherwise(F.col("_cntF")))
                .withColumn("seg", F.when(e, F.col("_segT")).otherwise(F.col("_segF"))))

    summary = o.groupBy(*KEY, "_chunk").agg(
        F.max_by("_eff", F.when(F.col("_eff").isNotNull(), F.col("seq"))).alias("_last_eff"),
        F.max("_cntT").alias("_totT"), F.max("_cntF").alias("_totF"),
        F.max("_segT").alias("_rsT"), F.max("_segF").alias("_rsF"))
    summary = summary.join(_stored_state(table), KEY, "left")
    wc = Window.partitionBy(*KEY).orderBy("_chunk")
    before_chunks = wc.rowsBetween(Window.unboundedPreceding, -1)
    carry = (summary
             .withColumn("_entry", F.coalesce(F.last("_last_eff", ignorenulls=True).over(before_chunks),
                                              F.col("_st_exists"), F.lit(False)))
             .withColumn("_c_cnt", F.when(F.col("_entry"), F.col("_totT")).otherwise(F.col("_totF")))
             .withColumn("_c_rst", F.when(F.col("_entry"), F.col("_rsT")).otherwise(F.col("_rsF")))
             .withColumn("_base_cnt", F.coalesce(F.col("_st_version"), F.lit(0).cast("long"))
                         + F.coalesce(F.sum("_c_cnt").over(before_chunks), F.lit(0).cast("long")))
             .withColumn("_base_rst", F.coalesce(F.sum("_c_rst").over(before_chunks), F.lit(0).cast("long")))
             .select(*KEY, "_chunk", "_entry", "_base_cnt", "_base_rst", "_st_exists"))

    e = F.col("_entry")
    rows = (o.join(carry, [*KEY, "_chunk"], "inner")
            .withColumn("exists_before", F.coalesce(F.col("_prev"), e))
            .withColumn("succ", F.when(e, F.col("_succT")).otherwise(F.col("_succF")))
            .withColumn("version", F.col("_base_cnt") + F.when(e, F.col("_cntT")).otherwise(F.col("_cntF")))
            .withColumn("seg", F.col("_base_rst") + F.when(e, F.col("_segT")).otherwise(F.col("_segF"))))
    return rows


def _items(rows: DataFrame) -> DataFrame:
    op, ok, before = F.col("op"), F.col("succ"), F.col("exists_before")
    status = (F.when(op == "index", F.when(before, STATUS_OK).otherwise(STATUS_CREATED))
              .when(op == "create", F.when(ok, STATUS_CREATED).otherwise(STATUS_CONFLICT))
              .otherwise(F.when(ok, STATUS_OK).otherwise(STATUS_NOT_FOUND)))
    result = (F.when(op == "index", F.when(before, "updated").otherwise("created"))
              .when(op == "create", F.when(ok, "created"))
              .when(op == "update", F.when(ok, "updated"))
              .when(op == "delete", F.when(ok, "deleted").otherwise("not_found")))
    err = (F.when((op == "create") & ~ok, F.lit(ERR_CONFLICT))
           .when((op == "update") & ~ok, F.lit(ERR_MISSING)))
    return rows.select("seq", "op", *KEY,
                       F.when(ok, F.col("version")).alias("_version"),
                       status.cast("int").alias("status"), result.alias("result"),
                       err.alias("error_type"))


def _final(table: DataFrame, rows: DataFrame, fields: list[str], given: bool = False) -> DataFrame:
    """The touched documents after the log. With ``given`` versions the last op's counts, else the greatest."""
    op, ok = F.col("op"), F.col("succ")
    contrib = ok & op.isin("index", "create", "update")
    aggs = [
        F.max_by(F.coalesce(F.col("_eff"), F.col("exists_before")), F.col("seq")).alias("_n_exists"),
        (F.max_by("version", "seq") if given else F.max("version")).alias("_n_version"),
        F.max("seg").alias("_n_seg"),
        F.max(F.when(ok, F.col("seq"))).alias("_n_seq"),
    ]
    for f in fields:
        has = contrib & F.col(f).isNotNull()
        pick = F.max_by(F.struct(has.alias("h"), F.col(f).alias("v")),
                        F.struct(F.col("seg"), has, F.col("seq")))
        aggs.append(pick.alias(f"_p_{f}"))
        if f in PLACE:
            aggs.append(F.max_by(F.col(f), F.when(F.col(f).isNotNull(), F.col("seq"))).alias(f"_q_{f}"))
    final = rows.groupBy(*KEY).agg(*aggs)

    t_cols = set(table.columns)
    stored = table.select(*KEY, *[F.col(c).alias(f"_s{c}") for c in table.columns if c not in KEY])
    j = stored.join(final, KEY, "full_outer")
    touched = F.col("_n_version").isNotNull()
    out = [*KEY,
           F.when(touched, F.col("_n_version")).otherwise(F.col("_s_version")).alias("_version"),
           F.when(touched, ~F.col("_n_exists")).otherwise(F.col("_s_deleted")).alias("_deleted"),
           F.when(touched, F.coalesce(F.col("_n_seq"), F.col("_s_seq") if "_seq" in t_cols else F.lit(None)))
           .otherwise(F.col("_s_seq") if "_seq" in t_cols else F.lit(None)).cast("long").alias("_seq")]
    for f in fields:
        chosen = F.when(F.col(f"_p_{f}.h"), F.col(f"_p_{f}.v"))
        if f in t_cols:
            new_val = F.when(F.col("_n_seg") == 0, F.coalesce(chosen, F.col(f"_s{f}"))).otherwise(chosen)
            val = F.when(touched, F.when(F.col("_n_exists"), new_val)).otherwise(F.col(f"_s{f}"))
        else:
            val = F.when(touched & F.col("_n_exists"), chosen)
        if f in PLACE:  # a tombstone stays in the shard of its document
            last = F.coalesce(F.col(f"_q_{f}"), F.col(f"_s{f}")) if f in t_cols else F.col(f"_q_{f}")
            val = F.when(touched & ~F.col("_n_exists"), last).otherwise(val)
        out.append(val.alias(f))
    res = j.select(*out)
    # A key that never existed (only failed ops) leaves no row.
    return res if given else res.where(F.col("_version") > 0)


def _prepare_ops(ops: DataFrame, table: DataFrame | None, default_index: str | None) -> DataFrame:
    """Every op with an index, a log position and, where it may have one, an id.

    ``routing`` and ``parent`` arguments become the document's ``_routing`` and ``_parent``.
    """
    if default_index is not None:
        ops = default_index_of(ops, default_index)
    for name in ("routing", "parent"):
        if name in ops.columns:
            given = F.col(name).cast("string")
            ops = ops.withColumn(f"_{name}", F.coalesce(F.col(f"_{name}"), given) if f"_{name}" in ops.columns else given).drop(name)
    if "_id" not in ops.columns:
        ops = ops.withColumn("_id", F.lit(None).cast("string"))
    if "seq" not in ops.columns:
        # Arrival order: positions are fixed once written, so a re-run task cannot renumber ops.
        from docindex.operators.rank import materialize

        ops = materialize(ops.withColumn("seq", F.monotonically_increasing_id()), "ops-seq")
    # POST path: index/create ops without an id get their W2 id; an id-less update or delete stays keyless and
    # fails as a missing document.
    auto = F.when(F.col("op").isin("index", "create"),
                  F.sha2(F.concat_ws("|", F.col("_index"), F.col("seq").cast("string")), 256))
    return ops.withColumn("_id", F.coalesce(F.col("_id"), auto))


def bulk_replay(table: DataFrame | None, ops: DataFrame, chunk_rows: int = CHUNK_ROWS,
                default_index: str | None = None, keep_rows=None) -> ReplayResult:
    """W8 + W9: apply a mixed ops log in ``seq`` order to ``table``.

    Returns the new doc_table (untouched stored rows pass through unchanged) and
    the per-op item results. ``table`` may be None (empty index). ``keep_rows``
    (a function of a frame) may persist or write the evaluated op rows, so that
    writing both the table and the items does not evaluate them twice.
    """
    table, ops, fields = _aligned(table, _prepare_ops(ops, table, default_index))
    # Only stored rows whose key the log touches take part in the replay. With a
    # counted, bounded key set the split is two broadcast joins (the stored table is
    # not shuffled and untouched rows pass through as they are); beyond the bound
    # the replay's own key-partitioned joins handle the whole table. Of a large log,
    # new documents that are written once take no part either.
    stats = log_stats(ops)
    ops, keyless = split_keyless(ops, stats)
    ops, lone, table, untouched = split_lone(table, ops, stats)
    rows = _evaluate(table, ops, chunk_rows, stats)
    lone = _evaluate_lone(lone) if lone is not None else None
    if keep_rows is not None:
        rows, lone = keep_rows(rows), keep_rows(lone) if lone is not None else None
    items = _with_items(_items(rows), _items(lone) if lone is not None else None)
    return ReplayResult(with_lone(with_untouched(_final(table, rows, fields), untouched), lone), _with_items(items, keyless))


def _aligned(table: DataFrame | None, ops: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """(table, ops, body fields), every field a column of the ops."""
    fields = body_fields(ops, table)
    if table is None:
        table = empty_table(ops, [f for f in fields if f in ops.columns])
    for f in fields:
        if f not in ops.columns:
            ops = ops.withColumn(f, F.lit(None).cast(table.schema[f].dataType))
    return table, ops, fields


def visible_at(ops: DataFrame, refresh_seq: int, table: DataFrame | None = None) -> DataFrame:
    """Live documents as of the last refresh: the replay of the log up to ``refresh_seq``.

    A search reads this (an as-of replay), while a get reads the full replay.
    """
    state = bulk_replay(table, ops.where(F.col("seq") <= refresh_seq)).table
    return state.where(~F.col("_deleted"))


def validate_log(ops: DataFrame) -> DataFrame:
    """Ops whose ``seq`` repeats within their key (their order is undefined).

    The replay requires ``seq`` unique per key; run this on untrusted input and
    refuse the log when it returns rows. It is a grouped count (partial
    aggregation), so it is not run on every replay.
    """
    dup = ops.groupBy(*KEY, "seq").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return ops.join(dup.select(*KEY, "seq"), [*KEY, "seq"], "left_semi")


def bulk_item_results(table: DataFrame | None, ops: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per-op status rows (input order via ``seq``)."""
    return bulk_replay(table, ops, chunk_rows).items


def _as_ops(delta: DataFrame, op: str) -> DataFrame:
    return delta.withColumn("op", F.lit(op))


def index_docs(table: DataFrame | None, delta: DataFrame, chunk_rows: int = CHUNK_ROWS) -> ReplayResult:
    """Upsert by key; whole body replaced; version 1 on first write, +1 after."""
    return bulk_replay(table, _as_ops(delta, "index"), chunk_rows)


def create_docs(table: DataFrame | None, delta: DataFrame, chunk_rows: int = CHUNK_ROWS) -> ReplayResult:
    """Insert only when absent; otherwise a 409 item and no change."""
    return bulk_replay(table, _as_ops(delta, "create"), chunk_rows)


def update_docs(table: DataFrame, delta: DataFrame, detect_noop: bool = False,
                chunk_rows: int = CHUNK_ROWS) -> ReplayResult:
    """Partial bodies merged over stored ones; missing key -> 404.

    With ``detect_noop`` an update whose every non-null field already holds that
    value is a noop: status 200, result ``noop``, version unchanged (tier P).
    """
    ops = _as_ops(delta, "update")
    if not detect_noop:
        return bulk_replay(table, ops, chunk_rows)
    return _update_with_noop(table, ops, chunk_rows)


def delete_docs(table: DataFrame, ids: DataFrame, chunk_rows: int = CHUNK_ROWS) -> ReplayResult:
    """Tombstone by key; a later get finds nothing; the item reports the id."""
    return bulk_replay(table, _as_ops(ids, "delete"), chunk_rows)


def default_index_of(ops: DataFrame, name: str) -> DataFrame:
    """Ops lacking ``_index`` take the caller's index."""
    if "_index" not in ops.columns:
        return ops.withColumn("_index", F.lit(name))
    return ops.withColumn("_index", F.coalesce(F.col("_index"), F.lit(name)))


default_index = default_index_of  # SURVEY name (W10)


def with_auto_ids(delta: DataFrame, seq_col: str = "seq") -> DataFrame:
    """Rows without ``_id`` get a deterministic one (tier P for the value).

    SHA-256 of the index name and the op's log position, which is unique in the
    log: a retried batch produces the same ids (idempotent), unlike a random UUID.
    """
    auto = F.sha2(F.concat_ws("|", F.col("_index"), F.col(seq_col).cast("string")), 256)
    return delta.withColumn("_id", F.coalesce(F.col("_id"), auto))


# ---------------------------------------------------------------- W4 noop
def _update_with_noop(table: DataFrame, ops: DataFrame, chunk_rows: int) -> ReplayResult:
    """Updates only: existence never changes, so success = stored row is live.

    An update is a noop when each of its non-null fields equals the value in
    effect before it: the last non-null value of that field among earlier
    updates of the key, else the stored value. Per-field "last non-null before"
    is a window inside ``(key, chunk)`` plus a carried value from earlier chunks.
    """
    fields = [f for f in body_fields(ops, None)]
    stats = log_stats(ops)
    ops, keyless = split_keyless(ops, stats)
    table, untouched = split_touched(table, ops, stats.rows)
    o = ops.withColumn("_chunk", _chunk_of(chunk_rows))
    w = Window.partitionBy(*KEY, "_chunk").orderBy("seq")
    before_rows = w.rowsBetween(Window.unboundedPreceding, -1)
    for f in fields:
        o = o.withColumn(f"_lp_{f}", F.last(f, ignorenulls=True).over(before_rows))
    summ = o.groupBy(*KEY, "_chunk").agg(
        *[F.max_by(f, F.when(F.col(f).isNotNull(), F.col("seq"))).alias(f"_cl_{f}") for f in fields])
    st = table.select(*KEY, (~F.col("_deleted")).alias("_st_exists"), F.col("_version").alias("_st_version"),
                      *[F.col(f).alias(f"_st_{f}") for f in fields if f in table.columns])
    wc = Window.partitionBy(*KEY).orderBy("_chunk")
    prev_chunks = wc.rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.join(st, KEY, "left")
    for f in fields:
        seed = F.col(f"_st_{f}") if f in table.columns else F.lit(None)
        carry = carry.withColumn(f"_cv_{f}", F.coalesce(F.last(f"_cl_{f}", ignorenulls=True).over(prev_chunks), seed))
    carry = carry.select(*KEY, "_chunk", F.coalesce("_st_exists", F.lit(False)).alias("_live"),
                         F.coalesce("_st_version", F.lit(0).cast("long")).alias("_v0"),
                         *[f"_cv_{f}" for f in fields])
    rows = o.join(carry, [*KEY, "_chunk"], "inner")
    same = F.lit(True)
    for f in fields:
        prior = F.coalesce(F.col(f"_lp_{f}"), F.col(f"_cv_{f}"))
        same = same & (F.col(f).isNull() | F.col(f).eqNullSafe(prior))
    rows = rows.withColumn("_noop", F.col("_live") & same)
    rows = rows.withColumn("_bump", (F.col("_live") & ~F.col("_noop")).cast("long"))
    # Running count of real changes: within-chunk window plus the count of earlier chunks.
    cnt_chunk = rows.groupBy(*KEY, "_chunk").agg(F.sum("_bump").alias("_cb"))
    cnt_carry = cnt_chunk.withColumn("_cb0", F.coalesce(F.sum("_cb").over(prev_chunks), F.lit(0).cast("long")))
    rows = rows.join(cnt_carry.select(*KEY, "_chunk", "_cb0"), [*KEY, "_chunk"], "inner")
    rows = rows.withColumn("version", F.col("_v0") + F.col("_cb0")
                           + F.sum("_bump").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    items = rows.select(
        "seq", "op", *KEY,
        F.when(F.col("_live"), F.col("version")).alias("_version"),
        F.when(F.col("_live"), 200).otherwise(404).cast("int").alias("status"),
        F.when(F.col("_noop"), "noop").when(F.col("_live"), "updated").alias("result"),
        F.when(~F.col("_live"), F.lit(ERR_MISSING)).alias("error_type"))
    # Final table: an update-only log never resets a document, so each field is its
    # last non-null update value, else the stored one (noops hold equal values).
    live = rows.where("_live")
    changes = live.groupBy(*KEY).agg(
        F.max("version").alias("_nv"), F.max(F.when(~F.col("_noop"), F.col("seq"))).alias("_nseq"),
        *[F.max_by(f, F.when(F.col(f).isNotNull(), F.col("seq"))).alias(f"_u_{f}") for f in fields])
    merged = table.join(changes, KEY, "left")
    cols = []
    for c in table.columns:
        if c == "_version":
            cols.append(F.coalesce(F.col("_nv"), F.col(c)).alias(c))
        elif c == "_seq":
            cols.append(F.coalesce(F.col("_nseq"), F.col(c)).alias(c))
        elif c in fields:
            cols.append(F.coalesce(F.col(f"_u_{c}"), F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    cols += [F.col(f"_u_{f}").alias(f) for f in fields if f not in table.columns]
    new_table = merged.select(*cols)
    return ReplayResult(with_untouched(new_table, untouched), _with_items(items, keyless))


# ---------------------------------------------------------------- W6 version types
def _versioned(table: DataFrame | None, ops: DataFrame, accept, allowed: tuple, chunk_rows: int) -> ReplayResult:
    """Writes with their own versions, in two steps.

    ``accept(stored, ops)`` says by the versions alone which ops take effect (``_acc``), the version that each leaves
    (``_ver``) and whether the key had a version before (``_known``). The accepted ops then go through the chunked
    replay, which knows what an index, update or delete does to a document; their versions stay the accepted ones. An
    accepted update or delete of a document that is not live is a 404, and its version is recorded all the same (tier
    P). Ops that a version type does not know are refused (400). Without ``op`` every row is an index op.
    """
    if "op" not in ops.columns:
        ops = ops.withColumn("op", F.lit("index"))
    ops = _prepare_ops(ops, table, None).withColumn("version", F.col("version").cast("long"))
    table, ops, fields = _aligned(table, ops)
    stats = log_stats(ops)
    ops, keyless = split_keyless(ops, stats)
    table, untouched = split_touched(table, ops, stats.rows)
    no_version = F.lit(None).cast("long").alias("_version")

    def refused(rows: DataFrame, status: int, error: str) -> DataFrame:
        return rows.select("seq", "op", *KEY, no_version, F.lit(status).cast("int").alias("status"), F.lit(error).alias("error_type"))

    judged = accept(table.select(*KEY, F.col("_version").alias("_sv")), ops.where(F.col("op").isin(*allowed)))
    taken = judged.where("_acc").select(*KEY, "seq", "op", *fields, "_ver", "_known")
    rows = _evaluate(table, taken, chunk_rows, stats).withColumn("version", F.col("_ver"))
    status = (F.when(F.col("op") == "index", F.when(F.col("_known"), STATUS_OK).otherwise(STATUS_CREATED))
              .otherwise(F.when(F.col("succ"), STATUS_OK).otherwise(STATUS_NOT_FOUND)))
    items = rows.select("seq", "op", *KEY, F.col("version").alias("_version"), status.cast("int").alias("status"),
                        F.when((F.col("op") == "update") & ~F.col("succ"), F.lit(ERR_MISSING)).alias("error_type"))
    items = items.unionByName(refused(judged.where(~F.col("_acc")), STATUS_CONFLICT, ERR_CONFLICT))
    items = items.unionByName(refused(ops.where(~F.col("op").isin(*allowed)), STATUS_BAD, ERR_REQUEST))
    return ReplayResult(with_untouched(_final(table, rows, fields, given=True), untouched), _with_items(items, keyless))


def write_external(table: DataFrame | None, delta: DataFrame, gte: bool = False,
                   chunk_rows: int = CHUNK_ROWS) -> ReplayResult:
    """External versions. Accept an index or delete op iff its ``version`` is greater than
    (``external``) or at least (``external_gte``) every version seen before it for
    the key, stored version included; the stored version becomes the given one. An op
    without a version is a conflict (409); creates and updates are refused (400).

    Closed form: a refused row can never raise the running maximum, so the running
    max over all earlier rows equals the max over earlier accepted rows. The max is
    carried across chunks like the replay's counters.
    """
    def accept(stored: DataFrame, ops: DataFrame) -> DataFrame:
        o = ops.withColumn("_chunk", _chunk_of(chunk_rows))
        w = Window.partitionBy(*KEY, "_chunk").orderBy("seq")
        o = o.withColumn("_mx_local", F.max("version").over(w.rowsBetween(Window.unboundedPreceding, -1)))
        summ = o.groupBy(*KEY, "_chunk").agg(F.max("version").alias("_cmax")).join(stored, KEY, "left")
        wc = Window.partitionBy(*KEY).orderBy("_chunk")
        summ = summ.withColumn("_mx_carry", F.greatest(F.max("_cmax").over(wc.rowsBetween(Window.unboundedPreceding, -1)), F.col("_sv")))
        rows = o.join(summ.select(*KEY, "_chunk", "_mx_carry"), [*KEY, "_chunk"], "inner")
        prior = F.greatest(F.col("_mx_local"), F.col("_mx_carry"))
        higher = F.col("version") >= prior if gte else F.col("version") > prior
        return (rows.withColumn("_known", prior.isNotNull()).withColumn("_ver", F.col("version"))
                .withColumn("_acc", F.col("version").isNotNull() & F.coalesce(higher, F.lit(True))))

    return _versioned(table, delta, accept, ("index", "delete"), chunk_rows)


def write_force(table: DataFrame | None, delta: DataFrame, chunk_rows: int = CHUNK_ROWS) -> ReplayResult:
    """Always accept an index or delete op and set the given version; the last op per key wins.

    The first write of a key is 201. An op without a version is a conflict (409); creates and updates are refused (400).
    """
    def accept(stored: DataFrame, ops: DataFrame) -> DataFrame:
        first = ops.where(F.col("version").isNotNull()).groupBy(*KEY).agg(F.min("seq").alias("_first")).join(stored, KEY, "left")
        return (ops.join(first, KEY, "left").withColumn("_acc", F.col("version").isNotNull()).withColumn("_ver", F.col("version"))
                .withColumn("_known", F.col("_sv").isNotNull() | (F.col("seq") > F.col("_first"))))

    return _versioned(table, delta, accept, ("index", "delete"), chunk_rows)


# ---------------------------------------------------------------- B2
def bulk_batch_summary(items: DataFrame) -> DataFrame:
    """B2: per batch, item count, failed count and the ``errors`` flag."""
    return items.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.col("status") >= 300).alias("failed"),
        F.bool_or(F.col("status") >= 300).alias("errors"))


# ---------------------------------------------------------------- W6b compare-and-set
def _running_count(df: DataFrame, flag: str, out: str, chunk_rows: int, inclusive: bool,
                   seed: DataFrame | None = None) -> DataFrame:
    """Per-key running count of ``flag`` in ``seq`` order without a per-key task.

    Window inside ``(key, chunk)`` plus, per chunk, the total of all earlier
    chunks (a window over one summary row per key-chunk). ``seed`` adds a per-key
    base (columns ``KEY + ['_base']``).
    """
    d = df.withColumn("_rc_chunk", _chunk_of(chunk_rows))
    w = Window.partitionBy(*KEY, "_rc_chunk").orderBy("seq")
    frame = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    d = d.withColumn("_rc_local", F.coalesce(F.sum(F.col(flag).cast("long")).over(frame), F.lit(0).cast("long")))
    summ = df.withColumn("_rc_chunk", _chunk_of(chunk_rows)).groupBy(*KEY, "_rc_chunk").agg(
        F.sum(F.col(flag).cast("long")).alias("_rc_tot"))
    if seed is not None:
        summ = summ.join(seed, KEY, "left")
    else:
        summ = summ.withColumn("_base", F.lit(0).cast("long"))
    wc = Window.partitionBy(*KEY).orderBy("_rc_chunk")
    summ = summ.withColumn("_rc_carry", F.coalesce(F.col("_base"), F.lit(0).cast("long")) + F.coalesce(
        F.sum("_rc_tot").over(wc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    d = d.join(summ.select(*KEY, "_rc_chunk", "_rc_carry"), [*KEY, "_rc_chunk"], "inner")
    return d.withColumn(out, F.col("_rc_carry") + F.col("_rc_local")).drop("_rc_chunk", "_rc_local", "_rc_carry")


def _next_occurrence(nodes: DataFrame, chunk_rows: int) -> DataFrame:
    """For every node (key, seq, _u): the seq of the first later node of the same key with ``_u + 1``.

    An as-of lookup done as a window over ``(key, value, chunk)`` plus a carried
    "first target in a later chunk", so one hot (key, value) pair never lands in a
    single task.
    """
    src = nodes.select(*KEY, (F.col("_u") + 1).alias("_val"), F.col("seq").alias("_s"), F.lit(True).alias("_src"))
    tgt = nodes.select(*KEY, F.col("_u").alias("_val"), F.col("seq").alias("_s"), F.lit(False).alias("_src"))
    u = src.unionByName(tgt).withColumn("_c", F.expr(f"_s div {int(chunk_rows)}"))
    wv = Window.partitionBy(*KEY, "_val", "_c").orderBy("_s", "_src")
    u = u.withColumn("_nl", F.first(F.when(~F.col("_src"), F.col("_s")), ignorenulls=True)
                     .over(wv.rowsBetween(1, Window.unboundedFollowing)))
    summ = u.groupBy(*KEY, "_val", "_c").agg(F.min(F.when(~F.col("_src"), F.col("_s"))).alias("_cmin"))
    wt = Window.partitionBy(*KEY, "_val").orderBy("_c")
    summ = summ.withColumn("_later", F.first("_cmin", ignorenulls=True).over(wt.rowsBetween(1, Window.unboundedFollowing)))
    srcs = u.where("_src").join(summ.select(*KEY, "_val", "_c", "_later"), [*KEY, "_val", "_c"], "inner")
    return srcs.select(*KEY, F.col("_s").alias("id"), F.coalesce("_nl", "_later").alias("nxt"))


def write_internal(table: DataFrame | None, delta: DataFrame, chunk_rows: int = CHUNK_ROWS) -> ReplayResult:
    """Internal versions as compare-and-set (tier P).

    An index, update or delete op with a ``version`` is accepted iff it equals the current version
    (absent document = 0); one without a version is always accepted; each
    acceptance adds 1. Creates are refused (400): they have no version. Exact and parallel: with ``nb`` = null-version ops before
    an op and ``v0`` the stored version, let ``u = version - nb - v0``. The
    accepted versioned ops are exactly the greedy chain of ``u = 0, 1, 2, ...``
    in ``seq`` order: the first op with ``u = 0``, then the first later op with
    ``u = 1``, and so on. Each op's successor (first later op with ``u + 1``) is
    an as-of lookup; the chain from each key's start is expanded by pointer
    doubling (round ``k`` adds positions ``[2^k, 2^(k+1))``), so the number of
    rounds is logarithmic in the chain length and every round is a
    hash-partitioned join on ``(key, seq)``, materialised to cut lineage.
    """
    return _versioned(table, delta, lambda stored, ops: _compare_and_set(stored, ops, chunk_rows), ("index", "update", "delete"), chunk_rows)


def _compare_and_set(stored: DataFrame, ops: DataFrame, chunk_rows: int) -> DataFrame:
    from docindex.operators.rank import materialize

    d = ops.withColumn("_null", F.col("version").isNull())
    d = _running_count(d, "_null", "_nb", chunk_rows, inclusive=False, seed=None).join(stored, KEY, "left")
    d = d.withColumn("_v0", F.coalesce(F.col("_sv"), F.lit(0).cast("long"))).drop("_sv")
    d = d.withColumn("_u", F.when(~F.col("_null"), F.col("version") - F.col("_nb") - F.col("_v0")))
    d = materialize(d, "cas-ops")
    nodes = d.where(~F.col("_null")).select(*KEY, "seq", "_u")

    jump = materialize(_next_occurrence(nodes, chunk_rows).where(F.col("nxt").isNotNull()), "cas-jump")
    path = materialize(nodes.where(F.col("_u") == 0).groupBy(*KEY).agg(F.min("seq").alias("id"))
                       .withColumn("_w", F.lit(0).cast("long")), "cas-path")
    step = 1
    while True:
        ext = (path.join(jump, [*KEY, "id"], "inner")
               .select(*KEY, F.col("nxt").alias("id"), (F.col("_w") + step).alias("_w")))
        ext = materialize(ext, "cas-path")
        if ext.isEmpty():
            break
        # Every round's positions are already written; the path is their union.
        path = path.unionByName(ext)
        a, b = jump.alias("a"), jump.alias("b")
        jump = materialize(a.join(b, (F.col("a._index") == F.col("b._index")) & (F.col("a._id") == F.col("b._id"))
                                  & (F.col("a.nxt") == F.col("b.id")), "inner")
                           .select(F.col("a._index"), F.col("a._id"), F.col("a.id"), F.col("b.nxt")), "cas-jump")
        step *= 2

    accepted = path.select(*KEY, F.col("id").alias("seq"), F.lit(True).alias("_hit"))
    rows = d.join(accepted, [*KEY, "seq"], "left").withColumn("_acc", F.col("_null") | F.coalesce(F.col("_hit"), F.lit(False)))
    rows = _running_count(rows, "_acc", "_n", chunk_rows, inclusive=True).withColumn("_ver", F.col("_v0") + F.col("_n"))
    return materialize(rows.withColumn("_known", F.col("_ver") > 1), "cas-judged")


# ---------------------------------------------------------------- JSON bodies
def bulk_replay_json(table: DataFrame | None, ops: DataFrame, body_col: str = "_source",
                     chunk_rows: int = CHUNK_ROWS) -> ReplayResult:
    """W8/W4 for schema-less bodies: ``body_col`` holds each op's JSON object.

    Unlike the typed path, an explicit JSON ``null`` in an update sets the field to
    null while an absent key leaves it alone. The per-op evaluation is the same
    chunked replay; the body is then resolved per (document, field): every
    contributing op's object is exploded into ``(field, value)`` entries (a
    variant keeps the JSON value), the entry of the latest op inside the
    document's last segment wins (stored fields count as the oldest entries when
    the log never resets the document), and the winners are reassembled into one
    JSON object per document with keys in name order (tier P).
    """
    from docindex.operators.rank import materialize

    ops = _prepare_ops(ops, None, None)
    if table is None:
        spark = ops.sparkSession
        table = spark.createDataFrame([], f"_index string, _id string, _version long, _deleted boolean, "
                                          f"_seq long, {body_col} string")
    # A body that is not a JSON object cannot be stored: its op is refused and changes nothing.
    whole = F.coalesce(F.schema_of_variant(F.try_parse_json(body_col)).startswith("OBJECT"), F.lit(False))
    ops = ops.withColumn("_refused", (F.col("op") != "delete") & F.col(body_col).isNotNull() & ~whole)
    refused, ops = ops.where("_refused"), ops.where("NOT _refused")
    stats = log_stats(ops)
    ops, keyless = split_keyless(ops, stats)
    # Written once: read for the states, the entries and the versions.
    table, untouched = split_touched(table, ops, stats.rows)
    if untouched is not None:
        table = materialize(table, "touched")
    else:  # too many keys for a broadcast: the same split by one join, and both parts are written
        keys = ops.select(*KEY).distinct().withColumn("_met", F.lit(True))
        split = materialize(table.join(keys, KEY, "left"), "touched")
        table, untouched = split.where("_met").drop("_met"), split.where("_met IS NULL").drop("_met")
    # Written once: the per-document state, the entries and the items all read it.
    rows = materialize(_evaluate(table, ops.select(*KEY, "seq", "op", body_col), chunk_rows, stats), "replay-rows")
    contrib = F.col("succ") & F.col("op").isin("index", "create", "update")
    per_doc = materialize(rows.groupBy(*KEY).agg(
        F.max_by(F.coalesce(F.col("_eff"), F.col("exists_before")), F.col("seq")).alias("_n_exists"),
        F.max("version").alias("_n_version"), F.max("seg").alias("_n_seg"),
        F.max(F.when(F.col("succ"), F.col("seq"))).alias("_n_seq")), "replay-docs")

    def entries(df, seq, seg):
        m = F.try_parse_json(body_col).cast("map<string,variant>")
        return df.select(*KEY, seq.alias("_e_seq"), seg.alias("_e_seg"), F.explode(m).alias("_f", "_v"))

    log_entries = entries(rows.where(contrib), F.col("seq"), F.col("seg"))
    stored_entries = entries(table.where(~F.col("_deleted")), F.lit(-1).cast("long"), F.lit(0).cast("long"))
    latest = log_entries.unionByName(stored_entries).groupBy(*KEY, "_f").agg(
        F.max_by(F.struct(F.col("_e_seg").alias("seg"), F.col("_v").alias("v")),
                 F.struct(F.col("_e_seg"), F.col("_e_seq"))).alias("_w"))
    alive = latest.join(per_doc.select(*KEY, "_n_seg", "_n_exists"), KEY, "inner") \
        .where(F.col("_n_exists") & (F.col("_w.seg") == F.col("_n_seg")))
    by_name = F.array_sort(F.collect_list(F.struct(F.col("_f").alias("k"), F.col("_w.v").alias("v"))),
                           lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))
    bodies = alive.groupBy(*KEY).agg(F.to_json(F.map_from_entries(by_name)).alias("_body"))

    stored = table.select(*KEY, *[F.col(c).alias(f"_s{c}") for c in ("_version", "_deleted", "_seq")])
    j = per_doc.join(stored, KEY, "left").join(bodies, KEY, "left")
    final = j.select(
        *KEY, F.col("_n_version").alias("_version"), (~F.col("_n_exists")).alias("_deleted"),
        F.coalesce(F.col("_n_seq"), F.col("_s_seq")).cast("long").alias("_seq"),
        F.when(F.col("_n_exists"), F.coalesce(F.col("_body"), F.lit("{}"))).alias(body_col)
    ).where(F.col("_version") > 0)
    return _json_result(final, untouched, rows, refused, keyless)


def _json_result(final: DataFrame, untouched: DataFrame, rows: DataFrame, refused: DataFrame, keyless: DataFrame | None) -> ReplayResult:
    items = _with_items(_items(rows), keyless)
    bad = refused.select("seq", "op", *KEY, F.lit(None).cast("long").alias("_version"), F.lit(STATUS_BAD).cast("int").alias("status"),
                         F.lit(None).cast("string").alias("result"), F.lit(ERR_PARSING).alias("error_type"))
    return ReplayResult(with_untouched(final, untouched), items.unionByName(bad))
