"""Codecs, the document store and streaming bulk on tiny inputs."""

import json

from pyspark.sql import functions as F

import pytest

from docindex import fixtures as fx
from docindex.operators import write as W
from docindex.session import scratch_path
from docindex.sources import codec as C
from docindex.sources import store


def _ops(spark, rows):
    return spark.createDataFrame(rows, "_index string, _id string, seq long, op string, name string")


def test_bulk_encode_payload_shape(spark):
    ops = _ops(spark, [("ix", "1", 1, "index", "a"), (None, "2", 2, "delete", None), ("ix", None, 3, "create", "c")])
    rows = C.bulk_encode(ops, 2, ["name"]).orderBy("batch_no").collect()
    assert [r.ops for r in rows] == [2, 1]
    assert rows[0].payload == ('{"index":{"_index":"ix","_id":"1"}}\n{"name":"a"}\n'
                               '{"delete":{"_id":"2"}}\n')
    assert rows[1].payload == '{"create":{"_index":"ix"}}\n{"name":"c"}\n'


def test_bulk_reply_round_trip(spark):
    ops = _ops(spark, [("ix", "1", 1, "create", "a"), ("ix", "1", 2, "create", "b"), ("ix", "2", 3, "update", "x")])
    items = W.bulk_replay(None, ops).items.withColumn("batch_no", F.lit(0).cast("long"))
    back = C.decode_bulk_responses(fx.bulk_replies(items), "reply").orderBy("pos").collect()
    assert [(r.op, r._id, r.status, r.error_type) for r in back] == [
        ("create", "1", 201, None), ("create", "1", 409, "version_conflict_engine_exception"),
        ("update", "2", 404, "document_missing_exception")]
    assert all(r.errors for r in back)


def test_search_reply_totals_both_shapes(spark):
    gen7 = json.dumps({"took": 3, "timed_out": False, "hits": {"total": {"value": 2, "relation": "eq"},
                      "max_score": 1.5, "hits": [{"_index": "i", "_id": "a", "_score": 1.5, "_source": {"n": 1}},
                                                 {"_index": "i", "_id": "b", "_score": 0.5, "_source": {"n": 2}}]}})
    gen6 = json.dumps({"took": 1, "timed_out": False, "hits": {"total": 7, "max_score": None, "hits": []}})
    df = spark.createDataFrame([(7, gen7), (6, gen6)], "v int, r string")
    rows = C.decode_search_responses(df, "r", keep=["v"]).orderBy("v", "pos").collect()
    assert [(r.v, r.total, r.relation, r.pos) for r in rows] == [(6, 7, "eq", None), (7, 2, "eq", 0), (7, 2, "eq", 1)]
    typed = C.hits_as(C.decode_search_responses(df, "r", keep=["v"]).where("pos is not null"), "n long")
    assert [r.n for r in typed.orderBy("pos").collect()] == [1, 2]


def test_get_replies_single_and_missing(spark):
    single = json.dumps({"_index": "i", "_id": "1", "_version": 2, "found": True, "_source": {"n": 5}})
    multi = json.dumps({"docs": [{"_index": "i", "_id": "1", "_version": 2, "found": True, "_source": {"n": 5}},
                                 {"_index": "i", "_id": "9", "found": False}]})
    df = spark.createDataFrame([(0, single), (1, multi)], "k int, r string")
    rows = C.decode_get_responses(df, "r", "n long", keep=["k"]).orderBy("k", "pos").collect()
    assert [(r.k, r._id, r.found, r.n) for r in rows] == [(0, "1", True, 5), (1, "1", True, 5), (1, "9", False, None)]


def test_shard_summary_absent_failures(spark):
    df = spark.createDataFrame([('{"_index":"i","_shards":{"total":2,"successful":2,"failed":0}}',),
                                ('{"_index":"i","_shards":{"total":2,"successful":1,"failed":1,'
                                 '"failures":[{"shard":0,"index":"i","reason":"x"}]}}',)], "r string")
    totals, failures = C.shard_summary(df, "r")
    t = totals.collect()[0]
    assert (t.total, t.successful, t.failed, t.failures) == (4, 3, 1, 1)
    assert [(r.shard, r.reason) for r in failures.collect()] == [(0, "x")]


def test_documents_as_rejects_malformed(spark):
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, "not json"), (3, '{"a": 3}')], "k int, j string")
    res = C.documents_as(df, "j", "a long", keep=["k"])
    assert sorted((r.k, r.a) for r in res.rows.collect()) == [(1, 1), (3, 3)]
    assert [r.k for r in res.rejects.collect()] == [2]


def _files(spark, root):
    """{(index, shard): data files} of a store."""
    out: dict = {}
    for r in store.read_index(spark, root).select("_index", "shard", F.input_file_name().alias("f")).distinct().collect():
        out.setdefault((r["_index"], r["shard"]), set()).add(r["f"])
    return out


def test_store_commit_touches_only_some_shards(spark):
    root = scratch_path(spark, "store-test")
    first = _ops(spark, [("ix", str(i), i, "index", f"n{i}") for i in range(1, 41)])
    store.write_index(W.bulk_replay(None, first).table, root, n_shards=8)
    before = _files(spark, root)
    delta = _ops(spark, [("ix", "3", 100, "update", "z"), ("ix", "4", 101, "delete", None)])
    items = store.commit_replay(spark, root, delta, n_shards=8)
    assert sorted(r.status for r in items.collect()) == [200, 200]
    after = _files(spark, root)
    assert 1 <= sum(after[k] != before[k] for k in before) <= 2
    table = {r._id: r for r in store.read_index(spark, root).collect()}
    assert len(table) == 40 and table["3"].name == "z" and table["4"]._deleted and table["4"]._version == 2
    store.compact(spark, root, expunge_only=True)
    last = _files(spark, root)
    assert sum(last[k] != after[k] for k in after) == 1
    assert store.read_index(spark, root).count() == 39 and store.read_index(spark, root).where("_deleted").count() == 0


def test_a_partition_that_loses_its_documents_is_replaced(spark):
    root = scratch_path(spark, "moved")
    ops = spark.createDataFrame([("ix", "1", 1, "index", "a", "k1")], "_index string, _id string, seq long, op string, name string, routing string")
    store.commit_replay(spark, root, ops, n_shards=16)
    store.commit_replay(spark, root, _ops(spark, [("ix", "1", 2, "index", "b")]))  # moves to its id's shard
    assert [(r.name, r._version, r._routing) for r in store.read_index(spark, root).collect()] == [("b", 2, None)]


def test_stream_batch_takes_effect_once(spark, monkeypatch):
    from docindex.streaming import bulk as SB

    root = scratch_path(spark, "stream-test")
    seed = _ops(spark, [("ix", str(i), i, "index", f"n{i}") for i in range(1, 11)])
    store.write_index(W.bulk_replay(None, seed).table, root)
    batch = _ops(spark, [("ix", "1", 20, "update", "u"), ("ix", "11", 21, "create", "c")])
    fn = SB._batch_fn(spark, root, store.DEFAULT_SHARDS, f"{root}/_streams/s", SB.BulkStream(root, f"{root}/_items/s", f"{root}/_summary/s"))
    state = lambda: sorted(tuple(r) for r in store.read_index(spark, root).collect())
    empty = state()
    publish = store.publish
    monkeypatch.setattr(store, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        fn(batch, 0)  # prepared, then the driver is lost
    assert state() == empty
    monkeypatch.setattr(store, "publish", publish)
    fn(batch, 0)
    once = state()
    assert once != empty and ("u", 2) in {(r.name, r._version) for r in store.read_index(spark, root).collect()}
    fn(batch, 0)  # a batch that is run again is put in place again
    assert state() == once
    fn(_ops(spark, [("ix", "1", 22, "update", "v")]), 1)
    with pytest.raises(ValueError):
        fn(batch, 0)


def test_streams_with_checkpoints_of_one_name_are_two(spark):
    from docindex.streaming import bulk as SB

    schema, root = "_index string, _id string, seq long, op string, name string", scratch_path(spark, "store")
    for job in ("job1", "job2"):
        base = scratch_path(spark, job)
        rows = [("ix", f"{job}-{i}", i, "index", "n") for i in range(5)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/src")
        q, paths = SB.bulk_stream(spark, SB.read_ops_stream(spark, f"{base}/src", schema), root, f"{base}/ck")
        q.awaitTermination()
        assert spark.read.parquet(paths.items_path).count() == 5
    assert store.read_index(spark, root).count() == 10


def test_bulk_stream_restart_continues_versions(spark):
    from docindex.streaming import bulk as SB

    schema = "_index string, _id string, seq long, op string, name string"
    src, root, ck = scratch_path(spark, "src"), scratch_path(spark, "store"), scratch_path(spark, "ck")
    rows = [("ix", str(i % 7), i, ["index", "update", "delete", "create"][i % 4], f"n{i}") for i in range(1, 61)]
    parts = [rows[:20], rows[20:40], rows[40:]]
    for p in parts[:2]:
        spark.createDataFrame(p, schema).coalesce(1).write.mode("append").parquet(src)
    q, _ = SB.bulk_stream(spark, SB.read_ops_stream(spark, src, schema), root, ck)
    q.awaitTermination()
    spark.createDataFrame(parts[2], schema).coalesce(1).write.mode("append").parquet(src)
    q, _ = SB.bulk_stream(spark, SB.read_ops_stream(spark, src, schema), root, ck)
    q.awaitTermination()
    want = sorted(tuple(r) for r in W.bulk_replay(None, spark.createDataFrame(rows, schema)).table.collect())
    got = sorted(tuple(r) for r in store.read_index(spark, root).drop("shard").select(
        "_index", "_id", "_version", "_deleted", "_seq", "name").collect())
    assert got == want


def test_bulk_stateful_matches_replay_over_a_restart(spark):
    from docindex.streaming import bulk as SB

    schema = "_index string, _id string, seq long, op string, name string"
    src, out, ck = scratch_path(spark, "src"), scratch_path(spark, "items"), scratch_path(spark, "ck")
    rows = [("ix" if i % 13 else None, str(i % 5) if i % 6 else None, i, ["index", "update", "delete", "create"][i * 7 % 4], f"n{i}") for i in range(1, 61)]
    for p in (rows[:20], rows[20:40], rows[40:]):
        spark.createDataFrame(p[::-1], schema).coalesce(1).write.mode("append").parquet(src)
        SB.bulk_stateful(spark, SB.read_ops_stream(spark, src, schema), out, ck).awaitTermination()
    key = lambda df: sorted((tuple(r) for r in df.select("seq", "op", "_index", "_id", "_version", "status", "result", "error_type").collect()), key=repr)
    assert key(spark.read.parquet(out)) == key(W.bulk_replay(None, spark.createDataFrame(rows, schema)).items)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == SB.ROCKSDB


def _docs(spark, n, **more):
    rows = [("ix", str(i), f"src{i % 7}", None, 1, False, i, f"n{i}") for i in range(n)]
    return spark.createDataFrame(rows, "_index string, _id string, _routing string, _parent string, _version long, _deleted boolean, _seq long, name string")


def test_routed_store_keeps_every_document(spark):
    root = scratch_path(spark, "routed")
    store.write_index(_docs(spark, 100), root)
    for i in (3, 4, 5, 6):
        items = store.commit_replay(spark, root, _ops(spark, [("ix", str(i), 1000 + i, "update", "new")]))
        assert [r.status for r in items.collect()] == [200]
    store.commit_replay(spark, root, _ops(spark, [("ix", "9", 2000, "delete", None), ("ix", "new", 2001, "index", "x"), ("ix", "8", 2002, "index", "moved")]))
    got = {r._id: r for r in store.read_index(spark, root).collect()}
    assert len(got) == 101 and got["4"].name == "new" and got["4"]._routing == "src4" and got["50"].name == "n50"
    assert got["9"]._deleted and got["9"]._routing == "src2" and got["8"]._routing is None and got["8"].name == "moved"


def test_routing_argument_reaches_the_store(spark):
    root = scratch_path(spark, "routed")
    ops = spark.createDataFrame([("ix", "1", 1, "index", "a", "k1", None), ("ix", "2", 2, "index", "b", None, "p"), ("ix", "1", 3, "delete", None, "k1", None)],
                                "_index string, _id string, seq long, op string, name string, routing string, parent string")
    store.commit_replay(spark, root, ops)
    assert sorted((r._id, r._routing, r._parent, r._deleted) for r in store.read_index(spark, root).collect()) == [("1", "k1", None, True), ("2", None, "p", False)]


def test_post_into_a_store(spark):
    root = scratch_path(spark, "post")
    store.write_index(_docs(spark, 100), root)
    store.commit_replay(spark, root, spark.createDataFrame([("ix", None, 1000, "index", "posted")], "_index string, _id string, seq long, op string, name string"))
    store.commit_replay(spark, root, spark.createDataFrame([("ix", "index", "again")], "_index string, op string, name string"))
    got = store.read_index(spark, root)
    assert got.count() == 102 and got.where("name in ('posted', 'again')").count() == 2


def test_store_schema_grows_and_index_names_stay_strings(spark):
    root = scratch_path(spark, "schema")
    store.commit_replay(spark, root, _ops(spark, [("2024.1", "1", 1, "index", "a"), ("2024.10", "1", 2, "index", "b")]))
    more = spark.createDataFrame([("2024.10", "2", 3, "index", "c", "Rome")], "_index string, _id string, seq long, op string, name string, city string")
    store.commit_replay(spark, root, more)
    got = {(r._index, r._id): (r.name, r.city) for r in store.read_index(spark, root).collect()}
    assert got == {("2024.1", "1"): ("a", None), ("2024.10", "1"): ("b", None), ("2024.10", "2"): ("c", "Rome")}
    with pytest.raises(ValueError):
        store.commit_replay(spark, root, spark.createDataFrame([("x", "2", 4, "index", 5)], "_index string, _id string, seq long, op string, city long"))


def test_compact_of_tombstones_only(spark):
    root = scratch_path(spark, "empty")
    store.commit_replay(spark, root, _ops(spark, [("ix", "1", 1, "index", "a")]))
    store.commit_replay(spark, root, _ops(spark, [("ix", "1", 2, "delete", None)]))
    store.compact(spark, root)
    assert store.read_index(spark, root).count() == 0 and "name" in store.read_index(spark, root).columns
    store.commit_replay(spark, root, _ops(spark, [("ix", "1", 3, "index", "b")]))
    assert [(r.name, r._version) for r in store.read_index(spark, root).collect()] == [("b", 1)]


def test_rewriting_a_table_empties_partitions_it_lacks(spark):
    root = scratch_path(spark, "rewrite")
    store.write_index(_docs(spark, 100), root)
    store.write_index(_docs(spark, 3), root)
    assert store.read_index(spark, root).count() == 3


def test_another_shard_count_still_finds_documents(spark):
    from docindex.api import Index

    root = scratch_path(spark, "shards")
    Index(spark, root, "ix", 8).index(spark.createDataFrame([(str(i), i, "a") for i in range(20)], "_id string, seq long, name string"))
    assert all(Index(spark, root, "ix", 3).get(str(i)).count() == 1 for i in range(20))


def test_noop_update_keeps_new_fields(spark):
    table = W.bulk_replay(None, _ops(spark, [("ix", "1", 1, "index", "a")])).table
    delta = spark.createDataFrame([("ix", "1", 5, "a", "Rome")], "_index string, _id string, seq long, name string, city string")
    assert [(r.name, r.city, r._version) for r in W.update_docs(table, delta, detect_noop=True).table.collect()] == [("a", "Rome", 2)]


def test_stream_batch_summary_per_micro_batch(spark):
    from docindex.streaming import bulk as SB

    schema = "_index string, _id string, seq long, op string, name string"
    src, out, ck = scratch_path(spark, "src"), scratch_path(spark, "sum"), scratch_path(spark, "ck")
    rows = [("ix", str(i % 3), i, ["create", "update"][i % 2], "n") for i in range(1, 13)]
    items = W.bulk_replay(None, spark.createDataFrame(rows, schema)).items
    for lo in (0, 6):
        items.where(f"seq > {lo} and seq <= {lo + 6}").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(items.schema).option("maxFilesPerTrigger", 1).parquet(src)
    SB.stream_batch_summary(stream, out, ck).awaitTermination()
    got = sorted((r.batch_no, r["items"]) for r in spark.read.parquet(out).collect())
    assert got == [(0, 6), (1, 6)]


def test_store_index_names_with_special_characters(spark):
    from docindex.operators.types import fold_types, unfold_types

    root = scratch_path(spark, "store-esc")
    ops = spark.createDataFrame([("ix", "a b/c", "1", 1, "index", "x"), ("ix", "t=2", "1", 2, "index", "y")],
                                "_index string, _type string, _id string, seq long, op string, name string")
    store.write_index(W.bulk_replay(None, fold_types(ops)).table, root)
    back = unfold_types(store.read_index(spark, root))
    assert sorted((r._type, r.name) for r in back.collect()) == [("a b/c", "x"), ("t=2", "y")]
    assert store.read_index(spark, root, ["ix/t=2"]).count() == 1


def test_read_documents_files_with_rejects(spark):
    path = scratch_path(spark, "ndjson")
    spark.createDataFrame([('{"a": 1, "b": "x"}',), ("not json",), ('{"a": 2}',)], "value string") \
        .coalesce(1).write.text(path)
    res = C.read_documents(spark, path, "a long, b string")
    assert sorted((r.a, r.b) for r in res.rows.collect()) == [(1, "x"), (2, None)]
    assert [r._corrupt_record for r in res.rejects.collect()] == ["not json"]
