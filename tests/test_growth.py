"""What grows with the input stays in many tasks and few passes: the steps that larger tables would have stopped."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docindex import fixtures as fx
from docindex.functions.analyze import prefix_sum
from docindex.llm import textvec
from docindex.operators import aggs, pages, rank, write
from docindex.plans import store_plans
from docindex.session import scratch_path
from docindex.sources import postings


def files(spark, path):
    """Data files below a path."""
    return spark.read.parquet(path).inputFiles()


def test_a_large_page_is_cut_without_a_limit(spark, monkeypatch):
    monkeypatch.setattr(pages, "SORTED", 50)
    df = spark.createDataFrame([(k % 3 if k % 10 else None, k) for k in range(500)], "a int, k long").repartition(7)
    order = [("a", False), ("k", True)]
    scroll = pages.KeysetScroll.of(df, order)
    first = scroll.page(None, 60)
    second = scroll.page(scroll.cursor_after(first), 60)
    for page in (first, second):
        shown = page._jdf.queryExecution().executedPlan().toString()
        assert "Limit" not in shown and "TakeOrdered" not in shown
    want = [r["k"] for r in df.orderBy(*pages.sort_columns(order)).collect()]
    assert [r["k"] for r in first.collect()] == want[:60] and [r["k"] for r in second.collect()] == want[60:120]


@pytest.fixture
def split_docs(spark, sf_dir):
    """The documents in nine files."""
    path = scratch_path(spark, "tables")
    spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(9).write.parquet(f"{path}/documents.parquet")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task a file
    yield path
    spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_a_document_stream_has_many_files_and_two_batches(spark, split_docs):
    stream, seen = fx.docs_stream(spark, split_docs), []
    query = stream.writeStream.foreachBatch(lambda batch, _: seen.append((batch.select(F.input_file_name()).distinct().count(), batch.count())))
    query.option("checkpointLocation", scratch_path(spark, "ckpt")).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 2 and min(n for n, _ in seen) > 1
    assert sum(rows for _, rows in seen) == fx.docs(spark, split_docs).where("lang is not null").count()


def test_parts_of_a_log_have_one_number_of_files(spark, monkeypatch):
    monkeypatch.setattr(store_plans, "PART_FILE_ROWS", 100)
    ops, path = spark.range(1, 1701).select(F.col("id").alias("seq"), F.lit("index").alias("op")), scratch_path(spark, "parts")
    n = store_plans._write_parts(ops, path, 4, 0, 1700)
    assert n == 4 and [len(files(spark, f"{path}/{p:02d}")) for p in range(4)] == [4] * 4
    ranges = [spark.read.parquet(f"{path}/{p:02d}").agg(F.min("seq"), F.max("seq"), F.count("seq")).first() for p in range(4)]
    assert [tuple(r) for r in ranges] == [(425 * p + 1, 425 * (p + 1), 425) for p in range(4)]


def test_postings_are_written_where_texts_lie(spark, monkeypatch):
    monkeypatch.setattr(postings, "_segments", lambda df: 3)
    rows = [("ix", str(k % 30), f"common w{k % 7} w{k % 7}") for k in range(60)] + [("ix", None, "common"), ("ix", "x", ""), ("ix", "y", None)]
    root = scratch_path(spark, "postings")
    postings.write_postings(spark.createDataFrame(rows, "_index string, _id string, text string"), "text", root, buckets=2)
    written = spark.read.parquet(f"{root}/postings")
    assert len(written.inputFiles()) == 6
    # Documents of one key and length are one document to the table, as they always were.
    found = {r["_id"]: r["tf"] for r in postings.read_postings(spark, root, ["common"]).collect()}
    assert found == {**{str(k): 2 for k in range(30)}, None: 1}
    blocks = spark.read.parquet(f"{root}/blocks").where("term = 'common'").agg(F.sum("docs"), F.max("tf")).first()
    assert tuple(blocks) == (31, 2)


def test_counting_many_values_groups_each_row_a_few_times(monkeypatch):
    monkeypatch.setattr(aggs, "_FOLD_ROWS", 100)
    calls, concat = [], pa.concat_tables
    monkeypatch.setattr(pa, "concat_tables", lambda tables, *a, **k: calls.append(len(tables)) or concat(tables, *a, **k))
    batches = [pa.RecordBatch.from_pydict({"key": list(range(50 * k, 50 * k + 50))}) for k in range(200)]
    out = pa.Table.from_batches(aggs._counted()(iter([*batches, *batches])))
    assert out.num_rows == 10_000 and set(out["n"].to_pylist()) == {2} and len(calls) <= 20


def test_prefix_sums_work_on_slices_of_arrow_arrays():
    whole = pa.array([[9, 9], None, [1, 2, 3], [], [5], [7, 7]], pa.list_(pa.int32()))
    assert prefix_sum.func(whole.slice(1, 4)).to_pylist() == [None, [1, 3, 6], [], [5]]
    assert prefix_sum.func(whole.slice(0, 0)).to_pylist() == []


def test_rows_become_objects_a_few_at_a_time():
    batches = [pa.RecordBatch.from_pydict({"a": list(range(n))}) for n in (0, 3, 600)]
    parts = list(textvec.few(iter(batches)))
    assert [p.num_rows for p in parts] == [3, 256, 256, 88]
    assert [x for p in parts for x in p.column(0).to_pylist()] == [*range(3), *range(600)]


def test_block_bounds_are_written_by_the_tasks_that_count_them(spark, monkeypatch):
    monkeypatch.setattr(postings, "_segments", lambda df: 2)
    rows = [("ix", str(k), f"common w{k % 7}") for k in range(60)]
    root = scratch_path(spark, "postings")
    postings.write_postings(spark.createDataFrame(rows, "_index string, _id string, text string"), "text", root, buckets=2)
    blocks = spark.read.parquet(f"{root}/blocks")
    assert 2 <= len(blocks.inputFiles()) <= 4
    assert blocks.count() == blocks.select("b", "term", "block").distinct().count()


POSTS = "_index string, _id string, seq long, op string, name string, n int"


def test_posts_of_a_large_log_are_not_replayed_by_key(spark, monkeypatch):
    monkeypatch.setattr(write, "REPLAY_BROADCAST_KEYS", 20)
    table = write.bulk_replay(None, spark.createDataFrame([("ix", str(k), k, "index", "old", k) for k in range(15)], POSTS)).table.localCheckpoint()
    posts = spark.createDataFrame([("ix", None, 100 + k, "index", f"p{k}", k) for k in range(60)], POSTS)
    kept = []
    res = write.bulk_replay(table, posts, keep_rows=lambda rows: kept.append(rows) or rows)
    assert [rows.count() for rows in kept] == [0, 60]
    assert res.table.where("name LIKE 'p%' AND _version = 1 AND length(_id) = 64").count() == 60 and res.table.count() == 75


def test_a_large_log_with_lone_ops_gives_what_the_replay_by_key_gives(spark, monkeypatch):
    first = [("ix", None, k, "index", f"a{k}", k) for k in range(8)] + [("ix", "d", 20, "index", "d", 1), ("ix", "d", 21, "delete", None, None),
                                                                       ("ix", "s", 22, "index", "s", 1), ("iy", "quiet", 23, "index", "q", 1)]
    table = write.bulk_replay(None, spark.createDataFrame(first, POSTS)).table.localCheckpoint()
    log = [("ix", None, 100 + k, "index" if k % 2 else "create", f"b{k}", None if k % 3 else k) for k in range(40)]  # new posts
    log += [("ix", None, k, "index", f"retry{k}", k) for k in range(5, 8)]  # ids that are stored already
    log += [("ix", "d", 200, "update", "none", 1), ("ix", "d", 201, "create", "again", 2), ("ix", "s", 202, "create", "no", 2), ("ix", "s", 203, "update", None, 9)]
    log += [("ix", "one", 204, "index", "once", 1), ("ix", "two", 205, "create", "twice", 1), ("ix", "two", 206, "update", None, 5)]
    log += [("ix", "gone", 207, "update", "x", 1), ("ix", "gone too", 208, "delete", None, None), ("ix", "odd", 209, "what", "x", 1), ("ix", "none", 210, None, "x", 1)]
    log += [("ix", None, None, "index", "no place", 1), (None, "k", 211, "index", "x", 1), ("ix", None, 212, "update", "x", 1)]
    ops = spark.createDataFrame(log, POSTS).withColumn("more", F.col("n") + 1)

    def replayed():
        res = write.bulk_replay(table, ops, chunk_rows=7)
        return [(f.schema, sorted(map(str, f.collect()))) for f in (res.table.select(*sorted(res.table.columns)), res.items)]

    want = replayed()
    monkeypatch.setattr(write, "REPLAY_BROADCAST_KEYS", 30)
    prepared = write._prepare_ops(ops, table, None)
    stats = write.log_stats(prepared)
    shared, lone, _touched, untouched = write.split_lone(table, write.split_keyless(prepared, stats)[0], stats)
    assert (shared.count(), lone.count(), untouched.count()) == (10, 45, 6)
    got = replayed()
    assert [rows for _, rows in got] == [rows for _, rows in want]
    assert [[(f.name, f.dataType) for f in s] for s, _ in got] == [[(f.name, f.dataType) for f in s] for s, _ in want]
    monkeypatch.setattr(write, "REPLAY_BROADCAST_KEYS", 3)  # more shared keys than that: all of it by key
    assert [rows for _, rows in replayed()] == [rows for _, rows in want]


JSON_TABLE = "_index string, _id string, _version long, _deleted boolean, _seq long, _source string"


def test_a_json_log_of_many_keys_keeps_the_documents_that_it_does_not_touch(spark, monkeypatch):
    stored = [("ix", "a", 2, False, 1, '{"x": 1,  "y": null}'), ("ix", "b", 3, True, 2, None), ("ix", "twice", 1, False, 3, '{"n": 1}'),
              ("ix", "quiet", 1, False, 4, '{"z": 1,  "a": [2]}'), ("ix", "quiet gone", 4, True, 5, None), ("iy", "a", 1, False, 6, "{}"),
              ("ix", "no version", 0, False, None, '{"v": 0}'), ("ix", None, 1, False, 7, '{"k": 1}'), (None, "a", 1, False, 8, '{"k": 2}')]
    log = [("ix", "a", 10, "update", '{"y": 2, "w": null}'), ("ix", "b", 11, "create", '{"new": true}'), ("ix", "twice", 12, "delete", None),
           ("ix", "twice", 13, "update", '{"n": 2}'), ("ix", "none", 14, "update", '{"n": 3}'), ("ix", "c", 15, "index", '{"c": "d"}'),
           ("ix", "c", 16, "update", "not json"), ("ix", None, 17, "index", '{"auto": 1}'), ("ix", None, 18, "delete", None), (None, "a", 19, "index", "{}")]
    table, ops = spark.createDataFrame(stored, JSON_TABLE), spark.createDataFrame(log, "_index string, _id string, seq long, op string, _source string")

    def replayed(t):
        res = write.bulk_replay_json(t, ops, chunk_rows=4)
        return [(f.dtypes, sorted(map(str, f.collect()))) for f in (res.table, res.items)]

    want, alone = replayed(table), replayed(None)
    monkeypatch.setattr(write, "REPLAY_BROADCAST_KEYS", 3)
    got = replayed(table)
    assert got == want and replayed(None) == alone
    for row in spark.createDataFrame(stored[3:], JSON_TABLE).collect():
        assert str(row) in got[0][1]
    assert len(got[0][1]) == 11


def test_a_rank_is_joined_without_a_shuffle(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the ranked rows were too many
    try:
        ranked = rank.global_rank(spark.range(100).repartition(5), ["id"])
        assert "SortMergeJoin" not in ranked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert [r["rank"] for r in ranked.orderBy("id").collect()] == list(range(1, 101))
