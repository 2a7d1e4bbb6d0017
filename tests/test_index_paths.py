"""Point reads, deep pages, families, states and top-k: that they read little, and that they are right on small inputs."""

import random

import pytest
from pyspark.sql import functions as F

from docindex.functions.analyze import prefix_sum
from docindex.operators import aggs, history, mapping, pages, search, write
from docindex.operators.colocate import Families
from docindex.session import scratch_path
from docindex.sources import postings, store
from docindex.streaming import percolate


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_rows(df) -> int:
    """Rows that the file scans of a frame gave out, after it has run."""
    df.collect()
    jvm_plan = df._jdf.queryExecution().executedPlan()
    total, todo = 0, [jvm_plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
            continue
        if name.startswith("Scan parquet"):
            total += int(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.length())]
    return total


@pytest.fixture(scope="module")
def big_store(spark):
    root = scratch_path(spark, "points")
    docs = spark.range(200_000).select(
        F.lit("ix").alias("_index"), F.concat(F.lit("doc-"), F.xxhash64("id").cast("string")).alias("_id"), F.lit(1).cast("long").alias("_version"),
        F.lit(False).alias("_deleted"), F.col("id").alias("_seq"), F.concat(F.lit("body "), F.col("id"), F.lit(" " * 40)).alias("body"))
    store.write_index(docs, root, n_shards=2)
    return root


def test_a_get_reads_few_rows(spark, big_store):
    table = store.read_index(spark, big_store)
    wanted = table.where("_seq = 77777").first()
    got = search.get_doc(table, "ix", wanted["_id"], n_shards=2)
    assert got.count() == 1 and scanned_rows(got) <= 10_000  # pages of 2,000 rows, of 200,000 in all
    missing = search.get_doc(table, "ix", "doc-none", n_shards=2)
    assert missing.count() == 0 and scanned_rows(missing) <= 10_000


def test_an_mget_reads_the_pages_of_its_keys(spark, big_store):
    table = store.read_index(spark, big_store)
    ids = [r["_id"] for r in table.where("_seq % 20000 = 5").select("_id").collect()]
    keys = spark.createDataFrame([(k, "ix", i) for k, i in enumerate(ids + ["doc-none", ids[0]])], "pos long, _index string, _id string")
    assert scanned_rows(search.pushed(table, keys)) <= 2_000 * 2 * len(ids) < 200_000
    rows = sorted(search.mget(table, keys, push=True).collect(), key=lambda r: r["pos"])
    assert [r["found"] for r in rows] == [True] * len(ids) + [False, True] and rows[-1]["body"] == rows[0]["body"]
    assert search.pushed(table, keys, limit=3) is table
    none = keys.where("false")
    assert search.mget(table, none, push=True).count() == 0


@pytest.mark.parametrize("order", [[("a", True), ("k", True)], [("a", False), ("b", True), ("k", False)]])
def test_deep_pages_are_slices_of_the_order(spark, monkeypatch, order):
    monkeypatch.setattr(pages, "SORTED", 20)
    monkeypatch.setattr(pages, "SAMPLED", 60)
    rnd = random.Random(1)
    rows = [(rnd.choice([None, 1, 1, 1, 2, 3]), rnd.choice([None, "x", "y"]), k) for k in range(900)]
    df = spark.createDataFrame(rows, "a int, b string, k long").repartition(5)
    want = [r["k"] for r in df.orderBy(*pages.sort_columns(order)).collect()]
    for at, size in ((0, 7), (13, 5), (444, 30), (895, 50), (900, 5), (2000, 3)):
        assert [r["k"] for r in pages.deep_page(df, order, at, size).collect()] == want[at: at + size]
    assert pages.deep_page(df.limit(0), order, 5, 5).count() == 0


def test_a_deep_page_writes_no_copy(spark, monkeypatch):
    from docindex.operators import rank

    monkeypatch.setattr(rank, "materialize", lambda *a, **k: pytest.fail("a copy was written"))
    table = spark.range(60_000).select(F.lit("i").alias("_index"), F.format_string("%06d", "id").alias("_id"), F.lit(False).alias("_deleted"))
    page = search.search(table, from_=40_000, size=3).hits
    assert [r["_id"] for r in page.collect()] == ["040000", "040001", "040002"]


def test_keyset_pages_add_up_under_ties(spark):
    rows = [(k % 3 if k % 10 else None, "same", k) for k in range(500)]
    df = spark.createDataFrame(rows, "a int, b string, k long").repartition(7)
    order = [("a", False), ("b", True), ("k", True)]
    scroll = pages.KeysetScroll.of(df, order)
    want = [r["k"] for r in df.orderBy(*pages.sort_columns(order)).collect()]
    got = [[r["k"] for r in p.collect()] for p in scroll.pages(60)]
    assert [len(p) for p in got] == [60] * 8 + [20] and sum(got, []) == want
    # A page in the middle is read by its cursor alone, from a part of the folders.
    where = next((n, tuple(r)[1:]) for n, r in enumerate(df.orderBy(*pages.sort_columns(order)).select("k", "a", "b", F.col("k").alias("kk")).collect()) if n == 299)
    part = scroll._rows().where(F.col("k") == want[299]).first()["_range"]
    page = scroll.page((part, where[1]), 60)
    assert [r["k"] for r in page.collect()] == want[300:360] and scanned_rows(page) < 400
    assert list(pages.KeysetScroll.of(df.limit(0), order).pages(5)) == []


def test_families_join_without_an_exchange(spark, sf_dir):
    from docindex import fixtures as fx

    parents, children = fx.orders_index(spark, sf_dir), fx.lineitem_children(spark, sf_dir)
    families = Families.of(parents, children, parent_index="orders", buckets=4)
    for df in (families.join(), families.parents_with(F.col("l_quantity") > 45), families.parents_with(without=True)):
        assert "Exchange" not in plan(df) and "Broadcast" not in plan(df)
    assert families.join().count() == search.parent_child(parents, children, parent_index="orders").count()
    for without in (False, True):
        want = search.parent_child(parents, children.where("l_quantity > 45"), "has_no_child" if without else "has_child", parent_index="orders")
        got = families.parents_with(F.col("l_quantity") > 45, without)
        assert sorted(r["_id"] for r in got.collect()) == sorted(r["_id"] for r in want.collect())


def test_states_equal_replays_at_every_position(spark):
    rnd = random.Random(2)
    log = [("ix", str(rnd.randrange(4)), s, rnd.choice(["index", "create", "update", "delete"]), rnd.choice([None, "x", "y"]), rnd.choice([None, 1, 2])) for s in range(60)]
    log += [(None, "1", 60, "index", "lost", 1), ("ix", None, 61, "update", "lost", 1)]
    ops = spark.createDataFrame(log, "_index string, _id string, seq long, op string, a string, b int")
    stored = write.bulk_replay(None, ops.where("seq < 15")).table
    states = spark.createDataFrame(history.history(stored, ops.where("seq >= 15"), chunk_rows=7).collect(), history.history(stored, ops.where("seq >= 15")).schema)
    key = lambda df: sorted(map(tuple, df.select("_index", "_id", "_version", "a", "b").collect()))
    for cut in range(14, 61, 5):
        assert key(history.as_of(states, cut)) == key(write.visible_at(ops, cut)), cut
    assert states.groupBy("_id").agg(F.count_if(F.col("valid_to").isNull()).alias("n")).where("n <> 1").count() == 0


def test_block_bounds_skip_and_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK_DOCS", 8)
    rnd = random.Random(3)
    words = ["common"] * 30 + ["often"] * 10 + [f"w{k}" for k in range(60)]
    rows = [("ix", str(k), False, " ".join(rnd.choice(words) for _ in range(rnd.choice([5, 8, 40, 300]))) + (" rare rare" if k % 97 == 0 else "")) for k in range(3000)]
    docs = spark.createDataFrame(rows, "_index string, _id string, _deleted boolean, text string")
    root = scratch_path(spark, "blocks")
    postings.write_postings(docs, "text", root, buckets=4)
    skipped = False
    for terms, k in ((["common"], 5), (["common", "often"], 10), (["rare", "common"], 7), (["rare"], 100), (["none"], 3), (["w1", "w2", "w3"], 1)):
        want = postings.bm25_postings(spark, root, terms).orderBy(F.desc("_score"), "_index", "_id").limit(k).collect()
        top = postings.bm25_top(spark, root, terms, k)
        assert [(r["_id"], round(r["_score"], 9)) for r in top.hits.collect()] == [(r["_id"], round(r["_score"], 9)) for r in want]
        skipped |= top.scored < top.blocks / 2
    assert skipped


def test_thresholds_find_the_exact_top_buckets(spark):
    rnd = random.Random(4)
    # The most frequent value is nobody's favourite in a single part.
    rows = [(p, v) for p in range(6) for v in [f"own{p}-{rnd.randrange(3)}" for _ in range(40)] + ["everywhere"] * 13 + [f"r{p}-{k}" for k in range(80)] + [None] * 5]
    df = spark.createDataFrame(rows, "p int, v string").repartition(6, "p")
    want = [tuple(r) for r in df.where("v is not null").groupBy("v").count().orderBy(F.desc("count"), "v").limit(4).collect()]
    assert [tuple(r) for r in aggs.terms_topk(df, "v", 4).collect()] == want and want[0] == ("everywhere", 78)
    assert aggs.terms_topk(df, "v", 10_000).count() == df.where("v is not null").select("v").distinct().count()
    assert aggs.terms_topk(df.where("false"), "v", 4).count() == 0


def test_standing_queries_equal_single_filters(spark):
    rows = [("ix", "1", False, "red fox and blue sky"), ("ix", "2", False, "Blue blue sky"), ("ix", "3", True, "red sky"), ("ix", "4", False, None)]
    docs = spark.createDataFrame(rows, "_index string, _id string, _deleted boolean, text string")
    asked = spark.createDataFrame([("sky", "sky"), ("both", "red"), ("both", "blue"), ("both", "blue"), ("none", "green")], "query string, term string")
    assert sorted((r["query"], r["_id"]) for r in percolate.percolate(docs, asked, "text").collect()) == [("both", "1"), ("sky", "1"), ("sky", "2")]


def test_misfits_at_any_depth(spark):
    spec = {"properties": {"u": {"properties": {"age": {"type": "long"}, "born": {"type": "date", "format": "yyyy-MM-dd"}, "a.b": {"type": "long"}}},
                           "list": {"type": "nested", "properties": {"n": {"type": "long"}, "in": {"properties": {"ok": {"type": "boolean"}}}}}}}
    bodies = ['{"u":{"age":"abc"}}', '{"u":"text"}', '{"u":{"age":"12","born":"2020-02-30","a.b":3}}', '{"u":{"born":"2020-02-28"}}', '{"list":[{"n":1},{"n":"x","in":{"ok":"maybe"}},5]}',
              '{"list":{"n":7}}', '{"u":null,"list":[]}', '{"u":[1]}', "{}", None]
    df = spark.createDataFrame(list(enumerate(bodies)), "k int, j string")
    out = mapping.apply_mapping(df, "j", spec, ["k"])
    assert sorted((r["k"], r["field"], r["value"]) for r in out.rejects.collect()) == [
        (0, "u.age", "abc"), (1, "u", "text"), (2, "u.born", "2020-02-30"), (4, "list", "5"), (4, "list.in.ok", "maybe"), (4, "list.n", "x"), (7, "u", "[1]")]
    rows = {r["k"]: r for r in out.rows.collect()}
    assert rows[2]["u"]["age"] == 12 and rows[2]["u"]["a.b"] == 3 and str(rows[3]["u"]["born"]).startswith("2020-02-28")
    assert [x and x["n"] for x in rows[4]["list"]] == [1, None, None] and [x["n"] for x in rows[5]["list"]] == [7] and rows[6]["u"] is None and rows[9]["u"] is None


def test_prefix_sums_of_any_length(spark):
    rows = [(None,), ([],), ([3],), (list(range(63)),), (list(range(64)),), (list(range(65)),), ([1] * 1000,)]
    got = [r[0] for r in spark.createDataFrame(rows, "a array<int>").select(prefix_sum(F.col("a"))).collect()]
    want = [None if a is None else [sum(a[: i + 1]) for i in range(len(a))] for (a,) in rows]
    assert got == want


def test_keyless_ops_have_items_in_every_chunk(spark):
    log = [("ix", "1", 0, "index", "a"), ("ix", None, 1, "update", "b"), ("ix", None, 2, "delete", None), (None, "1", 3, "index", "c"), ("ix", "1", 4, "update", "d"), ("ix", None, 5, "index", "e")]
    ops = spark.createDataFrame(log, "_index string, _id string, seq long, op string, name string")
    want = [(0, 201, None), (1, 404, "document_missing_exception"), (2, 404, None), (3, 400, "action_request_validation_exception"), (4, 200, None), (5, 201, None)]
    for rows in (2, 1 << 20):
        items = write.bulk_replay(None, ops, chunk_rows=rows).items
        assert sorted((r["seq"], r["status"], r["error_type"]) for r in items.collect()) == want
    updates = write.update_docs(write.bulk_replay(None, ops).table, ops.drop("op"), detect_noop=True, chunk_rows=2).items
    assert updates.count() == 6
    json_ops = ops.withColumn("_source", F.to_json(F.struct("name")))
    assert write.bulk_replay_json(None, json_ops.select("_index", "_id", "seq", "op", "_source"), chunk_rows=2).items.count() == 6
    versioned = ops.withColumn("version", F.lit(3).cast("long"))
    for res in (write.write_external(None, versioned, chunk_rows=2), write.write_internal(None, versioned, chunk_rows=2), write.write_force(None, versioned, chunk_rows=2)):
        assert res.items.count() == 6


def test_names_with_dots_are_told_from_paths(spark):
    df = spark.createDataFrame([('{"a.b":1,"a":{"b":2}}',), ('{"a":{"b":3},"c[]":[1]}',)], "j string")
    got = sorted((r["field"], r["type"], r["docs"]) for r in mapping.infer_mapping(df, "j").collect())
    assert got == [("a", "object", 2), ("a.b", "long", 2), ("a\\.b", "long", 1), ("c\\[\\]", "array", 1), ("c\\[\\][]", "long", 1)]
