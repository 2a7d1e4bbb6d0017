"""The index handle: the reference's per-index flow end to end on a store."""

import pytest
from pyspark.sql import functions as F

from docindex.api import Index
from docindex.session import scratch_path


def test_index_handle_flow(spark):
    ix = Index(spark, scratch_path(spark, "api"), "test")
    docs = spark.createDataFrame([("id", 1, "nom")], "_id string, seq long, name string")
    ix.index(docs)
    assert [(r._version, r.name) for r in ix.get("id").collect()] == [(1, "nom")]
    # Not refreshed yet: search sees nothing, get sees the write.
    ix.index(spark.createDataFrame([("id", 2, "nom")], "_id string, seq long, name string"))
    assert [r._version for r in ix.get("id").collect()] == [2]
    assert ix.search(F.col("name") == "nom").total.collect()[0].value == 0
    ix.refresh()
    res = ix.search(F.col("name") == "nom")
    assert res.total.collect()[0].value == 1
    items = ix.index(spark.createDataFrame([("id", 3, "x")], "_id string, seq long, name string"), create=True)
    assert [(r.status, r.error_type) for r in items.collect()] == [(409, "version_conflict_engine_exception")]
    ix.delete(spark.createDataFrame([("id", 4)], "_id string, seq long"))
    assert ix.get("id").count() == 0


def test_bulk_105_in_batches_of_10(spark):
    ix = Index(spark, scratch_path(spark, "api"), "index")
    ops = spark.createDataFrame([(str(i), i, "index", f"Nom {i}") for i in range(1, 106)],
                                "_id string, seq long, op string, name string")
    res = ix.bulk(ops, batch_size=10, refresh=True)
    assert [r._id for r in res.items.orderBy("seq").collect()] == [str(i) for i in range(1, 106)]
    assert res.responses.count() == 11 and not res.responses.where("errors").count()
    assert ix.search().total.collect()[0].value == 105
    assert ix.scroll(size=10).count() == 105


def test_versions_routing_and_parent_reach_the_store(spark):
    ix = Index(spark, scratch_path(spark, "api"), "v")
    docs = lambda rows: spark.createDataFrame(rows, "_id string, seq long, name string, version long")
    assert [r.status for r in ix.index(docs([("1", 1, "a", 5)]), version_type="external").collect()] == [201]
    assert [r.status for r in ix.index(docs([("1", 2, "b", 5)]), version_type="external").collect()] == [409]
    assert [r.status for r in ix.index(docs([("1", 3, "c", 5)]), version_type="external_gte").collect()] == [200]
    assert [r.status for r in ix.index(docs([("1", 4, "d", 4)]), version_type="internal").collect()] == [409]
    assert [r.status for r in ix.index(docs([("1", 5, "e", 2)]), version_type="force").collect()] == [200]
    assert [(r._version, r.name) for r in ix.get("1").collect()] == [(2, "e")]
    child = spark.createDataFrame([("c", 6, "kid", "1", None), ("r", 7, "routed", None, "k")], "_id string, seq long, name string, parent string, routing string")
    ix.index(child)
    assert ix.get("c", routing="1").count() == 1 and ix.get("r", routing="k").count() == 1 and ix.get("1").count() == 1


def test_search_arguments_index_lists_and_aliases(spark):
    root = scratch_path(spark, "api")
    a, b = Index(spark, root, "a"), Index(spark, root, "b")
    docs = lambda n: spark.createDataFrame([(str(i), i, f"word{i % 3} text", f"k{i % 2}") for i in range(n)], "_id string, seq long, body string, kind string")
    a.index(docs(9))
    b.index(docs(6))
    both = Index(spark, root, ["a", "b"])
    out = both.search(size=5, aggregations={"kinds": {"field": "kind", "size": 5}})
    assert out.total.first().value == 15 and {r.key: r.doc_count for r in out.aggregations["kinds"].collect() if not r.is_other} == {"k0": 8, "k1": 7}
    assert both.scroll(size=4).count() == 15
    hits = both.search(match=("body", "word1"), search_type="dfs_query_then_fetch")
    assert hits.total.first().value == 5 and hits.hits.first()._score > 0
    assert both.search(terminate_after=1).total.first().value <= 2 * both.n_shards
    a.put_alias("all")
    b.put_alias("all")
    assert Index(spark, root, "all").search().total.first().value == 15
    b.put_alias("all", remove=True)
    assert Index(spark, root, "all").search().total.first().value == 9


def test_mappings_and_templates_live_with_the_store(spark):
    root = scratch_path(spark, "api")
    ix = Index(spark, root, "test_index")
    ix.put_template("low", {"index_patterns": ["te*"], "order": 0, "mappings": {"_source": {"enabled": True}, "properties": {"name": {"type": "keyword"}}}})
    ix.put_template("high", {"index_patterns": ["test_*"], "order": 1, "mappings": {"_source": {"enabled": False}, "properties": {"age": {"type": "long"}}}})
    assert set(ix.mapping()["properties"]) == {"name", "age"} and Index(spark, root, "other").mapping()["properties"] == {}
    docs = spark.createDataFrame([("1", 1, '{"name": "a", "age": 3}'), ("2", 2, '{"name": "b", "age": "x"}'), ("3", 3, "no json")], "_id string, seq long, j string")
    _, rejects = ix.index_json(docs, "j", refresh=True)
    assert sorted((r._id, r.field) for r in rejects.collect()) == [("2", "age"), ("3", "_source")]
    assert [(r._id, r.age) for r in ix.search(F.col("name") == "a").hits.collect()] == [("1", 3)] and "_body" not in ix.search().hits.columns
    assert set(ix.put_mapping({"properties": {"city": {"type": "keyword"}}})["properties"]) == {"name", "age", "city"}
    with pytest.raises(ValueError):
        ix.put_mapping({"properties": {"age": {"type": "keyword"}}})


def test_index_handle_stats_merge_analyze(spark):
    ix = Index(spark, scratch_path(spark, "api"), "test")
    ops = spark.createDataFrame([("1", 1, "index", "a b"), ("2", 2, "index", "c"), ("2", 3, "delete", None)],
                                "_id string, seq long, op string, name string")
    ix.bulk(ops, refresh=True)
    st = ix.stats().collect()[0]
    assert (st.live_docs, st.deleted_docs, st.max_version) == (1, 1, 2)
    ix.force_merge(max_files=1, only_expunge_deletes=True)
    st2 = ix.stats().collect()[0]
    assert (st2.live_docs, st2.deleted_docs) == (1, 0)
    assert [r.token for r in ix.analyze("name").orderBy("position").collect()] == ["a", "b"]


def test_versioned_updates_and_deletes_and_noops(spark):
    ix = Index(spark, scratch_path(spark, "api"), "v")
    rows = lambda *r: spark.createDataFrame(list(r), "_id string, seq long, op string, name string, version long")
    got = lambda items: [(r.status, r._version) for r in items.orderBy("seq").collect()]
    assert got(ix.bulk(rows(("1", 1, "index", "a", 5), ("1", 2, "delete", None, 6), ("1", 3, "update", "b", 7)), version_type="external")) == [(201, 5), (200, 6), (400, None)]
    assert ix.get("1").count() == 0
    assert got(ix.bulk(rows(("1", 4, "index", "c", 6), ("1", 5, "index", "d", None), ("1", 6, "index", "e", 8)), version_type="external")) == [(409, None), (409, None), (200, 8)]
    change = lambda name, version, seq: spark.createDataFrame([("1", seq, name, version)], "_id string, seq long, name string, version long")
    assert got(ix.update(change("stale", 7, 7))) == [(409, None)] and got(ix.update(change("f", 8, 8))) == [(200, 9)]
    assert [(r.name, r._version) for r in ix.get("1").collect()] == [("f", 9)]
    same = spark.createDataFrame([("1", 9, "f")], "_id string, seq long, name string")
    assert [(r.status, r.result, r._version) for r in ix.update(same, detect_noop=True).collect()] == [(200, "noop", 9)]
    assert [(r.status, r._version) for r in ix.update(same.withColumn("seq", F.lit(10).cast("long"))).collect()] == [(200, 10)]


def test_search_sees_the_last_refresh(spark):
    root = scratch_path(spark, "api")
    ix = Index(spark, root, "i")
    docs = lambda *r: spark.createDataFrame(list(r), "_id string, seq long, name string")
    ix.index(docs(("1", 1, "a"), ("2", 2, "b")), refresh=True)
    ix.index(docs(("1", 3, "a2"), ("3", 4, "c")))
    ix.delete(spark.createDataFrame([("2", 5)], "_id string, seq long"))
    seen = lambda h: sorted((r._id, r.name) for r in h.search().hits.collect())
    assert seen(ix) == [("1", "a"), ("2", "b")] and seen(Index(spark, root, "i")) == [("1", "a2"), ("3", "c")]
    assert [r.name for r in ix.get("1").collect()] == ["a2"] and ix.scroll(size=1).count() == 2
    ix.refresh()
    assert seen(ix) == [("1", "a2"), ("3", "c")]


def test_mapping_of_several_indices_and_changed_types(spark):
    root = scratch_path(spark, "api")
    a, b = Index(spark, root, "a"), Index(spark, root, "b")
    a.put_mapping({"properties": {"text": {"type": "text", "analyzer": "standard"}, "n": {"type": "keyword"}}})
    b.put_mapping({"properties": {"other": {"type": "long"}}})
    a.index(spark.createDataFrame([("1", 1, "Some Words", "12"), ("2", 2, "more words", "x")], "_id string, seq long, text string, n string"), refresh=True)
    assert {k: set(m["properties"]) for k, m in Index(spark, root, ["a", "b"]).mappings().items()} == {"a": {"text", "n"}, "b": {"other"}}
    with pytest.raises(ValueError):
        a.put_mapping({"properties": {"n": {"type": "long"}}})
    a.put_mapping({"properties": {"n": {"type": "long"}, "text": {"type": "text", "search_analyzer": "whitespace"}}}, update_all_types=True)
    assert a.mapping()["properties"]["text"] == {"type": "text", "analyzer": "standard", "search_analyzer": "whitespace"}
    assert sorted((r._id, r.n) for r in a.search().hits.collect()) == [("1", 12), ("2", None)]
    # The search analyzer keeps the case of the query, the index analyzer has lowered the text.
    assert a.search(match=("text", "Words")).total.first().value == 0 and a.search(match=("text", "words")).total.first().value == 2
