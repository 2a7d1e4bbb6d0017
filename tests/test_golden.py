"""The reference's asserted behaviours (FIXTURES §B) on tiny frames."""

from pyspark.sql import functions as F

from docindex.functions.analyze import analyze, analyze_text, search_terms
from docindex.operators import mapping as M
from docindex.operators import search as S
from docindex.operators import write as W
from docindex.operators.rank import global_rank


def _docs(spark, n, index="scroll_index"):
    ops = spark.createDataFrame([(index, str(i), i, "index", f"Nom {i}") for i in range(1, n + 1)],
                                "_index string, _id string, seq long, op string, name string")
    return W.bulk_replay(None, ops).table


def test_analyze_this_is_a_test(spark):
    rows = [tuple(r) for r in analyze_text(spark, "this is a test").orderBy("position").collect()]
    assert rows == [("text", "this", 0, 4, "<ALPHANUM>", 0), ("text", "is", 5, 7, "<ALPHANUM>", 1),
                    ("text", "a", 8, 9, "<ALPHANUM>", 2), ("text", "test", 10, 14, "<ALPHANUM>", 3)]


def test_analyze_unicode_offsets_and_numbers(spark):
    rows = analyze_text(spark, "  Grüße, l'été 2024!").orderBy("position").collect()
    assert [(r.token, r.start_offset, r.end_offset, r.type) for r in rows] == [
        ("grüße", 2, 7, "<ALPHANUM>"), ("l", 9, 10, "<ALPHANUM>"), ("été", 11, 14, "<ALPHANUM>"),
        ("2024", 15, 19, "<NUM>")]
    assert search_terms("Grüße, l'été") == ["grüße", "l", "été"]


def test_whitespace_and_keyword_analyzers(spark):
    df = spark.createDataFrame([("i", "1", "Hello  World!")], "_index string, _id string, t string")
    ws = analyze(df, "t", "whitespace").orderBy("position").collect()
    assert [(r.token, r.start_offset, r.end_offset) for r in ws] == [("Hello", 0, 5), ("World!", 7, 13)]
    kw = analyze(df, "t", "keyword").collect()
    assert [(r.token, r.start_offset, r.end_offset, r.position) for r in kw] == [("Hello  World!", 0, 13, 0)]


def test_mget_same_key_twice_and_missing(spark):
    table = _docs(spark, 2, "test")
    keys = spark.createDataFrame([(0, "test", "1"), (1, "test", "1"), (2, "test", "9")],
                                 "pos long, _index string, _id string")
    rows = S.mget(table, keys).orderBy("pos").collect()
    assert [(r._id, r.found, r.name) for r in rows] == [("1", True, "Nom 1"), ("1", True, "Nom 1"), ("9", False, None)]


def test_mget_shuffle_path_matches_broadcast_path(spark):
    table = _docs(spark, 50, "test")
    keys = spark.createDataFrame([(i, "test", str(i % 60)) for i in range(200)], "pos long, _index string, _id string")
    a = sorted(tuple(r) for r in S.mget(table, keys).collect())
    b = sorted(tuple(r) for r in S.mget(table, keys.repartition(3)).collect())
    assert a == b and len(a) == 200


def test_scroll_105_by_10(spark):
    pages = S.scroll(S.match_all(_docs(spark, 105)), 10)
    assert pages.count() == 105
    counts = sorted((r.page, r["count"]) for r in pages.groupBy("page").count().collect())
    assert counts[0] == (0, 10) and counts[-1] == (10, 5) and len(counts) == 11


def test_scroll_empty_result_is_empty(spark):
    docs = S.match_all(_docs(spark, 5))
    assert S.scroll(docs.where(F.lit(False)), 10).count() == 0


def test_global_rank_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    ranked = global_rank(df, ["g", "k"], "r", num_partitions=7)
    got = sorted((r.g, r.k, r.r) for r in ranked.collect())
    want = sorted(((g, k) for g, k in ((r.g, r.k) for r in df.collect())))
    assert [x[2] for x in sorted(got, key=lambda t: (t[0], t[1]))] == list(range(1, 5001))
    assert [(g, k) for g, k, _ in sorted(got, key=lambda t: (t[0], t[1]))] == want


def test_search_before_and_after_refresh(spark):
    visible_at = W.visible_at
    ops = spark.createDataFrame([("test", "id", 1, "index", "nom"), ("test", "id", 2, "index", "nom")],
                                "_index string, _id string, seq long, op string, name string")
    before = S.search(visible_at(ops, 0), F.col("name") == "nom").total.collect()[0]
    after = S.search(visible_at(ops, 2), F.col("name") == "nom")
    assert (before.value, before.relation) == (0, "eq")
    assert after.total.collect()[0].value == 1
    assert [r.name for r in after.hits.collect()] == ["nom"]


def test_search_paging_and_default_size(spark):
    docs = S.match_all(_docs(spark, 45, "test"))
    page = S.search(docs, order=[F.col("_id").cast("int")], from_=20, size=20).hits
    assert [int(r._id) for r in page.collect()] == list(range(21, 41))
    assert S.search(docs).hits.count() == S.DEFAULT_SIZE


def test_term_keyword_and_text(spark):
    df = spark.createDataFrame([("i", "1", False, "Nom", "Le nom est court"), ("i", "2", False, "nom", "Autre")],
                               "_index string, _id string, _deleted boolean, name string, body string")
    assert [r._id for r in S.term(df, "name", "nom").collect()] == ["2"]
    assert [r._id for r in S.term(df, "body", "nom", text_fields=("body",)).collect()] == ["1"]
    toks = analyze(df, "body")
    assert [r._id for r in S.term(df, "body", "court", text_fields=("body",), tokens=toks).collect()] == ["1"]


def test_mapping_add_field_keeps_old(spark):
    from pyspark.sql import types as T

    old = T.StructType([T.StructField("message", T.StringType())])
    new = T.StructType([T.StructField("message", T.StringType()), T.StructField("user_name", T.StringType())])
    ch = M.evolve_mapping(old, new)
    assert ch.accepted and [f.name for f in ch.schema.fields] == ["message", "user_name"]


def test_mapping_conflict_refused_then_accepted_with_flag(spark):
    from pyspark.sql import types as T

    old = T.StructType([T.StructField("text", T.StringType())])
    new = T.StructType([T.StructField("text", T.LongType())])
    assert not M.evolve_mapping(old, new).accepted
    ch = M.evolve_mapping(old, new, update_all_types=True)
    assert ch.accepted and ch.schema["text"].dataType == T.LongType()


def test_alias_resolves_to_index(spark):
    docs = _docs(spark, 3, "test")
    actions = spark.createDataFrame([(1, "add", "test", "alias")], "seq int, action string, index string, alias string")
    out = M.expand_aliases(docs, actions).where(F.col("_alias") == "alias")
    assert out.count() == 3


def test_template_pattern_and_date_format(spark):
    docs = spark.createDataFrame([("test", "1"), ("other", "2")], "_index string, _id string")
    tagged = M.apply_templates(docs, [{"name": "t", "index_patterns": ["te*"], "order": 0}])
    assert {r._id: r._template for r in tagged.collect()} == {"1": "t", "2": None}
    mapping = {"_source": {"enabled": False}, "properties": {
        "host_name": {"type": "keyword"},
        "created_at": {"type": "date", "format": "EEE MMM dd HH:mm:ss Z YYYY"}}}
    js = spark.createDataFrame([(1, '{"host_name": "h", "created_at": "Wed Jan 03 10:00:00 +0000 2024"}'),
                                (2, '{"host_name": "h", "created_at": "yesterday"}')], "k int, j string")
    res = M.apply_mapping(js, "j", mapping, keep=["k"], drop_source=True)
    rows = {r.k: r for r in res.rows.collect()}
    assert "_source" not in res.rows.columns
    assert rows[1].created_at is not None and rows[2].created_at is None
    assert [(r.k, r.field) for r in res.rejects.collect()] == [(2, "created_at")]


def test_iter_pages_in_order(spark):
    pages = S.scroll(S.match_all(_docs(spark, 35)), 10)
    got = [(p, len(rows)) for p, rows in S.iter_pages(pages)]
    assert got == [(0, 10), (1, 10), (2, 10), (3, 5)]


def test_match_query_scores_matching_docs(spark):
    from docindex.functions.scoring import match_query

    df = spark.createDataFrame([("i", "1", False, "the cat sat"), ("i", "2", False, "a dog"),
                                ("i", "3", False, "The cat, the hat")],
                               "_index string, _id string, _deleted boolean, body string")
    hits = {r._id: r._score for r in match_query(df, "body", "The CAT").collect()}
    assert set(hits) == {"1", "3"} and hits["3"] > hits["1"] > 0


def test_infer_mapping_nested_paths(spark):
    df = spark.createDataFrame([('{"a": 1, "o": {"b": "x", "c": {"d": 2.5}}, "n": null}',), ('{"a": 2.0, "o": {"b": "y"}}',)],
                               "j string")
    got = sorted(tuple(r) for r in M.infer_mapping(df, "j").collect())
    assert got == [("a", "double", 1), ("a", "long", 1), ("o", "object", 2), ("o.b", "text", 2),
                   ("o.c", "object", 1), ("o.c.d", "double", 1)]


def test_mget_default_index(spark):
    table = _docs(spark, 3, "test")
    keys = spark.createDataFrame([(0, None, "2"), (1, "other", "2")], "pos long, _index string, _id string")
    rows = S.mget(table, keys, default_index="test").orderBy("pos").collect()
    assert [(r._index, r.found) for r in rows] == [("test", True), ("other", False)]
