"""W8/W9 replay against a plain Python fold, including hot keys split over chunks."""

import random

import pytest

from docindex.operators import write as W

OPS = ["index", "create", "update", "delete"]


def fold(stored, ops):
    """Reference fold: stored {key: (exists, version, a, b)}, ops sorted by seq."""
    state = dict(stored)
    items = []
    for seq, key, op, a, b in sorted(ops):
        ex, ver, fa, fb = state.get(key, (False, 0, None, None))
        if op == "index":
            status = 200 if ex else 201
            state[key] = (True, ver + 1, a, b)
            items.append((seq, status, ver + 1))
        elif op == "create":
            if ex:
                items.append((seq, 409, None))
            else:
                state[key] = (True, ver + 1, a, b)
                items.append((seq, 201, ver + 1))
        elif op == "update":
            if ex:
                state[key] = (True, ver + 1, a if a is not None else fa, b if b is not None else fb)
                items.append((seq, 200, ver + 1))
            else:
                items.append((seq, 404, None))
        else:
            if ex:
                state[key] = (False, ver + 1, None, None)
                items.append((seq, 200, ver + 1))
            else:
                items.append((seq, 404, None))
    return state, items


def random_log(rng, n, keys, hot_share=0.0):
    ops = []
    for seq in range(1, n + 1):
        key = "hot" if rng.random() < hot_share else f"k{rng.randrange(keys)}"
        op = rng.choice(OPS)
        a = rng.choice([None, rng.randrange(5)]) if op != "delete" else None
        b = rng.choice([None, f"s{rng.randrange(3)}"]) if op != "delete" else None
        ops.append((seq, key, op, a, b))
    return ops


def to_frames(spark, stored, ops):
    odf = spark.createDataFrame([("ix", k, s, o, a, b) for s, k, o, a, b in ops],
                                "_index string, _id string, seq long, op string, a long, b string")
    sdf = spark.createDataFrame([("ix", k, v, not e, 0, fa, fb) for k, (e, v, fa, fb) in stored.items()],
                                "_index string, _id string, _version long, _deleted boolean, _seq long, a long, b string")
    return sdf, odf


@pytest.mark.parametrize("chunk_rows,hot", [(1 << 20, 0.0), (3, 0.0), (4, 0.4), (1, 0.3)])
def test_replay_matches_fold(spark, chunk_rows, hot):
    rng = random.Random(7 + chunk_rows)
    stored = {f"k{i}": (rng.random() < 0.6, rng.randrange(1, 4), rng.randrange(5), "s0") for i in range(0, 6)}
    stored = {k: (e, v, a if e else None, b if e else None) for k, (e, v, a, b) in stored.items()}
    ops = random_log(rng, 300, 10, hot)
    want_state, want_items = fold(stored, ops)
    sdf, odf = to_frames(spark, stored, ops)
    res = W.bulk_replay(sdf, odf, chunk_rows=chunk_rows)
    got_items = sorted((r.seq, r.status, r._version) for r in res.items.collect())
    assert got_items == sorted(want_items)
    got = {r._id: (not r._deleted, r._version, r.a, r.b) for r in res.table.collect()}
    assert got == want_state


def test_index_twice_versions(spark):
    ops = spark.createDataFrame([("test", "id", 1, "nom"), ("test", "id", 2, "nom")],
                                "_index string, _id string, seq long, name string")
    res = W.index_docs(None, ops.where("seq = 1"))
    assert [r._version for r in res.table.collect()] == [1]
    res2 = W.index_docs(res.table, ops.where("seq = 2"))
    assert [(r._version, r.name) for r in res2.table.collect()] == [(2, "nom")]


def test_create_twice_conflicts(spark):
    ops = spark.createDataFrame([("test", "id", 1, "nom"), ("test", "id", 2, "nom")],
                                "_index string, _id string, seq long, name string")
    items = sorted(W.create_docs(None, ops).items.collect(), key=lambda r: r.seq)
    assert [(r.status, r.error_type) for r in items] == [(201, None), (409, "version_conflict_engine_exception")]


def test_delete_then_get_finds_nothing(spark):
    from docindex.operators.search import get_doc

    ops = spark.createDataFrame([("test", "id", 1, "index", "nom"), ("test", "id", 2, "delete", None)],
                                "_index string, _id string, seq long, op string, name string")
    res = W.bulk_replay(None, ops)
    assert get_doc(res.table, "test", "id").count() == 0
    items = sorted(res.items.collect(), key=lambda r: r.seq)
    assert [(r._id, r.status) for r in items] == [("id", 201), ("id", 200)]


def test_update_noop_keeps_version(spark):
    stored = spark.createDataFrame([("t", "1", 3, False, 0, 5, "x")],
                                   "_index string, _id string, _version long, _deleted boolean, _seq long, a long, b string")
    delta = spark.createDataFrame([("t", "1", 10, 5, None), ("t", "1", 11, 6, None), ("t", "2", 12, 1, None)],
                                  "_index string, _id string, seq long, a long, b string")
    res = W.update_docs(stored, delta, detect_noop=True, chunk_rows=1)
    items = sorted(res.items.collect(), key=lambda r: r.seq)
    assert [(r.result, r._version, r.status) for r in items] == [("noop", 3, 200), ("updated", 4, 200), (None, None, 404)]
    row = res.table.collect()[0]
    assert (row._version, row.a, row.b) == (4, 6, "x")


def test_bulk_105_by_10(spark):
    from docindex.operators.rank import batch_numbers

    ops = spark.createDataFrame([("index", str(i), i, "index", f"Nom {i}") for i in range(1, 106)],
                                "_index string, _id string, seq long, op string, name string")
    res = W.bulk_replay(None, ops)
    items = batch_numbers(res.items, "seq", 10)
    assert [r._id for r in items.orderBy("seq").collect()] == [str(i) for i in range(1, 106)]
    summary = W.bulk_batch_summary(items).orderBy("batch_no").collect()
    assert len(summary) == 11 and summary[-1]["items"] == 5 and not any(r.errors for r in summary)
    assert res.table.where("not _deleted").count() == 105


def cas_fold(stored, ops):
    state = dict(stored)
    items = []
    for seq, key, g in sorted(ops):
        v = state.get(key, 0)
        if g is None or g == v:
            state[key] = v + 1
            items.append((seq, 201 if v == 0 else 200, v + 1))
        else:
            items.append((seq, 409, None))
    return state, items


@pytest.mark.parametrize("chunk_rows,hot", [(1 << 20, 0.0), (2, 0.5), (5, 0.9)])
def test_write_internal_matches_fold(spark, chunk_rows, hot):
    rng = random.Random(11 + chunk_rows)
    stored = {f"k{i}": rng.randrange(0, 3) for i in range(4)}
    ops = []
    for seq in range(1, 400):
        key = "hot" if rng.random() < hot else f"k{rng.randrange(6)}"
        g = None if rng.random() < 0.3 else rng.randrange(0, 25)
        ops.append((seq, key, g))
    want_state, want_items = cas_fold(stored, ops)
    sdf = spark.createDataFrame([("ix", k, v, False, 0) for k, v in stored.items()],
                                "_index string, _id string, _version long, _deleted boolean, _seq long")
    odf = spark.createDataFrame([("ix", k, s, g, s * 10) for s, k, g in ops],
                                "_index string, _id string, seq long, version long, payload long")
    res = W.write_internal(sdf, odf, chunk_rows=chunk_rows)
    assert sorted((r.seq, r.status, r._version) for r in res.items.collect()) == sorted(want_items)
    got = {r._id: r._version for r in res.table.collect()}
    assert got == {k: v for k, v in want_state.items() if v > 0 or k in stored}


def test_json_replay_partial_updates_and_nulls(spark):
    stored = spark.createDataFrame([("t", "1", 2, False, 0, '{"a": 1, "b": "x"}')],
                                   "_index string, _id string, _version long, _deleted boolean, _seq long, _source string")
    ops = spark.createDataFrame([
        ("t", "1", 10, "update", '{"b": null, "c": [1, 2]}'),
        ("t", "2", 11, "create", '{"z": {"y": true}}'),
        ("t", "2", 12, "update", '{"w": 3}'),
        ("t", "3", 13, "update", '{"q": 1}'),
        ("t", "2", 14, "index", '{"only": "this"}'),
    ], "_index string, _id string, seq long, op string, _source string")
    res = W.bulk_replay_json(stored, ops, chunk_rows=2)
    got = {r._id: (r._version, r._deleted, r._source) for r in res.table.collect()}
    assert got == {"1": (3, False, '{"a":1,"b":null,"c":[1,2]}'), "2": (3, False, '{"only":"this"}')}
    assert sorted((r.seq, r.status) for r in res.items.collect()) == [(10, 200), (11, 201), (12, 200), (13, 404), (14, 200)]


def test_post_without_id_gets_auto_id_and_validate_log(spark):
    ops = spark.createDataFrame([("t", None, 1, "index", "a"), ("t", None, 2, "index", "b"),
                                 ("t", None, 3, "delete", None), ("t", "k", 4, "index", "c"), ("t", "k", 4, "update", "d")],
                                "_index string, _id string, seq long, op string, name string")
    res = W.bulk_replay(None, ops.where("seq < 4"))
    rows = res.table.collect()
    assert len(rows) == 2 and all(r._id and len(r._id) == 64 for r in rows)
    assert sorted(r.status for r in res.items.collect()) == [201, 201, 404]
    assert sorted(r.op for r in W.validate_log(ops).collect()) == ["index", "update"]
