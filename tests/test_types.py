"""Generation 5/6 mapping types: the same id once per type, typeless writes refused."""

import pytest

from docindex.operators import write as W
from docindex.operators.types import type_filter, with_types


def test_same_id_in_two_types(spark):
    ops = spark.createDataFrame([("ix", "a", "1", 1, "index", "x"), ("ix", "b", "1", 2, "index", "y"),
                                 ("ix", "a", "1", 3, "update", "z")],
                                "_index string, _type string, _id string, seq long, op string, name string")
    res = with_types(W.bulk_replay, None, ops)
    rows = sorted((r._index, r._type, r._id, r._version, r.name) for r in res.table.collect())
    assert rows == [("ix", "a", "1", 2, "z"), ("ix", "b", "1", 1, "y")]
    assert [r.name for r in type_filter(res.table, ["b"]).collect()] == ["y"]
    assert sorted((r._type, r.status) for r in res.items.collect()) == [("a", 200), ("a", 201), ("b", 201)]


def test_typeless_write_refused(spark):
    ops = spark.createDataFrame([("ix", None, "1", 1, "index", "x")],
                                "_index string, _type string, _id string, seq long, op string, name string")
    with pytest.raises(ValueError):
        with_types(W.bulk_replay, None, ops)
