"""Property: every standard token is the lower-cased text between its offsets, positions are 0..n-1."""

import random

import regex

from docindex.functions.analyze import analyze

ALPHABET = list("abcXYZ019 ,.;'!\n\téüßÉçñ-_") + ["日", "本", "٣", "😀"]


def test_tokens_match_offsets(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 60))) for _ in range(200)]
    df = spark.createDataFrame([("ix", str(i), t) for i, t in enumerate(texts)], "_index string, _id string, text string")
    toks = {}
    for r in analyze(df, "text").collect():
        toks.setdefault(int(r._id), []).append(r)
    for i, t in enumerate(texts):
        rows = sorted(toks.get(i, []), key=lambda r: r.position)
        want = [(m.start(), m.end(), m.group(0).lower()) for m in regex.finditer(r"[\p{L}\p{N}]+", t)]
        assert [(r.start_offset, r.end_offset, r.token) for r in rows] == want
        assert [r.position for r in rows] == list(range(len(rows)))
        for r in rows:
            assert r.type == ("<NUM>" if regex.fullmatch(r"\p{N}+", t[r.start_offset:r.end_offset]) else "<ALPHANUM>")


# Texts and their words by the word-break rules of UAX #29 (marks, inner marks, connectors, scripts).
BREAKS = [
    ("can't", ["can't"]), ("e\u0301a", ["e\u0301a"]), ("3.14 1,250.5", ["3.14", "1,250.5"]), ("a.b.c", ["a.b.c"]), ("a. b", ["a", "b"]), ("3a.4b", ["3a", "4b"]),
    ("a:b 1:2", ["a:b", "1", "2"]), ("_x1_ __", ["_x1_"]), ("a1,b", ["a1", "b"]), ("1,a", ["1", "a"]), ("\u65e5\u672c\u8a9e", ["\u65e5", "\u672c", "\u8a9e"]),
    ("\u30c6\u30b9\u30c8x", ["\u30c6\u30b9\u30c8", "x"]), ("\u3042\u3044", ["\u3042", "\u3044"]), ("don\u2019t 'quoted'", ["don\u2019t", "quoted"]), ("a\u00adb", ["a\u00adb"]),
    ("o'clock''s", ["o'clock", "s"]), ("\u05d0\u05d1 \u0430\u0431", ["\u05d0\u05d1", "\u0430\u0431"]), ("...", []), ("", []), ("1.", ["1"]),
]


def test_unicode_word_breaks(spark):
    from docindex.functions.analyze import analyze

    df = spark.createDataFrame([(str(k), t) for k, (t, _) in enumerate(BREAKS)], "_id string, text string")
    got: dict = {}
    for r in analyze(df, "text", "unicode").orderBy("_id", "position").collect():
        text = BREAKS[int(r["_id"])][0]
        assert text[r["start_offset"]: r["end_offset"]].lower() == r["token"]
        got.setdefault(int(r["_id"]), []).append(r["token"])
    assert [got.get(k, []) for k in range(len(BREAKS))] == [w for _, w in BREAKS]


def test_unicode_analyzer_on_long_tokens(spark):
    from docindex.functions.analyze import analyze

    df = spark.createDataFrame([("1", "x" * 300_000), ("2", "1.2" * 20_000), ("3", "a1" * 50_000), ("4", ".'" * 50_000)], "_id string, text string")
    rows = analyze(df, "text", "unicode").collect()
    assert {r["_id"] for r in rows} == {"1", "2", "3"} and sum(len(r["token"]) for r in rows if r["_id"] == "1") == 300_000
    assert sum(r["_id"] == "3" for r in rows) == 1
