"""Every operator on nulls, empty and long texts, ties, repeated rows, an empty table and clashing column names."""

import random

import pytest

import corpus_pipeline
from docindex.llm import (chat_format, decontaminate, html_crf, kneser_ney, packing, pii_crf, quality_divergence, setsketch_dedup,
                          token_files, url_cascade)

LONG = " ".join(f"word{i % 977} of the" for i in range(60_000))
ROWS = [
    (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "one", "en"), (5, "One", "fr"), (6, LONG, "en"), (7, LONG + " end", "en"),
    (8, "same text here again, for the third time or so", "de"), (8, "same text here again, for the third time or so", "de"),
    (9, "same id, another text", "xx"), (9, "and a second text under this id", "xx"), (None, "a row without an id", "en"), (None, None, None),
    (10, "mail a@b.example.org now\u2028\x1c é ß 日本語 😀 <|endoftext|>", "en"),
]
CLASHES = "n node sig regs id kept words at hit items row key gram lo hi side set root place start ids spans".split()


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*r, "src", 0, *["x"] * len(CLASHES)) for r in ROWS]
    names = "".join(f", `{c}` string" for c in CLASHES)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long{names}")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "one"), (2, None), (3, "..."), (3, "same text here"), (4, "one")], "item_id long, text string")


def _ids(rows, col="doc_id"):
    return sorted((r[col] is None, r[col] or 0) for r in rows)


WANTED = sorted((r[0] is None, r[0] or 0) for r in ROWS)


def test_quality(odd):
    rows = quality_divergence.scores(odd).collect()
    assert _ids(rows) == WANTED
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[1]["n_words"] == by[2]["n_words"] == by[3]["n_words"] == 0 and by[1]["base_failed"] and not by[1]["kept"]
    assert by[6]["n_words"] == 180_000 and by[6]["n_repeat_words"] == 180_000 and by[6]["base_failed"]
    assert by[10]["n_words"] == 8 and by[1]["char_distance"] is None
    kept = quality_divergence.keep_good(odd)
    assert kept.schema == odd.schema and kept.count() == 0
    assert quality_divergence.scores(odd.limit(0)).count() == 0 and quality_divergence.keep_good(odd.limit(0)).count() == 0


def test_near_duplicates(odd):
    rows = setsketch_dedup.near_duplicates(odd, shingle=2).collect()
    assert _ids(rows) == WANTED
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[1]["n_shingles"] == 0 and by[1]["component_id"] == 1 and by[1]["kept"] and by[3]["component_id"] == 3
    assert by[5]["component_id"] == 4 and not by[5]["kept"] and by[4]["n_shingles"] == 1
    assert by[7]["component_id"] == 6 and all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    kept = setsketch_dedup.keep_one(odd, shingle=2)
    assert sorted(kept.columns) == sorted(odd.columns)
    # Both texts under id 9 stay: they have nothing in common.
    assert _ids(kept.collect()) == [(False, i) for i in (1, 2, 3, 4, 6, 8, 9, 9, 10)] + [(True, 0)] * 2
    assert setsketch_dedup.near_duplicates(odd.limit(0)).count() == 0 and setsketch_dedup.keep_one(odd.limit(0)).count() == 0


def test_near_duplicates_by_rows_and_string_ids(spark):
    text = "one text that stands three times without an id and once with one"
    rows = [(None, text, 1), (None, text, 2), (None, text, 3), ("doc/7", text, 4), ("doc/10", text + " end", 5), ("doc/7", "quite another text under the same id", 6),
            ("doc/8", None, 7), ("doc/8", "", 8), (None, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, nr int")
    assert sorted(r["nr"] for r in setsketch_dedup.keep_one(docs, shingle=2).collect()) == [5, 6, 7, 8, 9]
    out = {(r["doc_id"], r["component_id"], r["kept"]) for r in setsketch_dedup.near_duplicates(docs, shingle=2).collect()}
    assert ("doc/10", "doc/10", True) in out and ("doc/7", "doc/10", False) in out and (None, None, True) in out


def test_least_ids_are_not_broadcast_once_a_salt(spark):
    """The table of least ids, a row a salt, is far larger than Spark takes it to be: the driver must not hold it."""
    common = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(100 - k, f"{common} own{k}") for k in range(80)] + [(200 + k, f"alone{k} on{k} its{k} own{k}") for k in range(5)] + [(300, "alone0 on0 its0 own0")],
                                 "doc_id long, text string")

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")  # less than the linked rows, more than a row a component
    try:
        out = setsketch_dedup.near_duplicates(docs, shingle=1)
        got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    held, shown = None, out._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    assert "Final Plan" in shown and "Generate explode" in shown
    for line in shown.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        held = None if held is not None and depth <= held else held
        assert held is None or "Generate explode" not in line
        held = depth if held is None and "BroadcastExchange" in line else held
    assert got == {100 - k: (21, k == 79) for k in range(80)} | {200 + k: (200 + k, True) for k in range(5)} | {300: (200, False)}


def test_registers_of_a_union_are_the_maxima_of_its_parts():
    import numpy as np

    rnd = np.random.default_rng(7)
    for n in (1, 2, 5, 40, 3000):
        both = rnd.integers(0, 1 << 63, size=2 * n, dtype=np.uint64)
        part = lambda *sets: setsketch_dedup.sketches(np.concatenate(sets), np.cumsum([0] + [len(x) for x in sets]))
        a, b = part(both[:n], both[n:])
        assert (part(both)[0] == np.maximum(a, b)).all()


def test_personal_data(odd):
    rows = pii_crf.report(odd).collect()
    assert _ids(rows) == WANTED
    ten = next(r for r in rows if r["doc_id"] == 10)
    assert ten["n_email"] == 1 and ten["spans"] == "email:5:20"
    assert all(r["spans"] == "" for r in rows if r["doc_id"] in (1, 2, 3, 6))
    red = pii_crf.redact(odd)
    assert red.schema == odd.schema and red.where("doc_id = 10").first()["text"].startswith("mail <email> now\u2028")
    assert red.where("doc_id = 1").first()["text"] is None and pii_crf.report(odd.limit(0)).count() == 0


def test_kneser_ney(spark, odd):
    labels = spark.createDataFrame([(6, 1, 0), (7, 1, None), (8, 1, 1), (9, 1, 0), (9, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = kneser_ney.classify(odd, labels).collect()
    assert _ids(rows) == WANTED
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[6]["trusted"] and by[7]["trusted"] and not by[8]["trusted"] and not by[9]["trusted"]
    assert by[1]["perplexity"] is None and not by[1]["kept"] and not by[2]["kept"] and by[6]["kept"]
    assert by[8]["perplexity"] is None and by[8]["kept"]  # no model of German here
    assert kneser_ney.classify(odd.limit(0), labels).count() == 0 and kneser_ney.classify(odd, labels.limit(0)).count() == len(ROWS)


def test_html(spark):
    rows = [(1, None), (2, ""), (3, "<"), (3, "<"), (4, "<p>a"), (None, "<article><p>x &amp; y</article>"), (5, "<main>" + "<p>A sentence in the text. " * 20_000)]
    pages = spark.createDataFrame([(*r, "u", "t", 1) for r in rows], "page_id long, html string, url string, text string, n_chars int")
    out = html_crf.extract(pages, keep=("url",)).collect()
    assert len(out) == len(rows) and {r["page_id"]: r["text"] for r in out}[None] == "x & y"
    by = {r["page_id"]: r for r in out}
    assert by[1]["text"] == by[2]["text"] == "" and by[5]["text"].count("\n") == 19_999 and by[5]["n_chars"] == len(by[5]["text"])
    assert html_crf.extract(pages.limit(0)).count() == 0


def test_chats(spark):
    rows = [(1, 1, "user", None), (1, 0, None, "hi"), (1, None, "system", "first"), (1, 1, "user", None), (1, 2, "assistant", "a"), (1, 3, "assistant", "b\\"),
            (None, 0, "user\n<|x", "lost <|im_end|>\n \\<|")]
    turns = spark.createDataFrame([(*r, "z", "z") for r in rows], "conv_id long, turn long, role string, text string, turns string, segments string")
    out = {r["conv_id"]: r for r in chat_format.report(turns).collect()}
    assert out[1]["n_turns"] == 6 and out[1]["loss_chars"] == 3 and out[None]["n_turns"] == 1
    read = chat_format.format_chats(turns).select("conv_id", chat_format.read_turns(chat_format.F.col("formatted")).alias("t")).collect()
    told = {r["conv_id"]: [tuple(x) for x in r["t"]] for r in read}
    assert told[None] == [("user\n<|x", "lost <|im_end|>\n \\<|")]
    assert told[1] == [("system", "first"), ("", "hi"), ("user", ""), ("user", ""), ("assistant", "a"), ("assistant", "b\\")]
    assert chat_format.report(turns.limit(0)).count() == 0


def test_token_files(spark, odd):
    root, manifest = token_files.write(odd, shards=3)
    rows = token_files.read(spark, root, manifest, with_ids=True).collect()
    assert _ids(rows) == WANTED and sum(r["n_ids"] for r in manifest) == sum(r["n_tokens"] for r in rows)
    ordered = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered[2:]] == sorted(r["doc_id"] for r in ordered[2:]) and ordered[0]["doc_id"] is None
    assert len(token_files.lookup(root, manifest, 9)) == 2 and len(token_files.lookup(root, manifest, 8)) == 2
    assert token_files.lookup(root, manifest, 1)[0].tolist() == [0] and token_files.lookup(root, manifest, 77) == []
    assert token_files.report(odd.limit(0)).count() == 0
    asked = spark.createDataFrame([(9,), (8,), (1,), (77,), (None,), (9,)], "doc_id long")
    got = sorted((r["doc_id"], r["nr"], len(r["ids"]) // manifest[0]["width"]) for r in token_files.lookup_all(asked, root, manifest).collect())
    assert [g[:2] for g in got] == [(1, 0), (8, 0), (8, 1), (9, 0), (9, 1)] and got[0][2] == 1


def test_a_fault_of_the_index_is_seen(spark, odd):
    import glob

    root, manifest = token_files.write(odd, shards=1)
    path = glob.glob(f"{root.removeprefix('file:')}/*.mph")[0]
    good = bytearray(open(path, "rb").read())
    n = sum(r["n_docs"] for r in manifest)
    index = token_files.Index(bytes(good))
    at = bytes(good).rindex(index.docs.tobytes())
    good[at: at + 8 * len(index.docs)] = index.docs[::-1].tobytes()
    open(path, "wb").write(good)
    with pytest.raises(Exception, match="does not lead to its documents"):
        token_files.read(spark, root, manifest).collect()
    assert n == len(ROWS)


def test_keys_with_many_rows_across_batches(spark):
    """A repeated key whose rows go on over the batches of the document table."""
    docs = spark.range(25_000).selectExpr("IF(id < 200, CAST(NULL AS long), IF(id < 23000, 5L, id)) AS doc_id", "concat('text ', id) AS text")
    root, manifest = token_files.write(docs, shards=1)
    rows = token_files.read(spark, root, manifest).collect()
    assert len(rows) == 25_000 and sum(r["doc_id"] == 5 for r in rows) == 22_800
    assert token_files.lookup_all(spark.createDataFrame([(5,), (24_999,)], "doc_id long"), root, manifest).count() == 22_801


def test_string_keys(spark, odd):
    named = odd.select(chat_format.F.concat(chat_format.F.lit("doc/"), chat_format.F.col("doc_id")).alias("doc_id"), "text")
    root, manifest = token_files.write(named, shards=2)
    assert len(token_files.lookup(root, manifest, "doc/9")) == 2 and token_files.lookup(root, manifest, "doc/99") == []


def test_decontamination(odd, bench):
    rows = decontaminate.report(odd, bench).collect()
    assert _ids(rows) == WANTED
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[4]["contaminated"] and by[4]["n_items"] == 2 and by[5]["n_hit"] == 1 and by[8]["n_hit"] == 3 and by[1]["n_words"] == 0
    left = decontaminate.remove_documents(odd, bench)
    assert left.columns == odd.columns and _ids(left.collect()) == [x for x in WANTED if x not in ((False, 4), (False, 5), (False, 8))]
    cut = decontaminate.remove_spans(odd, bench)
    assert cut.columns == odd.columns and cut.count() == len(ROWS) and cut.where("doc_id = 8").first()["text"].startswith(" again")
    assert decontaminate.report(odd.limit(0), bench).count() == 0 and decontaminate.report(odd, bench.limit(0)).where("n_hit > 0").count() == 0


def test_decontamination_beyond_the_set(odd, bench):
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    want = key(decontaminate.report(odd, bench))
    assert key(decontaminate.report(odd, bench, exact_bytes=0)) == want  # packed bits
    assert key(decontaminate.report(odd, bench, exact_bytes=0, packed_bytes=0, text_bytes=0)) == want  # every position by a shuffle join


def test_decontamination_with_many_windows(spark):
    """200,000 windows: the packed set still decides which positions go on, and the rows are right."""
    from tests.llm import brute

    rnd = random.Random(8)
    words = lambda n: " ".join(f"w{rnd.randrange(20_000)}x" for _ in range(n))
    items = [(i, words(212)) for i in range(1000)]
    docs = [(i, words(120)) for i in range(60)]
    docs += [(1000 + i, " ".join(["start", *items[i][1].split()[20: 20 + 12 + i % 3], "end"])) for i in range(30)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in decontaminate.report(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == brute.contamination(docs, items)
    windows = decontaminate.test_windows(bench)
    n = windows.select("anchor").distinct().count()
    known = decontaminate.HashSet(windows.select("anchor").distinct(), n, decontaminate.EXACT_BYTES, decontaminate.PACKED_BYTES)
    assert n > 150_000 and known.usable and not known.exact
    assert windows.where(~known.holds(chat_format.F.col("anchor"))).count() == 0
    others = spark.range(200_000).select(chat_format.F.xxhash64("id").alias("h"))
    assert others.where(known.holds(chat_format.F.col("h"))).count() < 0.02 * 200_000


def test_packing(odd):
    rows = packing.pieces(odd).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 1 and max(r["offset"] + r["length"] for r in rows) <= 2048
    assert sum(r["start"] == 0 for r in rows) == len(ROWS) and packing.pieces(odd.limit(0)).count() == 0


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "HTTP://A.Example.NET/en/x?y"), (4, "HTTP://A.Example.NET/en/x?y"), (None, "https://b.org"), (5, "x://"), (6, "http://É.com#f")]
    pages = spark.createDataFrame([(*r, "h", "p", "k") for r in rows], "page_id long, url string, host string, path string, key string")
    out = url_cascade.judge(pages, url_cascade.insecure_hosts(pages)).collect()
    got = sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out), key=repr)
    assert len(out) == len(rows) and (4, "a.example.net", "/en/x", "example.net/en/", "allow") in got
    assert (1, "", "", None, "block") in got or (1, "", "", None, "allow") in got
    assert (6, "É.com", "", None, "block") in got and (None, "b.org", "", None, "allow") in got
    none = url_cascade.judge(pages, spark.createDataFrame([(None,)], "key string")).where("rule is null and verdict = 'block'")
    assert none.count() == 0 and url_cascade.judge(pages.limit(0), url_cascade.insecure_hosts(pages)).count() == 0


def test_pipeline_on_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
