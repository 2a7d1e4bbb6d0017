"""The registered queries and operators against plain Python on the smallest tables."""

import hashlib
import math
import re
import zlib
from html import unescape

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from docindex.llm import html_crf, kneser_ney, packing, pii_crf, quality_divergence, setsketch_dedup, tokens, url_cascade
from tests.llm import brute


@pytest.fixture(scope="module")
def tables(sf_dir):
    def get(name, columns):
        return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()
    return get


@pytest.fixture(scope="module")
def run(spark, sf_dir):
    return lambda name: entry.queries()[name](spark, sf_dir).collect()


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.default_path())
    return lambda text, end: np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


def test_quality(run, tables):
    want = {i: brute.base_rules(t) for i, t in tables("documents", "doc_id, text")}
    rows = run("op1_quality_divergence")
    assert {r["doc_id"]: tuple(r)[1:7] for r in rows} == want
    assert all(not r["kept"] for r in rows if r["base_failed"])
    labels = {i: q for i, q in tables("labels", "doc_id, quality")}
    judged = [(labels[r["doc_id"]], r["kept"]) for r in rows if r["doc_id"] in labels and r["n_words"] >= 50]
    assert sum(q == k for q, k in judged) >= 0.97 * len(judged)


def test_distance():
    p, q = np.array([[0.5, 0.5, 0.0], [0.5, 0.25, 0.25]]), np.array([0.5, 0.25, 0.25])
    m = (p[0] + q) / 2
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x)
    assert quality_divergence.js_distance(p, q) == pytest.approx([math.sqrt((kl(p[0]) + kl(q)) / 2), 0])


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, sf_dir, tables, size):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = setsketch_dedup.near_duplicates(docs, shingle=size).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == brute.near_duplicates(tables("documents", "doc_id, text"), size)


def test_near_duplicate_chains(spark):
    """Groups of edited copies whose pairs lie around the threshold: chains, a hub, and many distinct outliers."""
    rng = np.random.default_rng(5)
    word = lambda: "w" + "".join(rng.choice(list("abcdefgh"), 4))
    rows, base = [], [word() for _ in range(120)]
    for i in range(150):
        edited = list(base)
        for k in rng.choice(120, rng.integers(0, 16), replace=False):
            edited[k] = word()
        rows.append((i * 3 % 151, " ".join(edited)))
        if i % 3 == 0:
            base[rng.integers(120)] = word()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in setsketch_dedup.near_duplicates(docs, shingle=2).collect()}
    assert got == brute.near_duplicates(rows, 2)


def test_sketch_estimates():
    rng = np.random.default_rng(1)
    errors = []
    for share in (0.3, 0.6, 0.8, 0.95):
        for n in (40, 700, 9000):
            both = rng.integers(0, 1 << 63, int(n * 2 * share / (1 + share)), dtype=np.uint64)
            a, b = (np.sort(np.concatenate([both, rng.integers(0, 1 << 63, n - len(both), dtype=np.uint64)])) for _ in range(2))
            regs = setsketch_dedup.sketches(np.concatenate([a, b]), np.array([0, n, 2 * n]))
            true = len(both) / (2 * n - len(both))
            greater, less = (regs[0] > regs[1]).sum(), (regs[0] < regs[1]).sum()
            errors.append(float(setsketch_dedup.estimate(np.array([greater]), np.array([less]), np.array([n * 1.0]), np.array([n * 1.0]))[0]) - true)
            merged = setsketch_dedup.sketches(np.unique(np.concatenate([a, b])), np.array([0, len(np.unique(np.concatenate([a, b])))]))[0]
            assert (np.maximum(regs[0], regs[1]) != merged).mean() < 0.02  # mergeable
    assert max(map(abs, errors)) < setsketch_dedup.MARGIN


def test_personal_data(run, tables):
    texts = dict(tables("documents", "doc_id, text"))
    for r in run("op3_pii_crf"):
        spans = brute.patterns(texts[r["doc_id"]])
        told = ",".join(f"{pii_crf.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert tuple(r)[1:5] == tuple(sum(k == x for _, x, _ in spans) for k in range(4))
        assert set(filter(None, told.split(","))) <= set(r["spans"].split(","))


def test_patterns_on_nasty_texts():
    rng = np.random.default_rng(3)
    for _ in range(3000):
        text = "".join(rng.choice(list("0123456789..--  ++()@@ab%é\n"), rng.integers(1, 60)))
        assert pii_crf.pattern_spans(text) == brute.patterns(text), text


def test_field_on_held_out_rows():
    """Rows that are not in the labelled table."""
    cases = {'my token = "c0ffee12d4e5f60718293a4b5c6d7e8f90a1b2c3" ok': ["secret"], "password: Qx77!zz9kk": ["secret"], "ssn 123-45-6789": ["id_number"],
             "Dear Dr. Maria Lopez": ["person"], "phone: 555-2368 now": ["local_phone"], "the river ran low. And the town slept on": [],
             "WE!! ARE!! THE!! CHAMPIONSHIPS!!": [], "In 2019 there were 1,024 rows on page 77": []}
    model, right = pii_crf.train(), 0
    for text, want in cases.items():
        import pyarrow as pa

        column = pa.array([text])
        lo, _, buf, offsets = next(pii_crf.tv.chunks(column))
        (_, spans), = pii_crf.chunk_spans(column, lo, buf, offsets, model)
        right += [pii_crf.KINDS[k] for _, k, _ in spans] == want
    assert right >= len(cases) - 1


def test_kneser_ney(spark):
    texts = [(1, "the cat sat on the mat 12"), (2, "the dog sat on the log 345"), (3, "a cat and a dog"), (4, "zzz qqq!"), (5, "the log sat")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in texts], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    score = brute.kneser_ney([t for i, t in texts if i <= 3])
    got = {r["doc_id"]: r["perplexity"] for r in kneser_ney.classify(docs, labels).collect()}
    for i, t in texts:
        loglik, n = score(t)
        assert got[i] == pytest.approx(math.exp(-loglik / n), rel=1e-9)


def test_pages(run, tables):
    pages = {i: h for i, h in tables("pages", "page_id, html")}
    for r in run("op5_html_crf"):
        article = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_pages_of_other_layouts():
    cases = [
        ('<nav><a href=/>x</a></nav><div id="wrapper"><section class="post-body"><h1>M1</h1><p>M2 some text here, fine.</p><div class="comment-list">'
         '<p>C one says nothing at all about it.</p></div></section></div><div class="cookie-banner">We use cookies</div>', "M1\nM2 some text here, fine."),
        ('<article><h1>A</h1><p>B&nbsp;&amp; c<script>var x="<p>no</p>"</script> d</p><form><input><p>Enter your mail here to get it.</p></form>'
         '<div class="sponsored">Ad text that is a long sentence here.</div><p>E</p></article>', "A\nB & c d\nE"),
        ('<div class="header">Site name</div><div class="notice">Site is down on Monday for works.</div><div class="article"><p>Hello there.</p><p>ok</p>'
         '</div><div class="sidebar"><ul><li>one</li></ul></div>', "Hello there.\nok"),
    ]
    model = html_crf.train()
    assert html_crf.main_texts([p for p, _ in cases], model) == [t for _, t in cases]


def test_token_files(run, tables, encode):
    start = 0
    rows = {r["doc_id"]: tuple(r)[1:] for r in run("op7_token_files")}
    for i, t in sorted(tables("documents", "doc_id, text")):
        ids = encode(t, 0)
        assert rows[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_encoder_equals_the_library(encode):
    rng = np.random.default_rng(9)
    parts = ["a", " b", "Z9", "'s", "'S", "’", " ", "  ", "\n", "\t", "\r\n", "é", " É", "ß", "²", "½", "ª", "·", "\xa0", "\x85", "\x1c", "日本", "😀", "ɏ", "ɐ", "<|endoftext|>", "_", "--", "1.5", "...", " 'll", "ǅ", "×"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(3000)]
    coder = tokens.encoder(tokens.default_path())
    import pyarrow as pa

    for _ in range(2):
        for lo, hi, buf, offsets in tokens.tv.chunks(pa.array(texts)):
            ids, bounds = coder.ids(buf, offsets)
            for i, text in enumerate(texts[lo:hi]):
                assert ids[bounds[i]: bounds[i + 1]].tolist() == encode(text, 0).tolist()[:-1], text
        texts = [" ".join(t.split()).replace(". ", ".\n") for t in texts]  # without white space side by side


def _packed(rows, texts, encode):
    sequences = {}
    by: dict = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by) == set(texts)
    for i, pieces in by.items():
        ids, at = encode(texts[i], 1), 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at: at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 2048 - at
    assert padding <= 2048 + packing.MIN_PIECE * len(sequences)


def test_packing(spark, sf_dir, tables, encode):
    texts = dict(tables("documents", "doc_id, text"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for parts in (1, 90):
        _packed(packing.pieces(docs.repartition(parts)).collect(), texts, encode)


def test_cascade_is_exact(spark):
    universe = spark.range(20_000).selectExpr("concat('host', id, '.example') AS key")
    listed = universe.where("conv(substring(md5(key), 1, 4), 16, 10) % 7 = 0").union(spark.range(50).selectExpr("concat('absent', id) AS key"))
    levels = url_cascade.cascade(listed, universe)
    inside = {r["key"] for r in listed.collect()}
    rows = universe.select("key", url_cascade.is_listed(levels, universe["key"]).alias("x")).collect()
    assert len(levels) > 2 and all(r["x"] == (r["key"] in inside) for r in rows)


def test_pipeline(spark, sf_dir, tables, encode):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r["doc_id"] for r in quality_divergence.scores(docs).where("kept").collect()}
    texts = {i: t for i, t in tables("documents", "doc_id, text") if i in kept}
    groups = brute.near_duplicates(list(texts.items()), 5)
    texts = {i: t for i, t in texts.items() if groups[i][2]}
    bad = brute.contamination(texts.items(), tables("benchmark", "item_id, text"))
    texts = {i: t for i, t in texts.items() if not bad[i][4]}
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = corpus_pipeline.stored(stage(spark, now, sf_dir), "test-stage")
        if k < 4:
            assert now.columns == docs.columns
        if k == 2:
            assert {r["doc_id"]: r["text"] for r in now.collect()} == texts
        if k == 3:
            clean = {r["doc_id"]: r["text"] for r in now.collect()}
            assert set(clean) == set(texts) and not any(brute.patterns(t) for t in clean.values())
            assert all(clean[i] == t for i, t in texts.items() if not re.search(r"[0-9@]", t))
    _packed(now.collect(), clean, encode)
    assert entry.queries()["pipeline"](spark, sf_dir).count() == now.count()


def test_ip_parts_of_any_length():
    for zeros in (0, 3, 300, 5_000):
        text = "from " + "0" * zeros + "10.0.0.1 on"
        assert pii_crf.pattern_spans(text) == brute.patterns(text) if zeros < 4000 else pii_crf.pattern_spans(text)[0][1] == 1
    assert [s[1] for s in pii_crf.pattern_spans("0256.1.1.1 and " + "9" * 5_000 + ".1.1.1")] == []


def test_runs_are_decoded_as_whole_lines():
    from docindex.llm import crf

    rnd = np.random.default_rng(0)
    for _ in range(200):
        n, states = int(rnd.integers(1, 80)), len(pii_crf.LABELS) + 1
        emit = rnd.normal(size=(n, states)).astype(np.float32) * 3
        emit[:, 0] += rnd.choice([0, 15], size=n)
        moves, bounds = rnd.normal(size=(states, states)).astype(np.float32), np.unique(np.r_[0, rnd.integers(0, n, 3), n])
        assert (crf.viterbi(emit, moves, bounds) == pii_crf.decode(emit, moves, bounds)).all()
