"""Hard negatives, cross-tokenizer alignment and the rank queue against plain versions, and on odd input."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from docindex.llm import hard_negatives, rank_queue_bpe, textvec as tv, token_align


# ---------------------------------------------------------------- hard negatives
def plain_negatives(rows, positives=5, negatives=5, low=80, high=100, every=100):
    kept = []
    for at, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, at, label, [math.floor(256 * x) for x in v]))
    out = []
    for a in kept:
        if a[0] % every:
            continue
        dot = [(-sum(x * y for x, y in zip(a[3], b[3])), b[0], b[1], b[2]) for b in kept if b is not a]
        best = sorted(x for x in dot if x[3] == a[2])[:positives]
        rest = sorted(x for x in dot if x[3] != a[2])
        for p in best:
            fit = [x for x in rest if -low * p[0] <= -100 * x[0] <= -high * p[0]][:negatives]
            out += [(a[0], p[1], k + 1, x[1], -p[0], -x[0]) for k, x in enumerate(fit)]
    return sorted(out)


def _mine(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for c in "row id q a_row slot score cell chunk block".split():
        df = df.withColumn(c, F.lit("x")) if c != "id" else df
    out = hard_negatives.mine(df, F.col("vec_id") % more.pop("every", 100) == 0, **more)
    return sorted(tuple(r) for r in out.collect())


def _clusters(n, dims, seed, groups=6):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(groups, dims))
    return [(i, (centres[i % groups] * rnd.uniform(0.2, 3) + rnd.normal(scale=0.15, size=dims)).tolist(), int(rnd.integers(0, 4))) for i in range(n)]


def test_hard_negatives_in_clusters(spark):
    rows = _clusters(600, 8, 1)
    rows += [(10_000 + i, rows[0][1], i % 3) for i in range(60)]  # one vector many times: ties
    assert _mine(spark, rows, every=20) == plain_negatives(rows, every=20)


def test_hard_negatives_in_many_chunks_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "CHUNK", 7)
    rows = _clusters(150, 4, 2)
    assert _mine(spark, rows, every=7) == plain_negatives(rows, every=7)


def test_intervals_hold_and_cut():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(300, 5)) * rnd.uniform(1, 400, size=(300, 1))
    x[:150] = x[0] * rnd.uniform(0.5, 2, size=(150, 1)) + rnd.normal(scale=2, size=(150, 5))
    x = np.floor(x)
    refs = hard_negatives.directions(x, 6)
    theta = hard_negatives.angles(x, refs).astype("<f4").astype(float)
    norm = np.linalg.norm(x, axis=1)
    least, most = hard_negatives.score_bounds(theta, norm, theta, theta, norm, norm)
    scores = x @ x.T
    assert (least <= scores).all() and (scores <= most).all()
    limit = 0.8 * norm[0] ** 2
    assert (most[0] < limit).sum() > 100


def test_hard_negatives_skip_granules(spark):
    """Far clusters are not sent out to score; the result is whole."""
    rows = _clusters(400, 16, 5, groups=8)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    index = hard_negatives.Index(df, "vec_id", "embedding", "label")
    picked = index.rows.where("id % 20 = 0").select(*(F.col(c).alias(f"a_{c}") for c in ("row", "id", "label", "cell", "norm", "q", "angles")))
    windows = picked.select("*", F.array(F.lit(0)).alias("slots"), F.array(F.expr("bigint(0.9 * a_norm * a_norm)")).alias("lows"), F.array(F.lit(1 << 60)).alias("highs"))
    sent = windows.mapInArrow(hard_negatives._route(index, False), f"{hard_negatives._ANCHOR}, slots array<int>, lows array<long>, highs array<long>, cell int, chunk int").count()
    assert sent < windows.count() * (len(index.cells) - 1) / 2


def test_hard_negatives_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (100, [1.0, 2.5], 2), (1, [0.5, 1.0], 1), (2, [0.9, 2.1], 3), (3, [0.9, 2.1], 3), (4, None, 1), (5, [1.0, None], 1),
            (6, [1.0, nan], 1), (8, [inf, 1.0], 1), (None, [1.0, 2.0], 2), (9, [1.0, 2.0], None), (10, [], 3), (11, [0.0, 0.0], 2), (200, [0.0, 0.0], 2), (12, [-1.0, -2.0], 1),
            (300, [1.0], 1), (13, [2.0, 1.0, 7.0], 2)]
    assert _mine(spark, rows) == plain_negatives(rows)
    assert _mine(spark, rows[:1]) == [] and _mine(spark, []) == []
    assert _mine(spark, [(0, [1e30, 0.0], 1), (1, [1e30, 0.0], 2)]) == []  # scores that no long holds
    big = [(100 * i, [9e3 + i, 9e3 - i, i / 7], i % 2) for i in range(8)]
    assert _mine(spark, big) == plain_negatives(big)


def test_registered_hard_negatives(spark, sf_dir):
    raw = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    rows = [(r[0], r[1], (r[2] + 1) % 10 if r[0] % 7 == 0 else r[2]) for r in raw]
    got = sorted(tuple(r) for r in entry.queries()["op11_hard_negatives"](spark, sf_dir).collect())
    assert got == plain_negatives(rows) and got


# ---------------------------------------------------------------- alignment
@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte, extra = {}, 0
    for x in range(256):
        if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174:
            byte[chr(x)] = x
        else:
            byte[chr(256 + extra)] = x
            extra += 1
    names = {i: t for t, i in a.get_vocab().items()}
    spell_a = lambda i: bytes(byte[c] for c in names[i])
    spell_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def plain(text):
        """(ids of A, ids of B, groups, linked pairs) or None."""
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        told = [[spell_a(i) for i in ids_a], [spell_b(i) for i in ids_b]]
        if any(b"".join(t) != (" " + text).encode() for t in told):
            return None
        ends = [np.cumsum([len(s) for s in t]).tolist() for t in told]
        groups, links, at = [], [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            to = [e.index(end) + 1 for e in ends]
            groups.append(",".join(map(str, ids_a[at[0]:to[0]])) + "|" + ",".join(map(str, ids_b[at[1]:to[1]])))
            for i in range(at[0], to[0]):
                for j in range(at[1], to[1]):
                    if max(ends[0][i] - len(told[0][i]), ends[1][j] - len(told[1][j])) < min(ends[0][i], ends[1][j]):
                        links.append((ids_a[i], ids_b[j]))
            at = to
        return ids_a, ids_b, groups, links

    return plain


def plain_report(docs, plain):
    found = [(i, plain(t)) for i, t in docs]
    count = Counter(p for _, x in found if x for p in set(x[3]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for i, x in found:
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((i, len(x[0]), len(x[1]), len(x[2]), len(x[3]), sum(count[p] == most[p[0]] for p in x[3]), sum(count[p] for p in x[3]),
                        hashlib.sha256(";".join(x[2]).encode()).hexdigest()))
    return sorted(out, key=repr)


ODD = ["", None, "a", " ", " a", "a ", "a  b", "\n", "\nx", "x\n", "a\nb\n\nc", "a\r\nb", "\ta", "<s> x</s>", "<|endoftext|> b", "a▁b", "a\x00b", "ﬁ ① Ⅳ é", "é​", "　x", "\xa0",
       "日本語 テスト", "😀 a", "é x", "word.\nNext, word; and: more! ok? 1.5", "x;\rfoo ;\r", "a'b don't 's", "»., ’. ².", "<0x41> a", "ÀÉ.ß, ñ;", "same", "same", "the the the"]


def test_alignment_of_odd_texts(spark, libraries):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "an id twice")]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, pairs int, groups_sha256 string")
    want = plain_report(docs, libraries)
    assert sorted(map(tuple, token_align.report(df).collect()), key=repr) == want
    assert sorted(map(tuple, token_align.report(df, broadcast_bytes=0).collect()), key=repr) == want  # the join by shuffle
    assert token_align.report(df.limit(0)).count() == 0


def test_alignment_of_random_and_long_texts(libraries):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab .,\né¿'1A_»²") for _ in range(rnd.randrange(60))) for _ in range(1500)]
    texts += ["x" * 30_000, " ".join(rnd.choice(["the", "aligned,", "words", "überall."]) for _ in range(20_000))]
    aligner = token_align.Aligner(*token_align.default_paths())
    column = pa.array([" " + t if t else "" for t in texts], pa.large_string())
    at = 0
    for lo, hi, buf, offsets in tv.chunks(column, 4_000):
        (n_a, n_b), n_groups, n_links, digests, (bounds, pairs, times) = aligner.chunk(buf, offsets)
        for k in range(hi - lo):
            x = libraries(texts[at + k])
            if x is None:
                assert (n_a[k], n_b[k], digests[k]) == (0, 0, "")
                continue
            assert (n_a[k], n_b[k], n_groups[k], n_links[k]) == (len(x[0]), len(x[1]), len(x[2]), len(x[3]))
            assert digests[k] == hashlib.sha256(";".join(x[2]).encode()).hexdigest()
            got = dict(zip(pairs[bounds[k]: bounds[k + 1]].tolist(), times[bounds[k]: bounds[k + 1]].tolist()))
            assert got == {p * aligner.base + q: n for (p, q), n in Counter(x[3]).items()}
        at += hi - lo
    assert at == len(texts)


def test_registered_alignment(spark, sf_dir, libraries):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, entry.queries()["op12_token_align"](spark, sf_dir).collect()), key=repr)
    assert got == plain_report(docs, libraries)


# ---------------------------------------------------------------- rank queue
@pytest.fixture(scope="module")
def tiktoken_ids():
    import base64

    import public_tokenizers
    import tiktoken

    with open(rank_queue_bpe.default_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_rank_queue_as_tiktoken(tiktoken_ids):
    c = rank_queue_bpe.codec(rank_queue_bpe.default_path(), rank_queue_bpe.default_pattern())
    rnd = random.Random(5)
    texts = [chr(p) + "a" + chr(p) + " " + chr(p) for p in [*range(0x3000), *range(0x1F300, 0x1F700)]]
    for letters in ("ab", "abc ", "etaoin shrdlu", "aA1 .,\n", "é日本a", "()[]{};=", "0123456789", "=-_"):
        texts += ["".join(rnd.choice(letters) for _ in range(n)) for n in (1, 2, 3, 7, 40, 300, 3000) for _ in range(8)]
    assert [np.frombuffer(x, "<u4").tolist() for x in c.encode(texts)] == [tiktoken_ids(t) for t in texts]


def test_cut_of_low_characters(tiktoken_ids):
    c = rank_queue_bpe.codec(rank_queue_bpe.default_path(), rank_queue_bpe.default_pattern())
    assert c.cut_low and rank_queue_bpe.low_cut(r"\w+") is None
    for p in range(0x250):
        for text in (f"a{chr(p)}1 {chr(p)}  {chr(p)}{chr(p)} b", f"'{chr(p)} {chr(p)}", f"{chr(p)}{chr(p)}\n {chr(p)}x"):
            assert c.cut_low(text) == c.cut_any(text)


def test_very_long_pre_tokens(tiktoken_ids):
    c = rank_queue_bpe.codec(rank_queue_bpe.default_path(), rank_queue_bpe.default_pattern())
    rnd = random.Random(6)
    for text in ("".join(rnd.choice("abcdefgh") for _ in range(200_000)), "a" * 200_000, "ab " * 100_000, "=" * 99_999):
        ids = np.frombuffer(c.encode_long(text), "<u4")
        assert ids.tolist() == tiktoken_ids(text) and c.decode(ids) == text.encode()


def test_long_texts_are_cut_where_pre_tokens_start(tiktoken_ids):
    text = "Some words,  and\n more of them; don't cut 'em   badly! " * 200
    c = rank_queue_bpe.codec(rank_queue_bpe.default_path(), rank_queue_bpe.default_pattern())
    for size in (1, 7, 64, 1000):
        pieces = list(rank_queue_bpe.parts(text, size))
        assert "".join(pieces) == text and np.frombuffer(b"".join(c.encode(pieces)), "<u4").tolist() == tiktoken_ids(text)


def test_a_full_table_starts_anew(tiktoken_ids, monkeypatch):
    monkeypatch.setattr(rank_queue_bpe, "TABLE", 3)
    monkeypatch.setattr(rank_queue_bpe, "KEPT_CHARS", 6)
    c = rank_queue_bpe.Codec(rank_queue_bpe.default_path(), rank_queue_bpe.default_pattern())
    for text in ("qwertz uiopü qwertz asdfghjklyx", "uiopü asdfghjklyx qwertz", "yxcvb nm qwertz uiopü", "qwertz"):
        assert np.frombuffer(c.encode([text, text])[1], "<u4").tolist() == tiktoken_ids(text)


def test_registered_rank_queue(spark, sf_dir, tiktoken_ids):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((i, len(ids := tiktoken_ids(t or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
                  for i, t in docs)
    assert sorted(map(tuple, entry.queries()["op13_rank_queue_bpe"](spark, sf_dir).collect())) == want


def test_rank_queue_on_odd_rows(spark, tiktoken_ids):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "an id twice"), (99, "word " * 300_000)]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, ids int, n_tokens string")
    got = sorted(map(tuple, rank_queue_bpe.report(df).collect()), key=repr)
    want = [(i, len(ids := tiktoken_ids(t or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in docs]
    assert got == sorted(want, key=repr)
    assert rank_queue_bpe.report(df.limit(0)).count() == 0
