"""The divergence rules on rare, unnamed and crowded-out languages."""

import numpy as np
import pytest

from docindex.llm import quality_divergence as qd

RUSSIAN = "вчера вечером мы долго шли вдоль реки и никто не сказал ни слова потом начался дождь поэтому все вернулись домой где было тепло".split()
SIGNS = ["★", "☆", "§", "¶", "◆", "✦", "→", "❖", "▲", "♣"]


@pytest.fixture(scope="module")
def judged(spark, sf_dir):
    base = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    seen = {r["doc_id"]: r for r in qd.scores(base).join(base, "doc_id").where("lang = 'en' and n_words between 80 and 2000").collect()}
    clean = next(r["text"] for _, r in sorted(seen.items()) if r["kept"] and r["char_distance"] < 0.06 and r["word_distance"] < 0.3)
    words = clean.split()
    signs = " ".join(w + ["%%%", "$$", "#&", "||"][k % 4] for k, w in enumerate(words))
    rng = np.random.default_rng(1)
    signs_only = " ".join("".join(rng.choice(SIGNS, 4)) for _ in range(150))
    russian = ". ".join(" ".join(rng.choice(RUSSIAN, 9)).capitalize() for _ in range(20)) + "."
    rows = [("clean", clean), ("signs", signs), ("capitals", " ".join(w.upper() + "!!!" for w in words)), ("marks", signs_only),
            ("russian", russian)]
    odd = [(f"{lang}/{name}", text, lang) for lang in ("nl", None, "und") for name, text in rows]
    crowd = base.selectExpr("concat('a', doc_id) AS doc_id", "text", "lang")
    for k in range(7):  # one hot language of many documents
        crowd = crowd.union(base.where("lang = 'en'").selectExpr(f"concat('b{k}-', doc_id)", "text", "lang"))
    docs = crowd.union(spark.createDataFrame(odd, "doc_id string, text string, lang string"))
    return {r["doc_id"]: r for r in qd.scores(docs).collect()}


@pytest.mark.parametrize("lang", ["nl", None, "und"])
def test_every_language_is_judged(judged, lang):
    got = {name: judged[f"{lang}/{name}"] for name in ("clean", "signs", "capitals", "marks", "russian")}
    assert not any(r["base_failed"] for r in got.values()) and all(r["char_distance"] is not None for r in got.values())
    assert {name for name, r in got.items() if r["kept"]} == {"clean", "russian"}, got


def test_a_crowd_of_another_language_changes_no_reference(spark):
    rng = np.random.default_rng(3)
    vocabulary = ["de", "het", "een", "van", "en", "dat", "niet", "op"] * 30 + [f"woord{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    prose = lambda: " ".join(rng.choice(vocabulary, 150)) + "."
    salad = " ".join(f"zq{chr(97 + i % 26)}{chr(97 + i // 7)}x" for i in range(150))
    small = [(i, prose(), "nl") for i in range(30)] + [(100, salad, "nl")]
    english = [*qd.COMMON_WORDS["en"] * 8, *(w.replace("w", "v") for w in vocabulary[-200:])]
    crowd = [(1000 + i, " ".join(rng.choice(english, 150)) + ".", "en") for i in range(8000)]
    kind = "doc_id long, text string, lang string"
    alone = {r["doc_id"]: r for r in qd.scores(spark.createDataFrame(small, kind)).collect()}
    beside = {r["doc_id"]: r for r in qd.scores(spark.createDataFrame(small + crowd, kind)).where("doc_id < 1000").collect()}
    assert all(alone[i]["kept"] and beside[i]["kept"] for i in range(30))
    assert not alone[100]["kept"] and not beside[100]["kept"]
    assert min(x[100]["word_distance"] for x in (alone, beside)) > qd.MAX_WORD_DISTANCE  # common words of Dutch come from the corpus


@pytest.mark.parametrize("n", [40, 900, 1100, 5000])
def test_a_label_of_junk_alone_is_no_reference(spark, sf_dir, n):
    base = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    copies = base.crossJoin(spark.range(20 * n // 1000 + 1)).drop("id")  # the junk stays a small part of the corpus
    junk = [(-1 - i, " ".join(f"w{(k + i) * 31 % 193}x{k}%% &&$#" for k in range(200 + i % 40)), "xx") for i in range(n)]
    rows = qd.scores(copies.union(spark.createDataFrame(junk, base.schema))).where("doc_id < 0 and not base_failed").collect()
    assert len(rows) > n / 2 and not any(r["kept"] for r in rows)
