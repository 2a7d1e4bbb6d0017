"""The verdicts of the character model against labels, with many, few, one or only short trusted documents in a language."""

import pytest
from pyspark.sql import functions as F

from docindex.llm import kneser_ney

RARE = {"r1": 1, "r5": 5, "short": 5}


@pytest.fixture(scope="module")
def judged(spark, sf_dir):
    """The given documents; French ones once more under rare labels, of which only a few are trusted."""
    big = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{big}/labels.parquet").select("doc_id", "quality", F.coalesce("toxic", F.lit(0)).alias("toxic"))
    french = docs.where("lang = 'fr' and length(text) between 400 and 8000").join(labels, "doc_id").collect()
    good = sorted({r["doc_id"]: r for r in french if r["quality"] == 1 and not r["toxic"]}.items())
    rows, told, truth = [], [], {}
    for j, (lang, n) in enumerate(RARE.items()):
        base = 10_000_000 * (j + 1)
        for k, (_, r) in enumerate(good):
            text = r["text"][:300] if lang == "short" and k < n else r["text"]
            rows.append((base + k, text, lang))
            if k < n:
                told.append((base + k, 1, 0))
            else:
                truth[base + k] = (lang, True)
        for k, (_, r) in enumerate(good[-6:]):  # letters in disorder
            rows.append((base + 5000 + k, "".join(sorted(r["text"], key=lambda c: (ord(c) * 7919) % 97))[::-1] + "%$#|" * 100, lang))
            truth[base + 5000 + k] = (lang, False)
    docs = docs.union(spark.createDataFrame(rows, docs.schema))
    labels = labels.union(spark.createDataFrame(told, labels.schema))
    out = {r["doc_id"]: r for r in kneser_ney.classify(docs, labels).collect()}
    return out, truth, {r["doc_id"]: r for r in labels.collect()}


@pytest.mark.parametrize("lang", list(RARE))
def test_few_trusted_documents(judged, lang):
    out, truth, _ = judged
    clean = [out[i]["kept"] for i, (x, q) in truth.items() if x == lang and q]
    junk = [out[i]["kept"] for i, (x, q) in truth.items() if x == lang and not q]
    assert len(clean) > 10 and sum(clean) >= 0.9 * len(clean), (sum(clean), len(clean))
    assert len(junk) == 6 and not any(junk)


@pytest.mark.parametrize("lang", ["en", "fr", "de", "es"])
def test_kept_agrees_with_the_labels(judged, lang):
    out, _, labels = judged
    rows = [(labels[i], r) for i, r in out.items() if i in labels and r["lang"] == lang and r["n_chars"] >= 400]
    good = [r["kept"] for x, r in rows if x["quality"] == 1 and not x["toxic"]]
    assert len(good) > 10 and sum(good) >= 0.95 * len(good), (sum(good), len(good))
