"""Quality classifier: an interpolated modified Kneser-Ney model of characters, one for each language.

The model of order ``ORDER`` is trained on all trusted documents (labelled good and not toxic), and every document of the
corpus is scored with its language's model. Characters are code points of the basic plane (others are one symbol); digits
are one symbol, white space is one symbol, and each text starts after ``ORDER - 1`` boundary symbols.

1. One pass counts the n-grams of the whole corpus and, beside, those of trusted documents. A task pre-aggregates with
   numpy and leaves its distinct n-grams; a shuffle by n-gram sums them. (A pass with no more than ``MAX_TRUSTED``
   trusted ids gets the flags by a broadcast of those ids; beyond that by a shuffle join.)
2. Continuation counts, discounts, context totals and interpolated probabilities come from joins of the count tables,
   which are sharded by n-gram: one row for each distinct n-gram of the corpus.
3. A second pass leaves, for each document, its distinct n-grams with counts; they are joined with the probabilities
   (broadcast up to ``MAX_TABLE`` counted rows, else sharded by n-gram) and summed to log-likelihoods.
4. Trusted documents fall into ``FOLDS`` folds by their text, and beside the full model there is one without each fold.
   A trusted document is measured by the model without its own fold: ``unseen`` is that perplexity, and the perplexity
   itself for all other documents. (Models are languages of their own inside the count tables, so there is no further pass.)
5. A document is kept if its ``unseen`` perplexity is at most its language's limit times 1 + ``SHORT`` / characters, as the
   perplexity of a short text is noisier. The limit is median + ``SPREADS`` * (``HIGH`` quantile - median) of ``unseen``
   over the trusted documents of that language with ``MIN_CHARS`` characters or more. A language with fewer than
   ``MIN_TRUSTED`` of them takes the median over all its documents, trusted or not, and the spread of the other languages
   (pooled, relative to their medians; ``SPREAD`` if there are none).

Cases: null and empty texts have no perplexity and are not kept; a null language is a language of its own; a language
without trusted documents has no model: perplexity and limit are null and its documents are kept; so are trusted
documents that no other text of their language can judge; documents without a
label are scored but not trusted; an id with several labels is trusted if every label is good; repeated rows are scored
alike; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docindex.llm import textvec as tv
from docindex.llm.scratch import stored

ORDER = 4
MAX_TRUSTED, MAX_TABLE, MERGE = 4_000_000, 1_000_000, 1 << 20
HIGH, SPREADS, MIN_CHARS, SHORT = 0.95, 4.0, 400, 20.0
FOLDS, MIN_TRUSTED, SPREAD = 3, 20, 0.15
_NO_LANGUAGE = "\x00"  # stands for a null language inside the model's tables
_BOUNDARY, _DIGIT, _OTHER = 2, 48, 0xFFFF


def grams(buf: np.ndarray, offsets: np.ndarray):
    """(n-gram of every character as ORDER 16-bit symbols in a 64-bit integer, characters of each text)."""
    lead = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=lead[1:])
    sizes = lead[offsets[1:]] - lead[offsets[:-1]]
    points = np.frombuffer(buf.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = np.minimum(points, _OTHER).astype(np.uint64)
    points[(points >= 48) & (points <= 57)] = _DIGIT
    points[(points == 32) | ((points >= 9) & (points <= 13))] = 32
    at = np.arange(len(points)) + (ORDER - 1) * (np.repeat(np.arange(len(sizes)), sizes) + 1)
    padded = np.full(len(points) + (ORDER - 1) * len(sizes), _BOUNDARY, dtype=np.uint64)
    padded[at] = points
    out = np.zeros(len(points), dtype=np.uint64)
    for k in range(ORDER):
        out |= padded[at - k] << np.uint64(16 * k)
    return out, sizes


def _language_salts(langs: list) -> np.ndarray:
    """One 64-bit number a text, the same for texts of one language; null is a language of its own."""
    names = sorted({x for x in langs if x is not None})
    raw = [x.encode() for x in names]
    ends = np.cumsum([len(x) for x in raw], dtype=np.int64)
    hashes = tv.span_hashes(np.frombuffer(b"".join(raw), dtype=np.uint8), ends - [len(x) for x in raw], ends) if raw else []
    table = dict(zip(names, hashes))
    return np.array([table.get(x, np.uint64(1)) for x in langs], dtype=np.uint64)


def _keys(found: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """One 64-bit key for each (language, n-gram)."""
    return tv.mix(found ^ salts)


def _distinct(found: np.ndarray):
    """Ascending distinct values and their counts."""
    found = np.sort(found)
    first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.zeros(0, dtype=np.int64)
    return found[first], np.diff(np.r_[first, len(found)])


def count_table(flagged: DataFrame) -> DataFrame:
    """(lang, key, gram, n, n0, n1, ..., seen) from (text, lang, fold): n counts trusted occurrences, nK those of a fold, seen all.

    The fold of a text that is not trusted is -1.
    """
    def run(batches):
        held: dict = {}  # (language, fold) -> pieces of distinct n-grams and counts

        def merged(pieces):
            gram, n = (np.concatenate(x) for x in zip(*pieces))
            order = np.argsort(gram)
            first = np.flatnonzero(np.r_[True, gram[order][1:] != gram[order][:-1]])
            return gram[order][first], np.add.reduceat(n[order], first)

        def out(which):
            for lang, fold in which:
                gram, n = merged(held.pop((lang, fold)))
                key = _keys(gram, _language_salts([lang])[0]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(key), pa.array(gram.view(np.int64)),
                                                  pa.array(np.full(len(gram), fold, dtype=np.int64)), pa.array(n)], ["lang", "key", "gram", "fold", "n"])

        for batch in batches:
            langs, folds = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for lo, hi, buf, offsets in tv.chunks(batch.column(0)):
                found, sizes = grams(buf, offsets)
                groups = list(zip(langs[lo:hi], folds[lo:hi]))
                names = {g: k for k, g in enumerate(dict.fromkeys(groups))}
                code = np.repeat(np.array([names[g] for g in groups]), sizes)
                for g, k in names.items():
                    own = found[code == k]
                    if len(own):
                        held.setdefault(g, []).append(_distinct(own))
                for g in [g for g, pieces in held.items() if sum(len(x[0]) for x in pieces) > MERGE]:
                    held[g] = [merged(held[g])]
                    if len(held[g][0][0]) > MERGE // 2:
                        yield from out([g])
        yield from out(list(held))

    parts = flagged.mapInArrow(tv.returning(run), "lang string, key long, gram long, fold long, n long")
    sums = parts.groupBy("lang", "key", "gram").agg(
        F.sum(F.when(F.col("fold") >= 0, F.col("n")).otherwise(0)).alias("n"),
        *(F.sum(F.when(F.col("fold") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(FOLDS)), F.sum("n").alias("seen"))
    return stored(sums.withColumn("lang", F.coalesce("lang", F.lit(_NO_LANGUAGE))), "grams")


def _models(counts: DataFrame, rows: list) -> DataFrame:
    """``counts`` once for each model whose number in ``rows`` (full model first, then without each fold) is over 0."""
    each = F.array(*(F.struct(F.lit(k).alias("model"), c.cast("long").alias("c")) for k, c in enumerate(rows)))
    found = counts.select("lang", "key", "gram", F.explode(F.filter(each, lambda x: x["c"] > 0)).alias("x"))
    return found.select(F.concat("lang", F.lit("\x01"), F.col("x.model").cast("string")).alias("lang"), "key", "gram", "x.model", "x.c")


def _order_tables(counts: DataFrame) -> list:
    """For every model and n = ORDER .. 1: (grams (lang, g, c), contexts (lang, h, total, gamma)), with modified Kneser-Ney discounts."""
    out = []
    now = _models(counts.where("n > 0"), [F.col("n"), *(F.col("n") - F.col(f"n{k}") for k in range(FOLDS))]).select("lang", F.col("gram").alias("g"), "c")
    for n in range(ORDER, 0, -1):
        if n < ORDER:  # continuation counts: distinct symbols before the n-gram
            mask = (1 << (16 * n)) - 1
            now = now.groupBy("lang", F.col("g").bitwiseAND(F.lit(mask)).alias("g")).agg(F.count(F.lit(1)).alias("c"))
        now = stored(now, f"order{n}")
        kinds = [F.sum((F.col("c") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]
        found = now.groupBy("lang").agg(*kinds)
        y = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(F.lit(0.5))
        # A count class that does not occur falls back to half a count less; a discount stays within its count.
        parts = [F.when((F.col(f"n{k}") > 0) & (F.col(f"n{k + 1}") > 0), k - (k + 1) * y * F.col(f"n{k + 1}") / F.nullif(F.col(f"n{k}"), F.lit(0))).otherwise(F.lit(0.5)) for k in (1, 2, 3)]
        cuts = found.select("lang", *(F.least(F.greatest(p, F.lit(0.1)), F.lit(float(k) - 0.05)).alias(f"d{k}") for k, p in zip((1, 2, 3), parts)))
        cut = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = now.join(cuts, "lang").select("lang", "g", "c", cut.alias("d"))
        contexts = rows.groupBy("lang", F.shiftrightunsigned("g", 16).alias("h")).agg(F.sum("c").alias("total"), F.sum("d").alias("taken"))
        contexts = contexts.select("lang", "h", "total", (F.col("taken") / F.col("total")).alias("gamma"))
        out.append((n, rows.select("lang", "g", (F.col("c") - F.col("d")).alias("rest")), contexts))
    return out


def gram_scores(counts: DataFrame) -> DataFrame:
    """(key, logp, without0, ...) for every distinct n-gram of the corpus whose language has a model."""
    tables = _order_tables(counts)
    unigrams = tables[-1][1]
    sizes = unigrams.groupBy("lang").agg((1.0 / (F.count(F.lit(1)) + 1)).alias("p"))  # uniform, with one place for the unseen
    asked = _models(counts, [F.lit(1), *(F.col(f"n{k}") for k in range(FOLDS))])  # a fold's documents hold n-grams of that fold only
    out = asked.select("lang", "key", "gram", "model").join(sizes, "lang")
    for n, own, contexts in reversed(tables):
        part = F.col("gram") if n == ORDER else F.col("gram").bitwiseAND(F.lit((1 << (16 * n)) - 1))
        out = out.withColumn("g", part).withColumn("h", F.shiftrightunsigned(part, 16))
        out = out.join(own, ["lang", "g"], "left").join(contexts, ["lang", "h"], "left")
        mixed = F.coalesce(F.col("rest"), F.lit(0.0)) / F.col("total") + F.col("gamma") * F.col("p")
        out = out.withColumn("p", F.when(F.col("total").isNull(), F.col("p")).otherwise(mixed)).drop("rest", "total", "gamma", "g", "h")
    names = ["logp", *(f"without{k}" for k in range(FOLDS))]
    return stored(out.groupBy("key").agg(*(F.max(F.when(F.col("model") == k, F.log("p"))).alias(x) for k, x in enumerate(names))), "scores")


def document_likelihoods(docs: DataFrame, scores: DataFrame) -> DataFrame:
    """(row, id, lang, fold, n_chars, loglik, unseen) from (id, text, lang, fold): one row a document.

    loglik is that of the full model, unseen that of the model without the document's fold; null without a model.
    """
    def run(batches):
        made = TaskContext.get().partitionId() << 36
        for batch in batches:
            langs = batch.column(2).to_pylist()
            for lo, hi, buf, offsets in tv.chunks(batch.column(1)):
                found, sizes = grams(buf, offsets)
                ends = np.cumsum(sizes)
                own = [_distinct(found[e - n: e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                rows = np.array([len(g) for g, _ in own])
                key = _keys(np.concatenate([g for g, _ in own]), np.repeat(_language_salts(langs[lo:hi]), rows))
                n = np.concatenate([c for _, c in own])
                bare = np.flatnonzero(sizes == 0)  # texts without characters still give a row
                which = np.concatenate([np.repeat(np.arange(hi - lo), rows), bare])
                taken = pa.array(which)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which + made), batch.column(0).slice(lo, hi - lo).take(taken), batch.column(2).slice(lo, hi - lo).take(taken), batch.column(3).slice(lo, hi - lo).take(taken),
                     pa.array(np.concatenate([key.view(np.int64), np.zeros(len(bare), dtype=np.int64)])),
                     pa.array(np.concatenate([n, np.zeros(len(bare), dtype=np.int64)]))], ["row", "id", "lang", "fold", "key", "n"])
                made += hi - lo

    kind = docs.schema["id"].dataType.simpleString()
    rows = docs.select("id", "text", "lang", "fold").mapInArrow(tv.returning(run), f"row long, id {kind}, lang string, fold int, key long, n long")
    small = scores.limit(MAX_TABLE + 1).count() <= MAX_TABLE
    scored = rows.join(F.broadcast(scores) if small else scores, "key", "left")
    unseen = F.col("logp")
    for k in range(FOLDS):
        unseen = F.when(F.col("fold") == k, F.col(f"without{k}")).otherwise(unseen)
    return scored.groupBy("row", "id", "lang", "fold").agg(F.sum("n").alias("n_chars"), F.sum(F.col("n") * F.col("logp")).alias("loglik"),
                                                           F.sum(F.col("n") * unseen).alias("unseen"))


def _limits(scored: DataFrame) -> DataFrame:
    """(limit_lang, limit) from (lang, n_chars, trusted, unseen)."""
    told = scored.where(F.col("trusted") & (F.col("n_chars") >= MIN_CHARS) & F.col("unseen").isNotNull())
    q = told.groupBy("lang").agg(F.percentile("unseen", F.array(F.lit(0.5), F.lit(HIGH))).alias("q"), F.count(F.lit(1)).alias("n"))
    q = stored(q.where(F.col("n") >= MIN_TRUSTED).select(F.col("lang").alias("l"), F.col("q")[0].alias("middle"), F.col("q")[1].alias("high")), "quantiles")
    own = q.select(F.col("l").alias("limit_lang"), (F.col("middle") + SPREADS * (F.col("high") - F.col("middle"))).alias("limit"))
    same = F.col("lang").eqNullSafe(F.col("l"))
    pooled = (told.join(F.broadcast(q), same).agg(F.percentile_approx(F.col("unseen") / F.col("middle"), HIGH, 10_000).alias("r"))
              .select((1 + SPREADS * F.coalesce(F.col("r") - 1, F.lit(SPREAD))).alias("ratio")))
    few = scored.where(F.col("unseen").isNotNull()).join(F.broadcast(q), same, "left_anti")
    level = F.col("unseen") / (1 + F.lit(SHORT) / F.col("n_chars"))
    middles = few.groupBy(F.col("lang").alias("limit_lang")).agg(F.percentile_approx(level, 0.5, 10_000).alias("middle"))
    return own.union(middles.crossJoin(F.broadcast(pooled)).select("limit_lang", F.col("middle") * F.col("ratio")))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row a document: key, lang, n_chars, trusted, perplexity, limit, kept."""
    good = (labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("good_id"))
            .agg(F.min(((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")).alias("ok")).where("ok = 1").select("good_id"))
    good = stored(good, "trusted")
    few = good.limit(MAX_TRUSTED + 1).count() <= MAX_TRUSTED
    side = F.broadcast(good) if few else good
    named = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    fold = F.when(F.col("good_id").isNotNull(), F.pmod(F.xxhash64("text"), F.lit(FOLDS))).otherwise(F.lit(-1)).cast("int")
    flagged = named.join(side, F.col("id") == F.col("good_id"), "left").withColumn("fold", fold).drop("good_id")
    scores = gram_scores(count_table(flagged.select("text", "lang", "fold")))
    scored = document_likelihoods(flagged, scores).withColumn("trusted", F.col("fold") >= 0)
    for at, loglik in (("perplexity", "loglik"), ("unseen", "unseen")):
        scored = scored.withColumn(at, F.when(F.col("n_chars") > 0, F.exp(-F.col(loglik) / F.col("n_chars"))))
    scored = stored(scored.drop("row", "loglik", "fold"), "scored")
    out = scored.join(F.broadcast(_limits(scored)), F.col("lang").eqNullSafe(F.col("limit_lang")), "left")
    bound = F.col("limit") * (1 + F.lit(SHORT) / F.nullif(F.col("n_chars"), F.lit(0)))
    kept = (F.col("n_chars") > 0) & F.coalesce(F.col("unseen") <= bound, F.lit(True))
    return out.select(F.col("id").alias(key), "lang", "n_chars", "trusted", "perplexity", "limit", kept.alias("kept"))
