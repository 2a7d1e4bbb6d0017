"""Quality rules: distribution divergence against language references.

A document gets two histograms: character classes (share of its code points)
and common words of its language (share of its words; the rest is one more
bin). The reference of a language is the median of each bin over all its documents
that pass the base rules, over the whole corpus; a median, unlike a mean, stays put when
a tenth of the corpus is junk. A document is rejected when
the Jensen-Shannon distance (base 2, square root, so within [0, 1]) of either
histogram from its reference is over a limit; characters are held against the nearest
reference of any language, so a wrong language label alone rejects nothing. Guards: the character histogram is
compared from ``min_chars`` code points on and the word histogram from ``min_words``
words on, because the histogram of a short text is mostly noise.

Every document has its characters tested, whatever its language. A language has a reference from ``MIN_DOCS`` documents
that pass the base rules on, however large the rest of the corpus is; null is a language of its own. A document without
such a reference is held against all others and the median of the whole corpus, in classes that do not depend on the
script (letters with or without case are one class; symbols and marks beyond ASCII are told from letters; where most
letters have no case, spaces count as letters, as not every script has them). A reference that is itself over the limit
from the corpus is none, however many documents stand behind it: a label that holds nothing but junk has no reference,
and its documents are judged as if it had too few.

A language without a list of common words takes those of the largest mean share in its own documents. There, a document
passes as well if it fits a listed language. Null and the codes in ``UNNAMED`` mix languages and have no word test.

Two passes over the documents (three where languages have no list of words), no shuffle of texts: pass 1 leaves, per task, language and
bin, counts of 256 levels, from which Spark takes exact medians; pass 2 decides row by row. One more pass, only over
documents of languages without a list, leaves word hashes with their shares. What goes to the driver and into the closure
is one small row a language label of ``MIN_DOCS`` documents or more.

Cases: a null or empty text has no words and fails the base rule; repeated rows are judged alike;
an empty table gives an empty result; other columns are passed through (filter) or left out (scores).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docindex.llm import textvec as tv
from docindex.llm.scratch import stored

# Common words by language; other languages take theirs from the corpus.
COMMON_WORDS = {
    "en": "the of and to in a is that it on for was with be by at this from as are or an he not".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par sur au avec pas il ne se plus".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o".split(),
}
CLASSES = ["lower", "upper", "space", "punctuation", "symbol", "other"]  # digits are left out: numbers and ids are no junk
_SYMBOLS = b"#*$%&|<>"

UNNAMED = ["", "und", "mul", "mis", "zxx", "unknown", "other"]

MIN_WORDS, MIN_CHARS, MIN_DOCS, LEVELS = 50, 200, 10, 256
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.15, 0.45
_WIDTH = max(len(v) for v in COMMON_WORDS.values()) + 1
_SHARE_UNIT = 1_000_000_000


def _class_table() -> np.ndarray:
    t = np.full(256, 4, dtype=np.int64)
    t[128:] = 5
    t[128:192] = 7  # continuation bytes: not a code point of their own
    t[97:123], t[65:91], t[48:58] = 0, 1, 7
    t[[9, 10, 11, 12, 13, 32]] = 2
    for c in b".,;:!?'\"()-":
        t[c] = 3
    return t


_CLASS = _class_table()
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(_SYMBOLS)] = True
_SALT = np.uint64(0xA24BAED4963EE407)


def _common_hashes(counted: dict) -> dict:
    """{language: (ascending word hashes, bin of each)}: the lists, and ``counted`` for other languages."""
    out = {lang: (np.sort(found), np.argsort(found)) for lang, found in counted.items()}
    for lang, listed in COMMON_WORDS.items():
        raw = [w.encode() for w in listed]
        ends = np.cumsum([len(w) for w in raw])
        hashes = tv.span_hashes(np.frombuffer(b"".join(raw), dtype=np.uint8), ends - [len(w) for w in raw], ends)
        order = np.argsort(hashes)
        out[lang] = hashes[order], order
    return out


def base_metrics(buf: np.ndarray, offsets: np.ndarray) -> dict:
    """Counts of the base rules for each text of one chunk, plus the spans reused by the histograms."""
    n = len(offsets) - 1
    starts, ends, first = tv.word_spans(buf, offsets)
    n_words = np.diff(first)
    lead = (buf & 0xC0) != 0x80
    solid = ~tv.WHITE[buf]
    # Lines: a text's pieces between \n; only those holding a word count.
    nl = np.flatnonzero(buf == 10)
    line_starts = np.sort(np.concatenate([offsets[:-1], nl + 1]))
    line_ends = np.sort(np.concatenate([nl, offsets[1:]]))
    solid_before = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum(solid, out=solid_before[1:])
    with_word = solid_before[line_ends] > solid_before[line_starts]
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    line_doc = np.searchsorted(offsets, line_starts, side="right") - 1
    line_key = tv.mix(tv.span_hashes(buf, line_starts, line_ends) + line_doc.astype(np.uint64) * _SALT)
    dup_lines = np.bincount(line_doc[tv.duplicate_positions(line_key)[0]], minlength=n)
    # Three-word windows: a word is repeated if a window over it occurs twice or more in its text.
    words = tv.span_hashes(buf, starts, ends)
    doc = tv.owners(first)
    repeated = np.zeros(len(words), dtype=bool)
    if len(words) >= 3:
        inside = doc[2:] == doc[:-2]
        at = np.flatnonzero(inside)
        key = words[at] * np.uint64(3) + tv.mix(words[at + 1]) * np.uint64(5) + tv.mix(words[at + 2] ^ _SALT)
        hit = at[tv.duplicate_positions(tv.mix(key + doc[at].astype(np.uint64) * _SALT))[1]]
        for k in range(3):
            repeated[hit + k] = True
    n_repeat = np.bincount(doc[repeated], minlength=n)
    return {"n_words": n_words, "word_chars": tv.sums(lead & solid, offsets),
            "n_symbols": tv.sums(_IS_SYMBOL[buf], offsets), "n_dup_lines": dup_lines, "n_repeat_words": n_repeat,
            "base_failed": (n_words < 50) | (100 * n_repeat > 50 * n_words),
            "words": words, "starts": starts, "first": first, "doc": doc}


def _lowered_hashes(buf, offsets, m: dict) -> np.ndarray:
    return tv.span_hashes(tv.LOWER[buf], m["starts"], _word_ends(buf, m, offsets))


def _word_counts(hashes, m: dict, rows: np.ndarray, common: tuple) -> np.ndarray:
    """Counts of the common words of one language and of the rest, for the texts flagged in ``rows``."""
    n, (listed, slot) = len(rows), common
    pick = np.flatnonzero(rows[m["doc"]])
    if not len(pick):
        return np.zeros((n, _WIDTH))
    at = np.minimum(np.searchsorted(listed, hashes[pick]), len(listed) - 1)
    bins = np.where(listed[at] == hashes[pick], slot[at], _WIDTH - 1)
    return np.bincount(m["doc"][pick] * _WIDTH + bins, minlength=n * _WIDTH).reshape(n, _WIDTH).astype(float)


def _of(langs: list, lang) -> np.ndarray:
    return np.array([x == lang for x in langs], dtype=bool)


def histograms(buf, offsets, m: dict, langs: list, common: dict):
    """Normalised character-class and common-word histograms, one row a text; characters; hashes of the words."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    chars = np.bincount(owner * 8 + _CLASS[buf], minlength=8 * n).reshape(n, 8)[:, :6].astype(float)
    hashes = _lowered_hashes(buf, offsets, m)
    counts = np.zeros((n, _WIDTH))
    for lang in set(langs) & set(common):
        counts += _word_counts(hashes, m, _of(langs, lang), common[lang])
    return _share(chars), _share(counts), chars.sum(axis=1), hashes


def script_free(buf, offsets) -> np.ndarray:
    """Counts of letters, capitals, spaces, punctuation and symbols of each text, symbols beyond ASCII told by their lead bytes."""
    n = len(offsets) - 1
    kind = _CLASS[buf]
    kind[kind == 5] = 0

    def lead(byte):
        at = np.flatnonzero(buf == byte)
        return at, buf[np.minimum(at + 1, len(buf) - 1)]

    at, then = lead(0xC2)  # U+0080 to U+00BF
    kind[at] = np.select([then == 0xA0, np.isin(then, [0xAA, 0xB5, 0xBA]), np.isin(then, [0xA1, 0xAB, 0xB7, 0xBB, 0xBF])], [2, 0, 3], 4)
    at, then = lead(0xC3)
    kind[at[np.isin(then, [0x97, 0xB7])]] = 4  # times and division signs
    at, then = lead(0xE2)  # U+2000 to U+2FFF: punctuation, symbols, and from U+2C00 on a few scripts
    kind[at] = np.select([then == 0x80, ((then >= 0xB0) & (then <= 0xB7)) | (then >= 0xBA)], [3, 0], 4)
    at, then = lead(0xE3)
    kind[at[then == 0x80]] = 3  # ideographic punctuation
    at, then = lead(0xF0)
    kind[at[then == 0x9F]] = 4  # pictographs
    owner = np.repeat(np.arange(n), np.diff(offsets))
    return np.bincount(owner * 8 + kind, minlength=8 * n).reshape(n, 8)[:, :5].astype(float)


def _caseless(counts: np.ndarray) -> np.ndarray:
    """Script-free counts with spaces among the letters."""
    out = counts.copy()
    out[:, 0] += out[:, 2]
    out[:, 2] = 0
    return out


def _word_ends(buf, m, offsets):
    """Ends of the words, without trailing sentence punctuation, so that 'the,' counts as 'the'."""
    _, ends, _ = tv.word_spans(buf, offsets)
    for _ in range(2):
        last = buf[ends - 1] if len(ends) else np.zeros(0, dtype=np.uint8)
        ends = ends - (np.isin(last, np.frombuffer(b".,;:!?", dtype=np.uint8)) & (ends - m["starts"] > 1))
    return ends


def _share(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=1, keepdims=True)
    return np.divide(counts, total, out=np.zeros_like(counts), where=total > 0)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of the rows of ``p`` from ``q``, in [0, 1]."""
    mid = (p + q) / 2

    def part(a):
        ratio = np.divide(a, mid, out=np.ones_like(mid), where=(a > 0) & (mid > 0))
        return (a * np.log2(ratio)).sum(axis=1)

    return np.sqrt(np.clip((part(p) + part(np.broadcast_to(q, p.shape))) / 2, 0, 1))


class References(NamedTuple):
    own: dict  # language: (characters, words), each language that has a reference
    shared: list  # characters of the references that count for every language
    free: np.ndarray  # script-free classes of the shared ones and of the whole corpus
    counted: dict  # language without a list: hashes of its common words


def counted_words(docs: DataFrame, text: str = "text", lang: str = "lang", min_docs: int = MIN_DOCS) -> dict:
    """{language without a list: hashes of its words of the largest mean share over documents that pass the base rules}."""
    l = F.col(lang)
    unlisted = docs.where(l.isNotNull() & ~l.isin(*COMMON_WORDS, *UNNAMED))
    large = [r[0] for r in unlisted.groupBy(l).count().where(F.col("count") >= min_docs).select(l).collect()]
    if not large:
        return {}
    wanted = set(large)

    def partial(batches):
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for lo, hi, buf, offsets in tv.chunks(batch.column(0)):
                m = base_metrics(buf, offsets)
                hashes, each = _lowered_hashes(buf, offsets, m), _SHARE_UNIT // np.maximum(m["n_words"], 1)
                for x in set(langs[lo:hi]) & wanted:
                    rows = _of(langs[lo:hi], x) & ~m["base_failed"]
                    pick = np.flatnonzero(rows[m["doc"]])
                    found, inverse = np.unique(hashes[pick], return_inverse=True)
                    total = np.zeros(len(found), dtype=np.int64)
                    np.add.at(total, inverse, each[m["doc"][pick]])
                    yield pa.RecordBatch.from_arrays([pa.array([x] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(total)],
                                                     ["l", "word", "n"])

    parts = unlisted.select(F.col(text).alias("t"), l.alias("l")).mapInArrow(tv.returning(partial), "l string, word long, n long")
    sums = parts.groupBy("l", "word").agg(F.sum("n").alias("n"))
    # Ranked within parts of a language first, so that no task sorts all words of one.
    best = sums
    for keys in (["l", F.pmod("word", F.lit(256))], ["l"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "word"))
        best = best.withColumn("rank", rank).where(F.col("rank") < _WIDTH).drop("rank")
    out: dict = {}
    for x, word, _ in best.collect():  # at most _WIDTH - 1 rows a language
        out.setdefault(x, []).append(word)
    return {x: np.sort(np.array(words, dtype=np.int64).view(np.uint64)) for x, words in out.items()}


def references(docs: DataFrame, text: str = "text", lang: str = "lang", min_docs: int = MIN_DOCS,
               max_char: float = MAX_CHAR_DISTANCE) -> References:
    """Median histograms by language, and of the whole corpus, over all documents that pass the base rules."""
    size = len(CLASSES) + _WIDTH
    counted = counted_words(docs, text, lang, min_docs)

    def partial(batches):
        common = _common_hashes(counted)
        for batch in batches:
            found: dict = {}
            langs = batch.column(1).to_pylist()
            for lo, hi, buf, offsets in tv.chunks(batch.column(0)):
                m = base_metrics(buf, offsets)
                chars, words, _, _ = histograms(buf, offsets, m, langs[lo:hi], common)
                level = np.rint(np.sqrt(np.hstack([chars, words])) * (LEVELS - 1)).astype(np.int64)
                good = ~m["base_failed"]
                for x in set(langs[lo:hi]):
                    rows = good & _of(langs[lo:hi], x)
                    at = np.arange(size) * LEVELS + level[rows]
                    at, n = np.unique(at, return_counts=True)
                    held = found.setdefault(x, {})
                    for k, c in zip(at.tolist(), n.tolist()):
                        held[k] = held.get(k, 0) + c
            for x, held in found.items():
                at, n = np.array(list(held), dtype=np.int64), np.array(list(held.values()), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x] * len(at), pa.string()), pa.array(at // LEVELS, pa.int64()),
                     pa.array(at % LEVELS, pa.int64()), pa.array(n)], ["l", "bin", "level", "n"])

    parts = docs.select(F.col(text).alias("t"), F.col(lang).alias("l")).mapInArrow(tv.returning(partial), "l string, bin long, level long, n long")
    counts = stored(parts.groupBy("l", "bin", "level").agg(F.sum("n").alias("n")), "levels")
    median = [F.expr("percentile(level, 0.5D, n)").alias("m"), F.sum("n").alias("n")]
    corpus = np.zeros(len(CLASSES))
    whole = counts.where(F.col("bin") < len(CLASSES)).groupBy("bin", "level").agg(F.sum("n").alias("n")).groupBy("bin").agg(*median)
    for k, m, _ in whole.collect():
        corpus[k] = (m / (LEVELS - 1)) ** 2
    found: dict = {}
    for x, k, m, _ in counts.groupBy("l", "bin").agg(*median).where(F.col("n") >= min_docs).collect():  # size rows a language
        found.setdefault(x, np.zeros(size))[k] = (m / (LEVELS - 1)) ** 2
    own = {x: tuple(_share(v[None, :])[0] for v in (h[: len(CLASSES)], h[len(CLASSES):])) for x, h in found.items()}
    fold = lambda h: np.array([h[0] + h[5], *h[1:5]])
    if not corpus.any():
        return References({}, [], np.zeros((0, 5)), counted)
    middle = fold(_share(corpus[None, :])[0])
    own = {x: r for x, r in own.items() if js_distance(_caseless(fold(r[0])[None, :]), _caseless(middle[None, :])[0])[0] <= max_char}
    shared = [r[0] for r in own.values()]
    return References(own, shared, np.array([fold(r) for r in shared] + [middle]), counted)


def judge(buf, offsets, langs, refs: References, common, min_words=MIN_WORDS, min_chars=MIN_CHARS,
          max_char=MAX_CHAR_DISTANCE, max_word=MAX_WORD_DISTANCE) -> dict:
    """Base metrics, both distances (null under the guard, or without common words) and the verdict."""
    m = base_metrics(buf, offsets)
    chars, words, n_chars, hashes = histograms(buf, offsets, m, langs, common)
    by_char, by_word = np.full(len(langs), np.nan), np.full(len(langs), np.nan)
    long_enough = n_chars >= min_chars
    with_own = np.array([x in refs.own for x in langs], dtype=bool)
    rows = long_enough & with_own
    if rows.any() and refs.shared:
        by_char[rows] = np.min([js_distance(chars[rows], r) for r in refs.shared], axis=0)
    rows = long_enough & ~with_own
    if rows.any() and len(refs.free):
        free = script_free(buf, offsets)
        no_case = chars[:, 5] > chars[:, 0] + chars[:, 1]
        for some, fold in ((rows & ~no_case, lambda x: x), (rows & no_case, _caseless)):
            if some.any():
                by_char[some] = np.min([js_distance(_share(fold(free[some])), r) for r in fold(refs.free)], axis=0)
    enough_words = m["n_words"] >= min_words
    for lang in set(langs) & set(refs.own):
        rows = _of(langs, lang)
        if lang in common:
            some = rows & enough_words
            by_word[some] = js_distance(words[some], refs.own[lang][1])
            if lang not in COMMON_WORDS:
                some &= by_word > max_word  # a label that stands on several languages
                for other in set(COMMON_WORDS) & set(refs.own) if some.any() else ():
                    counts = _share(_word_counts(hashes, m, some, common[other]))
                    by_word[some] = np.minimum(by_word[some], js_distance(counts[some], refs.own[other][1]))
    m["char_distance"], m["word_distance"] = by_char, by_word
    with np.errstate(invalid="ignore"):
        m["kept"] = ~m["base_failed"] & ~(by_char > max_char) & ~(by_word > max_word)
    return m


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **limits) -> DataFrame:
    """One row a document: key, base counts, distances, kept."""
    refs = references(docs, text, lang)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        common = _common_hashes(refs.counted)
        for batch in batches:
            langs = batch.column(2).to_pylist()
            for lo, hi, buf, offsets in tv.chunks(batch.column(1)):
                m = judge(buf, offsets, langs[lo:hi], refs, common, **limits)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *(pa.array(m[c], pa.int64()) for c in counts),
                     pa.array(m["base_failed"]), pa.array(m["kept"]),
                     *(pa.array(m[c], mask=np.isnan(m[c])) for c in ("char_distance", "word_distance"))],
                    [key, *counts, "base_failed", "kept", "char_distance", "word_distance"])

    source = docs.select(F.col(key), F.col(text), F.col(lang))
    fields = ", ".join(f"{c} long" for c in counts)
    kind = docs.schema[key].dataType.simpleString()
    return source.mapInArrow(tv.returning(run), f"`{key}` {kind}, {fields}, base_failed boolean, kept boolean, "
                                  "char_distance double, word_distance double")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", **limits) -> DataFrame:
    """The rows of ``docs`` that pass; every column as it was."""
    refs = references(docs, text, lang)
    text_at, lang_at = docs.columns.index(text), docs.columns.index(lang)

    def run(batches):
        common = _common_hashes(refs.counted)
        for batch in batches:
            langs = batch.column(lang_at).to_pylist()
            for lo, hi, buf, offsets in tv.chunks(batch.column(text_at)):
                kept = judge(buf, offsets, langs[lo:hi], refs, common, **limits)["kept"]
                yield batch.slice(lo, hi - lo).filter(pa.array(kept))

    return docs.mapInArrow(tv.returning(run), docs.schema)
