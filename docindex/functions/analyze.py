"""Text analysis: documents -> token rows.

Token rows: ``_index, _id, field, token, start_offset, end_offset, type, position``.

The standard analyzer here is an approximation of Unicode word breaking (tier
P outside the asserted example): a token is a maximal run of letters/digits,
lower-cased; offsets count code points; positions start at 0; a token made of
digits only has type ``<NUM>``, any other ``<ALPHANUM>``. Apostrophes split
words and CJK text is not segmented per character.

The unicode analyzer follows the word-break rules of Unicode's UAX #29: combining
marks, joiners and format characters belong to the letter before them; an
apostrophe, a full stop or a colon between two letters, and a full stop or a comma between
two digits, do not break; connectors (``_``) join; every ideograph and hiragana
is a token of its own, a run of katakana is one. It has no dictionary for scripts
without spaces (Thai and its like are runs), and a token ends after ``MIDS`` inner marks.

Extraction, lower-casing and exploding stay in JVM expressions. The one piece
Spark SQL lacks is a prefix sum over an array (token end offsets); it is a
vectorised Arrow UDF over the documents' small int arrays, so no window and
no shuffle is needed: analysis is a pure per-document map. (Aggregate expressions
can build the same sums in the JVM; measured, they took seven times as long.)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Token types of the analyze response.
TYPE_ALPHANUM, TYPE_NUM, TYPE_WORD = "<ALPHANUM>", "<NUM>", "word"

# Fixed patterns (kept inside \p{L}\p{N}\s\S so Java and RE2 agree).
STANDARD_TOKEN = r"[\p{L}\p{N}]+"
STANDARD_PAIR = r"([^\p{L}\p{N}]*)([\p{L}\p{N}]+)"
WHITESPACE_PAIR = r"(\s*)(\S+)"
NUMERIC_TOKEN = r"^\p{N}+$"

# Characters that do not break between two letters, between two digits, or in either place (UAX #29).
MID_LETTER, MID_NUMBER, MID_BOTH = ":\u00b7\u0387\u05f4\u2027\ufe13\ufe55\uff1a", ",;\u037e\u0589\u060c\u060d\u066c\u07f8\u2044\ufe10\ufe14\ufe50\ufe54\uff0c\uff1b", ".'\u2018\u2019\u2024\ufe52\uff07\uff0e"
MIDS = 200  # the pattern engine recurses once for each, so their number in a token is bounded
_ALONE = r"\p{IsHan}\p{IsHiragana}"
_LETTER = r"[\p{L}\p{Nl}&&[^" + _ALONE + r"\p{IsKatakana}]]"
_REST = r"[\p{L}\p{Nl}\p{Nd}\p{M}\p{Cf}\p{Pc}&&[^" + _ALONE + r"\p{IsKatakana}]]*+"
UNICODE_TOKEN = (r"\p{Pc}*+(?:" + _LETTER + r"|\p{Nd})" + _REST
                 + rf"(?:(?:(?<=[\p{{L}}\p{{M}}\p{{Cf}}])[{MID_LETTER}{MID_BOTH}](?={_LETTER})|(?<=[\p{{Nd}}\p{{M}}\p{{Cf}}])[{MID_NUMBER}{MID_BOTH}](?=\p{{Nd}}))" + _REST + rf"){{0,{MIDS}}}"
                 + r"|\p{IsKatakana}[\p{IsKatakana}\u30fc\p{M}\p{Pc}]*+|[" + _ALONE + r"]\p{M}*+")
UNICODE_PAIR = r"(?s)(.*?)(" + UNICODE_TOKEN + r"|\z)"  # what follows the last token is one more pair, of an empty token

TOKEN_SCHEMA = ("_index string, _id string, field string, token string, start_offset int, "
                "end_offset int, type string, position int")


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def prefix_sum(lengths: pa.Array) -> pa.Array:
    """Running sum of each array, on the batch's flat buffers: no object a row."""
    if isinstance(lengths, pa.ChunkedArray):
        lengths = lengths.combine_chunks()
    ends = lengths.offsets.to_numpy()
    flat = lengths.values.slice(ends[0], ends[-1] - ends[0]).to_numpy(zero_copy_only=False)
    ends = ends - ends[0]
    total = np.cumsum(flat, dtype=np.uint32)  # wraps around; the differences are right all the same
    counts = np.diff(ends)
    before = np.where(ends[:-1] > 0, total[ends[:-1] - 1], 0).astype(np.uint32) if len(total) else np.zeros(len(counts), dtype=np.uint32)
    total -= np.repeat(before, counts)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(total.view(np.int32)), mask=lengths.is_null())


def standard_tokens(text: Column) -> Column:
    """Lower-cased standard tokens of ``text`` as an array (no offsets)."""
    return F.regexp_extract_all(F.lower(text), F.lit(STANDARD_TOKEN), 0)


def is_token(value: str) -> bool:
    """Whether ``value`` is one standard token: a run of letters and digits. Nothing else can equal a token."""
    import regex

    return bool(regex.fullmatch(r"[\p{L}\p{N}]+", value))


def quoted(value: str) -> str:
    """``value`` as a literal inside a JVM regular expression."""
    return r"\Q" + value.replace(r"\E", r"\E\\E\Q") + r"\E"


def term_in_text(text: Column, value: str) -> Column:
    """True when some standard token of ``text`` equals ``value``; a value that is not one token matches nothing."""
    if not is_token(value):
        return F.lit(False)
    return F.lower(text).rlike(r"(^|[^\p{L}\p{N}])" + quoted(value) + r"([^\p{L}\p{N}]|$)")


def _pair_tokens(df: DataFrame, key_cols: list[str], field: str, pair_pattern: str,
                 lowercase: bool, typed: bool) -> DataFrame:
    text = F.col(field)
    seps = F.regexp_extract_all(text, F.lit(pair_pattern), 1)
    toks = F.regexp_extract_all(text, F.lit(pair_pattern), 2)
    lens = F.zip_with(seps, toks, lambda s, t: F.length(s) + F.length(t))
    staged = df.select(*key_cols, toks.alias("_toks"), prefix_sum(lens).alias("_ends"))
    exploded = staged.select(*key_cols, F.posexplode(F.arrays_zip(F.col("_toks").alias("t"),
                                                                  F.col("_ends").alias("e"))).alias("position", "z")).where("z.t <> ''")
    tok = F.col("z.t")
    ttype = (F.when(tok.rlike(NUMERIC_TOKEN), F.lit(TYPE_NUM)).otherwise(F.lit(TYPE_ALPHANUM))
             if typed else F.lit(TYPE_WORD))
    return exploded.select(
        *key_cols,
        F.lit(field).alias("field"),
        (F.lower(tok) if lowercase else tok).alias("token"),
        (F.col("z.e") - F.length(tok)).cast("int").alias("start_offset"),
        F.col("z.e").cast("int").alias("end_offset"),
        ttype.alias("type"),
        F.col("position").cast("int").alias("position"),
    )


def analyze(df: DataFrame, text_col: str, analyzer: str = "standard",
            key_cols: list[str] | None = None) -> DataFrame:
    """Token rows of ``text_col`` with the named analyzer (standard, unicode, whitespace, keyword)."""
    key_cols = key_cols if key_cols is not None else [c for c in ("_index", "_id") if c in df.columns]
    if analyzer == "standard":
        return _pair_tokens(df, key_cols, text_col, STANDARD_PAIR, lowercase=True, typed=True)
    if analyzer == "unicode":
        return _pair_tokens(df, key_cols, text_col, UNICODE_PAIR, lowercase=True, typed=True)
    if analyzer == "whitespace":
        return _pair_tokens(df, key_cols, text_col, WHITESPACE_PAIR, lowercase=False, typed=False)
    if analyzer == "keyword":
        v = F.col(text_col)
        return df.where(v.isNotNull()).select(
            *key_cols, F.lit(text_col).alias("field"), v.alias("token"),
            F.lit(0).alias("start_offset"), F.length(v).cast("int").alias("end_offset"),
            F.lit(TYPE_WORD).alias("type"), F.lit(0).alias("position"))
    raise ValueError(f"unknown analyzer {analyzer!r}")


def analyze_text(spark, text: str, analyzer: str = "standard") -> DataFrame:
    """The ``_analyze`` call on one text (a one-row frame through the same code path)."""
    df = spark.createDataFrame([(text,)], "text string")
    return analyze(df, "text", analyzer, key_cols=[])


def analyze_by_mapping(df: DataFrame, analyzers: dict[str, str],
                       key_cols: list[str] | None = None) -> DataFrame:
    """T4: one analyzer per field (index-time analyzers of a mapping), unioned."""
    parts = [analyze(df, f, a, key_cols) for f, a in analyzers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def search_terms(query_text: str, analyzer: str = "standard") -> list[str]:
    """Analyze a short query string (a call argument) into terms, as the search analyzer would."""
    import regex

    if analyzer == "keyword":
        return [query_text]
    if analyzer == "whitespace":
        return query_text.split()
    return [t.lower() for t in regex.findall(r"[\p{L}\p{N}]+", query_text)]
