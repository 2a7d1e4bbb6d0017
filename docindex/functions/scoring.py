"""R10 relevance: BM25 over the standard analyzer's tokens (tier P).

score(d) = sum_t idf(t) * tf / (tf + k1 * (1 - b + b * dl / avgdl)),
idf(t) = ln(1 + (N - df + 0.5) / (df + 0.5)), k1 = 1.2, b = 0.75
(Robertson & Zaragoza 2009, without the constant (k1 + 1) factor). Norms are
exact token counts, not a lossy byte encoding.

``dfs_query_then_fetch``: statistics over the whole corpus, gathered in one
aggregate (a few numbers: N, total length, one df per query term) and shipped
to the executors as literals, as a coordinator would.
``query_then_fetch``: statistics per (index, shard), one row each, joined back with
a broadcast whose size is bounded by indices x shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docindex.functions.analyze import STANDARD_TOKEN, is_token, quoted

# The usual BM25 parameters.
K1 = 1.2
B = 0.75


def _term_count(lower_text, term: str):
    """Occurrences of ``term`` as a whole standard token in lower-cased text (JVM regex count)."""
    if not is_token(term):
        return F.lit(0)
    return F.regexp_count(lower_text, F.lit(r"(?<![\p{L}\p{N}])" + quoted(term) + r"(?![\p{L}\p{N}])"))


def bm25(df: DataFrame, field: str, terms: list[str], search_type: str = "dfs_query_then_fetch",
         k1: float = K1, b: float = B) -> DataFrame:
    """Matches (at least one query term) with ``_score``; other columns kept.

    Term frequencies and document lengths are regex counts over the lower-cased
    text: no token arrays are built, and everything stays inside JVM codegen.
    """
    terms = list(dict.fromkeys(t for t in terms if t))
    if not terms:
        raise ValueError("no query terms")
    base = df.where(F.col(field).isNotNull()).withColumn("_lt", F.lower(F.col(field)))
    staged = base.select(
        *df.columns, F.regexp_count(F.col(field), F.lit(STANDARD_TOKEN)).alias("_dl"),
        *[_term_count(F.col("_lt"), t).alias(f"_tf{i}") for i, t in enumerate(terms)])
    stat_aggs = [F.count(F.lit(1)).alias("_n"), F.sum("_dl").alias("_len")]
    stat_aggs += [F.count_if(F.col(f"_tf{i}") > 0).alias(f"_df{i}") for i in range(len(terms))]

    def score(n, length, dfs):
        avgdl = length / n
        total = F.lit(0.0)
        for i in range(len(terms)):
            idf = F.log(F.lit(1.0) + (n - dfs[i] + F.lit(0.5)) / (dfs[i] + F.lit(0.5)))
            tf = F.col(f"_tf{i}").cast("double")
            norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("_dl") / avgdl)
            total = total + F.when(tf > 0, idf * tf / (tf + norm)).otherwise(F.lit(0.0))
        return total

    # Match test: one boundary-anchored alternation with rlike, which stops at the first
    # hit. Catalyst pushes this filter into the scan, so it must stay cheap; the
    # per-term counts are computed only for matching documents.
    alternation = "|".join(quoted(t) for t in terms if is_token(t))
    any_tf = F.lower(F.col(field)).rlike(r"(?<![\p{L}\p{N}])(?:" + alternation + r")(?![\p{L}\p{N}])") if alternation else F.lit(False)
    if search_type == "dfs_query_then_fetch":
        st = staged.agg(*stat_aggs).collect()[0]
        if not st["_n"]:
            return staged.where(F.lit(False)).withColumn("_score", F.lit(None).cast("double")).select(*df.columns, "_score")
        n = F.lit(float(st["_n"]))
        length = F.lit(float(st["_len"] or 0))
        dfs = [F.lit(float(st[f"_df{i}"])) for i in range(len(terms))]
        out = staged.where(any_tf).withColumn("_score", score(n, length, dfs))
    elif search_type == "query_then_fetch":
        stats = staged.groupBy("_index", "shard").agg(*stat_aggs)
        joined = staged.where(any_tf).join(F.broadcast(stats), ["_index", "shard"])
        out = joined.withColumn("_score", score(F.col("_n").cast("double"), F.col("_len").cast("double"),
                                                [F.col(f"_df{i}").cast("double") for i in range(len(terms))]))
    else:
        raise ValueError(f"unknown search_type {search_type!r}")
    return out.select(*df.columns, "_score")


def match_query(df: DataFrame, field: str, text: str, search_analyzer: str = "standard",
                search_type: str = "dfs_query_then_fetch") -> DataFrame:
    """A full-text query: the query text is analysed with the field's search analyzer
    (T4: it may differ from the index analyzer), then its terms are scored by BM25."""
    from docindex.functions.analyze import search_terms

    return bm25(df, field, search_terms(text, search_analyzer), search_type)
