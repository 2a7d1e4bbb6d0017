"""A written token table (inverted index) for term lookups and BM25.

Layout under ``root``: ``postings/b=<bucket>/`` holds one row per (term, document) with its frequency and the document's
length, in the bucket of the term's hash; ``stats`` one row per (index, shard) with documents and total length. A query
reads the buckets of its terms only and never the texts. Documents are dealt into segments, and the task of a segment
writes one file a bucket, sorted by term: the texts are shuffled once, the postings never. A very common term is one row
per document that holds it, in the files of all segments.

Documents are dealt into blocks by their length class and a hash, about ``BLOCK_DOCS`` each, and ``blocks/b=<bucket>/``
holds one row per (term, block): documents, greatest frequency, least length. From these few rows ``bm25_top`` bounds the
score of any document of a block, and reads only the postings of blocks that can still reach the top k.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docindex.functions.analyze import standard_tokens
from docindex.functions.route import route
from docindex.functions.scoring import B, K1
from docindex.operators.rank import input_bytes, materialize

KEY = ["_index", "_id", "shard"]
BLOCK_DOCS = 128
LENGTH_CLASSES = 4  # a doubling of the length
SEGMENT_BYTES = 16 << 20  # input bytes whose postings one task writes, about


def _block(parts: int):
    """A document's block: its length class, and one of ``parts`` by hash."""
    size = F.floor(F.log2(F.col("dl") + 1.0) * LENGTH_CLASSES).cast("long")
    return size * parts + F.pmod(F.xxhash64("_index", "_id"), F.lit(parts))


def _bucket(term, buckets: int):
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _segments(df: DataFrame) -> int:
    """Tasks that write a token table, each a file a bucket: by the bytes of the input."""
    return max(1, -(-input_bytes(df) // SEGMENT_BYTES))


def write_postings(df: DataFrame, field: str, root: str, buckets: int = 64, n_shards: int = 4) -> None:
    """Index the standard tokens of ``field`` for the live documents of ``df``; a null field has no tokens."""
    live = df.where(~F.col("_deleted")) if "_deleted" in df.columns else df
    live = live if "shard" in live.columns else route(live, n_shards)
    tokens = live.where(F.col(field).isNotNull()).select(*KEY, standard_tokens(F.col(field)).alias("t")).withColumn("dl", F.size("t").cast("long"))
    base, spark = root.rstrip("/"), df.sparkSession
    (tokens.groupBy("_index", "shard").agg(F.count(F.lit(1)).alias("docs"), F.sum("dl").alias("length"))
     .withColumn("buckets", F.lit(buckets)).write.parquet(f"{base}/stats"))
    docs = spark.read.parquet(f"{base}/stats").agg(F.sum("docs")).first()[0] or 0
    parts = max(1, docs // (8 * BLOCK_DOCS))  # lengths fall into eight classes or more
    # Texts are dealt by document, so a document's terms are counted, sorted and written where it lies.
    dealt = live.where(F.col(field).isNotNull()).select(*KEY, F.col(field).alias("text")).repartition(_segments(df), *KEY)
    terms = dealt.select(*KEY, standard_tokens(F.col("text")).alias("t")).select(*KEY, F.size("t").cast("long").alias("dl"), F.explode("t").alias("term"))
    rows = terms.groupBy(*KEY, "dl", "term").agg(F.count(F.lit(1)).alias("tf"))
    rows = rows.select("term", *KEY, "dl", "tf", _block(parts).alias("block"), _bucket(F.col("term"), buckets).alias("b"))
    rows.sortWithinPartitions("b", "term", "block").write.partitionBy("b").parquet(f"{base}/postings")
    written = spark.read.schema(_POSTINGS).parquet(f"{base}/postings")
    (written.groupBy("b", "term", "block").agg(F.count(F.lit(1)).alias("docs"), F.max("tf").alias("tf"), F.min("dl").alias("dl"))
     .coalesce(_segments(df)).sortWithinPartitions("b", "term").write.partitionBy("b").parquet(f"{base}/blocks"))


_POSTINGS = "term string, _index string, _id string, shard int, dl long, tf long, block long, b int"
_BLOCKS = "term string, block long, docs long, tf long, dl long, b int"


def _of_terms(spark: SparkSession, root: str, part: str, schema: str, terms: list[str]) -> DataFrame:
    """Rows of the terms: only their buckets are read."""
    count = spark.read.parquet(f"{root.rstrip('/')}/stats").agg(F.max("buckets")).first()[0]
    if count is None:
        return spark.createDataFrame([], schema).drop("b")
    wanted = [r[0] for r in spark.createDataFrame([(t,) for t in terms], "t string").select(_bucket(F.col("t"), count)).collect()]
    found = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{part}")
    return found.where(F.col("b").isin(wanted) & F.col("term").isin(terms)).drop("b")


def read_postings(spark: SparkSession, root: str, terms: list[str]) -> DataFrame:
    """Postings of the terms: only their buckets are read."""
    return _of_terms(spark, root, "postings", _POSTINGS, terms).drop("block")


def bm25_postings(spark: SparkSession, root: str, terms: list[str], search_type: str = "dfs_query_then_fetch",
                  k1: float = K1, b: float = B) -> DataFrame:
    """R10 from the token table: ``_index, _id, shard, _score`` of the documents that hold a term."""
    terms = list(dict.fromkeys(terms))
    scope = [] if search_type == "dfs_query_then_fetch" else ["_index", "shard"]
    hits = read_postings(spark, root, terms)
    df = hits.groupBy("term", *scope).agg(F.count(F.lit(1)).alias("df"))  # a row per term (and shard)
    stats = spark.read.parquet(f"{root.rstrip('/')}/stats").groupBy(*scope).agg(F.sum("docs").alias("n"), F.sum("length").alias("len"))
    if scope:
        known = df.join(stats, scope)
    else:
        whole = stats.first()
        known = df.withColumn("n", F.lit(whole["n"])).withColumn("len", F.lit(whole["len"]))
    joined = hits.join(F.broadcast(known), ["term", *scope])  # at most terms x shards rows
    idf = F.log(1.0 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = k1 * (1.0 - b + b * F.col("dl") / (F.col("len").cast("double") / F.col("n")))
    return joined.groupBy(*KEY).agg(F.sum(idf * F.col("tf") / (F.col("tf") + norm)).alias("_score"))


@dataclass
class Top:
    """The best documents of a query, and how many of its blocks were scored for them."""

    hits: DataFrame  # _index, _id, shard, _score; at most k rows, best first
    blocks: int
    scored: int


def bm25_top(spark: SparkSession, root: str, terms: list[str], k: int, k1: float = K1, b: float = B) -> Top:
    """R10, the first ``k`` documents by corpus-wide BM25, then key, without scoring every match.

    The k blocks of the highest bounds are scored first (each holds a document at least); the k-th best score found
    there is a limit, and of the other blocks only those whose bound reaches it are scored. Equal to the full ranking,
    ties included.
    """
    terms = list(dict.fromkeys(terms))
    blocks = _of_terms(spark, root, "blocks", _BLOCKS, terms)
    whole = spark.read.parquet(f"{root.rstrip('/')}/stats").agg(F.sum("docs").alias("n"), F.sum("length").alias("len")).first()
    found = dict(blocks.groupBy("term").agg(F.sum("docs")).collect())  # a row a term
    empty = spark.createDataFrame([], "_index string, _id string, shard int, _score double")
    if not found or k < 1:
        return Top(empty, 0, 0)
    n = float(whole["n"])
    idf = F.lit(None).cast("double")
    for t, df in found.items():
        idf = F.when(F.col("term") == t, F.log(F.lit(1.0 + (n - df + 0.5) / (df + 0.5)))).otherwise(idf)
    # The same expression scores a document and bounds a block (greatest frequency, least length).
    part = idf * F.col("tf") / (F.col("tf") + k1 * (1.0 - b + b * F.col("dl") / (F.lit(float(whole["len"])) / F.lit(n))))
    bounds = materialize(blocks.groupBy("block").agg((F.sum(part) * (1 + 1e-9)).alias("bound")), "bounds")
    postings = _of_terms(spark, root, "postings", _POSTINGS, terms)

    def score(chosen: DataFrame) -> DataFrame:
        return postings.join(chosen.select("block"), "block", "left_semi").groupBy(*KEY).agg(F.sum(part).alias("_score"))

    best = [F.col("_score").desc(), F.col("_index"), F.col("_id")]
    head = bounds.orderBy(F.desc("bound"), "block").limit(k)
    first = materialize(score(head), "top-first")
    kth = first.orderBy(*best).offset(k - 1).limit(1).first()
    rest = bounds.join(head.select("block"), "block", "left_anti")
    rest = materialize(rest if kth is None else rest.where(F.col("bound") >= F.lit(kth["_score"])), "top-rest")
    hits = first.unionByName(score(rest)).orderBy(*best).limit(k)
    total = bounds.count()
    return Top(hits, total, min(k, total) + rest.count())
