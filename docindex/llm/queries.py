"""Registered queries of the training-data operators: thin readers of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docindex.llm import (chat_format, decontaminate, hard_negatives, html_crf, kneser_ney, packing, pii_crf, quality_divergence, rank_queue_bpe,
                          setsketch_dedup, token_align, token_files, url_cascade)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_divergence(spark, sf_dir):
    return quality_divergence.scores(_table(spark, sf_dir, "documents"))


def op2_setsketch_dedup(spark, sf_dir):
    """Shingles of two words, as this query's contract asks; the operator's own default is five."""
    return setsketch_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2)


def op3_pii_crf(spark, sf_dir):
    return pii_crf.report(_table(spark, sf_dir, "documents"))


def op4_kneser_ney(spark, sf_dir):
    return kneser_ney.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_html_crf(spark, sf_dir):
    return html_crf.extract(_table(spark, sf_dir, "pages"), keep=("url",))


def op6_chat_format(spark, sf_dir):
    """All conversations and one more (-7) whose texts hold control strings."""
    told = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", told), (-7, 1, "assistant", told)], "conv_id long, turn long, role string, text string")
    given = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return chat_format.report(given.union(probe))


def op7_token_files(spark, sf_dir):
    return token_files.report(_table(spark, sf_dir, "documents"))


def op8_decontaminate(spark, sf_dir):
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_packing(spark, sf_dir):
    return packing.pieces(_table(spark, sf_dir, "documents")).drop("ids")


def op10_url_cascade(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return url_cascade.judge(pages, url_cascade.insecure_hosts(pages))


def op11_hard_negatives(spark, sf_dir):
    """Anchors are the rows whose id is divisible by 100; rows whose id is divisible by 7 are relabelled first."""
    given = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    moved = F.when(F.col("vec_id") % 7 == 0, F.expr("pmod(label + 1, 10)")).otherwise(F.col("label"))
    return hard_negatives.mine(given.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_token_align(spark, sf_dir):
    return token_align.report(_table(spark, sf_dir, "documents"))


def op13_rank_queue_bpe(spark, sf_dir):
    return rank_queue_bpe.report(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality_divergence, op2_setsketch_dedup, op3_pii_crf, op4_kneser_ney, op5_html_crf, op6_chat_format, op7_token_files, op8_decontaminate,
                                   op9_packing, op10_url_cascade, op11_hard_negatives, op12_token_align, op13_rank_queue_bpe)}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SAFE = "replace({0}, chr(92), chr(92) || chr(92))"
for _c in chat_format.CONTROLS:
    _SAFE = f"replace({_SAFE}, '{_c}', '{_c[0]}' || chr(92) || '{_c[1:]}')"

ORACLE_SQL: dict[str, str] = {
    "op6_chat_format": f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
ordered AS (SELECT *, lag(role) OVER w AS previous, row_number() OVER w AS nr FROM given
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
sized AS (SELECT *, length({_SAFE.format('text')}) + CASE WHEN previous = role THEN 8
    ELSE 12 + length(replace({_SAFE.format('role')}, chr(10), chr(92) || chr(10))) + 1 + 11 END AS chars FROM ordered)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nr)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY nr) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op8_decontaminate": rf"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM benchmark),
bw AS (SELECT item, w, least(len(w), 13) AS k, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS gram FROM bw),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
ks AS (SELECT DISTINCT k FROM g),
p AS (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k),
h AS (SELECT rid, i, p.k, item FROM (SELECT rid, i, k, array_to_string(w[i : i + k - 1], ' ') AS gram FROM p) p JOIN g USING (gram)),
hw AS (SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS x FROM (SELECT DISTINCT rid, i, k FROM h)) GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)""",
    "op10_url_cascade": f"""
WITH p AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN {_LOWER.format("regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*')")} ELSE '' END AS host,
  CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM pages),
listed AS (SELECT host FROM p WHERE instr(url, '://') > 0 GROUP BY host HAVING NOT starts_with(arg_min(url, page_id), 'https://')),
r AS (SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
  WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
  WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END AS verdict FROM r""",
    "op11_hard_negatives": """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 5""",
}
