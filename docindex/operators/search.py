"""Reads and search.

Predicates are Spark ``Column``s, not a query DSL. Hits keep the doc_table
columns; ``_score`` is null for unscored queries (match_all, term, filters) and
a double for BM25 (see ``docindex.functions.scoring``).
"""

from __future__ import annotations

from dataclasses import dataclass, field as _field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docindex.functions.analyze import STANDARD_TOKEN, is_token, term_in_text
from docindex.functions.route import shard_of_value
from docindex.operators import pages
from docindex.operators.rank import global_rank

KEY = ["_index", "_id"]
# Default page size of the search call, and the only total relation an exact count has.
DEFAULT_SIZE = 20
TOP_K = 10_000  # pages that end within it are a per-task top-k; deeper ones are selected by key ranges
PUSHED_KEYS = 2_000  # ids of a request list that are pushed into the scan
RELATION_EQ = "eq"


def live(table: DataFrame) -> DataFrame:
    """Only live documents (tombstones are kept in the table for versioning)."""
    return table.where(~F.col("_deleted")) if "_deleted" in table.columns else table


# ---------------------------------------------------------------- R1 / R7
def get_doc(table: DataFrame, index: str, doc_id: str, routing: str | None = None,
            n_shards: int | None = None, fields: list[str] | None = None,
            source: bool = True) -> DataFrame:
    """One live document by key; an empty frame when absent (server: 404).

    The ``_index``/``_id`` equalities reach the Parquet scan as pushed filters; when
    the table carries ``shard`` and ``n_shards`` is given, the shard computed from
    ``routing`` (else the id) prunes the read to one partition directory.
    """
    cond = (F.col("_index") == F.lit(index)) & (F.col("_id") == F.lit(doc_id))
    if n_shards and "shard" in table.columns:
        cond = cond & (F.col("shard") == F.lit(shard_of_value(routing or doc_id, n_shards)))
    out = live(table).where(cond)
    return select_source(out, fields, source)


def body_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_") and c not in ("shard", "seq", "pos", "page", "rank")]


def select_source(df: DataFrame, fields: list[str] | None = None, source: bool = True) -> DataFrame:
    """Keep the listed body fields (dotted paths allowed), or drop the body."""
    meta = [c for c in df.columns if c.startswith("_") or c == "shard"]
    if not source:
        return df.select(*meta)
    if fields is None:
        return df
    picked = [F.col(f).alias(f) for f in fields]
    return df.select(*[F.col(c) for c in meta], *picked)


# ---------------------------------------------------------------- R2
def mget(table: DataFrame, keys: DataFrame, default_index: str | None = None, push: bool = False) -> DataFrame:
    """R2: one row per requested key, request order (``pos``) and duplicates kept.

    ``keys`` has ``pos, _index, _id``; a key without ``_index`` asks the request's
    ``default_index``. Missing keys come back with ``found=false``.
    The table is first reduced to the asked keys (a semi-join: Spark broadcasts the
    key list if it is small), then the matches are joined to the request list by
    key. Document bodies are only ever shuffled, and a key that is asked for many
    times is a skewed join key that AQE splits. With ``push`` the ids of a short list are filters of the scan as well.
    """
    docs = live(pushed(table, keys) if push else table)
    body = [c for c in docs.columns if c not in KEY]
    if default_index is not None:
        keys = keys.withColumn("_index", F.coalesce(F.col("_index"), F.lit(default_index)))
    matches = docs.join(keys.select(*KEY), KEY, "left_semi")
    joined = keys.join(matches.withColumn("_found", F.lit(True)), KEY, "left")
    return joined.select("pos", *KEY, F.coalesce(F.col("_found"), F.lit(False)).alias("found"),
                         *[F.col(c) for c in body])


def pushed(table: DataFrame, keys: DataFrame, limit: int = PUSHED_KEYS) -> DataFrame:
    """``table`` filtered to the ids of a short request list, in a form that reaches the Parquet scan.

    Up to ``limit`` distinct ids (read with that limit) become equalities that a scan holds against statistics, Bloom
    filters and page indexes; the ids are or-ed in groups of ten, the most that Spark pushes as a list, and the groups as a balanced
    tree. A longer list leaves the table as it is: ``mget`` joins it.
    """
    ids = [r[0] for r in keys.where(F.col("_id").isNotNull()).select("_id").distinct().limit(limit + 1).collect()]
    if len(ids) > limit:
        return table
    ids.sort()  # neighbours share row groups
    parts = [F.col("_id").isin(*ids[k: k + 10]) for k in range(0, len(ids), 10)] or [F.lit(False)]
    while len(parts) > 1:
        parts = [parts[k] | parts[k + 1] if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return table.where(parts[0])


# ---------------------------------------------------------------- R3 / R4
def match_all(table: DataFrame) -> DataFrame:
    """Every live document."""
    return live(table)


def term(table: DataFrame, field: str, value, text_fields: tuple[str, ...] = (),
         tokens: DataFrame | None = None) -> DataFrame:
    """Exact term. Keyword fields compare whole; text fields match a token.

    For a text field the standard analyzer's tokens are lower-cased letter/digit
    runs, so a document matches when such a run equals ``value``; a value that is
    not exactly one token matches nothing, on either path. With a
    prepared ``tokens`` table (T1 output) this is a semi-join on the token; without
    one it is the equivalent boundary-anchored pattern on the lower-cased text,
    which stays a pushed-down-friendly filter and needs no shuffle.
    """
    docs = live(table)
    if field not in text_fields:
        return docs.where(F.col(field) == F.lit(value))
    if not is_token(str(value)):
        return docs.where(F.lit(False))
    if tokens is not None:
        hits = tokens.where((F.col("field") == field) & (F.col("token") == F.lit(value))).select(*KEY).distinct()
        return docs.join(hits, KEY, "left_semi")
    return docs.where(term_in_text(F.col(field), str(value)))


# ---------------------------------------------------------------- R5 / R6 / R11
@dataclass
class SearchResult:
    hits: DataFrame       # the page
    total: DataFrame      # one row: value, relation
    matches: DataFrame    # every match, unpaged (for aggregations)
    aggregations: dict = _field(default_factory=dict)  # name -> buckets, over all matches

    def max_score(self) -> DataFrame:
        return with_max_score(self.matches)


def default_order(df: DataFrame) -> list:
    """(column, ascending) pairs: score, index, id."""
    return ([("_score", False)] if "_score" in df.columns else []) + [("_index", True), ("_id", True)]


def search(tables, query: Column | None = None, from_: int = 0, size: int = DEFAULT_SIZE,
           order: list | None = None, max_per_shard: int | None = None) -> SearchResult:
    """A page of hits plus the exact total (relation ``eq``).

    ``from_``/``size`` page through a total order (default: score, index, id), which
    Spark plans as ``TakeOrderedAndProject`` (a per-partition top-k, then a merge of
    at most ``from_+size`` rows per partition), never a full sort. A page that ends
    beyond ``TOP_K`` is selected by key ranges (``pages.deep_page``) if the order is
    given as names or (name, ascending) pairs, else cut by global rank: the same rows,
    without a large top-k in every task. There is no limit on ``from_ + size``.
    ``max_per_shard`` is the ``terminate_after`` argument (R8).
    """
    if from_ < 0 or size < 0:
        raise ValueError("from and size must not be negative")
    df = multi_index(tables) if isinstance(tables, (list, tuple)) else tables
    matches = live(df) if query is None else live(df).where(query)
    if max_per_shard is not None:
        matches = terminate_after(matches, max_per_shard)
    if "_score" not in matches.columns:
        matches = matches.withColumn("_score", F.lit(None).cast("double"))
    cols = [(c, True) if isinstance(c, str) else c for c in (order if order is not None else default_order(matches))]
    named = all(isinstance(c, tuple) for c in cols)
    named_cols, cols = cols, [pages.sort_columns([c])[0] if isinstance(c, tuple) else c for c in cols]
    if from_ + size > TOP_K and named:
        page = pages.deep_page(matches, named_cols, from_, size)
    elif from_ + size > TOP_K:
        ranked = global_rank(matches, cols, "_page_rank")
        page = ranked.where((F.col("_page_rank") > from_) & (F.col("_page_rank") <= from_ + size)).drop("_page_rank")
    else:
        page = matches.orderBy(*cols)
        page = (page.offset(from_) if from_ else page).limit(size)
    total = matches.agg(F.count(F.lit(1)).alias("value")).withColumn("relation", F.lit(RELATION_EQ))
    return SearchResult(page, total, matches)


def multi_index(tables) -> DataFrame:
    """Several indices searched as one; columns missing in one index become null."""
    tables = list(tables)
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def with_max_score(hits: DataFrame) -> DataFrame:
    """Max ``_score`` over all matches; null when nothing was scored."""
    score = F.col("_score") if "_score" in hits.columns else F.lit(None).cast("double")
    return hits.agg(F.max(score).alias("max_score"), F.count(F.lit(1)).alias("total"))


# ---------------------------------------------------------------- R8 / R9
def terminate_after(df: DataFrame, n: int, order: list | None = None) -> DataFrame:
    """At most ``n`` matches per shard, the first ``n`` by ``_id`` (deterministic).

    ``row_number() <= n`` over a per-shard window is planned with a
    ``WindowGroupLimit`` below the exchange, so each task forwards at most ``n``
    rows per shard.
    """
    part = ["_index", "shard"] if "shard" in df.columns else ["_index"]
    order = order or ["_id"]
    w = Window.partitionBy(*part).orderBy(*[F.col(c) if isinstance(c, str) else c for c in order])
    return df.withColumn("_ta_rn", F.row_number().over(w)).where(F.col("_ta_rn") <= n).drop("_ta_rn")


def scroll(df: DataFrame, size: int, order: list | None = None) -> DataFrame:
    """The full result set as numbered pages (``page`` from 0), every hit exactly once.

    The page number comes from the scalable global rank, so no page boundary
    needs a single-partition exchange. Consumers may write ``partitionBy("page")``
    or iterate with ``toLocalIterator``.
    """
    if size < 1:
        raise ValueError("size must be positive")
    order = order or ["_index", "_id"]
    ranked = global_rank(df, order, "rank")
    return ranked.withColumn("page", F.floor((F.col("rank") - 1) / size).cast("long"))


def iter_pages(numbered: DataFrame):
    """Consume a scroll result page by page on the driver, one page in memory at a time.

    ``numbered`` is the output of ``scroll``; it is range-partitioned by ``page`` so
    ``toLocalIterator`` fetches one partition after another, in page order.
    """
    current, rows = None, []
    for r in numbered.repartitionByRange("page").sortWithinPartitions("rank").toLocalIterator():
        if current is not None and r["page"] != current:
            yield current, rows
            rows = []
        current = r["page"]
        rows.append(r)
    if current is not None:
        yield current, rows


# ---------------------------------------------------------------- R12
def parent_child(parents: DataFrame, children: DataFrame, how: str = "inner",
                 parent_prefix: str = "parent_", parent_index: str | None = None) -> DataFrame:
    """Children with their parent's fields (``children._parent = parents._id``).

    A parent is known by index and id: ``parent_index``, or the child's own index.

    ``how``: ``inner`` (children with parent fields), ``has_child`` (parents with at
    least one child, a semi-join) or ``has_no_child`` (anti-join). When both sides
    are routed by the parent id they share shard numbers, so a join on
    ``(shard, _parent)`` is shuffle-free once both are bucketed on ``shard``. A
    parent with a very large share of the children is a skewed join key; AQE's
    skew-join handling splits that partition on the children side.
    """
    p = live(parents)
    c = live(children)
    of = F.lit(parent_index) if parent_index is not None else F.col("_index")
    if how in ("has_child", "has_no_child"):
        asked = c.where(F.col("_parent").isNotNull()).select(of.alias("_index"), F.col("_parent").alias("_id"))
        return p.join(asked, KEY, "left_semi" if how == "has_child" else "left_anti")
    c = c.withColumn("_p_index", of)
    pcols = [F.col(x).alias(parent_prefix + x.lstrip("_")) for x in p.columns
             if x not in ("_routing", "_parent", "_deleted", "_seq", "shard")]
    pp = p.select(*pcols)
    on = (c["_parent"] == pp[parent_prefix + "id"]) & (c["_p_index"] == pp[parent_prefix + "index"])
    return c.join(pp, on, how).drop("_p_index")


children_of = parent_child  # SURVEY name (R12)

__all__ = ["live", "get_doc", "children_of", "iter_pages", "select_source", "mget", "match_all", "term", "search",
           "SearchResult", "multi_index", "with_max_score", "terminate_after", "scroll",
           "parent_child", "STANDARD_TOKEN"]
