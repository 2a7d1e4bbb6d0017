"""An index handle over the store: the per-index calls of the reference, as Spark jobs.

``Index(spark, root, name)`` names one index inside a store folder, an alias, or (for reads) a list of both. Every call
is a composition of the library's operators over the store's documents; writes rewrite only the shards they touch.
Search sees the state of the last ``refresh``, while ``get`` reads the latest commit, matching the reference's refresh
semantics (R13).

Writes keep the rows that they replace until the next ``refresh``; a search leaves the written keys out and takes those
rows instead. A handle that is opened later sees all commits.

Write frames may carry ``routing``, ``parent`` and, with ``version_type``, ``version`` columns. Mappings, templates and
aliases live in the store's settings: an index without a mapping of its own takes the merged mappings of the templates
that match its name, lowest ``order`` first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docindex.functions.analyze import analyze
from docindex.functions.scoring import match_query
from docindex.operators import aggs, mapping, rank, search, write
from docindex.session import scratch_path
from docindex.sources import store

VERSION_TYPES = {
    "internal": lambda table, ops: write.write_internal(table, ops),
    "external": lambda table, ops: write.write_external(table, ops),
    "external_gte": lambda table, ops: write.write_external(table, ops, gte=True),
    "force": lambda table, ops: write.write_force(table, ops),
}


@dataclass
class BulkResponses:
    items: DataFrame      # one row per op, with batch_no
    responses: DataFrame  # one row per batch: items, failed, errors


def bulk_batches(items: DataFrame, batch_size: int) -> BulkResponses:
    """Group item results into bulk responses of ``batch_size`` ops (last one short)."""
    numbered = rank.batch_numbers(items, "seq", batch_size)
    return BulkResponses(numbered, write.bulk_batch_summary(numbered))


class Index:
    """One index of a store (or several, for reads): ``root`` is a folder every executor can reach."""

    def __init__(self, spark: SparkSession, root: str, name: str | list[str], n_shards: int | None = None):
        self.spark, self.root, self.name = spark, root, name
        self._given_shards = n_shards or store.DEFAULT_SHARDS
        self._undo: list[str] = []  # what this handle's writes replaced since the last refresh, oldest first

    @property
    def n_shards(self) -> int:
        """The store's own shard count; the given one counts for a new store only."""
        return store.shard_count(self.spark, self.root, self._given_shards)

    def indices(self) -> list[str]:
        """The named indices, aliases resolved."""
        aliases = store.settings(self.spark, self.root, "aliases")
        out: dict = {}
        for name in [self.name] if isinstance(self.name, str) else self.name:
            out.update(dict.fromkeys(aliases.get(name, [name])))
        return list(out)

    def _one(self) -> str:
        found = self.indices()
        if len(found) != 1:
            raise ValueError(f"a write names one index, not {found}")
        return found[0]

    # -- reads ---------------------------------------------------------------
    def _table(self) -> DataFrame:
        return store.read_index(self.spark, self.root, self.indices())

    def _searchable(self) -> DataFrame:
        """The documents as of the last refresh: the current ones, but the keys written since as they were before."""
        table = self._table()
        if not self._undo:
            return table
        old = None
        for nr, path in enumerate(self._undo):
            rows = self.spark.read.parquet(path).withColumn("_nr", F.lit(nr))
            old = rows if old is None else old.unionByName(rows, allowMissingColumns=True)
        body = [c for c in old.columns if c not in ("_index", "_id", "_nr")]
        old = old.groupBy("_index", "_id").agg(F.min_by(F.struct(*body), "_nr").alias("_old"))
        kept = table.join(old.select("_index", "_id"), ["_index", "_id"], "left_anti")
        was = old.where("_old._version IS NOT NULL").select("_index", "_id", "_old.*")
        return kept.unionByName(was.where(F.col("_index").isin(*self.indices())), allowMissingColumns=True)

    def get(self, doc_id: str, routing: str | None = None, fields: list[str] | None = None,
            source: bool = True) -> DataFrame:
        """The live document; only its shard's folder is read when routing or the id tells it."""
        index, table = self._one(), self._table()
        routed = {"_routing", "_parent"} & set(table.columns)
        shards = self.n_shards if routing is not None or not routed else None
        return search.get_doc(table, index, doc_id, routing, shards, fields, source)

    def mget(self, keys: DataFrame) -> DataFrame:
        found = self.indices()
        return search.mget(self._table(), keys, default_index=found[0] if len(found) == 1 else None, push=True)

    def search(self, query: Column | None = None, from_: int = 0, size: int = search.DEFAULT_SIZE,
               order: list | None = None, match: tuple[str, str] | None = None, search_type: str = "query_then_fetch",
               terminate_after: int | None = None, aggregations: dict | None = None) -> search.SearchResult:
        """``match`` = (field, text) scores by BM25, the text analysed by the field's ``search_analyzer``;
        ``aggregations`` = {name: terms_agg arguments} over all matches."""
        table = self._searchable()
        if match:
            spec = self._field(match[0])
            table = match_query(search.live(table), *match, spec.get("search_analyzer", spec.get("analyzer", "standard")), search_type=search_type)
        out = search.search(table, query, from_, size, order, terminate_after)
        out.aggregations = {name: aggs.terms_agg(out.matches, **args) for name, args in (aggregations or {}).items()}
        return out

    def scroll(self, query: Column | None = None, size: int = 10) -> DataFrame:
        t = search.live(self._searchable())
        return search.scroll(t if query is None else t.where(query), size)

    def analyze(self, field: str, analyzer: str = "standard") -> DataFrame:
        return analyze(search.live(self._table()), field, analyzer)

    # -- writes --------------------------------------------------------------
    def _ops(self, df: DataFrame, op: str | None) -> DataFrame:
        out = write.default_index_of(df, self._one())
        return out.withColumn("op", F.lit(op)) if op else out

    def bulk(self, ops: DataFrame, batch_size: int | None = None, refresh: bool = False, version_type: str | None = None):
        """Apply an ops log; returns item results (and per-batch responses with ``batch_size``).

        With ``version_type`` the ops' ``version`` decides (W6); their ``op`` says what they do all the same.
        """
        return self._commit(self._ops(ops, None), VERSION_TYPES[version_type] if version_type else None, refresh, batch_size)

    def _commit(self, ops: DataFrame, apply, refresh: bool, batch_size: int | None = None):
        undo = None if refresh else scratch_path(self.spark, "undo")
        items = store.commit_replay(self.spark, self.root, ops, self._given_shards, apply=apply, undo=undo)
        if refresh:
            self.refresh()
        else:
            self._undo.append(undo)
        return bulk_batches(items, batch_size) if batch_size else items

    def index(self, docs: DataFrame, create: bool = False, refresh: bool = False, version_type: str | None = None) -> DataFrame:
        """Index (or create) documents; with ``version_type`` their ``version`` decides."""
        return self.bulk(self._ops(docs, "create" if create else "index"), refresh=refresh, version_type=version_type)

    def update(self, docs: DataFrame, refresh: bool = False, version_type: str | None = None, detect_noop: bool = False) -> DataFrame:
        """Merge partial documents. A ``version`` column makes it a compare-and-set (``internal``, the only type that
        updates know); ``detect_noop`` leaves documents alone that hold the values already (W4)."""
        if detect_noop:
            if version_type:
                raise ValueError("a versioned update writes always")
            return self._commit(self._ops(docs, "update"), lambda table, ops: write.update_docs(table, ops.drop("op"), detect_noop=True), refresh)
        return self.bulk(self._ops(docs, "update"), refresh=refresh, version_type=version_type or ("internal" if "version" in docs.columns else None))

    def delete(self, ids: DataFrame, refresh: bool = False, version_type: str | None = None) -> DataFrame:
        return self.bulk(self._ops(ids, "delete"), refresh=refresh, version_type=version_type)

    def index_json(self, docs: DataFrame, json_col: str, refresh: bool = False):
        """Index JSON bodies under the index's mapping; returns (items, rejects of values that do not fit)."""
        found = self.mapping()
        keep = [c for c in docs.columns if c != json_col]
        enabled = found.get("_source", {}).get("enabled", True)
        mapped = mapping.apply_mapping(docs, json_col, found, keep, drop_source=not enabled)
        rows = mapped.rows.withColumnRenamed("_source", "_body") if enabled else mapped.rows
        return self.index(rows, refresh=refresh), mapped.rejects

    def refresh(self) -> None:
        """Make every committed write visible to search."""
        self._undo = []

    # -- mappings, templates, aliases -------------------------------------------
    def mappings(self) -> dict:
        """{index: mapping} of every named index."""
        own = store.settings(self.spark, self.root, "mappings")
        templates = store.settings(self.spark, self.root, "templates")
        named = [{**t, "name": n} for n, t in templates.items()]
        return {name: own.get(name) or mapping.template_mapping(named, name) for name in self.indices()}

    def mapping(self) -> dict:
        """The index's own mapping, else the templates' that match its name, merged by ascending order."""
        return self.mappings()[self._one()]

    def _field(self, name: str) -> dict:
        """A field's mapping: the first one among the named indices."""
        return next((m["properties"][name] for m in self.mappings().values() if name in m.get("properties", {})), {})

    def put_mapping(self, new: dict, update_all_types: bool = False) -> dict:
        """Add fields to the index's mapping. A changed type is refused; with ``update_all_types`` it is taken, and the
        documents of the store are rewritten to it (values that do not fit become null)."""
        name, base = self._one(), self.mapping()
        store.put_setting(self.spark, self.root, "mappings", name, lambda old: mapping.merge_mappings(old or base, new, update_all_types), self._given_shards)
        if update_all_types and store.exists(self.spark, self.root):
            table = store.read_index(self.spark, self.root)
            wanted = {f.name: f.dataType for f in mapping.mapping_schema(new).fields}
            changed = [f for f in table.schema.fields if f.name in wanted and f.dataType != wanted[f.name]]
            if changed:
                schema = T.StructType([T.StructField(f.name, wanted.get(f.name, f.dataType)) for f in table.schema.fields])
                store.write_index(rank.materialize(mapping.rewrite_to(table, schema), "rewritten"), self.root)
        return self.mapping()

    def put_template(self, name: str, template: dict | None) -> None:
        """Store a template (``index_patterns`` or ``template``, ``order``, ``mappings``); None removes it."""
        store.put_setting(self.spark, self.root, "templates", name, lambda _old: template, self._given_shards)

    def put_alias(self, alias: str, remove: bool = False) -> None:
        """Add this index to an alias, or take it out."""
        name = self._one()
        store.put_setting(self.spark, self.root, "aliases", alias, lambda old: (
            [x for x in old or [] if x != name] + ([] if remove else [name])) or None, self._given_shards)

    # -- maintenance -----------------------------------------------------------
    def stats(self) -> DataFrame:
        return store.index_stats(self._table())

    def force_merge(self, max_files: int | None = None, only_expunge_deletes: bool = False) -> None:
        store.compact(self.spark, self.root, max_files, only_expunge_deletes)
