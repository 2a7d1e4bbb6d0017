"""Schema operations as data jobs.

A mapping is the reference's JSON mapping as a Python dict
(``{"properties": {"name": {"type": "keyword"}, ...}}``). It becomes a Spark
``StructType``; documents are cast by ``from_json`` in the executors, and values
that do not fit their declared type become rejects instead of failures.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed: field types of a mapping and the Spark type each one is stored as.
MAPPING_TYPES = {
    "keyword": T.StringType(), "text": T.StringType(), "string": T.StringType(),
    "long": T.LongType(), "integer": T.IntegerType(), "short": T.ShortType(), "byte": T.ByteType(),
    "double": T.DoubleType(), "float": T.FloatType(), "half_float": T.FloatType(), "scaled_float": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.StringType(), "binary": T.StringType(),
}
DEFAULT_DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"


# ---------------------------------------------------------------- mapping -> schema
def _field_type(spec: dict) -> T.DataType:
    if "properties" in spec and spec.get("type", "object") in ("object", "nested"):
        inner = mapping_schema(spec)
        return T.ArrayType(inner) if spec.get("type") == "nested" else inner
    t = spec.get("type", "object")
    if t not in MAPPING_TYPES:
        raise ValueError(f"unsupported field type {t!r}")
    return MAPPING_TYPES[t]


def mapping_schema(mapping: dict) -> T.StructType:
    """The ``properties`` of a mapping as a StructType (dates read as strings first)."""
    props = mapping.get("properties", {})
    return T.StructType([T.StructField(name, _field_type(spec)) for name, spec in props.items()])


def spark_date_patterns(formats: str) -> list[tuple[str, bool]]:
    """Spark datetime patterns for a mapping's date ``format``, one for each of its ``||`` alternatives.

    Spark cannot parse a weekday (``EEE``) or a week-based year (``YYYY``): the
    weekday prefix is dropped (and stripped from values), ``YYYY`` becomes ``yyyy``.
    Returns (pattern, strip_leading_weekday) pairs.
    """
    out = []
    for fmt in (f.strip() for f in formats.split("||")):
        strip = fmt.startswith("EEE ")
        out.append(((fmt[4:] if strip else fmt).replace("YYYY", "yyyy"), strip))
    return out


def _date_col(c: Column, spec: dict) -> Column:
    """The value under the first format that fits."""
    fits = []
    for pattern, strip in spark_date_patterns(spec.get("format") or DEFAULT_DATE_FORMAT):
        v = F.regexp_replace(c, r"^\S+\s+", "") if strip else c
        if pattern in ("epoch_millis", "epoch_second"):
            number = v.try_cast("long")
            fits.append(F.timestamp_millis(number) if pattern == "epoch_millis" else F.timestamp_seconds(number))
        else:
            fits.append(F.try_to_timestamp(v, F.lit(pattern)))
    return F.coalesce(*fits)


# ---------------------------------------------------------------- objects and nested fields
def _child(v: Column, name: str) -> Column:
    quote = '"' if "'" in name else "'"
    return F.try_variant_get(v, f"$[{quote}{name}{quote}]", "variant")


def _is_kind(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def _present(v: Column) -> Column:
    return F.coalesce(v.isNotNull() & ~F.is_variant_null(v), F.lit(False))


def _is_object(spec: dict) -> bool:
    return "properties" in spec and spec.get("type", "object") in ("object", "nested")


def _typed(v: Column, spec: dict) -> Column:
    """A variant as its declared type; what does not fit is null, objects are fitted field by field."""
    if not _is_object(spec):
        text = F.try_variant_get(v, "$", "string")
        return _date_col(text, spec) if spec.get("type") == "date" else text.try_cast(_field_type(spec))

    def whole(x):
        return F.when(_is_kind(x, "OBJECT"), F.struct(*[_typed(_child(x, n), s).alias(n) for n, s in spec["properties"].items()]))

    if spec.get("type") == "nested":
        return F.when(_is_kind(v, "ARRAY"), F.transform(v.try_cast("array<variant>"), whole)).when(_is_kind(v, "OBJECT"), F.array(whole(v)))
    return whole(v)


def _misfits(v: Column, spec: dict, path: str) -> Column:
    """Array of (field, value) of every value in a variant that is present but does not fit, at any depth.

    A field inside the elements of a nested array has the path without positions."""
    own = F.array(F.struct(F.lit(path).alias("field"), F.try_variant_get(v, "$", "string").alias("value")))
    none = own.cast("array<struct<field:string,value:string>>")
    empty = F.slice(none, 1, 0)
    if not _is_object(spec):
        return F.when(_present(v) & _typed(v, spec).isNull(), none).otherwise(empty)

    def inside(x):
        return F.concat(empty, *[_misfits(_child(x, n), s, f"{path}.{n}") for n, s in spec["properties"].items()])

    out = F.when(_is_kind(v, "OBJECT"), inside(v))
    if spec.get("type") == "nested":
        element = F.array(F.struct(F.lit(path).alias("field"), F.lit(None).cast("string").alias("value")))
        out = out.when(_is_kind(v, "ARRAY"), F.flatten(F.transform(v.try_cast("array<variant>"), lambda x: F.when(_is_kind(x, "OBJECT"), inside(x)).when(
            _present(x), F.transform(element, lambda e: e.withField("value", F.try_variant_get(x, "$", "string")))).otherwise(empty))))
    return out.when(_present(v), none).otherwise(empty)


@dataclass
class Mapped:
    rows: DataFrame      # typed documents (all rows; failed values are null)
    rejects: DataFrame   # keep cols + field + raw value of every value that did not fit


def apply_mapping(df: DataFrame, json_col: str, mapping: dict, keep: list[str] | None = None,
                  drop_source: bool = False) -> Mapped:
    """M1: cast JSON documents to the declared fields; misfits become rejects.

    Every top-level scalar field is read as its raw JSON text and cast to its declared
    type (``try_cast``; dates through the mapping's format). Objects and nested fields are
    walked as variants: their values are cast the same way, dates included, and
    every misfit is a reject under its dotted path, elements of arrays included. A
    value that is present but whose typed value is null did not fit; a body that
    is not a JSON object is a reject of field ``_source``, with the whole text. With
    ``drop_source`` (``_source.enabled: false``, M7) the JSON body is not kept.
    """
    keep = keep or []
    props = mapping.get("properties", {})
    st = mapping_schema(mapping)
    raw = T.StructType([T.StructField(n, T.StringType()) for n in props])
    body = F.try_parse_json(json_col)
    whole = F.coalesce(F.schema_of_variant(body).startswith("OBJECT"), F.lit(False))
    parsed = df.select(*keep, F.col(json_col).alias("_source"), whole.alias("_whole"), F.from_json(F.col(json_col), raw).alias("_r"), body.alias("_v"))
    objects = [n for n, spec in props.items() if _is_object(spec)]
    typed = []
    for name, spec in props.items():
        r = F.col(f"_r.`{name}`")
        if name in objects:
            c = _typed(_child(F.col("_v"), name), spec)
        elif spec.get("type") == "date":
            c = _date_col(r, spec)
        else:
            c = r.try_cast(st[name].dataType)
        typed.append(c.alias(name))
    staged = parsed.select(*keep, "_source", "_whole", "_v", *typed, *[F.col(f"_r.`{n}`").alias(f"_raw_{n}") for n in props if n not in objects])
    fields_out = [F.col(f"`{n}`") for n in props]
    rows = staged.select(*keep, *([] if drop_source else ["_source"]), *fields_out)
    bad = F.array_compact(F.array(*[
        F.when(F.col(f"`_raw_{n}`").isNotNull() & F.col(f"`{n}`").isNull(),
               F.struct(F.lit(n).alias("field"), F.col(f"`_raw_{n}`").alias("value"))) for n in props if n not in objects],
        F.when(F.col("_source").isNotNull() & ~F.col("_whole"), F.struct(F.lit("_source").alias("field"), F.col("_source").alias("value")))))
    if objects:
        bad = F.concat(bad, *[_misfits(_child(F.col("_v"), n), props[n], n) for n in objects])
    rejects = staged.select(*keep, F.explode(bad).alias("_b")).select(*keep, "_b.field", "_b.value")
    return Mapped(rows, rejects)


def drop_source(df: DataFrame, source_col: str = "_source") -> DataFrame:
    """M7: searchable fields stay, the body is not returned."""
    return df.drop(source_col)


# ---------------------------------------------------------------- M2
# Fixed: variant type names -> mapping type names used by the inventory.
_VARIANT_TO_MAPPING = [("BIGINT", "long"), ("INT", "long"), ("SMALLINT", "long"), ("TINYINT", "long"),
                  ("DECIMAL", "double"), ("DOUBLE", "double"), ("FLOAT", "double"), ("STRING", "text"),
                  ("BOOLEAN", "boolean"), ("OBJECT", "object"), ("ARRAY", "array"), ("DATE", "date"),
                  ("TIMESTAMP", "date")]


def _mapping_type(variant_type: Column) -> Column:
    e = F.lit("unknown")
    for prefix, name in reversed(_VARIANT_TO_MAPPING):
        e = F.when(variant_type.startswith(prefix), F.lit(name)).otherwise(e)
    return e


def infer_mapping(df: DataFrame, json_col: str) -> DataFrame:
    """M2: field inventory of schema-less JSON documents.

    Rows ``field, type, docs``: how many documents hold the field (a dotted path for fields inside objects, ``path[]``
    for the elements of an array; a dot, bracket or backslash in a name itself has a backslash before it) with that
    observed type, at any depth. Null values are not counted (dynamic
    mapping ignores them); texts that are not JSON objects are left to ``infer_rejects``.

    Walked level by level: a level's objects and arrays are exploded once, counted by (field, type) with partial
    aggregation, and only the objects and arrays among them are written for the next level, until none is left.
    """
    from docindex.operators.rank import materialize

    body = F.try_parse_json(json_col)
    level = df.select(F.monotonically_increasing_id().alias("doc"), F.lit("").alias("path"), F.lit(False).alias("many"), body.alias("v"))
    level = level.where(F.schema_of_variant("v").startswith("OBJECT"))
    level = materialize(level, "infer")  # documents are numbered once
    counts = None
    while not level.isEmpty():
        kind = F.schema_of_variant("v")
        objects = (level.where(kind.startswith("OBJECT"))
                   .select("doc", "path", "many", F.explode(F.col("v").cast("map<string,variant>")).alias("key", "v"))
                   .withColumn("key", F.regexp_replace("key", r"([.\[\]\\])", r"\\$1"))
                   .select("doc", F.when(F.col("path") == "", F.col("key")).otherwise(F.concat_ws(".", "path", "key")).alias("path"), "many", "v"))
        arrays = (level.where(kind.startswith("ARRAY"))
                  .select("doc", F.concat("path", F.lit("[]")).alias("path"), F.lit(True).alias("many"), F.explode(F.col("v").cast("array<variant>")).alias("v")))
        found = objects.unionByName(arrays).where(F.col("v").isNotNull() & ~F.is_variant_null("v"))
        typed = found.select("doc", "many", F.col("path").alias("field"), _mapping_type(kind).alias("type"))
        # Below an array a document can hold a field several times; elsewhere once.
        once = typed.where(~F.col("many")).select("field", "type").unionAll(typed.where("many").select("doc", "field", "type").distinct().select("field", "type"))
        here = materialize(once.groupBy("field", "type").agg(F.count(F.lit(1)).alias("docs")), "infer-counts")
        counts = here if counts is None else counts.unionByName(here)
        level = materialize(found.where(kind.startswith("OBJECT") | kind.startswith("ARRAY")), "infer")
    if counts is None:
        return df.sparkSession.createDataFrame([], "field string, type string, docs long")
    return counts


def infer_rejects(df: DataFrame, json_col: str, keep: list[str] | None = None) -> DataFrame:
    """M2: the texts that are not JSON objects, with the ``keep`` columns."""
    whole = F.coalesce(F.schema_of_variant(F.try_parse_json(json_col)).startswith("OBJECT"), F.lit(False))
    return df.where(F.col(json_col).isNotNull() & ~whole).select(*(keep or []), F.col(json_col).alias("value"))


# ---------------------------------------------------------------- M3
@dataclass
class MappingChange:
    report: list[tuple[str, str | None, str | None, str]]  # field, old type, new type, status
    schema: T.StructType
    accepted: bool

    def report_df(self, spark) -> DataFrame:
        return spark.createDataFrame(self.report, "field string, old_type string, new_type string, status string")


def _merge(old: T.StructType, new: T.StructType, take_new: bool, path: str, report: list) -> T.StructType:
    """Fields of both; objects are merged field by field. Appends (path, old type, new type, status) rows."""
    new_f = {f.name: f.dataType for f in new.fields}
    fields = []
    for f in old.fields:
        name, kind = path + f.name, new_f.get(f.name)
        if isinstance(f.dataType, T.StructType) and isinstance(kind, T.StructType) and kind != f.dataType:
            fields.append(T.StructField(f.name, _merge(f.dataType, kind, take_new, name + ".", report)))
        elif kind is not None and kind != f.dataType:
            report.append((name, f.dataType.simpleString(), kind.simpleString(), "conflict"))
            fields.append(T.StructField(f.name, kind if take_new else f.dataType))
        else:
            report.append((name, f.dataType.simpleString(), kind.simpleString() if kind is not None else None, "kept"))
            fields.append(T.StructField(f.name, f.dataType))
    known = {f.name for f in old.fields}
    for f in new.fields:
        if f.name not in known:
            report.append((path + f.name, None, f.dataType.simpleString(), "added"))
            fields.append(T.StructField(f.name, f.dataType))
    return T.StructType(fields)


def evolve_mapping(old: T.StructType, new: T.StructType, update_all_types: bool = False) -> MappingChange:
    """M3: add new fields, keep old ones; a changed type is a conflict.

    Fields of objects are merged one by one (``u.b`` is added to ``u``; ``u.a`` stays). Without ``update_all_types`` a
    conflict refuses the change (the old schema stays, as a refused put-mapping call); with it the new type is
    taken. This compares two schemas (metadata), not data.
    """
    report: list = []
    schema = _merge(old, new, update_all_types, "", report)
    accepted = update_all_types or not any(r[3] == "conflict" for r in report)
    if accepted:
        report = [(f, o, n, "changed" if s == "conflict" else s) for f, o, n, s in report]
    else:
        report = [(f, o, n, "refused" if s == "added" else s) for f, o, n, s in report]
    # Added fields come last, as they did not exist before.
    report = [r for r in report if r[1] is not None] + [r for r in report if r[1] is None]
    return MappingChange(report, schema if accepted else T.StructType([T.StructField(f.name, f.dataType) for f in old.fields]), accepted)


def _fitted(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """``c`` as the wanted type: objects field by field, missing fields null, others ``try_cast``."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        kinds = {f.name: f.dataType for f in have.fields}
        inner = [(_fitted(c.getField(f.name), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*inner))
    return c if have == want else c.try_cast(want)


def rewrite_to(df: DataFrame, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """Project a frame onto ``schema``: missing fields null, others ``try_cast`` (misfits: ``rewrite_rejects``)."""
    keep = keep or []
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = [F.col(k) for k in keep]
    for f in schema.fields:
        if f.name not in keep:
            out.append((_fitted(F.col(f.name), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name))
    return df.select(*out)


def rewrite_rejects(df: DataFrame, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """Values that ``rewrite_to`` makes null as they do not cast: ``keep`` columns, dotted field, value as text."""
    keep = keep or []

    def misfits(c, have, want, path):
        if isinstance(have, T.StructType) and isinstance(want, T.StructType):
            kinds = {f.name: f.dataType for f in have.fields}
            return [m for f in want.fields if f.name in kinds for m in misfits(c.getField(f.name), kinds[f.name], f.dataType, path + f.name + ".")]
        if have == want:
            return []
        return [F.when(c.isNotNull() & c.try_cast(want).isNull(), F.struct(F.lit(path[:-1]).alias("field"), c.cast("string").alias("value")))]

    kinds = {f.name: f.dataType for f in df.schema.fields}
    found = [m for f in schema.fields if f.name in kinds and f.name not in keep for m in misfits(F.col(f.name), kinds[f.name], f.dataType, f.name + ".")]
    if not found:
        return df.where(F.lit(False)).select(*keep, F.lit("").alias("field"), F.lit("").alias("value"))
    return df.select(*keep, F.explode(F.array_compact(F.array(*found))).alias("_b")).select(*keep, "_b.field", "_b.value")


def evolve_data(old_df: DataFrame, new_df: DataFrame, change: MappingChange, keep: list[str]) -> DataFrame:
    """Both generations of documents under the resulting schema (``unionByName``)."""
    return rewrite_to(old_df, change.schema, keep).unionByName(rewrite_to(new_df, change.schema, keep))


# ---------------------------------------------------------------- M4
def field_inventory(table: DataFrame, index_col: str = "_index") -> DataFrame:
    """M4: per (index, field): type, live docs and non-null count.

    One grouped aggregate with a ``count(col)`` per body column (partial
    aggregation), then ``stack`` turns the wide row into one row per field.
    """
    live = table.where(~F.col("_deleted")) if "_deleted" in table.columns else table
    body = [f for f in live.schema.fields if not f.name.startswith("_") and f.name != "shard"]
    wide = live.groupBy(index_col).agg(F.count(F.lit(1)).alias("_docs"),
                                       *[F.count(F.col(f.name)).alias(f"_nn{i}") for i, f in enumerate(body)])
    pieces = [x for i, f in enumerate(body) for x in (F.lit(f.name), F.lit(f.dataType.simpleString()), F.col(f"_nn{i}"))]
    return wide.select(index_col, "_docs", F.stack(F.lit(len(body)), *pieces).alias("field", "type", "non_null")) \
        .select(F.col(index_col).alias("_index"), "field", "type", F.col("_docs").alias("docs"), "non_null")


# ---------------------------------------------------------------- M5
def glob_regex(pattern: str) -> str:
    """An index-name glob (``*`` wildcard) as an anchored regex."""
    return "^" + ".*".join(re.escape(p) for p in pattern.split("*")) + "$"


def index_matches(pattern: str, index: str) -> bool:
    """Whether an index name fits a template's pattern."""
    return bool(re.match(glob_regex(pattern), index))


def apply_templates(docs: DataFrame, templates: list[dict], index_col: str = "_index") -> DataFrame:
    """M5: tag each document with the template whose pattern matches its index.

    ``templates``: ``[{"name", "index_patterns": [...], "order", ...}]`` (a call
    argument, a handful of entries). Every template becomes a literal in one
    per-row expression, so no join is needed; the highest ``order`` wins, then
    the name. Adds ``_template`` and ``_template_order`` (null when none match).
    """
    if not templates:
        return docs.withColumn("_template", F.lit(None).cast("string")).withColumn(
            "_template_order", F.lit(None).cast("int"))
    cands = []
    for t in templates:
        pats = t.get("index_patterns") or [t["template"]]
        hit = F.lit(False)
        for p in pats:
            hit = hit | F.col(index_col).rlike(glob_regex(p))
        cands.append(F.when(hit, F.struct(F.lit(int(t.get("order", 0))).alias("order"),
                                          F.lit(t["name"]).alias("name"))))
    best = F.array_max(F.array_compact(F.array(*cands)))
    return docs.withColumn("_tpl", best).withColumn("_template", F.col("_tpl.name")) \
        .withColumn("_template_order", F.col("_tpl.order")).drop("_tpl")


def merge_mappings(old: dict | None, new: dict, update_all_types: bool = False) -> dict:
    """Fields of both mappings; an object's fields one by one; a field with another type is refused, or taken over
    with ``update_all_types``."""
    out = {**(old or {}), **{k: v for k, v in new.items() if k != "properties"}}
    props = dict((old or {}).get("properties", {}))
    for name, spec in new.get("properties", {}).items():
        have = props.get(name)
        if have and "properties" in have and "properties" in spec:
            props[name] = merge_mappings(have, spec, update_all_types)
        elif have and have.get("type", "object") != spec.get("type", "object") and not update_all_types:
            raise ValueError(f"field {name} is mapped as {have.get('type', 'object')}")
        else:
            props[name] = {**(have or {}), **spec}
    out["properties"] = props
    return out


def template_mapping(templates: list[dict], index: str) -> dict:
    """The mapping of an index by the templates whose pattern fits its name: merged from the lowest ``order`` on, then by
    name, so that a field of a higher order wins."""
    out: dict = {"properties": {}}
    for t in sorted(templates, key=lambda t: (int(t.get("order", 0)), t.get("name", ""))):
        if any(index_matches(p, index) for p in t.get("index_patterns") or [t["template"]]):
            out = merge_mappings(out, t.get("mappings", {}), update_all_types=True)
    return out


def apply_template_mappings(docs: DataFrame, json_col: str, templates: list[dict], keep: list[str] | None = None, index_col: str = "_index") -> Mapped:
    """M5: each document cast by the merged mapping of its index (``template_mapping``), misfits as in M1.

    The index names (a catalog, one row each) are read first; indices of one mapping are one branch, a filter on the
    index, and the branches' columns are brought together by name. Where two mappings type a field differently, its
    column is text.
    """
    keep = keep or []
    names = [r[0] for r in docs.select(index_col).distinct().collect() if r[0] is not None]
    groups: dict = {}
    for name in sorted(names):
        mapping = template_mapping(templates, name)
        groups.setdefault(repr(mapping), (mapping, []))[1].append(name)
    mapped = [(m, apply_mapping(docs.where(F.col(index_col).isin(own)), json_col, m, [*keep, index_col], drop_source=not m.get("_source", {}).get("enabled", True)))
              for m, own in groups.values()]
    if not mapped:
        empty = apply_mapping(docs, json_col, {"properties": {}}, [*keep, index_col])
        return Mapped(empty.rows, empty.rejects)
    kinds: dict = {}
    for _, x in mapped:
        for f in x.rows.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType)
    as_text = {n for n, k in kinds.items() if len(k) > 1}
    rows = [x.rows.select(*[F.col(f"`{c}`").cast("string").alias(c) if c in as_text else F.col(f"`{c}`") for c in x.rows.columns]) for _, x in mapped]
    out, rejects = rows[0], mapped[0][1].rejects
    for r, (_, x) in zip(rows[1:], mapped[1:]):
        out, rejects = out.unionByName(r, allowMissingColumns=True), rejects.unionByName(x.rejects)
    return Mapped(out, rejects)


# ---------------------------------------------------------------- M6

def alias_table(actions: DataFrame) -> DataFrame:
    """Live (index, alias) pairs: the last action per pair (by ``seq``) is an add."""
    w = Window.partitionBy("index", "alias").orderBy(F.col("seq").desc())
    last = actions.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return last.where(F.col("action") == "add").select("index", "alias")


def expand_aliases(docs: DataFrame, actions: DataFrame, index_col: str = "_index") -> DataFrame:
    """M6: documents reachable through alias names, tagged ``_alias``.

    ``actions``: ``seq, action (add|remove), index, alias``. The alias table has
    at most one row per (index, alias); Spark broadcasts it if it is small.
    """
    right = alias_table(actions).withColumnRenamed("index", index_col).withColumnRenamed("alias", "_alias")
    return docs.join(right, index_col, "inner")
