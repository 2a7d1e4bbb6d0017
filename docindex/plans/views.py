"""The fixture views of ``docindex.fixtures`` written as DuckDB SQL (CTE bodies)."""

DOCS = r"""docs AS (
  SELECT 'docs_' || lang AS _index, CAST(doc_id AS VARCHAR) AS _id, CAST(1 AS BIGINT) AS _version,
         source AS _routing, CAST(NULL AS VARCHAR) AS _parent, FALSE AS _deleted,
         CAST(doc_id AS BIGINT) AS _seq, text, lang, source, n_chars,
         CAST(CAST(('0x' || substr(md5(source), 1, 8)) AS BIGINT) % 4 AS INTEGER) AS shard
  FROM documents)"""

OPS = r"""ops AS (
  SELECT 'events' AS _index, CAST(user_id AS VARCHAR) AS _id,
         CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT) AS seq,
         CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete'
                         WHEN 'click' THEN 'update' ELSE 'index' END AS op,
         value, props
  FROM events)"""

CUT = "(SELECT count(*) // 2 FROM events)"

ORDERS = r"""orders_ix AS (
  SELECT 'orders' AS _index, CAST(o_orderkey AS VARCHAR) AS _id, CAST(1 AS BIGINT) AS _version,
         CAST(NULL AS VARCHAR) AS _routing, CAST(NULL AS VARCHAR) AS _parent, FALSE AS _deleted,
         CAST(o_orderkey AS BIGINT) AS _seq, o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         o_orderdate, o_orderpriority,
         CAST(CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 8 AS INTEGER) AS shard
  FROM orders)"""

LINES = r"""lines_ix AS (
  SELECT 'lineitems' AS _index, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS _id,
         CAST(1 AS BIGINT) AS _version, CAST(NULL AS VARCHAR) AS _routing,
         CAST(l_orderkey AS VARCHAR) AS _parent, FALSE AS _deleted,
         l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_returnflag, l_shipdate,
         CAST(CAST(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 8 AS INTEGER) AS shard
  FROM lineitem)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
