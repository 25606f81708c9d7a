"""The registered queries as SQL over the same tables.

Every statement starts from the test tables as one union of vertices (`v`) and one of
edges (`e`), with NULL for the properties a concept or label lacks.
"""

from __future__ import annotations

# Properties and their SQL types.
VERTEX_PROPERTIES = {
    "name": "VARCHAR", "balance": "DOUBLE", "segment": "VARCHAR", "status": "VARCHAR",
    "price": "DOUBLE", "odate": "TIMESTAMP", "priority": "VARCHAR", "brand": "VARCHAR",
    "ptype": "VARCHAR", "size": "INTEGER", "text": "VARCHAR", "lang": "VARCHAR",
    "source": "VARCHAR", "n_chars": "BIGINT",
}
EDGE_PROPERTIES = {"odate": "TIMESTAMP", "quantity": "DOUBLE", "lines": "BIGINT"}
SPARK_NAMES = {"VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp", "INTEGER": "int", "BIGINT": "bigint"}
CATALOG_NAMES = {"VARCHAR": "STRING", "DOUBLE": "DOUBLE", "TIMESTAMP": "LOCAL_DATETIME", "INTEGER": "INTEGER", "BIGINT": "LONG"}


def _branch(table: str, key: str, head: str, properties: dict[str, str], **columns: str) -> str:
    values = [
        f"{columns[name]} AS {name}" if name in columns else f"CAST(NULL AS {kind}) AS {name}"
        for name, kind in properties.items()
    ]
    return f"SELECT CAST({key} AS BIGINT) AS k, {head}, {', '.join(values)} FROM {table}"


def _vertex(table: str, concept: str, prefix: str, key: str, **columns: str) -> str:
    head = f"'{prefix}' || {key} AS _id, '{concept}' AS _conceptType"
    return _branch(table, key, head, VERTEX_PROPERTIES, **columns)


def _edge(table: str, label: str, own: str, source: str, target: str, key: str, **columns: str) -> str:
    head = f"{own} AS _id, '{label}' AS _edgeLabel, {source} AS _sid, {target} AS _did"
    return _branch(table, key, head, EDGE_PROPERTIES, **columns)


CUSTOMER = _vertex("customer", "customer", "c", "c_custkey", name="c_name", balance="c_acctbal", segment="c_mktsegment")
ORDER = _vertex("orders", "order", "o", "o_orderkey", status="o_orderstatus", price="o_totalprice",
                odate="o_orderdate", priority="o_orderpriority")
PART = _vertex("part", "part", "p", "p_partkey", name="p_name", brand="p_brand", ptype="p_type",
               size="p_size", price="p_retailprice")
SUPPLIER = _vertex("supplier", "supplier", "s", "s_suppkey", name="s_name", balance="s_acctbal")
NATION = _vertex("nation", "nation", "n", "n_nationkey", name="n_name")
REGION = _vertex("region", "region", "r", "r_regionkey", name="r_name")
DOCUMENT = _vertex("documents", "document", "d", "doc_id", text="text", lang="lang", source="source", n_chars="n_chars")
USER = _vertex("(SELECT DISTINCT user_id FROM events)", "user", "u", "user_id")

PLACED = _edge("orders", "placed", "'placed:' || o_orderkey", "'c' || o_custkey", "'o' || o_orderkey",
               "o_orderkey", odate="o_orderdate")
CUSTOMER_NATION = _edge("customer", "in_nation", "'in_nation:c' || c_custkey", "'c' || c_custkey",
                        "'n' || c_nationkey", "c_custkey")
SUPPLIER_NATION = _edge("supplier", "in_nation", "'in_nation:s' || s_suppkey", "'s' || s_suppkey",
                        "'n' || s_nationkey", "s_suppkey")
NATION_REGION = _edge("nation", "in_region", "'in_region:' || n_nationkey", "'n' || n_nationkey",
                      "'r' || n_regionkey", "n_nationkey")
CONTAINS = _edge(
    "(SELECT l_orderkey, l_partkey, sum(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey)",
    "contains", "'contains:' || l_orderkey || ':' || l_partkey", "'o' || l_orderkey", "'p' || l_partkey",
    "l_orderkey", quantity="q", lines="n",
)

_V = " UNION ALL ".join([CUSTOMER, ORDER, PART, SUPPLIER, NATION, REGION, DOCUMENT, USER])
_E = " UNION ALL ".join([PLACED, CUSTOMER_NATION, SUPPLIER_NATION, NATION_REGION, CONTAINS])
WITH = f"WITH v AS ({_V}), e AS ({_E})"

ORACLES: dict[str, str] = {}


def oracle(name: str, statement: str, more: str = "") -> None:
    """Register a statement over `v` and `e`, and over further named subqueries if given."""
    ORACLES[name] = f"{WITH}{', ' + more if more else ''} {statement}"


V = "_id, _conceptType, name, balance, price"
E = "_id, _edgeLabel, _sid, _did, odate, quantity, lines"

# ---- scans

for scan in ("vertex_scan", "scan_shard", "scan_shard_by_id", "scan_range", "fetch_properties", "fetch_hidden"):
    oracle(scan, f"SELECT {V} FROM v")
oracle("edge_scan", f"SELECT {E} FROM e")


def _schema_rows(frame: str, reserved: tuple[str, ...], properties: dict[str, str]) -> str:
    names = [*reserved, *sorted(properties, reverse=True)]
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{n}' AS name, '{SPARK_NAMES[properties.get(n, 'VARCHAR')]}' AS type, "
        f"count({n}) AS n_values FROM {frame}"
        for i, n in enumerate(names)
    )


_ALL = {**VERTEX_PROPERTIES, **EDGE_PROPERTIES}
_V_ALL = "va AS (SELECT *, CAST(NULL AS DOUBLE) AS quantity, CAST(NULL AS BIGINT) AS lines FROM v)"
_E_ALL = "ea AS (SELECT *, " + ", ".join(
    f"CAST(NULL AS {k}) AS {n}" for n, k in VERTEX_PROPERTIES.items() if n not in EDGE_PROPERTIES
) + " FROM e)"
oracle("element_schema_vertices", _schema_rows("va", ("_conceptType", "_id"), _ALL), _V_ALL)
oracle("element_schema_edges", _schema_rows("ea", ("_did", "_sid", "_edgeLabel", "_id"), _ALL), _E_ALL)

_ABSENT = ("name", "balance", "segment", "status", "price", "odate", "size", "text", "n_chars")
oracle(
    "heterogeneous_union",
    "SELECT _conceptType, count(*) AS n, "
    + ", ".join(f"count(*) - count({c}) AS no_{c}" for c in _ABSENT) + " FROM v GROUP BY _conceptType",
)
oracle("fetch_edge_refs",
       "SELECT _id, _edgeLabel, _sid, _did, CAST(NULL AS TIMESTAMP) AS odate, "
       "CAST(NULL AS DOUBLE) AS quantity, CAST(NULL AS BIGINT) AS lines FROM e")
oracle("visible_elements", f"SELECT {V} FROM v WHERE k % 3 IN (0, 1) AND k % 10 <> 0")
oracle("visible_edges", f"SELECT {E} FROM e WHERE k % 3 = 0 AND k % 10 <> 0")
oracle("user_schema", "SELECT CAST(size AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS nickname, name, _id FROM v")

# ---- predicates: name -> (frame, condition, columns)

PREDICATES = {
    "f_and": ("v", "balance >= 1000 AND balance <= 5000", "balance"),
    "f_or": ("v", "size = 43 OR size = 39 OR size = 99", "size"),
    "f_not": ("v", "NOT segment = 'BUILDING'", "segment"),
    "f_not_date": ("v", "NOT CAST(odate AS DATE) = DATE '1999-02-02'", "odate"),
    "f_ne": ("v", "status <> 'F'", "status"),
    "f_is_null": ("v", "name IS NULL", "name"),
    "f_is_not_null": ("v", "balance IS NOT NULL", "balance"),
    "f_eq_null_safe": ("v", "segment IS NOT DISTINCT FROM 'MACHINERY'", "segment"),
    "f_eq_null_safe_null": ("v", "price IS NOT DISTINCT FROM NULL", "price"),
    "f_id": ("v", "_id = 'c42'", "_conceptType, name"),
    "f_concept": ("v", "_conceptType = 'customer'", "_conceptType, name"),
    "f_label": ("e", "_edgeLabel = 'placed'", "_edgeLabel, _sid"),
    "f_source_id": ("e", "_sid = 'c42'", "_edgeLabel, _sid, _did"),
    "f_concept_and_prop": ("v", "_conceptType = 'customer' AND balance > 10", "_conceptType, balance"),
    "f_eq_string": ("v", "name = 'small ring'", "name"),
    "f_eq_number": ("v", "size = 20", "size"),
    "f_eq_date": ("v", "CAST(odate AS DATE) = DATE '1999-02-02'", "odate"),
    "f_eq_timestamp": ("v", "odate = TIMESTAMP '1999-02-02 00:00:00'", "odate"),
    "f_gt": ("v", "size > 20", "size"),
    "f_ge": ("v", "size >= 20", "size"),
    "f_lt": ("v", "size < 20", "size"),
    "f_le": ("v", "size <= 20", "size"),
    "f_gt_date": ("v", "odate > DATE '1999-01-01'", "odate"),
    "f_ge_timestamp": ("v", "odate >= TIMESTAMP '1999-01-01 00:00:00'", "odate"),
    "f_in_number": ("v", "size IN (41, 43)", "size"),
    "f_in_string": ("v", "segment IN ('BUILDING', 'FURNITURE')", "segment"),
    "f_in_date": ("v", "CAST(odate AS DATE) IN (DATE '1999-02-02', DATE '1999-02-16')", "odate"),
    "f_in_with_null": ("v", "segment IN ('BUILDING', NULL)", "segment"),
    "f_in_reserved": ("v", "_conceptType IN ('nation', 'region', 'supplier')", "_conceptType"),
    "f_like_reserved": ("e", "_edgeLabel LIKE 'in%'", "_edgeLabel, _did"),
    "f_contains": ("v", "name LIKE '%mal%'", "name"),
    "f_starts_with": ("v", "name LIKE 'small%'", "name"),
    "f_ends_with": ("v", "name LIKE '%ring'", "name"),
    "f_contains_text": ("v", "text LIKE '%the%'", "n_chars"),
    "f_col_vs_col": ("v", "price >= size * 50", "price, size"),
}
for name, (frame, condition, columns) in PREDICATES.items():
    oracle(name, f"SELECT _id, {columns} FROM {frame} WHERE {condition}")

# ---- types and durations

ORACLES["types_scalar"] = """
SELECT 'o' || o_orderkey AS _id, o_orderstatus = 'O' AS v_boolean,
  CAST(o_orderkey % 100 AS INTEGER) AS v_byte, CAST(o_orderkey % 30000 AS INTEGER) AS v_short,
  CAST(o_orderkey % 1000000 AS INTEGER) AS v_int, o_orderkey AS v_long,
  CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS v_float, o_totalprice AS v_double,
  o_totalprice AS v_decimal, CAST(o_orderdate AS DATE) AS v_date, o_orderdate AS v_local_datetime,
  CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 42635556 MILLISECOND AS v_datetime,
  o_orderpriority AS v_string, hex(o_orderstatus) AS v_binary
FROM orders"""

ORACLES["types_array"] = """
SELECT 'o' || l_orderkey AS _id,
  string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags,
  array_to_string(list_sort(list(DISTINCT l_linenumber)), ',') AS numbers,
  CAST(count(DISTINCT l_discount) AS INTEGER) AS n_discounts, max(l_discount) AS max_discount,
  array_to_string(list_sort(list(DISTINCT l_linestatus = 'O')), ',') AS opens,
  array_to_string(list_sort(list(DISTINCT CAST(date_trunc('year', l_shipdate) AS DATE))), ',') AS years,
  CAST(count(DISTINCT date_trunc('year', l_shipdate)) AS INTEGER) AS n_moments,
  CAST(min(date_trunc('year', l_shipdate)) AS TIMESTAMP) AS first_moment
FROM lineitem GROUP BY l_orderkey"""

ORACLES["types_array_float"] = """
SELECT 'e' || vec_id AS _id, label, CAST(len(embedding) AS INTEGER) AS n,
  CAST(embedding[1] AS DOUBLE) AS first, CAST(list_max(embedding) AS DOUBLE) AS highest
FROM embeddings"""

# Non-negative durations as text; months, days, seconds and nanos are whole numbers.
_TEXT = """CASE WHEN months = 0 AND days = 0 AND seconds = 0 AND nanos = 0 THEN 'PT0S' ELSE 'P'
  || CASE WHEN months // 12 <> 0 THEN (months // 12) || 'Y' ELSE '' END
  || CASE WHEN months % 12 <> 0 THEN (months % 12) || 'M' ELSE '' END
  || CASE WHEN days <> 0 THEN days || 'D' ELSE '' END
  || CASE WHEN seconds <> 0 OR nanos <> 0 THEN 'T' ELSE '' END
  || CASE WHEN seconds // 3600 <> 0 THEN (seconds // 3600) || 'H' ELSE '' END
  || CASE WHEN seconds % 3600 // 60 <> 0 THEN (seconds % 3600 // 60) || 'M' ELSE '' END
  || CASE WHEN nanos <> 0 THEN (seconds % 60) || '.' || rtrim(lpad(CAST(nanos AS VARCHAR), 9, '0'), '0') || 'S'
          WHEN seconds % 60 <> 0 THEN (seconds % 60) || 'S' ELSE '' END END"""
_FIELDS = f"'duration' AS type, months, days, seconds, CAST(nanos AS INTEGER) AS nanoseconds, {_TEXT} AS value"

ORACLES["duration_make"] = f"""
WITH d AS (SELECT 'o' || o_orderkey AS _id, o_orderkey % 14 AS months, CAST(22 AS BIGINT) AS days,
    71509 + (o_orderkey % 50) * 3600 + 1 AS seconds, 500000000 AS nanos FROM orders)
SELECT _id, {_FIELDS} FROM d"""

ORACLES["duration_array"] = f"""
WITH d AS (
  SELECT 'd' || doc_id AS _id, 1 AS position, CAST(0 AS BIGINT) AS months, CAST(0 AS BIGINT) AS days,
    n_chars AS seconds, 500000000 AS nanos FROM documents
  UNION ALL
  SELECT 'd' || doc_id, 2, 0, length(text) * 7 // 4, (length(text) * 7 % 4) * 21600, 0 FROM documents)
SELECT _id, CAST(2 AS INTEGER) AS n, CAST(position AS INTEGER) AS position, {_FIELDS} FROM d"""

ORACLES["duration_array_order"] = "SELECT 'd' || doc_id AS _id, n_chars AS length FROM documents WHERE n_chars > 1000"

ORACLES["duration_order"] = """
WITH d AS (SELECT 'o' || o_orderkey AS _id, (o_orderkey % 14) * 2629746 + (o_orderkey % 50) * 3600 AS length FROM orders)
SELECT _id, length FROM d WHERE length > 20000000"""

ORACLES["duration_range"] = """
SELECT 'o' || o_orderkey AS _id, CAST((o_orderkey % 90) * 86400 + 0.5 AS DOUBLE) AS length FROM orders
WHERE (o_orderkey % 90) * 86400 + 0.5 BETWEEN 30 * 86400 AND 60 * 86400"""

# ---- writes

ORACLES["insert_patterns"] = """
SELECT 'placed|customer:' || o_custkey || '|order:' || o_orderkey AS _id, 'placed' AS _edgeLabel, 'customer:' || o_custkey AS _sid,
  'order:' || o_orderkey AS _did, o_orderstatus AS status, o_totalprice AS price
FROM orders JOIN customer ON c_custkey = o_custkey
UNION ALL SELECT 'order:' || o_orderkey, 'order', NULL, NULL, NULL, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey
UNION ALL SELECT 'customer:' || c_custkey, 'customer', NULL, NULL, NULL, NULL FROM customer"""

_PEOPLE = "people AS (SELECT * FROM v WHERE _conceptType IN ('customer', 'supplier'))"
_C = "SELECT {} FROM v WHERE _conceptType = 'customer'"

oracle("stored_vertices", "SELECT _id, _conceptType, name, balance, price, odate, n_chars, md5(text) AS text_md5 FROM v")
oracle("stored_id_lookup", "SELECT _id, _conceptType, name FROM people WHERE _id = 'c42'", _PEOPLE)
oracle("stored_edges", f"SELECT {E} FROM e")
oracle("stored_filter", "SELECT _id, _conceptType, name, balance FROM v WHERE _conceptType = 'customer' AND balance > 10")
oracle("insert_vertices", "SELECT _id, _conceptType, name, balance, segment FROM people", _PEOPLE)
oracle("insert_generated_ids",
       "SELECT _conceptType, count(*) AS n, count(*) AS n_ids, count(*) AS n_whole FROM people GROUP BY _conceptType",
       _PEOPLE)
oracle("insert_edges_generated_ids",
       "SELECT _edgeLabel, count(*) AS n, count(*) AS n_ids, count(*) AS n_whole FROM e "
       "WHERE _edgeLabel = 'placed' OR _id LIKE 'in_nation:c%' GROUP BY _edgeLabel")
oracle("insert_by_option_maps",
       "SELECT _id, 'client' AS _conceptType, name, balance FROM people WHERE _conceptType = 'customer'", _PEOPLE)
ORACLES["stored_texts_of_odd_types"] = (
    "SELECT 'd' || doc_id AS _id, '{\"n\":' || n_chars || '}' AS facts, '[' || doc_id || ',' || n_chars || ']' AS nested "
    "FROM documents")
oracle("compacted_vertices",
       "SELECT _id, _conceptType, name, CASE WHEN _conceptType = 'customer' AND balance < 0 THEN 0.0 ELSE balance END AS balance, "
       "segment FROM people WHERE _conceptType IN ('customer', 'supplier')", _PEOPLE)
oracle("insert_edges", f"SELECT {E} FROM e WHERE _edgeLabel IN ('placed', 'contains')")
oracle(
    "upsert_vertices",
    "SELECT coalesce(b._id, a._id) AS _id, coalesce(b._conceptType, a._conceptType) AS _conceptType, a.name, "
    "CASE WHEN b._id IS NOT NULL THEN b.balance ELSE a.balance END AS balance, a.segment, b.owing "
    "FROM (SELECT * FROM people WHERE _conceptType = 'customer') a FULL JOIN b ON a._id = b._id",
    _PEOPLE + ", b AS (SELECT _id, _conceptType, CAST(0 AS DOUBLE) AS balance, true AS owing FROM people "
    "WHERE _conceptType = 'customer' AND balance < 0 UNION ALL "
    "SELECT _id, _conceptType, balance, false FROM people WHERE _conceptType = 'supplier')",
)
oracle(
    "upsert_moves_concept",
    "SELECT _id, CASE WHEN _conceptType = 'customer' AND balance < 0 THEN 'debtor' ELSE _conceptType END "
    "AS _conceptType, name, balance FROM people", _PEOPLE,
)
oracle(
    "upsert_latest",
    "SELECT coalesce(b._id, a._id) AS _id, 'customer' AS _conceptType, a.name, b.last_order, b.last_price "
    "FROM (SELECT * FROM v WHERE _conceptType = 'customer') a FULL JOIN b ON a._id = b._id",
    "b AS (SELECT 'c' || o_custkey AS _id, max(o_orderkey) AS last_order, "
    "arg_max(o_totalprice, o_orderkey) AS last_price FROM orders GROUP BY o_custkey)",
)
oracle(
    "upsert_edges",
    "SELECT coalesce(b._id, a._id) AS _id, coalesce(b._edgeLabel, a._edgeLabel) AS _edgeLabel, "
    "coalesce(b._sid, a._sid) AS _sid, coalesce(b._did, a._did) AS _did, a.odate, b.status, b.price "
    "FROM (SELECT * FROM e WHERE _edgeLabel = 'placed') a FULL JOIN b ON a._id = b._id",
    "b AS (SELECT 'placed:' || o_orderkey AS _id, 'placed' AS _edgeLabel, 'c' || o_custkey AS _sid, "
    "'o' || o_orderkey AS _did, o_orderstatus AS status, o_totalprice AS price FROM orders "
    "WHERE o_orderstatus = 'F' UNION ALL "
    "SELECT _id, _edgeLabel, _sid, _did, CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE) FROM e "
    "WHERE _edgeLabel = 'in_nation' AND _id LIKE 'in_nation:c%')",
)
oracle("upsert_null_clears",
       _C.format("_id, _conceptType, name, balance, CASE WHEN balance < 0 THEN NULL ELSE segment END AS segment"))
oracle("overwrite_all", "SELECT _id, _conceptType, name, price FROM v WHERE _conceptType = 'part'")
oracle("overwrite_filter",
       "SELECT _id, _conceptType, name, balance FROM people WHERE NOT balance < 0 UNION ALL "
       "SELECT _id, _conceptType, name, balance FROM v WHERE _conceptType = 'nation'", _PEOPLE)
oracle("overwrite_dynamic",
       "SELECT _id, _conceptType, name, balance FROM people WHERE _conceptType = 'supplier' OR balance < 0", _PEOPLE)

# ---- visibility expressions

_NUMBER = "CAST(regexp_extract(_id, '[0-9]+') AS BIGINT) % 8"
oracle("visible_by_expression",
       f"SELECT _id, _conceptType, name FROM v WHERE CASE {_NUMBER} WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false WHEN 3 THEN false "
       "WHEN 4 THEN true WHEN 5 THEN true WHEN 6 THEN false WHEN 7 THEN true END")
oracle("stored_visible_by_expression",
       f"SELECT _id, _edgeLabel, _sid, _did FROM e WHERE _edgeLabel = 'placed' AND CASE {_NUMBER} WHEN 0 THEN true WHEN 1 THEN false "
       "WHEN 2 THEN true WHEN 3 THEN false WHEN 4 THEN true WHEN 5 THEN false WHEN 6 THEN true WHEN 7 THEN false END")

# ---- catalog


def _counted(frame: str, names: dict[str, str], kinds: dict[str, str], shown: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS name, '{kinds[k]}' AS type{shown.format(n=n, hint='ALL' if k == 'VARCHAR' else 'EXACT_MATCH')}, "
        f"count({n}) AS n_values FROM {frame}" for n, k in names.items()
    )


_REGISTERED = {n: VERTEX_PROPERTIES[n] for n in ("name", "balance", "segment", "brand", "ptype", "size", "price")}
oracle(
    "register_properties_of_tables",
    _counted("cp", _REGISTERED, CATALOG_NAMES,
             ", '{n}' AS display_name, 'thing' AS concept, false AS system_property, true AS user_visible, "
             "true AS searchable, true AS updatable, true AS addable, '{hint}' AS text_hint"),
    "cp AS (SELECT * FROM v WHERE _conceptType IN ('customer', 'part'))",
)
oracle("list_properties_of_graph", _counted("va", _ALL, CATALOG_NAMES, ""), _V_ALL)
oracle(
    "register_types_of_tables",
    "SELECT 'concept' AS kind, _conceptType AS name, _conceptType AS display_name, 'thing' AS parent, "
    "CAST(NULL AS VARCHAR) AS source, CAST(NULL AS VARCHAR) AS target, true AS user_visible, count(*) AS n "
    "FROM v GROUP BY _conceptType UNION ALL "
    "SELECT 'concept', 'thing', 'thing', NULL, NULL, NULL, true, NULL UNION ALL "
    "SELECT 'relationship', _edgeLabel, _edgeLabel, NULL, 'thing', 'thing', true, count(*) FROM e GROUP BY _edgeLabel",
)
oracle("list_labels_of_graph",
       "SELECT _edgeLabel AS name, 'thing' AS source, 'thing' AS target, count(*) AS n FROM e GROUP BY _edgeLabel")
oracle("list_concepts_of_graph",
       "SELECT _conceptType AS name, 'thing' AS parent, count(*) AS n FROM v GROUP BY _conceptType "
       "UNION ALL SELECT 'thing', NULL, NULL")
oracle("drop_property_of_store",
       "SELECT _id, _conceptType, name, balance, CASE WHEN _conceptType = 'supplier' THEN 1 END AS segment FROM people",
       _PEOPLE)
oracle("drop_concept_of_graph",
       "SELECT _conceptType AS name, count(*) AS n, _conceptType <> 'document' AS registered FROM v GROUP BY _conceptType")
oracle("drop_label_of_graph",
       "SELECT _edgeLabel AS name, count(*) AS n, _edgeLabel <> 'contains' AS registered FROM e GROUP BY _edgeLabel")

# ---- matching and deleting

oracle("match_label", "SELECT name, brand, size FROM v WHERE _conceptType = 'part'")
oracle("match_label_prop", "SELECT _id, name FROM v WHERE _conceptType = 'customer' AND segment = 'BUILDING'")
oracle("match_edge_label", "SELECT _id, _sid, _did, quantity FROM e WHERE _edgeLabel = 'contains' AND quantity > 45")
oracle("delete_where_balance", "SELECT _id, _conceptType, name, balance FROM people WHERE NOT balance < 0", _PEOPLE)
_DEBTORS = ("gone AS (SELECT _id FROM v WHERE _conceptType = 'customer' AND balance < 0), "
            "links AS (SELECT * FROM e WHERE _edgeLabel = 'placed' OR _id LIKE 'in_nation:c%')")
oracle("delete_all",
       "SELECT _conceptType AS type, count(*) AS n FROM v WHERE _conceptType = 'supplier' GROUP BY 1 "
       "UNION ALL SELECT _edgeLabel, count(*) FROM links GROUP BY 1", _DEBTORS)
oracle("drop_types_of_store",
       "SELECT _edgeLabel AS name, count(*) AS n, _edgeLabel <> 'placed' AS listed FROM links "
       "WHERE _sid NOT IN (SELECT _id FROM gone) GROUP BY 1", _DEBTORS)
oracle("delete_detach",
       "SELECT _id, _edgeLabel, _sid, _did FROM links WHERE _sid NOT IN (SELECT _id FROM gone)", _DEBTORS)
oracle("dangling_edges",
       "SELECT _id, _edgeLabel, _sid FROM links WHERE _sid IN (SELECT _id FROM gone)", _DEBTORS)

# ---- text index

ORACLES["index_contains"] = """
SELECT 'd' || doc_id AS _id, CASE WHEN lang = 'de' THEN 'translated' ELSE 'document' END AS _conceptType, lang,
  CAST(length(text) + CASE WHEN lang = 'de' THEN 9 ELSE 0 END AS INTEGER) AS length
FROM documents WHERE lang = 'de' AND text IS NOT NULL OR contains(text, 'tion the ')"""

# ---- layouts of stored graphs

oracle("stored_scan_range", "SELECT _id, _edgeLabel, _sid, _did FROM e WHERE _edgeLabel = 'placed'")
oracle("stored_scan_shard", "SELECT _id, _conceptType, name, balance FROM people", _PEOPLE)

# ---- edges of vertices

_ENDS = ("ends AS (SELECT _sid AS _id, _id AS edge, _edgeLabel AS label, 'out' AS direction, _did AS other FROM e "
         "UNION ALL SELECT _did, _id, _edgeLabel, 'in', _sid FROM e)")
oracle("edge_references_of_vertices", "SELECT *, true AS bounded FROM ends", _ENDS)
oracle("edge_labels_of_vertices", "SELECT _id, label, direction, count(*) AS n FROM ends GROUP BY ALL", _ENDS)

# ---- compositions

oracle("count_by_concept", "SELECT _conceptType, count(*) AS n FROM v GROUP BY _conceptType")
oracle(
    "edge_endpoints_join",
    "SELECT e._id, e._edgeLabel, s._conceptType AS source_type, s.name AS source_name, "
    "d._conceptType AS target_type, d.name AS target_name FROM e JOIN v s ON e._sid = s._id JOIN v d ON e._did = d._id",
)
