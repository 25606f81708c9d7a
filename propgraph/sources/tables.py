"""The test tables seen as a graph: customers, orders, parts and so on, and what links them.

Everything is lazy: a filter on the graph's frames reaches the Parquet scans of the tables,
and the branches of concepts that cannot match are dropped from the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from propgraph.columns import (
    CONCEPT_TYPE, DEST_ID, EDGE, EDGE_LABEL, HIDDEN, ID, SOURCE_ID, VERTEX, VISIBILITY,
)
from propgraph.operators.catalog import Catalog, register_properties
from propgraph.sources.elements import PropertyGraph, graph_of

# Given schemas save a pass over the footers of every file.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}

VERTEX_PROPERTIES = (
    "name string, balance double, segment string, status string, price double, odate timestamp, "
    "priority string, brand string, ptype string, size int, text string, lang string, "
    "source string, n_chars bigint"
)
EDGE_PROPERTIES = "odate timestamp, quantity double, lines bigint"

CONCEPTS = ("customer", "order", "part", "supplier", "nation", "region", "document", "user")
LABELS = ("placed", "in_nation", "in_region", "contains")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def key(prefix: str, *columns: str) -> str:
    """SQL for an element id from a table's key columns, such as c17 or contains:3:8."""
    return f"concat('{prefix}', {", ':', ".join(columns)})"


def _marks(column: str, marked: bool) -> list[str]:
    """Derived visibility tokens and hidden flags, by the key's remainder."""
    if not marked:
        return []
    return [
        f"elt(1 + cast({column} % 3 AS int), '', 'a', 'b') AS {VISIBILITY}",
        f"{column} % 10 = 0 AS {HIDDEN}",
    ]


def _vertices(frame: DataFrame, concept: str, prefix: str, column: str, marked: bool, **properties: str) -> DataFrame:
    values = [f"{source} AS {name}" for name, source in properties.items()]
    return frame.selectExpr(
        f"{key(prefix, column)} AS {ID}", f"'{concept}' AS {CONCEPT_TYPE}", *_marks(column, marked), *values
    )


def customers(spark: SparkSession, sf_dir: str, marked: bool = False) -> DataFrame:
    return _vertices(table(spark, sf_dir, "customer"), "customer", "c", "c_custkey", marked,
                     name="c_name", balance="c_acctbal", segment="c_mktsegment")


def orders(spark: SparkSession, sf_dir: str, marked: bool = False) -> DataFrame:
    return _vertices(table(spark, sf_dir, "orders"), "order", "o", "o_orderkey", marked,
                     status="o_orderstatus", price="o_totalprice", odate="o_orderdate",
                     priority="o_orderpriority")


def parts(spark: SparkSession, sf_dir: str, marked: bool = False) -> DataFrame:
    return _vertices(table(spark, sf_dir, "part"), "part", "p", "p_partkey", marked,
                     name="p_name", brand="p_brand", ptype="p_type", size="p_size",
                     price="p_retailprice")


def suppliers(spark: SparkSession, sf_dir: str, marked: bool = False) -> DataFrame:
    return _vertices(table(spark, sf_dir, "supplier"), "supplier", "s", "s_suppkey", marked,
                     name="s_name", balance="s_acctbal")


def nations(spark: SparkSession, sf_dir: str, marked: bool = False) -> DataFrame:
    return _vertices(table(spark, sf_dir, "nation"), "nation", "n", "n_nationkey", marked, name="n_name")


def regions(spark: SparkSession, sf_dir: str, marked: bool = False) -> DataFrame:
    return _vertices(table(spark, sf_dir, "region"), "region", "r", "r_regionkey", marked, name="r_name")


def documents(spark: SparkSession, sf_dir: str, marked: bool = False) -> DataFrame:
    return _vertices(table(spark, sf_dir, "documents"), "document", "d", "doc_id", marked,
                     text="text", lang="lang", source="source", n_chars="n_chars")


def users(spark: SparkSession, sf_dir: str, marked: bool = False) -> DataFrame:
    return _vertices(table(spark, sf_dir, "events").select("user_id").distinct(), "user", "u", "user_id", marked)


def _edges(
    frame: DataFrame, label: str, own: str, source: str, target: str, column: str, marked: bool,
    **properties: str,
) -> DataFrame:
    values = [f"{c} AS {name}" for name, c in properties.items()]
    return frame.selectExpr(
        f"{own} AS {ID}", f"'{label}' AS {EDGE_LABEL}", f"{source} AS {SOURCE_ID}",
        f"{target} AS {DEST_ID}", *_marks(column, marked), *values,
    )


def placed(spark: SparkSession, sf_dir: str, marked: bool = False) -> DataFrame:
    return _edges(table(spark, sf_dir, "orders"), "placed", key("placed:", "o_orderkey"),
                  key("c", "o_custkey"), key("o", "o_orderkey"), "o_orderkey", marked, odate="o_orderdate")


def customer_nations(spark: SparkSession, sf_dir: str, marked: bool = False) -> DataFrame:
    return _edges(table(spark, sf_dir, "customer"), "in_nation", key("in_nation:c", "c_custkey"),
                  key("c", "c_custkey"), key("n", "c_nationkey"), "c_custkey", marked)


def supplier_nations(spark: SparkSession, sf_dir: str, marked: bool = False) -> DataFrame:
    return _edges(table(spark, sf_dir, "supplier"), "in_nation", key("in_nation:s", "s_suppkey"),
                  key("s", "s_suppkey"), key("n", "s_nationkey"), "s_suppkey", marked)


def nation_regions(spark: SparkSession, sf_dir: str, marked: bool = False) -> DataFrame:
    return _edges(table(spark, sf_dir, "nation"), "in_region", key("in_region:", "n_nationkey"),
                  key("n", "n_nationkey"), key("r", "n_regionkey"), "n_nationkey", marked)


def contains(spark: SparkSession, sf_dir: str, marked: bool = False) -> DataFrame:
    """One edge per order and part; its line items are summed before the shuffle."""
    lines = (
        table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey")
        .agg(F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("lines"))
    )
    return _edges(lines, "contains", key("contains:", "l_orderkey", "l_partkey"), key("o", "l_orderkey"),
                  key("p", "l_partkey"), "l_orderkey", marked, quantity="quantity", lines="lines")


def tables_graph(
    spark: SparkSession, sf_dir: str, marked: bool = False, kinds: tuple[str, ...] = (VERTEX, EDGE)
) -> PropertyGraph:
    """All test tables as one graph; `marked` adds visibility tokens and hidden elements.

    The catalog is always whole; the frames of element kinds not asked for are empty.
    """
    catalog = Catalog()
    for properties in (VERTEX_PROPERTIES, EDGE_PROPERTIES):
        catalog = register_properties(catalog, StructType.fromDDL(properties))
    vertices = (customers, orders, parts, suppliers, nations, regions, documents, users)
    edges = (placed, customer_nations, supplier_nations, nation_regions, contains)
    return graph_of(
        spark,
        [f(spark, sf_dir, marked) for f in vertices if VERTEX in kinds],
        [f(spark, sf_dir, marked) for f in edges if EDGE in kinds],
        CONCEPTS, LABELS, catalog,
    )
