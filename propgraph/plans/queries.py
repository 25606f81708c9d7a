"""The registered queries: one per operator, each over the whole test tables.

Results are flat: instants become zone-less timestamps, structs and arrays are taken apart.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from propgraph.columns import (
    CONCEPT_TYPE, DEST_ID, EDGE, EDGE_LABEL, HIDDEN, ID, SOURCE_ID, VERTEX, VISIBILITY, type_column,
)
from propgraph.functions.durations import duration_seconds, make_duration
from propgraph.functions.values import instant
from propgraph.operators.catalog import (
    CONCEPT, RELATIONSHIP, Catalog, drop_property, drop_type, infer_schema, list_concepts, list_labels,
    list_properties, properties_frame, register_properties, register_types, types_frame,
)
from propgraph.api import create_patterns, load, save
from propgraph.operators.match import lasting, match_edges, match_vertices, where
from propgraph.operators.patterns import Link, Node
from propgraph.operators.references import edge_labels, edge_references
from propgraph.options import GraphOptions
from propgraph.plans.scratch import scratch_root
from propgraph.sources import tables as t
from propgraph.sources.elements import PropertyGraph, graph_of, read_elements
from propgraph.sources.store import GraphStore

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VERTEX_COLUMNS = (ID, CONCEPT_TYPE, "name", "balance", "price")
EDGE_COLUMNS = (ID, EDGE_LABEL, SOURCE_ID, DEST_ID, "odate", "quantity", "lines")


def query(function: Query) -> Query:
    """Register under the function's own name; date-times are compared in UTC."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return function


def flat(frame: DataFrame, *columns: str) -> DataFrame:
    """The given columns, with instants as zone-less timestamps."""
    types = dict(frame.dtypes)
    return frame.select(*[
        F.col(c).cast("timestamp_ntz").alias(c) if types[c] == "timestamp" else F.col(c) for c in columns
    ])


def vertices(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return read_elements(t.tables_graph(spark, sf_dir, kinds=(VERTEX,)), VERTEX, **options)


def edges(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return read_elements(t.tables_graph(spark, sf_dir, kinds=(EDGE,)), EDGE, **options)


def key(prefix: str, *columns: str) -> Column:
    return F.expr(t.key(prefix, *columns))


def on_days(when: Column, *days: str) -> Column:
    """Does an instant fall on one of the days? As ranges, which scans can skip row groups by."""
    starts = [F.lit(day).cast("date") for day in days]
    return reduce(lambda a, b: a | b, [
        (when >= start.cast("timestamp")) & (when < F.date_add(start, 1).cast("timestamp")) for start in starts])


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---- scans -------------------------------------------------------------------------------


@query
def vertex_scan(spark, sf_dir):
    return flat(vertices(spark, sf_dir), *VERTEX_COLUMNS)


@query
def edge_scan(spark, sf_dir):
    return flat(edges(spark, sf_dir), *EDGE_COLUMNS)


@query
def scan_shard(spark, sf_dir):
    return flat(vertices(spark, sf_dir, partitioning="shard"), *VERTEX_COLUMNS)


@query
def scan_shard_by_id(spark, sf_dir):
    frame = vertices(spark, sf_dir, partitioning="shard", partitions=shuffle_width(spark))
    return flat(frame, *VERTEX_COLUMNS)


@query
def scan_range(spark, sf_dir):
    width = shuffle_width(spark)
    frame = vertices(spark, sf_dir, partitioning="range", partitions=width, max_ranges=width)
    return flat(frame, *VERTEX_COLUMNS)


def _value_counts(spark: SparkSession, graph: PropertyGraph, element_type: str) -> DataFrame:
    """(name, n_values) for every column of the inferred schema, in one pass."""
    schema = infer_schema(graph.catalog, element_type)
    frame = read_elements(graph, element_type)
    counts = frame.agg(*[F.count(F.col(c)).alias(c) for c in schema.fieldNames()])
    pairs = [F.struct(F.lit(c).alias("name"), F.col(c).alias("n_values")) for c in schema.fieldNames()]
    return counts.select(F.inline(F.array(*pairs)))


def _schema_rows(spark: SparkSession, sf_dir: str, element_type: str) -> DataFrame:
    graph = t.tables_graph(spark, sf_dir, kinds=(element_type,))
    schema = infer_schema(graph.catalog, element_type)
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]
    listed = spark.createDataFrame(rows, "position int, name string, type string")
    return listed.join(_value_counts(spark, graph, element_type), "name").select(
        "position", "name", "type", "n_values"
    )


@query
def element_schema_vertices(spark, sf_dir):
    return _schema_rows(spark, sf_dir, VERTEX)


@query
def element_schema_edges(spark, sf_dir):
    return _schema_rows(spark, sf_dir, EDGE)


@query
def heterogeneous_union(spark, sf_dir):
    frame = vertices(spark, sf_dir)
    absent = ("name", "balance", "segment", "status", "price", "odate", "size", "text", "n_chars")
    return frame.groupBy(CONCEPT_TYPE).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in absent],
    )


@query
def fetch_properties(spark, sf_dir):
    return flat(vertices(spark, sf_dir, fetch_hints="PROPERTIES"), *VERTEX_COLUMNS)


@query
def fetch_edge_refs(spark, sf_dir):
    return flat(edges(spark, sf_dir, fetch_hints="EDGE_REFS"), *EDGE_COLUMNS)


@query
def fetch_hidden(spark, sf_dir):
    graph = t.tables_graph(spark, sf_dir, True, (VERTEX,))
    frame = read_elements(graph, VERTEX, authorizations=("a", "b"), fetch_hints="ALL_INCLUDING_HIDDEN")
    return flat(frame, *VERTEX_COLUMNS)


@query
def visible_elements(spark, sf_dir):
    graph = t.tables_graph(spark, sf_dir, True, (VERTEX,))
    return flat(read_elements(graph, VERTEX, authorizations=("a",)), *VERTEX_COLUMNS)


@query
def visible_edges(spark, sf_dir):
    graph = t.tables_graph(spark, sf_dir, True, (EDGE,))
    return flat(read_elements(graph, EDGE), *EDGE_COLUMNS)


@query
def user_schema(spark, sf_dir):
    schema = StructType([
        StructField("size", LongType()), StructField("nickname", StringType()),
        StructField("name", StringType()), StructField(ID, StringType()),
    ])
    return vertices(spark, sf_dir, schema=schema)


# ---- predicates --------------------------------------------------------------------------


def _filter_query(name: str, element_type: str, predicate: Callable[[], Column], *columns: str) -> None:
    read = vertices if element_type == VERTEX else edges

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat(where(read(spark, sf_dir), predicate()), ID, *columns)

    run.__name__ = name
    query(run)


col = F.col

_filter_query("f_and", VERTEX, lambda: (col("balance") >= 1000) & (col("balance") <= 5000), "balance")
_filter_query("f_or", VERTEX, lambda: (col("size") == 43) | (col("size") == 39) | (col("size") == 99), "size")
_filter_query("f_not", VERTEX, lambda: ~(col("segment") == "BUILDING"), "segment")
_filter_query("f_not_date", VERTEX, lambda: ~(col("odate").cast("date") == F.lit("1999-02-02").cast("date")), "odate")
_filter_query("f_ne", VERTEX, lambda: col("status") != "F", "status")
_filter_query("f_is_null", VERTEX, lambda: col("name").isNull(), "name")
_filter_query("f_is_not_null", VERTEX, lambda: col("balance").isNotNull(), "balance")
_filter_query("f_eq_null_safe", VERTEX, lambda: col("segment").eqNullSafe("MACHINERY"), "segment")
_filter_query("f_eq_null_safe_null", VERTEX, lambda: col("price").eqNullSafe(None), "price")
_filter_query("f_id", VERTEX, lambda: col(ID) == "c42", CONCEPT_TYPE, "name")
_filter_query("f_concept", VERTEX, lambda: col(CONCEPT_TYPE) == "customer", CONCEPT_TYPE, "name")
_filter_query("f_label", EDGE, lambda: col(EDGE_LABEL) == "placed", EDGE_LABEL, SOURCE_ID)
_filter_query("f_source_id", EDGE, lambda: col(SOURCE_ID) == "c42", EDGE_LABEL, SOURCE_ID, DEST_ID)
_filter_query("f_concept_and_prop", VERTEX,
              lambda: (col(CONCEPT_TYPE) == "customer") & (col("balance") > 10), CONCEPT_TYPE, "balance")
_filter_query("f_eq_string", VERTEX, lambda: col("name") == "small ring", "name")
_filter_query("f_eq_number", VERTEX, lambda: col("size") == 20, "size")
_filter_query("f_eq_date", VERTEX, lambda: col("odate").cast("date") == F.lit("1999-02-02").cast("date"), "odate")
_filter_query("f_eq_timestamp", VERTEX, lambda: col("odate") == instant(F.lit("1999-02-02T02:00:00+02:00")), "odate")
_filter_query("f_gt", VERTEX, lambda: col("size") > 20, "size")
_filter_query("f_ge", VERTEX, lambda: col("size") >= 20, "size")
_filter_query("f_lt", VERTEX, lambda: col("size") < 20, "size")
_filter_query("f_le", VERTEX, lambda: col("size") <= 20, "size")
_filter_query("f_gt_date", VERTEX, lambda: col("odate") > F.lit("1999-01-01").cast("date"), "odate")
_filter_query("f_ge_timestamp", VERTEX, lambda: col("odate") >= instant(F.lit("1999-01-01T00:00:00")), "odate")
_filter_query("f_in_number", VERTEX, lambda: col("size").isin(41, 43), "size")
_filter_query("f_in_string", VERTEX, lambda: col("segment").isin("BUILDING", "FURNITURE"), "segment")
_filter_query("f_in_date", VERTEX, lambda: on_days(col("odate"), "1999-02-02", "1999-02-16"), "odate")
_filter_query("f_in_with_null", VERTEX, lambda: col("segment").isin("BUILDING", None), "segment")
_filter_query("f_in_reserved", VERTEX, lambda: col(CONCEPT_TYPE).isin("nation", "region", "supplier"), CONCEPT_TYPE)
_filter_query("f_like_reserved", EDGE, lambda: col(EDGE_LABEL).like("in%"), EDGE_LABEL, DEST_ID)
_filter_query("f_contains", VERTEX, lambda: col("name").contains("mal"), "name")
_filter_query("f_starts_with", VERTEX, lambda: col("name").startswith("small"), "name")
_filter_query("f_ends_with", VERTEX, lambda: col("name").endswith("ring"), "name")
_filter_query("f_contains_text", VERTEX, lambda: col("text").contains("the"), "n_chars")
_filter_query("f_col_vs_col", VERTEX, lambda: col("price") >= col("size") * 50, "price", "size")


# ---- types and durations -----------------------------------------------------------------


def _stored(spark: SparkSession, batch: DataFrame, concept: str) -> DataFrame:
    """Write vertices, read them back."""
    store = GraphStore(spark, scratch_root(spark))
    store.write(batch, GraphOptions(VERTEX, concept_type=concept))
    return read_elements(store.graph(), VERTEX)


@query
def types_scalar(spark, sf_dir):
    number = F.col("o_orderkey")
    batch = t.table(spark, sf_dir, "orders").select(
        key("o", "o_orderkey").alias(ID),
        (F.col("o_orderstatus") == "O").alias("v_boolean"),
        F.pmod(number, F.lit(100)).cast("byte").alias("v_byte"),
        F.pmod(number, F.lit(30000)).cast("short").alias("v_short"),
        F.pmod(number, F.lit(1000000)).cast("int").alias("v_int"),
        number.alias("v_long"),
        F.col("o_totalprice").cast("float").alias("v_float"),
        F.col("o_totalprice").alias("v_double"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("v_decimal"),
        F.col("o_orderdate").cast("date").alias("v_date"),
        F.col("o_orderdate").alias("v_local_datetime"),
        instant(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T12:50:35.556+01:00"))).alias("v_datetime"),
        F.col("o_orderpriority").alias("v_string"),
        F.encode("o_orderstatus", "utf-8").alias("v_binary"),
    )
    frame = _stored(spark, batch, "order")
    return flat(
        frame.withColumns({
            "v_byte": F.col("v_byte").cast("int"), "v_short": F.col("v_short").cast("int"),
            "v_float": F.col("v_float").cast("double"), "v_decimal": F.col("v_decimal").cast("double"),
            "v_binary": F.hex("v_binary"),
        }),
        ID, "v_boolean", "v_byte", "v_short", "v_int", "v_long", "v_float", "v_double", "v_decimal",
        "v_date", "v_local_datetime", "v_datetime", "v_string", "v_binary",
    )


@query
def types_array(spark, sf_dir):
    """Arrays with few possible members, so that no order can grow one without bound."""

    def members(value: Column) -> Column:
        return F.sort_array(F.collect_set(value))

    batch = (
        t.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
            members(F.col("l_returnflag")).alias("flags"),
            members(F.col("l_linenumber").cast("bigint")).alias("numbers"),
            members(F.col("l_discount")).alias("discounts"),
            members(F.col("l_linestatus") == "O").alias("opens"),
            members(F.trunc(F.col("l_shipdate").cast("date"), "year")).alias("years"),
            members(F.date_trunc("year", F.col("l_shipdate").cast("timestamp"))).alias("moments"),
        )
        .select(key("o", "l_orderkey").alias(ID), "flags", "numbers", "discounts", "opens", "years", "moments")
    )
    frame = _stored(spark, batch, "order")

    def joined(name: str) -> Column:
        return F.array_join(F.transform(F.col(name), lambda v: v.cast("string")), ",")

    return frame.select(
        ID,
        F.array_join("flags", ",").alias("flags"),
        joined("numbers").alias("numbers"),
        F.size("discounts").alias("n_discounts"),
        F.element_at("discounts", -1).alias("max_discount"),
        joined("opens").alias("opens"),
        joined("years").alias("years"),
        F.size("moments").alias("n_moments"),
        F.element_at("moments", 1).cast("timestamp_ntz").alias("first_moment"),
    )


@query
def types_array_float(spark, sf_dir):
    batch = t.table(spark, sf_dir, "embeddings").select(key("e", "vec_id").alias(ID), "embedding", "label")
    return _stored(spark, batch, "embedding").select(
        ID, "label", F.size("embedding").alias("n"),
        F.element_at("embedding", 1).cast("double").alias("first"),
        F.array_max("embedding").cast("double").alias("highest"),
    )


def _duration_fields(name: str, prefix: str = "") -> list[Column]:
    return [F.col(name)[c].alias(prefix + c) for c in ("type", "months", "days", "seconds", "nanoseconds", "value")]


@query
def duration_make(spark, sf_dir):
    months = F.pmod(F.col("o_orderkey"), F.lit(14)) + F.lit(0.75).cast("decimal(3,2)")
    batch = t.table(spark, sf_dir, "orders").select(
        key("o", "o_orderkey").alias(ID),
        make_duration(months=months, hours=F.pmod(F.col("o_orderkey"), F.lit(50)), seconds=1).alias("span"),
    )
    return _stored(spark, batch, "order").select(ID, *_duration_fields("span"))


@query
def duration_array(spark, sf_dir):
    batch = t.table(spark, sf_dir, "documents").select(
        key("d", "doc_id").alias(ID),
        F.array(
            make_duration(seconds=F.col("n_chars") + F.lit(0.5).cast("decimal(2,1)")),
            make_duration(weeks=F.length("text") / F.lit(4).cast("decimal(1,0)")),
        ).alias("spans"),
    )
    each = _stored(spark, batch, "document").select(ID, F.size("spans").alias("n"), F.posexplode("spans").alias("at", "span"))
    return each.select(ID, "n", (F.col("at") + 1).alias("position"), *_duration_fields("span"))


@query
def duration_array_order(spark, sf_dir):
    """Elements chosen by the length of the first duration of an array."""
    batch = t.table(spark, sf_dir, "documents").select(
        key("d", "doc_id").alias(ID), F.array(make_duration(seconds="n_chars"), make_duration(days=1)).alias("spans"))
    length = duration_seconds(F.element_at("spans", 1))
    return where(_stored(spark, batch, "document"), length > 1000).select(ID, length.cast("bigint").alias("length"))


@query
def duration_order(spark, sf_dir):
    """Ordering stored durations by their length, the stand-in for comparing them."""
    batch = t.table(spark, sf_dir, "orders").select(
        key("o", "o_orderkey").alias(ID),
        make_duration(months=F.pmod(F.col("o_orderkey"), F.lit(14)), hours=F.pmod(F.col("o_orderkey"), F.lit(50)))
        .alias("span"),
    )
    length = duration_seconds(F.col("span"))
    return where(_stored(spark, batch, "order"), length > 20_000_000).select(ID, length.cast("bigint").alias("length"))


@query
def duration_range(spark, sf_dir):
    """Stored durations within a range, which the scan skips by the length beside them."""
    batch = t.table(spark, sf_dir, "orders").select(
        key("o", "o_orderkey").alias(ID), make_duration(days=F.pmod(F.col("o_orderkey"), F.lit(90)), seconds=F.lit(0.5).cast("decimal(2,1)")).alias("span"))
    store = GraphStore(spark, scratch_root(spark))
    store.write(batch, GraphOptions(VERTEX, concept_type="order"))
    found = lasting(store.graph(), VERTEX, "span", 30 * 86400, 60 * 86400)
    return found.select(ID, duration_seconds(F.col("span")).cast("double").alias("length"))


# ---- writes ------------------------------------------------------------------------------

CUSTOMER = GraphOptions(VERTEX, concept_type="customer")
SUPPLIER = GraphOptions(VERTEX, concept_type="supplier")
PLACED = GraphOptions(EDGE, label_type="placed")
ANY_VERTEX = GraphOptions(VERTEX)
ANY_EDGE = GraphOptions(EDGE)


def _store(spark: SparkSession) -> GraphStore:
    return GraphStore(spark, scratch_root(spark))


def _people(spark: SparkSession, sf_dir: str) -> GraphStore:
    """A stored graph of customers and suppliers."""
    store = _store(spark)
    both = t.customers(spark, sf_dir).unionByName(t.suppliers(spark, sf_dir), allowMissingColumns=True)
    store.write(both, ANY_VERTEX, type_from_column=True)
    return store


def _state(store: GraphStore, element_type: str, *columns: str) -> DataFrame:
    return flat(read_elements(store.graph(), element_type), ID, type_column(element_type), *columns)


def _owing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.customers(spark, sf_dir).filter(F.col("balance") < 0)


@query
def stored_vertices(spark, sf_dir):
    store = _store(spark)
    store.write(t.tables_graph(spark, sf_dir, kinds=(VERTEX,)).vertices, ANY_VERTEX, type_from_column=True)
    frame = read_elements(store.graph(), VERTEX)
    return flat(frame.withColumn("text_md5", F.md5(F.col("text").cast("binary"))), ID, CONCEPT_TYPE, "name", "balance", "price", "odate", "n_chars", "text_md5")


@query
def stored_id_lookup(spark, sf_dir):
    """An id looked up in a stored graph, where it is a column that scans can skip files by."""
    return where(read_elements(_people(spark, sf_dir).graph(), VERTEX), col(ID) == "c42").select(ID, CONCEPT_TYPE, "name")


@query
def stored_edges(spark, sf_dir):
    store = _store(spark)
    store.write(t.tables_graph(spark, sf_dir, kinds=(EDGE,)).edges, ANY_EDGE, type_from_column=True)
    return _state(store, EDGE, SOURCE_ID, DEST_ID, "odate", "quantity", "lines")


@query
def stored_filter(spark, sf_dir):
    """Stored vertices of one concept over a balance: one partition filter, one pushed filter."""
    store = _store(spark)
    store.write(t.customers(spark, sf_dir), CUSTOMER)
    frame = read_elements(store.graph(), VERTEX)
    return frame.filter((F.col(CONCEPT_TYPE) == "customer") & (F.col("balance") > 10)).select(
        ID, CONCEPT_TYPE, "name", "balance"
    )


@query
def insert_vertices(spark, sf_dir):
    store = _store(spark)
    store.write(t.customers(spark, sf_dir), CUSTOMER)
    store.write(t.suppliers(spark, sf_dir), SUPPLIER)
    return _state(store, VERTEX, "name", "balance", "segment")


@query
def insert_generated_ids(spark, sf_dir):
    """Rows without ids get new ones: as many ids as rows, all whole numbers from zero up."""
    store = _store(spark)
    for batch, options in ((t.customers(spark, sf_dir), CUSTOMER), (t.suppliers(spark, sf_dir), SUPPLIER)):
        store.write(batch.drop(ID), options)
    frame = read_elements(store.graph(), VERTEX)
    unique = frame.groupBy(ID).agg(F.min(CONCEPT_TYPE).alias(CONCEPT_TYPE), F.count(F.lit(1)).alias("rows"))
    return unique.groupBy(CONCEPT_TYPE).agg(
        F.sum("rows").alias("n"), F.count(F.lit(1)).alias("n_ids"),
        F.count_if(F.expr(f"try_cast({ID} AS bigint) >= 0")).alias("n_whole"),
    )


@query
def insert_edges(spark, sf_dir):
    store = _store(spark)
    store.write(t.placed(spark, sf_dir), PLACED)
    store.write(t.contains(spark, sf_dir), GraphOptions(EDGE, label_type="contains"))
    return _state(store, EDGE, SOURCE_ID, DEST_ID, "odate", "quantity", "lines")


@query
def insert_patterns(spark, sf_dir):
    """Customers with their orders from one call, run twice: the second changes nothing."""
    customers, orders = (t.table(spark, sf_dir, name) for name in ("customer", "orders"))
    rows = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    nodes = {"who": Node("customer", ["c_custkey"], {"name": "c_name"}), "what": Node("order", ["o_orderkey"], {"price": "o_totalprice"})}
    root = scratch_root(spark)
    for _ in range(2):
        create_patterns(rows, root, nodes, [Link("who", "placed", "what", {"status": "o_orderstatus"})])
    graph = GraphStore(spark, root).graph()
    ends = read_elements(graph, VERTEX).select(F.col(ID).alias(DEST_ID), "price")
    links = read_elements(graph, EDGE).select(ID, EDGE_LABEL, SOURCE_ID, DEST_ID, "status").join(ends, DEST_ID)
    return links.unionByName(
        read_elements(graph, VERTEX).select(ID, F.col(CONCEPT_TYPE).alias(EDGE_LABEL), "price"), allowMissingColumns=True)


@query
def insert_edges_generated_ids(spark, sf_dir):
    """Edges without ids get new ones: whole numbers, each once."""
    store = _store(spark)
    for placed in (t.placed(spark, sf_dir), t.customer_nations(spark, sf_dir)):
        store.write(placed.drop(ID), ANY_EDGE, type_from_column=True)
    return read_elements(store.graph(), EDGE).groupBy(EDGE_LABEL).agg(
        F.count("*").alias("n"), F.countDistinct(ID).alias("n_ids"), F.count_if(F.col(ID).rlike("^[0-9]+$")).alias("n_whole"))


@query
def insert_by_option_maps(spark, sf_dir):
    """A write and a read as option maps say; the range scan has as many tasks as asked for."""
    root = scratch_root(spark)
    save(t.customers(spark, sf_dir), root, {"element.type": "VERTEX", "conceptType": "client"})
    options = {"element.type": "VERTEX", "partitioning.strategy": "range", "reader.fetchHints": "ALL"}
    return load(spark, root, options, partitions=300).select(ID, CONCEPT_TYPE, "name", "balance")


@query
def stored_texts_of_odd_types(spark, sf_dir):
    """Maps and nested arrays are stored as text."""
    batch = t.table(spark, sf_dir, "documents").select(
        key("d", "doc_id").alias(ID), F.create_map(F.lit("n"), "n_chars").alias("facts"),
        F.array(F.array("doc_id", "n_chars")).alias("nested"))
    return _stored(spark, batch, "document").select(ID, "facts", F.element_at("nested", 1).alias("nested"))


@query
def compacted_vertices(spark, sf_dir):
    """All vertices, each kind inserted by itself, after small files of one partition were merged."""
    store = _store(spark)
    for frame in (t.customers(spark, sf_dir), t.suppliers(spark, sf_dir)):
        store.write(frame, ANY_VERTEX, type_from_column=True)
    store.write(_owing(spark, sf_dir).select(ID, F.lit(0.0).alias("balance"), CONCEPT_TYPE), ANY_VERTEX, type_from_column=True)
    store.compact()
    return _state(store, VERTEX, "name", "balance", "segment")


@query
def upsert_vertices(spark, sf_dir):
    """Customers in debt get a new balance and a flag; suppliers come new."""
    store = _store(spark)
    store.write(t.customers(spark, sf_dir), CUSTOMER)
    changed = _owing(spark, sf_dir).select(
        ID, CONCEPT_TYPE, F.lit(0.0).alias("balance"), F.lit(True).alias("owing")
    )
    new = t.suppliers(spark, sf_dir).select(ID, CONCEPT_TYPE, "balance", F.lit(False).alias("owing"))
    store.write(changed.union(new), ANY_VERTEX, type_from_column=True)
    return _state(store, VERTEX, "name", "balance", "segment", "owing")


@query
def upsert_moves_concept(spark, sf_dir):
    """An upsert under another concept moves the vertex there."""
    store = _people(spark, sf_dir)
    store.write(_owing(spark, sf_dir).select(ID), GraphOptions(VERTEX, concept_type="debtor"))
    return _state(store, VERTEX, "name", "balance")


@query
def upsert_latest(spark, sf_dir):
    """Many rows per id in one batch: each customer keeps the order with the highest key."""
    store = _store(spark)
    store.write(t.customers(spark, sf_dir), CUSTOMER)
    rows = t.table(spark, sf_dir, "orders").select(
        key("c", "o_custkey").alias(ID), F.col("o_orderkey").alias("last_order"),
        F.col("o_totalprice").alias("last_price"),
    )
    store.write(rows, CUSTOMER, order_by="last_order")
    return _state(store, VERTEX, "name", "last_order", "last_price")


@query
def upsert_edges(spark, sf_dir):
    store = _store(spark)
    store.write(t.placed(spark, sf_dir), PLACED)
    finished = t.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select(
        key("placed:", "o_orderkey").alias(ID), key("c", "o_custkey").alias(SOURCE_ID),
        key("o", "o_orderkey").alias(DEST_ID), F.lit("placed").alias(EDGE_LABEL),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
    )
    new = t.customer_nations(spark, sf_dir)
    store.write(finished.unionByName(new, allowMissingColumns=True), ANY_EDGE, type_from_column=True)
    return _state(store, EDGE, SOURCE_ID, DEST_ID, "odate", "status", "price")


@query
def upsert_null_clears(spark, sf_dir):
    store = _store(spark)
    store.write(t.customers(spark, sf_dir), CUSTOMER)
    store.write(_owing(spark, sf_dir).select(ID, F.lit(None).cast("string").alias("segment")), CUSTOMER)
    return _state(store, VERTEX, "name", "balance", "segment")


@query
def overwrite_all(spark, sf_dir):
    store = _people(spark, sf_dir)
    store.write(t.parts(spark, sf_dir), GraphOptions(VERTEX, concept_type="part"), mode="overwrite")
    return _state(store, VERTEX, "name", "price")


@query
def overwrite_filter(spark, sf_dir):
    """Everything with a debt goes, wherever it is; the nations come."""
    store = _people(spark, sf_dir)
    store.write(t.nations(spark, sf_dir), GraphOptions(VERTEX, concept_type="nation"),
                mode="overwrite_where", where=F.col("balance") < 0)
    return _state(store, VERTEX, "name", "balance")


@query
def overwrite_dynamic(spark, sf_dir):
    """The batch holds customers only, so customers are replaced and suppliers stay."""
    store = _people(spark, sf_dir)
    store.write(_owing(spark, sf_dir), ANY_VERTEX, mode="overwrite_dynamic", type_from_column=True)
    return _state(store, VERTEX, "name", "balance")


# ---- visibility expressions --------------------------------------------------------------

#: Visibilities by the number in an element's id.
EXPRESSIONS = ("", "a", "b", "a&b", "a|b", "a&(b|c)", "(a&b)|(c&d)", '"a b"&c')


def _with_visibility(frame: DataFrame) -> DataFrame:
    number = F.regexp_extract(ID, "[0-9]+", 0).cast("bigint") % len(EXPRESSIONS)
    return frame.withColumn(VISIBILITY, F.element_at(F.array(*map(F.lit, EXPRESSIONS)), (number + 1).cast("int")))


@query
def visible_by_expression(spark, sf_dir):
    """All vertices, each with an expression from its id: those that three authorizations satisfy."""
    graph = graph_of(spark, [_with_visibility(t.tables_graph(spark, sf_dir, kinds=(VERTEX,)).vertices)])
    return read_elements(graph, VERTEX, authorizations=("a", "c", "a b")).select(ID, CONCEPT_TYPE, "name")


@query
def stored_visible_by_expression(spark, sf_dir):
    """Edges of a stored graph, whose expressions are evaluated once each and looked up."""
    store = _store(spark)
    store.write(_with_visibility(t.placed(spark, sf_dir)), PLACED)
    return read_elements(store.graph(), EDGE, authorizations=("b", "c", "d")).select(ID, EDGE_LABEL, SOURCE_ID, DEST_ID)


# ---- catalog -----------------------------------------------------------------------------


@query
def register_properties_of_tables(spark, sf_dir):
    """Customers first, parts after: known names keep type and place, new ones are added."""
    customers, parts = t.customers(spark, sf_dir), t.parts(spark, sf_dir)
    catalog = register_properties(register_properties(Catalog(), customers.schema), parts.schema)
    listed = properties_frame(spark, catalog).drop("column")
    counts = _value_counts(spark, graph_of(spark, [customers, parts]), VERTEX)
    return listed.join(counts, "name")


def _type_counts(graph: PropertyGraph, element_type: str) -> DataFrame:
    kind = type_column(element_type)
    return read_elements(graph, element_type).groupBy(F.col(kind).alias("name")).agg(F.count(F.lit(1)).alias("n"))


@query
def register_types_of_tables(spark, sf_dir):
    catalog = register_types(register_types(Catalog(), CONCEPT, t.CONCEPTS), RELATIONSHIP, t.LABELS)
    listed = types_frame(spark, catalog, CONCEPT).union(types_frame(spark, catalog, RELATIONSHIP))
    graph = t.tables_graph(spark, sf_dir)
    counts = _type_counts(graph, VERTEX).union(_type_counts(graph, EDGE))
    return listed.join(counts, "name", "left")


@query
def list_properties_of_graph(spark, sf_dir):
    graph = t.tables_graph(spark, sf_dir, kinds=(VERTEX,))
    return list_properties(spark, graph.catalog).join(_value_counts(spark, graph, VERTEX), "name")


@query
def list_labels_of_graph(spark, sf_dir):
    graph = t.tables_graph(spark, sf_dir, kinds=(EDGE,))
    return list_labels(spark, graph.catalog).join(_type_counts(graph, EDGE), "name")


@query
def list_concepts_of_graph(spark, sf_dir):
    graph = t.tables_graph(spark, sf_dir, kinds=(VERTEX,))
    return list_concepts(spark, graph.catalog).join(_type_counts(graph, VERTEX), "name", "left")


@query
def drop_property_of_store(spark, sf_dir):
    """A dropped name used again starts empty."""
    store = _people(spark, sf_dir)
    store.drop_property("segment")
    store.write(t.suppliers(spark, sf_dir).select(ID, F.lit(1).alias("segment")), SUPPLIER)
    return _state(store, VERTEX, "name", "balance", "segment")


@query
def drop_concept_of_graph(spark, sf_dir):
    graph = t.tables_graph(spark, sf_dir, kinds=(VERTEX,))
    catalog = drop_type(graph.catalog, CONCEPT, "document")
    counts = _type_counts(graph, VERTEX)
    return counts.join(list_concepts(spark, catalog), "name", "left").select(
        "name", "n", F.col("parent").isNotNull().alias("registered")
    )


@query
def drop_label_of_graph(spark, sf_dir):
    graph = t.tables_graph(spark, sf_dir, kinds=(EDGE,))
    catalog = drop_type(graph.catalog, RELATIONSHIP, "contains")
    counts = _type_counts(graph, EDGE)
    return counts.join(list_labels(spark, catalog), "name", "left").select(
        "name", "n", F.col("source").isNotNull().alias("registered")
    )


# ---- matching and deleting ---------------------------------------------------------------


@query
def match_label(spark, sf_dir):
    return match_vertices(t.tables_graph(spark, sf_dir, kinds=(VERTEX,)), "part").select("name", "brand", "size")


@query
def match_label_prop(spark, sf_dir):
    return match_vertices(t.tables_graph(spark, sf_dir, kinds=(VERTEX,)), "customer", {"segment": "BUILDING"}).select(ID, "name")


@query
def match_edge_label(spark, sf_dir):
    frame = match_edges(t.tables_graph(spark, sf_dir, kinds=(EDGE,)), "contains", predicate=F.col("quantity") > 45)
    return frame.select(ID, SOURCE_ID, DEST_ID, "quantity")


@query
def delete_where_balance(spark, sf_dir):
    store = _people(spark, sf_dir)
    store.delete(VERTEX, F.col("balance") < 0)
    return _state(store, VERTEX, "name", "balance")


@query
def delete_all(spark, sf_dir):
    """What is left after all vertices were deleted and customers came anew: these, and the edges."""
    store = _debtors_deleted(spark, sf_dir, detach=False)
    store.delete(VERTEX)
    store.write(t.suppliers(spark, sf_dir), SUPPLIER)
    graph = store.graph()
    return read_elements(graph, VERTEX).groupBy(F.col(CONCEPT_TYPE).alias("type")).agg(F.count("*").alias("n")).union(
        read_elements(graph, EDGE).groupBy(F.col(EDGE_LABEL).alias("type")).agg(F.count("*").alias("n")))


@query
def drop_types_of_store(spark, sf_dir):
    """Types dropped from the store's catalog; the elements stay."""
    store = _debtors_deleted(spark, sf_dir, detach=True)
    store.drop_label("placed")
    listed = types_frame(spark, store.catalog(), RELATIONSHIP)
    counts = read_elements(store.graph(), EDGE).groupBy(F.col(EDGE_LABEL).alias("name")).agg(F.count("*").alias("n"))
    return counts.join(listed.select("name", F.lit(True).alias("listed")), "name", "left").select(
        "name", "n", F.coalesce("listed", F.lit(False)).alias("listed"))


def _debtors_deleted(spark: SparkSession, sf_dir: str, detach: bool) -> GraphStore:
    """Customers with their orders, after the customers in debt were deleted."""
    store = _store(spark)
    store.write(t.customers(spark, sf_dir), CUSTOMER)
    links = t.placed(spark, sf_dir).unionByName(t.customer_nations(spark, sf_dir), allowMissingColumns=True)
    store.write(links, ANY_EDGE, type_from_column=True)
    store.delete(VERTEX, F.col("balance") < 0, detach=detach)
    return store


@query
def delete_detach(spark, sf_dir):
    return _state(_debtors_deleted(spark, sf_dir, detach=True), EDGE, SOURCE_ID, DEST_ID)


@query
def dangling_edges(spark, sf_dir):
    """Edges left without their source vertex."""
    graph = _debtors_deleted(spark, sf_dir, detach=False).graph()
    ids = read_elements(graph, VERTEX).select(F.col(ID).alias(SOURCE_ID))
    return read_elements(graph, EDGE).join(ids, SOURCE_ID, "left_anti").select(ID, EDGE_LABEL, SOURCE_ID)


# ---- text index --------------------------------------------------------------------------


@query
def index_contains(spark, sf_dir):
    """Documents that contain a passage, found through the index; some were changed after it was made."""
    store = _store(spark)
    documents = t.table(spark, sf_dir, "documents").select(key("d", "doc_id").alias(ID), "text", "lang")
    store.write(documents, GraphOptions(VERTEX, concept_type="document"))
    store.index_text(VERTEX, "text")
    late = documents.filter(F.col("lang") == "de").select(ID, F.concat(F.lit("tion the "), "text").alias("text"))
    store.write(late, GraphOptions(VERTEX, concept_type="translated"))
    return store.containing(VERTEX, "text", "tion the ").select(ID, CONCEPT_TYPE, "lang", F.length("text").alias("length"))


# ---- layouts of stored graphs ------------------------------------------------------------


@query
def stored_scan_range(spark, sf_dir):
    """Stored edges read in ranges of their ids, each a filter on sorted files."""
    store = _store(spark)
    store.write(t.placed(spark, sf_dir), PLACED)
    return read_elements(store.graph(), EDGE, partitioning="range", partitions=6).select(ID, EDGE_LABEL, SOURCE_ID, DEST_ID)


@query
def stored_scan_shard(spark, sf_dir):
    """Stored vertices read in shards that are groups of buckets."""
    return read_elements(_people(spark, sf_dir).graph(), VERTEX, partitioning="shard", partitions=3).select(ID, CONCEPT_TYPE, "name", "balance")


# ---- edges of vertices -------------------------------------------------------------------


@query
def edge_references_of_vertices(spark, sf_dir):
    """Every vertex's edges, taken from its lists, with the number of each list's edges kept in bounds."""
    lists = edge_references(t.tables_graph(spark, sf_dir, kinds=(EDGE,)), chunk=50)
    each = lists.select(ID, F.explode("edges").alias("e"), (F.size("edges") <= 50).alias("bounded"))
    return each.select(ID, "e.edge", "e.label", "e.direction", "e.other", "bounded")


@query
def edge_labels_of_vertices(spark, sf_dir):
    return edge_labels(t.tables_graph(spark, sf_dir, kinds=(EDGE,)))


# ---- compositions with native operators --------------------------------------------------


@query
def count_by_concept(spark, sf_dir):
    return vertices(spark, sf_dir).groupBy(CONCEPT_TYPE).agg(F.count(F.lit(1)).alias("n"))


@query
def edge_endpoints_join(spark, sf_dir):
    """Every edge with the concept and name of both its ends."""
    graph = t.tables_graph(spark, sf_dir)
    ends = read_elements(graph, VERTEX)
    links = read_elements(graph, EDGE).select(ID, EDGE_LABEL, SOURCE_ID, DEST_ID)
    for end, prefix in ((SOURCE_ID, "source"), (DEST_ID, "target")):
        named = ends.select(
            F.col(ID).alias(end), F.col(CONCEPT_TYPE).alias(f"{prefix}_type"), F.col("name").alias(f"{prefix}_name")
        )
        links = links.join(named, end)
    return links.select(ID, EDGE_LABEL, "source_type", "source_name", "target_type", "target_name")
