"""Reads of a small graph: rows, schema, presets, visibility, predicates, plans."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import propgraph as pg
from propgraph.columns import EDGE, VERTEX
from propgraph.operators.catalog import Catalog

UTC = datetime.timezone.utc


def people(spark):
    return spark.createDataFrame(
        [("1", "Person", "John Doe", 39, 19, 20, None, "", False),
         ("2", "Person", "Jane Doe", None, 20, 18, datetime.date(1988, 1, 5), "a", False),
         ("3", "Customer", "John Mayer", 43, 21, 12, datetime.date(1998, 2, 4), "b", False),
         ("4", "Customer", None, 41, None, 1, datetime.date(1994, 10, 16), None, True)],
        "_id string, _conceptType string, name string, age bigint, score bigint, limit bigint, "
        "birth date, _visibility string, _hidden boolean",
    )


@pytest.fixture(scope="module")
def graph(spark):
    edges = spark.createDataFrame(
        [("e1", "knows", "1", "2", "str1"), ("e2", "likes", "2", "3", "str2")],
        "_id string, _edgeLabel string, _sid string, _did string, prop1 string",
    )
    return pg.graph_of(spark, [people(spark)], [edges])


ALL = dict(authorizations=("a", "b"), fetch_hints="ALL_INCLUDING_HIDDEN")


def ids(frame):
    return sorted(r[0] for r in frame.select("_id").collect())


def test_vertices_are_wide_and_ordered_by_the_catalog(graph):
    frame = pg.read_elements(graph, VERTEX, **ALL)
    assert frame.columns == ["_conceptType", "_id", "score", "prop1", "name", "limit", "birth", "age"]
    assert ids(frame) == ["1", "2", "3", "4"]


def test_edges_carry_their_ends(graph):
    frame = pg.read_elements(graph, EDGE)
    assert frame.columns[:4] == ["_did", "_sid", "_edgeLabel", "_id"]
    assert frame.select("_sid", "_did", "prop1", "name").orderBy("_id").collect() == [
        ("1", "2", "str1", None), ("2", "3", "str2", None)
    ]


def test_absent_properties_are_null(spark):
    first = spark.createDataFrame([("1", "Person", [12, 34])], "_id string, _conceptType string, field1 array<bigint>")
    second = spark.createDataFrame([("2", "Person", 123)], "_id string, _conceptType string, field2 bigint")
    rows = pg.read_elements(pg.graph_of(spark, [first, second]), VERTEX).orderBy("_id").collect()
    assert [(r.field1, r.field2) for r in rows] == [([12, 34], None), (None, 123)]


def test_union_goes_by_the_first_registered_type(spark):
    wide = spark.createDataFrame([("1", "A", 1)], "_id string, _conceptType string, n bigint")
    narrow = spark.createDataFrame([("2", "B", 2)], "_id string, _conceptType string, n int")
    frame = pg.read_elements(pg.graph_of(spark, [wide, narrow]), VERTEX)
    assert dict(frame.dtypes)["n"] == "bigint"
    assert sorted(r.n for r in frame.collect()) == [1, 2]
    text = spark.createDataFrame([("3", "C", "x")], "_id string, _conceptType string, n string")
    with pytest.raises(ValueError, match="'n' is LONG"):
        pg.graph_of(spark, [wide, text])


def test_empty_graph(spark):
    graph = pg.PropertyGraph(Catalog(), *[pg.graph_of(spark).frame(k) for k in (VERTEX, EDGE)])
    assert pg.read_elements(graph, VERTEX).count() == pg.read_elements(graph, EDGE).count() == 0


@pytest.mark.parametrize("tokens, expected", [((), ["1"]), (("a",), ["1", "2"]), (("a", "b"), ["1", "2", "3"])])
def test_visibility(graph, tokens, expected):
    assert ids(pg.read_elements(graph, VERTEX, tokens)) == expected


def test_hidden_elements_need_their_hint(graph):
    assert ids(pg.read_elements(graph, VERTEX, fetch_hints="ALL_INCLUDING_HIDDEN")) == ["1", "4"]


@pytest.mark.parametrize("hint", ["ALL", "PROPERTIES", "PROPERTIES_AND_METADATA", "PROPERTIES_AND_EDGE_REFS"])
def test_hints_with_properties(graph, hint):
    assert pg.read_elements(graph, VERTEX, fetch_hints=hint).first().name == "John Doe"


@pytest.mark.parametrize("hint", ["EDGE_LABELS", "EDGE_REFS", "NONE"])
def test_hints_without_properties(graph, hint):
    frame = pg.read_elements(graph, EDGE, fetch_hints=hint)
    assert frame.schema == pg.read_elements(graph, EDGE).schema
    assert sorted((r._id, r._sid, r._edgeLabel, r.prop1) for r in frame.collect()) == [
        ("e1", "1", "knows", None), ("e2", "2", "likes", None)
    ]


def test_unknown_hints_and_strategies_are_errors(graph):
    with pytest.raises(ValueError, match="fetchHints"):
        pg.read_elements(graph, VERTEX, fetch_hints="EVERYTHING")
    with pytest.raises(ValueError, match="partitioning"):
        pg.read_elements(graph, VERTEX, partitioning="hash")


def test_user_schema(graph):
    schema = T.StructType([
        T.StructField("nickname", T.StringType()), T.StructField("age", T.IntegerType()),
        T.StructField("_id", T.StringType()),
    ])
    frame = pg.read_elements(graph, VERTEX, schema=schema, **ALL)
    assert frame.dtypes == [("nickname", "string"), ("age", "int"), ("_id", "string")]
    assert sorted(r._id for r in frame.filter("age = 43 AND nickname IS NULL").collect()) == ["3"]


@pytest.mark.parametrize("options, partitions", [
    ({"partitioning": "shard", "partitions": 5}, 5), ({"partitioning": "range", "partitions": 3}, 3),
    ({"partitioning": "range", "partitions": 300}, 300), ({"partitioning": "range", "partitions": 9, "max_ranges": 4}, 4),
])
def test_strategies_keep_each_row_once(graph, options, partitions):
    frame = pg.read_elements(graph, VERTEX, **ALL, **options)
    assert ids(frame) == ["1", "2", "3", "4"]
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert f", {partitions}" in plan.splitlines()[0]


@pytest.mark.parametrize("strategy", ["none", "shard"])
def test_plain_scans_do_not_shuffle(graph, strategy):
    assert "Repartition" not in pg.read_elements(graph, VERTEX, partitioning=strategy)._jdf.queryExecution().optimizedPlan().toString()


PREDICATES = [
    ("name = 'John Doe'", ["1"]), ("NOT name = 'John Doe'", ["2", "3"]), ("name != 'John Doe'", ["2", "3"]),
    ("birth = '1988-01-05'", ["2"]), ("NOT birth = '1988-01-05'", ["3", "4"]), ("birth > '1990-01-01'", ["3", "4"]),
    ("age > 41", ["3"]), ("age >= 41", ["3", "4"]), ("age < 40", ["1"]), ("age <= 41", ["1", "4"]),
    ("score >= limit", ["2", "3"]), ("age IN (41, 43)", ["3", "4"]), ("age IN (41, NULL)", ["4"]),
    ("birth IN (date'1988-01-05', date'1998-02-04')", ["2", "3"]), ("name IN ('Jane Doe', 'x')", ["2"]),
    ("age IS NULL", ["2"]), ("age IS NOT NULL", ["1", "3", "4"]), ("age = 43 OR age = 39 OR age = 32", ["1", "3"]),
    ("age >= 39 AND age <= 43", ["1", "3", "4"]), ("name LIKE 'John%'", ["1", "3"]), ("name LIKE '%Doe'", ["1", "2"]),
    ("name LIKE '%n M%'", ["3"]), ("name <=> 'Jane Doe'", ["2"]), ("name <=> NULL", ["4"]), ("NOT name <=> NULL", ["1", "2", "3"]),
    ("_id = '2'", ["2"]), ("_id IN ('2', '4')", ["2", "4"]), ("_conceptType = 'Customer'", ["3", "4"]),
    ("_conceptType LIKE 'Per%'", ["1", "2"]), ("_conceptType = 'Customer' AND age > 41", ["3"]),
    ("abs(age - 42) = 1", ["3", "4"]), ("age BETWEEN 40 AND 42", ["4"]),
]


@pytest.mark.parametrize("predicate, expected", PREDICATES)
def test_predicates(graph, predicate, expected):
    assert ids(pg.where(pg.read_elements(graph, VERTEX, **ALL), predicate)) == expected


def test_empty_in_list_matches_nothing(graph):
    assert ids(pg.where(pg.read_elements(graph, VERTEX, **ALL), F.col("age").isin())) == []


def test_edge_predicates(graph):
    frame = pg.read_elements(graph, EDGE)
    assert ids(frame.filter("_edgeLabel = 'knows'")) == ids(frame.filter("_did IN ('2')")) == ids(frame.filter("_sid LIKE '1%'")) == ["e1"]


def test_match(graph):
    assert ids(pg.match_vertices(graph, "Person", **ALL)) == ["1", "2"]
    assert ids(pg.match_vertices(graph, "Person", {"name": "Jane Doe"}, **ALL)) == ["2"]
    assert ids(pg.match_vertices(graph, None, {"colour": "red"}, **ALL)) == [], "no such property anywhere"
    assert ids(pg.match_vertices(graph, "Customer", predicate="age < 43", **ALL)) == ["4"]
    assert ids(pg.match_edges(graph, "likes", {"prop1": "str2"})) == ["e2"]


def test_duration_predicates_raise(spark):
    frame = spark.range(2).select(
        F.col("id").cast("string").alias("_id"), F.lit("T").alias("_conceptType"),
        pg.make_duration(days=F.col("id")).alias("span"), F.array(pg.make_duration(days=1)).alias("spans"), "id",
    )
    graph = pg.graph_of(spark, [frame])
    scan = pg.read_elements(graph, VERTEX)
    for predicate in (
        F.col("span") == pg.make_duration(days=1), F.col("span") > pg.make_duration(days=1),
        F.col("span").isin(pg.make_duration(days=1)), scan["span"] == scan["span"],
        F.col("spans") == F.array(pg.make_duration(days=1)), F.col("span").eqNullSafe(pg.make_duration(days=1)),
        F.array_contains("spans", pg.make_duration(days=1)), (F.col("id") > 0) & ~(F.col("spans")[0] <= F.col("span")),
    ):
        with pytest.raises(ValueError, match="^Duration filters not supported$"):
            pg.where(scan, predicate)
    with pytest.raises(ValueError, match="^Duration filters not supported$"):
        pg.match_vertices(graph, "T", {"span": 1})
    assert ids(pg.where(scan, F.col("span").isNotNull() & (scan["id"] > 0))) == ["1"]
    assert ids(pg.where(scan, pg.duration_seconds(F.col("span")) >= 86_400)) == ["1"]
    assert ids(pg.where(scan, "span.days = 1")) == ["1"]
    assert ids(pg.where(scan, F.col("span").isNull())) == []
    assert ids(pg.where(scan, pg.duration_seconds(scan["span"]) > 1)) == ["1"]
    assert ids(pg.where(scan, pg.duration_seconds(F.col("spans")[0]) > 1)) == ["0", "1"]
    assert ids(pg.where(scan, pg.duration_seconds(F.element_at("spans", 1)) > 1)) == ["0", "1"]
