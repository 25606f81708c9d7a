"""Patterns made of rows, and durations sought by their stored length."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import propgraph as pg
from propgraph.columns import EDGE, VERTEX
from propgraph.operators.match import lasting

NODES = {"a": pg.Node("Person", ["who"], {"name": "who"}), "b": pg.Node("City", ["city", "land"], {"land": "land"})}
LINKS = [pg.Link("a", "lives:in", "b", {"since": "since"}), pg.Link("b", "near", "b")]


def read(spark, root, kind, *columns):
    return sorted((tuple(r) for r in pg.read_elements(pg.GraphStore(spark, root).graph(), kind).select(*columns).collect()), key=str)


def test_patterns(spark, root):
    rows = spark.createDataFrame([("x", "A:1", "l", 1), ("y", "A:1", "l", 2), ("z", None, "l", 3), (None, "B", "m", 4), ("x", "A:1", "l", 1)],
                                 "who string, city string, land string, since int")
    for _ in range(2):
        pg.create_patterns(rows, root, NODES, LINKS)
    assert read(spark, root, VERTEX, "_id", "_conceptType", "name", "land") == [
        ("City:A::1:l", "City", None, "l"), ("City:B:m", "City", None, "m"), ("Person:x", "Person", "x", None), ("Person:y", "Person", "y", None),
        ("Person:z", "Person", "z", None)]
    assert read(spark, root, EDGE, "_id", "_edgeLabel", "_sid", "_did", "since") == [
        ("lives:in|Person:x|City:A::1:l", "lives:in", "Person:x", "City:A::1:l", 1), ("lives:in|Person:y|City:A::1:l", "lives:in", "Person:y", "City:A::1:l", 2),
        ("near|City:A::1:l|City:A::1:l", "near", "City:A::1:l", "City:A::1:l", None), ("near|City:B:m|City:B:m", "near", "City:B:m", "City:B:m", None)]


def test_a_key_with_different_properties_is_an_error(spark, root):
    rows = spark.createDataFrame([("x", 1), ("x", 2)], "who string, age int")
    with pytest.raises(ValueError, match="More than one row in the batch for _id Person:x"):
        pg.create_patterns(rows, root, {"a": pg.Node("Person", ["who"], {"age": "age"})})
    with pytest.raises(ValueError, match="No node 'b'"):
        pg.create_patterns(rows, root, {"a": pg.Node("Person", ["who"])}, [pg.Link("a", "l", "b")])


def test_edges_need_no_join(spark):
    from propgraph.operators.patterns import pattern_edges
    rows = spark.createDataFrame([("x", "A", "l", 1)], "who string, city string, land string, since int")
    assert "Join" not in pattern_edges(rows, NODES, LINKS)._jdf.queryExecution().executedPlan().toString()


def test_durations_are_sought_by_their_stored_length(spark, root):
    store = pg.GraphStore(spark, root)
    batch = spark.range(40).select(F.col("id").cast("string").alias("_id"), pg.make_duration(days="id", seconds=F.lit(0.5).cast("decimal(2,1)")).alias("span"))
    store.write(batch.filter("_id <> '7'"), pg.GraphOptions(VERTEX, concept_type="T"))
    store.write(batch.filter("_id = '7'").unionByName(spark.range(1).select(F.lit("none").alias("_id")), allowMissingColumns=True), pg.GraphOptions(VERTEX, concept_type="T"))
    store.write(spark.createDataFrame([("3", 5)], "_id string, n int"), pg.GraphOptions(VERTEX, concept_type="T"))

    def found(low, high):
        frame = lasting(store.graph(), VERTEX, "span", low, high)
        return sorted(int(r._id) for r in frame.collect()), frame._jdf.queryExecution().executedPlan().toString()

    day = 86400
    ids, plan = found(3 * day, 7 * day)
    pushed = plan.split("PushedFilters: ")[1].replace("`", "")
    assert ids == [3, 4, 5, 6] and "GreaterThanOrEqual(span@seconds,259200)" in pushed and "LessThanOrEqual(span@seconds,604800)" in pushed
    assert found(None, day + Decimal("0.5"))[0] == [0, 1] and found(39 * day, None)[0] == [39]
    assert found(3 * day + 1, 4 * day)[0] == []
    frames = pg.graph_of(spark, [batch.withColumn("_conceptType", F.lit("T"))])
    assert lasting(frames, VERTEX, "span", 38 * day, None).count() == 2
    assert "span@seconds" not in pg.read_elements(store.graph(), VERTEX).columns
