"""Edges of vertices as bounded lists."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import propgraph as pg
from propgraph.operators.references import edge_labels, edge_references


def graph_of_edges(spark, data):
    edges = spark.createDataFrame(data, "_id string, _edgeLabel string, _sid string, _did string")
    return pg.graph_of(spark, [], [edges])


def listed(frame):
    return sorted((r._id, *e) for r in frame.collect() for e in r.edges)


@pytest.mark.parametrize("chunk", [1, 2, 7, 1000])
def test_each_edge_from_both_ends_once(spark, chunk):
    data = [(f"e{k}", f"l{k % 3}", f"v{k % 5}", f"v{k % 7}") for k in range(100)] + [("loop", "l0", "v1", "v1")]
    out = edge_references(graph_of_edges(spark, data), chunk=chunk)
    wanted = sorted([(s, e, label, "out", d) for e, label, s, d in data] + [(d, e, label, "in", s) for e, label, s, d in data])
    assert listed(out) == wanted
    assert max(len(r.edges) for r in out.collect()) <= chunk
    assert listed(edge_references(graph_of_edges(spark, data), labels=("l1",), chunk=chunk)) == [w for w in wanted if w[2] == "l1"]
    counts = Counter((w[0], w[2], w[3]) for w in wanted)
    assert {(r._id, r.label, r.direction): r.n for r in edge_labels(graph_of_edges(spark, data)).collect()} == counts


def test_a_hot_vertex_is_split(spark):
    """A third of all edges start at one vertex: its list spans rows, and no group holds them all."""
    data = spark.range(60_000).select(
        F.concat(F.lit("e"), "id").alias("_id"), F.lit("l").alias("_edgeLabel"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 9000)).alias("_sid"), F.concat(F.lit("w"), "id").alias("_did"))
    out = edge_references(pg.graph_of(spark, [], [data]), chunk=500).filter("_id = 'hot'").collect()
    assert sum(len(r.edges) for r in out) == 20_000 and max(len(r.edges) for r in out) <= 500
    by_piece = Counter()
    for r in out:
        by_piece[r.piece] += len(r.edges)
    assert len(by_piece) == 80 and max(by_piece.values()) < 500


def test_order_within_a_list_and_no_edges(spark):
    out = edge_references(graph_of_edges(spark, [("b", "l", "1", "2"), ("a", "l", "1", "3")])).filter("_id = '1'").first()
    assert [e.edge for e in out.edges] == ["a", "b"] and (out.piece, out.part) == (0, 0)
    assert edge_references(graph_of_edges(spark, [])).count() == 0


def test_edges_not_seen_are_not_listed(spark):
    edges = spark.createDataFrame([("a", "l", "1", "2", "x", False), ("b", "l", "1", "2", "", True), ("c", "l", "1", "2", "", False)],
                                  "_id string, _edgeLabel string, _sid string, _did string, _visibility string, _hidden boolean")
    graph = pg.graph_of(spark, [], [edges])
    assert {e[1] for e in listed(edge_references(graph))} == {"c"}
    assert {e[1] for e in listed(edge_references(graph, authorizations=("x",), fetch_hints="ALL_INCLUDING_HIDDEN"))} == {"a", "b", "c"}


def test_plan(spark):
    plan = edge_references(graph_of_edges(spark, [("a", "l", "1", "2")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
