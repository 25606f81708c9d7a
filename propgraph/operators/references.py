"""The edges at each vertex as lists of bounded length: what edge references and edge labels are fetched from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.columns import DEST_ID, EDGE, EDGE_LABEL, ID, SOURCE_ID
from propgraph.sources.elements import PropertyGraph, read_elements

#: Edges of a list at most.
CHUNK = 1000
OUT, IN = "out", "in"


def ends(edges: DataFrame) -> DataFrame:
    """(_id, edge, label, direction, other): each edge once from either end; a loop has both."""
    def end(own: str, direction: str, other: str) -> Column:
        return F.struct(F.col(own).alias(ID), F.lit(direction).alias("direction"), F.col(other).alias("other"))

    both = F.explode(F.array(end(SOURCE_ID, OUT, DEST_ID), end(DEST_ID, IN, SOURCE_ID))).alias("end")
    return edges.select(F.col(ID).alias("edge"), F.col(EDGE_LABEL).alias("label"), both).select(f"end.{ID}", "edge", "label", "end.direction", "end.other")


def edge_references(graph: PropertyGraph, labels: tuple[str, ...] = (), chunk: int = CHUNK, **options) -> DataFrame:
    """(_id, piece, part, edges) of each vertex with edges: lists of (edge, label, direction, other), in this order.

    A list holds `chunk` edges at most. The edges of a vertex with more are dealt by hash to pieces of
    about half of that before they are collected, and a piece that is too long is cut into parts; so no task gets
    all edges of a hot vertex. Degrees are counted first (counts combine before the shuffle), and only those above
    `chunk` are joined back. Of the options, those of `read_elements` decide which edges are seen; `labels`, if
    given, which of them are listed. Edges whose vertices don't exist count too, as ids are all that is read.
    """
    found = ends(read_elements(graph, EDGE, **options).select(ID, EDGE_LABEL, SOURCE_ID, DEST_ID))
    if labels:
        found = found.filter(F.col("label").isin(*labels))
    degrees = found.groupBy(ID).agg(F.count("*").alias("degree")).filter(F.col("degree") > chunk)
    pieces = degrees.select(F.col(ID).alias("__hot"), F.ceil(2 * F.col("degree") / chunk).alias("__pieces"))
    dealt = found.join(pieces, F.col(ID) == F.col("__hot"), "left")
    piece = F.coalesce(F.pmod(F.xxhash64("edge", "direction"), F.col("__pieces")), F.lit(0)).alias("piece")
    lists = dealt.select(ID, piece, F.struct("edge", "label", "direction", "other").alias("one")).groupBy(ID, "piece").agg(
        F.sort_array(F.collect_list("one")).alias("all"))
    starts = F.sequence(F.lit(1), F.size("all"), F.lit(chunk))
    parts = lists.select(ID, "piece", "all", F.posexplode(starts).alias("part", "start"))
    return parts.select(ID, "piece", "part", F.slice("all", F.col("start"), F.lit(chunk)).alias("edges"))


def edge_labels(graph: PropertyGraph, **options) -> DataFrame:
    """(_id, label, direction, n): how many edges of each label and direction a vertex has."""
    found = ends(read_elements(graph, EDGE, **options).select(ID, EDGE_LABEL, SOURCE_ID, DEST_ID))
    return found.groupBy(ID, "label", "direction").agg(F.count("*").alias("n"))
