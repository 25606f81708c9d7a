"""Property graphs as Spark DataFrames."""

from propgraph.api import create_edges, create_patterns, create_vertices, load, save
from propgraph.columns import EDGE, VERTEX
from propgraph.functions.durations import duration, duration_seconds, make_duration
from propgraph.operators.match import match_edges, match_vertices, where
from propgraph.operators.patterns import Link, Node
from propgraph.operators.references import edge_labels, edge_references
from propgraph.options import GraphOptions
from propgraph.sources.elements import PropertyGraph, graph_of, read_elements
from propgraph.sources.store import GraphStore

__all__ = [
    "EDGE", "VERTEX", "GraphOptions", "GraphStore", "Link", "Node", "PropertyGraph", "create_edges", "create_patterns",
    "create_vertices", "duration", "duration_seconds", "edge_labels", "edge_references", "graph_of", "load", "make_duration",
    "match_edges", "match_vertices", "read_elements", "save", "where",
]
