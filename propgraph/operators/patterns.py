"""Create graph patterns from rows: several vertices and the edges between them a row, in one call.

Ids are made of a node's concept and key values, so equal keys are one vertex, edges know their ends without
a join, and a call that died can simply be run again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.columns import CONCEPT_TYPE, DEST_ID, EDGE_LABEL, ID, SOURCE_ID, named


@dataclass(frozen=True)
class Node:
    """A vertex of each row: its concept, the columns that tell it from others, and the properties it gets (name: column)."""

    concept: str
    key: Sequence[str]
    properties: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Link:
    """An edge of each row from one node to another, by their names; `key` tells edges of the same ends and label apart."""

    source: str
    label: str
    target: str
    properties: Mapping[str, str] = field(default_factory=dict)
    key: Sequence[str] = ()


def _joined(parts: Sequence[Column], mark: str) -> Column:
    """Texts with a mark between, doubled inside them; null if any is."""
    inner = [F.replace(p.cast("string"), F.lit(mark), F.lit(2 * mark)) for p in parts]
    return reduce(lambda a, b: F.concat(a, F.lit(mark), b), inner)


def node_id(node: Node) -> Column:
    """concept:key:key, null if a key is: then the row has no such vertex."""
    return _joined([F.lit(node.concept), *map(named, node.key)], ":")


def pattern_vertices(rows: DataFrame, nodes: Mapping[str, Node]) -> DataFrame:
    """The vertices of all rows: each once. A key that comes with different properties has a row for each."""
    parts = []
    for node in nodes.values():
        own = rows.select(node_id(node).alias(ID), F.lit(node.concept).alias(CONCEPT_TYPE), *(named(c).alias(p) for p, c in node.properties.items()))
        parts.append(own.filter(named(ID).isNotNull()))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).distinct()


def pattern_edges(rows: DataFrame, nodes: Mapping[str, Node], links: Sequence[Link]) -> DataFrame:
    """The edges of all rows: each once, without those of which an end is missing."""
    parts = []
    for link in links:
        ends = [node_id(nodes[link.source]), node_id(nodes[link.target])]
        own = rows.select(
            _joined([F.lit(link.label), *ends, *map(named, link.key)], "|").alias(ID), F.lit(link.label).alias(EDGE_LABEL),
            ends[0].alias(SOURCE_ID), ends[1].alias(DEST_ID), *(named(c).alias(p) for p, c in link.properties.items()))
        parts.append(own.filter(named(ID).isNotNull()))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).distinct()
