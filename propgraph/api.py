"""Entry points that take option maps, for stored graphs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from propgraph.columns import EDGE, VERTEX
from propgraph.operators.patterns import Link, Node, pattern_edges, pattern_vertices
from propgraph.options import (
    CONCEPT_TYPE_OPTION, ELEMENT_TYPE, LABEL_TYPE_OPTION, GraphOptions,
)
from propgraph.sources.elements import read_elements
from propgraph.sources.store import GraphStore


def load(
    spark: SparkSession, root: str, options: Mapping[str, str],
    schema: StructType | None = None, partitions: int | None = None, max_ranges: int | None = None,
) -> DataFrame:
    """Vertices or edges of the graph stored at `root`, as the options say; `partitions` and `max_ranges` as in `read_elements`."""
    resolved = GraphOptions.resolve(spark, options)
    return read_elements(
        GraphStore(spark, root).graph(), resolved.element_type, resolved.authorizations,
        resolved.fetch_hints, resolved.partitioning, partitions, schema, max_ranges,
    )


def save(
    batch: DataFrame, root: str, options: Mapping[str, str], mode: str = "append",
    where: Column | None = None, type_from_column: bool = False, order_by: str | None = None,
    allow_lossy: bool = False,
) -> None:
    """Write vertices or edges into the graph stored at `root`; see `GraphStore.write`."""
    spark = batch.sparkSession
    GraphStore(spark, root).write(
        batch, GraphOptions.resolve(spark, options), mode, where, type_from_column, order_by, allow_lossy
    )


def create_vertices(batch: DataFrame, root: str, concept: str) -> None:
    """Insert (or, with `_id`, upsert) vertices of one concept."""
    save(batch, root, {ELEMENT_TYPE: VERTEX, CONCEPT_TYPE_OPTION: concept})


def create_patterns(rows: DataFrame, root: str, nodes: Mapping[str, Node], links: Sequence[Link] = ()) -> None:
    """Create (or update) the vertices and edges that a pattern makes of each row.

    A vertex is told from others by its key columns, an edge by its ends, label and key; equal ones are one.
    Where a key is null, the row has no such vertex, nor its edges. A key with different properties is an error.
    Properties that other nodes of the call have and a node hasn't are cleared in it. Vertices come first;
    a call that died is run again.
    """
    for link in links:
        for end in (link.source, link.target):
            if end not in nodes:
                raise ValueError(f"No node '{end}' for edge '{link.label}'")
    spark = rows.sparkSession
    store = GraphStore(spark, root)
    if nodes:
        store.write(pattern_vertices(rows, nodes), GraphOptions(VERTEX), type_from_column=True)
    if links:
        store.write(pattern_edges(rows, nodes, links), GraphOptions(EDGE), type_from_column=True)


def create_edges(batch: DataFrame, root: str, label: str) -> None:
    """Insert (or, with `_id`, upsert) edges of one label."""
    save(batch, root, {ELEMENT_TYPE: EDGE, LABEL_TYPE_OPTION: label})
