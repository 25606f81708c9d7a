"""Vertices and edges as wide DataFrames: assembly, scans, fetch presets, visibility."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from propgraph.columns import (
    BOOKKEEPING, BUCKET, EDGE, HIDDEN, ID, RESERVED, VERTEX, VISIBILITY, named, null_of, reserved_columns,
)
from propgraph.functions.types import same_type
from propgraph.functions.values import stored_as_is, stored_value
from propgraph.functions.visibility import is_expression, is_plain, permits
from propgraph.operators.catalog import (
    CONCEPT, RELATIONSHIP, Catalog, conflicting_casts, infer_schema, register_properties,
    register_types,
)
from propgraph.options import HINT_WITH_HIDDEN, HINTS_WITH_PROPERTIES, GraphOptions
from propgraph.sources.files import empty


_ALLOWED = "__allowed"
#: Tasks up to which a stored frame is laid out by filters, and ids sampled for each cut between ranges.
UNSHUFFLED, CUT_SAMPLE = 64, 100


@dataclass(frozen=True)
class PropertyGraph:
    """Lazy vertex and edge frames with the catalog that describes them.

    `expressions`, if known: a small table (_visibility) of all visibilities that hold operators.
    """

    catalog: Catalog
    vertices: DataFrame
    edges: DataFrame
    expressions: DataFrame | None = None
    #: Are the frames tables in buckets, sorted by id?
    stored: bool = False

    def frame(self, element_type: str) -> DataFrame:
        return self.vertices if element_type == VERTEX else self.edges


def project(frame: DataFrame, schema: StructType, keep: Iterable[str] | None = None) -> DataFrame:
    """Columns of `schema` by name and in its order; names the frame lacks are null.

    With `keep`, only those names keep their values and all others read as null.
    """
    types = {f.name: f.dataType for f in frame.schema.fields}

    def column(field: StructField) -> Column:
        if field.name not in types or (keep is not None and field.name not in keep):
            value = null_of(field.dataType)
        elif same_type(types[field.name], field.dataType):
            value = named(field.name)
        else:
            value = named(field.name).cast(field.dataType)
        return value.alias(field.name)

    return frame.select(*[column(f) for f in schema.fields])


def assemble(
    spark: SparkSession, frames: Sequence[DataFrame], element_type: str, catalog: Catalog | None = None
) -> tuple[DataFrame, Catalog]:
    """One wide frame over several frames of elements, with the catalog grown to fit.

    Each property has the type it was first registered with; narrower columns are cast
    before the union, conflicting ones rejected.
    """
    catalog = catalog or Catalog()
    if not frames:
        fields = [StructField(c, StringType()) for c in reserved_columns(element_type)]
        return empty(spark, StructType(fields)), catalog
    stored = []
    for frame in frames:
        schema = frame.schema
        catalog = register_properties(catalog, schema)
        casts = conflicting_casts(catalog, schema)
        changes = {}
        for field in schema.fields:
            if field.name in RESERVED or field.name in BOOKKEEPING:
                continue
            value = stored_value(named(field.name), field.dataType)
            if field.name in casts:
                value = value.cast(casts[field.name])
            if field.name in casts or not stored_as_is(field.dataType):
                changes[field.name] = value
        stored.append(frame.withColumns(changes) if changes else frame)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stored), catalog


def graph_of(
    spark: SparkSession, vertices: Sequence[DataFrame] = (), edges: Sequence[DataFrame] = (),
    concepts: Iterable[str] = (), labels: Iterable[str] = (), catalog: Catalog | None = None,
) -> PropertyGraph:
    """A graph over frames that already carry the reserved columns."""
    vertex_frame, catalog = assemble(spark, vertices, VERTEX, catalog)
    edge_frame, catalog = assemble(spark, edges, EDGE, catalog)
    catalog = register_types(catalog, CONCEPT, concepts)
    catalog = register_types(catalog, RELATIONSHIP, labels)
    return PropertyGraph(catalog, vertex_frame, edge_frame)


def visible(frame: DataFrame, authorizations: Iterable[str] = (), include_hidden: bool = False, expressions: DataFrame | None = None) -> DataFrame:
    """Elements whose visibility the authorizations satisfy, and that are not hidden.

    Plain terms are compared by the scan; only what holds an operator is evaluated. With `expressions`, a table
    (_visibility) of all that do, each is evaluated once and looked up.
    """
    if VISIBILITY in frame.columns:
        token, authorizations = named(VISIBILITY), tuple(authorizations)
        plain = token.isNull() | token.isin("", *filter(is_plain, authorizations))
        frame = frame.filter(plain | is_expression(token))
        if expressions is None:
            frame = frame.filter(permits(token, authorizations))
        else:
            allowed = expressions.filter(permits(named(VISIBILITY), authorizations)).select(named(VISIBILITY).alias(_ALLOWED))
            frame = frame.join(allowed, token == F.col(_ALLOWED), "left").filter(plain | F.col(_ALLOWED).isNotNull()).drop(_ALLOWED)
    if HIDDEN in frame.columns and not include_hidden:
        frame = frame.filter(named(HIDDEN).isNull() | (named(HIDDEN) == F.lit(False)))
    return frame


def _in_parts(frame: DataFrame, conditions: Sequence[Column]) -> DataFrame:
    """The rows of each condition as a task of its own, read where they lie: no shuffle.

    The last may be two: Spark makes one task of a union whose sides are all single tasks.
    """
    parts = [frame.filter(c).coalesce(2 if k == len(conditions) - 1 else 1) for k, c in enumerate(conditions)]
    return reduce(lambda a, b: a.union(b), parts)


def id_cuts(frame: DataFrame, parts: int) -> list[str]:
    """Ids that cut the frame into about equal ranges, from a sample of bounded size: the ids of least hash."""
    sample = sorted(r[0] for r in frame.select(ID).orderBy(F.xxhash64(ID), ID).limit(CUT_SAMPLE * parts).collect())
    return sorted({sample[k * len(sample) // parts] for k in range(1, parts)}) if sample else []


def distribute(
    frame: DataFrame, strategy: str, partitions: int | None = None,
    max_ranges: int | None = None, stored: bool = False,
) -> DataFrame:
    """Lay out a scan's rows over tasks. Each row comes once.

    `none`, and `shard` without a count, keep the file splits: no shuffle. `shard` with a count hashes by id;
    `range` cuts the ids into as many ranges as asked for, or as there are shuffle partitions; `max_ranges`, if
    given, limits them.

    A stored frame isn't shuffled for that, up to UNSHUFFLED tasks: its shards are groups of its buckets, read by
    partition filters; its ranges are filters on the id, which skip row groups and pages as files are sorted by id.
    """
    if strategy == "shard" and partitions:
        buckets = sorted(r[0] for r in frame.select(BUCKET).distinct().collect()) if stored else []
        if stored and partitions <= min(len(buckets), UNSHUFFLED):
            return _in_parts(frame, [F.col(BUCKET).isin(*buckets[k::partitions]) for k in range(partitions)])
        return frame.repartition(partitions, ID)
    if strategy == "range":
        wanted = partitions or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        wanted = max(1, min(wanted, max_ranges or wanted))
        if stored and wanted <= UNSHUFFLED:
            edges = [None, *id_cuts(frame, wanted), None]
            low = [named(ID) >= c if c is not None else F.lit(True) for c in edges[:-1]]
            high = [named(ID) < c if c is not None else F.lit(True) for c in edges[1:]]
            return _in_parts(frame, [a & b for a, b in zip(low, high, strict=True)])
        return frame.repartitionByRange(wanted, ID)
    return frame


def read_elements(
    graph: PropertyGraph,
    element_type: str,
    authorizations: Iterable[str] = (),
    fetch_hints: str = "ALL",
    partitioning: str = "shard",
    partitions: int | None = None,
    schema: StructType | None = None,
    max_ranges: int | None = None,
) -> DataFrame:
    """All visible elements of one kind as a wide frame, one row each.

    The columns are the inferred ones or those of `schema`. One lazy plan: filters and
    column selections put on the result reach the scan below it.
    """
    options = GraphOptions(
        element_type, tuple(authorizations), fetch_hints=fetch_hints, partitioning=partitioning
    )
    frame = visible(
        graph.frame(element_type), options.authorizations, options.fetch_hints == HINT_WITH_HIDDEN, graph.expressions
    )
    fetched = None if options.fetch_hints in HINTS_WITH_PROPERTIES else reserved_columns(element_type)
    schema = schema or infer_schema(graph.catalog, element_type)
    if graph.stored:  # by filters below the projection
        return project(distribute(frame, options.partitioning, partitions, max_ranges, True), schema, fetched)
    return distribute(project(frame, schema, fetched), options.partitioning, partitions, max_ranges)
