"""Select elements by type, property values and predicates."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_json_string

from propgraph.columns import EDGE, VERTEX, column_or_null, length_column, named, type_column
from propgraph.functions.durations import duration_seconds
from propgraph.functions.types import holds_duration
from propgraph.sources.elements import PropertyGraph, read_elements

# Fixed value: the message.
DURATION_FILTER = "Duration filters not supported"
#: Expressions that order or equate their operands.
_COMPARISONS = {
    "EqualTo", "EqualNullSafe", "LessThan", "LessThanOrEqual", "GreaterThan", "GreaterThanOrEqual", "In", "InSet",
    "Greatest", "Least", "SortArray", "ArrayContains", "ArrayMax", "ArrayMin", "ArrayDistinct",
}


def _compares_durations(condition) -> bool:
    """Does an analysed expression compare, look up or sort values that are durations or arrays of them?"""
    waiting = [condition]
    while waiting:
        node = waiting.pop()
        children = node.children()
        own = [children.apply(k) for k in range(children.size())]
        if node.getClass().getSimpleName() in _COMPARISONS and any(
            holds_duration(_parse_datatype_json_string(child.dataType().json())) for child in own
        ):
            return True
        waiting += own
    return False


def where(frame: DataFrame, predicate: Column | str) -> DataFrame:
    """`filter`, but comparing a duration raises instead of comparing field by field.

    Null tests of durations and comparisons of their parts are fine; to order durations, compare
    `duration_seconds`.
    """
    matched = frame.filter(predicate)
    if any(holds_duration(f.dataType) for f in frame.schema.fields):
        if _compares_durations(matched._jdf.queryExecution().analyzed().condition()):
            raise ValueError(DURATION_FILTER)
    return matched


def _match(
    graph: PropertyGraph, element_type: str, type_name: str | None,
    properties: Mapping[str, object] | None, predicate: Column | str | None, options: dict,
) -> DataFrame:
    frame = read_elements(graph, element_type, **options)
    if type_name is not None:
        frame = frame.filter(named(type_column(element_type)) == type_name)
    types = {f.name: f.dataType for f in frame.schema.fields}
    for name, value in (properties or {}).items():
        if name in types and holds_duration(types[name]):
            raise ValueError(DURATION_FILTER)
        frame = frame.filter(column_or_null(frame, name) == F.lit(value))
    return frame if predicate is None else where(frame, predicate)


def match_vertices(
    graph: PropertyGraph, concept: str | None = None, properties: Mapping[str, object] | None = None,
    predicate: Column | str | None = None, **options,
) -> DataFrame:
    """Vertices of a concept whose properties equal the given values and meet the predicate.

    A property no vertex has matches nothing. `options` are those of `read_elements`.
    """
    return _match(graph, VERTEX, concept, properties, predicate, options)


def lasting(
    graph: PropertyGraph, element_type: str, name: str, low: Decimal | int | None = None, high: Decimal | int | None = None, **options,
) -> DataFrame:
    """Elements whose duration property is at least `low` and at most `high` seconds long (months as in `duration_seconds`).

    Where the length is stored beside the duration, the scan skips by it what can't be in the range.
    `options` are those of `read_elements`.
    """
    frame, bounds = graph.frame(element_type), ((low, 0), (high, 1))
    for bound, upper in bounds:
        if bound is not None:
            length = duration_seconds(named(name))
            frame = frame.filter(length <= F.lit(bound) if upper else length >= F.lit(bound))
            if length_column(name) in frame.columns:
                whole = F.lit(math.floor(bound)).cast("bigint")
                frame = frame.filter(named(length_column(name)) <= whole if upper else named(length_column(name)) >= whole)
    return read_elements(replace(graph, **{"vertices" if element_type == VERTEX else "edges": frame}), element_type, **options)


def match_edges(
    graph: PropertyGraph, label: str | None = None, properties: Mapping[str, object] | None = None,
    predicate: Column | str | None = None, **options,
) -> DataFrame:
    """Edges of a label whose properties equal the given values and meet the predicate."""
    return _match(graph, EDGE, label, properties, predicate, options)
