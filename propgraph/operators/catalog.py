"""The property catalog: which properties, concepts and edge labels a graph has.

The catalog is metadata of the size of a schema (one entry per property name and per
element type), so like a StructType it lives on the driver; `properties_frame` and
`types_frame` show it as DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass, fields, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, DataType, StringType, StructField, StructType

from propgraph.columns import BOOKKEEPING, RESERVED, ROOT_CONCEPT, reserved_columns
from propgraph.functions.types import property_type, same_type, spark_type, widens

CONCEPT = "concept"
RELATIONSHIP = "relationship"


@dataclass(frozen=True)
class Property:
    """One property name, with the one type it has everywhere in the graph."""

    name: str
    type: str
    display_name: str
    concept: str = ROOT_CONCEPT
    system_property: bool = False
    user_visible: bool | None = True
    searchable: bool = True
    updatable: bool = True
    addable: bool = True
    text_hint: str = "EXACT_MATCH"
    column: str = ""  # column of the stored files; differs from the name after drop and re-use

    @property
    def spark_type(self) -> DataType:
        return spark_type(self.type)


@dataclass(frozen=True)
class ElementType:
    """A concept (type of vertices) or relationship (label of edges)."""

    kind: str
    name: str
    display_name: str
    parent: str | None = None
    source: str | None = None
    target: str | None = None
    user_visible: bool = True


def _row_schema(entry: type) -> StructType:
    flags = ("bool", "bool | None")
    return StructType([
        StructField(f.name, BooleanType() if f.type in flags else StringType()) for f in fields(entry)
    ])


PROPERTIES_SCHEMA = _row_schema(Property)
TYPES_SCHEMA = _row_schema(ElementType)


@dataclass(frozen=True)
class Catalog:
    properties: tuple[Property, ...] = ()
    types: tuple[ElementType, ...] = (ElementType(CONCEPT, ROOT_CONCEPT, ROOT_CONCEPT),)
    retired_columns: tuple[str, ...] = ()

    def find(self, name: str) -> Property | None:
        return self._by_name.get(name)

    @cached_property
    def _by_name(self) -> dict[str, Property]:
        return {p.name: p for p in self.properties}

    def has_type(self, kind: str, name: str) -> bool:
        return any(t.kind == kind and t.name == name for t in self.types)


def register_properties(catalog: Catalog, schema: StructType) -> Catalog:
    """Add the columns the catalog does not know yet; a known name keeps its type.

    Reserved and bookkeeping columns are no properties.
    """
    known = {p.name for p in catalog.properties}
    spellings = {name.lower(): name for name in known}
    added = []
    for field in schema.fields:
        if field.name in known or field.name in RESERVED or field.name in BOOKKEEPING:
            continue
        other = spellings.setdefault(field.name.lower(), field.name)
        if other != field.name:
            raise ValueError(f"Property '{field.name}' differs from '{other}' only by case")
        known.add(field.name)
        added.append(_new_property(catalog, field))
    return replace(catalog, properties=catalog.properties + tuple(added)) if added else catalog


def _new_property(catalog: Catalog, field: StructField) -> Property:
    uses = sum(1 for c in catalog.retired_columns if c.rsplit("@", 1)[0] == field.name)
    return Property(
        name=field.name,
        type=property_type(field.dataType),
        display_name=field.name,
        text_hint="ALL" if isinstance(field.dataType, StringType) else "EXACT_MATCH",
        column=f"{field.name}@{uses}" if uses else field.name,
    )


def register_entries(catalog: Catalog, properties: Iterable[Property] = (), types: Iterable[ElementType] = ()) -> Catalog:
    """Add whole entries, as they are."""
    return replace(catalog, properties=(*catalog.properties, *properties), types=(*catalog.types, *types))


def register_types(catalog: Catalog, kind: str, names: Iterable[str]) -> Catalog:
    """Add concepts below the root concept, or relationships from and to it."""
    added = []
    for name in sorted(set(names)):
        if catalog.has_type(kind, name):
            continue
        if kind == CONCEPT:
            added.append(ElementType(CONCEPT, name, name, parent=ROOT_CONCEPT))
        else:
            added.append(ElementType(RELATIONSHIP, name, name, source=ROOT_CONCEPT, target=ROOT_CONCEPT))
    return replace(catalog, types=catalog.types + tuple(added)) if added else catalog


def infer_schema(catalog: Catalog, element_type: str) -> StructType:
    """Schema of vertices or edges: every user-visible property of the whole graph.

    Fixed order: reserved columns first, then the properties from Z to A.
    """
    visible = (p for p in catalog.properties if p.user_visible)
    shown = sorted(visible, key=lambda p: p.name, reverse=True)
    reserved = reversed(reserved_columns(element_type))
    return StructType(
        [StructField(name, StringType(), False) for name in reserved]
        + [StructField(p.name, p.spark_type) for p in shown]
    )


def conflicting_casts(catalog: Catalog, schema: StructType, allow_lossy: bool = False) -> dict[str, DataType]:
    """Columns whose type differs from the catalog's, with the type to cast them to.

    Only casts that lose nothing are made unasked; other conflicts raise.
    """
    casts = {}
    for field in schema.fields:
        known = catalog.find(field.name)
        if known is None or same_type(field.dataType, known.spark_type):
            continue
        written = property_type(field.dataType)
        readable = same_type(spark_type(written), known.spark_type)
        if not (readable or allow_lossy or widens(written, known.type)):
            raise ValueError(f"Property '{field.name}' is {known.type} in the catalog, not {written}")
        casts[field.name] = known.spark_type
    return casts


def drop_property(catalog: Catalog, name: str) -> Catalog:
    """Forget a property. Its stored column is never used again, so nothing is rewritten."""
    gone = catalog.find(name)
    if gone is None:
        raise ValueError(f"No property '{name}'")
    return replace(
        catalog,
        properties=tuple(p for p in catalog.properties if p.name != name),
        retired_columns=catalog.retired_columns + (gone.column or gone.name,),
    )


def drop_type(catalog: Catalog, kind: str, name: str) -> Catalog:
    """Forget a concept or relationship; elements of that type stay. The root concept is kept."""
    if kind == CONCEPT and name == ROOT_CONCEPT:
        raise ValueError(f"The root concept '{ROOT_CONCEPT}' cannot be dropped")
    if not catalog.has_type(kind, name):
        raise ValueError(f"No {kind} '{name}'")
    kept = tuple(t for t in catalog.types if not (t.kind == kind and t.name == name))
    return replace(catalog, types=kept)


def properties_frame(spark: SparkSession, catalog: Catalog) -> DataFrame:
    """The catalog's properties, one row each."""
    return spark.createDataFrame([tuple(asdict(p).values()) for p in catalog.properties], PROPERTIES_SCHEMA)


def types_frame(spark: SparkSession, catalog: Catalog, kind: str) -> DataFrame:
    """The catalog's concepts or relationships, one row each."""
    rows = [tuple(asdict(t).values()) for t in catalog.types if t.kind == kind]
    return spark.createDataFrame(rows, TYPES_SCHEMA)


def list_properties(spark: SparkSession, catalog: Catalog) -> DataFrame:
    return properties_frame(spark, catalog).select("name", "type")


def list_concepts(spark: SparkSession, catalog: Catalog) -> DataFrame:
    return types_frame(spark, catalog, CONCEPT).select("name", "parent")


def list_labels(spark: SparkSession, catalog: Catalog) -> DataFrame:
    return types_frame(spark, catalog, RELATIONSHIP).select("name", "source", "target")
