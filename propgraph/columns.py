"""Reserved element columns and small column helpers shared by the whole package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

VERTEX = "VERTEX"
EDGE = "EDGE"

# The reserved column names and the default type names.
ID = "_id"
SOURCE_ID = "_sid"
DEST_ID = "_did"
CONCEPT_TYPE = "_conceptType"
EDGE_LABEL = "_edgeLabel"
RESERVED = (ID, SOURCE_ID, DEST_ID, CONCEPT_TYPE, EDGE_LABEL)
ROOT_CONCEPT = "thing"
DEFAULT_LABEL = "hasEntity"

# Bookkeeping columns of this library: who may see an element, is it hidden, and which
# bucket of a stored graph it is in.
VISIBILITY = "_visibility"
HIDDEN = "_hidden"
BUCKET = "_bucket"
BOOKKEEPING = (VISIBILITY, HIDDEN, BUCKET)


def length_column(name: str) -> str:
    """Where a stored duration's length is kept."""
    return f"{name}@seconds"


def type_column(element_type: str) -> str:
    """The column that names an element's concept or label."""
    return CONCEPT_TYPE if element_type == VERTEX else EDGE_LABEL


def reserved_columns(element_type: str) -> tuple[str, ...]:
    """Reserved columns an element of this kind carries."""
    if element_type == VERTEX:
        return (ID, CONCEPT_TYPE)
    return (ID, EDGE_LABEL, SOURCE_ID, DEST_ID)


def named(name: str, qualifier: str | None = None) -> Column:
    """A top-level column by its literal name, dots and backticks included."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{qualifier}.{quoted}" if qualifier else quoted)


def null_of(dtype: DataType) -> Column:
    return F.lit(None).cast(dtype)


def column_or_null(frame: DataFrame, name: str, dtype: DataType | str = "string") -> Column:
    """The frame's column of that name, or a typed null where the frame lacks it."""
    return named(name) if name in frame.columns else F.lit(None).cast(dtype)


def property_columns(frame: DataFrame) -> list[str]:
    """Every column that is neither reserved nor bookkeeping."""
    return [c for c in frame.columns if c not in RESERVED and c not in BOOKKEEPING]


def is_true(predicate: Column) -> Column:
    """SQL WHERE semantics as a plain boolean: unknown counts as false."""
    return F.coalesce(predicate, F.lit(False))
