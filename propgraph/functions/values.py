"""Value conversions between written frames and stored properties, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, DataType, DecimalType, MapType, StringType, StructType,
    TimestampNTZType, VariantType,
)

from propgraph.functions.durations import stored_duration
from propgraph.functions.types import PROPERTY_TYPES, property_type


def instant(value: Column) -> Column:
    """A date-time text, with or without zone offset, as a UTC instant.

    Needs the session time zone to be UTC for texts and values without an offset.
    """
    return value.cast("timestamp")


def stored_as_is(dtype: DataType) -> bool:
    """Does a scalar of this type need no conversion to be stored?"""
    if isinstance(dtype, TimestampNTZType):
        return False
    return type(dtype) in PROPERTY_TYPES or isinstance(dtype, (StringType, DecimalType))


def stored_value(value: Column, dtype: DataType) -> Column:
    """A written value in the form it is stored in.

    Most types stay as they are; date-times without zone become instants, durations get
    their text, arrays go element by element, and what no property type can hold
    (maps, nested arrays, intervals) becomes text.
    """
    property_type(dtype)  # rejects structs that are no durations
    if isinstance(dtype, ArrayType):
        element = dtype.elementType
        if stored_as_is(element) and not isinstance(element, BinaryType):
            return value
        if isinstance(element, ArrayType):
            return F.transform(value, lambda v: F.to_json(v))
        if isinstance(element, BinaryType):
            return value.cast("array<string>")
        return F.transform(value, lambda v: stored_value(v, element))
    if isinstance(dtype, StructType):
        return stored_duration(value)
    if isinstance(dtype, TimestampNTZType):
        return instant(value)
    if isinstance(dtype, (MapType, VariantType)):
        return F.to_json(value)
    return value if stored_as_is(dtype) else value.cast("string")
