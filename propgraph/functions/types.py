"""Property types of the catalog and the Spark types they stand for, both ways."""

from __future__ import annotations

import re

from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType,
    FloatType, IntegerType, LongType, ShortType, StringType, StructField, StructType,
    TimestampNTZType, TimestampType,
)

DURATION_KIND = "duration"

# Fixed value: the duration struct.
DURATION = StructType([
    StructField("type", StringType(), False),
    StructField("months", LongType(), False),
    StructField("days", LongType(), False),
    StructField("seconds", LongType(), False),
    StructField("nanoseconds", IntegerType(), False),
    StructField("value", StringType(), False),
])

# Property type name -> Spark type. `<name>_ARRAY` is an array of it.
SPARK_TYPES: dict[str, DataType] = {
    "BOOLEAN": BooleanType(),
    "INTEGER": IntegerType(),
    "LONG": LongType(),
    "SHORT": ShortType(),
    "BYTE": ByteType(),
    "FLOAT": FloatType(),
    "DOUBLE": DoubleType(),
    "DATE": TimestampType(),
    "DATETIME": TimestampType(),
    "LOCAL_DATE": DateType(),
    "LOCAL_DATETIME": TimestampType(),
    "STREAMING": BinaryType(),
    "STRING": StringType(),
    "DURATION": DURATION,
}

# Spark type -> property type name, where a name of its own exists.
PROPERTY_TYPES: dict[type[DataType], str] = {
    BooleanType: "BOOLEAN",
    IntegerType: "INTEGER",
    LongType: "LONG",
    ShortType: "SHORT",
    ByteType: "BYTE",
    FloatType: "FLOAT",
    DoubleType: "DOUBLE",
    TimestampType: "LOCAL_DATETIME",
    TimestampNTZType: "LOCAL_DATETIME",
    DateType: "LOCAL_DATE",
    BinaryType: "STREAMING",
}

# Casts that lose nothing: from type -> wider types.
WIDENINGS = {
    "BYTE": ("SHORT", "INTEGER", "LONG", "FLOAT", "DOUBLE"),
    "SHORT": ("INTEGER", "LONG", "FLOAT", "DOUBLE"),
    "INTEGER": ("LONG", "DOUBLE"),
    "FLOAT": ("DOUBLE",),
}

_ARRAY = "_ARRAY"
_DECIMAL = re.compile(r"DECIMAL\((\d+),(\d+)\)")


def is_duration(dtype: DataType) -> bool:
    """A struct with the duration's fields; the text field may be missing."""
    if not isinstance(dtype, StructType):
        return False
    fields = DURATION.fieldNames()
    return dtype.fieldNames() in (fields, fields[:-1])


def holds_duration(dtype: DataType) -> bool:
    return is_duration(dtype.elementType if isinstance(dtype, ArrayType) else dtype)


def property_type(dtype: DataType) -> str:
    """Catalog type name for a Spark type. Types without a name of their own are text."""
    if isinstance(dtype, ArrayType):
        inner = dtype.elementType
        return "STRING_ARRAY" if isinstance(inner, (ArrayType, BinaryType)) else property_type(inner) + _ARRAY
    if isinstance(dtype, StructType):
        if not is_duration(dtype):
            raise ValueError(f"A struct property must be a duration, not {dtype.simpleString()}")
        return "DURATION"
    if isinstance(dtype, DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    return PROPERTY_TYPES.get(type(dtype), "STRING")


def spark_type(name: str) -> DataType:
    """Spark type for a catalog type name. Unknown names read as text."""
    if name.endswith(_ARRAY):
        element = name[: -len(_ARRAY)]
        known = element in SPARK_TYPES or _DECIMAL.fullmatch(element)
        return ArrayType(spark_type(element)) if known else StringType()
    decimal = _DECIMAL.fullmatch(name)
    if decimal:
        return DecimalType(int(decimal[1]), int(decimal[2]))
    return SPARK_TYPES.get(name, StringType())


def widens(source: str, target: str) -> bool:
    """Can values of one property type be stored as the other without loss?"""
    if source.endswith(_ARRAY) and target.endswith(_ARRAY):
        return widens(source[: -len(_ARRAY)], target[: -len(_ARRAY)])
    return source == target or target in WIDENINGS.get(source, ())


def same_type(left: DataType, right: DataType) -> bool:
    """Equal but for nullability."""
    return left.simpleString() == right.simpleString()
