"""The catalog of a stored graph as a small Parquet table to which rows are only ever appended.

A row notes one thing: a property or a type that came or went, numbers handed out as ids, the number
of buckets, or bytes of visibility expressions that came. The table has the size of the graph's schema and of its inserts without ids; it
is read whole, in the order of its rows' numbers.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from propgraph.operators.catalog import Catalog, ElementType, Property, drop_property, drop_type, register_entries
from propgraph.sources.files import read_table

SCHEMA = StructType([StructField("n", LongType()), StructField("event", StringType()), StructField("entry", StringType())])
PROPERTY, TYPE, DROP_PROPERTY, DROP_TYPE, IDS, BUCKETS, EXPRESSIONS = "property", "type", "drop property", "drop type", "ids", "buckets", "expressions"


@dataclass(frozen=True)
class Noted:
    """What the table says: the catalog, the first free number for an id, the buckets, bytes of expressions, and how many rows said so."""

    catalog: Catalog = Catalog()
    next_id: int = 0
    buckets: int | None = None
    expressions: int = 0
    rows: int = 0


def read_catalog(spark: SparkSession, path: str) -> Noted:
    table = read_table(spark, path, SCHEMA)
    catalog, next_id, buckets, expressions = Catalog(), 0, None, 0
    rows = table.collect() if table is not None else []
    for _, event, text in sorted(rows):
        entry = json.loads(text)
        if event == PROPERTY:
            catalog = register_entries(catalog, properties=[Property(**entry)])
        elif event == TYPE:
            catalog = register_entries(catalog, types=[ElementType(**entry)])
        elif event == DROP_PROPERTY:
            catalog = drop_property(catalog, entry)
        elif event == DROP_TYPE:
            catalog = drop_type(catalog, *entry)
        elif event == IDS:
            next_id = max(next_id, entry)
        elif event == BUCKETS:
            buckets = entry
        else:
            expressions += entry
    return Noted(catalog, next_id, buckets, expressions, len(rows))


def added(old: Catalog, new: Catalog) -> list[tuple[str, object]]:
    """Rows that turn the old catalog into the new one, which has more entries."""
    return [(PROPERTY, asdict(p)) for p in new.properties if p not in old.properties] + [
        (TYPE, asdict(t)) for t in new.types if t not in old.types]


def note(spark: SparkSession, path: str, known: Noted, events: Iterable[tuple[str, object]]) -> Noted:
    """Append the events; returns what was known with the rows that there are by then."""
    rows = [(known.rows + k, event, json.dumps(entry)) for k, (event, entry) in enumerate(events)]
    if rows:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return replace(known, rows=known.rows + len(rows))
