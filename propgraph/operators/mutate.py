"""Changes to elements as frame-to-frame functions; the store persists their results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propgraph.columns import (
    DEST_ID, EDGE, HIDDEN, ID, SOURCE_ID, VISIBILITY, is_true, named, property_columns, type_column,
)
from propgraph.functions.values import stored_value
from propgraph.functions.visibility import well_formed
from propgraph.operators.catalog import Catalog, conflicting_casts

_BASE = "base"
_BATCH = "batch"
_WRITTEN = "__written"
_FILE, _PLACE, _FIRST = "__file", "__place", "__first"
#: Ids of more digits are never handed out.
_DIGITS = 37


def _present(value: Column, name: str) -> Column:
    """The value, or an error where it is null."""
    return F.coalesce(value, F.raise_error(F.lit(f"Column {name} must not be null")))


def prepare(
    batch: DataFrame, element_type: str, default_type: str, catalog: Catalog,
    type_from_column: bool = False, allow_lossy: bool = False,
) -> DataFrame:
    """A written frame as elements: reserved columns, then properties in stored form.

    The type is `default_type` whatever the frame says, unless `type_from_column`. Edges
    need `_sid` and `_did`. `catalog` must know every property already.
    """
    if element_type == EDGE:
        for name in (SOURCE_ID, DEST_ID):
            if name not in batch.columns:
                raise ValueError(f"Schema does not contain {name} column for edge")
    kind = type_column(element_type)
    own_type = F.lit(default_type)
    if type_from_column and kind in batch.columns:
        given = named(kind).cast("string")
        own_type = F.when(F.trim(given) != "", given).otherwise(own_type)

    columns = []
    if ID in batch.columns:
        columns.append(_present(named(ID).cast("string"), ID).alias(ID))
    columns.append(own_type.alias(kind))
    if element_type == EDGE:
        columns += [_present(named(c).cast("string"), c).alias(c) for c in (SOURCE_ID, DEST_ID)]
    if VISIBILITY in batch.columns:
        columns.append(well_formed(F.coalesce(named(VISIBILITY).cast("string"), F.lit(""))).alias(VISIBILITY))
    if HIDDEN in batch.columns:
        columns.append(is_true(named(HIDDEN)).alias(HIDDEN))

    casts = conflicting_casts(catalog, batch.schema, allow_lossy)
    types = {f.name: f.dataType for f in batch.schema.fields}
    for name in property_columns(batch):
        value = stored_value(named(name), types[name])
        columns.append((value.cast(casts[name]) if name in casts else value).alias(name))
    return batch.select(*columns)


def assign_ids(written: DataFrame, start: int) -> DataFrame:
    """Give each row of a written Parquet table the next whole number from `start` up, as text, without gaps.

    A row's number is the rows in the files before its own, plus its place in its file: files are fixed, so
    tasks that run again give the same ids. The rows are counted by file, and only these counts are sent around.
    """
    file, place = F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_PLACE)
    before = Window.orderBy(_FILE).rowsBetween(Window.unboundedPreceding, -1)
    counts = written.groupBy(file).agg(F.count("*").alias("n"))
    firsts = counts.select(_FILE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_FIRST))
    numbered = written.select("*", file, place).join(F.broadcast(firsts), _FILE)  # a row per file
    number = F.lit(str(start)).cast("decimal(38,0)") + (F.col(_FIRST) + F.col(_PLACE)).cast("decimal(38,0)")
    return numbered.select(number.cast("string").alias(ID), *[named(c) for c in written.columns])


def check_ids(frame: DataFrame, may_repeat: bool = True) -> int:
    """The highest number among a frame's ids, -1 if none is one; raises if two rows have one id.

    Only ids are read; where they can't repeat, nothing is shuffled.
    """
    number = F.max(F.when(F.length(ID) <= _DIGITS, F.expr(f"try_cast({ID} AS decimal(38, 0))"))).alias("highest")
    if not may_repeat:
        highest = frame.agg(number).first().highest
        return -1 if highest is None else int(highest)
    counts = frame.groupBy(ID).agg(F.count("*").alias("n"))
    found = counts.agg(number, F.max_by(ID, "n").alias("id"), F.max("n").alias("n")).first()
    if (found.n or 0) > 1:
        raise ValueError(f"More than one row in the batch for _id {found.id}")
    return -1 if found.highest is None else int(found.highest)


def last_of_each_id(batch: DataFrame, order_by: str) -> DataFrame:
    """Of the rows of each id the one with the highest value (equal values: the highest hash).

    An aggregate, so copies of a hot id collapse before the shuffle.
    """
    others = [c for c in batch.columns if c != ID]
    rank = F.struct(named(order_by), F.xxhash64(*[named(c) for c in others]))
    best = F.max_by(F.struct(*[named(c) for c in others]), rank).alias("row")
    values = {ID: named(ID), **{c: F.col("row").getField(c) for c in others}}
    return batch.groupBy(ID).agg(best).select(*[values[c].alias(c) for c in batch.columns])


def append_elements(base: DataFrame, batch: DataFrame) -> DataFrame:
    """Base and batch together; columns one side lacks are null there."""
    return base.unionByName(batch, allowMissingColumns=True)


def _merged_columns(base: DataFrame, batch: DataFrame) -> list[Column]:
    """For each column: the batch's value where the batch wrote the row and has the column."""
    names = base.columns + [c for c in batch.columns if c not in base.columns]
    written = F.col(_WRITTEN).isNotNull()
    merged = []
    for name in names:
        if name not in batch.columns:
            value = named(name, _BASE)
        elif name == ID:
            value = F.coalesce(named(name, _BATCH), named(name, _BASE))
        elif name not in base.columns:
            value = named(name, _BATCH)
        else:
            value = F.when(written, named(name, _BATCH)).otherwise(named(name, _BASE))
        merged.append(value.alias(name))
    return merged


def update_matched(base: DataFrame, batch: DataFrame) -> DataFrame:
    """Only the updates of an upsert: base rows, those in the batch with its values.

    A left join, so a small batch is broadcast and the base is not shuffled.
    """
    condition = named(ID, _BASE) == named(ID, _BATCH)
    flagged = batch.withColumn(_WRITTEN, F.lit(True)).alias(_BATCH)
    return base.alias(_BASE).join(flagged, condition, "left").select(*_merged_columns(base, batch))


def delete_where(base: DataFrame, predicate: Column) -> DataFrame:
    """Rows that do not meet the predicate; an unknown predicate keeps the row."""
    return base.filter(~is_true(predicate))

