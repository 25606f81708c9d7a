"""A stored property graph: two tables of elements, a catalog and the visibilities met, changed by Spark's own writes.

Inserts append. Upserts, overwrites and deletes read the partitions that hold a changed row and overwrite
those, and no others, in one job (see `element_table`); `catalog/` is described in `catalog_table`.

A job that fails changes nothing. Its commit moves partitions into place one after the other, and a change
takes at most two jobs: one that dies in between is run again and then ends where it would have ended. Versions,
isolation of readers and several writers at once are a table format's work.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from propgraph.columns import BUCKET, DEST_ID, EDGE, ID, SOURCE_ID, VERTEX, VISIBILITY, named, type_column
from propgraph.functions.visibility import is_expression
from propgraph.operators.catalog import CONCEPT, RELATIONSHIP, Catalog, drop_property, drop_type, register_properties, register_types
from propgraph.operators.mutate import (
    append_elements, assign_ids, check_ids, delete_where, last_of_each_id, prepare, update_matched,
)
from propgraph.options import CONF_PREFIX, GraphOptions, require_choice
from propgraph.sources import catalog_table as notes
from propgraph.sources.element_table import ElementTable, with_buckets
from propgraph.sources.elements import PropertyGraph, read_elements
from propgraph.sources.files import empty, read_table, remove
from propgraph.sources.text_index import TextIndex

MODES = ("append", "overwrite", "overwrite_where", "overwrite_dynamic")
#: Buckets of a new graph, unless the session's `spark.propgraph.buckets` says otherwise.
BUCKETS = 8
#: Bytes of visibility expressions up to which reads look them up; beyond, each row's is evaluated.
EXPRESSION_BYTES = 8 << 20
_VISIBILITIES = StructType([StructField(VISIBILITY, StringType())])
_END = "__end"


class GraphStore:
    """Reads and changes one stored graph."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _noted(self) -> notes.Noted:
        return notes.read_catalog(self.spark, f"{self.root}/catalog")

    def _note(self, known: notes.Noted, events: list[tuple[str, object]]) -> notes.Noted:
        return notes.note(self.spark, f"{self.root}/catalog", known, events)

    def _table(self, element_type: str, catalog: Catalog) -> ElementTable:
        return ElementTable(self.spark, self.root, element_type, catalog)

    def catalog(self) -> Catalog:
        return self._noted().catalog

    def graph(self) -> PropertyGraph:
        """The graph as of now, as lazy frames; after later changes ask anew."""
        known = self._noted()
        frames = [self._table(t, known.catalog).scan for t in (VERTEX, EDGE)]
        # all visibilities that hold operators, if they are few enough to be sent around
        expressions = None if known.expressions > EXPRESSION_BYTES else F.broadcast(self._expressions())
        return PropertyGraph(known.catalog, *frames, expressions, stored=True)

    def _expressions(self) -> DataFrame:
        found = read_table(self.spark, f"{self.root}/visibilities", _VISIBILITIES)
        return empty(self.spark, _VISIBILITIES) if found is None else found

    def write(
        self, batch: DataFrame, options: GraphOptions, mode: str = "append", where: Column | None = None,
        type_from_column: bool = False, order_by: str | None = None, allow_lossy: bool = False,
    ) -> None:
        """Insert (no `_id` column) or upsert (with one) the batch.

        `append` keeps all other elements of the kind; `overwrite` replaces them all,
        `overwrite_where` those that meet `where`, `overwrite_dynamic` those of the types in
        the batch. Every type is that of the options, or of the type column if asked for.
        `order_by` names the column whose highest value decides between rows of one id. A batch may
        be made from the graph itself.
        """
        require_choice(mode, MODES, "mode")
        if (where is not None) != (mode == "overwrite_where"):
            raise ValueError("'where' belongs to mode overwrite_where, and only to it")
        element_type, known = options.element_type, self._noted()
        catalog = register_properties(known.catalog, batch.schema)
        batch = prepare(batch, element_type, options.default_type, catalog, type_from_column, allow_lossy)
        buckets = known.buckets or int(self.spark.conf.get(f"{CONF_PREFIX}buckets", "") or BUCKETS)
        events = [] if known.buckets else [(notes.BUCKETS, buckets)]
        table, has_ids = self._table(element_type, catalog), ID in batch.columns
        with self._staging() as stage:
            if has_ids and order_by is not None:
                batch = last_of_each_id(batch, order_by)
            if table.written or not has_ids:  # used more than once from here on: computed once, and of known size
                batch = stage(batch)
            if not has_ids:
                highest = known.next_id + batch.count() - 1
                batch = assign_ids(batch, known.next_id)
            else:
                highest = check_ids(batch, order_by is None)
            if highest >= known.next_id:
                events.append((notes.IDS, highest + 1))
            batch = with_buckets(batch, buckets)
            types = {options.default_type}
            if type_from_column:
                types = {r[0] for r in batch.select(table.kind).distinct().collect()}  # one row per type
            registered = register_types(catalog, CONCEPT if element_type == VERTEX else RELATIONSHIP, types)
            if VISIBILITY in batch.columns:
                events += self._add_expressions(batch, stage)
            noted = self._note(known, events)  # numbers are taken before they are used, names are known once they are
            if table.written:
                batch = self._replace(table, batch, has_ids and mode != "overwrite", mode, where, types, stage)
            table.put(batch)
            self._note(noted, notes.added(known.catalog, registered))

    def _add_expressions(self, batch: DataFrame, stage) -> list[tuple[str, object]]:
        """Write down the visibilities with operators that the graph hasn't had yet."""
        texts = batch.filter(is_expression(named(VISIBILITY))).select(VISIBILITY).distinct()
        texts = stage(texts.join(self._expressions(), VISIBILITY, "left_anti"))
        size = texts.agg(F.sum(F.octet_length(VISIBILITY) + 16)).first()[0]
        if size:
            texts.coalesce(1).write.mode("append").parquet(f"{self.root}/visibilities")
        return [(notes.EXPRESSIONS, size)] if size else []

    def _replace(self, table: ElementTable, batch: DataFrame, match_ids: bool, mode: str, where: Column | None, types: set[str], stage) -> DataFrame:
        """Overwrite the partitions from which rows go or in which rows change; returns the batch's rows of others."""
        scan, kind, touched = table.scan, table.kind, set()
        if mode == "overwrite":
            touched, scan = table.partitions(scan), scan.limit(0)
        elif mode == "overwrite_dynamic":
            touched, scan = table.partitions(scan.filter(named(kind).isin(*types))), scan.filter(~named(kind).isin(*types))
        elif where is not None:
            touched, scan = table.partitions(scan.filter(where)), delete_where(scan, where)
        fresh = batch
        if match_ids:
            # one pass over the ids in the batch's buckets; their partitions, and those they move to, are hit
            own = [r[0] for r in batch.select(BUCKET).distinct().collect()]
            ids = batch.select(ID, named(kind).alias("to"))
            found = stage(scan.filter(F.col(BUCKET).isin(*own)).select(ID, kind, BUCKET).join(ids, ID))
            touched |= table.partitions(found) | table.partitions(found.select(named("to").alias(kind), BUCKET))
            fresh = batch.join(found.select(ID), ID, "left_anti")
        if not touched:
            return batch
        rewritten = scan.filter(table.among(touched))
        if match_ids:
            rewritten = update_matched(rewritten, batch)
        table.put(append_elements(rewritten, fresh.filter(table.among(touched))), touched)
        return fresh.filter(~table.among(touched))

    def delete(self, element_type: str, where: Column | None = None, detach: bool = False) -> None:
        """Delete the elements that meet the predicate, or all of the kind.

        Edges of deleted vertices stay unless `detach`; they go first, so that a run that died can be repeated.
        """
        catalog = self.catalog()
        table, edges = self._table(element_type, catalog), self._table(EDGE, catalog)
        doomed = table.scan if where is None else table.scan.filter(where)
        with self._staging() as stage:
            if detach and element_type == VERTEX and edges.written:
                gone = stage(doomed.select(named(ID).alias(_END)))
                ends = edges.scan.select(ID, type_column(EDGE), BUCKET, F.explode(F.array(SOURCE_ID, DEST_ID)).alias(_END))
                hit = stage(ends.join(gone, _END, "left_semi").drop(_END).distinct())
                if touched := edges.partitions(hit):
                    edges.put(edges.scan.filter(edges.among(touched)).join(hit.select(ID), ID, "left_anti"), touched)
            if touched := table.partitions(doomed):
                kept = table.scan.limit(0) if where is None else delete_where(table.scan.filter(table.among(touched)), where)
                table.put(kept, touched)

    def index_text(self, element_type: str, name: str) -> None:
        """Make or refresh the index of a text property whose hint is ALL; only changed partitions are read."""
        TextIndex(self._table(element_type, self.catalog()), name).refresh()

    def containing(self, element_type: str, name: str, needle: str, **options) -> DataFrame:
        """Elements whose text property contains the needle, by its index as far as it is up to date.

        Otherwise as `read_elements` gives them, and with its options.
        """
        graph, index = self.graph(), TextIndex(self._table(element_type, self.catalog()), name)
        frame = {"vertices" if element_type == VERTEX else "edges": index.containing(needle)}
        return read_elements(replace(graph, **frame), element_type, **options)

    def drop_property(self, name: str) -> None:
        """Remove a property from every element. Only the catalog changes, no data is rewritten."""
        known = self._noted()
        drop_property(known.catalog, name)
        self._note(known, [(notes.DROP_PROPERTY, name)])

    def drop_concept(self, name: str) -> None:
        """Remove a concept from the catalog; its vertices stay."""
        self._drop_type(CONCEPT, name)

    def drop_label(self, name: str) -> None:
        """Remove an edge label from the catalog; its edges stay."""
        self._drop_type(RELATIONSHIP, name)

    def _drop_type(self, kind: str, name: str) -> None:
        known = self._noted()
        drop_type(known.catalog, kind, name)
        self._note(known, [(notes.DROP_TYPE, (kind, name))])

    def compact(self, below: int = 64 << 20) -> None:
        """Rewrite the partitions that have several files smaller than `below` bytes."""
        for element_type in (VERTEX, EDGE):
            self._table(element_type, self.catalog()).compact(below)

    @contextmanager
    def _staging(self) -> Iterator:
        """Gives a function that writes a frame down for the time of one change."""
        path = f"{self.root}/_staging/{uuid.uuid4().hex}"

        def stage(frame: DataFrame) -> DataFrame:
            own = f"{path}/{uuid.uuid4().hex}"
            frame.write.parquet(own)
            return self.spark.read.schema(frame.schema).parquet(own)

        try:
            yield stage
        finally:
            remove(self.spark, path)
