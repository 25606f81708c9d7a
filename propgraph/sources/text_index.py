"""An index of a stored text property: which elements hold which three characters in a row.

The postings lie in partitions like those of the elements, `<kind of type>=<type>/_bucket=<b>`, sorted by gram, and
each has a mark: a digest of the element files that it was made of. A row holds a gram and the ids of elements that
have it, out of a few MB of texts: the elements of a gram are dealt over several rows. A search takes the elements
that have all grams of what is sought from the postings, and looks into the texts of these only. Partitions whose
elements changed since are searched whole, until `refresh` writes their postings anew; so results never depend on the
index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from propgraph.columns import BUCKET, ID, named, null_of
from propgraph.sources.element_table import ElementTable, Partitions
from propgraph.sources.files import empty, read_table

#: Characters of a gram; grams of one search at most (any of them will do, as texts are looked into).
GRAM, GRAMS = 3, 16
#: Elements up to which a search names them in the scan's filter; more are joined.
NAMED = 1000
#: The hint of properties whose texts are indexed.
HINT = "ALL"
_GRAM, _IDS, _MARK = "__gram", "__ids", "__mark"


def grams_of(text: Column) -> Column:
    """The different grams of a text, found in one pass; `grams.py` finds the same for whole batches."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1)))


def grams_sought(needle: str) -> list[str]:
    """Grams of what is sought, spread over it."""
    found = list(dict.fromkeys(needle[i : i + GRAM] for i in range(len(needle) - GRAM + 1)))
    return found[:: -(-len(found) // GRAMS)] if found else []


class TextIndex:
    """The index of one property of the stored vertices or edges."""

    def __init__(self, table: ElementTable, name: str) -> None:
        known = table.catalog.find(name)
        if known is None or known.text_hint != HINT:
            raise ValueError(f"Property '{name}' has no text index")
        self.table, self.name, self.spark = table, name, table.spark
        self.path = f"{table.path}-grams/{known.column.encode().hex()}"
        place = [StructField(table.kind, StringType()), StructField(BUCKET, IntegerType())]
        self._postings = StructType([StructField(_GRAM, StringType()), StructField(_IDS, ArrayType(StringType())), *place])
        self._marks = StructType([StructField(_MARK, LongType()), *place])

    def _read(self, what: str, schema: StructType) -> DataFrame:
        found = read_table(self.spark, f"{self.path}/{what}", schema)
        return empty(self.spark, schema) if found is None else found

    def _write(self, what: str, frame: DataFrame) -> None:
        frame.write.partitionBy(self.table.kind, BUCKET).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/{what}")

    def _now(self) -> dict[tuple[str, int], int]:
        """The mark of each partition, from its files' names and times: a row each, no column is read."""
        if not self.table.written:
            return {}
        files = self.spark.read.schema(StructType(self._marks.fields[1:])).parquet(self.table.path)
        file = F.concat_ws(":", F.col("_metadata.file_name"), F.col("_metadata.file_modification_time").cast("string"), F.col("_metadata.file_size"))
        mark = F.xxhash64(F.array_join(F.sort_array(F.collect_set(file)), ","))
        return {(r[0], r[1]): r[2] for r in files.groupBy(self.table.kind, BUCKET).agg(mark).collect()}

    def changed(self) -> tuple[Partitions, Partitions]:
        """Partitions whose postings are those of their elements, and the others."""
        now = self._now()
        then = {(r[self.table.kind], r[BUCKET]): r[_MARK] for r in self._read("marks", self._marks).collect()}
        fresh = {p for p, mark in now.items() if then.get(p) == mark}
        return fresh, set(now) - fresh

    def refresh(self) -> None:
        """Write the postings of changed partitions; marks come last, so a run that dies leaves them out of date.

        A file of elements is of one partition, so where its texts are read its postings are written: no shuffle.
        """
        now, (_, stale) = self._now(), self.changed()
        if not stale:
            return
        from propgraph.sources.grams import postings_task  # numpy is needed here only

        kind = self.table.kind
        texts = self.table.scan.filter(self.table.among(stale)).filter(F.octet_length(named(self.name)) >= GRAM)
        texts = texts.select(ID, named(self.name).cast("binary"), kind, BUCKET)
        rows = texts.mapInArrow(postings_task(GRAM, self._postings.names), self._postings)
        marks = self.spark.createDataFrame([(now[p], *p) for p in sorted(stale)], self._marks)
        none = marks.select(*[null_of(f.dataType).alias(f.name) for f in self._postings.fields[:2]], kind, BUCKET)
        self._write("postings", rows.unionByName(none.coalesce(1)).sortWithinPartitions(kind, BUCKET, _GRAM))
        self._write("marks", marks.coalesce(1))

    def candidates(self, needle: str, fresh: Partitions) -> DataFrame:
        """(_id, type, _bucket) of elements in fresh partitions that have all grams sought."""
        grams = grams_sought(needle)
        rows = self._read("postings", self._postings).filter(self.table.among(fresh)).filter(F.col(_GRAM).isin(*grams))
        rows = rows.select(F.explode(_IDS).alias(ID), self.table.kind, BUCKET)
        return rows.groupBy(ID, self.table.kind, BUCKET).agg(F.count("*").alias("n")).filter(F.col("n") == len(grams)).drop("n")

    def containing(self, needle: str) -> DataFrame:
        """The stored elements whose text contains the needle: like a filter over all of them.

        A needle shorter than a gram is sought in all texts.
        """
        scan, table = self.table.scan, self.table
        holds = named(self.name).contains(needle)
        if len(needle) < GRAM:
            return scan.filter(holds)
        fresh, stale = self.changed()
        if not fresh:
            return scan.filter(holds)
        found = self.candidates(needle, fresh)
        few = found.limit(NAMED + 1).collect()
        if len(few) <= NAMED:
            hit = {(r[table.kind], r[BUCKET]) for r in few}
            indexed = scan.filter(table.among(hit)).filter(named(ID).isin(*[r[ID] for r in few])).filter(holds)
        else:
            place = found.select(named(ID).alias("__id"), named(table.kind).alias("__type"), F.col(BUCKET).alias("__bucket"))
            same = (named(ID) == F.col("__id")) & (named(table.kind) == F.col("__type")) & (F.col(BUCKET) == F.col("__bucket"))
            indexed = scan.filter(table.among(table.partitions(found))).filter(holds).join(place, same, "left_semi")
        return indexed.unionByName(scan.filter(table.among(stale)).filter(holds)) if stale else indexed
