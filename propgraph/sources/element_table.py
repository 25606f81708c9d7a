"""One Parquet table of elements: `<kind of type>=<type>/_bucket=<b>`, a bucket being the hash of an id.

Appends, and dynamic partition overwrites of named (type, bucket) partitions. Each partition overwritten gets
one row without id, so that it is overwritten also if nothing else is left in it; scans skip such rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from propgraph.columns import BUCKET, HIDDEN, ID, VERTEX, VISIBILITY, length_column, named, reserved_columns, type_column
from propgraph.functions.durations import duration_seconds
from propgraph.operators.catalog import Catalog
from propgraph.sources.files import empty, read_table

Partitions = set[tuple[str, int]]


def with_buckets(frame: DataFrame, buckets: int) -> DataFrame:
    return frame.withColumn(BUCKET, F.pmod(F.xxhash64(named(ID)), F.lit(buckets)).cast("int"))


class ElementTable:
    """The stored vertices or edges of one graph."""

    def __init__(self, spark: SparkSession, root: str, element_type: str, catalog: Catalog) -> None:
        self.spark, self.catalog, self.kind = spark, catalog, type_column(element_type)
        self.path = f"{root}/{'vertices' if element_type == VERTEX else 'edges'}"
        names = [c for c in reserved_columns(element_type) if c != self.kind]
        fields = [*(StructField(c, StringType()) for c in (*names, VISIBILITY)), StructField(HIDDEN, BooleanType())]
        fields += [StructField(p.column, p.spark_type) for p in catalog.properties]
        #: Durations have their length beside them, in whole seconds, so that files can be skipped by it.
        self.lengths = {length_column(p.name): length_column(p.column) for p in catalog.properties if p.type == "DURATION"}
        fields += [StructField(c, LongType()) for c in self.lengths.values()]
        schema = StructType([*fields, StructField(self.kind, StringType()), StructField(BUCKET, IntegerType())])
        found = read_table(spark, self.path, schema)
        self.written = found is not None
        found = found if self.written else empty(spark, schema)
        columns = [named(c) for c in (*names, self.kind, VISIBILITY, HIDDEN, BUCKET)]
        columns += [named(c).alias(n) for n, c in self.lengths.items()]
        #: Stored elements under their property names, with the bucket each is in and the lengths of durations.
        self.scan = found.filter(named(ID).isNotNull()).select(*columns, *[named(p.column).alias(p.name) for p in catalog.properties])

    def partitions(self, frame: DataFrame) -> Partitions:
        """The (type, bucket) partitions of the rows: no more than the table has."""
        return {tuple(r) for r in frame.select(self.kind, BUCKET).distinct().collect()}

    def among(self, partitions: Partitions) -> Column:
        """Is the row in one of the partitions? Only partition columns, so a scan opens no other files."""
        by_type: dict[str, list[int]] = {}
        for name, bucket in sorted(partitions):
            by_type.setdefault(name, []).append(bucket)
        return reduce(lambda a, b: a | b, [(named(self.kind) == name) & F.col(BUCKET).isin(*own) for name, own in by_type.items()], F.lit(False))

    def put(self, frame: DataFrame, touched: Partitions | None = None) -> None:
        """Append rows, or overwrite the touched partitions with them; rows carry their bucket.

        The rows are shuffled once, so that a task holds few partitions; large ones are split by size.
        """
        for name, value in ((VISIBILITY, ""), (HIDDEN, False)):
            own = named(name) if name in frame.columns else F.lit(None)
            frame = frame.withColumn(name, F.coalesce(own, F.lit(value)))
        if touched is not None:
            marks = StructType([StructField(self.kind, StringType()), StructField(BUCKET, IntegerType())])
            frame = frame.unionByName(self.spark.createDataFrame(sorted(touched), marks), allowMissingColumns=True)
        columns = {p.name: p.column for p in self.catalog.properties} | self.lengths
        for p in self.catalog.properties:
            if p.type == "DURATION" and p.name in frame.columns:
                frame = frame.withColumn(length_column(p.name), F.floor(duration_seconds(named(p.name))).cast("bigint"))
        frame = frame.select(*[named(c).alias(columns.get(c, c)) for c in frame.columns])
        (
            frame.hint("rebalance", named(self.kind), F.col(BUCKET)).sortWithinPartitions(self.kind, BUCKET, ID)
            .write.partitionBy(self.kind, BUCKET).mode("append" if touched is None else "overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option(f"parquet.bloom.filter.enabled#{ID}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
            .parquet(self.path)
        )

    def compact(self, below: int) -> None:
        """Rewrite the partitions that have several files smaller than `below` bytes."""
        if self.written:
            place = F.col("_metadata.file_path")
            files = self.spark.read.schema(f"{self.kind} string, {BUCKET} int").parquet(self.path).filter(F.col("_metadata.file_size") < below)
            files = files.groupBy(self.kind, BUCKET).agg(F.min(place).alias("first"), F.max(place).alias("last"))
            if touched := self.partitions(files.filter("first < last")):
                self.put(self.scan.filter(self.among(touched)), touched)
