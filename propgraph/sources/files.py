"""Folders of tables: tables that may not be there yet, and removal of scratch tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from propgraph.columns import null_of


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.range(0).select(*[null_of(f.dataType).alias(f.name) for f in schema.fields])


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The Parquet table at `path`, or None if nothing was written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, through Spark's file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
