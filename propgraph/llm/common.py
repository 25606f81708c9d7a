"""Shared helpers: tables, scratch tables in shared storage, broadcasts behind a size check."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes up to which a side may be broadcast (beyond, Spark shuffles both sides), and what a row takes besides its values.
BROADCAST_BYTES, ROW_BYTES = 64 << 20, 48
#: Characters that end a word.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_fields(schema: StructType, ddl: str) -> StructType:
    return StructType([*schema.fields, *StructType.fromDDL(ddl).fields])


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_prefix(*frames: DataFrame) -> str:
    """What no column of the frames begins with, for columns of one's own."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for frame in frames for c in frame.columns):
        prefix += "_"
    return prefix


def hashable(frame: DataFrame) -> list[Column]:
    """The columns of which a hash can be taken: maps are left out."""
    return [F.col(f"`{c.name}`") for c in frame.schema.fields if "map<" not in c.dataType.simpleString()]


def text_key(column: Column) -> Column:
    """Sixteen bytes that stand for a text; null is taken as the empty text."""
    return F.unhex(F.md5(F.coalesce(column, F.lit("")).cast("binary")))


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; unset, a temporary one, on a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="propgraph-llm-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Tables written to the shared folder, so that later steps don't compute them again.

    They survive the loss of executors, unlike cached blocks. `drop` removes what is no longer
    read; the rest goes when the application ends, as the frame that is returned still reads it.
    """

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex[:12]}"
        atexit.register(self._end)

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def numbered(self, frame: DataFrame, order: list[Column], column: str, name: str) -> DataFrame:
        """The frame, sorted and kept, with each row's place from 0.

        Files are in the order of the sort, so a row's place is the rows of the files before its own, of
        which there are as many as tasks, and its place in its file. No task sees all rows.
        """
        rows = self.keep(frame.orderBy(*order), name)
        file = rows.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
        counts = file.groupBy("__file").agg(F.count("*").alias("n")).orderBy("__file").collect()
        before, firsts = 0, []
        for r in counts:
            firsts.append((r["__file"], before))
            before += r.n
        starts = self.spark.createDataFrame(firsts, "__file string, __first long")
        return file.join(F.broadcast(starts), "__file").select(*rows.columns, (F.col("__first") + F.col("__row")).alias(column))

    def drop(self, *names: str) -> None:
        for name in names:
            _remove(self.spark, f"{self.root}/{name}")

    def _end(self) -> None:
        try:
            _remove(self.spark, self.root)
        except Exception:  # noqa: BLE001 - the session is gone: its folders are the cluster's to clear
            pass


def light(frame: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """The frame, to be broadcast if its values, measured as text, take at most so many bytes.

    It should be a scratch table: its rows are counted and, unless these are too many, measured.
    """
    rows = frame.count()
    if rows * ROW_BYTES > most:
        return frame
    size = frame.agg(F.sum(F.octet_length(F.to_json(F.struct(*frame.columns))))).first()[0] or 0
    return F.broadcast(frame) if rows * ROW_BYTES + size <= most else frame
