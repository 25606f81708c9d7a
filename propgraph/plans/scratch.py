"""Where queries that write keep their tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

from propgraph.sources.files import remove

_FOLDERS: dict[str, str] = {}


def _shared(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, else the warehouse; on a local master a temporary one will do."""
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named
    if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
        return tempfile.mkdtemp(prefix="propgraph-", dir="/tmp")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", "")
    if not warehouse:
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
    return warehouse


def scratch_root(spark: SparkSession) -> str:
    """A new folder in the application's own folder in shared storage, which goes when Python ends."""
    application = spark.sparkContext.applicationId
    if application not in _FOLDERS:
        _FOLDERS[application] = f"{_shared(spark).rstrip('/')}/propgraph-{application}"
        atexit.register(remove_scratch, spark)
    return f"{_FOLDERS[application]}/{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Remove the application's folder with all that queries have written there."""
    if spark.sparkContext._jsc is None:  # stopped: the driver's JVM can't be asked any more
        return
    folder = _FOLDERS.pop(spark.sparkContext.applicationId, None)
    if folder:
        remove(spark, folder)
