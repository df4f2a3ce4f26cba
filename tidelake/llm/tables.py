"""Reading the given tables, tasks in Python, and tables in the folder all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

import tidelake

_archives: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would.

    Python workers then import it, so its tables of constants are made once per process; functions sent by
    value would bring a copy of them for every task.
    """
    context = spark.sparkContext
    if context.applicationId in _archives:
        return
    folder = tempfile.TemporaryDirectory(prefix="tidelake-archive-")
    archive, root = Path(folder.name) / "tidelake.zip", Path(tidelake.__file__).parent
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _archives[context.applicationId] = folder


def map_arrow(df: DataFrame, fn: Callable, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` on executors that have this package."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``; where that is unset, under the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return f"{root.rstrip('/')}/tidelake-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, safe from lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.written_to = path
    return stored


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark delete shuffle files that nothing refers to any more, which it does when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` made, once nothing is computed from them any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(df.written_to)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
