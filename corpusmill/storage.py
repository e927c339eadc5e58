"""Cutting lineage in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROW_GROUP = 16 << 20
_made: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path below spark.checkpoint.dir, which goes when the driver ends.

    A cluster has to name that folder; a local master gets a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpusmill-"))
        root = spark.sparkContext.getCheckpointDir()
    if not _made:
        atexit.register(_remove)
    path = f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def dropped(spark: SparkSession, path: str) -> None:
    """Remove what is below ``path``."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _remove() -> None:
    for spark, path in _made:
        with contextlib.suppress(Exception):  # the session may have ended
            if path.startswith(("/", "file:")):
                shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), ignore_errors=True)
            else:
                dropped(spark, path)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written below spark.checkpoint.dir and read again. Small row groups keep little of it in an executor's heap."""
    path = scratch(df.sparkSession, tag)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove what ``stored`` wrote for ``tables``; nothing may be read from them any more."""
    for table in tables:
        dropped(table.sparkSession, table.scratch_path)
