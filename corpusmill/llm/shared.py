"""Tables and scratch folders in the one folder that the driver and every executor see."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..storage import discard, scratch, stored  # noqa: F401


def materialise(df: DataFrame, tag: str, rows: int | None = None, task_rows: int = 100_000) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again: lineage ends, executors may be lost.

    Where at most ``rows`` rows are known to come, some ``task_rows`` of them make a task and a file.
    """
    return stored(df if rows is None else gathered(df, rows, task_rows), tag)


def gathered(df: DataFrame, rows: int, task_rows: int = 100_000) -> DataFrame:
    """The same rows in as few tasks as have some ``task_rows`` each, without a shuffle."""
    return df.coalesce(max(1, -(-rows // task_rows)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release() -> None:
    """Give freed memory back to the system. Workers live on between tasks, and an executor has to find room for all of them."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; memory is given back after the last."""
    yield from batches
    release()


def lean_group(f: Callable[[pa.Table], pa.Table], table: pa.Table) -> pa.Table:
    """``f(table)``; what it used meanwhile is given back."""
    out = f(table)
    release()
    return out


def row_ranges(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges ``(first, last)`` with at most ``most`` bytes of text, or one row."""
    end = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64))
    first = 0
    while first < len(end):
        last = max(first + 1, int(np.searchsorted(end, (end[first - 1] if first else 0) + most, "right")))
        yield first, last
        first = last


def fresh_names(taken: list[str], names: str) -> list[str]:
    """Each of ``names``, with underscores before it until no column of ``taken`` has it."""
    used, out = {c.lower() for c in taken}, []
    for name in names.split():
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out
