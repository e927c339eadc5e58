"""Reading documents and shards, each row with its place in the source."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader

from ..config import FAILED, PROMPTS, RECORD, Config
from ..storage import stored

log = logging.getLogger(__name__)

#: An iterator over documents, each a dict; rows are numbered as they come.
Stream = Callable[[], Iterator[dict]]


def documents(spark: SparkSession, path: str, id_column: str = "url", text_column: str = "text") -> DataFrame:
    """``ord (file, row), source_id, text`` and the file's other columns; order is by the file's whole path, then row in the file."""
    df = spark.read.parquet(path)
    # the path comes URL-encoded, which sorts differently, and has its plus signs as they are
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return df.select(F.struct(file.alias("file"), F.col("_metadata.row_index").alias("row")).alias("ord"), F.col(id_column).cast("string").alias("source_id"), *[c for c in df.columns if c not in ("ord", "source_id")]).withColumn("text", F.coalesce(F.col(text_column), F.lit("")))


def numbered(docs: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """Adds ``row``: the place in ``whole`` (default ``docs``), all that was read, over all its files and from 0 on.

    Files' rows are counted and summed up in their order, a row a file; the documents stay where they are.
    """
    files = (docs if whole is None else whole).groupBy(F.col("ord.file").alias("__file")).agg(F.count("*").alias("__n"))
    before = files.select("__file", (F.sum("__n").over(Window.orderBy("__file")) - F.col("__n")).alias("__before"))
    return docs.join(F.broadcast(before), F.col("ord.file") == F.col("__file")).withColumn("row", F.col("ord.row") + F.col("__before")).drop("__file", "__before")


class _StreamReader(DataSourceReader):
    def __init__(self, stream: Stream, id_column: str):
        self.stream, self.id_column = stream, id_column

    def read(self, partition):
        for row, doc in enumerate(self.stream()):
            ident, text = doc.get(self.id_column), doc.get("text")
            yield (("", row), None if ident is None else str(ident), "" if text is None else text)


def streamed(spark: SparkSession, stream: Stream, id_column: str = "url") -> DataFrame:
    """``ord, source_id, text`` of an iterator, which one task draws from: a stream has one reader."""

    class StreamSource(DataSource):
        @classmethod
        def name(cls):
            return "corpusmill_stream"

        def schema(self):
            return "ord struct<file:string,row:long>, source_id string, text string"

        def reader(self, schema):
            return _StreamReader(stream, id_column)

    spark.dataSource.register(StreamSource)
    return spark.read.format("corpusmill_stream").load()


def configured(spark: SparkSession, config: Config, stream: Stream | None = None) -> DataFrame:
    """The configured source's documents: all that ``stream`` gives or, where there is none or it fails at any row, the Parquet files from their first row on."""
    source = config.source
    if not source.path:
        raise ValueError("the source has no path")
    if stream is not None:
        try:
            return stored(streamed(spark, stream, source.id_column), "streamed")
        except Exception as e:
            log.warning("the stream failed (%s); its Parquet files are read instead", str(e).partition("\n")[0])
    return documents(spark, "/".join(x for x in (source.path, source.subset) if x), source.id_column)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _numbered(spark: SparkSession, root: str, kind: str) -> DataFrame | None:
    schema = T.StructType([*(RECORD if kind == "kept" else FAILED).fields, T.StructField("shard", T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{root}/{kind}") if exists(spark, f"{root}/{kind}") else None


def shards(spark: SparkSession, root: str, kind: str = "kept") -> DataFrame | None:
    """All records of ``kind`` (kept or failed), or None before the first run."""
    found = _numbered(spark, root, kind)
    return None if found is None else found.select(*[f.name for f in (RECORD if kind == "kept" else FAILED).fields])


def next_shards(spark: SparkSession, root: str, kind: str = "kept") -> DataFrame:
    """``(prompt, next)``: the number that the next shard of each prompt has, for all prompts. Numbers are folder names, so no file is opened for them."""
    found = _numbered(spark, root, kind)
    every = spark.createDataFrame([(p,) for p in PROMPTS], "prompt string")
    if found is None:
        return every.withColumn("next", F.lit(0))
    return every.join(found.groupBy("prompt").agg((F.max("shard") + 1).alias("next")), "prompt", "left").select("prompt", F.coalesce("next", F.lit(0)).alias("next"))


def seen_ids(spark: SparkSession, root: str, source_data: str, retry_failed: bool = True) -> DataFrame | None:
    """Distinct ``(prompt, source_id)`` on disk for ``source_data``; failed ones count unless they are retried."""
    found = [s.where(F.col("source_data") == source_data).select("prompt", "source_id").where("source_id is not null") for kind in ("kept", *([] if retry_failed else ["failed"])) if (s := shards(spark, root, kind)) is not None]
    out = None
    for f in found:
        out = f if out is None else out.unionByName(f)
    return None if out is None else out.distinct()


def kept_texts(spark: SparkSession, root: str, source_data: str) -> DataFrame | None:
    """``(prompt, text)`` of the kept records of ``source_data``."""
    found = shards(spark, root)
    return None if found is None else found.where((F.col("source_data") == source_data) & F.col("text").isNotNull()).select("prompt", "text")


def totals(spark: SparkSession, root: str, kind: str = "kept") -> DataFrame:
    """``(prompt, shards, rows, bytes)`` on disk, for all prompts."""
    every = spark.createDataFrame([(p,) for p in PROMPTS], "prompt string")
    found = _numbered(spark, root, kind)
    if found is None:
        return every.select("prompt", *[F.lit(0).cast("long").alias(c) for c in ("shards", "rows", "bytes")])
    size = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    files = found.groupBy("prompt", "shard", size.alias("f")).agg(F.count("*").alias("n"))
    summed = files.groupBy("prompt").agg(F.countDistinct("shard").alias("shards"), F.sum("n").alias("rows"), F.sum("f.size").alias("bytes"))
    return every.join(summed, "prompt", "left").fillna(0)
