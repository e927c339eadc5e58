"""The curation run over files as they arrive: each micro-batch is one resumed run."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..config import Config
from ..plans import curate, progress


def start(spark: SparkSession, path: str, schema, config: Config, checkpoint: str, rephraser: curate.Rephraser = curate.echo, order: str | None = None) -> StreamingQuery:
    """Runs over new Parquet files below ``path``; ids on disk are skipped and kept texts stay in the duplicate index.

    A repeated micro-batch finds its ids on disk, so it writes nothing twice; for that, failed pairs
    count as seen here, whatever ``retry_failed`` says. A later batch run can try them again.
    """
    config, id_column = config.having(retry_failed=False), config.source.id_column
    spark.streams.addListener(progress.StreamLog(config.progress_every))

    def batch(df, number: int) -> None:
        docs = df.select(F.struct(F.lit(number).alias("batch"), F.col(order or id_column).alias("row")).alias("ord"), F.col(id_column).cast("string").alias("source_id"), "text")
        curate.run(spark, config, docs=docs, rehydration=True, rephraser=rephraser)

    return spark.readStream.schema(schema).parquet(path).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()
