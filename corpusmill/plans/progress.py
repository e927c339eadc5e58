"""Signs of life: batch tasks and streams log how many records they have passed."""

from __future__ import annotations

import logging
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming.listener import StreamingQueryListener

log = logging.getLogger("corpusmill.progress")


def beats(before: int, after: int, every: int) -> list[int]:
    """The multiples of ``every`` that a count passes on its way."""
    return list(range((before // every + 1) * every, after + 1, every)) if every > 0 else []


def counted(df: DataFrame, every: int) -> DataFrame:
    """The same rows; each task logs every ``every`` of them, on its executor."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            for at in beats(n, n + batch.num_rows, every):
                logging.getLogger("corpusmill.progress").info("%d records in this task", at)
            n += batch.num_rows
            yield batch

    return df.mapInArrow(count, df.schema)


class StreamLog(StreamingQueryListener):
    """Logs every ``every`` rows that a stream has read."""

    def __init__(self, every: int):
        self.every, self.rows = every, 0

    def onQueryStarted(self, event) -> None:  # noqa: N802
        log.info("the stream began")

    def onQueryProgress(self, event) -> None:  # noqa: N802
        before, self.rows = self.rows, self.rows + max(0, event.progress.numInputRows)
        for at in beats(before, self.rows, self.every):
            log.info("%d rows read, batch %d", at, event.progress.batchId)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        log.info("the stream ended after %d rows", self.rows)
