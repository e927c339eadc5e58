"""Writing, merging and publishing shards.

A shard is a folder ``{kept or failed}/prompt=.../shard=...`` with one file. Numbers go on from run
to run; every shard of a run but its last has exactly the configured rows.
"""

from __future__ import annotations

import logging
import shutil
from pathlib import Path
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FAILED, PROMPTS, RECORD, Config
from ..operators.rows import shard_numbers
from . import scan

log = logging.getLogger(__name__)


def write_shards(df: DataFrame, root: str, rows: int = 8000) -> None:
    """Appends records to ``root/kept`` and ``root/failed``, numbered within their prompt in the order of a hash of their id, zstd.

    Records are dealt and numbered in parts of the hash range with some 65536 records each.
    """
    spark, chunk = df.sparkSession, ((1 << 63) - 1) // (df.count() // (1 << 16) + 1)
    for kind, own, schema in (("kept", df.where("status = ''"), RECORD), ("failed", df.where("status <> ''").withColumn("failure_reason", F.col("status")), FAILED)):
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
        keyed = own.select(*cols).withColumn("key", F.shiftrightunsigned(F.xxhash64("source_id", "source_data"), 1))
        numbered = shard_numbers(keyed, rows, ["prompt"], "key", chunk).join(F.broadcast(scan.next_shards(spark, root, kind)), "prompt", "left")
        placed = numbered.select(*schema.names, (F.col("shard") + F.coalesce("next", F.lit(0))).cast("int").alias("shard"))
        placed.repartition("prompt", "shard").write.mode("append").option("compression", "zstd").partitionBy("prompt", "shard").parquet(f"{root}/{kind}")


def merge_shards(kept: DataFrame, out: str, compression: str = "zstd") -> None:
    """All rows as one file, which is what is asked for here."""
    kept.coalesce(1).write.mode("overwrite").option("compression", compression).parquet(out)


def publish_plan(spark: SparkSession, root: str, prompts: tuple[str, ...] = PROMPTS, prefix: str = "") -> DataFrame:
    """``(local, remote, bytes)`` for each kept file, by prompt and shard."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{root}/kept").select("path", "length")
    prompt = F.regexp_extract("path", r"prompt=([^/]+)/", 1)
    name = F.format_string("part-%05d.parquet", F.regexp_extract("path", r"shard=(\d+)/", 1).cast("int"))
    remote = F.concat_ws("/", prompt, *([F.lit(prefix.strip("/"))] if prefix.strip("/") else []), name)
    return files.where(prompt.isin(*prompts)).select(F.col("path").alias("local"), remote.alias("remote"), F.col("length").alias("bytes")).orderBy("remote")


def card(config: Config, prompts: tuple[str, ...] = PROMPTS) -> str:
    """What a published folder says of itself: its configs in a header, then origin and columns in words."""
    notes = {"text": "the rewritten document", "source_id": "id of the source document", "source_data": "subset that the source came from", "prompt": "task", "model": "id of the generating model", "language_confidence": "language score of the raw output"}
    head = ["---", "configs:", *[line for p in prompts for line in (f"  - config_name: {p}", f"    data_files: {p}/**/*.parquet")], f"language: [{config.gates.language}]", "tags: [synthetic]", "---"]
    body = ["# Rewritten documents", "", f"Documents rewritten by `{config.generator.model}`, one config for each task: {', '.join(prompts)}.", "", "| column | type | meaning |", "| --- | --- | --- |"]
    return "\n".join([*head, "", *body, *[f"| `{f.name}` | {f.dataType.simpleString()} | {notes[f.name]} |" for f in RECORD.fields], ""])


class Publisher(Protocol):
    def has(self, remote: str) -> bool: ...

    def upload(self, local: str, remote: str) -> None: ...

    def write_card(self, text: str, force: bool = False, message: str = "") -> bool: ...


class FolderPublisher:
    """Publishes into a local folder."""

    def __init__(self, root: str):
        self.root = Path(root)

    def has(self, remote: str) -> bool:
        return (self.root / remote).exists()

    def upload(self, local: str, remote: str) -> None:
        to = self.root / remote
        to.parent.mkdir(parents=True, exist_ok=True)
        shutil.copyfile(local.removeprefix("file://").removeprefix("file:"), to)

    def write_card(self, text: str, force: bool = False, message: str = "") -> bool:
        to = self.root / "README.md"
        if to.exists() and not force:
            return False
        self.root.mkdir(parents=True, exist_ok=True)
        to.write_text(text)
        log.info("%s: %s", message or "a card is written", to)
        return True


def publish(spark: SparkSession, root: str, publisher: Publisher, config: Config = Config(), prompts: tuple[str, ...] = PROMPTS, prefix: str = "", dry_run: bool = True) -> DataFrame | None:
    """The plan, carried out unless ``dry_run``: a card if there is none, and the files that aren't there yet (shards never change)."""
    if not scan.exists(spark, f"{root}/kept"):
        return None
    plan = publish_plan(spark, root, prompts, prefix)
    if not dry_run:
        publisher.write_card(card(config, prompts))
        for row in plan.toLocalIterator():
            if not publisher.has(row.remote):
                publisher.upload(row.local, row.remote)
    return plan
