"""The curation run: filter, fan out, rewrite, validate, remove near duplicates, write."""

from __future__ import annotations

import logging
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PROMPTS, STATUSES, Config
from ..functions import text as tx
from ..operators import dedup, rows
from ..sources import scan, sink
from ..storage import stored
from . import progress

log = logging.getLogger(__name__)
Rephraser = Callable[[str, str, str], str]
#: Most rows whose requests and answers are Python texts at a time.
SLICE = 64


def echo(endpoint: str, prompt: str, request: str) -> str:
    """The offline rewriter: returns the document of the request as it is."""
    return request.split("\n\nΚείμενο:\n", 1)[-1]


def endpoint(source_id: Column, prompt: Column, n: int) -> Column:
    """The endpoint of a pair, drawn evenly from its hash, so that a retry goes to the same one."""
    x = F.conv(F.substring(F.md5(F.concat_ws("|", source_id, prompt).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    return tx.bucket(x, n)


def rephrased(pairs: DataFrame, config: Config, rephraser: Rephraser = echo, in_flight: int = 1) -> DataFrame:
    """Adds the rewriter's ``text`` to ``(ord, source_id, prompt, text)``; of failed calls the text is null and ``error`` says why.

    Rows stream through Arrow batches, of which ``SLICE`` rows at a time become Python texts; a task has
    at most ``in_flight`` calls open and about sixteen times as many begun or waiting, in the order of the rows.
    """
    urls = config.generator.endpoints
    asked = pairs.withColumn("request", rows.rendered(tx.truncated(F.col("text"), config.source.most_chars), F.col("prompt"))).withColumn("endpoint", endpoint(F.col("source_id"), F.col("prompt"), len(urls)))
    out = asked.select("ord", "source_id", "prompt", "endpoint", "request")

    def one(e: int, p: str, r: str) -> tuple[str | None, str | None]:
        try:
            return rephraser(urls[int(e)], p, r), None
        except Exception as e:  # the pair is set aside, the run goes on
            return None, f"{type(e).__name__}: {e}"

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = min(SLICE, 4 * in_flight) if in_flight > 1 else SLICE
        parts = (batch.slice(at, step) for batch in batches for at in range(0, batch.num_rows, step))
        with ThreadPoolExecutor(in_flight) as pool:
            begun: deque = deque()
            for part in parts:
                requests = [part.column(c).to_pylist() for c in ("endpoint", "prompt", "request")]
                # Executor.map submits all its calls at once and is waited for when its results are drawn
                begun.append((part.select(["ord", "source_id", "prompt"]), (pool.map if in_flight > 1 else map)(one, *requests)))
                del part, requests
                while len(begun) * step > (16 * in_flight if in_flight > 1 else 0):
                    yield answered(*begun.popleft())
            while begun:
                yield answered(*begun.popleft())

    def answered(part: pa.RecordBatch, done: Iterator[tuple[str | None, str | None]]) -> pa.RecordBatch:
        texts, errors = zip(*done)
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string()), pa.array(errors, pa.string())], names=[*part.schema.names, "text", "error"])

    schema = out.drop("endpoint", "request").schema.add("text", "string").add("error", "string")
    return out.mapInArrow(call, schema).withColumn("model", F.lit(config.generator.model)).withColumn("source_data", F.lit(config.source.subset))


def judged(records: DataFrame, config: Config, score: Callable[[Column], Column] | None = None) -> DataFrame:
    """Adds ``confidence``, ``stripped`` and the row-local part of ``status``: language, length, then format.

    The language is judged on the raw text: on the whole of a short one, and of a longer one on three
    slices that all have to pass. The confidence is their mean.
    """
    gates = config.gates
    score = score or (lambda t: tx.language_score(t, gates.language))
    raw = F.coalesce(F.col("text"), F.lit(""))
    cut = records.withColumn("starts", tx.slice_starts(F.length(raw))).withColumn("chunks", tx.slices(raw, F.col("starts")))
    scored = cut.withColumn("scores", tx.slice_scores(F.col("chunks"), score)).withColumn("confidence", tx.mean(F.col("scores"))).withColumn("stripped", tx.stripped(raw))
    status = (
        F.when(~F.forall("scores", lambda s: s >= gates.least_score), STATUSES[0]).when(~F.length("stripped").between(gates.least_chars, gates.most_chars), STATUSES[1])
        .when(~tx.format_ok(F.col("stripped"), F.col("prompt")), STATUSES[2]).otherwise("")
    )
    return scored.withColumn("status", status).drop("starts", "chunks", "scores")


def outcomes(records: DataFrame, config: Config, known: DataFrame | None = None, score=None) -> DataFrame:
    """All records with their final status; kept ones have the stripped text and the confidence, others the raw text."""
    local, n = stored(judged(records, config, score), "judged"), config.gates.permutations
    fit = local.where("status = ''").select("prompt", "ord", F.col("stripped").alias("text"))
    kept = dedup.near_dedup(fit, ["prompt"], known=known, n=n, banded=dedup.banding(config.gates.likeness, n))
    full = local.join(kept, ["prompt", "ord"], "left").withColumn("status", F.when((F.col("status") == "") & ~F.coalesce("kept", F.lit(False)), STATUSES[3]).otherwise(F.col("status")))
    good = F.col("status") == ""
    return full.withColumn("text", F.when(good, F.col("stripped")).otherwise(F.col("text"))).withColumn("language_confidence", F.when(good, F.col("confidence")).cast("float")).drop("kept", "stripped")


def run(spark: SparkSession, config: Config, docs: DataFrame | None = None, max_docs: int | None = None, prompts: tuple[str, ...] = PROMPTS, dry_run: bool = True, rehydration: bool = True, rephraser: Rephraser = echo, publisher: sink.Publisher | None = None, score=None, stream: scan.Stream | None = None) -> DataFrame:
    """One run over ``docs`` (default: the configured source); returns its statistics, one row.

    The first document of each id is taken, before documents are fanned out to the tasks; those
    without id are left out. ``rehydration`` counts kept texts of earlier runs as duplicates' firsts.
    ``config.generator.calls`` calls are shared by the tasks that run at once. Failed calls give no
    record; they are logged and counted as ``failed_calls``. What is skipped, and every
    ``progress_every`` records, is logged too.
    """
    if unknown := set(prompts) - set(PROMPTS):
        raise ValueError(f"unknown prompts {sorted(unknown)}, known are {PROMPTS}")
    root, subset = config.shards.root, config.source.subset
    docs = scan.configured(spark, config, stream) if docs is None else docs
    docs = docs.where(tx.verdict(F.col("text"), config.source.script) == "kept").select("ord", "source_id", "text").where("source_id is not null")
    docs = rows.first_per_source(docs, keys=("source_id",))
    pairs = rows.fanout(docs, prompts)
    if (seen := scan.seen_ids(spark, root, subset, config.shards.retry_failed)) is not None:
        seen = stored(seen, "seen")
        log.info("on disk: %s", {r["prompt"]: r["count"] for r in seen.groupBy("prompt").count().collect()})
        log.info("skipped: %s", {r.prompt: r.skipped for r in rows.skips(docs, seen, prompts).collect()})
        pairs = rows.unseen(pairs, seen)
    if max_docs is not None:
        pairs = rows.limited(pairs, max_docs)
    known = scan.kept_texts(spark, root, subset) if rehydration else None
    in_flight = 1 if rephraser is echo else max(1, config.generator.calls // spark.sparkContext.defaultParallelism)
    told = progress.counted(rephrased(pairs, config, rephraser, in_flight), config.progress_every)
    asked = stored(told, "rephrased")
    errors = asked.where("error is not null").count()
    failed = asked.where("error is not null").groupBy("prompt", "error").count().orderBy(F.desc("count")).limit(20).collect()
    for r in failed:
        log.warning("%d calls failed for %s: %s", r["count"], r.prompt, r.error)
    done = stored(outcomes(asked.where("error is null"), config, known, score), "outcomes")
    sink.write_shards(done, root, config.shards.rows)
    if publisher is not None and not dry_run:
        sink.publish(spark, root, publisher, config, prompts, dry_run=False)
    return rows.filter_stats(done).withColumn("failed_calls", F.lit(errors).cast("long"))
