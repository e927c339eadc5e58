"""Row operators: fan-out, resuming, limits, samples, audits and shard numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import PROMPTS, STATUSES, TEMPLATES, VERDICTS


def fanout(docs: DataFrame, prompts: tuple[str, ...] = PROMPTS) -> DataFrame:
    """Every document with each of at most four tasks; a map, not a join."""
    return docs.withColumn("prompt", F.explode(F.array(*map(F.lit, prompts))))


def rendered(doc: Column, prompt: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, template in TEMPLATES.items():
        out = F.when(prompt == name, F.replace(F.lit(template), F.lit("{doc}"), doc)).otherwise(out)
    return out


def unseen(pairs: DataFrame, seen: DataFrame) -> DataFrame:
    return pairs.join(seen.select("prompt", "source_id").distinct(), ["prompt", "source_id"], "left_anti")


def first_per_source(df: DataFrame, ord_col: str = "ord", keys: tuple[str, ...] = ("prompt", "source_id")) -> DataFrame:
    """The first row for each of ``keys``, by a partial aggregate; null ids are one id. Documents are best resolved before their fan-out."""
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*others), ord_col).alias("first"))
    return best.select(*keys, "first.*")


def skips(docs: DataFrame, seen: DataFrame, prompts: tuple[str, ...] = PROMPTS) -> DataFrame:
    """``(prompt, skipped)``: for each task how many of ``docs(source_id)`` it has already, all tasks."""
    found = fanout(docs.select("source_id"), prompts).join(seen.select("prompt", "source_id").distinct(), ["prompt", "source_id"], "left_semi").groupBy("prompt").count()
    every = docs.sparkSession.createDataFrame([(p,) for p in prompts], "prompt string")
    return every.join(found, "prompt", "left").select("prompt", F.coalesce("count", F.lit(0)).alias("skipped"))


def limited(pairs: DataFrame, n: int, ord_col: str = "ord") -> DataFrame:
    """The pairs of the first ``n`` documents that have any."""
    docs = pairs.select(ord_col).distinct().orderBy(ord_col).limit(n)
    return pairs.join(docs, ord_col, "left_semi")


def verdict_profile(df: DataFrame, amount: str) -> DataFrame:
    """Documents and amounts by verdict, all verdicts, with shares."""
    found = df.groupBy("verdict").agg(F.count("*").alias("docs"), F.coalesce(F.sum(amount), F.lit(0)).alias("tokens"))
    every = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(VERDICTS)], "verdict string, rank int")
    full = every.join(found, "verdict", "left").select("verdict", "rank", F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("tokens", F.lit(0)).alias("tokens"))
    total = Window.partitionBy()  # eight rows
    return full.select("verdict", "docs", "tokens", (F.col("docs") * 100.0 / F.greatest(F.sum("docs").over(total), F.lit(1))).alias("docs_pct"), (F.col("tokens") * 100.0 / F.greatest(F.sum("tokens").over(total), F.lit(1))).alias("tokens_pct"))


def sampled(df: DataFrame, n: int = 50, seed: str = "0", key: str = "source_id") -> DataFrame:
    """Of each prompt an equal part of ``n`` rows, one at least: those of the smallest hashes. Tasks rank their rows first, so few are shuffled."""
    each = max(1, n // len(PROMPTS))
    rank = F.row_number().over(Window.partitionBy("prompt").orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string")).cast("binary")), key))
    return df.withColumn("__r", rank).where(F.col("__r") <= each).drop("__r")


def confidence_stats(df: DataFrame, by: tuple[str, ...] = (), column: str = "language_confidence") -> DataFrame:
    """Least, mean and greatest confidence of the rows that have one."""
    c = F.col(column)
    return df.where(c.isNotNull()).groupBy(*by).agg(F.min(c).alias("lo"), F.avg(c).alias("mean"), F.max(c).alias("hi"))


def filter_stats(df: DataFrame) -> DataFrame:
    names = ("dropped_lang", "dropped_length", "dropped_format", "dropped_dup")
    counted = df.agg(F.count("*").alias("seen"), *[F.count_if(F.col("status") == s).alias(n) for n, s in zip(names, STATUSES, strict=True)], F.count_if(F.col("status") == "").alias("kept"))
    return counted.select("*", *[(F.col(n) * 100.0 / F.greatest("seen", F.lit(1))).alias(f"{n}_pct") for n in (*names, "kept")])


def shard_numbers(df: DataFrame, rows: int, by: list[str], ord_col: str = "ord", chunk: int = 1 << 16) -> DataFrame:
    """``shard``: rows of each group numbered by ``ord_col``, ``rows`` to a shard.

    Numbers are made in chunks of the order and moved by the chunks' counts, so no group meets in one task.
    """
    part = (F.col(ord_col) / chunk).cast("long")
    df = df.withColumn("__p", F.floor(part))
    counts = df.groupBy(*by, "__p").agg(F.count("*").alias("__n"))
    before = counts.withColumn("__b", F.sum("__n").over(Window.partitionBy(*by).orderBy("__p")) - F.col("__n")).drop("__n")
    own = F.row_number().over(Window.partitionBy(*by, "__p").orderBy(ord_col))
    return df.withColumn("__r", own).join(before, [*by, "__p"]).withColumn("shard", F.floor((F.col("__b") + F.col("__r") - 1) / rows).cast("long")).drop("__p", "__r", "__b")
