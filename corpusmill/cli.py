"""Commands: run, spot-check, profile, check-dups, read-shards, publish, refresh-readme."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import PROMPTS, Config, chosen_prompts
from .functions import text as tx
from .operators import dedup, rows
from .plans import curate
from .sources import scan, sink
from .sources.chat import ChatRephraser
from .storage import stored


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corpusmill")
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("run")
    p.add_argument("--max-docs", type=int)
    p.add_argument("--dry-run", action=argparse.BooleanOptionalAction, default=True)
    p.add_argument("--prompts")
    p.add_argument("--rehydration", action=argparse.BooleanOptionalAction, default=False)
    p.add_argument("--publish-to", default="./data/published")
    p.add_argument("--verbose", action="store_true")
    p.add_argument("--generator", choices=("http", "echo"), default="http")
    p = sub.add_parser("spot-check")
    p.add_argument("--n", type=int, default=50)
    p = sub.add_parser("profile")
    p.add_argument("configs", nargs="+")
    p.add_argument("--root", default=".")
    p.add_argument("--limit", type=int, default=100)
    p = sub.add_parser("check-dups")
    p.add_argument("prompt", choices=PROMPTS)
    p.add_argument("--root")
    p.add_argument("--threshold", type=float, default=0.8)
    p.add_argument("--num-perm", type=int, default=128)
    p = sub.add_parser("read-shards")
    p.add_argument("prompt", choices=PROMPTS, nargs="?")
    p.add_argument("--root")
    p.add_argument("--out")
    p.add_argument("--compression", default="zstd")
    p = sub.add_parser("publish")
    p.add_argument("--input")
    p.add_argument("--to", default="./data/published")
    p.add_argument("--prompts")
    p.add_argument("--dest-prefix", default="")
    p.add_argument("--dry-run", action=argparse.BooleanOptionalAction, default=True)
    p = sub.add_parser("refresh-readme")
    p.add_argument("--to", default="./data/published")
    p.add_argument("--message", "-m", default="refresh the card")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args, config = parser().parse_args(argv), Config.from_env()
    logging.basicConfig(level=logging.DEBUG if getattr(args, "verbose", False) else logging.INFO)
    if args.command == "refresh-readme":
        sink.FolderPublisher(args.to).write_card(sink.card(config), force=True, message=args.message)
        return
    spark = spark or SparkSession.builder.appName("corpusmill").getOrCreate()
    root = getattr(args, "root", None) or getattr(args, "input", None) or config.shards.root
    if args.command == "run":
        rephraser = ChatRephraser.of(config) if args.generator == "http" else curate.echo
        curate.run(spark, config.having(local_shard_dir=root), max_docs=args.max_docs, prompts=chosen_prompts(args.prompts), dry_run=args.dry_run, rehydration=args.rehydration, rephraser=rephraser, publisher=sink.FolderPublisher(args.publish_to)).show(truncate=False)
    elif args.command == "spot-check":
        totals(spark, root)
        if (kept := scan.shards(spark, root)) is not None:
            some = stored(rows.sampled(kept, args.n), "sampled")
            rows.confidence_stats(some, by=("prompt",)).show()
            some.select("prompt", "source_id", tx.text_head(F.col("text")).alias("head")).orderBy("prompt", "source_id").show(args.n, truncate=False)
    elif args.command == "profile":
        for name in args.configs:
            docs = scan.documents(spark, f"{args.root}/{name}", config.source.id_column).orderBy("ord").limit(args.limit)
            rows.verdict_profile(docs.withColumn("verdict", tx.verdict(F.col("text"), config.source.script)), "token_count").show()
    elif args.command == "check-dups":
        kept = scan.shards(spark, root).where(F.col("prompt") == args.prompt)
        numbered = kept.select("prompt", "text", F.struct("source_data", "source_id").alias("ord"))
        dedup.near_dedup(numbered, ["prompt"], n=args.num_perm, banded=dedup.banding(args.threshold, args.num_perm)).groupBy("prompt").agg(F.count("*").alias("total"), F.count_if(~F.col("kept")).alias("dup"), F.count_if("kept").alias("unique")).show()
    elif args.command == "read-shards":
        totals(spark, root)
        kept = scan.shards(spark, root)
        if args.prompt:
            kept = kept.where(F.col("prompt") == args.prompt)
        kept.groupBy("source_data").agg(F.count("*").alias("len")).orderBy(F.desc("len"), "source_data").show()
        if args.out:
            sink.merge_shards(kept, args.out, args.compression)
    elif args.command == "publish":
        plan = sink.publish(spark, root, sink.FolderPublisher(args.to), config, chosen_prompts(args.prompts), args.dest_prefix, args.dry_run)
        if plan is not None:
            plan.withColumn("size", tx.size_text(F.col("bytes"))).show(truncate=False)


def totals(spark: SparkSession, root: str) -> None:
    """Shards, rows and size on disk of each prompt."""
    scan.totals(spark, root).withColumn("size", tx.size_text(F.col("bytes"))).orderBy("prompt").show()


if __name__ == "__main__":
    main()
