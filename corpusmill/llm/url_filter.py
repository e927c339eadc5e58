"""URL filtering with a cascade of Bloom filters, in DataFrame operations only.

Level 1 encodes the listed keys. The keys of the complete universe that pass it without being
listed are encoded by level 2, the listed ones that pass both by level 3, and so on until no key is
wrong. For every key of the universe the first level that rejects it tells, exactly, whether it is
listed. The levels are bit arrays inside the plan, so judging is one map over the URLs.

Keys are dealt by hash into as many parts as keep the bits of a cascade near ``PART_BITS``, some
four million listed keys each; every part has a cascade of its own and is judged by a pass over its
URLs. So what a plan holds is bounded however long the list is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialise

PART_BITS = 1 << 26
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(j)), F.lit(self.bits)) for j in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        # one array literal, once the plan is optimised
        words = F.expr(f"cast(split('{','.join(map(str, self.words))}', ',') as array<bigint>)")
        return F.forall(F.array(*self.positions(key)), lambda p: F.getbit(F.get(words, (p / 64).cast("int")), (p % 64).cast("int")) == 1)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    @property
    def bits(self) -> int:
        return sum(x.bits for x in self.levels)

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe; null for null."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            out = F.when(~level.passes(key), F.lit(level.number % 2 == 0)).otherwise(out)
        return F.when(key.isNotNull(), out)


def encode(keys: DataFrame, bits: int, hashes: int, number: int) -> Level:
    """A Bloom filter of the column ``key``; its words, at most ``bits / 64``, reach the driver."""
    blank = Level(number, bits, hashes, ())
    at = keys.select(F.explode(F.array(*blank.positions(F.col("key")))).alias("at"))
    rows = at.groupBy((F.col("at") / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("set")).collect()
    words = [0] * -(-bits // 64)
    for word, value in rows:
        words[word] = value
    return Level(number, bits, hashes, tuple(words))


def _cascade(sides: list[DataFrame], counts: list[int]) -> Cascade:
    """Of listed keys and others, each with its exact count."""
    levels: list[Level] = []
    rate = min(0.5, max(2.0**-16, counts[0] / max(1, 2 * counts[1])))
    while counts[len(levels) % 2]:
        own, other = len(levels) % 2, 1 - len(levels) % 2
        hashes = max(1, round(math.log2(1 / rate)))
        levels.append(encode(sides[own], max(64, math.ceil(counts[own] * hashes / math.log(2) / 64) * 64), hashes, len(levels) + 1))
        sides[other] = sides[other].where(levels[-1].passes(F.col("key")))
        counts[other] = sides[other].count()
        rate = 0.25
    return Cascade(tuple(levels))


def part_of(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts)).cast("int")


def build_cascades(universe: DataFrame, listed: DataFrame, key: str = "key", part_bits: int = PART_BITS) -> list[Cascade]:
    """The cascades of the keys of ``listed`` over all keys of ``universe``, one for each part of the keys.

    Keys only in ``listed`` join the universe; null keys are left out, repeated ones count once.
    """
    named = lambda df, flag: df.select(F.col(key).cast("string").alias("key"), F.lit(flag).alias("listed")).where("key is not null")
    keys = materialise(named(universe, 0).unionByName(named(listed, 1)).groupBy("key").agg(F.max("listed").alias("listed")), "universe")
    n_all, n_in = keys.agg(F.count("*"), F.coalesce(F.sum("listed"), F.lit(0))).first()
    if not n_in:
        return [Cascade(())]
    parts = max(1, math.ceil(n_in * 1.5 * (6 + math.log2(max(2.0, min(2.0**16, 2 * n_all / n_in)))) / part_bits))
    counted = keys.withColumn("part", part_of(F.col("key"), parts)).groupBy("part").agg(F.count("*").alias("n"), F.sum("listed").alias("own"))
    counts = {r["part"]: (r["own"], r["n"] - r["own"]) for r in counted.collect()}
    mine = lambda p, flag: keys.where((F.col("listed") == flag) & (part_of(F.col("key"), parts) == p)).select("key")
    return [_cascade([mine(p, 1), mine(p, 0)], list(counts.get(p, (0, 0)))) for p in range(parts)]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", part_bits: int = PART_BITS) -> DataFrame:
    """``(id_col, host, path, rule, verdict, listed)`` for each row of ``pages``.

    ``rules`` are ``(host, path, verdict)``: a rule fits its host and all subdomains if the URL's
    path starts with the rule's; of several the longest wins. Without a rule a URL is blocked if its
    host and path, as one text, are among ``listed(key)`` and else allowed. Null URLs and those
    without ``://`` have an empty host and path and no rule. Rows are returned as often as they
    come; other columns are ignored; empty tables give empty results.
    """
    urls = pages.select(id_col, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    key = F.concat("host", "path")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    cascades = build_cascades(urls.select(key.alias("key")), listed, part_bits=part_bits)
    known = [(urls if len(cascades) == 1 else urls.where(part_of(key, len(cascades)) == p)).withColumn("listed", c.contains(key)) for p, c in enumerate(cascades)]
    every = reduce(DataFrame.unionByName, known)
    return every.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")
