"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .fingerprint import fingerprints
from .html_text import extract_text
from .license_scan import license_scan
from .ngram_join import jaccard_components
from .packing import pack_apart
from .shared import table
from .sharding import histogram_shards
from .suffix_match import suffix_matches
from .toxicity import toxicity_scores, train
from .url_filter import host_of, judge_urls, path_of
from .warc import archived

URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: Words in a host name that put all its pages on the block list.
LISTED_WORDS = r"(^|[.-])(casino|poker|bets?|betting|pills|viagra|porn|xxx|adult|loans|jackpot|spam|ads)([.-]|$)"
LICENSE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    url = F.col("url")
    listed = pages.where(host_of(url).rlike(LISTED_WORDS)).select(F.concat(host_of(url), path_of(url)).alias("key"))
    return judge_urls(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = histogram_shards(table(spark, sf_dir, "documents"), 8, tolerance=0.0)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return dealt.select("doc_id", "size", F.crc32(text).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), usable=lambda c: ~held_out(c))
    return toxicity_scores(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"), LICENSE_PHRASES).drop("places")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_apart(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_warc, op2_url_filter, op3_sharding, op4_fingerprints, op5_toxicity, op6_licenses, op7_decontamination, op8_ngram_join, op9_html_text, op10_packing, pipeline)}

_HOST = "case when url like '%://%' then translate(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end"
_PATH = "case when url like '%://%' then regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) else '' end"
_FITS = lambda host, path: f"((host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}'))"
_RULE = "case " + " ".join(f"when {_FITS(h, p)} then '{h}{p}'" for h, p, _ in sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))) + " end"
_VERDICT = "case " + " ".join(f"when {_FITS(h, p)} then '{v}'" for h, p, v in sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))) + f" when regexp_matches(host, '{LISTED_WORDS}') then 'block' else 'allow' end"

ORACLE_SQL = {
    "op1_warc": oracle.WARC,
    "op2_url_filter": f"with u as (select page_id, coalesce({_HOST}, '') as host, coalesce({_PATH}, '') as path from pages) select page_id, host, path, {_RULE} as rule, {_VERDICT} as verdict from u",
    "op3_sharding": oracle.SHARDING,
    "op4_fingerprints": oracle.FINGERPRINTS,
    "op6_licenses": oracle.licenses(LICENSE_PHRASES),
    "op7_decontamination": oracle.DECONTAMINATION,
    "op8_ngram_join": oracle.NGRAM_JOIN,
    "op9_html_text": oracle.HTML_TEXT,
}
