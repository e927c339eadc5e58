"""The registered queries over the provided tables and the SQL to hold them against.

Texts are Latin here, so the script is a parameter. Assistant turns of ``conversations`` stand in
for generated texts; ``conv_id % 4`` gives their task. ``pages`` stand in for what has a URL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import BOLD_TITLE, INTRODUCTIONS, OPENERS, PROMPTS, RECORD, REFUSALS, STATUSES, TEMPLATES, TOKEN, VERDICTS, Config
from .functions import text as tx
from .operators import dedup, rows
from .plans import curate
from .sources import scan, sink
from .storage import scratch, stored

CONFIG = Config().having(script="Latin", target_lang="en", lid_threshold=0.5, source_config="documents")
#: Generated texts are shorter than this at every scale of the tables.
LONGEST_TURN = 2400


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """Rows dealt over the cores where the scan has fewer splits than these, as one small row group has; else the scan's own splits."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _docs(spark, sf):
    return _spread(_read(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "source", "n_chars"))


def _turns(spark, sf):
    """Generated texts: id, prompt, text."""
    prompt = F.element_at(F.array(*map(F.lit, PROMPTS)), (F.col("conv_id") % 4 + 1).cast("int"))
    return _spread(_read(spark, sf, "conversations").where("role = 'assistant'").select((F.col("conv_id") * 1000 + F.col("turn")).alias("ord"), "conv_id", "turn", prompt.alias("prompt"), F.coalesce("text", F.lit("")).alias("text")))


def _judged(spark, sf):
    config = CONFIG
    turns = _turns(spark, sf).withColumn("source_id", F.col("ord").cast("string")).withColumn("source_data", F.lit("conversations")).withColumn("model", F.lit(config.generator.model))
    return turns, config


def verdict_profile(spark, sf):
    return rows.verdict_profile(_docs(spark, sf).select("n_chars", tx.verdict(F.col("text"), "Latin").alias("verdict")), "n_chars")


def _scanned(spark, sf):
    return scan.documents(spark, f"{sf}/documents.parquet", "doc_id")


def scan_documents(spark, sf):
    whole = _scanned(spark, sf).select("ord", "source_id", "text")
    return scan.numbered(_spread(whole), whole).select("source_id", "row", F.length("text").alias("n"), tx.verdict(F.col("text"), "Latin").alias("verdict"))


def source_order(spark, sf):
    """The first of all rows by file and row, and how many come after."""
    return _scanned(spark, sf).agg(F.min_by("source_id", "ord").alias("first_id"), F.max_by("source_id", "ord").alias("last_id"), F.count("*").alias("n"))


def broken_stream():
    """Gives a few documents and fails."""
    for i in range(10):
        yield {"doc_id": i, "text": "lost"}
    raise OSError("the connection is gone")


def numbers_stream():
    for i in range(1000):
        yield {"doc_id": i, "text": f"number {i}"}


def stream_scan(spark, sf):
    return scan.streamed(spark, numbers_stream, "doc_id").select(F.col("ord.row").alias("row"), "source_id", "text")


def source_fallback(spark, sf):
    config = CONFIG.having(source_name=sf, source_config="documents.parquet", id_column="doc_id")
    return scan.numbered(scan.configured(spark, config, broken_stream)).select("source_id", "row", F.length("text").alias("n"))


def profile_limited(spark, sf):
    return rows.verdict_profile(_docs(spark, sf).select("doc_id", "text", "n_chars").orderBy("doc_id").limit(100).select("n_chars", tx.verdict(F.col("text"), "Latin").alias("verdict")), "n_chars")


def truncate_docs(spark, sf):
    return _docs(spark, sf).select("doc_id", F.md5(tx.truncated(F.col("text"), 600).cast("binary")).alias("head_md5"), F.length(tx.truncated(F.col("text"), 600)).alias("n"))


def prompt_render(spark, sf):
    docs = rows.fanout(_docs(spark, sf).select("doc_id", tx.truncated(F.col("text"), 12000).alias("doc")))
    return docs.select("doc_id", "prompt", F.md5(rows.rendered(F.col("doc"), F.col("prompt")).cast("binary")).alias("request_md5"))


def normalize_ws(spark, sf):
    return _docs(spark, sf).select("doc_id", F.md5(tx.collapsed(F.col("text")).cast("binary")).alias("text_md5"))


def _sliced(spark, sf):
    turns = _turns(spark, sf).withColumn("starts", tx.slice_starts(F.length("text")))
    return turns.withColumn("chunks", tx.slices(F.col("text"), F.col("starts")))


def lid_slices(spark, sf):
    return _sliced(spark, sf).select("ord", F.posexplode("chunks").alias("slice", "chunk")).select("ord", "slice", F.md5(F.col("chunk").cast("binary")).alias("chunk_md5"))


def lang_score(spark, sf):
    return _docs(spark, sf).select("doc_id", F.round(tx.language_score(F.col("text"), "en"), 9).alias("score"))


def lang_gate(spark, sf):
    scores = _sliced(spark, sf).select("ord", tx.slice_scores(F.col("chunks"), lambda t: tx.language_score(t, "en")).alias("scores"))
    return scores.select("ord", F.forall("scores", lambda s: s >= 0.5).alias("passes"), F.round(tx.mean(F.col("scores")), 9).alias("confidence"))


def strip_preamble(spark, sf):
    return _turns(spark, sf).select("ord", F.md5(tx.stripped(F.col("text")).cast("binary")).alias("text_md5"))


def refusal_flag(spark, sf):
    return _turns(spark, sf).select("ord", tx.is_refusal(F.col("text")).alias("refusal"))


def tokens(spark, sf):
    return _docs(spark, sf).select("doc_id", F.size(tx.tokens(F.col("text"))).alias("n"), F.md5(F.array_join(tx.tokens(F.col("text")), " ").cast("binary")).alias("tokens_md5"))


def shingles(spark, sf):
    return _docs(spark, sf).select("doc_id", tx.shingles(tx.tokens(F.col("text"))).alias("s")).select("doc_id", F.size("s").alias("n"), F.md5(F.array_join(F.array_sort("s"), "|").cast("binary")).alias("shingles_md5"))


def _signed(spark, sf):
    return dedup.signatures(_docs(spark, sf).select(F.col("doc_id").alias("ord"), "text"), ["ord"])


def minhash_sig(spark, sf):
    return _signed(spark, sf).select(F.col("ord").alias("doc_id"), F.md5(F.array_join("sig", ",").cast("binary")).alias("sig_md5"))


def lsh_bands(spark, sf):
    return dedup.bands(_signed(spark, sf), ["ord"]).select(F.col("ord").alias("doc_id"), "band", "band_key")


def near_dup_pairs(spark, sf):
    return dedup.collisions(stored(dedup.bands(_signed(spark, sf), ["ord"]), "bands"), [])


def near_dedup(spark, sf):
    df = _docs(spark, sf).select(F.lit("all").alias("prompt"), F.col("doc_id").alias("ord"), "text")
    return dedup.near_dedup(df, ["prompt"]).select("ord", "kept")


def near_dedup_incremental(spark, sf):
    df = _docs(spark, sf).select(F.lit("all").alias("prompt"), F.col("doc_id").alias("ord"), "text", "source")
    old = df.where("source = 'src0'")
    kept = dedup.near_dedup(old.drop("source"), ["prompt"]).where("kept")
    known = old.join(kept.select("ord"), "ord", "left_semi").select("prompt", "text")
    return dedup.near_dedup(df.where("source <> 'src0'").drop("source"), ["prompt"], known=known).select("ord", "kept")


def dup_audit(spark, sf):
    return near_dedup(spark, sf).agg(F.count("*").alias("total"), F.count_if(~F.col("kept")).alias("dup"), F.count_if("kept").alias("uniq"), F.coalesce(F.round(F.count_if(~F.col("kept")) * 100.0 / F.count("*"), 6), F.lit(0.0)).alias("pct"))


def size_str(spark, sf):
    n = F.col("doc_id") * F.col("doc_id") * F.col("n_chars")
    return _read(spark, sf, "documents").select("doc_id", tx.size_text(n).alias("size"))


def text_head(spark, sf):
    return _docs(spark, sf).select("doc_id", F.md5(tx.text_head(F.col("text")).cast("binary")).alias("head_md5"))


def length_gate(spark, sf):
    return _turns(spark, sf).select("ord", F.length("text").between(150, 8000).alias("ok"))


def _format(name):
    def query(spark, sf):
        test = {"faq": tx.is_faq, "math": tx.is_math, "table": tx.is_table, "tutorial": tx.is_tutorial}[name]
        return _docs(spark, sf).select("doc_id", test(F.col("text")).alias("ok"))

    return query


def format_gate(spark, sf):
    return _turns(spark, sf).select("ord", "prompt", tx.format_ok(F.col("text"), F.col("prompt")).alias("ok"))


def filter_chain(spark, sf):
    turns, config = _judged(spark, sf)
    return curate.outcomes(turns, config).select("ord", "prompt", "status")


def kept_outcomes(spark, sf):
    """Documents as outputs of one task, behind an opener that is stripped: the kept side of the chain, with its duplicates."""
    config = CONFIG.having(lid_threshold=0.0)
    text = F.concat(F.lit("Φυσικά! 1. "), "text")
    docs = _docs(spark, sf).select(F.col("doc_id").alias("ord"), F.lit("tutorial").alias("prompt"), text.alias("text"))
    return curate.outcomes(docs, config).select("ord", "status", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def failed_records(spark, sf):
    turns, config = _judged(spark, sf)
    return curate.outcomes(turns, config).where("status <> ''").select("ord", "prompt", F.md5(F.col("text").cast("binary")).alias("text_md5"), "language_confidence", F.col("status").alias("failure_reason"))


def filter_stats(spark, sf):
    turns, config = _judged(spark, sf)
    return rows.filter_stats(curate.outcomes(turns, config))


def confidence_stats(spark, sf):
    score = tx.language_score(F.col("text"), "en")
    return _docs(spark, sf).select(score.alias("c")).where("c >= 0.5").agg(F.round(F.min("c"), 9).alias("lo"), F.round(F.avg("c"), 9).alias("mean"), F.round(F.max("c"), 9).alias("hi"))


def prompt_fanout(spark, sf):
    return rows.fanout(_read(spark, sf, "documents").select("doc_id"))


def _pages(spark, sf):
    return _read(spark, sf, "pages").select(F.col("page_id").alias("ord"), F.regexp_replace("url", r"[?#].*$", "").alias("source_id"))


def _seen(spark, sf):
    pages = _pages(spark, sf)
    return pages.where("ord % 3 = 0").select(F.lit("faq").alias("prompt"), "source_id").unionByName(pages.where("ord % 5 = 0").select(F.lit("math").alias("prompt"), "source_id"))


def resume_ids(spark, sf):
    return _seen(spark, sf).where("source_id is not null").distinct()


def resume_anti_join(spark, sf):
    return rows.unseen(rows.fanout(_pages(spark, sf)), resume_ids(spark, sf)).select("ord", "prompt", "source_id")


def first_per_source(spark, sf):
    return rows.first_per_source(rows.fanout(_pages(spark, sf))).select("ord", "prompt", "source_id")


def max_docs(spark, sf):
    return rows.limited(resume_anti_join(spark, sf), 40).select("ord", "prompt")


def seen_counts(spark, sf):
    every = spark.createDataFrame([(p,) for p in PROMPTS], "prompt string")
    return every.join(resume_ids(spark, sf).groupBy("prompt").agg(F.count("*").alias("n")), "prompt", "left").select("prompt", F.coalesce("n", F.lit(0)).alias("n"))


def skip_counts(spark, sf):
    return rows.skips(_pages(spark, sf), resume_ids(spark, sf))


def by_source(spark, sf):
    return _read(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("len")).orderBy(F.desc("len"), "source")


def spot_check(spark, sf):
    return rows.sampled(_turns(spark, sf).select("ord", "prompt", F.col("ord").alias("source_id"))).select("ord", "prompt")


def rephrase_stub(spark, sf):
    pairs = rows.fanout(_docs(spark, sf).select(F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("source_id"), "text"))
    return curate.rephrased(pairs, CONFIG).select("ord", "prompt", F.md5(F.col("text").cast("binary")).alias("text_md5"), "model", "source_data")


def route_buckets(spark, sf):
    x = F.col("event_id") / 977.0 - 0.05
    return _read(spark, sf, "events").select("event_id", *[tx.bucket(x, n).alias(f"of_{n}") for n in (1, 2, 3, 4, 7)])


def shard_assign(spark, sf):
    return rows.shard_numbers(_read(spark, sf, "documents").select(F.col("source").alias("prompt"), F.col("doc_id").alias("ord")), 8, ["prompt"], chunk=256).select("prompt", "ord", "shard")


def _written(spark, sf, runs=1):
    """Every turn as a record, written in ``runs`` runs of 40 records a shard; every fifth as a failed one."""
    turns, _ = _judged(spark, sf)
    root = scratch(spark, "shards")
    done = turns.withColumn("status", F.when(F.col("ord") % 5 == 0, STATUSES[1]).otherwise("")).withColumn("language_confidence", (F.col("ord") % 100) / F.lit(100.0))
    for k in range(runs):
        sink.write_shards(done.where(F.col("ord") % runs == k), root, rows=40)
    return root


def shard_sizes(spark, sf):
    """Numbers go on over two runs, and only a run's last shard is short."""
    root = _written(spark, sf, 2)
    kept = spark.read.parquet(f"{root}/kept").groupBy("prompt", "shard").agg(F.count("*").alias("n")).withColumn("kind", F.lit("kept"))
    return kept.unionByName(spark.read.parquet(f"{root}/failed").groupBy("prompt", "shard").agg(F.count("*").alias("n")).withColumn("kind", F.lit("failed")))


def next_shards(spark, sf):
    root = _written(spark, sf, 2)
    both = [scan.next_shards(spark, root, kind).withColumn("kind", F.lit(kind)) for kind in ("kept", "failed", "none")]
    return both[0].unionByName(both[1]).unionByName(both[2])


def shard_totals(spark, sf):
    found = scan.totals(spark, _written(spark, sf))
    return found.select("prompt", "shards", "rows", (F.col("bytes") > 0).alias("has_bytes"))


def seen_on_disk(spark, sf):
    root = _written(spark, sf)
    some = [scan.seen_ids(spark, root, "conversations", retry).withColumn("retry", F.lit(retry)) for retry in (True, False)]
    return some[0].unionByName(some[1])


def kept_records(spark, sf):
    """What is read back of the kept shards, as written."""
    cols = ("source_id", "source_data", "prompt", "model", "language_confidence")
    return scan.shards(spark, _written(spark, sf)).select(*cols, F.md5(F.col("text").cast("binary")).alias("text_md5"))


def failed_shards(spark, sf):
    return scan.shards(spark, _written(spark, sf), "failed").select("source_id", "prompt", "failure_reason", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def known_texts(spark, sf):
    return scan.kept_texts(spark, _written(spark, sf), "conversations").groupBy("prompt").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


def shard_confidence(spark, sf):
    sampled = rows.confidence_stats(scan.shards(spark, _written(spark, sf)).withColumn("c", F.round(F.col("language_confidence").cast("double"), 6)), ("prompt",), "c")
    return sampled.select("prompt", F.round("lo", 6).alias("lo"), F.round("mean", 6).alias("mean"), F.round("hi", 6).alias("hi"))


def merge_shards(spark, sf):
    root = _written(spark, sf)
    sink.merge_shards(scan.shards(spark, root), f"{root}/merged")
    return spark.read.schema(RECORD).parquet(f"{root}/merged").groupBy("prompt", "source_data").agg(F.count("*").alias("n_rows"), F.sum(F.octet_length("text")).alias("bytes"))


def publish_plan(spark, sf):
    return sink.publish_plan(spark, _written(spark, sf), PROMPTS[:3], "/run1/").select("remote", F.regexp_extract("local", r"(kept/prompt=\w+/shard=\d+)/", 1).alias("folder"))


class _Memory:
    """Keeps what is published as rows."""

    def __init__(self):
        self.remote, self.card = [], ""

    def has(self, remote):
        return remote.endswith("part-00000.parquet")

    def upload(self, local, remote):
        self.remote.append(remote)

    def write_card(self, text, force=False):
        self.card = text


def published(spark, sf):
    """The names of the uploads, without those that were there."""
    to = _Memory()
    sink.publish(spark, _written(spark, sf), to, CONFIG, dry_run=False)
    return spark.createDataFrame([(r,) for r in to.remote], "remote string")


def dataset_card(spark, sf):
    """The card's table of columns."""
    lines = [x.split(" | ") for x in sink.card(CONFIG).split("\n") if x.startswith("| `")]
    return spark.createDataFrame([(x[0].strip("| `"), x[1]) for x in lines], "name string, type string")


def failing(endpoint, prompt, request):
    """Fails for texts whose length is a multiple of seven."""
    text = curate.echo(endpoint, prompt, request)
    if len(text) % 7 == 0:
        raise ValueError(f"{len(text)} characters")
    return text


def rephrase_errors(spark, sf):
    pairs = rows.fanout(_docs(spark, sf).select(F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("source_id"), "text"))
    return curate.rephrased(pairs, CONFIG, failing, in_flight=4).where("error is not null").select("ord", "prompt", "error")


def endpoints(spark, sf):
    """The endpoint that each pair is sent to, of three."""
    pairs = rows.fanout(_docs(spark, sf).select("doc_id"))
    return pairs.select("doc_id", "prompt", curate.endpoint(F.col("doc_id").cast("string"), F.col("prompt"), 3).alias("endpoint"))


QUERIES = {f.__name__: f for f in (
    verdict_profile, scan_documents, profile_limited, truncate_docs, prompt_render, normalize_ws, lid_slices, lang_score, lang_gate, strip_preamble, refusal_flag, tokens, shingles,
    minhash_sig, lsh_bands, near_dup_pairs, near_dedup, near_dedup_incremental, dup_audit, size_str, text_head, length_gate, format_gate, filter_chain, kept_outcomes, failed_records, filter_stats,
    confidence_stats, prompt_fanout, resume_ids, resume_anti_join, first_per_source, max_docs, seen_counts, skip_counts, by_source, spot_check, rephrase_stub, route_buckets, shard_assign, merge_shards, publish_plan,
    source_order, stream_scan, source_fallback, shard_sizes, next_shards, shard_totals, seen_on_disk, kept_records, failed_shards, known_texts, shard_confidence, published, dataset_card, rephrase_errors, endpoints,
)} | {f"format_{n}": _format(n) for n in PROMPTS}

# ---- SQL ---------------------------------------------------------------------------------------
_n = lambda t, c: f"length(regexp_replace({t}, '[^{c}]', '', 'g'))"
_VERDICT = (
    "case when length(t) < 200 then 'too_short' when length(t) > 20000 then 'too_long' when {l} = 0 then 'no_letters' when {s} / {l} < 0.6::double then 'not_greek'"
    " when list_sum(list_transform(regexp_extract_all(t, '(?i)https?://\\S+'), lambda x: length(x))) / length(t) > 0.05::double then 'too_many_urls'"
    " when {u} / {l} > 0.4::double then 'too_much_upper' when {p} / length(t) > 0.25::double then 'too_much_punct' else 'kept' end"
).format(l=_n("t", r"\p{L}"), s=_n("t", r"\p{Latin}"), u=_n("t", r"\p{Lu}"), p=_n("t", r"\p{P}"))
_DOCS = "d as (select doc_id, coalesce(text, '') as t, source, n_chars from documents)"
_PROMPT = "list_extract([" + ", ".join(f"'{p}'" for p in PROMPTS) + "], (conv_id % 4 + 1)::int)"
_TURNS = f"d as (select conv_id * 1000 + turn as ord, {_PROMPT} as prompt, coalesce(text, '') as t from conversations where role = 'assistant')"
_PROFILE = f"""v as (select n_chars, {_VERDICT} as verdict from d), e as (select unnest([{', '.join(f"'{v}'" for v in VERDICTS)}]) as verdict),
 g as (select e.verdict, count(n_chars) as docs, coalesce(sum(n_chars), 0)::bigint as tokens from e left join v using (verdict) group by 1)
 select verdict, docs, tokens, docs * 100.0::double / greatest(sum(docs) over (), 1) as docs_pct, tokens * 100.0::double / greatest(sum(tokens) over (), 1) as tokens_pct from g"""
_TRUNC = lambda n: f"case when length(t) <= {n} then t when contains(left(t, {n}), chr(10)) then regexp_extract(left(t, {n}), '(?s)^(.*)\\n[^\\n]*$', 1) else left(t, {n}) end"
_TOK = f"regexp_extract_all(lower(t), '{TOKEN}')"
_SH = "case when len(k) = 0 then [] else list_distinct(list_transform(range(1, greatest(len(k) - 4, 1) + 1), lambda i: array_to_string(list_slice(k, i, i + 4), ' '))) end"
_COLLAPSE = "trim(regexp_replace({t}, '[\\s\\x{0b}\\x{85}\\x{a0}\\x{2028}\\x{2029}\\x{3000}]+', ' ', 'g'))"
_words = lambda own: "[" + ", ".join(f"'{w}'" for w in own) + "]"


def _language(t: str, lang: str) -> str:
    k = f"regexp_extract_all(lower({_COLLAPSE.replace('{t}', t)}), '{TOKEN}')"
    hits = {c: f"len(list_filter({k}, lambda w: list_contains({_words(own)}, w)))" for c, own in sorted(tx.STOPWORDS.items())}
    top = " and ".join(f"{hits[lang]} {'>' if c < lang else '>='} {h}" for c, h in hits.items() if c != lang)
    return f"case when {top} and {hits[lang]} > 0 then {hits[lang]}::double / ({' + '.join(hits.values())}) else 0.0::double end"


_STRIP = f"regexp_replace(t, '^(?:(?i:{OPENERS})|(?i:{INTRODUCTIONS})|{BOLD_TITLE}|\\s)*', '')"
_REFUSES = f"regexp_matches({_STRIP}, '^(?i)\\s*{REFUSALS}')"
_STRIPPED = f"case when {_REFUSES} then '' else {_STRIP} end"
_FORMAT = {
    "faq": "(length({t}) - length(replace(replace({t}, '?', ''), ';', '')) >= 3 and length({t}) - length(replace({t}, chr(10), '')) >= 4)",
    "math": "(regexp_matches({t}, '\\p{{Nd}}') and regexp_matches({t}, '(?i)(λύση|βήμα)'))",
    "table": "contains(array_to_string(list_transform(string_split_regex({t}, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e]'), lambda x: case when regexp_matches(x, '^\\s*\\|.*\\|\\s*$') then '1' else '0' end), ''), '111')",
    "tutorial": "(length({t}) > 300 and (regexp_matches({t}, '(?m)^\\s*\\d+[.)]\\s+\\S') or len(regexp_extract_all({t}, '(?m)^\\s*[-*•]\\s+\\S')) >= 3))",
}
_GATE = lambda t: "case prompt " + " ".join(f"when '{p}' then {_FORMAT[p].format(t=t)}" for p in PROMPTS) + " else false end"
_WORD = lambda x: f"('0x' || left(md5({x}), 8))::bigint"


def _signature(source: str) -> str:
    """``sig(ord, sig)`` of ``source(ord, t)``."""
    return f"""tk as (select ord, {_TOK} as k from {source}), sh as (select ord, {_SH} as s from tk),
 h as (select ord, unnest(s) as x from sh), hh as (select ord, {_WORD('x')} % 2147483647 as x from h),
 pm as (select i, 1 + {_WORD("'a' || i")} % 2147483646 as a, {_WORD("'b' || i")} % 2147483647 as b from range(128) r(i)),
 mn as (select ord, i, min((a * x + b) % 2147483647) as m from hh cross join pm group by 1, 2),
 sg as (select ord, list(m order by i) as sig from mn group by 1),
 sig as (select s.ord, coalesce(g.sig, list_transform(range(128), lambda i: 2147483647)) as sig from {source} s left join sg g using (ord))"""


_BANDS = "bd as (select ord, unnest(range(9)) as band, sig from sig), bands as (select ord, band::int as band, md5(array_to_string(list_slice(sig, band * 13 + 1, band * 13 + 13), ',')) as band_key from bd)"
_EDGES = "edges as (select distinct a.ord as early, b.ord as late from bands a join bands b using (band, band_key) where a.ord < b.ord)"


def _kept(rounds: int = 6, nodes: str = "sig", edges: str = "edges", x: str = "") -> str:
    """``final(ord, kept)`` (names with the prefix ``x``): the rounds unrolled; an undecided row would show as null."""
    out = [f"{x}s0 as (select ord, case when ord in (select late from {edges}) then null else true end as kept from {nodes})"]
    for r in range(1, rounds + 1):
        out.append(f"{x}t{r} as (select late as ord, bool_or(coalesce(kept, false)) as yes, count(*) filter (kept is null) as open from {edges} join {x}s{r - 1} on early = ord group by 1), {x}s{r} as (select s.ord, coalesce(kept, case when yes then false when open = 0 then true end) as kept from {x}s{r - 1} s left join {x}t{r} using (ord))")
    return ", ".join(out) + f", {x}final as (select * from {x}s{rounds})"


_DEDUP = f"with d as (select doc_id as ord, coalesce(text, '') as t from documents), {_signature('d')}, {_BANDS}, {_EDGES}, {_kept()}"
_STARTS = ", ".join(f"({n}, [{', '.join(map(str, tx.drawn_starts(n)))}])" for n in range(501, LONGEST_TURN))
_CHUNKS = f"""st(len, own) as (values {_STARTS}),
 ck as (select ord, case when length(t) <= 500 then [t] else list_transform(own, lambda s: substr(t, s + 1, 500)) end as chunks from d left join st on st.len = length(t)),
 ch as (select ord, unnest(range(len(chunks)))::int as slice, unnest(chunks) as chunk from ck)"""
_SCORES = f"sc as (select ord, bool_and(s >= 0.5) as passes, list_sum(list(s order by slice)) / count(*) as conf from (select ord, slice, {_language('chunk', 'en')} as s from ch) group by 1)"
_JUDGED = f"{_CHUNKS}, {_SCORES}, j as (select ord, prompt, t, passes, {_STRIPPED} as st from d join sc using (ord)), l as (select *, case when not passes then '{STATUSES[0]}' when not (length(st) between 150 and 8000) then '{STATUSES[1]}' when not ({_GATE('st')}) then '{STATUSES[2]}' else '' end as local from j)"
_PAGES = "p as (select page_id as ord, regexp_replace(url, '[?#].*$', '') as source_id from pages)"
_SEEN = "seen as (select distinct prompt, source_id from (select 'faq' as prompt, source_id from p where ord % 3 = 0 union all select 'math', source_id from p where ord % 5 = 0) where source_id is not null)"
_FAN = "f as (select p.*, x.prompt from p cross join (select unnest([" + ", ".join(f"'{p}'" for p in PROMPTS) + "]) as prompt) x)"
_bucket = lambda n: f"case when x < 0 or x > 1 then {n - 1} else list_min(list_filter(range({n}), lambda i: x <= (i + 1) / {n}.0::double)) end::int as of_{n}"
_SHARDS = "s as (select source as prompt, doc_id as ord, (row_number() over (partition by source order by doc_id) - 1) // 8 as shard from documents)"
_TEMPLATE = lambda p: "'" + TEMPLATES[p].replace("'", "''") + "'"

_WRITTEN = f"w as (select ord, prompt, t, ord::varchar as source_id, ord % 2 as run, case when ord % 5 = 0 then 'failed' else 'kept' end as kind from d)"
_ALL_PROMPTS = f"ap as (select unnest({_words(PROMPTS)}) as prompt)"
_COUNT_SHARDS = "select prompt, kind, run, count(*) as n, ((count(*) + 39) // 40)::int as k from w group by all"

ORACLE_SQL = {
    "verdict_profile": f"with {_DOCS}, {_PROFILE}",
    "scan_documents": f"with {_DOCS}, n as (select *, row_number() over () - 1 as row from d) select doc_id::varchar as source_id, row, length(t)::int as n, {_VERDICT} as verdict from n",
    "source_order": "with n as (select doc_id::varchar as id, row_number() over () as r from documents) select min_by(id, r) as first_id, max_by(id, r) as last_id, count(*) as n from n",
    "stream_scan": "select i as row, i::varchar as source_id, 'number ' || i as text from range(1000) t(i)",
    "source_fallback": "select doc_id::varchar as source_id, row_number() over () - 1 as row, length(coalesce(text, ''))::int as n from documents",
    "lid_slices": f"with {_TURNS}, {_CHUNKS} select ord, slice, md5(chunk) as chunk_md5 from ch",
    "lang_gate": f"with {_TURNS}, {_CHUNKS}, {_SCORES} select ord, passes, round(conf, 9) as confidence from sc",
    "profile_limited": f"with d as (select doc_id, coalesce(text, '') as t, n_chars from documents order by doc_id limit 100), {_PROFILE}",
    "truncate_docs": f"with {_DOCS}, x as (select doc_id, {_TRUNC(600)} as h from d) select doc_id, md5(h) as head_md5, length(h)::int as n from x",
    "prompt_render": f"with {_DOCS}, x as (select doc_id, {_TRUNC(12000)} as h from d) " + " union all ".join(f"select doc_id, '{p}' as prompt, md5(replace({_TEMPLATE(p)}, '{{doc}}', h)) as request_md5 from x" for p in PROMPTS),
    "normalize_ws": f"with {_DOCS} select doc_id, md5({_COLLAPSE.replace('{t}', 't')}) as text_md5 from d",
    "lang_score": f"with {_DOCS} select doc_id, round({_language('t', 'en')}, 9) as score from d",
    "strip_preamble": f"with {_TURNS} select ord, md5({_STRIPPED}) as text_md5 from d",
    "refusal_flag": f"with {_TURNS} select ord, {_REFUSES} as refusal from d",
    "tokens": f"with {_DOCS} select doc_id, len({_TOK})::int as n, md5(array_to_string({_TOK}, ' ')) as tokens_md5 from d",
    "shingles": f"with {_DOCS}, x as (select doc_id, {_TOK} as k from d), y as (select doc_id, {_SH} as s from x) select doc_id, len(s)::int as n, md5(array_to_string(list_sort(s), '|')) as shingles_md5 from y",
    "minhash_sig": f"with d as (select doc_id as ord, coalesce(text, '') as t from documents), {_signature('d')} select ord as doc_id, md5(array_to_string(sig, ',')) as sig_md5 from sig",
    "lsh_bands": f"with d as (select doc_id as ord, coalesce(text, '') as t from documents), {_signature('d')}, {_BANDS} select ord as doc_id, band, band_key from bands",
    "near_dup_pairs": f"with d as (select doc_id as ord, coalesce(text, '') as t from documents), {_signature('d')}, {_BANDS}, hd as (select band, band_key, min(ord) as early from bands group by 1, 2) select distinct early, ord as late from bands join hd using (band, band_key) where early < ord",
    "near_dedup": f"{_DEDUP} select ord, kept from final",
    "near_dedup_incremental": f"""with d as (select doc_id as ord, coalesce(text, '') as t from documents), {_signature('d')}, {_BANDS}, {_EDGES}, o as (select doc_id as ord, coalesce(source = 'src0', false) as old, source is null as none from documents),
 on_ as (select ord from o where old), oe as (select early, late from edges join on_ a on a.ord = early join on_ b on b.ord = late), {_kept(nodes="on_", edges="oe", x="o")},
 hit as (select distinct b.ord from bands b join bands a using (band, band_key) join ofinal f on f.ord = a.ord and f.kept join o on o.ord = b.ord and not o.old and not o.none),
 nn as (select ord from o where not old and not none and ord not in (select ord from hit)), ne as (select early, late from edges join nn a on a.ord = early join nn b on b.ord = late), {_kept(nodes="nn", edges="ne", x="n")}
 select ord, kept from nfinal union all select ord, false from hit""",
    "dup_audit": f"{_DEDUP} select count(*) as total, count(*) filter (not kept) as dup, count(*) filter (kept) as uniq, coalesce(round(count(*) filter (not kept) * 100.0::double / count(*), 6), 0) as pct from final",
    "size_str": "with x as (select doc_id, doc_id * doc_id * n_chars as n from documents) select doc_id, case when n < 1024 then printf('%.1fB', n::double) when n < 1048576 then printf('%.1fKB', n / 1024.0::double) when n < 1073741824 then printf('%.1fMB', n / 1048576.0::double) when n < 1099511627776 then printf('%.1fGB', n / 1073741824.0::double) else printf('%.1fTB', n / 1099511627776.0::double) end as size from x",
    "text_head": f"with {_DOCS} select doc_id, md5(array_to_string(list_slice(string_split_regex(regexp_replace(t, '^\\s+|\\s+$', '', 'g'), '\\r\\n|[\\n\\r]'), 1, 6), chr(10))) as head_md5 from d",
    "length_gate": f"with {_TURNS} select ord, length(t) between 150 and 8000 as ok from d",
    "format_gate": f"with {_TURNS} select ord, prompt, {_GATE('t')} as ok from d",
    "confidence_stats": f"with {_DOCS}, x as (select {_language('t', 'en')} as c from d) select round(min(c), 9) as lo, round(avg(c), 9) as mean, round(max(c), 9) as hi from x where c >= 0.5",
    "prompt_fanout": "with p as (select doc_id from documents), " + _FAN + " select doc_id, prompt from f",
    "resume_ids": f"with {_PAGES}, {_SEEN} select prompt, source_id from seen",
    "resume_anti_join": f"with {_PAGES}, {_SEEN}, {_FAN} select ord, prompt, source_id from f where not exists (select 1 from seen s where s.prompt = f.prompt and s.source_id = f.source_id)",
    "first_per_source": f"with {_PAGES}, {_FAN} select min(ord) as ord, prompt, source_id from f group by prompt, source_id",
    "max_docs": f"with {_PAGES}, {_SEEN}, {_FAN}, o as (select ord, prompt from f where not exists (select 1 from seen s where s.prompt = f.prompt and s.source_id = f.source_id)) select ord, prompt from o where ord in (select distinct ord from o order by ord limit 40)",
    "seen_counts": f"with {_PAGES}, {_SEEN}, e as (select unnest([{', '.join(repr(p) for p in PROMPTS)}]) as prompt) select e.prompt, count(source_id) as n from e left join seen using (prompt) group by 1",
    "skip_counts": f"with {_PAGES}, {_SEEN}, {_FAN} select f.prompt, count(s.source_id) as skipped from f left join seen s on s.prompt = f.prompt and s.source_id = f.source_id group by 1",
    "by_source": "select source, count(*) as len from documents group by 1",
    "spot_check": f"with {_TURNS}, r as (select ord, prompt, row_number() over (partition by prompt order by md5('0' || ord), ord) as r from d) select ord, prompt from r where r <= 12",
    "rephrase_stub": f"with {_DOCS}, x as (select doc_id, {_TRUNC(12000)} as h from d) " + " union all ".join(f"select doc_id as ord, '{p}' as prompt, md5(h) as text_md5, '{CONFIG.generator.model}' as model, '{CONFIG.source.subset}' as source_data from x" for p in PROMPTS),
    "route_buckets": f"with e as (select event_id, event_id / 977.0::double - 0.05::double as x from events) select event_id, {', '.join(_bucket(n) for n in (1, 2, 3, 4, 7))} from e",
    "shard_assign": f"with {_SHARDS} select prompt, ord, shard from s",
    "merge_shards": f"with {_TURNS}, {_WRITTEN} select prompt, 'conversations' as source_data, count(*) as n_rows, sum(strlen(t))::bigint as bytes from w where kind = 'kept' group by 1",
    "publish_plan": f"with {_TURNS}, {_WRITTEN}, c as (select prompt, ((count(*) + 39) // 40)::int as k from w where kind = 'kept' and list_contains({_words(PROMPTS[:3])}, prompt) group by 1), s as (select prompt, unnest(range(k)) as i from c) select prompt || '/run1/' || printf('part-%05d.parquet', i) as remote, 'kept/prompt=' || prompt || '/shard=' || i as folder from s",
    "shard_sizes": f"with {_TURNS}, {_WRITTEN}, c as ({_COUNT_SHARDS}), o as (select c.*, case when run = 1 then coalesce((select k from c z where z.prompt = c.prompt and z.kind = c.kind and z.run = 0), 0) else 0 end as before from c), s as (select *, unnest(range(k)) as i from o) select prompt, (before + i)::int as shard, least(40, n - 40 * i) as n, kind from s",
    "next_shards": f"with {_TURNS}, {_WRITTEN}, c as ({_COUNT_SHARDS}), {_ALL_PROMPTS}, ks as (select unnest(['kept', 'failed', 'none']) as kind) select ap.prompt, coalesce(sum(k), 0)::int as next, ks.kind from ap cross join ks left join c on c.prompt = ap.prompt and c.kind = ks.kind group by 1, 3",
    "shard_totals": f"with {_TURNS}, {_WRITTEN}, {_ALL_PROMPTS} select ap.prompt, ((count(ord) + 39) // 40) as shards, count(ord) as rows, count(ord) > 0 as has_bytes from ap left join w on w.prompt = ap.prompt and kind = 'kept' group by 1",
    "seen_on_disk": f"with {_TURNS}, {_WRITTEN} select prompt, source_id, true as retry from w where kind = 'kept' union all select prompt, source_id, false from w",
    "kept_records": f"with {_TURNS}, {_WRITTEN} select source_id, 'conversations' as source_data, prompt, '{CONFIG.generator.model}' as model, ((ord % 100) / 100.0::double)::float as language_confidence, md5(t) as text_md5 from w where kind = 'kept'",
    "failed_shards": f"with {_TURNS}, {_WRITTEN} select source_id, prompt, '{STATUSES[1]}' as failure_reason, md5(t) as text_md5 from w where kind = 'failed'",
    "known_texts": f"with {_TURNS}, {_WRITTEN} select prompt, count(*) as n, sum(length(t))::bigint as chars from w where kind = 'kept' group by 1",
    "shard_confidence": f"with {_TURNS}, {_WRITTEN}, c as (select prompt, (ord % 100) / 100.0::double as c from w where kind = 'kept') select prompt, round(min(c), 6) as lo, round(avg(c), 6) as mean, round(max(c), 6) as hi from c group by 1",
    "published": f"with {_TURNS}, {_WRITTEN}, c as (select prompt, ((count(*) + 39) // 40)::int as k from w where kind = 'kept' group by 1) select prompt || '/' || printf('part-%05d.parquet', i) as remote from (select prompt, unnest(range(1, k)) as i from c)",
    "dataset_card": "select * from (values " + ", ".join(f"('{f.name}', '{f.dataType.simpleString()}')" for f in RECORD.fields) + ") t(name, type)",
    "rephrase_errors": f"with {_DOCS}, x as (select doc_id, length({_TRUNC(12000)}) as n from d) select doc_id as ord, prompt, 'ValueError: ' || n || ' characters' as error from x cross join (select unnest({_words(PROMPTS)}) as prompt) where n % 7 = 0",
    "endpoints": f"with e as (select doc_id, prompt, {_WORD("doc_id || '|' || prompt")} / 4294967296.0::double as x from documents cross join (select unnest({_words(PROMPTS)}) as prompt)) select doc_id, prompt, {_bucket(3)[:-4]}endpoint from e",
} | {f"format_{p}": f"with {_DOCS} select doc_id, {_FORMAT[p].format(t='t')} as ok from d" for p in PROMPTS}
_CHAIN = f"with {_TURNS}, {_JUDGED}, k as (select ord, prompt, st as t from l where local = ''), {_signature('k')}, {_BANDS}, edges as (select distinct a.ord as early, b.ord as late from bands a join bands b using (band, band_key) join k ka on ka.ord = a.ord join k kb on kb.ord = b.ord where a.ord < b.ord and ka.prompt = kb.prompt), {_kept()}, o as (select l.*, case when local <> '' then local when kept then '' else '{STATUSES[3]}' end as status from l left join final using (ord))"
ORACLE_SQL["kept_outcomes"] = f"""with d as (select doc_id as ord, 'tutorial' as prompt, 'Φυσικά! 1. ' || coalesce(text, '') as t from documents),
 l as (select ord, prompt, t, {_STRIPPED} as st, case when not (length(st) between 150 and 8000) then '{STATUSES[1]}' when not ({_GATE('st')}) then '{STATUSES[2]}' else '' end as local from d),
 {_CHAIN[_CHAIN.index("k as (select ord, prompt, st"):]} select ord, status, md5(case when status = '' then st else t end) as text_md5 from o"""
ORACLE_SQL["filter_chain"] = f"{_CHAIN} select ord, prompt, status from o"
ORACLE_SQL["failed_records"] = f"{_CHAIN} select ord, prompt, md5(t) as text_md5, null::float as language_confidence, status as failure_reason from o where status <> ''"
_NAMES = ("dropped_lang", "dropped_length", "dropped_format", "dropped_dup")
_COUNTS = ", ".join(f"count(*) filter (status = '{s}') as {n}" for s, n in zip((*STATUSES, ""), (*_NAMES, "kept"), strict=True))
ORACLE_SQL["filter_stats"] = f"{_CHAIN}, c as (select count(*) as seen, {_COUNTS} from o) select *, {', '.join(f'{n} * 100.0::double / greatest(seen, 1) as {n}_pct' for n in (*_NAMES, 'kept'))} from c"
