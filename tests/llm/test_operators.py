"""Each operator against a brute-force version, on the smallest tables and on rows made for the edges."""

import base64
import collections
import hashlib
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import html_text, packing, queries, suffix_match, toxicity, url_filter, warc
from corpusmill.llm.fingerprint import containment, fingerprints, merged, sketches
from corpusmill.llm.license_scan import license_scan
from corpusmill.llm.ngram_join import jaccard_components
from corpusmill.llm.sharding import histogram_shards

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, length string, id string, size string"


def edge_rows():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [str(x) for x in rng.choice(vocabulary, 120)]
    texts = [None, "", " \n\t", "one", "one two three four", "A B C D E", "a b c d e", "Été ñandú straße 𝔘nicode kept whole here", "x" * 5000, " ".join(vocabulary * 30)]
    texts += [" ".join(base)] * 40
    for k in range(40):
        words = list(base)
        for at in rng.integers(0, 120, k % 8):
            words[at] = f"edit{k}"
        texts.append(" ".join(words))
    texts += [" ".join(str(x) for x in rng.choice(vocabulary, 30)) + " " + " ".join(base[:60]) for _ in range(40)]
    texts += ["This is under the MIT License. Apache License, Version 2.0; CC BY-NC 4.0", "All rights reserved.", "GNU General Public License, version 3 this work"]
    rows = [(i, t, "en", "hot" if i % 3 == 0 else f"s{i % 7}", 0, "x", "y", "z") for i, t in enumerate(texts)]
    return rows + [rows[12], (None, "no id", None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(5)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def both(edges, docs):
    return [edges, docs, edges.limit(0)]


def shingle_set(text, k=5):
    w = SPACED.findall((text or "").translate(ASCII))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_ngram_join(edges, docs):
    for df in both(edges, docs):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        sets = [(i, frozenset(shingle_set(t))) for i, t in rows if i is not None]
        root = {i: i for i, _ in sets}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, (i, s) in enumerate(sets):
            for j, t in sets[a + 1 :]:
                if s and t and 100 * len(s & t) >= 80 * len(s | t):
                    p, q = find(i), find(j)
                    root[max(p, q)] = min(p, q)
        want = collections.Counter((i, len(shingle_set(t)), None if i is None else find(i)) for i, t in rows)
        assert collections.Counter(tuple(r) for r in jaccard_components(df).collect()) == want


def test_suffix_matches(spark, edges, docs, sf):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text")
    extra = spark.createDataFrame([(1, "a b C"), (2, "one"), (3, None), (4, " ".join(f"w{i}" for i in range(5, 40))), (5, "w7 w8"), (6, " ".join("y" * 30 for _ in range(9))), (7, "-" * 99)], "item_id long, text string")
    for df, items, block in ((edges, extra, 24), (docs, bench.unionByName(extra), 4000), (edges.limit(0), extra, 10**6), (edges, extra.limit(0), 10)):
        windows = collections.defaultdict(set)
        for i, t in items.collect():
            w = ALNUM.findall((t or "").translate(ASCII))
            for k in range(max(1, len(w) - 9)) if w else ():
                windows[tuple(w[k : k + 10])].add(str(i))
        want = []
        for i, t in [(r.doc_id, r.text) for r in df.collect()]:
            w, hit, found = ALNUM.findall((t or "").translate(ASCII)), set(), set()
            for size in {len(x) for x in windows}:
                for k in range(len(w) - size + 1):
                    if own := windows.get(tuple(w[k : k + size])):
                        hit.update(range(k, k + size))
                        found |= own
            want.append((i, len(w), len(hit), tuple(sorted(found))))
        found = suffix_match.suffix_matches(df, items, block_words=block)
        got = found.collect()
        assert len(suffix_match.without_matches(df, items, block_words=block).collect()) == sum(not n for _, _, n, _ in want)
        assert collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == collections.Counter(want)
        assert all(bool(r.matches) == bool(r.n_hit) for r in got)


def test_suffix_shards_of_one_batch(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 3, n)) for n in rng.integers(0, 200, 60)] + [None, ""]
    block = type("Block", (), {"value": suffix_match.TestBlock(["a", "b"], texts[:2], 5)})
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    (whole,) = suffix_match._searched(iter([batch]), block, True)
    monkeypatch.setattr(suffix_match, "SHARD_WORDS", 300)
    monkeypatch.setattr(suffix_match.words, "SPAN_BYTES", 256)
    parts = list(suffix_match._searched(iter([batch]), block, True))
    assert len(parts) > 3 and pa.Table.from_batches(parts).to_pylist() == whole.to_pylist()


def test_longest_match_has_its_places(spark):
    docs = spark.createDataFrame([(1, "x y " + " ".join(f"t{i}" for i in range(20)) + " z")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "q " + " ".join(f"t{i}" for i in range(20)))], "item_id long, text string")
    (row,) = suffix_match.suffix_matches(docs, items).collect()
    assert [tuple(m) for m in row.matches] == [("9", 1, 2, 20)]


def hash_by_hand(text, k=5):
    """All distinct 64-bit shingle hashes, in plain integers."""
    m = 2**64 - 1

    def mix(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & m
        x = (x ^ x >> 27) * 0x94D049BB133111EB & m
        return x ^ x >> 31

    own = []
    for w in SPACED.findall(text.translate(ASCII)):
        total, power = 0, 1
        for b in w.encode():
            total, power = total + (b + 1) * power & m, power * 0x9E3779B97F4A7C15 & m
        own.append(mix(total + len(w.encode()) & m))
    slots = [mix(j + 1) | 1 for j in range(k)]
    return {mix((len(x) * 0x9E3779B97F4A7C15 + sum(a * b for a, b in zip(x, slots))) & m) for x in ([own[i : i + k] for i in range(max(1, len(own) - k + 1))] if own else [])}


def sketch_by_hand(text):
    own = hash_by_hand(text)
    return {x >> 16 for x in own if x < 2**61} or {x >> 16 for x in sorted(own)[:1]}


def print_by_hand(text):
    return "".join(f"{x:012x}" for x in sorted(sketch_by_hand(text)))


def near_by_hand(a, b):
    x, y = sketch_by_hand(a), sketch_by_hand(b)
    if min(len(x), len(y)) < 64:
        x, y = hash_by_hand(a), hash_by_hand(b)
    return len(x & y) / min(len(x), len(y)) if x and y else float(len(x) == len(y))


def in_turn(df):
    """(id, text, next text) by descending id, within an id by a hash of the text; null ids last."""
    import xxhash

    rows = [(-(2**63) if r.doc_id is None else r.doc_id, xxhash.xxh64_intdigest((r.text or "").encode(), 42) >> 21, r.text or "") for r in df.collect()]
    rows.sort(reverse=True)
    return [(None if i == -(2**63) else i, t, rows[(k + 1) % len(rows)][2]) for k, (i, _, t) in enumerate(rows)]


def test_fingerprints_of_a_hot_id(spark):
    rows = [(None if i % 3 else i, ("equal text" if i % 2 else f"text {i} " * 9)) for i in range(900)] + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    want = collections.Counter((i, hashlib.sha256((t[: len(t) - len(t) // 3] + after[: len(t) // 3]).encode()).hexdigest()) for i, t, after in in_turn(df))
    assert collections.Counter((r.doc_id, r.edited_sha256) for r in fingerprints(df, range_rows=60).collect()) == want


def test_fingerprints(edges, docs):
    for df in both(edges, docs):
        want = collections.Counter()
        for i, t, after in in_turn(df):
            edited = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
            near = [near_by_hand(t, edited), near_by_hand(t, after)]
            want[(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), print_by_hand(t), print_by_hand(edited), *near)] += 1
        got = fingerprints(df, range_rows=25).collect()
        assert collections.Counter(tuple(r) for r in got) == want
        by_text = collections.defaultdict(set)
        texts = {r.doc_id: r.text for r in df.collect()}
        for r in got:
            by_text[texts[r.doc_id] or ""].add(r.fingerprint)
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert all(len(x) == 1 for x in by_text.values())
        assert collections.Counter(tuple(r) for r in fingerprints(df).collect()) == want


def test_sketches_estimate_containment():
    import pyarrow as pa

    words = [f"w{i}" for i in range(20000)]
    a, b = sketches(pa.array([" ".join(words), " ".join(words[:4000])]))
    assert abs(len(a) / 19996 - 1 / 8) < 0.01 and containment(a, b) == 1.0
    assert set(merged(a, b).tolist()) == set(a.tolist())


def test_short_texts_in_long_ones_are_near(spark):
    words = [f"w{i}" for i in range(6000)]
    rows = [x for k, n in enumerate(range(5, 51)) for x in ((2 * k + 1, " ".join(words[50 * k : 50 * k + n])), (2 * k, " ".join(words[: 5000 + k])))]
    got = {r.doc_id: r for r in fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    for i in range(1, len(rows), 2):
        a, b = shingle_set(texts[i]), shingle_set(texts[i - 1])
        e = shingle_set(texts[i][: len(texts[i]) - len(texts[i]) // 3] + texts[i - 1][: len(texts[i]) // 3])
        assert got[i].near_next == len(a & b) / min(len(a), len(b)) == 1.0
        assert got[i].near_edited == len(a & e) / min(len(a), len(e))


def test_sharding(edges, docs):
    for df in both(edges, docs):
        got = histogram_shards(df, 8).select("doc_id", "text", "size", "shard", "slot").collect()
        assert collections.Counter((r.doc_id, r.text, r.size) for r in got) == collections.Counter((r.doc_id, r.text, len((r.text or "").encode()) + 1) for r in df.collect())
        sums = collections.Counter()
        for s in {r.shard for r in got}:
            assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
        for r in got:
            sums[r.shard] += r.size
        total, longest = sum(sums.values()), max((r.size for r in got), default=0)
        assert all(abs(v - total / 8) <= longest + 0.002 * total for v in sums.values())


def test_sharding_cuts_a_hot_text(spark):
    df = spark.createDataFrame([(i, "same text for all" if i % 10 else f"other {i}") for i in range(4000)], "doc_id long, text string")
    sums = {r.shard: r["b"] for r in histogram_shards(df, 8).groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    assert len(sums) == 8 and max(sums.values()) < 1.02 * min(sums.values())


def test_sharding_at_no_tolerance_is_the_sort(spark, edges, docs):
    for df in (edges, docs):
        rows = sorted((zlib.crc32((r.text or "").encode()), r.doc_id is not None, r.doc_id or 0, len((r.text or "").encode()) + 1) for r in df.collect())
        total, below, want, slots = sum(r[3] for r in rows), 0, collections.Counter(), collections.Counter()
        for _, known, i, size in rows:
            shard = min(int((below + size / 2) / (total / 8)), 7)
            want[(i if known else None, size, shard, slots[shard])] += 1
            slots[shard] += 1
            below += size
        got = histogram_shards(df, 8, tolerance=0.0).select("doc_id", F.col("size").cast("long"), "shard", "slot").collect()
        assert collections.Counter(tuple(r) for r in got) == want


def test_sharding_cuts_repeated_rows_and_keeps_columns(spark):
    rows = [(None, "same", i, "a", "b", "c", 1) for i in range(20000)]
    for parts in (1, 8):
        df = spark.createDataFrame(rows, "doc_id long, text string, range long, first string, t string, leaf string, h int").repartition(parts)
        for tolerance in (0.0, 0.001):
            out = histogram_shards(df, 8, tolerance=tolerance)
            assert out.columns == [*df.columns, "size", "shard", "slot"]
            got = out.collect()
            assert sorted(r.range for r in got) == list(range(20000)) and {r.t for r in got} == {"b"}
            for s in range(8):
                assert sorted(r.slot for r in got if r.shard == s) == list(range(2500))


def test_url_filter(spark, sf):
    urls = ["https://a.Example.com/en/x?y", "http://WWW.example.com/en/1", "x.net/es/", "ftp://k.net/es/#a", None, "", "://", "http://host", "a://b://c/d", "https://casino-win.example.net/de/", "http://net/fr/", "http://examplecom/en/", "https://h.org/" + "long/" * 10**5, *[f"http://ads.h{i}.org/{i}" for i in range(40)]]
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)] + [(0, urls[0], "z")], "page_id long, url string, host string")
    for df in (pages, spark.read.parquet(f"{sf}/pages.parquet"), pages.limit(0)):
        host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
        listed = df.where(host.rlike(queries.LISTED_WORDS)).select(F.concat(host, path).alias("key"))
        for bits in (1 << 25, 100):
            got = url_filter.judge_urls(df, listed, queries.URL_RULES, part_bits=bits).collect()
            want = collections.Counter()
            for i, u in [(r.page_id, r.url) for r in df.collect()]:
                rest = u.split("://", 1)[1] if u and "://" in u else ""
                host = re.match(r"[^/?#]*", rest)[0]
                path = re.match(r"[^?#]*", rest[len(host) :])[0]
                host = host.translate(ASCII)
                fit = [(h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
                rule, verdict = max(fit, key=lambda x: len(x[0])) if fit else (None, "block" if re.search(queries.LISTED_WORDS, host) else "allow")
                want[(i, host, path, rule, verdict)] += 1
            assert collections.Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == want


def test_cascade_is_exact(spark):
    universe = spark.range(5000).select(F.concat(F.lit("host"), "id").alias("key"), "id")
    (cascade,) = url_filter.build_cascades(universe, universe.where("id % 7 = 0"))
    assert len(cascade.levels) > 2
    assert universe.where(cascade.contains(F.col("key")) != (F.col("id") % 7 == 0)).count() == 0
    parts = url_filter.build_cascades(universe, universe.where("id % 7 = 0"), part_bits=4000)
    assert len(parts) > 1
    for p, cascade in enumerate(parts):
        own = universe.where(url_filter.part_of(F.col("key"), len(parts)) == p)
        assert own.count() and own.where(cascade.contains(F.col("key")) != (F.col("id") % 7 == 0)).count() == 0
    (empty,) = url_filter.build_cascades(universe, universe.limit(0))
    assert universe.where(empty.contains(F.col("key"))).count() == 0


def test_license_scan(edges, docs):
    for df in both(edges, docs):
        want = collections.Counter()
        for i, t in [(r.doc_id, r.text) for r in df.collect()]:
            w = ALNUM.findall((t or "").translate(ASCII))
            at = [(k, label) for p, label in queries.LICENSE_PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
            want[(i, len(w), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at})))] += 1
        got = license_scan(df, queries.LICENSE_PHRASES).collect()
        assert collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
        assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    found = {r.doc_id: r.labels for r in license_scan(edges, queries.LICENSE_PHRASES).collect()}
    last = max(i for i in found if i is not None)
    assert found[last] == "gpl-3" and found[last - 1] == "all-rights-reserved" and found[last - 2] == "apache-2,cc-by-nc,mit"


def test_license_scan_finds_frequent_key_phrases(spark):
    from corpusmill.llm.license_scan import TEMPLATES

    bare = ["GNU General Public License, version 3", "x MIT License", "All rights reserved"]
    texts = [bare[i % 3] for i in range(90)] + ["gnu General public"] * 60 + ["This work is licensed under the GNU General Public License version 3."] * 3
    for hot in (texts, texts[:90], [bare[0]] * 40 + ["plain words"] * 60, [" ".join(bare)] * 5):
        docs = spark.createDataFrame(list(enumerate(hot)), "doc_id long, text string")
        got = {r.doc_id: r for r in license_scan(docs, {}).collect()}
        for i, t in enumerate(hot):
            w = " " + " ".join(ALNUM.findall(t.translate(ASCII))) + " "
            want = sorted({label for label, _, keys in TEMPLATES if all(f" {k} " in w for _, k in keys)})
            assert got[i].labels == ",".join(want) and len(got[i].places) == len(want) and (got[i].score > 0) == bool(want)


def test_license_scan_templates(spark):
    from corpusmill.llm.license_scan import TEMPLATES

    texts = [n for _, n, _ in TEMPLATES] + [" ".join(w for _, w in k[2]) + " only" for k in TEMPLATES] + ["mit", "licensed under the gnu", None, "", "x " * 10**6 + TEMPLATES[3][1]]
    docs = spark.createDataFrame([(i, t, "w") for i, t in enumerate(texts)], "doc_id long, text string, words string")
    got = {r.doc_id: r for r in license_scan(docs, {}).collect()}
    n = len(TEMPLATES)
    for i, (label, notice, keys) in enumerate(TEMPLATES):
        assert label in got[i].labels.split(",") and got[i].score == 1.0 and (label, 0) in [tuple(p) for p in got[i].places]
        assert label in got[n + i].labels.split(",") and (label, -keys[0][0]) in [tuple(p) for p in got[n + i].places]
    assert all(got[2 * n + k].labels == "" and got[2 * n + k].score == 0 for k in range(4))
    assert got[2 * n + 4].labels == "gpl-3" and [p.first_word for p in got[2 * n + 4].places] == [10**6]
    bare = {r.doc_id: r for r in license_scan(docs, {"mit license": "mit"}, templates=[]).collect()}
    assert bare[0].labels == "mit" and bare[0].n_base == 1 and bare[0].score == 0 and {r.labels for r in license_scan(docs, {}, templates=[]).collect()} == {""}


def test_license_scan_folds_only_ascii(spark):
    texts = ["\u212aopie libre \u00e9t\u00e9", "Kopie libre \u00c9T\u00c9", "x Kopie LIBRE \u00e9t\u00e9", "M\u0130T License, under the MIT License"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan(docs, {"kopie libre \u00e9t\u00e9": "libre", "under the mit license": "mit"}).collect()}
    assert [got[i].base_labels for i in range(4)] == ["", "", "libre", "mit"] and got[2].first_word == 1 and got[3].first_word == 2


def test_warc_round_trip(spark, sf):
    rows = [(3, "http://a/\r\nx", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "u", None), (5, "u", ""), (7, "u", "x" * 200000), (9, "u", "z"), (9, "u", "z"), (None, "u", "z")]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, payload string")
    for df in (pages, spark.read.parquet(f"{sf}/pages.parquet"), pages.limit(0)):
        every = [(r.page_id, (r.html or "").encode()) for r in df.collect()]
        want = collections.Counter()
        for i, body in every:
            owner = min((j for j, b in every if b == body and j is not None), default=None)
            revisit = owner is not None and owner != i
            want[(i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", owner if revisit else None)] += 1
        got = warc.archived(df).collect()
        assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want


def test_warc_pushdown_and_members(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"body {i // 2}" * 3000) for i in range(10)], "page_id long, url string, html string")
    spark.dataSource.register(warc.WarcDataSource)
    path = f"file://{tmp_path}/w"
    warc.write_pages(pages, path)
    assert warc.read_warc(spark, path).where("record_type = 'response'").count() == 5
    assert warc.read_warc(spark, path, payload=False).where("target_uri in ('http://h/3', 'http://h/4')").count() == 2
    name = next((tmp_path / "w").glob("*.warc.gz"))
    raw, sizes = name.read_bytes(), []
    assert len(list((tmp_path / "w").glob("manifest-*.json"))) == 1
    while raw:  # any gzip reader can take the members apart
        one = zlib.decompressobj(31)
        assert one.decompress(raw).startswith(b"WARC/1.1\r\n")
        sizes.append(len(raw) - len(one.unused_data))
        raw = one.unused_data


def test_warc_jobs(spark, tmp_path):
    page = lambda own: spark.createDataFrame([(i, f"http://h/{i}", f"body {i}") for i in own], "page_id long, url string, html string")
    path, found = f"file://{tmp_path}/w", lambda: sorted(int(r.record_id[10:-1]) for r in warc.read_warc(spark, path).collect())
    warc.write_pages(page(range(5)), path)
    warc.write_pages(page(range(5, 9)), path)
    assert found() == list(range(9))
    spark.dataSource.register(warc.WarcDataSource)
    warc.read_warc(spark, path).where("target_uri = 'http://h/3'").write.format("warc").mode("overwrite").save(f"{path}2")
    warc.read_warc(spark, f"{path}2").write.format("warc").mode("overwrite").save(path)
    assert found() == [3] and len(list((tmp_path / "w").glob("*.warc.gz"))) == 1
    for name in (tmp_path / "w").glob("manifest-*.json"):
        name.unlink()
    assert found() == [3]


def test_warc_files_are_cut_at_records(spark, tmp_path, monkeypatch):
    path, rng = f"file://{tmp_path}/w", np.random.default_rng(1)
    rows = [(i, f"http://h/{i}", rng.bytes(2 << 20).hex()) for i in range(12)]
    warc.write_pages(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    spark.dataSource.register(warc.WarcDataSource)
    back = spark.read.format("warc").option("partitionBytes", str(8 << 20)).option("verify", "true").load(path)
    assert back.rdd.getNumPartitions() > 2 and len(list((tmp_path / "w").glob("*.warc.gz"))) == 1
    assert {r.target_uri: bytes(r.payload).decode() for r in back.collect()} == {u: h for _, u, h in rows}


def test_warc_owners_by_filter(spark, tmp_path):
    rows = [(i, None, f"body {i % 50 if i % 3 else i}") for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    spark.dataSource.register(warc.WarcDataSource)
    out = []
    for few in (0, 10**6):
        warc.write_pages(pages, f"file://{tmp_path}/{few}", few_owners=few)
        out.append(sorted(tuple(r) for r in warc.read_warc(spark, f"file://{tmp_path}/{few}").drop("payload").fillna("").collect()))
    assert out[0] == out[1] and len(out[0]) == 600


def test_html_text():
    page = "<!DOCTYPE html><html><head><title>T</title><script>var t='</p>';</script></head><body><nav><ul><li><a>Menu item</a></li></ul></nav><div class='ad'>Buy this now, it is very long text that looks like an article indeed.</div><article><h1>Head &amp; more</h1><p><b>First   para\ngraph.<br><p>Second &lt;one&gt;.</p><section id='comments'><p>Nice!</p></section></article><aside>Side</aside><footer>&copy; us</footer></body></html>"
    assert html_text.main_text(page) == "Head & more\nFirst para graph.\nSecond <one>."
    assert html_text.main_text("") == "" and html_text.main_text("<nav>x</nav>") == ""
    plain = "<div class=menu>a</div><div><p>" + "long text here " * 10 + "</p><p>short</p></div><footer>f</footer>"
    assert html_text.main_text(plain) == ("long text here " * 10).strip() + "\nshort"
    assert html_text.main_text("<p>unclosed <b>mark &eacute") == "unclosed mark é"


def test_html_articles_in_furniture():
    post = "A long post that goes on and on, word after word, for quite a while. " * 4
    want = post.strip()
    text = html_text.main_text
    comments = "<div id='comments'><ol><li><article class='comment-body'>Nice post!</article><li><article class='comment-body'>" + "I agree. " * 20 + "</article></ol></div>"
    teaser = "<aside class='related'><article>teaser</article></aside>"
    for extra in (comments, teaser, comments + teaser, "<nav><article>x</article></nav>", "<article class='comment'>Nice!</article>"):
        assert text(f"<div class='entry-content'>{post}</div>{extra}") == want
        assert text(f"<article><p>{post}</p></article>{extra}") == want
        assert text(f"<article><p>{post}</p>{extra}</article>") == want
        assert text(f"{extra}<p>{post}</p>") == want
    # Layout around the main text, and what was never closed.
    assert text(f"<div class='content-sidebar-wrap'><main>{post}</main><aside>x</aside></div>") == want
    assert text(f"<form><div class='has-sidebar'><article>{post}</article>{teaser}</div></form>") == want
    assert text(f"<article class='post tag-share'>{post}</article>{teaser}") == want
    assert text(f"<div class='ad'>Buy<article>{post}</article>") == want
    # Elements named article that hold little of the text don't hide the rest.
    assert text(f"<div>{post}</div><section><article>teaser</article></section>").startswith(want)


def test_html_regions_of_articles_surge():
    post, other = "word after word " * 20, "something else " * 12
    ad = "<div class='ad'>Buy</div>"
    page = f"<article><p>{post}</p>{ad}<p>A tag</p>{ad}<p>B tag</p>{ad}<p>C tag</p>{ad}<p>D tag</p></article>"
    assert "D tag" not in html_text.main_text(page) and html_text.main_text(page).startswith(post.strip())
    assert html_text.main_text(page, threshold=3).endswith("D tag")
    assert html_text.main_text(page, threshold=10**6) == post.strip()
    # Between regions that surge, those in the article go alone where they hold the bulk.
    assert html_text.main_text(f"<article>{post}</article><div>{other}</div>") == post.strip()
    assert html_text.main_text(f"<article>A short note.</article><div>{other}</div>") == "A short note.\n" + other.strip()


def test_html_keeps_short_regions_by_the_main_text():
    post, ad, share = "word after word " * 20, "<div class='ad'>Buy</div>", "<ul class='share'><li>Like</li></ul>"
    for shell in ("{}", "<article>{}</article>", "<nav>Menu</nav><div>{}</div><footer>f</footer>"):
        got = html_text.main_text(shell.format(f"<h1>Headline</h1>{share}<p>{post}</p>{ad}<p>Middle.</p>{ad}<p>{post}</p><form>x</form><p>One.</p>{ad}<p>Two.</p>{ad}<p>Three.</p>{ad}<p>Four.</p>{ad}<p>Five.</p>{ad}<p>{post}</p>{ad}<p>The end.</p>"))
        assert got.split("\n") == ["Headline", post.strip(), "Middle.", post.strip(), "One.", "Two.", "Three.", "Four.", "Five.", post.strip(), "The end."]


def test_html_broken_markup_takes_linear_time():
    start = time.monotonic()
    for page in ("<a " * 20000, '<a b="c" ' * 20000, "</a " * 20000, "<a '" * 20000, "<!x" * 20000, "<head>x" * 20000, "<!-- x " * 20000):
        for end in ("", ">"):
            html_text.main_text(page + end)
    assert time.monotonic() - start < 20
    assert html_text.main_text("<p>kept</p>a < b<!-- never > closed <p>x</p>") == "kept\na < b"
    assert html_text.main_text("<p>kept</p>1 < 2<!-- never closed") == "kept\n1 < 2"


def test_html_query(spark, sf):
    got = queries.op9_html_text(spark, sf).collect()
    assert all(r.n_chars == len(r.text) and r.text for r in got)


def test_toxicity(spark, docs, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels)
    got = toxicity.toxicity_scores(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.score < 0.5}
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert len({r.score for r in toxicity.toxicity_scores(blank, toxicity.train(blank, labels.limit(0))).collect()}) == 1


def test_toxicity_learns():
    rng = np.random.default_rng(0)
    doc = lambda bad: np.unique(np.concatenate([rng.integers(1000, 50000, 200), rng.integers(0, 20, 3) if bad else []])).astype(np.int32)
    pos, unl = [doc(True) for _ in range(200)], [doc(k % 10 == 0) for k in range(2000)]
    model = toxicity.fit(pos, unl, 0.1)
    score = lambda d: model.weights[d].sum() + model.bias
    assert np.mean([score(doc(True)) > 0 for _ in range(200)]) > 0.95 and np.mean([score(doc(False)) > 0 for _ in range(200)]) < 0.02


def test_packing(edges, docs):
    for df in both(edges, docs):
        got = packing.pack(df, capacity=700).collect()
        bins = collections.defaultdict(list)
        for r in got:
            bins[r["bin"]].append(r)
        for own in bins.values():
            assert sum(r["length"] for r in own) == own[0]["used"] <= 700
            assert len({r["source"] for r in own}) == len(own) and len({r["cluster"] for r in own}) == len(own)
        want = sum(len((r.text or "").encode()) + 1 for r in df.collect())
        assert sum(r["length"] for r in got) == want


def naive_bins(rows, capacity):
    """Best fit in plain steps: for each piece the tightest bin that has room and neither its source nor its cluster."""
    bins, out = [], []
    for i, rest, source, cluster in rows:
        fit = [b for b in bins if b["room"] >= rest and source not in b["sources"] and cluster not in b["clusters"]]
        at = min(fit, key=lambda b: b["room"], default=None)
        if at is None:
            at = {"room": capacity, "sources": set(), "clusters": set(), "ids": []}
            bins.append(at)
        at["room"] -= rest
        at["sources"].add(source)
        at["clusters"].add(cluster)
        at["ids"].append(i)
    return sorted(b["room"] for b in bins)


def test_packing_is_best_fit(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "é" * int(rng.integers(0, 90)) + "x" * int(rng.integers(0, 90)), f"s{rng.integers(0, 40)}" if i % 3 else "hot") for i in range(500)]
    rows += [(500, rows[7][1], "s1"), (501, rows[7][1], "s2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = packing.pack(docs, capacity=300).collect()
    assert len({r["bin"].split("-")[0] for r in got}) == 1
    turn = sorted(got, key=lambda r: (-r["length"], r["cluster"], r["doc_id"]))
    used = {r["bin"]: r["used"] for r in got}
    assert sorted(300 - u for u in used.values()) == naive_bins([(r["doc_id"], r["length"], r["source"], r["cluster"]) for r in turn], 300)


def test_packing_cuts_between_code_points(spark):
    texts = ["é" * 30, "a" + "é" * 30, "𝔘" * 9 + "x", "x" * 21, "x" * 6, "x" * 7, "", None, "語" * 400 + "é" * 300, "x" * 2000]
    for capacity in (4, 7, 8192):
        texts[-2:] = ["語" * capacity + "é" * 300, "x" * 10 * capacity]
        docs = spark.createDataFrame([(i, t, f"s{i}", 1, "c") for i, t in enumerate(texts)] + [(None, None, None, 1, "c")] * 3, "doc_id long, text string, source string, length int, cluster string")
        pieces = collections.defaultdict(list)
        got = packing.pack(docs, capacity=capacity).collect()
        for r in got:
            pieces[r["doc_id"]].append(r)
            assert 0 < r["length"] <= capacity
        assert sum(len(x) == 3 for x in pieces.values() if x[0]["doc_id"] is None) == 1
        for i, t in enumerate(texts):
            raw, own = (t or "").encode() + b"\0", sorted(pieces[i], key=lambda r: r["piece"])
            parts = [raw[r["start"] : r["start"] + r["length"]] for r in own]
            assert b"".join(parts) == raw and all(p.decode() for p in parts) and [r["piece"] for r in own] == list(range(len(own)))
            assert all(len(a) + len(b.decode()[0].encode()) > capacity for a, b in zip(parts, parts[1:]))


def test_packing_deals_repeated_rows(spark):
    docs = spark.createDataFrame([(None, None, None)] * 3000, "doc_id long, text string, source string").repartition(4)
    bins = collections.Counter(r["bin"] for r in packing.pack(docs, group_rows=100).collect())
    groups = collections.Counter(b.split("-")[0] for b in bins.elements())
    assert len(bins) == 3000 and max(groups.values()) < 160


def test_packing_keeps_near_copies_apart(spark, edges, docs, tmp_path):
    for k, df in enumerate((edges, docs)):
        df.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        group = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard_components(df).collect() if r.doc_id is not None and r.n_shingles}
        size = {r.doc_id: len(shingle_set(r.text)) for r in df.collect()}
        got = queries.op10_packing(spark, f"{tmp_path}/{k}").collect()
        bins = collections.defaultdict(list)
        for r in got:
            if (r.doc_id, size[r.doc_id]) in group:
                bins[r["bin"]].append(group[r.doc_id, size[r.doc_id]])
        assert all(len(set(own)) == len(own) for own in bins.values())
        assert sum(r["length"] for r in got) == sum(len((r.text or "").encode()) + 1 for r in df.collect())


def test_best_fit_takes_the_tightest_compatible():
    assert packing.best_fit([7, 6, 3, 3, 3], [0, 1, 0, 1, 2], [-1, -1, -1, -1, -1], 10) == [0, 1, 1, 0, 2]
    assert packing.best_fit([5, 5, 5], [0, 1, 2], [0, 0, -1], 10) == [0, 1, 0]


def made_page(rng):
    """A page of random parts and the text that it should give."""
    sentence = lambda n: " ".join(f"{rng.choice(['word', 'more', 'less', 'A&amp;B', 'é', 'x&lt;y'])}{rng.integers(100)}" for _ in range(n))
    clean = lambda t: t.replace("&amp;", "&").replace("&lt;", "<")
    short = lambda: sentence(rng.integers(1, 9))
    furniture = [
        lambda: f"<nav><ul><li><a href='/'>{short()}</a></li><li>{short()}</li></ul></nav>", lambda: f"<div class='ad'>{sentence(rng.integers(3, 40))}</div>", lambda: f"<form><p>{short()}</p><input><button>{short()}</button></form>",
        lambda: f"<div id='cookie-notice'><p>{sentence(20)}</p></div>", lambda: f"<aside><h3>{short()}</h3><p>{sentence(30)}</p></aside>", lambda: f"<script>var a='<p>{short()}</p>';</script>", lambda: f"<style>p{{}} {short()}</style>", lambda: f"<!-- <p>{short()}</p> -->",
    ]
    some = lambda n: [rng.choice(furniture)() for _ in range(rng.integers(0, n))]
    article, want = [], []
    for k in range(rng.integers(2, 12)):
        text = sentence(rng.integers(40, 90)) if k == 0 else sentence(rng.integers(1, 90))
        kind = rng.choice(["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<div>\n {}\t</div>", "<p><b>{}<br></p>", "<ul><li>{}</li></ul>"])
        article.append(kind.format(text))
        want.append(clean(text))
        if rng.integers(5) == 0:
            article += some(2)
    comments = f"<section class='comments'><article><p>{sentence(60)}</p></article><p>{sentence(80)}</p></section>" if rng.integers(2) else ""
    shell = rng.choice(["<article>{}</article>", "<main><article>{}</article></main>", "<div class='post'>{}</div>", "<div class='has-sidebar'><article>{}</article></div>"])
    page = ["<!DOCTYPE html><html><head><title>T</title></head><body>", f"<header><h1>{short()}</h1></header>", *some(4), shell.format("".join(article)), comments, *some(3), f"<footer>&copy; {sentence(30)}</footer></body></html>"]
    return "".join(page), "\n".join(want)


def test_html_made_pages(spark):
    rng = np.random.default_rng(11)
    made = [made_page(rng) for _ in range(400)]
    rows = [(i, f"u{i}", page, "x") for i, (page, _) in enumerate(made)] + [(0, "u0", made[0][0], "x"), (None, None, None, None), (None, "u", "", "x"), (7, None, "<p>" + "long " * 10**6, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    want = collections.Counter([(i, f"u{i}", text, len(text)) for i, (_, text) in enumerate(made)] + [(0, "u0", made[0][1], len(made[0][1])), (None, None, "", 0), (None, "u", "", 0), (7, None, ("long " * 10**6).strip(), 5 * 10**6 - 1)])
    got = collections.Counter(tuple(r) for r in html_text.extract_text(pages).collect())
    assert got == want
    assert html_text.extract_text(pages.limit(0)).collect() == []


def test_html_marks_only_change_lengths():
    post, other = "word after word " * 20, "something else " * 12
    text = html_text.main_text
    assert text(f"<div class='related widget'><p>{post}</p></div><p>{other}</p>") == f"{post.strip()}\n{other.strip()}"
    assert text(f"<div class='related'><p>{other}</p></div><p>{post}</p>") == post.strip()
    assert text(f"<div class='share ad'><p>{post}</p></div><p>{other}</p>") == other.strip()
    assert text(f"<p>{post}<math><mi>x</mi></math> is <object>seen</object></p>") == f"{post}x is seen"


def test_queries_match_sql(spark, sf):
    import glob
    import os

    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    show = lambda x: "-" if x is None else f"{float(x):.9g}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    assert set(queries.ORACLE_SQL) == {"op1_warc", "op2_url_filter", "op3_sharding", "op4_fingerprints", "op6_licenses", "op7_decontamination", "op8_ngram_join", "op9_html_text"}
    for name, sql in queries.ORACLE_SQL.items():
        got, result = queries.QUERIES[name](spark, sf), con.execute(sql)
        columns = [c[0] for c in result.description]
        assert sorted(columns) == sorted(got.columns), name
        want = collections.Counter(tuple(map(show, r)) for r in result.fetchall())
        assert collections.Counter(tuple(show(r[c]) for c in columns) for r in got.collect()) == want, name


def test_toxicity_query(spark, sf, tmp_path):
    """Held-out labels, languages and sources don't matter to a score; ids only to who is learnt from."""
    big = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0).cast("long")})
    flipped = labels.withColumn("toxic", F.when(queries.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))).withColumn("quality", 1 - F.col("quality"))
    for k, (d, b) in enumerate(((docs, labels), (other, flipped))):
        d.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        b.write.parquet(f"{tmp_path}/{k}/labels.parquet")
    got = [{r.doc_id: r for r in queries.op5_toxicity(spark, f"{tmp_path}/{k}").collect()} for k in (0, 1)]
    assert got[0] == got[1] and len(got[0]) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got[0].items())
    y = [(got[0][r.doc_id].score, r.toxic) for r in labels.collect() if got[0][r.doc_id].held_out]
    pos, neg = ([s for s, t in y if t == k] for k in (1, 0))
    assert np.mean([(a > b) + (a == b) / 2 for a in pos for b in neg]) > 0.8


def test_toxicity_counts_all_documents(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 50, 20)) + (" vile words" if i % 4 == 0 else "") + (" mild" if i % 2 else "")) for i in range(400)]
    rows += [(3, None), (None, "vile words"), (7, "x " * 10**6), (8, rows[8][1]), (8, rows[8][1])]
    docs = spark.createDataFrame([(*r, 1.0, "y") for r in rows], "doc_id long, text string, score double, id string").repartition(4)
    labels = spark.createDataFrame([(i, 1 if i % 4 == 0 else 0) for i in range(400)] + [(None, 1), (5, None), (999, 1), (8, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {(r.doc_id, i): r.score for i, r in enumerate(toxicity.toxicity_scores(docs, model).collect())}
    assert len(got) == len(rows)
    assert all((s > 0.5) == (i is None or i % 4 == 0 and i is not None) for (i, _), s in got.items() if i not in (3, 7))
    word = lambda w: toxicity.features(next(toxicity.words.spans(__import__("pyarrow").array([w]))))[0][0, 0]
    assert model.weights[word("vile")] > 0 and model.weights[word("w7")] == 0 and model.weights[word("mild")] == 0
    assert toxicity.toxicity_scores(docs.limit(0), model).collect() == []
    for few in (toxicity.train(docs, labels.limit(0)), toxicity.train(docs.limit(0), labels)):
        assert len({r.score for r in toxicity.toxicity_scores(docs, few).collect()}) == 1


def test_ngram_blobs_round_trip():
    from corpusmill.llm import ngram_join as join

    rng = np.random.default_rng(6)
    for bits, exact in ((4, 60), (6, 62), (8, 64), (13, 64), (16, 64), (20, 64)):
        part = int(rng.integers(0, 1 << bits))
        h = (rng.integers(0, 2**64, 1000, np.uint64) >> np.uint64(bits)) | np.uint64(part << 64 - bits)
        got, drop = join._unpack(join._pack(h, bits), bits, part), np.uint64(64 - exact)
        assert ((got >> drop) == (h >> drop)).all() and (got >> np.uint64(64 - bits) == part).all()
    keys, count = np.arange(5, dtype=np.uint64), np.array([1, 65535, 65536, 200000, 3])
    a, b = join._holders(keys, count)
    assert (np.repeat(np.frombuffer(a, np.uint64), np.frombuffer(b, "<u2")) == np.repeat(keys, count)).all()
