"""Column functions, duplicate removal and whole runs on hand-made rows; queries against DuckDB."""

import glob
import hashlib
import http.server
import json
import os
import random
import threading

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill import cli, queries
from corpusmill.config import PROMPTS, Config, chosen_prompts
from corpusmill.functions import md5
from corpusmill.functions import text as tx
from corpusmill.operators import dedup, rows
from corpusmill.plans import curate, progress
from corpusmill.sources import scan, sink
from corpusmill.sources.chat import ChatRephraser


def values(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    return [r.v for r in df.select("i", column(F.col("t")).alias("v")).orderBy("i").collect()]


def test_verdicts(spark):
    letters = "α" * 200
    texts = [None, "α" * 199, letters, "α" * 20000, "α" * 20001, "1" * 300, "α" * 60 + "b" * 40 + " " * 100, "α" * 59 + "b" * 41 + " " * 100, "Α" * 80 + "α" * 120, "Α" * 81 + "α" * 119, "α" * 150 + "." * 50, "α" * 149 + "." * 51, "α" * 280 + " HTTPS://a.bc/defgh ijk"]
    want = ["too_short", "too_short", "kept", "kept", "too_long", "no_letters", "kept", "not_greek", "kept", "too_much_upper", "kept", "too_much_punct", "too_many_urls"]
    assert values(spark, texts, tx.verdict) == want


def test_truncation(spark):
    assert values(spark, ["abc", "ab\ncdef", "\nabcdef", "abcdefgh", "abcd\n", "a\nb\ncd"], lambda t: tx.truncated(t, 5)) == ["abc", "ab", "", "abcde", "abcd\n", "a\nb"]


def test_preambles(spark):
    texts = ["Φυσικά, κείμενο", "ΦΥΣΙΚΆ! Εδώ είναι το κείμενο:\n\n**Τίτλος**\n\nσώμα", "Φυσικάλα", "Βεβαίως. Λυπάμαι, δεν", "   κείμενο ", "Ακολουθεί ο πίνακας.\nx"]
    assert values(spark, texts, tx.stripped) == ["κείμενο", "σώμα", "Φυσικάλα", "", "κείμενο ", "x"]


def test_formats(spark):
    assert values(spark, ["?" * 3 + "\n" * 4, "?;?" + "\n" * 3, ";" * 3 + "\n" * 4], tx.is_faq) == [True, False, False]
    assert values(spark, ["ΛΎΣΗ 1", "λυση 1", "βήμα ٣", "βήμα"], tx.is_math) == [True, False, True, False]
    assert values(spark, ["|a|\n|b|\n|c|", "|a|\n|b|", "|a|\n|b|\nx\n|c|", "|a|\r|b| |c|", "|\n|\n|", "a b |x| c"], tx.is_table) == [True, False, False, True, False, False]
    pad = "x" * 290
    assert values(spark, [f"1. abcdefg\n{pad}", f"1. abcdef\n{pad[:-1]}", f"- a\n* b\n• c\n{pad}", f"- a\n* b\n{pad} zz", f"{pad} zzzzzzzz\r1. a"], tx.is_tutorial) == [True, False, True, False, False]


def test_shingles_and_tokens(spark):
    assert values(spark, ["", "Α ΒΣ", "a b c d e", "a b c d e f", "éa 12x"], lambda t: F.array_join(tx.shingles(tx.tokens(t)), "|")) == ["", "α βς", "a b c d e", "a b c d e|b c d e f", "é a 12 x"]


def test_small_functions(spark):
    assert values(spark, [" a  \n b ", "　", "x"], tx.collapsed) == ["a b", "", "x"]
    df = spark.createDataFrame([(float(x),) for x in (0, 0.25, 0.250001, 0.5, 1, 1.5, -0.1)], "x double")
    assert [r.b for r in df.select(tx.bucket(F.col("x"), 4).alias("b")).collect()] == [0, 0, 1, 1, 3, 3, 3]
    assert [r.s for r in spark.createDataFrame([(5,), (2048,), (3 << 20,)], "n long").select(tx.size_text(F.col("n")).alias("s")).collect()] == ["5.0B", "2.0KB", "3.0MB"]
    with pytest.raises(ValueError):
        chosen_prompts("faq,none")
    assert chosen_prompts("") == PROMPTS and Config.from_env({"VLLM_PORTS": "1, 2", "x": "y", "Retry_Failed": "no"}).generator.calls == 184
    assert Config().having(lid_threshold="0.5", rows_per_flush=7, progress_every="3") == Config().having(lid_threshold=0.5).having(rows_per_flush="7", progress_every=3)


def test_sizes_round_as_c_does(spark):
    """Halves go to the even digit and 0.45 is below a half; Java's format takes both up."""
    sizes = [0, 256, 1280, 1792, 3840, 2**20 - 1, 2**20 + 2**18, 398720204, 2**40 + 2**38, 2**40 * 8192 + 494780232499, 2**53 + 1, 2**63 - 1, 1023, 1024, -(2**40)]
    df = spark.createDataFrame(list(enumerate([*sizes, None])), "i long, n long")
    sql, listed = queries.ORACLE_SQL["size_str"].split("select doc_id, ")[2], ", ".join(map(str, [*sizes, "null"]))
    want = [w for (w,) in duckdb.sql(f"with x as (select unnest([{listed}]::bigint[]) as n) select {sql}").fetchall()]
    assert [r.s for r in df.orderBy("i").select(tx.size_text(F.col("n")).alias("s")).collect()] == want
    assert want[2:5] == ["1.2KB", "1.8KB", "3.8KB"] and want[-1] is None


def test_first_kept_chain(spark):
    banded = spark.createDataFrame([(1, 0, "x"), (2, 0, "x"), (2, 1, "y"), (3, 1, "y"), (3, 2, "z"), (4, 2, "z"), (5, 0, "u")], "ord long, band int, band_key string")
    assert {r.ord: r.kept for r in dedup.first_kept(banded, []).collect()} == {1: True, 2: False, 3: True, 4: False, 5: True}
    assert dedup.first_kept(banded.limit(0), []).collect() == []


def test_first_kept_is_the_sequential_rule(spark):
    rng = random.Random(5)
    for _ in range(3):
        rows = [(ord_, band, str(rng.randrange(25))) for ord_ in range(120) for band in range(3)]
        kept, held = {}, set()
        for ord_ in range(120):
            own = {r[1:] for r in rows if r[0] == ord_}
            kept[ord_] = not own & held
            held |= own if kept[ord_] else set()
        assert {r.ord: r.kept for r in dedup.first_kept(spark.createDataFrame(rows, "ord long, band int, band_key string"), []).collect()} == kept


def test_minima_by_hand():
    a, b = (np.array(x, np.int64) for x in dedup.constants(8))
    rng = np.random.default_rng(0)
    sizes = [0, 3, 0, 5000, 70000, 9000, 1, 0]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    values = rng.integers(0, dedup.PRIME, bounds[-1])
    want = [[min(((int(x) * values[lo:hi] + int(y)) % dedup.PRIME).tolist(), default=dedup.PRIME) for x, y in zip(a, b)] for lo, hi in zip(bounds, bounds[1:])]
    assert dedup._minima(values, bounds, a, b).tolist() == want


def test_digests_by_hashlib():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 60000).astype(np.uint8)
    for most in (40, 70, 400):  # one block, two, and some for hashlib
        begin = rng.integers(0, len(data) - most, 9000)
        end = begin + rng.integers(0, most, 9000)
        assert md5.heads(data, begin, end).tolist() == [int(hashlib.md5(data[b:e].tobytes()).hexdigest()[:8], 16) for b, e in zip(begin, end)]
    assert md5.heads(data, np.array([60000]), np.array([60000])).tolist() == [0xD41D8CD9] and len(md5.heads(data[:0], begin[:0], end[:0])) == 0


def test_signatures_by_hand(spark, monkeypatch):
    """Empty, wordless, short, long-worded, Greek and repeating texts, cut anywhere."""
    words = [f"λέξη{i % 40}ab" for i in range(300)]
    texts = ["", None, "...", "a", "a b c d", "a b c d e", "Α ΒΣ x1y", " ".join(words), "x" * 900 + " b " + "y" * 300, "a b c d e " * 50, *[f"{k} " + " ".join(words[k:]) for k in range(90)], ""]
    df = spark.createDataFrame(list(enumerate(texts)), "ord long, text string").coalesce(2)
    a, b = dedup.constants(16)
    for part in (1, 100, 1 << 20):
        monkeypatch.setattr(dedup, "PART", part)
        got = {r.ord: r.sig for r in dedup.signatures(df, ["ord"], n=16).collect()}
        for r in df.select("ord", tx.shingles(tx.tokens(F.coalesce("text", F.lit("")))).alias("s")).collect():
            hashes = [int(hashlib.md5(s.encode()).hexdigest()[:8], 16) % dedup.PRIME for s in r.s]
            assert got[r.ord] == [min(((x * h + y) % dedup.PRIME for h in hashes), default=dedup.PRIME) for x, y in zip(a, b)], r.ord
    assert dedup.signatures(df.limit(0), ["ord"]).collect() == []


def test_rounds_hold_shared_bands_only(spark, monkeypatch):
    """Of 2000 documents three share bands, and only theirs are written."""
    rows_ = [(i, b, f"{i}-{b}") for i in range(2000) for b in range(3)] + [(5, 3, "x"), (9, 3, "x"), (9, 3, "x"), (9, 4, "y"), (11, 4, "y")]
    written, real = [], dedup.stored
    monkeypatch.setattr(dedup, "stored", lambda df, tag: [out := real(df, tag), written.append((tag, out.count()))][0])
    got = {r.ord: r.kept for r in dedup.first_kept(spark.createDataFrame(rows_, "ord long, band int, band_key string"), []).collect()}
    assert len(got) == 2000 and [i for i, kept in got.items() if not kept] == [9]
    assert max(n for tag, n in written if tag == "bands") == 5


def test_dedup_scopes(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([("faq", 1, text), ("faq", 2, text), ("math", 3, text), ("faq", 4, "..."), ("faq", 5, "!!")], "prompt string, ord long, text string")
    assert {r.ord: r.kept for r in dedup.near_dedup(df, ["prompt"]).collect()} == {1: True, 2: False, 3: True, 4: True, 5: False}
    known = df.where("ord = 1").select("prompt", "text")
    assert {r.ord: r.kept for r in dedup.near_dedup(df.where("ord > 1"), ["prompt"], known=known).collect()} == {2: False, 3: True, 4: True, 5: False}


def test_runs_resume(spark, tmp_path):
    body = lambda k: f"{k}. λύση " + " ".join(f"λέξη{(i * (k + 3)) % 97}α{i}" for i in range(60)) + "\n1. και το η να\n- α\n- β\n- γ ???\n\n|α|\n|β|\n|γ|\n και το η να του"
    spark.createDataFrame([(f"u{k % 5}", body(k)) for k in range(6)] + [(None, body(9))], "url string, text string").coalesce(1).write.parquet(f"{tmp_path}/in/part")
    config = Config().having(source_name=f"{tmp_path}/in", source_config="part", local_shard_dir=f"{tmp_path}/out", lid_threshold=0.0, rows_per_flush=2)
    root = config.shards.root
    part = curate.run(spark, config, max_docs=2, prompts=("faq",)).first()
    assert part.seen == 2
    first = curate.run(spark, config).first()
    assert first.seen == 18 and first.kept == 18 and first.failed_calls == 0
    again = curate.run(spark, config).first()
    assert again.seen == 0
    assert {(r.prompt, r.shard): r["count"] for r in spark.read.parquet(f"{root}/kept").groupBy("prompt", "shard").count().collect()} == {(p, k): 1 if k == 2 else 2 for p in PROMPTS for k in range(3)}
    assert {r.prompt: (r.shards, r.rows) for r in scan.totals(spark, root).collect()} == {p: (3, 5) for p in PROMPTS}
    plan = sink.publish_plan(spark, root)
    assert [r.remote for r in plan.collect()] == [f"{p}/part-{k:05d}.parquet" for p in PROMPTS for k in range(3)]
    hub = sink.FolderPublisher(f"{tmp_path}/hub")
    for _ in range(2):
        sink.publish(spark, root, hub, config, dry_run=False)
    assert len(glob.glob(f"{tmp_path}/hub/*/*.parquet")) == plan.count()
    assert "config_name: faq" in hub.root.joinpath("README.md").read_text()
    sink.merge_shards(scan.shards(spark, root), f"{tmp_path}/one")
    assert spark.read.parquet(f"{tmp_path}/one").count() == 20
    assert scan.seen_ids(spark, root, "other").count() == 0
    with pytest.raises(ValueError):
        curate.run(spark, config, prompts=("none",))


def test_language_gate_judges_slices(spark):
    greek, latin = "και το η να του " * 60, "of the and to in " * 12
    texts = [greek, greek[:500], latin, greek[:400] + latin + greek[:400], "x" * 501]
    records = spark.createDataFrame([(i, "faq", t) for i, t in enumerate(texts)], "ord long, prompt string, text string")
    got = {r.ord: (r.status == "dropped for lang", round(r.confidence, 6)) for r in curate.judged(records, Config()).collect()}
    for i, t in enumerate(texts):
        r = random.Random(len(t))
        cut = [t] if len(t) <= 500 else [t[k : k + 500] for k in [r.randint(0, len(t) - 500) for _ in range(3)]]
        scores = values(spark, cut, lambda c: tx.language_score(c, "el"))
        assert got[i] == (min(scores) < 0.9, round(sum(scores) / len(scores), 6))


def test_failed_calls_are_counted(spark, tmp_path, caplog):
    config = Config().having(local_shard_dir=f"{tmp_path}/out", min_output_chars=1, lid_threshold=0.0)
    docs = spark.createDataFrame([(i, f"u{i}", f"λέξη{i} " * 60) for i in range(5)], "ord long, source_id string, text string")
    with caplog.at_level("INFO"):
        stats = curate.run(spark, config, docs=docs, prompts=("faq",), rephraser=refuse_three).first()
    assert stats.seen == 4 and stats.failed_calls == 1 and "ValueError: no" in caplog.text


def refuse_three(endpoint, prompt, request):
    if "λέξη3 " in request:
        raise ValueError("no")
    return request


def test_streams(spark, tmp_path):
    spark.createDataFrame([(f"u{i}", f"t{i}") for i in range(4)], "url string, text string").coalesce(1).write.parquet(f"{tmp_path}/in/part")
    config = Config().having(source_name=f"{tmp_path}/in", source_config="part")
    whole = scan.configured(spark, config, lambda: iter([{"url": 1, "text": None}, {"text": "b"}])).collect()
    assert [(r.ord.row, r.source_id, r.text) for r in whole] == [(0, "1", ""), (1, None, "b")]

    def broken():
        yield {"url": "x", "text": "lost"}
        raise OSError("gone")

    assert [(r.ord.row, r.source_id) for r in scan.configured(spark, config, broken).collect()] == [(i, f"u{i}") for i in range(4)]
    with pytest.raises(ValueError):
        scan.configured(spark, Config())


def test_rows_are_numbered_over_files(spark, tmp_path):
    """Several files, of one name in two folders, an empty one and names that sort otherwise when URL-encoded."""
    texts = lambda k, n: spark.createDataFrame([(f"{k}{i}", f"{k} {i}") for i in range(n)], "url string, text string").coalesce(1)
    names = ["a b/x.parquet", "a!/x.parquet", "a+%2B/x.parquet", "a0/y.parquet", "a1/x.parquet"]
    for k, (name, n) in enumerate(zip(names, (3, 2, 4, 0, 2))):
        texts(k, n).write.parquet(f"{tmp_path}/raw{k}")
        (tmp_path / "in" / name).parent.mkdir(parents=True)
        os.link(glob.glob(f"{tmp_path}/raw{k}/*.parquet")[0], tmp_path / "in" / name)
    want = duckdb.sql(f"select url, row_number() over () - 1 from read_parquet('{tmp_path}/in/*/*.parquet')").fetchall()
    docs = scan.documents(spark, f"{tmp_path}/in/*")
    assert len(want) == 11 and sorted((r.source_id, r.row) for r in scan.numbered(docs).collect()) == sorted(want)
    assert sorted((r.source_id, r.row) for r in scan.numbered(docs.where("source_id like '%1'").repartition(3), docs).collect()) == sorted(w for w in want if w[0].endswith("1"))
    assert docs.select("ord").distinct().count() == 11
    streamed = scan.streamed(spark, queries.numbers_stream, "doc_id")
    assert all(r.row == r.ord.row for r in scan.numbered(streamed).collect()) and scan.numbered(docs.limit(0)).collect() == []


def test_queries_number_rows_over_files(spark, sf, tmp_path):
    parts = spark.read.parquet(f"{sf}/documents.parquet").repartitionByRange(3, "doc_id")
    parts.write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("source_fallback", "scan_documents"):
        got = queries.QUERIES[name](spark, str(tmp_path))
        assert sorted(map(tuple, got.collect())) == sorted(duck.execute(f"select {', '.join(got.columns)} from ({queries.ORACLE_SQL[name]})").fetchall()), name


def test_beats():
    assert progress.beats(0, 1999, 2000) == [] and progress.beats(1999, 6000, 2000) == [2000, 4000, 6000] and progress.beats(6000, 6001, 2000) == []


def test_banding_and_commands(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.chdir(tmp_path)
    assert dedup.banding(0.8) == (dedup.BANDS, dedup.ROWS)
    text = "λύση " + " ".join(f"w{i}" for i in range(60))
    done = spark.createDataFrame([(text, f"u{i}", "d", "math", "m", 0.9, "") for i in range(3)], "text string, source_id string, source_data string, prompt string, model string, language_confidence double, status string")
    sink.write_shards(done, f"{tmp_path}/out")
    cli.main(["check-dups", "math", "--root", f"{tmp_path}/out", "--threshold", "0.5", "--num-perm", "64"], spark)
    assert "|  math|    3|  2|     1|" in capsys.readouterr().out
    cli.main(["read-shards", "faq", "--root", f"{tmp_path}/out", "--out", f"{tmp_path}/faq"], spark)
    cli.main(["read-shards", "--root", f"{tmp_path}/out", "--out", f"{tmp_path}/all"], spark)
    assert "|    math|     1|   3|" in capsys.readouterr().out
    cli.main(["spot-check", "--n", "8"], spark)  # nothing there yet
    monkeypatch.setenv("LOCAL_SHARD_DIR", f"{tmp_path}/out")
    cli.main(["spot-check", "--n", "8"], spark)
    cli.main(["publish", "--input", f"{tmp_path}/out", "--to", f"{tmp_path}/hub", "--prompts", "math", "--dest-prefix", "x"], spark)
    assert "math/x/part-00000.parquet" in capsys.readouterr().out and not (tmp_path / "hub").exists()
    cli.main(["publish", "--input", f"{tmp_path}/out", "--to", f"{tmp_path}/hub", "--no-dry-run"], spark)
    assert sorted(p.name for p in (tmp_path / "hub").rglob("*.*")) == ["README.md", "part-00000.parquet"]
    cli.main(["refresh-readme", "--to", f"{tmp_path}/hub", "-m", "again"])
    assert spark.read.parquet(f"{tmp_path}/faq").count() == 0 and spark.read.parquet(f"{tmp_path}/all").count() == 3


def test_chat_endpoint(spark):
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            doc = asked["messages"][1]["content"].split("\n")[-1]
            out = json.dumps({"choices": [{"message": {"content": f"{asked['model']}:{doc}:{len(asked['messages'])}"}}]}).encode()
            self.send_response(500 if doc == "fail" else 200)
            self.end_headers()
            self.wfile.write(out)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    config = Config().having(vllm_base_url="http://127.0.0.1", vllm_ports=(server.server_port,), vllm_model_id="m")
    pairs = spark.createDataFrame([(i, f"u{i}", "faq", t) for i, t in enumerate(["one", "fail", "two"])], "ord long, source_id string, prompt string, text string")
    got = curate.rephrased(pairs, config, ChatRephraser.of(config), in_flight=4).collect()
    server.shutdown()
    assert {r.ord: r.text for r in got} == {0: "m:one:2", 1: None, 2: "m:two:2"} and {r.ord for r in got if r.error} == {1}


def test_few_requests_are_held(spark):
    """Of an Arrow batch of 4000 long rows few are Python texts at a time; all are answered in order, failed and null ones too."""

    def held(endpoint, prompt, request):
        if request is None or request.endswith("7"):
            raise ValueError("no")
        with open("/proc/self/statm") as f:
            return f"{int(f.read().split()[1]) * 4096} {request}"

    text = F.concat(F.repeat(F.lit("x"), 11000), F.lit(" "), F.col("id").cast("string"))
    pairs = spark.range(0, 4000, 1, 1).select(F.struct(F.lit("f").alias("file"), F.col("id").alias("row")).alias("ord"), F.col("id").cast("string").alias("source_id"), F.lit("faq").alias("prompt"), F.when(F.col("id") != 11, text).alias("text"))
    for in_flight in (1, 5):
        got = curate.rephrased(pairs, Config(), held, in_flight=in_flight).select("ord", "error", F.length("text").alias("n"), F.split("text", " ")[0].cast("long").alias("used"), F.substring_index("text", " ", -1).alias("last")).collect()
        assert [r.ord.row for r in got] == list(range(4000)) and {r.ord.row for r in got if r.error} == {11, *range(7, 4000, 10)}
        assert all((r.n is None) == (r.error is not None) and (r.error or r["last"] == str(r.ord.row)) for r in got)
        assert got[3999].used - got[0].used < 50e6


def test_streaming(spark, tmp_path):
    from corpusmill.streaming import incremental

    text = "1. λύση και το η να " + " ".join(f"λέξη{i}" for i in range(80)) + "\n???\n\n\n|α|\n|β|\n|γ|\n"
    spark.createDataFrame([("u1", text)], "url string, text string").write.parquet(f"{tmp_path}/in")
    config = Config().having(local_shard_dir=f"{tmp_path}/out", lid_threshold=0.5, min_output_chars=10)
    for k in range(2):  # with another state, all files are new again
        incremental.start(spark, f"{tmp_path}/in", "url string, text string", config, f"{tmp_path}/state{k}").awaitTermination()
    assert sum(scan.shards(spark, f"{tmp_path}/out", kind).count() for kind in ("kept", "failed")) == 4


def test_queries_match_sql(spark, sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    show = lambda x: "-" if x is None or x != x else f"{float(x):.9g}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    for name, sql in queries.ORACLE_SQL.items():
        got, result = queries.QUERIES[name](spark, sf), con.execute(sql)
        columns = [c[0] for c in result.description]
        assert sorted(columns) == sorted(got.columns), name
        want = sorted(tuple(map(show, r)) for r in result.fetchall())
        assert sorted(tuple(show(r[c]) for c in columns) for r in got.collect()) == want, name


def test_shard_numbers(spark):
    df = spark.range(1000).select(F.col("id").alias("ord"), (F.col("id") % 3).alias("g"))
    counts = rows.shard_numbers(df, 10, ["g"], chunk=64).groupBy("g", "shard").count().collect()
    assert all(r["count"] == 10 or r.shard == 33 for r in counts)


def test_merge_shards_reads_what_was_merged(spark, sf, monkeypatch):
    merge = sink.merge_shards
    count = lambda: sum(r.n_rows for r in queries.merge_shards(spark, sf).collect())
    whole = count()
    assert whole == spark.read.parquet(f"{sf}/conversations.parquet").where("role = 'assistant' and (conv_id * 1000 + turn) % 5 <> 0").count()
    monkeypatch.setattr(sink, "merge_shards", lambda kept, out, *rest: merge(kept.limit(whole - 1), out, *rest))
    assert count() == whole - 1
