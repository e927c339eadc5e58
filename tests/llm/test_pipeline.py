"""The pipeline's stages, each against what its operator says about the stage's own input."""

import collections
import re

import numpy as np
import pyarrow as pa

import corpus_pipeline
from corpusmill.llm import queries, suffix_match
from corpusmill.llm.ngram_join import jaccard_components
from corpusmill.llm.shared import materialise, table


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, sf), "test")
        if name != "best-fit packing":
            assert out.columns == columns
            before, after = {r.doc_id for r in docs.collect()}, {r.doc_id for r in out.collect()}
            assert after <= before and len(after) == out.count()
        if name == "n-gram Jaccard join":
            assert after == {r.doc_id for r in jaccard_components(docs).collect() if r.doc_id == r.component_id}
        if name == "benchmark decontamination":
            assert not suffix_match.suffix_matches(out, table(spark, sf, "benchmark")).where("n_hit > 0").count()
        if name == "best-fit packing":
            assert {r.doc_id for r in out.collect()} == after
        docs = out


def test_stages_tell_rows_apart_without_ids(spark, sf):
    leak = max((r.text for r in table(spark, sf, "benchmark").collect()), key=len)
    copy, other, clean = ("a text of some length that comes again %s " % x * 6 for x in ("one", "two", "three"))
    rows = [(None, copy), (None, copy), (7, copy), (7, copy), (9, copy), (9, other), (None, clean), (None, clean), (3, None), (3, "")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string").repartition(4)
    out = corpus_pipeline.near_duplicates(spark, docs, sf).collect()
    assert sorted(((r.doc_id or 0, r.text or "") for r in out)) == sorted([(7, copy), (9, other), (0, clean), (3, ""), (3, "")])
    docs = spark.createDataFrame([(i, t, "s") for i, t in [(None, leak), (None, clean), (5, leak), (5, other), (5, other), (6, None)]], docs.schema)
    out = corpus_pipeline.decontamination(spark, docs, sf).collect()
    assert sorted(((r.doc_id or 0, r.text or "") for r in out)) == sorted([(0, clean), (5, other), (5, other), (6, "")])


def test_toxicity_stage_by_hand(spark):
    sf = "/root/testdata/sf0.01"
    from corpusmill.llm import toxicity

    docs = table(spark, sf, "documents").where("doc_id % 2 = 0")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "s", 0), (4, "x " * 10**5, "en", "s", 1)], docs.schema)
    docs = docs.unionByName(odd).unionByName(odd)
    model = toxicity.train(docs, table(spark, sf, "labels"), usable=lambda c: ~queries.held_out(c))

    def score(text):
        words = {w for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))}
        spans = list(toxicity.words.spans(pa.array(sorted(words), pa.string())))
        own = {int(f) for s in spans for f in np.unique(toxicity.features(s)[0])}
        return sum(float(model.weights[f]) for f in own) + model.bias

    want = collections.Counter((r.doc_id, r.text) for r in docs.collect() if score(r.text) < 0)
    got = collections.Counter((r.doc_id, r.text) for r in corpus_pipeline.toxicity(spark, docs, sf).collect())
    assert got == want and sum(want.values()) < docs.count()


def test_stages_on_odd_tables(spark, sf):
    kinds = "doc_id long, text string, source string, component_id string, row int, id string, bin int"
    rows = [(None, None, None, "a", 1, "i", 2), (1, "", "s", None, None, None, None), (1, "", "s", None, None, None, None), (2, "word " * 50000, None, "b", 3, "j", 4), (None, "one two", "t", "c", 5, "k", 6)]
    for df in (spark.createDataFrame(rows, kinds), spark.createDataFrame([], kinds)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, sf)
            if name == "best-fit packing":
                assert out.groupBy().agg({"length": "sum"}).first()[0] == (sum(len((r[1] or "").encode()) + 1 for r in rows) if df.count() else None)
            else:
                assert out.columns == df.columns and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


def test_registered():
    import __spark_entry__

    assert set(queries.QUERIES) <= set(__spark_entry__.queries())
