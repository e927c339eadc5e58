"""The training-data pipeline: each stage works on all that the stage before it kept.

Every stage takes a table with doc_id, text and source and any other columns, whatever their names,
and gives back the same columns (packing: its pieces). Ids may be null or repeated and texts null or
empty in all of them; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.ngram_join import jaccard_components
from corpusmill.llm.packing import pack
from corpusmill.llm.queries import held_out
from corpusmill.llm.shared import discard, fresh_names, materialise, table
from corpusmill.llm.suffix_match import without_matches
from corpusmill.llm.toxicity import train, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows that the classifier calls toxic, by their whole texts; labels of ids that aren't there, and rows without label or id, don't matter."""
    return without_toxic(docs, train(docs, table(spark, sf_dir, "labels"), usable=lambda c: ~held_out(c)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row, that of the smallest id; Spark broadcasts the others' row keys where they are few.

    Rows are told apart by a key of their own, so ids may be null (they come last), repeated or
    carry several texts. Wordless texts are in no group and all stay.
    """
    (row,) = fresh_names([*docs.columns, "component_id", "n_shingles"], "row")
    keyed = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")
    rows = keyed.count()
    found = jaccard_components(keyed, id_col=row).select(row, "component_id")
    placed = materialise(found.join(keyed.select(row, "doc_id"), row), "placed", rows)
    first = placed.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", row)).alias("m")).select(f"m.{row}")
    gone = materialise(placed.select(row).join(first, row, "left_anti"), "gone", rows)
    discard(placed)
    return keyed.join(gone, row, "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows that hold a window of a benchmark item; each row is judged by its own text, so ids don't matter."""
    return without_matches(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every row and its bin; null texts are empty ones, a null source is a source like others."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: Training and the similarity join have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            discard(before)
        before = docs
    return docs
