"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch retains every 64-bit hash of a document's five-word shingles below a fixed share of the
hash range, so two sketches compare as the whole sets do, however unequal their sizes, and the
sketch of a union is the union of sketches. The smallest hash is always retained, so that only
wordless texts have an empty sketch; ``merged`` drops such a stand-in when it isn't needed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .shared import lean, row_ranges, shuffle_partitions

SHARE = 1 / 8
#: Sketches of fewer hashes are too coarse to compare by; such pairs are compared as whole sets.
FEW = 64
#: Bytes of text that are compared at a time.
SLICE_BYTES = 1 << 20
PAIRS = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def shingle_sets(texts: pa.Array, k: int = 5) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, ascending."""
    out = []
    for span in words.spans(texts, words.SPACED):
        values, bounds = words.distinct_sorted(*words.shingles(span.hashes(), span.bounds, k))
        out += np.split(values, bounds[1:-1])
    return out


def retained(values: np.ndarray, share: float = SHARE) -> np.ndarray:
    """The sketch of a set: its hashes below the share, or its smallest one; their first 48 bits."""
    low = values[: np.searchsorted(values, np.uint64(int(share * 2**64) - 1), "right")]
    return np.unique((low if len(low) else values[:1]) >> np.uint64(16))


def sketches(texts: pa.Array, share: float = SHARE, k: int = 5) -> list[np.ndarray]:
    """Each text's retained shingle hashes, ascending."""
    return [retained(x, share) for x in shingle_sets(texts, k)]


def merged(a: np.ndarray, b: np.ndarray, share: float = SHARE) -> np.ndarray:
    """The sketch of two documents' union."""
    both = np.union1d(a, b)
    low = both[both <= np.uint64((int(share * 2**64) - 1) >> 16)]
    return low if len(low) else both[:1]


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smaller set that the other holds, estimated if these are sketches; 1 for two empty ones.

    A stand-in says nothing of a document whose retained hashes lie below the share; see ``nearness``.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    few, many = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(many, few), len(many) - 1)
    return float(np.count_nonzero(many[at] == few)) / len(few)


def nearness(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> float:
    """The containment of two documents by their sketches ``of_a`` and ``of_b`` or, where one of these has few hashes, by the whole sets."""
    return containment(of_a, of_b) if min(len(of_a), len(of_b)) >= FEW else containment(a, b)


def printed(sketch: np.ndarray) -> str:
    """The hashes' 48 bits in hex, one after the other."""
    return sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()


def _compare(batches: Iterator[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    """Rows come in order; each is compared with the one after it. Borrowed rows only follow others.

    What a slice needs, and one row before it, is all that is held besides the batch.
    """
    kept = None
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    for batch in batches:
        for first, last in row_ranges(batch.column(1), SLICE_BYTES):
            part = batch.slice(first, last - first)
            ids, texts, borrowed = part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist()
            sets = shingle_sets(part.column(1))
            own = [retained(x, share) for x in sets]
            if kept is not None:
                ids, texts, borrowed, sets, own = ([x, *rest] for x, rest in zip(kept, (ids, texts, borrowed, sets, own), strict=True))
            kept = (ids[-1], texts[-1], borrowed[-1], sets[-1], own[-1])
            todo = [i for i in range(len(ids) - 1) if not borrowed[i]]
            edited = [texts[i][: len(texts[i]) - len(texts[i]) // 3] + texts[i + 1][: len(texts[i]) // 3] for i in todo]
            rows = []
            for i, text, whole in zip(todo, edited, shingle_sets(pa.array(edited, pa.string())), strict=True):
                sketch = retained(whole, share)
                near = (nearness(sets[i], whole, own[i], sketch), nearness(sets[i], sets[i + 1], own[i], own[i + 1]))
                rows.append((ids[i], len(texts[i]), hashlib.sha256(text.encode()).hexdigest(), printed(own[i]), printed(sketch), *near))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)], names=[x.split()[0] for x in PAIRS.split(", ")])


def _below(value, cuts: list[int]):
    """How many of the ascending ``cuts`` lie below ``value``; a search in two steps, since tables of many ranges have many cuts."""
    step = max(1, math.isqrt(len(cuts)))
    rows = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    if not rows:
        return F.lit(0)
    literal = lambda own: F.expr(f"cast(split('{','.join(map(str, own))}', ',') as array<bigint>)")
    row = F.size(F.filter(literal([own[-1] for own in rows]), lambda c: c < value))
    within = F.expr("array(" + ", ".join(f"cast(split('{','.join(map(str, own))}', ',') as array<bigint>)" for own in rows) + ")")
    return F.when(row == len(rows), len(cuts)).otherwise(row * step + F.size(F.filter(F.get(within, row), lambda c: c < value)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, range_rows: int = 2048) -> DataFrame:
    """Fingerprints of each row's text and of its edited text, and how near they and the next row's are.

    Rows are taken by descending id (null ids last, within an id by a descending hash of the text),
    and after the last comes the first; the edited text has the last third of the code points
    replaced by the first as many of the next text. Null texts count as empty; repeated rows are
    returned as often as they come; other columns are ignored; an empty table gives an empty result.

    Rows are dealt once, by ranges of (id, hash of the text, input partition), some ``range_rows``
    rows each, or more where that would make more ranges than twice the shuffle partitions. An id
    with many rows, as null may be, is cut by the hash, and rows that are equal by where they come
    from. Each range also borrows the first row of the range that follows, so that no task needs
    another one's rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("id"), text.alias("text"))
    rows = rows.withColumn("mark", F.shiftleft(F.shiftrightunsigned(F.xxhash64("text"), 21), 20))
    rows = rows.withColumn("place", F.col("mark") + F.pmod(F.spark_partition_id(), F.lit(1 << 20)))
    n = max(1, min(2 * shuffle_partitions(spark), rows.count() // range_rows))
    quantiles = lambda c: F.percentile_approx(c, [i / n for i in range(1, n)], 10 * n)
    every = (rows.agg(quantiles("id")).first()[0] or []) if n > 1 else []
    cuts = sorted(set(every))
    below = _below(F.col("id"), cuts)
    number, task, tasks = below * n, below, len(cuts) + 1
    # An id that fills whole quantiles is cut along its places. Ranges are numbered in order, and every range is a task.
    hot = {i: m for i in cuts if (m := every.count(i)) > 1}
    for i, places in rows.where(F.col("id").isin(list(hot))).groupBy("id").agg(quantiles("place")).collect() if hot else ():
        inner = sorted(set(places[:: max(1, n // hot[i])]))
        part = _below(F.col("place"), inner)
        number = F.when(F.col("id") == i, cuts.index(i) * n + part).otherwise(number)
        task = F.when((F.col("id") == i) & (part > 0), tasks - 1 + part).otherwise(task)
        tasks += len(inner)
    placed = rows.withColumns({"range": number.cast("long"), "task": task.cast("int")})
    heads = sorted(tuple(r) for r in placed.groupBy("range", "task").agg(F.max("id").alias("id")).select("range", "id", "task").collect())
    if not heads:
        return spark.createDataFrame([], PAIRS).withColumnRenamed("id", id_col)
    # The range below a range follows it; after the lowest comes the highest.
    follow = spark.createDataFrame([(*heads[k - 1][:2], t) for k, (_, _, t) in enumerate(heads)], "range long, id long, after int")
    first = placed.join(F.broadcast(follow), ["range", "id"]).groupBy("id", "after").agg(F.max(F.struct("mark", "text")).alias("m"))
    borrowed = first.select("id", "m.text", "m.mark", F.lit(1).alias("borrowed"), F.col("after").alias("task"))
    both = placed.select("id", "text", "mark", F.lit(0).alias("borrowed"), "task").unionByName(borrowed)
    dealt = both.repartitionById(tasks, F.col("task")).sortWithinPartitions("borrowed", F.desc("id"), F.desc("mark"), F.desc("text"))
    found = dealt.select("id", "text", "borrowed").mapInArrow(lambda it: lean(_compare(it, share)), PAIRS)
    return found.select(F.nullif("id", F.lit(-(2**63))).alias(id_col), *[x.split()[0] for x in PAIRS.split(", ")][1:])
