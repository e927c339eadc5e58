"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives P; the unlabelled set U is drawn from all training
documents, whatever is known of them. With the share of toxic documents ``prior``, the risk of a
classifier g is ``prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])`` (Kiryo et al.,
2017); when the second part falls below zero a step is taken against it.

A document's features are its distinct words and the heads of its words (so that inflected and
compounded forms of a term count together), hashed. Features are kept when they are clearly more
frequent in P than in all training documents; the others only add noise that grows with the length
of a text.

These frequencies are counted over every training document, in the tasks, and summed. Only the
gradient uses a sample, bounded by ``max_positive`` and ``max_unlabelled``, of which just the kept
features reach the driver; every document is scored from its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .shared import lean, materialise

BINS = 1 << 20
#: Bytes of a word's head; None is the whole word.
HEADS = (None, 4, 5, 7)


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float
    prior: float


def features(span: words.Span) -> tuple[np.ndarray, np.ndarray]:
    """One row of feature numbers for each way to cut a word, for the span's distinct words; and which of these each word is."""
    if not len(span.starts):
        return np.zeros((len(HEADS), 0), np.int32), np.zeros(0, np.int64)
    _, first, which = np.unique(span.hashes(), return_index=True, return_inverse=True)
    salt = [np.uint64(0x51ED270B * (i + 1)) for i in range(len(HEADS))]
    return np.stack([(words.mix(span.hashes(h, first) + s) % np.uint64(BINS)).astype(np.int32) for h, s in zip(HEADS, salt, strict=True)]), which


def _sorted_distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([np.ones(min(len(x), 1), bool), x[1:] != x[:-1]])]


def _distinct(span: words.Span, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document of the span, feature) of its distinct features (of those that ``wanted`` marks), by document."""
    f, which = features(span)
    held = _sorted_distinct(span.doc_of_word() * max(1, f.shape[1]) + which)
    doc, which = held // max(1, f.shape[1]), held % max(1, f.shape[1])
    each = []
    for own in f:
        live = slice(None) if wanted is None else wanted[own][which]
        each.append(doc[live] * BINS + own[which[live]])
    pairs = _sorted_distinct(np.concatenate(each))
    return pairs // BINS, pairs % BINS


def _counted(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """``feature, n``: the documents of the task that have each feature (that ``wanted`` marks), and all documents as feature -1."""
    total, n = np.zeros(BINS, np.int64), 0
    for batch in batches:
        n += batch.num_rows
        for span in words.spans(batch.column(0)):
            total += np.bincount(_distinct(span, wanted)[1], minlength=BINS)
    if n:
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], own]), pa.int32()), pa.array(np.concatenate([[n], total[own]]), pa.int64())], names=["feature", "n"])


def _kept(batches: Iterator[pa.RecordBatch], keep: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``kind, features``: those that ``keep`` marks."""
    for batch in batches:
        lists = []
        for span in words.spans(batch.column(1)):
            doc, f = _distinct(span, keep)
            lists += np.split(f.astype(np.int32), np.searchsorted(doc, np.arange(1, span.docs)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tolist() for x in lists], pa.list_(pa.int32()))], names=["kind", "features"])


def clearly(p: np.ndarray, u: np.ndarray, n_p: int, n_u: int, least: int = 5, z: float = 5.0) -> np.ndarray:
    """Whether features of ``p`` of ``n_p`` positives and ``u`` of ``n_u`` documents are clearly more frequent among the positives."""
    n_p, n_u = max(n_p, 1), max(n_u, 1)
    rate = (p + u) / (n_p + n_u)
    score = (p / n_p - u / n_u) / np.sqrt(np.maximum(rate * (1 - rate), 1e-12) * (1 / n_p + 1 / n_u))
    return (p >= least) & (score > z) & (p / n_p > 2 * u / n_u)


def screened(pos: list[np.ndarray], unl: list[np.ndarray]) -> np.ndarray:
    """Features that are clearly more frequent in ``pos`` than in ``unl``."""
    p, u = (np.bincount(np.concatenate([*x, np.zeros(0, np.int32)]).astype(np.int64), minlength=BINS) for x in (pos, unl))
    return clearly(p, u, len(pos), len(unl))


def fit(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, keep: np.ndarray | None = None, steps: int = 300, rate: float = 0.1, decay: float = 1e-4) -> ToxicityModel:
    """Full-batch Adam on the non-negative risk with the logistic loss, over the features that ``keep`` marks (default: screened here)."""
    keep = screened(pos, unl) if keep is None else keep
    number = np.cumsum(keep) - 1
    w = np.zeros(int(keep.sum()) + 1)
    if not pos or not unl or len(w) == 1:
        return ToxicityModel(np.zeros(BINS, np.float32), float(np.log(max(prior, 1e-3) / (1 - min(prior, 0.999)))) if unl or pos else 0.0, prior)
    sets = []
    for docs in (pos, unl):
        own = [number[d[keep[d]]] for d in docs]
        sets.append((np.concatenate([*own, np.zeros(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(own)), [len(x) for x in own]), len(own)))
    m, v = np.zeros_like(w), np.zeros_like(w)
    w[-1] = np.log(prior / (1 - prior))

    def scores(s):
        return np.bincount(s[1], weights=w[s[0]], minlength=s[2]) + w[-1]

    def gradient(s, g):
        out = np.bincount(s[0], weights=g[s[1]], minlength=len(w))
        out[-1] = g.sum()
        return out

    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for t in range(1, steps + 1):
        gp, gu = scores(sets[0]), scores(sets[1])
        as_negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        negative = gradient(sets[1], sigmoid(gu)) / sets[1][2] - prior * gradient(sets[0], sigmoid(gp)) / sets[0][2]
        if as_negative < 0:
            grad = -negative
        else:
            grad = prior * gradient(sets[0], -sigmoid(-gp)) / sets[0][2] + negative
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    weights = np.zeros(BINS, np.float32)
    weights[keep] = w[:-1]
    return ToxicityModel(weights, float(w[-1]), prior)


def _smallest(ids: DataFrame, count: int, wanted: int) -> DataFrame:
    """The ``wanted`` ids of the smallest hashes. Ids above a hash with ample room for them aren't sorted, so that the last task's input doesn't grow with the table."""
    rank, room = F.xxhash64("id"), wanted + wanted // 4 + 1000
    if count > room:
        ids = ids.where(rank < F.lit(-(2**63) + 2**64 * room // count))
    return ids.orderBy(rank, "id").limit(wanted)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", usable=None, max_positive: int = 6000, max_unlabelled: int = 24000) -> ToxicityModel:
    """Fit on at most ``max_positive`` confirmed rows and ``max_unlabelled`` rows taken as unlabelled, those of the smallest id hashes.

    ``usable`` (a function from an id column to a boolean column) restricts what may be learnt from.
    Rows without id are never learnt from, null labels and labels without document are ignored, an id
    that is confirmed once is confirmed; repeated rows count as often as they come. Without confirmed
    rows, or without features that set them apart, every document has the score of the prior.
    """
    usable = usable or (lambda c: F.lit(True))
    labels = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("y")).where(F.col("id").isNotNull() & F.col("y").isNotNull() & usable(F.col("id")))
    total, toxic, confirmed = labels.agg(F.count("*"), F.sum((F.col("y") == 1).cast("long")), F.countDistinct(F.when(F.col("y") == 1, F.col("id")))).first()
    prior = min(max((toxic or 0) / total if total else 0.01, 1e-3), 0.999)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where(F.col("id").isNotNull() & usable(F.col("id")))
    chosen = _smallest(labels.where("y = 1").select("id").distinct(), confirmed, max_positive).withColumn("positive", F.lit(1))
    drawn = _smallest(texts.select("id"), texts.select("id").count(), max_unlabelled).distinct().withColumn("positive", F.lit(0))
    wanted = materialise(chosen.unionByName(drawn).groupBy("id").agg(F.max("positive").alias("p"), F.min("positive").alias("u")), "sample")
    sample = texts.join(F.broadcast(wanted), "id").select((F.col("p") * 2 + (1 - F.col("u"))).alias("kind"), "text")

    def counts(of: DataFrame, features_of: np.ndarray | None = None) -> tuple[int, np.ndarray]:
        found = of.select("text").mapInArrow(lambda it: lean(_counted(it, features_of)), "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
        rows = (found if features_of is not None else found.where("n >= 5")).toArrow()
        out, at, n = np.zeros(BINS, np.int64), np.asarray(rows["feature"]), np.asarray(rows["n"])
        out[at[at >= 0]] = n[at >= 0]
        return int(n[at < 0].sum()), out

    n_p, p = counts(sample.where("kind >= 2"))
    n_u, u = counts(texts, p >= 5)
    keep = clearly(p, u, n_p, n_u)
    rows = sample.mapInArrow(lambda it: lean(_kept(it, keep)), "kind int, features array<int>").toArrow()
    lists = [np.asarray(x.values, np.int32) for x in rows["features"]]
    return fit([x for x, k in zip(lists, rows["kind"].to_pylist(), strict=True) if k >= 2], [x for x, k in zip(lists, rows["kind"].to_pylist(), strict=True) if k % 2], prior, keep)


def _scored(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = shared.value
    live = model.weights != 0
    for batch in batches:
        out = []
        for span in words.spans(batch.column(batch.num_columns - 1)):
            doc, f = _distinct(span, live)
            out.append(np.bincount(doc, weights=model.weights[f], minlength=span.docs) + model.bias)
        z = np.concatenate([*out, np.zeros(0)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], names=["id", "score"])


def toxicity_scores(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score)`` for each row; a null or empty text has the score of no features. The model (4 MB) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lambda it: lean(_scored(it, shared)), "id long, score double").withColumnRenamed("id", id_col)


def _clean(batches: Iterator[pa.RecordBatch], shared, text: int, limit: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = pa.array(np.zeros(batch.num_rows, np.int64))
        (scored,) = _scored(iter([pa.RecordBatch.from_arrays([ids, batch.column(text)], names=["id", "text"])]), shared)
        yield batch.filter(pa.array(np.asarray(scored["score"]) < limit))


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``limit``, with all their columns and without a join."""
    shared, text = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)
    return docs.mapInArrow(lambda it: lean(_clean(it, shared, text, limit)), docs.schema)
