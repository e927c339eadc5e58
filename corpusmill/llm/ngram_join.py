"""Similarity self-join of documents on word n-grams by vertical partitioning.

The global order of n-grams is the order of their 64-bit hashes; it is cut into fragments of equal
width, so that each fragment has an equal share of all distinct n-grams, those of about
``FRAGMENT_BYTES`` of text however large the table and whatever the session's settings. Every
document's set is cut along with it.

1. *Fragments.* A map over the texts emits, for every ``BUFFER_GRAMS`` n-grams and each fragment, one
   blob with the documents' n-grams there (never more blobs than n-grams). The group of a fragment
   sees every holder of its n-grams and keeps those with two holders or more, with the exact number
   of holders. A passage that many different documents share adds 16 bytes for each of them to the
   fragments of its n-grams.
2. *Candidates.* A document can only link if 80 % of its set is held by others as well. For the
   survivors the n-grams are ordered from rare to common; two linked documents share one of the
   first ``n - ceil(0.8 n) + 1``, of which those without another holder come first. Passages that
   many documents share are last in that order and lead to no candidates.
3. *Overlaps.* The sets are cut into ``OVERLAP_PARTS`` fragments; for each candidate pair the overlap
   is counted in each on its own and summed for the pair; the sum decides.

A large group of near copies is first compared with one document per n-gram (the one with the
fewest n-grams of its own). Only pairs that are then still in different components are compared one
by one, if their sizes and shared parts allow a link; where both were compared with the same
document, what they lack of it and have besides gives their exact overlap, without their sets.
Components, and not the pairs, are the result, so this loses no link.

Sets are told apart by 64-bit hashes, n-grams by the first 60 to 64 bits of theirs: 56 beside the
fragment's number of 4 bits or more, 48 beside one of 16 or more. Documents with equal sets form one
class from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words
from .components import connected
from .shared import discard, gathered, lean, lean_group, materialise

NO_ID = np.iinfo(np.int64).max
BLOBS = "kind int, key int, part int, a binary, b binary, c binary, d binary"
MEMBERS, CLASSES, GRAMS = 2, 0, 1
#: Bytes of text whose n-grams make a fragment, and the least bits of a fragment's number.
FRAGMENT_BYTES, FEWEST_BITS = 16 << 20, 4
#: Bytes of text whose fragments a task takes, one after the other.
TASK_BYTES = 48 << 20
#: N-grams that a map task holds before it emits them.
BUFFER_GRAMS = 1 << 19
#: Fragments in which the overlaps of pairs are counted.
OVERLAP_PARTS = 2


def _pack(h: np.ndarray, bits: int) -> bytes:
    """Each hash without the ``bits`` that its fragment tells, in 7 bytes, or 6 beyond 65536 fragments."""
    low = (h << np.uint64(bits)) >> np.uint64(64 - 8 * _width(bits))
    return low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : _width(bits)].tobytes()


def _width(bits: int) -> int:
    return 7 if bits < 16 else 6


def _unpack(raw: bytes, bits: int, part: int) -> np.ndarray:
    size = _width(bits)
    out = np.zeros((len(raw) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(-1, size)
    low = out.reshape(-1).view("<u8").astype(np.uint64)
    return (low << np.uint64(64 - 8 * size)) >> np.uint64(bits) | np.uint64(part << 64 - bits)


def _holders(keys: np.ndarray, count: np.ndarray) -> tuple[bytes, bytes]:
    """Class keys and how many n-grams follow for each, in two bytes; a class with more comes again."""
    times = -(-count // 65535)
    last = np.cumsum(times) - 1
    rest = np.full(int(times.sum()), 65535, np.int64)
    rest[last] = count - 65535 * (times - 1)
    return np.repeat(keys, times).tobytes(), rest.astype("<u2").tobytes()


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where each run of equal values begins and ends."""
    edge = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return zip(edge.tolist(), [*edge[1:].tolist(), len(values)], strict=False)


def _row(kind: int, key: int, part: int, *blobs: bytes) -> tuple:
    return (kind, key, part, *blobs, *[b""] * (4 - len(blobs)))


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] * 3 + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], names=["kind", "key", "part", "a", "b", "c", "d"])


def set_keys(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit key for each document's set; 0 stands for the empty set."""
    sums = np.zeros(len(bounds) - 1, np.uint64)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        sums[full] = np.add.reduceat(words.mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), bounds[:-1][full])
    size = np.diff(bounds).astype(np.uint64)
    return np.where(full, words.mix(sums + size * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1), np.uint64(0))


def _by_fragment(sets: list[tuple[np.ndarray, np.ndarray]], bits: int) -> pa.RecordBatch:
    """A blob for each fragment with the n-grams and class keys of ``sets``."""
    grams, keys = (np.concatenate(x) for x in zip(*sets, strict=True))
    part = (grams >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.int64)
    order = np.argsort(part, kind="stable")  # small numbers are dealt by their digits
    grams, keys, part = grams[order], keys[order], part[order]
    head = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (part[1:] != part[:-1])]))
    count = np.diff(np.concatenate([head, [len(grams)]])).astype(np.int64)
    rows = []
    for lo, hi in _runs(part):
        a, b = np.searchsorted(head, (lo, hi))
        f = int(part[lo])
        rows.append(_row(GRAMS, f, f, *_holders(keys[head[a:b]], count[a:b]), _pack(grams[lo:hi], bits)))
    return _table(rows)


def _cut(batches: Iterator[pa.RecordBatch], k: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Each fragment's n-grams by class, each bucket's classes, and the members of the classes."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    known_keys: set[int] = set()  # the classes among ``held``
    for batch in batches:
        ids = batch.column(0).cast(pa.int64())
        known = np.asarray(ids.is_valid())
        ids = np.asarray(ids.fill_null(NO_ID))
        for span in words.spans(batch.column(1), words.SPACED):
            grams, bounds = words.distinct_sorted(*words.shingles(span.hashes(), span.bounds, k))
            keys, size = set_keys(grams, bounds), np.diff(bounds)
            own, valid = ids[span.first : span.first + span.docs], known[span.first : span.first + span.docs]
            rows = [_row(MEMBERS, span.first % (1 << bits), 0, own.tobytes(), keys.tobytes(), size.astype(np.int64).tobytes(), valid.tobytes())]
            order = np.lexsort((own, keys))
            new = np.ones(len(order), bool)
            new[1:] = keys[order][1:] != keys[order][:-1]
            first = order[new & (keys[order] != 0)]
            bucket = (keys[first] & np.uint64((1 << bits) - 1)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            first, bucket = first[by], bucket[by]
            for lo, hi in _runs(bucket):
                at = first[lo:hi]
                rows.append(_row(CLASSES, int(bucket[lo]), 0, keys[at].tobytes(), own[at].tobytes(), size[at].astype(np.int64).tobytes()))
            yield _table(rows)
            take = np.zeros(span.docs, bool)
            take[[i for i in first.tolist() if keys[i].item() not in known_keys]] = True
            known_keys.update(keys[take].tolist())
            live = np.repeat(take, size)
            held.append((grams[live], np.repeat(keys, size)[live]))
            if sum(len(x) for x, _ in held) >= BUFFER_GRAMS:
                yield _by_fragment(held, bits)
                held, known_keys = [], set()
    if sum(len(x) for x, _ in held):
        yield _by_fragment(held, bits)


def _shared(table: pa.Table, bits: int) -> pa.Table:
    """Of one fragment, the n-grams with two classes or more, dealt by the class; other kinds of rows pass."""
    kind = np.asarray(table["kind"])
    out = [table.filter(pa.array(kind != GRAMS))]
    table = table.filter(pa.array(kind == GRAMS))
    if not table.num_rows:
        return out[0]
    f = table["key"][0].as_py()
    keys = np.concatenate([np.repeat(np.frombuffer(a, np.uint64), np.frombuffer(b, "<u2")) for a, b in zip(table["a"].to_pylist(), table["b"].to_pylist(), strict=True)])
    grams = np.concatenate([_unpack(c, bits, f) for c in table["c"].to_pylist()])
    order = np.argsort(grams, kind="stable")
    sorted_ = grams[order]
    same = np.zeros(len(order), bool)
    same[1:] = sorted_[1:] == sorted_[:-1]
    same[:-1] |= same[1:]
    order = order[same]
    grams, keys = grams[order], keys[order]
    order = np.lexsort((keys, grams))
    grams, keys = grams[order], keys[order]
    new = np.ones(len(order), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (keys[1:] != keys[:-1])
    grams, keys = grams[new], keys[new]
    if len(grams):
        start = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        held = np.repeat(np.diff(np.concatenate([start, [len(grams)]])), np.diff(np.concatenate([start, [len(grams)]])))
        live = held > 1
        grams, keys, held = grams[live], keys[live], np.minimum(held[live], 65535)  # only orders n-grams
        bucket = (keys & np.uint64((1 << bits) - 1)).astype(np.int64)
        order = np.lexsort((keys, bucket))
        grams, keys, held, bucket = grams[order], keys[order], held[order], bucket[order]
        rows = []
        for lo, hi in _runs(bucket):
            holder, count = np.unique(keys[lo:hi], return_counts=True)
            rows.append(_row(GRAMS, int(bucket[lo]), f, *_holders(holder, count), _pack(grams[lo:hi], bits), held[lo:hi].astype(np.uint16).tobytes()))
        out.append(pa.Table.from_batches([_table(rows)]))
    return pa.concat_tables([x.cast(out[0].schema) for x in out])


SETS = T.StructType([T.StructField("node", T.LongType()), T.StructField("least_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("grams", T.ArrayType(T.LongType())), T.StructField("probe", T.IntegerType())])


def _survivors(table: pa.Table, bits: int, least: int, whole: int) -> pa.Table:
    """Each class of a bucket once: its smallest id, its size and, if it may link, its shared n-grams from rare to common."""
    kind = np.asarray(table["kind"])
    base, rows = table.filter(pa.array(kind == CLASSES)), table.filter(pa.array(kind == GRAMS))
    keys, ids, size = (np.concatenate([np.frombuffer(x, t) for x in base[c].to_pylist()] or [np.zeros(0, t)]) for c, t in (("a", np.uint64), ("b", np.int64), ("c", np.int64)))
    order = np.lexsort((ids, keys))
    keys, ids, size = keys[order], ids[order], size[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    keys, ids, size = keys[new], ids[new], size[new]
    holder, grams, held = [], [], []
    for part, a, b, c, d in zip(*(rows[x].to_pylist() for x in ("part", "a", "b", "c", "d")), strict=True):
        holder.append(np.repeat(np.frombuffer(a, np.uint64), np.frombuffer(b, "<u2")))
        grams.append(_unpack(c, bits, part))
        held.append(np.frombuffer(d, np.uint16))
    at = np.searchsorted(keys, np.concatenate(holder)) if holder else np.zeros(0, np.int64)
    shared = np.bincount(at, minlength=len(keys))
    may = (shared * whole >= least * size) & (ids != NO_ID)
    grams, held = (np.concatenate(grams), np.concatenate(held)) if holder else (np.zeros(0, np.uint64), np.zeros(0, np.uint16))
    live = may[at]
    at, grams, held = at[live], grams[live], held[live]
    order = np.lexsort((grams, held, at))
    at, grams = at[order], grams[order]
    count = np.where(may, shared, 0)
    probe = size - (size * least + whole - 1) // whole + 1 - (size - count)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.array(grams.view(np.int64), pa.int64()), mask=pa.array(~may))
    return pa.table({"node": keys.view(np.int64), "least_id": ids, "n": size, "grams": lists, "probe": np.where(may, np.maximum(probe, 0), 0).astype(np.int32)})


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, c, d in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            ids = pa.array(np.frombuffer(a, np.int64), mask=~np.frombuffer(d, bool))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.frombuffer(b, np.int64)), pa.array(np.frombuffer(c, np.int64))], names=["id", "node", "n"])


def _overlaps(pairs: DataFrame, sets: DataFrame, differences: bool = False) -> DataFrame:
    """``pairs(a, b)`` with both sizes and the overlap, counted in each fragment and summed per pair.

    ``differences`` adds what is shared of ``b``'s set, what ``a`` lacks of it, and what it has besides.
    """
    parts = F.explode(F.transform(F.sequence(F.lit(0), F.lit(OVERLAP_PARTS - 1)), lambda p: F.struct(p.alias("part"), F.filter("grams", lambda g: F.pmod(F.shiftrightunsigned(g, 48), F.lit(OVERLAP_PARTS)) == p).alias("own"))))
    cut = sets.select("node", "n", parts.alias("p")).select("node", "n", "p.part", "p.own")
    left = cut.select(F.col("node").alias("a"), F.col("n").alias("n_a"), "part", F.col("own").alias("own_a"))
    leads = cut.join(pairs.select(F.col("b").alias("node")).distinct(), "node", "left_semi")
    right = leads.select(F.col("node").alias("b"), F.col("n").alias("n_b"), "part", F.col("own").alias("own_b"))
    each = pairs.join(left, "a").join(right, ["b", "part"])
    if not differences:
        return each.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("own_a", "own_b")).alias("both")).groupBy("a", "b", "n_a", "n_b").agg(F.sum("both").alias("both"))
    each = each.select("a", "b", "n_a", "n_b", F.size("own_b").alias("s_b"), F.array_except("own_b", "own_a").alias("lost"), F.array_except("own_a", "own_b").alias("added"))
    summed = each.groupBy("a", "b", "n_a", "n_b").agg(F.sum("s_b").alias("s_b"), F.sum(F.col("s_b") - F.size("lost")).alias("both"), F.flatten(F.collect_list("lost")).alias("lost"), F.flatten(F.collect_list("added")).alias("added"))
    return summed.select("a", "b", "n_a", "n_b", "s_b", "both", "lost", "added")


def _linked(scored: DataFrame, least: int, whole: int) -> DataFrame:
    return scored.where(F.col("both") * whole >= least * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")


def _allowed(room, least: int, whole: int):
    """Whether an overlap of at most ``room`` is enough for a link."""
    return room * (whole + least) >= least * (F.col("n_a") + F.col("n_b"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, least: int = 80, whole: int = 100) -> DataFrame:
    """``(id_col, n_shingles, component_id)`` for each row of ``docs``.

    Words are runs without ASCII white space, A-Z lower-cased; a document's set has its distinct
    windows of ``k`` words, or its whole sequence if that is shorter. Two documents link when
    ``whole * |intersection| >= least * |union|``. ``component_id`` is the smallest id reachable.

    Null or wordless texts have 0 shingles and are alone. A row without id gets no component and
    lends none. Repeated rows are returned as often as they come; ids that occur with several texts
    keep one row for each. Other columns are ignored. An empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    volume, n_docs = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    bits = max(FEWEST_BITS, ((volume or 0) // FRAGMENT_BYTES).bit_length())
    cut = texts.mapInArrow(lambda it: lean(_cut(it, k, bits)), BLOBS)
    by_key = lambda df, f, kind: df.repartitionById(1 << bits, F.col("key")).groupBy("key").applyInArrow(lambda t: lean_group(f, t), kind).coalesce(max(1, -(-(volume or 0) // TASK_BYTES)))
    blobs = materialise(by_key(cut, lambda x: _shared(x, bits), BLOBS), "grams")
    classes = materialise(by_key(blobs.where(F.col("kind") != MEMBERS), lambda x: _survivors(x, bits, least, whole), SETS), "classes")
    members = blobs.where(F.col("kind") == MEMBERS).select("a", "b", "c", "d").mapInArrow(_members, "id long, node long, n long")

    sets = classes.where("probe > 0")
    tokens = materialise(sets.select("node", "n", F.size("grams").alias("s"), F.explode(F.slice("grams", 1, F.col("probe"))).alias("gram")), "tokens")
    n_sets, n_tokens = sets.count(), tokens.count()
    lead = tokens.groupBy("gram").agg(F.min(F.struct((F.col("n") - F.col("s")).alias("own"), "node", "n", "s")).alias("lead"), F.count("*").alias("held")).where("held > 1")
    near = tokens.select("gram", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("s").alias("s_a")).join(lead.select("gram", F.col("lead.node").alias("b"), F.col("lead.n").alias("n_b"), F.col("lead.s").alias("s_b")), "gram")
    shared = F.least("s_a", "s_b")
    votes = near.where((F.col("a") != F.col("b")) & _allowed(shared, least, whole)).groupBy("a", "b").count()
    first = votes.groupBy("a").agg(F.max(F.struct("count", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    scored = materialise(_overlaps(first, sets, differences=True), "scored", n_sets, 20_000)
    linked = materialise(_linked(scored, least, whole), "linked", n_sets)

    # Two documents compared with the same one differ from it in little, and those differences give their overlap.
    known = connected(linked)
    against = scored.select(F.col("a").alias("node"), F.col("b").alias("lead"), F.col("s_b").alias("s_lead"), "lost", "added")
    mine = tokens.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = mine.groupBy("gram").agg(F.min(F.struct(F.col("n") - F.col("s"), "node", "component")).alias("head"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("gram", F.col("head.component").alias("main"))
    open_ = materialise(mine.join(heads, "gram").join(against, "node", "left"), "open", n_tokens)
    side = lambda x: open_.select("gram", "main", *[F.col(c).alias(f"{k}_{x}") for c, k in (("node", "id"), ("n", "n"), ("s", "s"), ("component", "c"), ("lead", "lead"), ("s_lead", "t"), ("lost", "lost"), ("added", "added"))])
    left, right = side("a").where("c_a <> main"), side("b").drop("main", "t_b")
    fresh = ~F.col("lead_a").eqNullSafe(F.col("id_b")) & ~F.col("lead_b").eqNullSafe(F.col("id_a"))
    once = (F.col("c_b") == F.col("main")) | (F.col("id_a") < F.col("id_b"))
    same = F.coalesce(F.col("lead_a") == F.col("lead_b"), F.lit(False))
    exact = F.col("t_a") - F.size(F.array_union("lost_a", "lost_b")) + F.size(F.array_intersect("added_a", "added_b"))
    may = (F.col("c_a") != F.col("c_b")) & once & fresh & _allowed(shared, least, whole)
    rest = left.join(right, "gram").where(F.when(may, F.when(same, _allowed(exact, least, whole)).otherwise(True)).otherwise(False))
    rest = materialise(rest.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"), same.alias("sure")).distinct(), "rest", n_tokens)
    links = materialise(linked.unionByName(rest.where("sure").select("a", "b")).unionByName(_linked(_overlaps(rest.where("not sure").select("a", "b"), sets), least, whole)), "links", n_sets + rest.count())

    found = connected(links)
    named = found.join(classes.select("node", "least_id"), "node")
    ids = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    labelled = materialise(classes.select("node", "least_id").join(found.join(ids, "component").select("node", "component_id"), "node", "left").select("node", F.coalesce("component_id", "least_id").alias("component_id")), "named", n_docs)
    discard(classes, tokens, scored, linked, open_, rest, links)
    full = members.where("node <> 0").join(labelled, "node").select("id", "n", "component_id")
    every = gathered(full, n_docs, 20_000).unionByName(members.where("node = 0").select("id", "n", F.col("id").alias("component_id")))
    return every.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))
