"""Best-fit packing of documents into training sequences under conflicts.

Documents are dealt by hash into packing groups of bounded expected size, so that a source or a
group of copies with a third of all rows is spread over all of them. In a group, pieces go in
decreasing length into bins that are kept in the order of their residual room. A bin carries a
bitmap of its sources and one of its duplicate clusters; from the tightest bin with enough room the
search goes on to the next roomier ones until one has neither the piece's source nor its cluster.
If there is none, a bin is opened.

A document longer than a bin is cut, between two code points; all its pieces but the last have a bin
of their own.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ngram_join import jaccard_components
from .shared import gathered, lean_group, materialise

GROUP_ROWS = 4096
BINS = "id long, piece int, start long, length long, source string, cluster long, bin string, used long"


def best_fit(lengths: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """A bin number for each piece; pieces have to come in decreasing length. Cluster -1 conflicts with nothing."""
    rooms: list[tuple[int, int]] = []
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    out = []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        s, c = 1 << source, 1 << cluster if cluster >= 0 else 0
        at = bisect_left(rooms, (length, -1))
        while at < len(rooms) and (source_bits[rooms[at][1]] & s or cluster_bits[rooms[at][1]] & c):
            at += 1
        if at < len(rooms):
            room, number = rooms.pop(at)
        else:
            room, number = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        source_bits[number] |= s
        cluster_bits[number] |= c
        if room > length:
            insort(rooms, (room - length, number))
        out.append(number)
    return out


def _pack(table: pa.Table, capacity: int) -> pa.Table:
    group = table["group"][0].as_py()
    table = table.select(["id", "length", "source", "cluster", "cuts"]).sort_by([("length", "descending"), ("cluster", "ascending"), ("id", "ascending")])
    ids, sources, clusters = table["id"].to_pylist(), table["source"].to_pylist(), table["cluster"].to_pylist()
    length = np.asarray(table["length"])
    cuts = [own or [] for own in table["cuts"].to_pylist()]
    rest = length - np.array([own[-1] if own else 0 for own in cuts], np.int64)
    rows, full = [], 0
    for i, own in enumerate(cuts):
        for piece, (start, end) in enumerate(zip([0, *own], own, strict=False)):
            rows.append((ids[i], piece, start, end - start, sources[i], clusters[i], f"{group}-f{full}", end - start))
            full += 1
    tail = np.flatnonzero(rest)
    tail = tail[np.argsort(-rest[tail], kind="stable")]
    source_no: dict = {}
    often: dict = {}
    for i in tail:
        often[clusters[i]] = often.get(clusters[i], 0) + 1
    cluster_no = {c: k for k, c in enumerate(c for c, n in often.items() if n > 1)}
    bins = best_fit([int(rest[i]) for i in tail], [source_no.setdefault(sources[i], len(source_no)) for i in tail], [cluster_no.get(clusters[i], -1) for i in tail], capacity)
    used = np.bincount(bins, weights=rest[tail]).astype(np.int64) if bins else []
    for i, b in zip(tail.tolist(), bins, strict=True):
        rows.append((ids[i], len(cuts[i]), int(length[i] - rest[i]), int(rest[i]), sources[i], clusters[i], f"{group}-{b}", int(used[b])))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in BINS.split(", ")]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 8, kinds, strict=True)], names=names)


def byte_cuts(text: Column, capacity: int) -> Column:
    """Where a text of over ``capacity`` UTF-8 bytes, its end mark among them, is cut: the last code point edge that fits, again and again. Null for others."""
    raw, size = text.cast("binary"), F.octet_length(text) + 1
    # at most three bytes before an edge go on a code point
    edge = lambda p: p - F.aggregate(F.sequence(F.lit(0), F.lit(2)), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, k: on(a, p - k), lambda a: a["n"])

    def on(a: Column, p: Column) -> Column:
        inner = a["on"] & F.hex(F.substring(raw, p + 1, F.lit(1))).between("80", "BF")
        return F.struct((a["n"] + inner.cast("int")).alias("n"), inner.alias("on"))

    def step(own: Column, _: Column) -> Column:
        last = F.coalesce(F.try_element_at(own, F.lit(-1)), F.lit(0))
        return F.when(size - last > capacity, F.array_append(own, edge(last + capacity))).otherwise(own)

    most = (size / (capacity - 3)).cast("int") + 1
    return F.when(size > capacity, F.aggregate(F.sequence(F.lit(1), most), F.expr("cast(array() as array<int>)"), step)).cast("array<long>")


def even_cuts(length: Column, capacity: int) -> Column:
    """Every ``capacity``-th place before the end. Null for what isn't longer."""
    return F.when(length > capacity, F.transform(F.sequence(F.lit(1).cast("long"), F.ceil(length / capacity) - 1), lambda i: i * capacity))


def pack(docs: DataFrame, capacity: int = 8192, length: Column | None = None, cluster: Column | None = None, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", group_rows: int = GROUP_ROWS, cuts: Column | None = None) -> DataFrame:
    """``(id_col, piece, start, length, source, cluster, bin, used)``: every piece of every row of ``docs``.

    ``length`` (default: UTF-8 bytes and one end mark; null counts as empty) is what a row takes of a
    bin's ``capacity`` (4 at least); rows of equal ``cluster`` (default: equal texts) and rows of one
    source don't meet in a bin. A row that is longer than a bin is cut at ``cuts`` (default: between
    code points, or evenly if ``length`` is given). ``used`` is the bin's sum. Null ids and sources
    are values like any other; a repeated row conflicts with itself and is dealt like any other
    row; an empty table gives an empty result; other columns are ignored.
    """
    if capacity < 4:
        raise ValueError("a bin has to hold any code point")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    if cuts is None:
        cuts = byte_cuts(text, capacity) if length is None else even_cuts(length, capacity)
    length = F.octet_length(text) + 1 if length is None else length
    cluster = F.xxhash64(text) if cluster is None else cluster
    rows = docs.select(F.col(id_col).cast("long").alias("id"), length.cast("long").alias("length"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), cluster.cast("long").alias("cluster"), cuts.alias("cuts"), F.monotonically_increasing_id().alias("row"))
    groups = max(1, -(-docs.select(F.col(id_col)).count() // group_rows))
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("id", "length", "row"), F.lit(groups)).cast("int")).drop("row")
    packed = dealt.groupBy("group").applyInArrow(lambda t: lean_group(lambda x: _pack(x, capacity), t), BINS)
    return gathered(packed, groups, 1).withColumnRenamed("id", id_col)


def pack_apart(docs: DataFrame, capacity: int = 8192, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pack`` with the components of ``jaccard_components`` as clusters, so that near copies don't meet in a bin either.

    ``cluster`` is the component's smallest 64-bit hash of id and text; wordless texts are in a
    cluster with equal ones. Texts aren't shuffled for it, only hashes and lengths.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(id_col, source_col, text.alias("text"), F.xxhash64(F.col(id_col), text).alias("key"))
    found = jaccard_components(keyed, id_col="key", text_col="text").where("n_shingles > 0").groupBy("key").agg(F.min("component_id").alias("component"))
    rows = keyed.select(id_col, source_col, "key", (F.octet_length("text") + 1).alias("length"), F.xxhash64("text").alias("equal"), byte_cuts(F.col("text"), capacity).alias("cuts")).join(found, "key", "left")
    rows = materialise(rows.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), "length", "cuts", F.coalesce("component", "equal").alias("component")), "clusters", docs.count(), 20_000)
    return pack(rows, capacity, F.col("length"), F.col("component"), "id", "source", group_rows=group_rows, cuts=F.col("cuts"), text_col="source").withColumnRenamed("id", id_col)
