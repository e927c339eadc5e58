"""Sharding by histogram sort, in DataFrame operations only.

Rows are ordered by (hash of the text, id, input partition). Round by round the bytes and rows below
candidate key boundaries are counted exactly over all partitions: first for equal ranges of the
hash, then, only where a range is too heavy or holds a splitter that misses its target by more than
the tolerance, for finer ranges of it, of the id inside one hash, and at last of the input partition
inside one id. So a text or a row that a third of all rows repeat is cut as well. When all splitters
meet the tolerance, the rows are exchanged once, each range to a task of its own, and numbered
inside the ranges; a range's first number comes from the counts.

Equal texts lie side by side, so a shard boundary cuts at most one group of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .shared import fresh_names, materialise, shuffle_partitions

#: Bits of the key that one round adds.
STEP = 10
HASH_BITS, PARTITION_BITS = 32, 20


def _prefix(parts: list[tuple[Column, int]], bits: int) -> Column:
    """The start of the range of keys that have the first ``bits`` bits in common, as a sortable text. ``parts`` are columns and their bits."""
    out = []
    for value, width in parts:
        drop = max(0, width - bits)
        out.append(F.lpad(F.hex(F.shiftleft(F.shiftright(value, drop), drop)), -(-width // 4), "0"))
        bits -= width
        if bits <= 0:
            break
    return F.concat(*out)


def histogram_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", tolerance: float = 0.001, range_bytes: int = 32 << 20) -> DataFrame:
    """The rows of ``docs`` with ``size``, ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 in each shard).

    ``size`` is the UTF-8 bytes of the text (null: none) plus 1. The shards' sums of sizes differ by
    ``tolerance`` of their mean and the one row on the boundary at most; at 0 every row is in the
    shard in which the middle of its bytes lies in key order. Null ids come first among equal texts.
    Repeated rows are cut like others. ``docs`` has to give the same rows in the same partitions
    when it is read again, as files and tables do. Columns of ``docs`` named like the results are
    replaced, all other columns are kept; an empty table gives an empty result.
    """
    text, ident = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(id_col).cast("long")
    h, t, u, leaf_, range_, pieces_, rank_, piece_ = fresh_names([*docs.columns, "size", "shard", "slot", "id"], "h t u leaf range pieces rank piece")
    keyed = docs.drop("size", "shard", "slot").withColumns({"size": (F.octet_length(text) + 1).cast("long"), h: F.crc32(text.cast("binary")), u: F.pmod(F.spark_partition_id(), F.lit(1 << PARTITION_BITS)).cast("long")})
    keys = materialise(keyed.select(h, ident.alias("id"), u, "size"), "keys")
    least, most, total, rows = keys.agg(F.min("id"), F.max("id"), F.sum("size"), F.count("*")).first()
    if not rows:
        return keyed.select(*[c for c in keyed.columns if c not in (h, u)], F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    least = least or 0
    id_bits = max(1, ((most or 0) - least + 1).bit_length())
    place = lambda c: F.coalesce(c - F.lit(least) + 1, F.lit(0).cast("long"))
    keys = keys.withColumn(t, place(F.col("id")))
    parts = [(F.col(h), HASH_BITS), (F.col(t), id_bits), (F.col(u), PARTITION_BITS)]
    edges = [HASH_BITS, HASH_BITS + id_bits, HASH_BITS + id_bits + PARTITION_BITS]
    ideal = total / shards
    heavy = min(ideal / 4, max(range_bytes, total / (8 * shuffle_partitions(docs.sparkSession)))) if rows > 1 else total
    leaves: list[tuple[str, int, int]] = []
    rounds: list[tuple[int, list[str]]] = []
    bits, parents = STEP, None
    while True:
        own = keys if parents is None else keys.where(_prefix(parts, rounds[-1][0]).isin(parents))
        found = own.groupBy(_prefix(parts, bits).alias("p")).agg(F.sum("size"), F.count("*")).collect()
        counted = sorted(leaves + [tuple(r) for r in found])
        below, split = 0, []
        fresh = {r[0] for r in found}
        for p, size, n in counted:
            miss = any(below + tolerance * ideal < k * ideal < below + size - tolerance * ideal for k in range(1, shards))
            if p in fresh and n > 1 and bits < edges[-1] and (size > heavy or miss):
                split.append(p)
            below += size
        gone = set(split)
        leaves = [x for x in counted if x[0] not in gone]
        rounds.append((bits, split))
        if not split:
            break
        parents, bits = split, min(bits + STEP, next(e for e in edges if e > bits))
    leaf = _prefix(parts, rounds[-1][0])
    for at, split in reversed(rounds[:-1]):
        leaf = F.when(_prefix(parts, at).isin(split), leaf).otherwise(_prefix(parts, at))

    # A leaf goes whole to the shard in which its middle lies, but for one of equal keys: its rows are dealt by their number.
    # Leaves of a shard are joined to ranges.
    named, below, room = [], 0, max(heavy / 2, 1)
    firsts: dict[int, int] = {}
    range_no, shard_before, filled = -1, -1, 0.0
    shard_at = lambda b: min(int(b / ideal), shards - 1)
    for p, size, n in sorted(leaves):
        first, last = shard_at(below + size / n / 2), shard_at(below + size - size / n / 2)
        cuts = [(0, shard_at(below + size / 2))]
        if first < last and len(p) == sum(-(-w // 4) for _, w in parts):
            cuts = [(0, first)]
            for s in range(first + 1, last + 1):
                k = next(k for k in range(max(0, int((s * ideal - below) * n / size) - 2), n + 1) if k == n or shard_at(below + (k + 0.5) * size / n) >= s)
                cuts.append((k, s))
        if len(cuts) > 1 or cuts[0][1] != shard_before or filled + size > room:
            range_no, filled, in_range = range_no + 1, 0, 0
        pieces = []
        for (k, s), end in zip(cuts, [*(k for k, _ in cuts[1:]), n], strict=True):
            pieces.append((in_range + k, s, firsts.get(s, 0) - in_range - k))
            firsts[s] = firsts.get(s, 0) + end - k
        named.append((p, range_no, pieces))
        shard_before, below, filled, in_range = cuts[0][1] if len(cuts) == 1 else -1, below + size, filled + size, in_range + n
    # pieces: of the rows of a range numbered from ``from`` on, the shard and what is added to the number.
    where = docs.sparkSession.createDataFrame(named, f"{leaf_} string, {range_} int, {pieces_} array<struct<from:long,shard:int,add:long>>")
    full = keyed.withColumn(t, place(ident)).withColumn(leaf_, leaf)
    dealt = full.join(F.broadcast(where), leaf_) if len(named) < 100_000 else full.join(where, leaf_)
    dealt = dealt.repartitionById(range_no + 1, F.col(range_))
    rank = F.row_number().over(Window.partitionBy(range_).orderBy(h, t, u)) - 1
    dealt = dealt.withColumn(rank_, rank).withColumn(piece_, F.element_at(F.filter(pieces_, lambda x: x["from"] <= F.col(rank_)), -1))
    return dealt.withColumns({"shard": F.col(f"{piece_}.shard"), "slot": F.col(rank_) + F.col(f"{piece_}.add")}).drop(h, t, u, leaf_, range_, pieces_, rank_, piece_)
