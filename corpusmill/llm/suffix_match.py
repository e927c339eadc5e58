"""Benchmark decontamination with suffix arrays over the training documents.

Documents are cut into shards of bounded size (a longer text is one of its own). A shard's suffix
array is sparse: it has the suffixes whose first words (four, or the whole window if shorter) begin
some test window; the others cannot match one. Suffixes are ordered by word numbers, eight words at
a time and only among ties. Every test window start is then searched in it by bisection, all at
once, which gives all places of the window; from there the match is followed to its full length.

The test set is the stated query set. It is numbered in blocks of at most ``BLOCK_WORDS`` words
(about 60 MB as a broadcast). The documents are searched for one block at a time, and a block is
given up before the next is sent, so that the driver and every worker hold one. Between two blocks
the rows are written to the shared folder with what was found so far; test sets of one block, some
5 MB of text, take a single map. There is no shuffle, and what a lost executor held is one more map
task. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .shared import lean, materialise

#: Words of the test set in one broadcast.
BLOCK_WORDS = 1_000_000
#: Words of the documents in one suffix array.
SHARD_WORDS = 1 << 19
HEAD = 4
SO_FAR = "id long, text string, hits array<struct<first:long,end:long>>, items array<string>, matches array<struct<item:string,item_word:long,doc_word:long,length:long>>"
FOUND = "id long, n_words long, n_hit long, items array<string>, matches array<struct<item:string,item_word:long,doc_word:long,length:long>>"


def _key(cols: list[np.ndarray]) -> np.ndarray:
    total = np.zeros(len(cols[0]), np.uint64)
    for j, c in enumerate(cols):
        total += c.astype(np.uint64) * words._SLOTS[j]
    return words.mix(total + np.uint64(len(cols)))


class TestBlock:
    """Items as word numbers, their windows, and what begins them."""

    __test__ = False

    def __init__(self, ids: list[str], texts: list[str], window: int, skipped: list[int] | None = None):
        spans = list(words.spans(pa.array(texts, pa.string())))
        hashes = [s.hashes() for s in spans]
        every = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        self.vocabulary = np.unique(every)
        self.flags = np.zeros(1 << 20, bool)
        self.flags[self.vocabulary & np.uint64((1 << 20) - 1)] = True
        self.ids = ids
        self.skipped = np.asarray(skipped or [0] * len(ids), np.int64)  # words of the item that stand before the text
        size = np.concatenate([*(np.diff(s.bounds) for s in spans), np.zeros(0, np.int64)]).astype(np.int64)
        start = np.cumsum(size + 1) - size - 1
        self.seq = np.zeros(int(size.sum() + len(size)) + 16, np.int64)
        item = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(every)) + item
        self.seq[place] = self.number(every)
        per = np.where(size >= window, size - window + 1, np.minimum(size, 1))
        self.item = np.repeat(np.arange(len(size)), per)
        first = np.concatenate([[0], np.cumsum(per)[:-1]]) if len(per) else per
        self.at = np.arange(int(per.sum())) - np.repeat(first, per) + start[self.item] if len(per) else np.zeros(0, np.int64)
        self.length = np.minimum(size, window)[self.item]
        self.item_start, self.longest = start, int(size.max(initial=0))
        self.heads = []
        for g in range(1, HEAD + 1):
            own = self.at[(self.length >= HEAD) if g == HEAD else (self.length == g)]
            if len(own):
                keys = np.unique(_key([self.seq[own + j] for j in range(g)]))
                flags = np.zeros(1 << 20, bool)
                flags[keys & np.uint64((1 << 20) - 1)] = True
                self.heads.append((g, keys, flags))

    def number(self, h: np.ndarray) -> np.ndarray:
        """1 and up for words of the test set, else 0."""
        out = np.zeros(len(h), np.int64)
        maybe = np.flatnonzero(self.flags[h & np.uint64((1 << 20) - 1)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.vocabulary, h[maybe]), len(self.vocabulary) - 1)
            out[maybe] = np.where(self.vocabulary[at] == h[maybe], at + 1, 0)
        return out

    def suffixes(self, seq: np.ndarray) -> np.ndarray:
        """Positions in ``seq`` that begin like a window, in the order of their suffixes."""
        live = np.zeros(len(seq), bool)
        for g, keys, flags in self.heads:
            known = np.flatnonzero(seq[: len(seq) - 16])
            for j in range(1, g):
                known = known[seq[known + j] > 0]
            key = _key([seq[known + j] for j in range(g)])
            maybe = flags[key & np.uint64((1 << 20) - 1)]
            known, key = known[maybe], key[maybe]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            live[known[keys[at] == key]] = True
        at = np.flatnonzero(live)
        group, tied, depth = np.zeros(len(at), np.int64), np.arange(len(at)), 0
        while len(tied) > 1 and depth < self.longest:
            cols = [seq[np.minimum(at[tied] + depth + j, len(seq) - 1)] for j in range(8)]
            order = np.lexsort([*cols[::-1], group[tied]])
            at[tied] = at[tied][order]
            step = group[tied][1:] != group[tied][:-1]
            for c in cols:
                step |= c[order][1:] != c[order][:-1]
            new = np.concatenate([[True], step])
            group[tied] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
            same = np.concatenate([~step, [False]]) | np.concatenate([[False], ~step])
            tied, depth = tied[same], depth + 8
        return at

    def search(self, seq: np.ndarray, array: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window the range of ``array`` whose suffixes begin with it."""
        out = []
        for upper in (False, True):
            lo, hi = np.zeros(len(self.at), np.int64), np.full(len(self.at), len(array))
            while (open_ := np.flatnonzero(lo < hi)).size:
                mid = (lo[open_] + hi[open_]) // 2
                sign, todo = np.zeros(len(open_), np.int64), np.arange(len(open_))
                for j in range(int(self.length.max())):
                    todo = todo[(sign[todo] == 0) & (self.length[open_[todo]] > j)]
                    if not len(todo):
                        break
                    sign[todo] = np.sign(seq[array[mid[todo]] + j] - self.seq[self.at[open_[todo]] + j])
                right = (sign < 0) | (upper & (sign == 0))
                lo[open_[right]], hi[open_[~right]] = mid[right] + 1, mid[~right]
            out.append(lo)
        return out[0], out[1]

    def matches(self, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of windows in ``seq``, the window there, and the length to which the match goes on."""
        array = self.suffixes(seq)
        if not len(array):
            return (np.zeros(0, np.int64),) * 3
        lo, hi = self.search(seq, array)
        count = hi - lo
        which = np.repeat(np.arange(len(lo)), count)
        place = array[np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + lo[which]]
        length = self.length[which].copy()
        grow = np.arange(len(which))
        while len(grow):
            a, b = self.seq[np.minimum(self.at[which[grow]] + length[grow], len(self.seq) - 1)], seq[np.minimum(place[grow] + length[grow], len(seq) - 1)]
            grow = grow[(a == b) & (a > 0)]
            length[grow] += 1
        return place, which, length


PLACES = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
MATCHES = pa.list_(pa.struct([("item", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("length", pa.int64())]))


def _shards(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, word hashes and words a document of shards of about ``SHARD_WORDS`` words, whatever a batch holds."""
    first, hashes, size = 0, [], []
    for span in words.spans(texts):
        hashes.append(span.hashes())
        size.append(np.diff(span.bounds))
        last = span.first + span.docs
        if last == len(texts) or sum(map(len, hashes)) >= SHARD_WORDS:
            yield first, last, np.concatenate(hashes), np.concatenate(size).astype(np.int64)
            first, hashes, size = last, [], []


def _scan(batches: Iterator[pa.RecordBatch], shared) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, list, list, list]]:
    """Per shard its rows, their words, hit words, and lists of hit places, items and matches.

    Rows are ``id, text`` and, from the second block on, ``hits, items, matches`` so far, which are added to.
    """
    test = shared.value
    for batch in batches:
        for first, last, hashes, size in _shards(batch.column(1)):
            n, rows = last - first, batch.slice(first, last - first)
            start = np.cumsum(size + 1) - size - 1
            edge = np.zeros(int(size.sum()) + n + 17, np.int32)
            items: dict[int, set] = {}
            found: dict[int, list] = {}
            if batch.num_columns > 2:
                for d, (places, own, matched) in enumerate(zip(*(rows.column(i).to_pylist() for i in (2, 3, 4)), strict=True)):
                    if places:
                        items[d], found[d] = set(own), matched
                        for x in places:
                            edge[start[d] + x["first"]] += 1
                            edge[start[d] + x["end"]] -= 1
            seq = np.zeros(len(edge) - 1, np.int64)
            seq[np.arange(len(hashes)) + np.repeat(np.arange(n), size)] = test.number(hashes)
            at, which, length = test.matches(seq)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + test.length[which], -1)
            doc = np.searchsorted(start, at, "right") - 1
            item = test.item[which]
            for d, i in np.unique(np.stack([doc, item]), axis=1).T.tolist() if len(doc) else ():
                items.setdefault(d, set()).add(test.ids[i])
            # a match that goes on from the word before is part of a longer one
            before = (seq[at - 1] == test.seq[test.at[which] - 1]) & (seq[at - 1] > 0) & (at > 0) & (test.at[which] > 0) if len(at) else np.zeros(0, bool)
            for d, i, w, p, k in zip(*(x[~before].tolist() for x in (doc, item, test.at[which] - test.item_start[item] + test.skipped[item], at - start[doc], length)), strict=True):
                found.setdefault(d, []).append({"item": test.ids[i], "item_word": w, "doc_word": p, "length": k})
            inside = np.cumsum(edge) > 0
            hit = np.concatenate([[0], np.cumsum(inside)])
            turns = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
            hits: dict[int, list] = {}
            for d, a, b in zip((np.searchsorted(start, turns[::2], "right") - 1).tolist(), turns[::2].tolist(), turns[1::2].tolist(), strict=True):
                hits.setdefault(d, []).append({"first": a - int(start[d]), "end": b - int(start[d])})
            yield rows, size, (hit[start + size] - hit[start]).astype(np.int64), [hits.get(d, []) for d in range(n)], [sorted(items.get(d, ())) for d in range(n)], [found.get(d, []) for d in range(n)]


def _searched(batches: Iterator[pa.RecordBatch], shared, last: bool) -> Iterator[pa.RecordBatch]:
    for rows, size, n_hit, hits, items, matches in _scan(batches, shared):
        tail = [pa.array(items, pa.list_(pa.string())), pa.array(matches, MATCHES)]
        if last:
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(size), pa.array(n_hit), *tail], names=["id", "n_words", "n_hit", "items", "matches"])
        else:
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(hits, PLACES), *tail], names=["id", "text", "hits", "items", "matches"])


def test_blocks(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int = BLOCK_WORDS) -> Iterator[tuple[TestBlock, bool]]:
    """The test set in blocks of at most ``block_words`` words, one at a time, and whether it is the last; an empty one has one empty block.

    A longer item is cut into parts that have ``window - 1`` words in common.
    """
    block_words = max(block_words, window)

    def parts() -> Iterator[tuple[str, str, int]]:
        rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
        for i, text in rows.toLocalIterator():
            if len(text) < 2 * block_words:
                yield i, text, 0
                continue
            for span in words.spans(pa.array([text], pa.string())):
                n, at, end = len(span.starts), 0, 0
                while end < n:
                    end = min(n, at + block_words)
                    yield i, span.data[span.starts[at] : span.ends[end - 1]].tobytes().decode(), at
                    at = end - window + 1

    ids, texts, skipped, n = [], [], [], 0
    for i, text, at in parts():
        size = (len(text) + 1) // 2 if len(text) < 2 * block_words else block_words
        if ids and n + size > block_words:
            yield TestBlock(ids, texts, window, skipped), False
            ids, texts, skipped, n = [], [], [], 0
        ids.append(i)
        texts.append(text)
        skipped.append(at)
        n += size
    yield TestBlock(ids, texts, window, skipped), True


test_blocks.__test__ = False


def suffix_matches(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(id_col, n_words, n_hit, items, matches)`` for each row of ``docs``.

    Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` with A-Z lower-cased. A test window is
    ``window`` consecutive words of an item, or the whole of a shorter one. ``n_hit`` counts the
    document's words inside any occurrence of a window, ``items`` has the distinct ids (as strings)
    of items with an occurring window, ``matches`` each longest verbatim match with its places.

    Null or empty texts have no words and match nothing; repeated rows and ids are returned as they
    come; a test item without id has the id ``""``; without test items nothing is hit. A match over
    the edge of two parts of an item of over ``block_words`` words is listed in two. Other columns
    are ignored.
    """
    sc = docs.sparkSession.sparkContext
    state = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    for block, last in test_blocks(items, item_id, item_text, window, block_words):
        shared = sc.broadcast(block)
        state = state.mapInArrow(lambda it, b=shared, e=last: lean(_searched(it, b, e)), FOUND if last else SO_FAR)
        if not last:
            state = materialise(state, "searched")
            shared.destroy()
    return state.withColumnRenamed("id", id_col)


def _clean(batches: Iterator[pa.RecordBatch], shared, text: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = pa.array(np.zeros(batch.num_rows, np.int64))
        parts = _scan(iter([pa.RecordBatch.from_arrays([ids, batch.column(text).cast(pa.string())], names=["id", "text"])]), shared)
        hit = np.concatenate([np.zeros(0, np.int64), *(part[2] for part in parts)])
        yield batch.filter(pa.array(hit == 0))


def without_matches(docs: DataFrame, items: DataFrame, window: int = 10, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that ``suffix_matches`` finds no hit in, with all their columns and without a join."""
    sc, text = docs.sparkSession.sparkContext, docs.columns.index(text_col)
    for block, last in test_blocks(items, item_id, item_text, window, block_words):
        shared = sc.broadcast(block)
        docs = docs.mapInArrow(lambda it, b=shared: lean(_clean(it, b, text)), docs.schema)
        if not last:
            docs = materialise(docs, "clean")
            shared.destroy()
    return docs
