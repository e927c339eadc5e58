"""Vectorised words and word shingles over Arrow string arrays.

Both word patterns in use only name ASCII separators, so they can be told apart byte by byte in
UTF-8. Texts are cut into spans of a few MB (a single longer text is a span of its own, hashed in
blocks of words), which bounds the memory of a worker whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPAN_BYTES = 2 << 20
WORD_BLOCK = 1 << 17

#: Words of letters, digits and anything beyond ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z are lower-cased.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Words between white space: [^\x20\x09-\x0D]+.
SPACED = np.ones(256, bool)
SPACED[0x20] = False
SPACED[0x09:0x0E] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15
_POWERS = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.full(max(n, 64), _BASE, np.uint64)
        _POWERS[0] = 1
        _POWERS = np.cumprod(_POWERS, dtype=np.uint64)
    return _POWERS


@dataclass
class Span:
    """Words of documents ``first`` to ``first + len(bounds) - 2`` of a batch.

    ``bounds[i]:bounds[i + 1]`` are the words of the i-th of them; ``starts`` and ``ends`` are byte
    positions in ``data``; ``origin`` has the byte position of each document.
    """

    first: int
    data: np.ndarray
    origin: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def docs(self) -> int:
        return len(self.bounds) - 1

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.docs), np.diff(self.bounds))

    def word(self, i: int) -> bytes:
        return LOWER[self.data[self.starts[i] : self.ends[i]]].tobytes()

    def hashes(self, longest: int | None = None, only: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of each lower-cased word (or of those that ``only`` numbers), or of its first ``longest`` bytes."""
        starts, ends = (self.starts, self.ends) if only is None else (self.starts[only], self.ends[only])
        out = np.empty(len(starts), np.uint64)
        for at in range(0, len(out), WORD_BLOCK):
            s, e = starts[at : at + WORD_BLOCK], ends[at : at + WORD_BLOCK]
            size = e - s if longest is None else np.minimum(e - s, longest)
            edge = np.cumsum(size) - size
            within = np.arange(int(size.sum())) - np.repeat(edge, size)
            byte = LOWER[self.data[within + np.repeat(s, size)]].astype(np.uint64) + np.uint64(1)
            out[at : at + WORD_BLOCK] = mix(np.add.reduceat(byte * _powers(int(size.max()))[within], edge) + size.astype(np.uint64))
        return out


def spans(texts: pa.Array, inside: np.ndarray = ALNUM) -> Iterator[Span]:
    """The words of ``texts``; null counts as empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SPAN_BYTES, "right")) - 1)
        last = min(last, len(texts))
        own, origin = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        is_word = inside[own]
        before = np.empty_like(is_word)
        before[1:] = is_word[:-1]
        before[:1] = False
        before[origin[:-1][origin[:-1] < len(own)]] = False
        starts = np.flatnonzero(is_word & ~before)
        after = np.empty_like(is_word)
        after[:-1] = is_word[1:]
        after[-1:] = False
        after[origin[1:][origin[1:] > 0] - 1] = False
        ends = np.flatnonzero(is_word & ~after) + 1
        yield Span(first, own, origin, starts, ends, np.searchsorted(starts, origin))
        first = last


_SLOTS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(words: np.ndarray, bounds: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``k`` words and the bounds of each document's windows.

    A document of fewer words, but not none, has its whole sequence as its one window.
    """
    n = np.diff(bounds)
    per = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_bounds = np.concatenate([[0], np.cumsum(per)])
    at = np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1], per) + np.repeat(bounds[:-1], per)
    size = np.repeat(np.minimum(n, k), per)
    total = size.astype(np.uint64) * np.uint64(_BASE)
    for j in range(k):
        live = size > j
        total += np.where(live, words[np.minimum(at + j, max(len(words) - 1, 0))] * _SLOTS[j] if len(words) else 0, 0).astype(np.uint64)
    return mix(total), out_bounds


def distinct_sorted(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct values in ascending order, and their bounds."""
    values = values.copy()
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        values[a:b].sort()  # numpy sorts plain numbers far faster than their order
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[bounds[:-1][np.diff(bounds) > 0]] = True
    return values[keep], np.concatenate([[0], np.cumsum(keep)])[bounds].astype(np.int64)
