"""The heads of many MD5 digests at once: numpy takes a step of the digest for some thousand messages together."""

from __future__ import annotations

import hashlib
import math

import numpy as np

_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_TURNS = [[np.uint32(s) for s in own] for own in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))]
_WORDS = [*range(16), *[(5 * i + 1) % 16 for i in range(16)], *[(3 * i + 5) % 16 for i in range(16)], *[7 * i % 16 for i in range(16)]]
_START = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
#: Messages taken together, the fewest that are worth it, and the most 64-byte blocks of one; others go one by one.
_TOGETHER, _FEWEST, _LONGEST = 8192, 256, 4


def _digested(blocks: np.ndarray) -> np.ndarray:
    """The first state word after ``blocks`` (blocks, 16, messages)."""
    n = blocks.shape[2]
    state = [np.full(n, x, np.uint32) for x in _START]
    f, g = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for words in blocks:
        a, b, c, d = (x.copy() for x in state)
        for i in range(64):
            if i < 16:  # (b & c) | (~b & d)
                np.bitwise_xor(c, d, out=f)
                np.bitwise_and(f, b, out=f)
                np.bitwise_xor(f, d, out=f)
            elif i < 32:  # (d & b) | (~d & c)
                np.bitwise_xor(b, c, out=f)
                np.bitwise_and(f, d, out=f)
                np.bitwise_xor(f, c, out=f)
            elif i < 48:
                np.bitwise_xor(b, c, out=f)
                np.bitwise_xor(f, d, out=f)
            else:
                np.invert(d, out=f)
                np.bitwise_or(f, b, out=f)
                np.bitwise_xor(f, c, out=f)
            np.add(f, a, out=f)
            np.add(f, words[_WORDS[i]], out=f)
            np.add(f, _SINES[i], out=f)
            turn = _TURNS[i // 16][i % 4]
            np.right_shift(f, np.uint32(32) - turn, out=g)
            np.left_shift(f, turn, out=f)
            np.bitwise_or(f, g, out=f)
            np.add(f, b, out=a)
            a, b, c, d = d, a, b, c
        for x, y in zip(state, (a, b, c, d)):
            x += y
    return state[0]


def heads(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each stretch of ``data`` (bytes) the number that the first eight hex digits of its MD5 make."""
    out, size = np.empty(len(begin), np.int64), end - begin
    blocks = (size + 8) // 64 + 1
    wide = np.concatenate([data, np.zeros(64 * _LONGEST, np.uint8)])
    left = blocks > _LONGEST
    for k in range(1, _LONGEST + 1):
        own = np.flatnonzero(blocks == k)
        if len(own) < _FEWEST:
            left[own] = True
            continue
        # a row for each size: which bytes stay, and what comes behind them
        sizes = np.arange(64 * k - 8)
        stay = np.where(np.arange(64 * k) < sizes[:, None], 255, 0).astype(np.uint8)
        behind = np.zeros((len(sizes), 64 * k), np.uint8)
        behind[sizes, sizes] = 128
        behind[:, -8:] = (sizes * 8).astype("<u8").view(np.uint8).reshape(-1, 8)
        stay, behind = stay.view(np.uint64), behind.view(np.uint64)
        windows = np.lib.stride_tricks.as_strided(wide[: 64 * k].view(f"V{64 * k}"), (len(data) + 1,), (1,))
        for at in range(0, len(own), _TOGETHER):
            these = own[at : at + _TOGETHER]
            rows = windows[begin[these]].view(np.uint64).reshape(-1, 8 * k)
            rows &= stay[size[these]]
            rows |= behind[size[these]]
            words = np.ascontiguousarray(rows.view("<u4").T).reshape(k, 16, -1)
            out[these] = _digested(words).byteswap()
    raw = data.tobytes() if left.any() else b""
    for i in np.flatnonzero(left).tolist():
        out[i] = int.from_bytes(hashlib.md5(raw[begin[i] : end[i]]).digest()[:4], "big")
    return out
