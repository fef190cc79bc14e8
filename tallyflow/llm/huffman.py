"""Canonical, length-limited Huffman codes of token ids, in numpy.

Codes come from global counts by package-merge. A block is coded on its own: bits from the left, and the bit
offset of every ``CHECK``-th id beside it. Decoding looks ``limit`` bits up in one table and runs all
checkpoints of a block side by side.
"""

from __future__ import annotations

import numpy as np

#: longest code, unless there are more symbols than it can tell apart
LIMIT = 18
CHECK = 64


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits; 0 for symbols that do not occur."""
    out = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    n = len(used)
    if n < 2:
        out[used] = 1
        return out
    limit = max(limit, int(n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    level, leaves = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        m = len(level) // 2
        both = np.concatenate([weights, level[0 : 2 * m : 2] + level[1 : 2 * m : 2]])
        by = np.argsort(both, kind="stable")
        level = both[by]
        leaves.append(by < n)
    need, length = 2 * n - 2, np.zeros(n, np.int64)
    for is_leaf in reversed(leaves):
        own = int(is_leaf[:need].sum())
        length[:own] += 1
        need = 2 * (need - own)
    out[order] = length
    return out


class Code:
    """Canonical codes of the given lengths: by length, then by symbol."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.limit = int(self.lengths.max(initial=1))
        symbols = np.lexsort((np.arange(len(lengths)), self.lengths))
        symbols = symbols[self.lengths[symbols] > 0]
        size = 1 << (self.limit - self.lengths[symbols])
        begin = np.concatenate([[0], np.cumsum(size)])
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[symbols] = (begin[:-1] >> (self.limit - self.lengths[symbols])).astype(np.uint64)
        table = np.repeat(symbols, size)
        self.symbol = np.zeros(1 << self.limit, np.uint32)
        self.symbol[: len(table)] = table
        self.step = np.ones(1 << self.limit, np.int64)
        self.step[: len(table)] = np.repeat(self.lengths[symbols], size)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits as big-endian 32-bit words, and the checkpoints."""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        at = ends - n
        total = int(ends[-1]) if len(ids) else 0
        shift = (64 - n - (at & 31)).astype(np.uint64)
        wide = self.codes[ids] << shift
        words = np.bincount(at >> 5, (wide >> np.uint64(32)).astype(np.float64), minlength=(total + 31 >> 5) + 1)
        low = np.bincount((at >> 5) + 1, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=len(words))
        words = words + low[: len(words)]
        return words[: total + 31 >> 5].astype(">u4").tobytes(), at[::CHECK].astype("<u8")

    def decode(self, data: bytes, checkpoints: np.ndarray, count: int) -> np.ndarray:
        words = np.append(np.frombuffer(data, ">u4").astype(np.uint64), np.zeros(2, np.uint64))
        at, top = checkpoints.astype(np.int64), len(words) - 2
        out = np.empty((CHECK, len(at)), np.uint32)
        right = np.uint64(64 - self.limit)
        for k in range(CHECK):
            w = np.minimum(at >> 5, top)
            bits = (words[w] << np.uint64(32) | words[w + 1]) << (at & 31).astype(np.uint64) >> right
            out[k] = self.symbol[bits]
            at = at + self.step[bits]
        return out.T.ravel()[:count]
