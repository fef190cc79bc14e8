"""A word-level FM-index of one training shard: wavelet-tree ranks, backward search, sampled suffix positions."""

from __future__ import annotations

import numpy as np

#: every so many words of a text, and at its first word, the suffix position is kept
SAMPLE = 16


class Bits:
    """A bit vector with ranks."""

    def __init__(self, bits: np.ndarray):
        pad = -len(bits) % 64 + 64
        words = np.packbits(np.append(bits, np.zeros(pad, bool)), bitorder="little").view(np.uint64)
        self.words = words
        self.sums = np.zeros(len(words), np.int32)
        np.cumsum(np.bitwise_count(words[:-1]), out=self.sums[1:], dtype=np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits before position i."""
        block, bit = i >> 6, (i & 63).astype(np.uint64)
        below = self.words[block] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.sums[block] + np.bitwise_count(below)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class Wavelet:
    """A wavelet matrix: one bit vector per bit of the symbols, highest first."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.depth = max(1, int(top).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for level in range(self.depth - 1, -1, -1):
            bit = (symbols >> level) & 1 == 1
            zeros = symbols[~bit]
            self.levels.append((Bits(bit), len(zeros)))
            symbols = np.concatenate([zeros, symbols[bit]])
        # where each symbol's run begins below the last level
        self.runs = symbols

    def _begin(self, symbol: np.ndarray) -> np.ndarray:
        at = np.zeros(len(symbol), np.int64)
        for k, (bits, zeros) in enumerate(self.levels):
            one = bits.rank(at)
            at = np.where((symbol >> (self.depth - 1 - k)) & 1, zeros + one, at - one)
        return at

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before position i."""
        return self._follow(symbol, i) - self._begin(symbol)

    def _follow(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (bits, zeros) in enumerate(self.levels):
            one = bits.rank(i)
            i = np.where((symbol >> (self.depth - 1 - k)) & 1, zeros + one, i - one)
        return i

    def access(self, i: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(i), np.int64)
        for bits, zeros in self.levels:
            bit, one = bits.get(i).astype(np.int64), bits.rank(i)
            i = np.where(bit, zeros + one, i - one)
            symbol = symbol * 2 + bit
        return symbol


def suffix_order(code: np.ndarray, top: int) -> np.ndarray:
    """Positions in the order of their suffixes. ``code`` ends with a symbol that occurs once, and no two separators are equal."""
    n = len(code)
    per = max(1, 62 // max(1, int(top).bit_length()))
    key, wide = np.zeros(n, np.int64), np.append(code, np.zeros(per, np.int64))
    for k in range(per):
        key = (key << int(top).bit_length()) | wide[k : k + n]
    del wide
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])
    del key
    rank = np.empty(n, np.int64)
    begin = np.flatnonzero(new)
    rank[order] = np.repeat(begin, np.diff(np.append(begin, n)))
    step = per
    # only positions that still share a rank are sorted again, by the rank one step ahead
    size = np.diff(np.append(begin, n))
    slots = np.flatnonzero(np.repeat(size > 1, size))
    while len(slots):
        at = order[slots]
        ahead = np.where(at + step < n, rank[np.minimum(at + step, n - 1)], -1)
        mine = rank[at]
        by = np.lexsort((ahead, mine)) if n >= 1 << 31 else np.argsort(mine * (n + 1) + ahead + 1, kind="stable")
        at, ahead, mine = at[by], ahead[by], mine[by]
        order[slots] = at
        new = np.append(True, (mine[1:] != mine[:-1]) | (ahead[1:] != ahead[:-1]))
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(at)))
        rank[at] = slots[np.repeat(begin, size)]
        slots = slots[np.repeat(size > 1, size)]
        step *= 2
    return order


class Shard:
    """The index of the words of some texts. ``words`` are hashes, ``first`` the bounds of the texts in them."""

    def __init__(self, words: np.ndarray, first: np.ndarray):
        self.alphabet, code = np.unique(words, return_inverse=True)
        texts, sigma = len(first) - 1, len(self.alphabet)
        # each text is followed by a separator of its own
        shift = np.repeat(np.arange(texts), np.diff(first))
        n = len(words) + texts
        body = np.empty(n, np.int64)
        where = np.arange(len(words)) + shift
        body[where] = code.ravel() + texts
        ends = first[1:] + np.arange(texts)
        body[ends] = np.arange(texts)
        sampled = np.zeros(n, bool)  # by the word's number, from the start of its text
        sampled[where[(np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))) % SAMPLE == 0]] = True
        del code, shift, where
        self.texts, self.n = texts, n
        order = suffix_order(body + 1, sigma + texts + 1)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(body, minlength=sigma + texts))])
        kept = sampled[order]
        self.kept, self.sample = Bits(kept), order[kept]
        order -= 1
        body = body[order]
        del order
        self.last = Wavelet(body, sigma + texts)
        self.begins = np.append(0, ends[:-1] + 1)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row range of the suffixes that begin with each phrase (rows of equally many word hashes)."""
        count, m = phrases.shape
        low, high = np.zeros(count, np.int64), np.zeros(count, np.int64)
        if not len(self.alphabet) or not count:
            return low, high
        at = np.minimum(np.searchsorted(self.alphabet, phrases), len(self.alphabet) - 1)
        live = np.flatnonzero((self.alphabet[at] == phrases).all(1))
        code = at + self.texts
        low[live] = self.before[code[live, m - 1]]
        high[live] = self.before[code[live, m - 1] + 1]
        for k in range(m - 2, -1, -1):
            if not len(live):
                break
            c = code[live, k]
            lo, hi = self.before[c] + self.last.rank(c, low[live]), self.before[c] + self.last.rank(c, high[live])
            low[live], high[live] = lo, hi
            live = live[lo < hi]
        high = np.maximum(high, low)
        return low, high

    def locate(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and word number of the suffix in each row, by walking back to a kept position."""
        out, steps = np.full(len(rows), -1, np.int64), np.zeros(len(rows), np.int64)
        rows, live = rows.copy(), np.arange(len(rows))
        while len(live):
            hit = self.kept.get(rows[live]).astype(bool)
            found = live[hit]
            out[found] = self.sample[self.kept.rank(rows[found])] + steps[found]
            live = live[~hit]
            c = self.last.access(rows[live])
            rows[live] = self.before[c] + self.last.rank(c, rows[live])
            steps[live] += 1
        text = np.searchsorted(self.begins, out, side="right") - 1
        return text, out - self.begins[text]
