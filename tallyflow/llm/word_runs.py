"""Periodic runs of words: stretches that repeat themselves, with their exact maximal bounds.

Method. A suffix automaton of the words read so far is kept with its link tree as a link-cut tree. The states
on the path from the newest prefix to the root are its suffixes; a preferred path is a *segment* of states
whose last occurrence ended at the same word. Appending word i accesses the new state, which walks the
segments upwards and recolours them all to i. A segment coloured e, whose longest suffix on the path has L words,
says: the last L words also ended at e, and no longer ones did. With d = i - e <= L that is a square: the last
L + d words have period d, and the word before them breaks it. The same start and period at the next word is
the same run, extended.

Why no run of ``factor`` >= 3 periods is missed: at each word from the point where the run is long enough, its
last (factor - 1) periods ended last exactly one period ago, as an occurrence nearer by would give a smaller
period (Fine and Wilf). So their segment has that colour, and its longest suffix reaches the run's start. For
the same reason the period seen is the smallest.

Before, words that can be in no run are left out, in numpy: in a run, each window of ``sure_window`` words occurs
again one period away. So words that no window covers which repeats within their stretch split the text into
stretches, and these again, for up to ``ROUNDS`` rounds. All that is left goes through the automaton, which takes
amortised O(log n) steps a word on any text.

Words are maximal runs of other characters than the six ASCII blanks. Null and empty texts have no words and
no runs; rows of a null or repeated id are rows like any other. A very long text is handled alone, in memory
proportional to it. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow.llm import textops
from tallyflow.llm.tasks import batch as record
from tallyflow.llm.tasks import map_arrow

#: a run has at least so many words, and so many periods
LEAST, FACTOR = 6, 4
ROUNDS = 8

RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


class Automaton:
    """Suffix automaton whose link tree is a link-cut tree; states are numbers, 0 is no state, 1 the root.

    ``upper`` and ``lower`` are a state's children in the splay tree of its segment, ``above`` its parent there or,
    at the top of one, the state that the segment hangs from. ``seen`` is the word where its strings ended last,
    plus one; 0 if they have not. ``late`` is such a value not yet handed down to both children.
    """

    def __init__(self, words: int):
        zeros = array("q", bytes(8 * (2 * words + 2)))
        self.size, self.link, self.upper, self.lower, self.above, self.seen, self.late = (zeros[:] for _ in range(7))
        # most states are left by one word only; the others' further words are in ``more``
        self.word, self.to = zeros[:], zeros[:]
        self.more: dict[int, dict[int, int]] = {}
        self.states, self.last = 2, 1

    def _next(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.to[state]
        more = self.more.get(state)
        return more.get(word, 0) if more else 0

    def _lead(self, state: int, word: int, to: int) -> None:
        if self.word[state] in (0, word):
            self.word[state], self.to[state] = word, to
        else:
            self.more.setdefault(state, {})[word] = to

    def _rotate(self, x: int) -> None:
        upper, lower, above = self.upper, self.lower, self.above
        y = above[x]
        z = above[y]
        if upper[y] == x:
            inner = upper[y] = lower[x]
            lower[x] = y
        else:
            inner = lower[y] = upper[x]
            upper[x] = y
        if inner:
            above[inner] = y
        above[y] = x
        above[x] = z
        if z:
            if upper[z] == y:
                upper[z] = x
            elif lower[z] == y:
                lower[z] = x

    def _settle(self, x: int) -> None:
        """Hands a late value down."""
        t = self.late[x]
        if t:
            for c in (self.upper[x], self.lower[x]):
                if c:
                    self.seen[c] = self.late[c] = t
            self.late[x] = 0

    def _splay(self, x: int) -> None:
        upper, lower, above = self.upper, self.lower, self.above
        path, y = [x], x
        while (z := above[y]) and (upper[z] == y or lower[z] == y):
            path.append(z)
            y = z
        late = self.late
        for z in reversed(path):
            if late[z]:
                self._settle(z)
        while (y := above[x]) and (upper[y] == x or lower[y] == x):
            z = above[y]
            if z and (upper[z] == y or lower[z] == y):
                self._rotate(y if (upper[y] == x) == (upper[z] == y) else x)
            self._rotate(x)

    def append(self, word: int, i: int) -> list[tuple[int, int]]:
        """Adds ``word``, over 0, as number ``i``; gives (distance, longest repeated suffix) of each segment, the deepest first."""
        size, link, above = self.size, self.link, self.above
        new, p = self.states, self.last
        self.states += 1
        size[new] = size[p] + 1
        while p and not self._next(p, word):
            self._lead(p, word, new)
            p = link[p]
        if not p:
            link[new] = 1
        else:
            q = self._next(p, word)
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                c = self.states
                self.states += 1
                self.word[c], self.to[c] = self.word[q], self.to[q]
                if q in self.more:
                    self.more[c] = dict(self.more[q])
                size[c] = size[p] + 1
                link[c] = link[q]
                # the copy comes right above q, in q's segment
                self._splay(q)
                up = self.upper[c] = self.upper[q]
                if up:
                    above[up] = c
                self.upper[q], above[c] = c, q
                self.seen[c] = self.seen[q]
                while p and self._next(p, word) == q:
                    self._lead(p, word, c)
                    p = link[p]
                link[q] = link[new] = c
        above[new] = link[new]
        self.last = new
        seen, lower = self.seen, self.lower
        x, below, out = new, 0, []
        while x:
            self._splay(x)
            if seen[x]:
                out.append((i + 1 - seen[x], size[x]))
            lower[x] = below
            below = x
            x = above[x]
        seen[below] = self.late[below] = i + 1
        return out


def stretch_runs(words: list[int], least: int = LEAST, factor: int = FACTOR) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of words, numbers over 0, of at least ``factor`` periods and ``least`` words."""
    found: dict[tuple[int, int], int] = {}
    automaton = Automaton(len(words))
    for i, word in enumerate(words):
        for period, size in automaton.append(word, i):
            length = size + period
            if size >= (factor - 1) * period and length >= least:
                found[i + 1 - length, period] = length
    return sorted((start, length, period) for (start, period), length in found.items())


def sure_window(least: int, factor: int) -> int:
    """Words of a window that occurs twice in any run of that length wherever it lies: the least of length - 2 * period."""
    return min(max(least, factor * q) - 2 * q for q in range(1, max(least, 2) + 1))


def live_stretches(hash: np.ndarray, row: np.ndarray, least: int = LEAST, factor: int = FACTOR) -> tuple[np.ndarray, np.ndarray]:
    """First words and ends of the stretches that runs can lie in; words are in row order."""
    at, part, gram = np.arange(len(hash)), row, sure_window(least, factor)
    for _ in range(ROUNDS):
        m = max(0, len(at) - gram + 1)
        own, key = hash[at], np.zeros(m, np.uint64)
        for k in range(gram):
            key = key * textops.U64(0xC2B2AE3D27D4EB4F) + own[k : k + m]
        whole = np.flatnonzero(part[:m] == part[len(at) - m : len(at)])
        # equal hashes of other windows only keep words that could go
        key = textops.mix(key[whole] ^ textops.mix(part[whole].astype(np.uint64) + textops.U64(1)))
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        again = np.zeros(len(whole), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        live = np.zeros(len(at), bool)
        for k in range(gram):
            live[whole[again] + k] = True
        kept, old = at[live], part[live]
        fresh = np.ones(len(kept), bool)
        fresh[1:] = (np.diff(kept) > 1) | (old[1:] != old[:-1])
        first = np.flatnonzero(fresh)
        size = np.diff(np.append(first, len(kept)))
        long = size >= least
        done = long.all() and len(kept) == len(at)
        words = np.repeat(long, size)
        at, part = kept[words], np.repeat(np.arange(len(first)), size)[words]
        if done or not len(at):
            break
    first = np.flatnonzero(np.diff(part, prepend=-1))
    return at[first], at[first] + np.diff(np.append(first, len(at)))


class Finder:
    """Runs of consecutive texts."""

    def __init__(self, least: int = LEAST, factor: int = FACTOR):
        if factor < 3 or sure_window(least, factor) < 1:
            raise ValueError("runs of at least 3 periods and 3 words only")
        self.least, self.factor = least, factor

    def texts(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """(start, length, period) of each text's runs, by start, then period."""
        w = textops.words(texts)
        raw = w.data.tobytes()
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        for lo, hi in zip(*(x.tolist() for x in live_stretches(w.hash, w.row, self.least, self.factor))):
            ids: dict[bytes, int] = {}
            own = [ids.setdefault(raw[s:e], len(ids) + 1) for s, e in zip(w.start[lo:hi].tolist(), w.end[lo:hi].tolist())]
            row = int(w.row[lo])
            base = lo - int(w.first[row])
            out[row] += [(base + start, length, period) for start, length, period in stretch_runs(own, self.least, self.factor)]
        return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by a blank."""
    kept, at = [], 0
    for lo, hi in sorted((start + period, start + length) for start, length, period in runs):
        kept += words[at:lo]
        at = max(at, hi)
    return b" ".join(kept + words[at:])


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, factor: int = FACTOR) -> DataFrame:
    """(doc_id, runs, collapsed) per row: all runs by start, then period, and the text with one period left of each."""
    out = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])

    def run(batches):
        finder, arrow = Finder(least, factor), to_arrow_schema(out)
        for piece in textops.pieces(batches, "text"):
            texts = piece.column("text")
            runs = finder.texts(texts)
            found = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs]
            # bytes.split cuts at the same six blanks
            short = [collapsed((t or "").encode().split(), r).decode() for t, r in zip(texts.to_pylist(), runs)]
            yield record(arrow, piece.column("doc_id"), pa.array(found, arrow.field("runs").type), short)

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, out)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): the texts of one id in ten made periodic from some word on, by a rule on the id's checksum.

    With h = crc32 of the decimal id, unsigned, g = h / 10, and n words: where h % 10 = 0, word i >= a becomes word
    a + (i - a) % p, for a = g % n and p = 1 + (n - a) / (3 + g % 8), whole divisions. Other texts, those without
    words and those of a null id stay.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.floor(h / 10).alias("g"), (h % 10 == 0).alias("due"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    rows = rows.withColumn("words", F.when(F.col("due"), words))
    n, a, m, p = (F.col(c) for c in "namp")
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int")))
    rows = rows.withColumn("m", n - a).withColumn("p", (1 + F.floor(m / (3 + F.col("g") % 8))).cast("int"))
    block = F.slice("words", a + 1, p)
    periodic = F.concat(F.slice("words", F.lit(1), a), F.flatten(F.array_repeat(block, F.floor(m / p).cast("int"))), F.slice(block, F.lit(1), m % p))
    return rows.select("doc_id", F.when(n > 0, F.array_join(periodic, " ")).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The number of runs, the run of the greatest exponent, and digests of all runs and of the collapsed text."""
    better = lambda best, r: best["period"].isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start bigint, length bigint, period bigint>")
    best = F.aggregate("runs", none, lambda best, r: F.when(better(best, r), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    exponent = F.expr("1000 * best.length div best.period").alias("exponent_milli")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", exponent, "runs_sha256", "collapsed_sha256")
