"""BPE encoding and decoding as streaming transducers.

Encoding. From the merge list alone follows how many symbols beyond a token's end can still change it: the
*sufficient lookahead* (``Merges.lookahead``). A token is emitted once that many symbols behind it are known,
or its word has ended. The transducer's window is the longest token and the lookahead, so every window emits,
and a word of any length needs a window of fixed size. All distinct words of a piece go through it side by
side: a step merges the window of each word, one merge rank of each word per numpy round, emits what is
stable, and moves on to the first byte not emitted.

Why the lookahead suffices: a token t = a b is formed unless b is first taken by a rule (b, x) of a lower
rank, which needs x, which must be formed by still lower ranks. So reach(t) = max(reach(b), reach(a) - |b|,
max over those x of |x| + reach(x)), in rank order; a formed token stays final unless some rule (t, x)
takes it, which adds |x| + reach(x) over all rules of t. What is on the left is known already.

Decoding. ``Decoder`` turns ids into text piece by piece and holds only an incomplete character.

Null and empty texts have no ids and decode to the empty text. Memory is bounded by a piece of texts, or one text.
"""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow.llm import textops
from tallyflow.llm.pretokens import WordFile, byte_letters, pretokens, read_file
from tallyflow.llm.tasks import batch as record
from tallyflow.llm.tasks import give_back, map_arrow

#: bytes up to which the window of a word that goes on is doubled; fewer steps for long words
WINDOW = 512
PIECE = 2 << 20
NEVER = np.int32(2**31 - 1)


class Merges:
    """The merge list as arrays: base symbols, a hash table of pairs, and the sufficient lookahead."""

    def __init__(self, file: WordFile):
        letters = byte_letters()
        self.base = np.array([file.vocab[c] for c in letters], np.int32)
        self.last = np.array([file.vocab[c + file.suffix] for c in letters], np.int32)
        vocab = file.vocab
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in file.merges]
        self.merged = np.array([m for *_, m in pairs], np.int32)
        key = np.array([a << 32 | b for a, b, _ in pairs], np.int64)
        bits = max(4, int(4 * len(key)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NEVER, np.int32)
        todo, slot = np.arange(len(key)), self._slot(key)
        while len(todo):
            free = todo[self.keys[slot[todo]] < 0]
            put = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[put]], self.ranks[slot[put]] = key[put], put
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = slot[todo] + 1 & self.mask
        self.lookahead = self._lookahead(file)
        #: bytes of each token
        self.sizes = np.zeros(1 + max(*vocab.values(), *file.specials.values(), 0), np.int64)
        for token, i in vocab.items():
            self.sizes[i] = len(token.removesuffix(file.suffix))
        #: a window of this size emits a token, however the text goes on
        self.window = int(self.sizes.max()) + self.lookahead

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    @staticmethod
    def _lookahead(file: WordFile) -> int:
        size = lambda t: len(t.removesuffix(file.suffix))
        reach: dict[str, int] = {}
        takes: dict[str, int] = {}
        for a, b in file.merges:
            own = max(0, reach.get(b, 0), reach.get(a, 0) - size(b), takes.get(b, 0))
            reach[a + b] = max(own, reach.get(a + b, 0))
            takes[a] = max(takes.get(a, 0), size(b) + reach.get(b, 0))
        return 1 + max((max(reach.get(t, 0), takes.get(t, 0)) for t in reach.keys() | takes.keys()), default=0)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.ranks[slot], NEVER)
        todo = np.flatnonzero((found != key) & (found >= 0))
        while len(todo):
            slot[todo] = slot[todo] + 1 & self.mask
            found = self.keys[slot[todo]]
            out[todo] = np.where(found == key[todo], self.ranks[slot[todo]], NEVER)
            todo = todo[(found != key[todo]) & (found >= 0)]
        return out

    def apply(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges each word, whose symbols begin at ``first`` (with the total at the end), to its tokens."""
        words = len(first) - 1
        word = np.repeat(np.arange(words), np.diff(first))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(symbols), NEVER, np.int32)
        i = np.flatnonzero(word[1:] == word[:-1])
        rank[i] = self.rank(symbols[i], symbols[i + 1])
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(symbols)))
            busy = best < NEVER
            live = np.repeat(busy, counts)
            if not busy.all():
                done.append((word[~live], symbols[~live]))
                symbols, word, rank = symbols[live], word[live], rank[live]
                best, counts = best[busy], counts[busy]
            if not len(symbols):
                break
            hit = np.flatnonzero(rank == np.repeat(best, counts))
            # of overlapping equal pairs the left one merges
            run = np.append(True, np.diff(hit) != 1)
            head = np.flatnonzero(run)
            nth = np.arange(len(hit)) - np.repeat(head, np.diff(np.append(head, len(hit))))
            hit = hit[nth % 2 == 0]
            symbols[hit] = self.merged[rank[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            place = np.cumsum(keep) - 1
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            at = place[hit]
            near = np.concatenate([at, at[at > 0] - 1])
            rank[near] = NEVER
            near = near[near + 1 < len(symbols)]
            near = near[word[near] == word[near + 1]]
            rank[near] = self.rank(symbols[near], symbols[near + 1])
        if not done:
            return symbols, np.zeros(words + 1, np.int64)
        word, out = np.concatenate([w for w, _ in done]), np.concatenate([s for _, s in done])
        order = np.argsort(word, kind="stable")
        return out[order], np.searchsorted(word[order], np.arange(words + 1))

    def step(self, data: np.ndarray, at: np.ndarray, end: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One step of the transducer on each word, of which ``at`` to ``end`` is left: emitted tokens, their words, and the new ``at``."""
        size = np.minimum(end - at, window)
        ended = at + size == end
        first = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(first[-1]) - np.repeat(first[:-1], size) + np.repeat(at, size)
        symbols = self.base[data[place]]
        tail = first[1:][ended] - 1
        symbols[tail] = self.last[data[place[tail]]]
        tokens, bounds = self.apply(symbols, first)
        word = np.repeat(np.arange(len(at)), np.diff(bounds))
        ends = np.cumsum(self.sizes[tokens]) - first[word]
        stable = ended[word] | (ends <= size[word] - self.lookahead)
        tokens, word = tokens[stable], word[stable]
        return tokens, word, at + np.bincount(word, self.sizes[tokens], len(at)).astype(np.int64)

    def steps(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(tokens, their words) of each step until all words have ended; a word's tokens come in order."""
        left = np.flatnonzero(end > start)
        at, end = start[left], end[left]
        window = np.full(len(left), self.window)
        while len(left):
            tokens, word, at = self.step(data, at, end, window)
            yield tokens, left[word]
            on = at < end
            left, at, end = left[on], at[on], end[on]
            window = np.minimum(2 * window[on], max(WINDOW, self.window))

    def stream(self, data: np.ndarray) -> Iterator[np.ndarray]:
        """Tokens of one word of any length, emitted as soon as they are stable."""
        for tokens, _ in self.steps(data, np.array([0]), np.array([len(data)])):
            yield tokens


class Encoder:
    """Ids of whole texts."""

    def __init__(self, path: str):
        self.file = read_file(path)
        self.merges = Merges(self.file)

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the given words, and where each word's begin."""
        parts = list(self.merges.steps(data, start, end))
        tokens = np.concatenate([t for t, _ in parts]) if parts else np.zeros(0, np.int32)
        word = np.concatenate([w for _, w in parts]) if parts else np.zeros(0, np.int64)
        if len(parts) > 1:
            order = np.argsort(word, kind="stable")
            tokens, word = tokens[order], word[order]
        return tokens, np.searchsorted(word, np.arange(len(start) + 1))

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin; each distinct word is merged once."""
        p = pretokens(texts, self.file.specials)
        if not len(p.hash):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        return gather(p, *self._distinct(p), len(texts))

    def _distinct(self, p):
        plain = p.special < 0
        hash = np.where(plain, p.hash, p.special.astype(np.uint64))
        _, at, word = np.unique(hash, return_index=True, return_inverse=True)
        tokens, bounds = self.words(p.data, p.start[at], p.end[at])
        for k in np.flatnonzero(~plain[at]):  # a special token is one id, whatever its placeholder gave
            tokens[bounds[k]] = p.special[at[k]]
        return tokens, bounds, word.ravel()


def gather(p, tokens: np.ndarray, bounds: np.ndarray, word: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of every pre-token, from those of the distinct ones."""
    n = np.diff(bounds)[word]
    to = np.concatenate([[0], np.cumsum(n)])
    ids = tokens[np.arange(to[-1]) - np.repeat(to[:-1], n) + np.repeat(bounds[word], n)]
    return ids, to[np.searchsorted(p.row, np.arange(rows + 1))]


class Decoder:
    """Text of ids that come piece by piece.

    Files without a decoder step give the tokens as they are written, with blanks between them (``plain``).
    Otherwise letters become bytes, word ends become blanks, and the bytes go through a UTF-8 state machine.
    """

    def __init__(self, file: WordFile, plain: bool = True):
        names = {i: t for t, i in (file.vocab | file.specials).items()}
        if plain:
            self.table = {i: (" " + t).encode() for i, t in names.items()}
        else:
            byte = {c: b for b, c in enumerate(byte_letters())}
            ends = file.suffix
            special = set(file.specials.values())
            self.table = {i: t.encode() if i in special else bytes(byte[c] for c in t.removesuffix(ends)) + b" " * t.endswith(ends) for i, t in names.items()}
        self.plain, self.started, self.state = plain, False, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray, last: bool = False) -> str:
        """The text that the next ids complete; with ``last``, the rest, and the machine starts again."""
        raw = b"".join(map(self.table.__getitem__, ids.tolist()))
        if self.plain and raw and not self.started:
            raw, self.started = raw[1:], True
        text = self.state.decode(raw, last)
        if last:
            self.started = False
            self.state.reset()
        return text


RESULT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
#: ids decoded at once
CHUNK = 1 << 16


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) per document: its token ids as an array."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        encoder, arrow = Encoder(path), to_arrow_schema(schema)
        for piece in textops.pieces(batches, "text", PIECE):
            ids, at = encoder.texts(piece.column("text"))
            yield record(arrow, piece.column("id"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())))

    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, schema)


def decoded(tokens: DataFrame, path: str, plain: bool = True) -> DataFrame:
    """(id, text) per row of ``encoded``."""
    schema = T.StructType([tokens.schema["id"], T.StructField("text", T.StringType())])

    def run(batches):
        decoder, arrow = Decoder(read_file(path), plain), to_arrow_schema(schema)
        for b in batches:
            texts = [decoder.feed(np.array(x or (), np.int64), last=True) for x in b.column("ids").to_pylist()]
            yield record(arrow, b.column("id"), texts)

    return map_arrow(tokens.select("id", "ids"), run, schema)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Per document the number of ids, the digest of the ids and that of the text decoded from them, in one pass.

    With ``keep``, the columns of ``docs`` come back too, under their own names, then n_tokens, ids_sha256 and decoded_sha256.
    """
    if keep:
        clash = {"n_tokens", "ids_sha256", "decoded_sha256"}
        docs = docs.select([c for c in docs.columns if c not in clash])
        schema = T.StructType([*docs.schema.fields, *RESULT.fields[1:]])
        rows, text = docs, text_col
    else:
        schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *RESULT.fields[1:]])
        rows, text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text"

    def run(batches):
        encoder, arrow = Encoder(path), to_arrow_schema(schema)
        decoder = Decoder(encoder.file)
        for piece in textops.pieces(batches, text, PIECE):
            ids, at = encoder.texts(piece.column(text))
            wide, digests, back = ids.astype("<u4"), [], []
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
                digests.append(hashlib.sha256(wide[lo:hi]).hexdigest())
                out = hashlib.sha256()
                for k in range(lo, max(hi, lo + 1), CHUNK):
                    out.update(decoder.feed(ids[k : min(hi, k + CHUNK)], last=k + CHUNK >= hi).encode())
                back.append(out.hexdigest())
            own = piece.columns if keep else [piece.column("doc_id")]
            yield record(arrow, *own, np.diff(at), digests, back)
            del piece, ids, at, wide, digests, back, own
            give_back()

    return map_arrow(rows, run, schema)
