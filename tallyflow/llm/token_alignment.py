"""Two tokenizers' ids of the same texts, aligned by the bytes they cover.

Byte offsets at which tokens of both end cut a text into groups; the tokens that end there are linked. Texts
are told apart by their full bytes: one shuffle groups them by the text itself, counted on the map side, so
copies meet in one row and a text that a third of all rows share is one row a task before it. Each distinct
text is tokenised once (``distinct_tokens``, a written table), and link counts are weighted by its copies.

Tokens linked end at one byte, so one's bytes are a suffix of the other's. ``Vocabularies`` lists all such
pairs of ids: at most the bytes of all vocabulary entries of both files together, some hundred thousand,
whatever the corpus. So a task counts links in one array of that length, and the counts of all pairs are
proved small enough to broadcast.

Measures meet the documents again by the SHA-256 of the text. Texts of more than one in ``HOT`` rows, fewer
than ``HOT``, are broadcast; the others are joined.

Null and empty texts, and texts whose tokens do not give back a blank and the text (a model's blank sign in
it), have no tokens: zeros and an empty digest. Rows of a null or repeated id are rows like any other. A very
long text is handled alone. Empty tables give empty results. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow.llm import textops
from tallyflow.llm.pieces import BLANK
from tallyflow.llm.pretokens import byte_letters
from tallyflow.llm.tasks import batch as record
from tallyflow.llm.tasks import map_arrow
from tallyflow.sinks.scratch import stored

HOT = 2000
PIECE = 1 << 18

#: the pattern and the settings of byte-level files (fixed values of the format)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}

INTS = T.ArrayType(T.IntegerType())
TOKENS = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("copies", T.LongType()), T.StructField("a", INTS), T.StructField("b", INTS)])
PAIR_COUNTS = T.StructType([T.StructField("pair", T.IntegerType()), T.StructField("n", T.LongType())])
GROUPS = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("groups", T.ArrayType(T.StructType([T.StructField("a", INTS), T.StructField("b", INTS)])))])
MEASURES = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("copies", T.LongType()), *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
    T.StructField("groups_sha256", T.StringType()),
])


class Files:
    """Two tokenizer files as they encode: ids of texts, and the bytes of each id.

    The first is read by the tokenizers library. Where all its entries merge from their own bytes to one token
    (``proved``), merging by the rank of the joined bytes does the same on every text: two tokens x, y that stand
    for an entry t can only be neighbours if merging t alone comes to x, y, and then x, y is t's own pair. So
    a byte-level file with the usual pattern is then merged by tiktoken, with the file's own entries as ranks.
    """

    def __init__(self, a_path: str, b_path: str, proved: bool | None = None):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        a_file, self.b_file = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        a_file.encode_special_tokens = True
        byte = {c: n for n, c in enumerate(byte_letters())}
        added = {t.content for t in a_file.get_added_tokens_decoder().values()}
        vocab = a_file.get_vocab(with_added_tokens=True)
        self.a = [b""] * (1 + max(vocab.values()))
        for t, i in vocab.items():
            self.a[i] = t.encode() if t in added else bytes(byte[c] for c in t)
        sp = self.b_file
        self.b = [bytes([int(t[3:5], 16)]) if sp.is_byte(i) else t.replace(BLANK, " ").encode() for i in range(sp.get_piece_size()) for t in [sp.id_to_piece(i)]]
        if proved is None:
            proved = self._proved(a_path, a_file, {t: i for t, i in vocab.items() if t not in added})
        self.proved = proved
        if proved:
            from tiktoken import Encoding

            ranks = {self.a[i]: i for t, i in vocab.items() if t not in added}
            encoding = Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._a_ids = lambda text: encoding.encode_to_numpy(text, disallowed_special=())
        else:
            self._a_ids = lambda text: np.array(a_file.encode(text, add_special_tokens=False).ids, np.uint32)

    @staticmethod
    def _proved(path: str, file, vocab: dict[str, int]) -> bool:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        made = [vocab[a + b] for a, b in pairs]
        plain = spec["normalizer"] is None and spec["pre_tokenizer"] | {"trim_offsets": True} == BYTE_LEVEL and not spec["model"].get("ignore_merges")
        in_order = all(x < y for x, y in zip(made, made[1:])) and len(made) + 256 == len(vocab)
        return plain and in_order and all([t.id for t in file.model.tokenize(name)] == [i] for name, i in vocab.items())

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of each text by both files; both empty where one does not give back a blank and the text."""
        spaced = [(" " + t) if t else "" for t in texts]
        each = [self._a_ids(t) for t in spaced]
        a, a_first = np.concatenate([*each, np.zeros(0, np.uint32)]).astype(np.int32), np.cumsum([0, *map(len, each)])
        found = pa.array(self.b_file.encode(texts, num_threads=1), pa.list_(pa.int32()))
        b, b_first = found.values.to_numpy(), found.offsets.to_numpy()
        raw = [t.encode() for t in spaced]
        want, first = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
        good = _gives(self.a, a, a_first, want, first) & _gives(self.b, b, b_first, want, first)
        return tuple(_kept(x, at, good) for x, at in ((a, a_first), (b, b_first)))


def _gives(entries: list[bytes], ids: np.ndarray, at: np.ndarray, want: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether the bytes of each text's ids are the bytes wanted of it."""
    size, flat = np.array(list(map(len, entries)), np.int64), np.frombuffer(b"".join(entries), np.uint8)
    start, own = np.cumsum(size) - size, size[ids]
    end = np.append(0, np.cumsum(own))
    same = np.diff(end[at]) == np.diff(first)
    if same.all():
        got = flat[np.arange(end[-1]) - np.repeat(end[:-1] - start[ids], own)]
        return np.diff(np.append(0, np.cumsum(got != want))[first]) == 0
    for k in np.flatnonzero(same):
        same[k] = b"".join(map(entries.__getitem__, ids[at[k] : at[k + 1]].tolist())) == want[first[k] : first[k + 1]].tobytes()
    return same


def _kept(ids: np.ndarray, at: np.ndarray, good: np.ndarray) -> pa.ListArray:
    n = np.diff(at)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n * good)), pa.int32()), pa.array(ids[np.repeat(good, n)], pa.int32()))


class Vocabularies:
    """Sizes in bytes of all ids of both files, and the pairs of ids that can be linked."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (a, b))
        key = set()
        for one, other, place in ((a, b, lambda i, j: i * len(b) + j), (b, a, lambda j, i: i * len(b) + j)):
            by_bytes: dict[bytes, list[int]] = {}
            for i, t in enumerate(other):
                by_bytes.setdefault(t, []).append(i)
            for i, t in enumerate(one):
                for k in range(len(t)):
                    key.update(place(i, j) for j in by_bytes.get(t[k:], ()))
        #: all pairs that can be linked, as a * (entries of b) + b
        self.pairs = np.array(sorted(key), np.int64)
        # and where each is, by its hash, or in one of the places behind that
        bits = max(4, int(8 * len(self.pairs)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._key, self._number = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        todo, place = np.arange(len(self.pairs)), self._place(self.pairs)
        while len(todo):
            free = todo[self._key[place[todo]] < 0]
            put = free[np.unique(place[free], return_index=True)[1]]
            self._key[place[put]], self._number[place[put]] = self.pairs[put], put
            todo = np.setdiff1d(todo, put, assume_unique=True)
            place[todo] = place[todo] + 1 & self._mask

    def _place(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each pair of ids, all of which can be linked."""
        key = a.astype(np.int64) * len(self.b_size) + b
        place = self._place(key)
        out = self._number[place]
        todo = np.flatnonzero(self._key[place] != key)
        while len(todo):
            place[todo] = place[todo] + 1 & self._mask
            out[todo] = self._number[place[todo]]
            todo = todo[self._key[place[todo]] != key[todo]]
        return out

    def marks(self) -> np.ndarray:
        """Each id as written within a group and at the end of its side, those of the first file first; filled up with zeros."""
        own = [s % i for i in range(len(self.a_size)) for s in (b"%d,", b"%d|")] + [s % i for i in range(len(self.b_size)) for s in (b"%d,", b"%d;")]
        wide = np.array(own)
        return wide.view(np.uint8).reshape(len(own), -1)


@dataclass
class Aligned:
    """Ids of consecutive texts, the last token of each group on both sides, and where each text begins."""

    a: np.ndarray
    b: np.ndarray
    a_last: np.ndarray
    b_last: np.ndarray
    a_first: np.ndarray
    b_first: np.ndarray

    def groups(self) -> np.ndarray:
        """The first group of each text, and their total."""
        return np.append(0, np.cumsum(self.a_last))[self.a_first]

    def pairs(self, v: Vocabularies) -> np.ndarray:
        """The number of each link's pair, in text order."""
        return v.number(self.a[self.a_last], self.b[self.b_last])

    def written(self, marks: np.ndarray, n_a: int) -> list[bytes]:
        """Each text as ``a1,a2|b1;a3|b2,b3``; ``marks`` of a vocabulary whose first file has ``n_a`` ids."""
        a_end, b_end = np.append(0, np.flatnonzero(self.a_last) + 1), np.append(0, np.flatnonzero(self.b_last) + 1)
        a_group, b_group = np.cumsum(self.a_last) - self.a_last, np.cumsum(self.b_last) - self.b_last
        at = np.empty(len(self.a) + len(self.b), np.int32)
        at[np.arange(len(self.a)) + b_end[a_group]] = 2 * self.a + self.a_last
        at[np.arange(len(self.b)) + a_end[b_group + 1]] = 2 * (n_a + self.b) + self.b_last
        text = marks[at]
        used = text != 0
        first = np.append(0, np.cumsum(used.sum(1)))[self.a_first + self.b_first].tolist()
        raw = text[used].tobytes()
        return [raw[lo : max(lo, hi - 1)] for lo, hi in zip(first[:-1], first[1:])]


def aligned(v: Vocabularies, a: pa.Array, b: pa.Array) -> Aligned:
    """Groups of texts from their ids, which cover the same bytes on both sides."""
    (a, a_first), (b, b_first) = ((x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy().astype(np.int64)) for x in (a, b))
    a, b = a[a_first[0] : a_first[-1]], b[b_first[0] : b_first[-1]]
    a_end, b_end = np.cumsum(v.a_size[a]), np.cumsum(v.b_size[b])
    size = int(a_end[-1]) + 1 if len(a) else 1
    on_a, on_b = np.zeros(size, bool), np.zeros(size, bool)
    on_a[a_end] = on_b[b_end] = True
    return Aligned(a, b, on_b[a_end], on_a[b_end], a_first - a_first[0], b_first - b_first[0])


def _batches(batches, limit: int = 1 << 17):
    """Batches cut so that their texts have at most ``limit`` ids of the first file together, or are one text."""
    for b in batches:
        first, at = b.column("a").offsets.to_numpy(), 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(first, first[at] + limit, side="right")) - 1)
            yield b.slice(at, to - at)
            at = to


class Alignment:
    """Tokens, pair counts and measures of a table of documents."""

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"):
        files = Files(a_path, b_path)
        self.paths, self.proved = (a_path, b_path), files.proved
        self.vocabularies = Vocabularies(files.a, files.b)
        self.spark = docs.sparkSession
        self._sent = self.spark.sparkContext.broadcast(self.vocabularies)
        self.docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        self._tokens = self._pairs = None

    def distinct_tokens(self) -> DataFrame:
        """(key, copies, a, b) per distinct text that is not empty: its SHA-256, its rows, its ids by both files."""
        if self._tokens is None:
            paths, proved = self.paths, self.proved

            def run(batches):
                files, arrow = Files(*paths, proved), to_arrow_schema(TOKENS)
                for piece in textops.pieces(batches, "text", PIECE):
                    a, b = files.encode(piece.column("text").to_pylist())
                    yield record(arrow, piece.column("key"), piece.column("copies"), a, b)

            once = self.docs.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
            self._tokens = stored(map_arrow(once.select(F.unhex(F.sha2("text", 256)).alias("key"), "copies", "text"), run, TOKENS), "distinct-tokens")
        return self._tokens

    def groups(self) -> DataFrame:
        """(key, groups) per distinct text: the ids of each group on both sides, in text order."""
        sent = self._sent

        def run(batches):
            v, arrow = sent.value, to_arrow_schema(GROUPS)
            ints = lambda ids, ends: pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32()))
            for piece in _batches(batches):
                x = aligned(v, piece.column("a"), piece.column("b"))
                both = pa.StructArray.from_arrays([ints(x.a, np.flatnonzero(x.a_last) + 1), ints(x.b, np.flatnonzero(x.b_last) + 1)], ["a", "b"])
                yield record(arrow, piece.column("key"), pa.ListArray.from_arrays(pa.array(x.groups(), pa.int32()), both).cast(arrow.field("groups").type))

        return map_arrow(self.distinct_tokens().select("key", "a", "b"), run, GROUPS)

    def _pair_counts(self) -> DataFrame:
        if self._pairs is None:
            sent = self._sent

            def run(batches):
                v = sent.value
                total = np.zeros(len(v.pairs), np.int64)
                for piece in _batches(batches):
                    x = aligned(v, piece.column("a"), piece.column("b"))
                    copies, pair = np.repeat(piece.column("copies").to_numpy(), np.diff(x.groups())), x.pairs(v)
                    many = copies > 1
                    total += np.bincount(pair[~many], minlength=len(total))
                    np.add.at(total, pair[many], copies[many])
                used = np.flatnonzero(total)
                yield record(to_arrow_schema(PAIR_COUNTS), used, total[used])

            parts = map_arrow(self.distinct_tokens().select("copies", "a", "b"), run, PAIR_COUNTS)
            self._pairs = stored(parts.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
        return self._pairs

    def pair_counts(self) -> DataFrame:
        """(a, b, n): how many links of all documents hold a pair of ids linked."""
        pairs, n_b = self.vocabularies.pairs, len(self.vocabularies.b_size)
        names = self.spark.createDataFrame(pa.table({"pair": pa.array(np.arange(len(pairs)), pa.int32()), "a": pa.array(pairs // n_b, pa.int32()), "b": pa.array(pairs % n_b, pa.int32())}))
        return self._pair_counts().join(F.broadcast(names), "pair").select("a", "b", "n")

    def measures(self) -> DataFrame:
        """(key, copies, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per distinct text."""
        sent, v = self._sent, self.vocabularies
        counted = self._pair_counts().toArrow()  # at most one row per pair of the vocabularies
        n = np.zeros(len(v.pairs), np.int64)
        n[counted["pair"].to_numpy()] = counted["n"].to_numpy()
        b, highest = v.pairs % len(v.b_size), np.zeros(len(v.b_size), np.int64)
        np.maximum.at(highest, b, n)
        known = self.spark.sparkContext.broadcast((n, n == highest[b]))

        def run(batches):
            v, arrow = sent.value, to_arrow_schema(MEASURES)
            (n, best), marks = known.value, v.marks()
            for piece in _batches(batches):
                x = aligned(v, piece.column("a"), piece.column("b"))
                pair, first = x.pairs(v), x.groups()
                sums = lambda values: np.diff(np.append(0, np.cumsum(values))[first])
                digests = [hashlib.sha256(t).hexdigest() if t else "" for t in x.written(marks, len(v.a_size))]
                links = np.diff(first)
                yield record(arrow, piece.column("key"), piece.column("copies"), np.diff(x.a_first), np.diff(x.b_first), links, links, sums(best[pair].astype(np.int64)), sums(n[pair]), digests)

        return map_arrow(self.distinct_tokens(), run, MEASURES)

    def per_document(self) -> DataFrame:
        """The measures of every row's text, with its doc_id."""
        found = stored(self.measures(), "alignment")
        columns = [f.name for f in MEASURES.fields[2:]]
        keys = stored(self.docs.select("doc_id", F.when(F.col("text") != "", F.unhex(F.sha2("text", 256))).alias("key")), "document-keys")
        rows = found.agg(F.sum("copies")).first()[0] or 0
        is_hot = F.col("copies") * HOT > rows
        hot, others = F.broadcast(found.where(is_hot)), found.where(~is_hot)
        some = keys.where("key is not null")
        none = [F.lit("" if c == "groups_sha256" else 0).cast(MEASURES[c].dataType).alias(c) for c in columns]
        parts = [
            keys.where("key is null").select("doc_id", *none),
            some.join(hot, "key").select("doc_id", *columns),
            some.join(hot, "key", "left_anti").join(others, "key").select("doc_id", *columns),
        ]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])
