"""An interpolated modified Kneser-Ney model of n-grams, of order three by default, counted in Spark and mapped into memory by the workers.

Counting. Tasks combine counts before they leave, packed by bucket of a hash: common words as ranks (a list of
fewer than ``COMMON``), other words as hashes, in compressed byte planes. Each bucket is merged by one task, which
writes a file of sorted hash arrays: words with counts; n-grams with counts, and their contexts with totals and
the numbers of n-grams seen once, twice and more often. Only words and n-grams of the full order are counted from
texts. The n-grams of each lower order come from the merged buckets of the next: their count is the number of
different words before them, or if they start with the begin, where nothing else can stand before, the count
itself. The number of buckets follows the size of the corpus, so a bucket has a bounded size; a context with more
than its share of all words (at most ``4 * buckets`` of each length) is spread over all buckets by the hash of
the n-gram, and its parts are added up afterwards. Such a context of several words has only such words, so only
those are counted to find it.

Files are written under a name of the task's attempt, and only names that Spark has committed are used, so a
lost executor's files are never read. They lie in the scratch folder; a worker maps those it needs, from a
mounted folder in place, else from a copy that lasts as long as the worker.

Scoring. p(w | u v) = max(c(uvw) - D, 0) / c(uv) + gamma(uv) p(w | v), and so on down to 1 / (V + 1), with
modified Kneser-Ney discounts from each order's counts of counts; a context never seen leaves it to the next.

Words are lower-cased, one end is counted after each text and begins stand before it. Null and empty texts
are one end. Without training texts every p is 1 / (V + 1) = 1. Repeated rows count each. Extra columns are
not read.
"""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow.llm import textops
from tallyflow.llm.tasks import batch as record
from tallyflow.llm.tasks import give_back, map_arrow, open_uri
from tallyflow.llm.toxicity import held_out
from tallyflow.sinks.scratch import scratch_path

#: words of an n-gram
ORDER = 3
#: bytes of text per bucket
BUCKET_BYTES = 12 << 20
#: distinct keys a task holds before it sends them, and rows of a bucket that are merged at once
HELD, MERGED_AT = 1_200_000, 2_500_000
#: bytes of text scored at once, and of mapped files that a worker keeps
SCORED, MAPPED = 4 << 20, 256 << 20
#: n-grams that are moved and words whose ranks are looked up at once
MOVED = 1 << 18
#: words sent as ranks, each with more than one in so many of all words
COMMON = 1 << 23

U64 = np.uint64
BEGIN, END = U64(0xB5297A4D3F84D5B5), U64(0x1B56C4E9F1D2A7C3)
UNRANKED = 0xFFFFFFFF

PACKED = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("data", T.BinaryType())])
#: what a merged bucket is: its file, sizes, counts of counts, the next order's counts, and parts of hot contexts
MERGED = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("file", T.StringType()), T.StructField("keys", T.LongType()),
    T.StructField("total", T.LongType()), T.StructField("of", T.ArrayType(T.LongType())),
    T.StructField("hot", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("next", T.ArrayType(PACKED)),
])


def _bucket(hash: np.ndarray, buckets: int) -> np.ndarray:
    return ((hash >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def _key(grams: np.ndarray) -> np.ndarray:
    """One hash for each row of words; that of one word is its own."""
    hash = grams[:, 0]
    for k in range(1, grams.shape[1]):
        hash = textops.mix(hash * U64(0xC2B2AE3D27D4EB4F) + grams[:, k])
    return hash


def _spot(among: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values in a sorted array, and whether they are there."""
    if not len(among):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    place = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return place, among[place] == values


def _gram_bucket(grams: np.ndarray, hash: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """N-grams lie with their context, those of hot contexts and single words anywhere."""
    if grams.shape[1] == 1:
        return _bucket(hash, buckets)
    context = _key(grams[:, :-1])
    return _bucket(np.where(_spot(hot, context)[1], hash, textops.mix(context)), buckets)


def _tokens(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of word hashes that end in each word, with an end after each text, and the rows."""
    w = textops.words(texts, textops.SPACED, textops.LOWER)
    rows = len(texts)
    out = np.insert(w.hash, w.first[1:], END)
    first = w.first + np.arange(rows + 1)
    row = np.repeat(np.arange(rows), np.diff(first))
    inside = np.arange(len(out)) - first[:-1][row]
    grams = np.full((len(out), order), BEGIN)
    grams[:, -1] = out
    for k in range(1, order):
        own = np.flatnonzero(inside >= k)
        grams[own, -1 - k] = out[own - k]
    return grams, row


def _distinct(hash: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct value stands, in their order, and the number of each value's."""
    order = np.argsort(hash)
    there = hash[order]
    new = np.append(True, there[1:] != there[:-1])[: len(there)]
    inverse = np.empty(len(hash), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return order[new], inverse


def _counted(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams with summed counts and hashes, in the order of the hashes."""
    hash = _key(grams)
    order = np.argsort(hash)
    hash = hash[order]
    new = np.flatnonzero(np.append(True, hash[1:] != hash[:-1])[: len(hash)])
    return grams.take(order[new], axis=0), np.add.reduceat(counts[order], new) if len(new) else counts[:0], hash[new]


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``_counted`` gives for all parts together. It empties the list, so that each part goes as soon as its n-grams are taken."""
    hash = np.concatenate([_key(g) for g, _ in parts])
    order = np.argsort(hash)
    hash = hash[order]
    new = np.flatnonzero(np.append(True, hash[1:] != hash[:-1])[: len(hash)])
    hash = hash[new]
    counts = np.concatenate([n for _, n in parts])
    held = [g for g, _ in parts]
    parts.clear()
    counts = counts[order]
    order = order[new]
    counts = np.add.reduceat(counts, new) if len(new) else counts
    grams, lo = np.empty((len(order), held[0].shape[1]), U64), 0
    while held:
        some = [held.pop(0)]
        while held and sum(map(len, some)) + len(held[0]) <= MOVED:
            some.append(held.pop(0))
        own = np.concatenate(some) if len(some) > 1 else some[0]
        del some
        for at in range(lo, lo + len(own), MOVED):
            here = np.flatnonzero((order >= at) & (order < min(at + MOVED, lo + len(own))))
            grams[here] = own.take(order[here] - lo, axis=0)
        lo += len(own)
        del own
    return grams, counts, hash


def _planes(values: np.ndarray) -> bytes:
    """First all lowest bytes, then the next, and so on: upper bytes are mostly zeros, which compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unplaned(data: np.ndarray, kind: str) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


class Common:
    """The most frequent words, which are sent as ranks."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        self.words = words[np.argsort(-counts, kind="stable")]
        self.rank = np.argsort(self.words).astype(np.uint32)
        self.sorted = self.words[self.rank]
        self.rest = U64(64 - max(1, len(words).bit_length()))
        self.first = np.searchsorted(self.sorted >> self.rest, np.arange((1 << 64 - int(self.rest)) + 1, dtype=U64)).astype(np.uint32)

    def _ranks(self, words: np.ndarray) -> np.ndarray:
        """Ranks of words, some at a time: what a look-up holds is many times its words."""
        out = np.empty(len(words), "<u4")
        for at in range(0, len(words), MOVED):
            out[at : at + MOVED] = self._ranks_of(words[at : at + MOVED])
        return out

    def _ranks_of(self, words: np.ndarray) -> np.ndarray:
        """Ranks of words, found by their upper bits, of which one word or so has the same."""
        out = np.full(len(words), UNRANKED, "<u4")
        upper = words >> self.rest
        at = self.first[upper]
        todo = np.flatnonzero(at < self.first[upper + U64(1)])
        at, end, own = at[todo], self.first[upper[todo] + U64(1)], words[todo]
        while len(todo):
            there = self.sorted[at]
            same = there == own
            out[todo[same]] = self.rank[at[same]]
            more = np.flatnonzero((there < own) & (at + 1 < end))
            todo, at, end, own = todo[more], at[more] + 1, end[more], own[more]
        return out

    def pack(self, grams: np.ndarray, bucket: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """Bucket numbers, and one compressed packet of n-grams and counts for each."""
        ranks = self._ranks(grams.ravel()).reshape(grams.shape)
        order = self._order(ranks, bucket)
        names, at = np.unique(bucket[order], return_index=True)
        codec, packets = pa.Codec("zstd", compression_level=1), []
        for own in np.split(order, at[1:]) if len(names) else []:
            columns = np.ascontiguousarray(ranks.take(own, axis=0).T)
            other = np.ascontiguousarray(grams.take(own, axis=0).T)[columns == UNRANKED]
            raw = np.int64(len(own)).tobytes() + b"".join(_planes(c) for c in columns) + _planes(counts[own].astype(COUNT)) + other.astype("<u8").tobytes()
            packets.append(np.int64(len(raw)).tobytes() + codec.compress(raw, asbytes=True))
        return names.astype(np.int32), packets

    @staticmethod
    def _order(ranks: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """By bucket, then by the first two words."""
        if not len(bucket) or bucket.max() >= 1 << 16 or ranks.shape[1] < 2:
            return np.lexsort([*ranks[:, :2].T[::-1], bucket])
        key = bucket.astype(U64)
        for k in (0, 1):
            key <<= U64(24)
            key |= np.minimum(ranks[:, k], (1 << 24) - 1)  # ranks are far under that
        return np.argsort(key)

    def unpack(self, packet: bytes, order: int) -> tuple[np.ndarray, np.ndarray]:
        size = int(np.frombuffer(packet, "<i8", 1)[0])
        raw = np.frombuffer(pa.Codec("zstd").decompress(packet[8:], size), np.uint8)
        n, at, columns = int(raw[:8].view("<i8")[0]), 8, []
        for _ in range(order):
            columns.append(_unplaned(raw[at : at + 4 * n], "<u4"))
            at += 4 * n
        wide = np.dtype(COUNT).itemsize * n
        counts = _unplaned(raw[at : at + wide], COUNT).astype(np.int64)
        ranks = np.stack(columns)
        words, other = np.empty(ranks.shape, U64), ranks == UNRANKED
        words[~other] = self.words.take(ranks[~other])
        words[other] = np.frombuffer(raw[at + wide :].tobytes(), "<u8")
        return np.ascontiguousarray(words.T), counts


def _count(order: int, hot: np.ndarray, buckets: int, shared: Broadcast):
    def run(batches):
        arrow, held, size = to_arrow_schema(PACKED), [], 0

        def flush():
            grams, counts, hash = _summed(held)
            bucket = _gram_bucket(grams, hash, hot, buckets)
            del hash
            return record(arrow, *shared.value.pack(grams, bucket, counts))

        for piece in textops.pieces(batches, "text"):
            grams, _ = _tokens(piece.column("text"), order)
            held.append(_counted(grams, np.ones(len(grams), np.int64))[:2])
            del grams
            size += len(held[-1][0])
            if size > HELD:
                yield flush()
                size = 0
                give_back()
        if held:
            yield flush()
        give_back()

    return run


def _frequent_contexts(order: int, hot: np.ndarray):
    """Counts of contexts of two words or more that have only hot words."""

    def run(batches):
        arrow, held, size = pa.schema([("words", pa.int32()), ("w", pa.int64()), ("n", pa.int64())]), {}, 0

        def flush(k):
            _, counts, hash = _summed(held[k])
            return record(arrow, np.full(len(hash), k, np.int32), hash.view(np.int64), counts)

        for piece in textops.pieces(batches, "text"):
            grams, _ = _tokens(piece.column("text"), order)
            is_hot = _spot(hot, grams.ravel())[1].reshape(grams.shape)
            for k in range(2, order):
                own = grams[is_hot[:, -1 - k : -1].all(1), -1 - k : -1]
                held.setdefault(k, []).append(_counted(own, np.ones(len(own), np.int64))[:2])
                size += len(held[k][-1][0])
            if size > HELD:
                yield from (flush(k) for k in held)
                held, size = {}, 0
                give_back()
        yield from (flush(k) for k in held)
        give_back()

    return run


#: how counts are sent and stored; stored ones of over 254 are in a table of their own, by place
COUNT = "<u8"
KEYS, COUNTS = ["<u4", "<u4", "<u2"], ["u1", "<u8", "<u8"]


def _count_arrays(counts: np.ndarray) -> list[np.ndarray]:
    large = np.flatnonzero(counts > 254)
    return [np.minimum(counts, 255, out=np.empty(len(counts), "u1"), casting="unsafe"), large, counts[large]]


def _count_values(arrays: list[np.ndarray], place: np.ndarray) -> np.ndarray:
    """Counts at the given places."""
    small, at, large = arrays
    counts = small[place].astype(np.int64)
    over = counts == 255
    if over.any():
        counts[over] = large[np.searchsorted(at, place[over])]
    return counts


def remove(uri: str) -> None:
    """Deletes a scratch folder of this job."""
    system, path = open_uri(uri)
    system.delete_dir(path)


#: low bits of a key that are stored; the others follow from its place
REST = U64(48)
#: arrays of a file: places of keys by upper bits, their lower bits in two parts, counts, and the same for contexts with their four totals
ARRAYS = [*KEYS, *COUNTS, *KEYS, *COUNTS]


def _key_arrays(hash: np.ndarray) -> list[np.ndarray]:
    first = np.searchsorted(hash >> REST, np.arange((1 << 16) + 1, dtype=U64))
    return [first.astype("<u4"), (hash >> U64(16)).astype("<u4"), hash.astype("<u2")]


def _keys(first: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """All keys of sorted arrays."""
    return np.repeat(np.arange(1 << 16, dtype=U64), np.diff(first.astype(np.int64))) << REST | high.astype(U64) << U64(16) | low


def _place(first: np.ndarray, high: np.ndarray, low: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Places of keys in sorted arrays, -1 where they are not: a guess, then steps to the place."""
    upper = (key >> REST).astype(np.int64)
    start, end = first[upper].astype(np.int64), first[upper + 1].astype(np.int64)
    rest, last = (key >> U64(16)).astype(np.uint32), (key & U64(0xFFFF)).astype(np.uint16)
    if not len(high):
        return np.full(len(key), -1)
    # keys are hashes, so a key is near the share of its place that its larger part says
    lo, most = start + (rest * (end - start) >> 32), len(high) - 1
    small = high[np.minimum(lo, most)] < rest
    todo = np.flatnonzero(small & (lo < end))
    while len(todo):
        at = lo[todo] + 1
        lo[todo] = at
        todo = todo[(at < end[todo]) & (high[np.minimum(at, most)] < rest[todo])]
    todo = np.flatnonzero(~small & (lo > start))
    while len(todo):
        at = lo[todo] - 1
        less = high[at] < rest[todo]
        todo, at = todo[~less], at[~less]
        lo[todo] = at
        todo = todo[at > start[todo]]
    # two keys of one place hardly share the larger part
    own = np.minimum(lo, most)
    same = (lo < end) & (high[own] == rest)
    todo = np.flatnonzero(same & (low[own] < last))
    while len(todo):
        at = lo[todo] + 1
        lo[todo] = at
        own = np.minimum(at, most)
        there = (at < end[todo]) & (high[own] == rest[todo])
        same[todo[~there]] = False
        todo = todo[there & (low[own] < last[todo])]
    return np.where(same & (low[np.minimum(lo, most)] == last), lo, -1)


def _write(file: pa.NativeFile, arrays: list[np.ndarray]) -> None:
    """The arrays after their lengths, each from a multiple of eight bytes."""
    file.write(np.array([len(a) for a in arrays], "<u8").tobytes())
    for a, kind in zip(arrays, ARRAYS, strict=True):
        part = a.astype(kind, copy=False).tobytes()
        file.write(part)
        file.write(bytes(-len(part) % 8))


def _contexts(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams' distinct contexts, sorted, with totals and the numbers of n-grams seen once, twice and more often."""
    context = _key(grams[:, :-1])
    order = np.argsort(context)
    context = context[order]
    counts = counts[order]
    del order
    new = np.flatnonzero(np.append(True, context[1:] != context[:-1])[: len(context)])
    context = context[new]
    table = np.zeros((len(new), 4), np.int64)
    if len(new):
        table[:, 0] = np.add.reduceat(counts, new)
        for k, own in enumerate((counts == 1, counts == 2, counts > 2), 1):
            table[:, k] = np.add.reduceat(own, new, dtype=np.int64)
    return context, table


def _mapped(raw: np.ndarray) -> list[np.ndarray]:
    at, out = 8 * len(ARRAYS), []
    for n, kind in zip(raw[:at].view("<u8").tolist(), ARRAYS):
        size = n * np.dtype(kind).itemsize
        out.append(raw[at : at + size].view(kind))
        at += size + -size % 8
    return out


def _merge(out: str, order: int, hot: np.ndarray, buckets: int, shared: Broadcast, next_hot: np.ndarray | None = None):
    """Merges whole buckets: writes their files, returns what is known of them and, given ``next_hot``, counts of the next lower order."""
    from tallyflow.llm.jaccard_join import _runs_of

    def one(bucket: int, packets: pa.Array, arrow: pa.Schema) -> pa.RecordBatch:
        parts, size = [], 0
        for k, packet in enumerate(packets, 1):
            parts.append(shared.value.unpack(packet.as_py(), order))
            size += len(parts[-1][1])
            if size > MERGED_AT and k < len(packets):
                parts.append(_summed(parts)[:2])
                size = 0
        grams, counts, hash = _summed(parts)
        spread, after, contexts, table = [], [], np.zeros(0, U64), np.zeros((0, 4), np.int64)
        if order > 1:
            contexts, table = _contexts(grams, counts)
            is_hot = _spot(hot, contexts)[1]
            if is_hot.any():
                spread = [[int(x), *map(int, r)] for x, r in zip(contexts[is_hot].view(np.int64), table[is_hot])]
                contexts, table = contexts[~is_hot], table[~is_hot]
        arrays = [*_key_arrays(contexts), *_count_arrays(table.ravel())]
        del contexts, table
        arrays = [*_key_arrays(hash), *_count_arrays(counts), *arrays]
        keys, total = len(hash), int(counts.sum())
        of = [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [int((counts > 2).sum())]
        del hash
        name = f"{out}/{bucket:08d}-{TaskContext.get().taskAttemptId()}.bin"
        system, path = open_uri(name)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        with system.open_output_stream(path, compression=None) as f:
            _write(f, arrays)
        del arrays
        if next_hot is not None:
            parts.append((np.ascontiguousarray(grams[:, 1:]), np.where(grams[:, 1] == BEGIN, counts, 1)))
            del grams, counts
            lower, n, own = _summed(parts)
            place = _gram_bucket(lower, own, next_hot, buckets)
            del own
            after = [{"bucket": int(b), "data": x} for b, x in zip(*shared.value.pack(lower, place, n))]
        return record(arrow, [bucket], [name], [keys], [total], [of], [spread], [after])

    def run(batches):
        arrow = to_arrow_schema(MERGED)
        for b in _runs_of(batches, ["bucket"]):
            bucket = b.column("bucket").to_numpy()
            cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                yield one(int(bucket[lo]), b.column("data").slice(lo, hi - lo), arrow)
                give_back()

    return run


@dataclass
class Order:
    """Files of one table, by bucket, with its totals and its hot contexts with theirs."""

    files: dict[int, str]
    total: int
    keys: int
    of: list[int]
    hot: np.ndarray
    hot_totals: np.ndarray

    def discounts(self) -> np.ndarray:
        """What is taken from counts of 0, 1, 2 and more."""
        n1, n2, n3, n4 = self.of[:4]
        if not (n1 and n2 and n3):
            return np.array([0, 0.5, 0.75, 0.9])
        y = n1 / (n1 + 2 * n2)
        d = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
        return np.clip(d, [0, 0.05, 0.1, 0.1], [0, 1, 2, 3])


@dataclass
class Model:
    """Word counts, and a table for each order from 1, the last with counts of n-grams, the others with the numbers of different words before them."""

    words: Order
    grams: list[Order]
    buckets: int
    maps: dict = field(default_factory=dict)
    mapped: int = 0

    def unmap(self, most: int = 0) -> None:
        """Closes all files if more than ``most`` bytes are mapped."""
        if self.mapped > most:
            self.maps.clear()
            self.mapped = 0

    def _map(self, uri: str) -> list[np.ndarray]:
        """The arrays of one bucket's file."""
        if uri not in self.maps:
            system, path = open_uri(uri)
            copied = system.type_name != "local"
            if copied:
                handle, copy = tempfile.mkstemp()
                with os.fdopen(handle, "wb") as out, system.open_input_stream(path) as f:
                    while part := f.read(1 << 20):
                        out.write(part)
                path = copy
            raw = np.asarray(np.memmap(path, np.uint8, "r"))
            self.mapped += len(raw)
            if copied:
                os.unlink(path)  # the mapping keeps the bytes until the worker ends
            self.maps[uri] = _mapped(raw)
        return self.maps[uri]

    def _find(self, order: Order, bucket: np.ndarray, key: np.ndarray, contexts: bool = False) -> np.ndarray:
        """Counts of keys, or the four totals of contexts; 0 where there are none."""
        out = np.zeros((len(key), 4) if contexts else len(key), np.int64)
        by = np.argsort(bucket.astype(np.uint16) if len(bucket) and bucket.max() < 1 << 16 else bucket, kind="stable")
        there, half = bucket[by], len(KEYS) + len(COUNTS)
        cuts = np.flatnonzero(np.append(True, there[1:] != there[:-1]))[: len(by)]
        for name, own in zip(there[cuts].tolist(), np.split(by, cuts[1:])):
            if name not in order.files:
                continue
            arrays = self._map(order.files[name])[half:] if contexts else self._map(order.files[name])[:half]
            place = _place(*arrays[: len(KEYS)], key[own])
            own, place = own[place >= 0], place[place >= 0]
            out[own] = _count_values(arrays[len(KEYS) :], 4 * place[:, None] + np.arange(4) if contexts else place)
        return out

    def logs(self, word: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Training count, log10 of the add-one probability and of the model's, for each word after ``before``.

        ``before`` has one column for each word, the nearest last, or is that word; with fewer than the model's, the lower order is used.
        """
        own, levels = np.column_stack([before, word]), []
        while own.shape[1]:  # the distinct n-grams, their hashes, and where those one word longer, at first all, find theirs
            hash = _key(own)
            at, inverse = _distinct(hash)
            own = own.take(at, axis=0)
            levels.append((own, hash.take(at), inverse))
            own = own[:, 1:]
        own, only, up = levels.pop()
        place = _bucket(only, self.buckets)
        c = self._find(self.words, place, only)
        size = self.words.keys + 1
        base = np.log10((c + 1) / (self.words.total + size))
        first = self.grams[0]
        k = self._find(first, place, only)
        d, total = first.discounts(), first.total
        if total:
            taken = d[1] * first.of[0] + d[2] * first.of[1] + d[3] * first.of[4]
            p = (np.maximum(k - d[np.minimum(k, 3)], 0) + taken / size) / total
        else:
            p = np.full(len(only), 1 / size)
        to_word = up
        for order in self.grams[1 : len(levels) + 1]:
            own, hash, inverse = levels.pop()
            heads = _key(own[:, :-1])
            del own
            at, of_head = _distinct(heads)
            heads = heads[at]
            place = _bucket(textops.mix(heads), self.buckets)
            sums = self._find(order, place, heads, True)
            spot, is_hot = _spot(order.hot, heads)
            sums[is_hot] = order.hot_totals[spot[is_hot]]
            k = self._find(order, np.where(is_hot[of_head], _bucket(hash, self.buckets), place[of_head]), hash)
            d, seen = order.discounts(), sums[:, 0] > 0
            full = np.maximum(sums[:, 0], 1)
            left = np.where(seen, (sums[:, 1] * d[1] + sums[:, 2] * d[2] + sums[:, 3] * d[3]) / full, 1.0)  # for the lower order; all if the context is new
            del sums
            p = np.where(seen, 1 / full, 0.0).take(of_head) * np.maximum(k - d[np.minimum(k, 3)], 0) + left.take(of_head) * p.take(up)
            to_word, up = to_word[inverse], inverse
        return c[to_word], base[to_word], np.log10(p)[up]


def _order(merged: DataFrame, hot: np.ndarray) -> Order:
    rows = merged.select("bucket", "file", "keys", "total", "of").collect()  # one row per bucket
    of = np.sum([r["of"] for r in rows], axis=0).tolist() if rows else [0] * 5
    spread = merged.select(F.explode("hot").alias("h")).groupBy(F.col("h")[0].alias("w")).agg(*[F.sum(F.col("h")[k]).alias(f"n{k}") for k in range(1, 5)])
    totals = np.zeros((len(hot), 4), np.int64)
    for r in spread.collect() if len(hot) else []:  # one row per hot context
        totals[np.searchsorted(hot, np.array([r.w], np.int64).view(U64))[0]] = [r.n1, r.n2, r.n3, r.n4]
    return Order({r.bucket: r.file for r in rows}, sum(r.total for r in rows), sum(r["keys"] for r in rows), of, hot, totals)


def train(docs: DataFrame, text_col: str = "text", order: int = ORDER) -> Model:
    """The model of all texts, of n-grams of ``order`` words, two or more."""
    if order < 2:
        raise ValueError("the order is two or more")
    spark = docs.sparkSession
    rows, out = docs.select(F.col(text_col).alias("text")), scratch_path(spark, "ngrams")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-int(total) // BUCKET_BYTES))
    none = np.zeros(0, U64)

    def merged(packed: DataFrame, name: str, *how) -> DataFrame:
        dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
        path = f"{out}/{name}-merged"
        map_arrow(dealt, _merge(f"{out}/{name}", *how), MERGED).write.parquet(path)
        return spark.read.schema(MERGED).parquet(path)

    shared = spark.sparkContext.broadcast(Common(none, none.astype(np.int64)))
    words = _order(merged(map_arrow(rows, _count(1, none, buckets, shared), PACKED), "words", 1, none, buckets, shared), none)
    bar = max(1, words.total // (4 * buckets))
    least = min(bar, words.total // COMMON)

    def frequent(batches):
        schema = pa.schema([("w", pa.int64()), ("n", pa.int64())])
        for b in batches:
            for file in b.column("file").to_pylist():
                system, path = open_uri(file)
                with system.open_input_file(path) as f:
                    arrays = _mapped(np.frombuffer(f.read(), np.uint8))
                hash = _keys(*arrays[: len(KEYS)])
                count = _count_values(arrays[len(KEYS) : len(KEYS) + len(COUNTS)], np.arange(len(hash)))
                yield record(schema, hash[count > least].view(np.int64), count[count > least])

    files = spark.createDataFrame([(f,) for f in words.files.values()], "file string")
    common = map_arrow(files, frequent, "w bigint, n bigint").toArrow()  # fewer than the larger of COMMON and 4 * buckets
    word, count = common["w"].to_numpy().view(U64), common["n"].to_numpy()
    hot = {1: none, 2: np.unique(np.append(word[count > bar], BEGIN))}
    contexts = map_arrow(rows, _frequent_contexts(order, hot[2]), "words int, w bigint, n bigint")
    often = contexts.groupBy("words", "w").agg(F.sum("n").alias("n")).where(F.col("n") > bar).collect() if order > 2 else []  # fewer than 4 * buckets of each length
    for k in range(2, order):
        hot[k + 1] = np.unique(np.array([r.w for r in often if r.words == k], np.int64).view(U64))

    shared = spark.sparkContext.broadcast(Common(np.append(word, BEGIN), np.append(count, words.total)))
    packed, grams = map_arrow(rows, _count(order, hot[order], buckets, shared), PACKED), []
    for k in range(order, 0, -1):
        both = merged(packed, f"grams{k}", k, hot[k], buckets, shared, hot[k - 1] if k > 1 else None)
        if k < order:
            remove(f"{out}/grams{k + 1}-merged")  # its packets are merged, its figures are known
        grams.insert(0, _order(both, hot[k]))
        packed = both.select(F.explode("next").alias("x")).select("x.*")
    return Model(words, grams, buckets)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) per document; scores are sums of log10 probabilities."""
    names = [("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType())]
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *[T.StructField(k, t) for k, t in names]])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        arrow, own = to_arrow_schema(schema), shared.value
        try:
            for piece in textops.pieces(batches, "text", SCORED):
                grams, row = _tokens(piece.column("text"), len(own.grams))
                count, base, score = own.logs(grams[:, -1], grams[:, :-1])
                n = piece.num_rows
                yield record(arrow, piece.column("id"), np.bincount(row, minlength=n), np.bincount(row[count > 0], minlength=n), np.bincount(row, base, n), np.bincount(row, score, n))
                del grams, row, count, base, score
                own.unmap(MAPPED)
                give_back()
        finally:
            own.unmap()  # the worker lives on

    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, schema)


def score_all(docs: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    """All documents scored by the model of those that are not held out."""
    model = train(docs.where(~held_out("doc_id", folds, fold)))
    out = scored(docs, model)
    return out.select(F.col("id").alias("doc_id"), held_out("id", folds, fold).alias("held_out"), "n_tokens", "n_known", F.lit(model.words.total).cast("bigint").alias("train_tokens"), "base_score", "score")
