"""Benchmark decontamination by an FM-index per training shard.

Each task cuts its documents into shards of at most ``SHARD_WORDS`` words, indexes the words of a shard,
searches all benchmark windows backwards in it, locates the occurrences and merges their word ranges into
removal spans. Documents are never shuffled, and a shard never holds more than its bound: longer documents
are indexed in parts that overlap by a window.

Windows are ``WINDOW`` consecutive words of a benchmark item, or all words of a shorter one. The benchmark
is cut into blocks of at most ``BLOCK_BYTES`` of text on average (or one text). One block is broadcast; several are
files, which a task reads one after the other for each of its shards, so a shard is indexed once and documents are
read once whatever the size of the benchmark. Ranges are merged, and cut out, once all blocks are searched, so the
number of blocks changes no result.

Null and empty texts have no words and no hits. Repeated ids are rows of their own. Items without words
occur nowhere; an item id that is repeated counts once, and its texts are dealt out over the blocks, equal
ones once. Texts of a null item id are searched and hit like others, but a null is not listed as an item. An empty
benchmark hits nothing. Columns other than the id and the text are not read, or passed
through untouched by ``remove_spans``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import parquet
from pyarrow.fs import FileType
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow.llm import textops
from tallyflow.llm.fm_index import Shard
from tallyflow.llm.tasks import batch as record
from tallyflow.llm.tasks import give_back, map_arrow, open_uri
from tallyflow.sinks.scratch import scratch_path

WINDOW = 10
SHARD_WORDS = 1 << 20
#: about 100 MB of windows
BLOCK_BYTES = 8 << 20

SPAN = T.ArrayType(T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())]))


class Phrases:
    """Distinct windows of a block of items, by their length, each with the items that have it; the last name is the null one."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        self.names = [*sorted({name for name, _ in items} - {None}), None]
        place = {name: k for k, name in enumerate(self.names)}
        item = np.array([place[name] for name, _ in items], np.int64)
        w = textops.words(pa.array([text or "" for _, text in items], pa.large_string()), textops.ALNUM, textops.LOWER)
        sizes = np.minimum(np.diff(w.first), window)
        self.groups = []
        for size in np.unique(sizes[sizes > 0]).tolist():
            own = np.flatnonzero(sizes == size)
            counts = np.diff(w.first)[own] - size + 1
            begin = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(w.first[own], counts)
            windows = w.hash[begin[:, None] + np.arange(size)]
            _, at, which = np.unique(windows.view(np.dtype((np.void, windows.itemsize * size))).ravel(), return_index=True, return_inverse=True)
            having = np.unique(which.ravel() * len(self.names) + np.repeat(item[own], counts))
            bounds = np.searchsorted(having, np.arange(len(at) + 1) * len(self.names))
            self.groups.append((size, windows[at], having % len(self.names), bounds))


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> tuple[int, Callable[[], Iterator[Phrases]]]:
    """How many blocks the benchmark has, and what gives their windows, one block after the other, in a task."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t is not null").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("t") + 16), F.lit(0))).first()[0]
    count = max(1, -(-int(total) // BLOCK_BYTES))
    if count == 1:
        shared = spark.sparkContext.broadcast(Phrases([(r.i, r.t) for r in items.collect()], window))  # BLOCK_BYTES at most
        return 1, lambda: iter([shared.value])
    path = scratch_path(spark, "benchmark")
    block = F.pmod(F.xxhash64("i", "t"), F.lit(count))
    items.withColumn("block", block).repartition(count, "block").write.partitionBy("block").parquet(path)

    def read() -> Iterator[Phrases]:
        for k in range(count):
            system, folder = open_uri(f"{path}/block={k}")
            if system.get_file_info(folder).type == FileType.NotFound:
                continue
            table = parquet.read_table(folder, filesystem=system, columns=["i", "t"], partitioning=None)
            yield Phrases(list(zip(*(c.to_pylist() for c in table.columns))), window)

    return count, read


def _search(shard: Shard, phrases: Phrases) -> Iterator[tuple[int, int, int, list]]:
    """(text, first word, words, items) of each occurrence."""
    for size, windows, having, bounds in phrases.groups:
        low, high = shard.search(windows)
        some = np.flatnonzero(high > low)
        if not len(some):
            continue
        names = {p: [x for k in having[bounds[p] : bounds[p + 1]] if (x := phrases.names[k]) is not None] for p in some.tolist()}
        width = (high - low)[some]
        which = np.repeat(some, width)
        rows = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(low[some], width)
        text, word = shard.locate(rows)
        for t, w, p in zip(text.tolist(), word.tolist(), which.tolist()):
            yield t, w, size, names[p]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def scan(batches: Iterable[pa.RecordBatch], column: str, blocks: Callable[[], Iterator[Phrases]], window: int, shard_words: int) -> Iterator[tuple[pa.RecordBatch, list, list, list, np.ndarray]]:
    """Pieces of the batches, each with the word spans, byte spans, items and words of its rows."""
    held: list[tuple[pa.RecordBatch, textops.Words]] = []
    size = 0

    def flush():
        parts, owner = [], []
        overlap = window - 1
        for k, (_, w) in enumerate(held):
            for row in range(len(w.first) - 1):
                lo, hi = int(w.first[row]), int(w.first[row + 1])
                at = lo
                while at < hi:
                    to = min(hi, at + shard_words)
                    parts.append(w.hash[at:to])
                    owner.append((k, row, at - lo))
                    at = to if to == hi else max(at + 1, to - overlap)
        hits: dict[tuple[int, int], list] = defaultdict(list)
        i = 0
        while i < len(parts):
            j, n = i + 1, len(parts[i])
            while j < len(parts) and n + len(parts[j]) <= shard_words:
                n += len(parts[j])
                j += 1
            shard = Shard(np.concatenate(parts[i:j]), np.concatenate([[0], np.cumsum([len(p) for p in parts[i:j]])]))
            for phrases in blocks():
                for text, word, width, names in _search(shard, phrases):
                    k, row, base = owner[i + text]
                    hits[k, row].append((base + word, base + word + width, names))
            del shard
            i = j
        del parts
        give_back()
        for k, (batch, w) in enumerate(held):
            spans, cuts, items = [], [], []
            for row in range(batch.num_rows):
                own = hits.get((k, row), ())
                merged = _merged([(lo, hi) for lo, hi, _ in own])
                base, at = int(w.first[row]), int(w.offsets[row])
                spans.append(merged)
                cuts.append([(int(w.start[base + lo]) - at, int(w.end[base + hi - 1]) - at) for lo, hi in merged])
                items.append(sorted({x for *_, names in own for x in names}))
            yield batch, spans, cuts, items, np.diff(w.first)
        held.clear()

    for piece in textops.pieces(batches, column):
        w = textops.words(piece.column(column), textops.ALNUM, textops.LOWER)
        if held and size + len(w.hash) > shard_words:
            yield from flush()
            size = 0
        held.append((piece, w))
        size += len(w.hash)
    if held:
        yield from flush()


def _pairs(rows: list) -> list:
    return [[{"lo": lo, "hi": hi} for lo, hi in x] for x in rows]


def _searched(
    rows: DataFrame, text_col: str, benchmark: DataFrame, item_col: str, item_text: str, window: int, shard_words: int, schema: T.StructType, finish: Callable,
) -> DataFrame:
    """Rows of ``schema``, which ``finish`` makes from a piece and what all blocks of the benchmark hit in it."""
    width = len(rows.columns)
    _, blocks = _blocks(benchmark, item_col, item_text, window)

    def run(batches):
        arrow = to_arrow_schema(schema)
        for piece, spans, cuts, items, n in scan(batches, text_col, blocks, window, shard_words):
            yield record(arrow, *finish(piece.columns[:width], spans, cuts, items, n))

    return map_arrow(rows, run, schema)


def spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(id, n_words, spans, cuts, items) per document: merged word ranges, their byte ranges in the UTF-8 text, and the items that occur."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = T.ArrayType(benchmark.schema[item_col].dataType)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("spans", SPAN), T.StructField("cuts", SPAN), T.StructField("items", kind)])
    return _searched(rows, "text", benchmark, item_col, item_text, window, shard_words, schema, lambda own, s, c, items, n: (own[0], n, _pairs(s), _pairs(c), items))


def digest(found: DataFrame, id_name: str = "doc_id") -> DataFrame:
    """Counts and the item digest of ``spans``."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["hi"] - x["lo"])
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        F.col("id").alias(id_name), "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def _without(text: str, cuts: list[tuple[int, int]]) -> str:
    """``text`` without byte ranges of its UTF-8 form."""
    raw, keep, last = text.encode(), [], 0
    for lo, hi in cuts:
        keep.append(raw[last:lo])
        last = hi
    return b"".join([*keep, raw[last:]]).decode()


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with the hit ranges cut out of the texts; all other columns, rows and null texts stay as they are."""
    at = docs.columns.index(text_col)

    def finish(own, spans, cuts, items, n):
        texts = own[at].to_pylist()
        for row, found in enumerate(cuts):
            if found:
                texts[row] = _without(texts[row], found)
        return [pa.array(texts, own[at].type) if k == at else c for k, c in enumerate(own)]

    return _searched(docs, text_col, benchmark, item_col, item_text, window, shard_words, docs.schema, finish)
