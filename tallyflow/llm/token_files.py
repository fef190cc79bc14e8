"""Token ids of documents as Huffman-coded blocks, written and read back.

A written folder holds ``codebook`` (id, bits), ``blocks`` and ``parts`` as Parquet, so Spark's own commit
covers them on any file system and a lost task leaves nothing behind. A block holds whole documents in
ascending id order, up to ``BLOCK`` ids or one document, and can be decoded without any other: coded bits,
checkpoints, document ids and lengths, and its place in the part. ``parts`` has the ids before each part.

Texts are encoded once; the ids are stored as integers, counted over all documents, dealt out by ranges of
the document id and coded. Only the counts (one per vocabulary entry) and one total per part reach the driver.

Null and empty texts have only the end id. A null id sorts first. Rows of equal ids follow each other in the
order of their ids' bytes. An empty table gives empty blocks. Extra columns are not read. Ids are whole numbers.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow.llm import textops
from tallyflow.llm.bpe import gather
from tallyflow.llm.huffman import Code, code_lengths
from tallyflow.llm.pretokens import byte_letters, pretokens
from tallyflow.llm.tasks import batch as record
from tallyflow.llm.tasks import map_arrow
from tallyflow.sinks.scratch import scratch_path, stored

END = 2
BLOCK = 1 << 16
#: bytes of stored ids in a part, on average
PART_BYTES = 16 << 20
PIECE = 2 << 20
#: bytes of pre-tokens and their ids that a task remembers
HELD_BYTES = 96 << 20

IDS = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType())])
COUNTS = T.StructType([T.StructField("token", T.LongType()), T.StructField("n", T.LongType())])
BLOCKS = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("docs", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("checkpoints", T.BinaryType()), T.StructField("bits", T.BinaryType()),
])
DOCS = T.StructType([T.StructField("id", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])


class LibraryIds:
    """Ids of texts; the library's model encodes each distinct pre-token once for each time a task's table of them starts."""

    def __init__(self, tokenizer):
        self.model, self.specials = tokenizer.model, {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.letters = dict(enumerate(byte_letters()))
        self.held: dict[int, list[int]] = {}
        self.size = 0

    def _ids(self, word: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(word.decode("latin-1").translate(self.letters))]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin."""
        p = pretokens(texts, self.specials)
        if not len(p.hash):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        hash = np.where(p.special < 0, p.hash, p.special.astype(np.uint64))
        own, at, word = np.unique(hash, return_index=True, return_inverse=True)
        if self.size > HELD_BYTES:  # bounds memory, changes no id
            self.held, self.size = {}, 0
        raw, held = p.data.tobytes(), self.held
        found = list(map(held.get, own.tolist()))
        new = [k for k, ids in enumerate(found) if ids is None]
        lo, hi, special = (x[at[new]].tolist() for x in (p.start, p.end, p.special))
        for k, key, a, b, s in zip(new, own[new].tolist(), lo, hi, special):
            found[k] = held[key] = [s] if s >= 0 else self._ids(raw[a:b])
            self.size += 150 + 8 * (b - a)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        tokens = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
        return gather(p, tokens, np.append(0, np.cumsum(sizes)), word.ravel(), len(texts))


def width(path: str) -> str:
    """The least integer that holds every id of a tokenizer file."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def token_ids(docs: DataFrame, path: str, kind: str, id_col: str = "doc_id", text_col: str = "text", end: int = END) -> DataFrame:
    """(id, n, ids) per document: its ids and the end id, as little-endian integers of ``kind``."""

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encoder, arrow = LibraryIds(Tokenizer.from_file(path)), to_arrow_schema(IDS)
        for piece in textops.pieces(batches, "text", PIECE):
            ids, at = encoder.texts(piece.column("text"))
            rows = np.arange(len(at))
            out = np.insert(ids, at[1:], end).astype(kind)
            at = at + rows
            yield record(arrow, piece.column("id"), np.diff(at), textops.binaries(out, at))

    return map_arrow(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")), run, IDS)


def _counts(kind: str):
    def run(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            data, _ = textops.buffers(b.column("ids"))
            more = np.bincount(data.view(kind), minlength=len(total))
            more[: len(total)] += total
            total = more
        used = np.flatnonzero(total)
        yield record(to_arrow_schema(COUNTS), used, total[used])

    return run


def _write_blocks(code: Code, kind: str):
    def run(batches):
        arrow, part = to_arrow_schema(BLOCKS), TaskContext.get().partitionId()
        docs, held, size, start, block = [], [], 0, 0, 0

        def flush():
            ids = np.concatenate(held)
            bits, checks = code.encode(ids)
            return record(arrow, [part], [block], [start], [len(ids)], [docs], [[len(x) for x in held]], [checks.tobytes()], [bits])

        for b in batches:
            data, at = textops.buffers(b.column("ids"))
            ids = data.view(kind)
            at = at // ids.itemsize
            for k, doc in enumerate(b.column("id").to_pylist()):
                own = ids[at[k] : at[k + 1]]
                if held and size + len(own) > BLOCK:
                    yield flush()
                    start, block, docs, held, size = start + size, block + 1, [], [], 0
                docs.append(doc)
                held.append(own)
                size += len(own)
        if held:
            yield flush()

    return run


def write(docs: DataFrame, tokenizer_path: str, out: str, id_col: str = "doc_id", text_col: str = "text", end: int = END) -> None:
    """Encodes all texts and writes the folder ``out``."""
    spark = docs.sparkSession
    kind = width(tokenizer_path)
    ids = stored(token_ids(docs, tokenizer_path, kind, id_col, text_col, end), "token-ids")
    counts = map_arrow(ids.select("ids"), _counts(kind), COUNTS).groupBy("token").agg(F.sum("n").alias("n")).collect()  # one row per vocabulary entry
    total = np.zeros(1 + max((r.token for r in counts), default=0), np.int64)
    for r in counts:
        total[r.token] = r.n
    lengths = code_lengths(total)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id bigint, bits int").coalesce(1).write.parquet(f"{out}/codebook")
    parts = max(1, -(-4 * int(total.sum()) // PART_BYTES))
    dealt = ids.repartitionByRange(parts, "id").sortWithinPartitions("id", "ids").select("id", "ids")
    map_arrow(dealt, _write_blocks(Code(lengths), kind), BLOCKS).write.parquet(f"{out}/blocks")
    sizes = spark.read.schema(BLOCKS).parquet(f"{out}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # one row per part
    before, rows = 0, []
    for r in sizes:
        rows.append((r.part, before))
        before += r.n
    spark.createDataFrame(rows, "part int, before bigint").coalesce(1).write.parquet(f"{out}/parts")


def read(spark: SparkSession, out: str) -> DataFrame:
    """(id, start, n_tokens, ids) per document of a written folder; ``start`` counts the ids of all documents before it."""
    book = spark.read.parquet(f"{out}/codebook").collect()  # one row per vocabulary entry
    lengths = np.zeros(1 + max((r.id for r in book), default=0), np.int64)
    for r in book:
        lengths[r.id] = r.bits

    def run(batches):
        code, arrow = Code(lengths), to_arrow_schema(DOCS)
        for b in batches:
            for r in b.to_pylist():
                ids = code.decode(r["bits"], np.frombuffer(r["checkpoints"], "<u8"), r["n_ids"]).astype("<u4")
                at = np.concatenate([[0], np.cumsum(r["lengths"])])
                yield record(arrow, r["docs"], [r["part"]] * len(r["docs"]), at[:-1] + r["start"], np.diff(at), textops.binaries(ids, at))

    found = map_arrow(spark.read.schema(BLOCKS).parquet(f"{out}/blocks"), run, DOCS)
    parts = spark.read.schema("part int, before bigint").parquet(f"{out}/parts")
    return found.join(F.broadcast(parts), "part").select("id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids")


def checksums(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from a written folder."""
    return read(spark, out).select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def write_and_check(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    out = scratch_path(docs.sparkSession, "token-files")
    write(docs, tokenizer_path, out)
    return checksums(docs.sparkSession, out)
