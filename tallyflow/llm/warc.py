"""WARC archives with a two-level capture index.

Writing. Each task writes its pages to a file of its own below the output folder, one gzip member per record,
and returns where each record is; those rows are committed by Spark, so files of lost or repeated attempts
are never referred to. Of pages with equal payloads the one with the lowest id is a response, the others
revisit it. Digests are grouped, pages are not: only the lowest id of each repeated digest is joined back.

Index. Captures are sorted by their reversed-host URL key over the whole archive and cut into compressed
blocks of ``LINES``. A sparse directory keeps each block's first and last key. It is cut into pages of as many
entries, and so on, until a root of at most ``LINES`` entries is left, which alone is sent to every task; so an
archive of any size can be searched. A look-up bisects the root and then, by range reads, the pages below it
to the blocks; these pairs of key and block are dealt by block, so a url with very many captures is read by many
tasks. Each block is read once, bisected for its keys, and the records are read by range.

Directory keys are cut to ``KEY`` characters, which bounds the root. Blocks have whole keys.

Null payloads are empty. Null urls have an empty key. A null id is a response that nothing refers to.
Repeated ids with equal payloads are all responses if theirs is the lowest id. An empty table gives an
archive without files. Extra columns are not read. Files go through pyarrow's file systems, so the output
folder may be on any store that they reach.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby, islice
from operator import itemgetter
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow.llm import textops
from tallyflow.llm.tasks import batch as record
from tallyflow.llm.tasks import map_arrow
from tallyflow.sinks.scratch import scratch_path, stored

LINES = 1000
DATE = "1970-01-01T00:00:00Z"
LEVEL = 5
#: repeated digests that may be sent to every task, about 100 bytes each
FEW = 500_000
#: characters of a key in the directory
KEY = 256
#: directory pages a task keeps
PAGES = 16
#: most tasks that read records
TASKS = 20_000

WRITTEN = T.StructType([T.StructField("key", T.StringType()), T.StructField("url", T.StringType()), T.StructField("page_id", T.LongType()), T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])
BLOCKS = T.StructType([T.StructField("first_key", T.StringType()), T.StructField("last_key", T.StringType()), T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()), T.StructField("blocks", T.LongType()), T.StructField("level", T.IntegerType())])
FOUND = T.StructType([T.StructField("wanted", T.StringType()), T.StructField("key", T.StringType()), *BLOCKS.fields[2:5]])
READ = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()), T.StructField("payload", T.BinaryType())])


def url_key(url: str | None) -> str:
    """The sort key of a URL: host labels from right to left, then path and query, without scheme and fragment."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:  # not a URL: kept as it is
        return url.lower()
    end = f":{port}" if port and port not in (80, 443) else ""
    return f"{','.join(reversed(host.split('.')))}{end}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".lower()


def _open(uri: str) -> tuple[FileSystem, str]:
    return FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def _record(page_id, url, payload: bytes, first, date: str) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    revisit = first is not None and page_id is not None and first < page_id
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {json.dumps(url)[1:-1] if url else ''}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}",
    ]
    if revisit:
        head[5:5] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{first}>"]
    z = zlib.compressobj(LEVEL, wbits=31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def parse(raw: bytes) -> dict:
    """The fields of one record, from its gzip member."""
    data = zlib.decompress(raw, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind = fields["WARC-Type"]
    if kind == "response":  # what is stored counts, not what the header says
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    else:
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    url = fields["WARC-Target-URI"]
    return {"page_id": number("WARC-Record-ID"), "url": json.loads(f'"{url}"') if url else None, "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": number("WARC-Refers-To"), "payload": payload if kind == "response" else None}


def _write(out: str, date: str):
    def run(batches):
        arrow, context = to_arrow_schema(WRITTEN), TaskContext.get()
        name = f"{out}/data/{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        file, at = None, 0
        for piece in textops.pieces(batches, "html"):
            if file is None:
                system, path = _open(name)
                system.create_dir(path.rpartition("/")[0], recursive=True)
                file = system.open_output_stream(path, compression=None)
            ids, urls, rows = piece.column("page_id").to_pylist(), piece.column("url").to_pylist(), []
            for page_id, url, html, first in zip(ids, urls, piece.column("html").to_pylist(), piece.column("first").to_pylist()):
                raw = _record(page_id, url, (html or "").encode(), first, date)
                file.write(raw)
                rows.append((at, len(raw)))
                at += len(raw)
            yield record(arrow, [url_key(u) for u in urls], urls, ids, [name] * len(ids), [x for x, _ in rows], [n for _, n in rows])
        if file is not None:
            file.close()

    return run


def _write_blocks(out: str, level: int, lines: int):
    """Sorted captures (level 0), or directory entries of the level below, as compressed blocks."""

    def run(batches):
        arrow, context = to_arrow_schema(BLOCKS), TaskContext.get()
        name = f"{out}/index/{level}/{context.partitionId():06d}-{context.taskAttemptId()}.cdxj.z"
        file, at, held = None, 0, []

        def flush():
            nonlocal file, at
            if file is None:
                system, path = _open(name)
                system.create_dir(path.rpartition("/")[0], recursive=True)
                file = system.open_output_stream(path, compression=None)
            raw = zlib.compress("\n".join(map(json.dumps, held)).encode(), LEVEL)
            file.write(raw)
            last = held[-1][1 if level else 0]
            row = record(arrow, [held[0][0][:KEY]], [last[:KEY]], [name], [at], [len(raw)], [sum(x[5] for x in held) if level else 1], [level])
            at += len(raw)
            held.clear()
            return row

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                held.append(r)
                if len(held) == lines:
                    yield flush()
        if held:
            yield flush()
        if file is not None:
            file.close()

    return run


def write(pages: DataFrame, out: str, least_bytes: int = 0, date: str = DATE, lines: int = LINES) -> None:
    """Writes pages (page_id, url, html) below ``out``: ``data``, the levels of the ``index``, and its ``root`` as Parquet."""
    rows = pages.select("page_id", "url", "html", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"), F.octet_length(F.coalesce("html", F.lit(""))).alias("bytes"))
    first = rows.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    first = stored(first, "payloads")
    few = first.count() <= FEW
    dated = rows.join(F.broadcast(first) if few else first, "digest", "left").select("page_id", "url", "html", "first")
    captures = stored(map_arrow(dated, _write(out, date), WRITTEN), "captures")
    rows, order, level = captures.select(WRITTEN.names), ("key", "page_id", "file", "offset"), 0
    while True:
        parts = max(1, -(-rows.count() // (16 * lines)))
        by_key = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        blocks = stored(map_arrow(by_key, _write_blocks(out, level, lines), BLOCKS), "directory")
        if blocks.count() <= max(16, lines):
            break
        rows, order, level = blocks, ("first_key", "last_key", "file", "offset"), level + 1
    blocks.coalesce(1).write.parquet(f"{out}/root")


def root(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{out}/root")


class _Files:
    """Open files of a task."""

    def __init__(self):
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            system, path = _open(name)
            self.name, self.file = name, system.open_input_file(path)
        return self.file.read_at(length, offset)


def _lines(files: _Files, file: str, offset: int, length: int) -> list[list]:
    return [json.loads(x) for x in zlib.decompress(files.read(file, offset, length)).decode().split("\n")]


class _Directory:
    """The directory from its root down, with the pages used last."""

    def __init__(self, top: list[list]):
        self.top, self.files = top, _Files()
        self.page = lru_cache(PAGES)(lambda *place: _lines(self.files, *place))

    def blocks(self, key: str, entries: list[list] | None = None) -> Iterator[list]:
        """Where the blocks are that may hold the key."""
        entries, cut = self.top if entries is None else entries, key[:KEY]
        for x in entries[bisect_left(entries, cut, key=itemgetter(1)) : bisect_right(entries, cut, key=itemgetter(0))]:
            if x[6]:
                yield from self.blocks(key, self.page(*x[2:5]))
            else:
                yield x[2:5]


def _records(files: _Files, lines: list[list], arrow: pa.Schema, payloads: bool) -> Iterator[pa.RecordBatch]:
    lines.sort(key=itemgetter(3, 4))
    for at in range(0, len(lines), 64):
        found = [parse(files.read(*x[3:])) for x in lines[at : at + 64]]
        yield record(arrow, *([r[c] if payloads or c != "payload" else None for r in found] for c in READ.names))


def _tasks(blocks: int) -> int:
    return max(1, min(blocks // 2, TASKS))


def read(spark: SparkSession, out: str, payloads: bool = False) -> DataFrame:
    """Every record, by all pages of the directory. Revisits have no payload of their own."""

    def pages(batches):
        arrow, files = to_arrow_schema(BLOCKS), _Files()
        for b in batches:
            for place in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length"))):
                yield record(arrow, *zip(*_lines(files, *place)))

    def run(batches):
        arrow, index, data = to_arrow_schema(READ), _Files(), _Files()
        for b in batches:
            for place in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length"))):
                yield from _records(data, _lines(index, *place), arrow, payloads)

    rows = root(spark, out)
    n, levels = rows.agg(F.coalesce(F.sum("blocks"), F.lit(0)), F.coalesce(F.max("level"), F.lit(0))).first()
    for _ in range(levels):
        rows = map_arrow(rows.repartition(_tasks(n // LINES)), pages, BLOCKS)
    return map_arrow(rows.select("file", "offset", "length").repartition(_tasks(n)), run, READ)


def keyed(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """(wanted, key) of each distinct url."""
    schema = T.StructType(FOUND.fields[:2])

    def run(batches):
        arrow = to_arrow_schema(schema)
        for b in batches:
            yield record(arrow, b.column("wanted"), [url_key(u) for u in b.column("wanted").to_pylist()])

    return map_arrow(urls.select(F.col(url_col).alias("wanted")).distinct(), run, schema)


def fetch(spark: SparkSession, out: str, keys: DataFrame, payloads: bool = True) -> DataFrame:
    """(wanted, page_id, url, ...): the captures of each row of ``keys`` (wanted, key), searched from the root down."""
    top = root(spark, out).orderBy("first_key", "last_key").collect()  # at most LINES rows of bounded size
    shared = spark.sparkContext.broadcast([list(x) for x in top])
    schema = T.StructType([FOUND["wanted"], *READ.fields])

    def search(batches):
        arrow, directory = to_arrow_schema(FOUND), _Directory(shared.value)
        for b in batches:
            found = ((wanted, key, *place) for wanted, key in zip(b.column("wanted").to_pylist(), b.column("key").to_pylist()) for place in directory.blocks(key))
            while some := list(islice(found, 10_000)):
                yield record(arrow, *zip(*some))

    def run(batches):
        arrow, inner, index, data = to_arrow_schema(schema), to_arrow_schema(READ), _Files(), _Files()
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in FOUND.names)))
        for place, wants in groupby(rows, key=itemgetter(2, 3, 4)):
            own = _lines(index, *place)
            keys = [x[0] for x in own]
            lines = [[wanted, *x] for wanted, key, *_ in wants for x in own[bisect_left(keys, key) : bisect_right(keys, key)]]
            lines.sort(key=lambda x: (x[4], x[5]))
            for at in range(0, len(lines), 64):
                part = lines[at : at + 64]
                for found in _records(data, [x[1:] for x in part], inner, payloads):
                    yield record(arrow, [x[0] for x in part], *found.columns)

    found = stored(map_arrow(keys.repartitionByRange("key").sortWithinPartitions("key"), search, FOUND), "found")
    by_block = found.repartitionByRange(_tasks(sum(x.blocks for x in top)), "file", "offset").sortWithinPartitions("file", "offset", "key")
    return map_arrow(by_block, run, schema)


def lookup(spark: SparkSession, out: str, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """(wanted, page_id, url, ...) of all captures of each distinct url given."""
    return fetch(spark, out, keyed(urls, url_col))


def write_and_read(pages: DataFrame) -> DataFrame:
    """The records of ``pages`` after a round trip: archives in the scratch folder, searched for the key of every url."""
    spark, out = pages.sparkSession, scratch_path(pages.sparkSession, "warc")
    write(pages, out)
    keys = keyed(pages).select(F.col("key").alias("wanted"), "key").distinct()
    return fetch(spark, out, keys, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
