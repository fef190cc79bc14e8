"""Running Python over Arrow batches on executors that may not have this library installed."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

import tallyflow

_sent: set[str] = set()


def _ship(context: SparkContext) -> None:
    """Gives the library's sources to the executors, once for each application."""
    if context.applicationId in _sent:
        return
    top = Path(tallyflow.__file__).parent
    handle, path = tempfile.mkstemp(prefix="tallyflow-", suffix=".zip")  # the driver's own copy, served to the executors
    with os.fdopen(handle, "wb") as out, zipfile.ZipFile(out, "w") as z:
        for file in sorted(top.rglob("*.py")):
            z.write(file, file.relative_to(top.parent))
    context.addPyFile(path)
    _sent.add(context.applicationId)


def give_back() -> None:
    """Returns freed memory to the system: the worker lives on, and freed arrays between others would stay its own."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.pythonapi, "malloc_trim", None)  # glibc: what numpy has freed
    if trim:
        trim(ctypes.c_size_t(0))


def map_arrow(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str, barrier: bool = False) -> DataFrame:
    """``df.mapInArrow`` with this library at hand in the tasks, whose workers keep no freed memory from one task to the next."""
    _ship(df.sparkSession.sparkContext)

    def task(batches):
        yield from run(batches)
        give_back()

    return df.mapInArrow(task, schema, barrier)


def open_uri(uri: str) -> tuple[FileSystem, str]:
    """The file system and path of a file or folder in the shared scratch folder."""
    return FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def batch(schema: pa.Schema, *columns: object) -> pa.RecordBatch:
    """A record batch of ``schema`` from arrays, numpy arrays or lists."""
    cols = [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays([x if x.type == f.type else x.cast(f.type) for x, f in zip(cols, schema)], schema=schema)
