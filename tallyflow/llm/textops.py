"""Words, hashes and shingles of whole Arrow string columns, in numpy.

Words are maximal runs of word bytes inside one text. All separators are ASCII, so UTF-8 texts can be cut
byte by byte. Hashes are 64-bit, the same in every task and session.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: bytes of text handled at once; a longer text is handled alone
PIECE = 1 << 20
_STEP = 1 << 18
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SPACED = np.ones(256, bool)
SPACED[list(SPACES)] = False
#: letters, digits and all bytes from 0x80
ALNUM = np.zeros(256, bool)
ALNUM[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit (splitmix finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
_powers: dict[str, np.ndarray] = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, _STEP + 1)
        up, down = np.full(size, U64(_BASE)), np.full(size, U64(pow(_BASE, -1, 1 << 64)))
        up[0] = down[0] = 1
        _powers["up"], _powers["down"] = np.cumprod(up), np.cumprod(down)
    return _powers["up"], _powers["down"]


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes of data[start:end] from prefix sums, in steps of bounded memory."""
    out = np.empty(len(start), U64)
    i = 0
    while i < len(start):
        lo = start[i]
        j = max(i + 1, int(np.searchsorted(end, lo + _STEP, side="right")))
        up, down = _pow(int(end[j - 1] - lo))
        part = data[lo : end[j - 1]]
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum(_BYTE[part] * up[: len(part)], out=sums[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64))
        i = j
    return out


@dataclass
class Words:
    """Words of consecutive texts: byte range in ``data``, row, hash. ``first`` has the first word of each row, and the total."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def buffers(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins and the last ends; null is empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    if text.null_count:
        text = text.fill_null("")
    wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
    _, offsets, data = text.buffers()
    if len(text) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(text) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def words(text: pa.Array, letters: np.ndarray = SPACED, fold: np.ndarray = AS_IS) -> Words:
    """All words of all texts. ``fold`` maps bytes first, ``letters`` says which bytes are word bytes."""
    data, offsets = buffers(text)
    if fold is not AS_IS:
        data = fold[data]
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = letters[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, start, end, row, first, _hashes(data, start, end))


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts have at most ``limit`` bytes together, or are one text."""
    for batch in batches:
        _, offsets = buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def grams(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each window of ``size`` words; a text of fewer words, but not none, is one window."""
    h, n = w.hash, len(w.hash)
    lengths = np.diff(w.first)
    m = max(0, n - size + 1)
    out = np.zeros(m, U64)
    for k in range(size):
        out = out * U64(0xC2B2AE3D27D4EB4F) + h[k : k + m]
    whole = w.row[:m] == w.row[size - 1 : size - 1 + m]
    out, row = mix(out[whole] + U64(size)), w.row[:m][whole]
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(short):
        own = np.zeros(len(short), U64)
        for k in range(size - 1):
            has = lengths[short] > k
            own[has] = own[has] * U64(0xC2B2AE3D27D4EB4F) + h[w.first[short[has]] + k]
        out, row = np.append(out, mix(own + lengths[short].astype(U64))), np.append(row, short)
        order = np.argsort(row, kind="stable")
        out, row = out[order], row[order]
    return out, row


def per_row(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Bounds of each row's run in ``values``, which are in row order."""
    return np.searchsorted(row, np.arange(rows + 1))


def binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The runs ``values[bounds[i]:bounds[i + 1]]`` as a binary column."""
    data = np.ascontiguousarray(values)
    at = (bounds * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
