"""Language identification by a bit-sliced Bloom filter of n-grams.

A slot of the filter has one bit per language. A look-up ANDs the slots of an n-gram, which gives all
languages that contain it at once. A text's n-grams are counted per language; each count is corrected for
the filter's false positives, count' = (count - n fp) / (1 - fp) with fp from the share of slots that have
the language's bit; the highest decides, and the score is its share of all counts.

N-grams are 4 bytes of the lower-cased text in which runs of other characters are one blank. A language
contains those that are at least ``LEAST_RATE`` of its n-grams, so it has at most 1 / ``LEAST_RATE`` of them,
whatever the corpus. An n-gram that many languages contain counts for each of them, and so decides nothing.
Counts cover all training texts.

Null texts and texts without a letter are ``und`` with score 0. A text none of whose n-grams is known gets
the language with most n-grams in training, with score 0; ties go to the first language in order. Without
training rows all is ``und``. Repeated rows count each. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow.llm import textops
from tallyflow.llm.tasks import batch as record
from tallyflow.llm.tasks import map_arrow
from tallyflow.llm.toxicity import held_out
from tallyflow.sinks.scratch import stored

LEAST_RATE = 1e-5
SLOTS = 1 << 21
HASHES = 4
UNKNOWN = "und"

COUNTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])
#: distinct n-grams a task holds before it merges them
HELD = 4_000_000

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """N-grams, as 32-bit numbers, and their rows. Each text stands between blanks."""
    data, offsets = textops.buffers(texts)
    rows = len(offsets) - 1
    n = np.diff(offsets)
    byte = _FOLD[data]
    # capitals of the two-byte Latin letters, beside which multiplication sign and sharp s stay
    lead = np.flatnonzero((byte[:-1] == 0xC3) & (byte[1:] <= 0x9E) & (byte[1:] >= 0x80) & (byte[1:] != 0x97)) if len(byte) else np.zeros(0, int)
    byte[lead + 1] += 0x20
    row = np.repeat(np.arange(rows), n + 3)
    at = offsets[:-1] + 3 * np.arange(rows)  # a blank before, two behind
    out = np.full(len(data) + 3 * rows, 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(3 * np.arange(rows) + 1, n)] = byte
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0x20) | (out[:-1] != 0x20) | (row[1:] != row[:-1])
    keep[at + n + 2] = True  # one blank too many behind each text is kept, so the shortest has an n-gram
    out, row = out[keep].astype(np.uint32), row[keep]
    if len(out) < 4:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    key = out[:-3] << 24 | out[1:-2] << 16 | out[2:-1] << 8 | out[3:]
    inner = (row[:-3] == row[3:]) & (key & np.uint32(0x00FFFF00) != np.uint32(0x00202000))
    return key[inner], row[:-3][inner]


def _count(batches):
    arrow, names, held, size = to_arrow_schema(COUNTS), {}, [], 0

    def merged():
        key, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return key, np.bincount(at.ravel(), np.concatenate([n for _, n in held])).astype(np.int64)

    for piece in textops.pieces(batches, "text"):
        key, row = grams(piece.column("text"))
        lang = np.array([names.setdefault(x, len(names)) for x in piece.column("lang").to_pylist()], np.uint64)
        held.append(np.unique(lang[row] << np.uint64(32) | key, return_counts=True))
        size += len(held[-1][0])
        if size > HELD:
            held = [merged()]
            size = len(held[0][0])
            if size > HELD // 2:
                yield _rows(arrow, names, *held[0])
                held, size = [], 0
    if held:
        yield _rows(arrow, names, *merged())


def _rows(arrow, names, key, n):
    langs = pa.DictionaryArray.from_arrays(pa.array((key >> np.uint64(32)).astype(np.int32)), pa.array(list(names), pa.string()))
    return record(arrow, langs.cast(pa.string()), (key & np.uint64(0xFFFFFFFF)).astype(np.int64), n)


class Filter:
    """The bit-sliced filter: ``slots`` has one 64-bit word per 64 languages."""

    def __init__(self, langs: list[str], fallback: int):
        self.langs, self.fallback = langs, fallback
        self.slots = np.zeros((max(1, -(-len(langs) // 64)), SLOTS), np.uint64)

    @staticmethod
    def _places(grams: np.ndarray) -> list[np.ndarray]:
        a = textops.mix(grams.astype(np.uint64) + np.uint64(1))
        step = (a >> np.uint64(32)) | np.uint64(1)
        return [((a + np.uint64(k) * step) & np.uint64(SLOTS - 1)).astype(np.int64) for k in range(HASHES)]

    def add(self, grams: np.ndarray, lang: int) -> None:
        for at in self._places(grams):
            self.slots[lang // 64, np.unique(at)] |= np.uint64(1 << lang % 64)

    def false_rates(self) -> np.ndarray:
        """Probability that an n-gram no language contains seems to be in each."""
        return np.array([np.mean(self.slots[k // 64] >> np.uint64(k % 64) & np.uint64(1)) for k in range(len(self.langs))]) ** HASHES

    def counts(self, grams: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """How many n-grams of each row each language contains."""
        places = self._places(grams)
        out = np.zeros((rows, len(self.langs)))
        for word in range(len(self.slots)):
            mask = self.slots[word][places[0]]
            for at in places[1:]:
                mask &= self.slots[word][at]
            for k in range(64 * word, min(64 * word + 64, len(self.langs))):
                out[:, k] = np.bincount(row[(mask >> np.uint64(k % 64) & np.uint64(1)).astype(bool)], minlength=rows)
        return out


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Filter:
    """The filter of all given texts with a language."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    counts = map_arrow(rows, _count, COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = stored(counts, "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    known = sorted((r.lang, r.total) for r in totals.collect())  # one row per language
    found = Filter([x for x, _ in known], int(np.argmax([n for _, n in known])) if known else -1)
    rates = counts.join(F.broadcast(totals), "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("rate"))
    kept = rates.where(F.col("rate") >= LEAST_RATE).select("lang", "gram")  # at most 1 / LEAST_RATE rows a language
    place = {x: k for k, x in enumerate(found.langs)}
    members: dict[int, list[int]] = {k: [] for k in place.values()}
    for r in kept.collect():
        members[place[r.lang]].append(r.gram)
    for k, own in members.items():
        found.add(np.array(own, np.uint64), k)
    return found


def identify(docs: DataFrame, learned: Filter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) per document."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches):
        arrow, own = to_arrow_schema(schema), shared.value
        false = own.false_rates()
        for piece in textops.pieces(batches, "text"):
            texts = piece.column("text")
            key, row = grams(texts)
            n = piece.num_rows
            total = np.bincount(row, minlength=n)[:, None]
            share = np.maximum(0, (own.counts(key, row, n) - total * false) / (1 - np.minimum(false, 0.999)))
            sums = share.sum(1)
            best = np.where(sums > 0, share.argmax(1), own.fallback) if len(own.langs) else np.full(n, -1)
            score = np.where(sums > 0, share.max(1, initial=0) / np.maximum(sums, 1e-300), 0)
            data, offsets = textops.buffers(texts)
            ascii_letters = np.concatenate([[0], np.cumsum((data | 0x20) - 0x61 < 26)])
            plain = np.diff(ascii_letters[offsets]) > 0
            langs = [own.langs[k] if k >= 0 else UNKNOWN for k in best.tolist()]
            for k in np.flatnonzero(~plain).tolist():
                if not any(map(str.isalpha, texts[k].as_py() or "")):
                    langs[k], score[k] = UNKNOWN, 0.0
            yield record(arrow, piece.column("id"), langs, np.minimum(score, 1.0))

    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, schema)


def predict(docs: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """(doc_id, held_out, lang_pred, score); held-out ids are not learned from."""
    learned = learn(docs.where(~held_out("doc_id", folds, fold)))
    return identify(docs, learned).select(F.col("id").alias("doc_id"), held_out("id", folds, fold).alias("held_out"), "lang_pred", "score")
