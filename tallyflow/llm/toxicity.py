"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms: lower-cased words, hashed to ``TERM_BITS`` bits. The score is the logistic of
bias + sum of the terms' weights + sum over all pairs of terms of the product of their factor vectors, so a
pair of terms can weigh what neither does alone. It is learned from at most ``TRAIN_ROWS`` labelled texts on
average, drawn by a hash of the id; the terms kept are the up to ``TERMS`` most associated with the label,
the pairs come from those. Fitting runs in one task on that bounded sample; scoring runs over all texts.

Null and empty texts have no terms and get the bias alone. A null label, or one of an id that no document
has, teaches nothing; a repeated id teaches once per pair of rows. Without labelled texts every score is
``PRIOR``. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow.llm import textops
from tallyflow.llm.tasks import batch as record
from tallyflow.llm.tasks import map_arrow
from tallyflow.sinks.scratch import stored

TRAIN_ROWS = 16_000
TERM_BITS = 20
TERMS = 1024
FACTORS = 8
EPOCHS = 24
#: least optimizer steps, for small samples
STEPS = 600
#: least chi-square of a kept term, and the least texts it occurs in
ASSOCIATION = 15.0
LEAST_TEXTS = 5
PRIOR = 0.1

FEATURES = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("terms", T.BinaryType())])
MODEL = T.StructType([T.StructField("bias", T.DoubleType()), T.StructField("terms", T.BinaryType()), T.StructField("weights", T.BinaryType()), T.StructField("factors", T.BinaryType())])


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """True for ids whose crc32, of the id as text, leaves ``fold``; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def _terms(texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms and their rows, by row."""
    w = textops.words(texts, textops.ALNUM, textops.LOWER)
    return np.divmod(np.unique((w.row.astype(np.int64) << TERM_BITS) | (w.hash >> np.uint64(64 - TERM_BITS)).astype(np.int64)), 1 << TERM_BITS)


def _features(batches):
    arrow = to_arrow_schema(FEATURES)
    for piece in textops.pieces(batches, "text"):
        row, term = _terms(piece.column("text"))
        at = np.searchsorted(row, np.arange(piece.num_rows + 1))
        yield record(arrow, piece.column("label"), textops.binaries(term.astype("<u4"), at))


class Machine:
    """A fitted factorization machine; ``terms`` are the kept ones, in order."""

    def __init__(self, bias: float, terms: np.ndarray, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.terms, self.weights, self.factors = bias, terms, weights, factors

    @classmethod
    def fit(cls, rows: list[np.ndarray], labels: np.ndarray) -> Machine:
        n, positive = len(rows), int(labels.sum())
        prior = (positive + 10 * PRIOR) / (n + 10)
        bias = float(np.log(prior / (1 - prior)))
        empty = cls(bias, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
        if not 0 < positive < n:
            return empty
        flat = np.concatenate(rows).astype(np.int64)
        owner = np.repeat(np.arange(n), [len(r) for r in rows])
        both = np.bincount(flat, minlength=1 << TERM_BITS)
        hit = np.bincount(flat[labels[owner] == 1], minlength=1 << TERM_BITS)
        expected = both * (positive / n)
        spread = expected * (1 - positive / n) * (1 - both / n)
        chi = np.where((both >= LEAST_TEXTS) & (spread > 0), (hit - expected) ** 2 / np.maximum(spread, 1e-9), 0)
        kept = np.sort(np.argsort(-chi, kind="stable")[:TERMS])
        kept = kept[chi[kept] >= ASSOCIATION]
        if not len(kept):
            return empty
        place = np.full(1 << TERM_BITS, -1, np.int64)
        place[kept] = np.arange(len(kept))
        x = np.zeros((n, len(kept)), np.float32)
        own = place[flat]
        x[owner[own >= 0], own[own >= 0]] = 1
        rng = np.random.default_rng(7)
        w, v = np.zeros(len(kept), np.float32), rng.normal(0, 0.05, (len(kept), FACTORS)).astype(np.float32)
        state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, v, np.zeros(1, np.float32))]
        b, step, y = np.array([bias], np.float32), 0, labels.astype(np.float32)
        batches = max(1, n // 256)
        epochs = max(EPOCHS, -(-STEPS // batches))
        for epoch in range(epochs):
            rate = 0.05 * 0.05 ** (epoch / epochs)
            for part in np.array_split(rng.permutation(n), batches):
                xs = x[part]
                sums = xs @ v
                z = b + xs @ w + 0.5 * ((sums**2).sum(1) - xs @ (v**2).sum(1))
                err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) / len(part)
                grads = [xs.T @ err + 1e-5 * w, xs.T @ (err[:, None] * sums) - v * (xs.T @ err)[:, None] + 1e-4 * v, np.array([err.sum()])]
                step += 1
                for p, g, s in zip((w, v, b), grads, state):
                    s[0] = 0.9 * s[0] + 0.1 * g
                    s[1] = 0.999 * s[1] + 0.001 * g * g
                    p -= rate * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.999**step)) + 1e-8)
        return cls(float(b[0]), kept, w.astype(np.float64), v.astype(np.float64))

    def scores(self, row: np.ndarray, term: np.ndarray, rows: int) -> np.ndarray:
        """Score of each row, from its distinct terms."""
        at = np.minimum(np.searchsorted(self.terms, term), max(0, len(self.terms) - 1))
        ok = self.terms[at] == term if len(self.terms) else np.zeros(len(term), bool)
        row, at = row[ok], at[ok]
        z = self.bias + np.bincount(row, self.weights[at], rows)
        for k in range(self.factors.shape[1]):
            f = self.factors[at, k]
            z += 0.5 * (np.bincount(row, f, rows) ** 2 - np.bincount(row, f * f, rows))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _fit(batches):
    rows, labels = [], []
    for b in batches:
        data, at = textops.buffers(b.column("terms"))
        data, at = data.view("<u4"), at // 4
        rows += [data[lo:hi] for lo, hi in zip(at[:-1], at[1:])]
        labels.append(b.column("label").to_numpy())
    m = Machine.fit(rows, np.concatenate(labels) if labels else np.zeros(0, int))
    yield record(to_arrow_schema(MODEL), [m.bias], [m.terms.astype("<i8").tobytes()], [m.weights.astype("<f8").tobytes()], [m.factors.astype("<f8").tobytes()])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", rows: int = TRAIN_ROWS) -> Machine:
    """Fits on the labelled texts of ``labels``, of which about ``rows`` are drawn."""
    known = labels.select(F.col(label_id).alias("i"), F.col(label_col).cast("int").alias("label")).where("i is not null and label in (0, 1)")
    share = min(1.0, rows / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64("i"), F.lit(1_000_003)) < int(share * 1_000_003) + (share == 1))
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "i").select("label", "text")
    sample = stored(map_arrow(texts, _features, FEATURES), "labelled")
    model = map_arrow(sample.coalesce(1), _fit, MODEL).first()
    if model is None:  # no partition, so no rows
        return Machine.fit([], np.zeros(0, int))
    weights = np.frombuffer(model.weights, "<f8")
    return Machine(model.bias, np.frombuffer(model.terms, "<i8"), weights, np.frombuffer(model.factors, "<f8").reshape(len(weights), FACTORS))


def scored(docs: DataFrame, model: Machine, text_col: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a score column, which takes the place of one of that name."""
    docs = docs.drop(score)
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])

    def run(batches):
        arrow = to_arrow_schema(schema)
        for piece in textops.pieces(batches, text_col):
            row, term = _terms(piece.column(text_col))
            yield record(arrow, *piece.columns, model.scores(row, term, piece.num_rows))

    return map_arrow(docs, run, schema)


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted); labels of held-out ids are not used."""
    model = train(docs, labels.where(~held_out("doc_id", folds, fold)))
    out = scored(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
