"""Token counts of whole texts without tokenising most of them.

Texts are cut into pre-tokens at places no merge can cross (see ``pieces``). Which vocabulary strings encode
alone as one token is proved once for each model; a pre-token that is such a string counts one, by its bytes.
Only the other distinct pre-tokens are merged, and each task keeps the counts of up to ``HELD_BYTES`` of them;
a full table starts again empty, so it bounds memory and changes no count.

One pass, no shuffle. Null and empty texts have no tokens; a repeated or null id is a row like any other. Very
long texts are one piece, handled alone. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyflow.llm import textops
from tallyflow.llm.pieces import BLANK, Pieces
from tallyflow.llm.tasks import batch as record
from tallyflow.llm.tasks import map_arrow

#: bytes of merged pre-tokens that a task remembers
HELD_BYTES = 64 << 20
PIECE = 2 << 20
LIMIT = 4096


class Counter:
    """Tokens of texts, and how many of them were counted as whole pre-tokens."""

    def __init__(self, model: Pieces):
        self.model, self.held, self.size = model, {}, 0

    def _merged(self, word: bytes) -> int:
        n = self.held.get(word)
        if n is None:
            if self.size > HELD_BYTES:
                self.held, self.size = {}, 0
            n = self.held[word] = self.model.count(word.decode())
            self.size += len(word) + 100
        return n

    def texts(self, texts) -> tuple[np.ndarray, np.ndarray]:
        p = self.model.pretokens(texts)
        _, at, word, many = np.unique(p.hash, return_index=True, return_inverse=True, return_counts=True)
        raw, single = p.data.tobytes(), self.model.single
        n, whole = np.ones(len(at), np.int64), np.ones(len(at), np.int64)
        for k, (lo, hi) in enumerate(zip(p.start[at].tolist(), p.end[at].tolist())):
            own = raw[lo:hi]
            if own not in single:
                n[k], whole[k] = self._merged(own), 0
        word = word.ravel()
        rows = len(texts)
        sums = lambda x: np.bincount(p.row, x[word], rows).astype(np.int64)
        return sums(n), sums(whole)


def counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, n_whole) per row: bytes in UTF-8, tokens, and tokens counted as whole pre-tokens."""
    out = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_tokens", "n_whole"))])
    text = F.coalesce(F.col(text_col), F.lit(""))
    seen = F.when(text == "", "").otherwise(F.concat(F.lit(" "), F.replace(text, F.lit(BLANK), F.lit(" "))))

    def run(batches):
        counter, arrow = Counter(Pieces(model_path)), to_arrow_schema(out)
        for piece in textops.pieces(batches, "seen", PIECE):
            n, whole = counter.texts(piece.column("seen"))
            yield record(arrow, piece.column("doc_id"), piece.column("n_bytes"), n, whole)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("bigint").alias("n_bytes"), seen.alias("seen"))
    return map_arrow(rows, run, out)


def limited(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """Counts with a mark on the texts of more than ``limit`` tokens."""
    return counts(docs, model_path).withColumn("over_limit", F.col("n_tokens") > limit)
