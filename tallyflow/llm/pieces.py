"""Tokens of a sentencepiece BPE vocabulary, pre-token by pre-token.

Such a vocabulary merges a whole text as one sequence of characters, blanks included. But a merge only ever
makes a vocabulary piece, so two neighbouring characters that stand next to each other in no piece are never
in one token: whatever is left of that place and whatever is right of it merge as if alone. ``Pieces.joins``
holds the neighbouring pairs that do occur, and a text is cut at all others. No piece has a blank behind
another character, so this cuts at least before every run of blanks.

The same holds for ``single``: the pieces for which the merges, run on the piece's own characters, end in one
token. A pre-token equal to one of them is one token wherever it stands.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tallyflow.llm import textops

BLANK = "▁"
_TOP = 0x110000


@dataclass
class PreTokens:
    """Pre-tokens in text order: byte range in ``data``, row, hash."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray


class Pieces:
    """A sentencepiece BPE model that neither normalises nor has symbols of its own; others are refused."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kind = pb.ModelProto.SentencePiece
        norm, train = model.normalizer_spec, model.trainer_spec
        plain = norm.add_dummy_prefix and norm.escape_whitespaces and not (norm.remove_extra_whitespaces or norm.precompiled_charsmap or norm.normalization_rule_tsv)
        if train.model_type != pb.TrainerSpec.BPE or not plain or train.treat_whitespace_as_suffix or any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
            raise ValueError(f"{path}: not a plain BPE model with byte fallback")
        self.id = {p.piece.replace(BLANK, " "): i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.score = {p.piece.replace(BLANK, " "): p.score for p in model.pieces if p.type == kind.NORMAL}
        letters = sorted({c for t in self.id if len(t) > 1 for c in t})
        #: number of each character that occurs in a longer piece; 0 for all others
        self.letter = np.zeros(_TOP, np.uint16 if len(letters) < 65535 else np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        at = {c: k for k, c in enumerate(letters, 1)}
        self.joins = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for t in self.id:
            for a, b in zip(t, t[1:]):
                self.joins[at[a], at[b]] = True
        self.single = {t.encode() for t in self.id if self.merge(t) == [t]}

    def merge(self, text: str) -> list[str]:
        """Symbols of a text with blanks for blanks: the pair of the highest score first, of equal ones the leftmost."""
        score = self.score
        if len(text) < 2:
            return [text] if text else []
        symbol: list[str | None] = list(text)
        n = len(symbol)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(-score[p], i, i + 1, 2) for i in range(n - 1) if (p := text[i : i + 2]) in score]
        heapq.heapify(agenda)
        while agenda:
            _, i, j, size = heapq.heappop(agenda)
            if symbol[i] is None or symbol[j] is None or right[i] != j or len(symbol[i]) + len(symbol[j]) != size:
                continue  # one of the two has been merged since
            symbol[i] += symbol[j]
            symbol[j] = None
            k = right[i] = right[j]
            if k < n:
                left[k] = i
            for a, b in ((left[i], i), (i, k)):
                if a >= 0 and b < n and (p := symbol[a] + symbol[b]) in score:
                    heapq.heappush(agenda, (-score[p], a, b, len(p)))
        return [s for s in symbol if s is not None]

    def count(self, text: str) -> int:
        """Tokens of a pre-token; a character outside the vocabulary is one token a byte."""
        return sum(1 if s in self.score else len(s.encode()) for s in self.merge(text))

    def pretokens(self, texts: pa.Array) -> PreTokens:
        """Pre-tokens of texts that begin with the blank the model adds, with plain blanks for the model's."""
        data, offsets = textops.buffers(texts)
        n = len(data)
        if not n:
            none = np.zeros(0, np.int64)
            return PreTokens(data, none, none, none, none.astype(np.uint64))
        if data.max() < 0x80:
            points, at = data, None
        else:
            points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
            at = np.flatnonzero((data & 0xC0) != 0x80)  # where each character begins
        letter = self.letter[points]
        cut = np.ones(len(points), bool)
        cut[1:] = ~self.joins[letter[:-1], letter[1:]]
        bounds = offsets[:-1][np.diff(offsets) > 0]
        if at is None:
            cut[bounds] = True
            start = np.flatnonzero(cut)
        else:
            cut[np.searchsorted(at, bounds)] = True
            start = at[cut]
        end = np.append(start[1:], n)
        row = np.searchsorted(offsets, start, side="right") - 1
        return PreTokens(data, start, end, row, textops._hashes(data, start, end))
