"""Pre-tokens of whole texts for tokenizer files with word ends, in numpy.

Follows the file's own steps: special tokens are cut out of the raw text, the rest is composed (NFC) and
lower-cased, then cut into contractions, letter runs, single digits and runs of other characters; white
space is dropped.
"""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex

from tallyflow.llm import textops

SPACE, LETTER, DIGIT, OTHER, SPECIAL = range(5)
_TOP = 0x110000
_classes: dict[str, np.ndarray] = {}

#: contractions that are cut off a word: an apostrophe and one or two letters (fixed values of the format)
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")


def _class_of() -> np.ndarray:
    """Class of each code point."""
    if "of" not in _classes:
        out = np.full(_TOP, OTHER, np.uint8)
        every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, _TOP)))
        for kind, pattern in ((SPACE, r"\p{White_Space}+"), (LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+")):
            for m in regex.finditer(pattern, every):
                points = np.frombuffer(m.group().encode("utf-32-le"), np.uint32)
                out[points] = kind
        _classes["of"] = out
    return _classes["of"]


@dataclass
class PreTokens:
    """Pre-tokens in text order: row, hash, byte range in ``data``; ``special`` is the id of a special token, else -1."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    special: np.ndarray


def normal(text: str) -> str:
    if text.isascii():
        return text.lower()
    # one character at a time, so a final sigma is an ordinary one
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def pretokens(texts: pa.Array, specials: dict[str, int]) -> PreTokens:
    cut = regex.compile("(" + "|".join(map(regex.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
    names = list(specials)
    firsts = {x[:2] for x in names}
    parts: list[str] = []
    rows: list[int] = []
    marks: list[int] = []
    for row, text in enumerate(texts.to_pylist()):
        if not text:
            continue
        if any(x in text for x in firsts):
            for k, part in enumerate(cut.split(text)):
                parts.append("\x00" if k % 2 else normal(part))
                marks.append(specials[part] if k % 2 else -1)
                rows.append(row)
        else:
            parts.append(normal(text))
            marks.append(-1)
            rows.append(row)
    whole = "".join(parts)
    cp = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    n = len(cp)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    kind = _class_of()[cp]
    special = np.flatnonzero(np.array(marks, np.int64) >= 0)
    kind[bounds[special]] = SPECIAL
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    fresh = first[:n].copy()
    fresh[1:] |= kind[1:] != kind[:-1]
    fresh |= (kind == DIGIT) | (kind == SPECIAL)
    begin = fresh & (kind != SPACE)

    # an apostrophe that is a run of its own, with letters of the same text behind it
    q = np.flatnonzero((cp == 39) & begin)
    q = q[q + 1 < n]
    q = q[(kind[q + 1] == LETTER) & ~first[q + 1]]
    after = np.append(cp, np.zeros(2, np.uint32))
    two = np.zeros(len(q), bool)
    for a, b in TWO_LETTERS:
        two |= (after[q + 1] == ord(a)) & (after[q + 2] == ord(b))
    two &= ~first[np.minimum(q + 2, n)]
    one = np.isin(after[q + 1], [ord(c) for c in ONE_LETTER])
    begin[q[one | two] + 1] = False
    follow = np.concatenate([q[one] + 2, q[two & ~one] + 3])
    follow = follow[follow < n]
    follow = follow[(kind[follow] == LETTER) & ~first[follow]]
    begin[follow] = True

    edges = np.flatnonzero(np.append(begin | (kind == SPACE) | first[:n], True))
    start = np.flatnonzero(begin)
    end = edges[np.searchsorted(edges, start, side="right")] if n else start
    row = np.array(rows, np.int64)[np.searchsorted(bounds, start, side="right") - 1] if n else start
    mark = np.full(len(start), -1, np.int64)
    mark[np.searchsorted(start, bounds[special])] = np.array(marks, np.int64)[special]
    # from here on only the cuts are needed, in bytes
    del after, edges, first, fresh, begin, kind
    at = np.zeros(n + 1, np.int64)
    np.cumsum(np.uint8(1) + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000), out=at[1:])
    start, end = at[start], at[end]
    del cp, at
    data = np.frombuffer(whole.encode(), np.uint8)
    return PreTokens(data, start, end, row, textops._hashes(data, start, end), mark)


@dataclass
class WordFile:
    """What a tokenizer file of this kind holds."""

    vocab: dict[str, int]
    merges: list[tuple[str, str]]
    specials: dict[str, int]
    suffix: str


def read_file(path: str) -> WordFile:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    return WordFile(spec["model"]["vocab"], merges, {t["content"]: t["id"] for t in spec["added_tokens"]}, spec["model"]["end_of_word_suffix"])


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints, else the next one from 256 on."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out
