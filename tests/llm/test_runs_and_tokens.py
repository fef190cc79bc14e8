"""Word runs against brute force, token counts against the library, aligned tokens against a plain walk over bytes."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyflow.llm import queries, token_alignment, token_counts, word_runs
from tallyflow.llm.pieces import Pieces
from tests.oracle import SF_DIR

SPACED = r"[^\x20\x09-\x0D]+"
PIECES, BYTES = queries.tokenizer("piece_bpe_32k.model"), queries.tokenizer("byte_bpe_50k.json")
ODD = [" ", "  ", "a", "th", "the", " the", "\n", "\t", "é", "中", "文", "😀", "x" * 7, "1", "12", "<s>", "<unk>", "<|endoftext|>", "\x00", "\x85", ".", ",", "'", "İ", "ａ", "́"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    words = ["".join(rng.choice("aeioubcdfg") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    out = [None, "", " \n\t ", "one", "a a a a a a", "▁a b", "a▁ b", "x" * 3000, " " * 50, " ".join(rng.choice(words) for _ in range(4_000)), " ".join(words[:40] * 30)]
    out += ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(120)]
    out += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(60)]
    return out + ["many copies of one text"] * 70


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "key", 3, [1], 0.5) for i, t in enumerate(texts)] + [(5, "an id twice", "k", 1, None, 0.0), (None, "no id id id id id id", "k", 1, None, 0.0), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, key string, n_tokens int, runs array<int>, copies double").repartition(3)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def runs_of(words, least=6, factor=4):
    """All runs, by comparing the words at every distance."""
    out = []
    for q in range(1, len(words) // factor + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, factor * q) and not any(words[i : j + q - d] == words[i + d : j + q] for d in range(1, q)):
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize(("least", "factor"), [(6, 4), (3, 3), (9, 5)])
def test_runs_are_those_of_brute_force(least, factor):
    rng, texts = random.Random(least), []
    for _ in range(1500):
        own, letters = [], rng.choice(["ab", "abc", "abcdef"])
        for _ in range(rng.randint(1, 5)):
            block = [rng.choice(letters) for _ in range(rng.randint(1, 6))]
            own += block * rng.choice([1, 1, 2, 3, 4, 5, 7]) + block[: rng.randint(0, len(block))]
        texts.append(" ".join(own))
    got = word_runs.Finder(least, factor).texts(pa.array(texts))
    assert sum(map(len, got)) > 500
    for t, found in zip(texts, got):
        assert found == runs_of(t.split(), least, factor) == word_runs.stretch_runs([ord(w) for w in t.split()], least, factor), t
    with pytest.raises(ValueError):
        word_runs.Finder(6, 2)


def test_runs_of_extreme_texts():
    finder = word_runs.Finder()
    fib = ["a", "ab"]
    while len(fib[-1]) < 4000:
        fib.append(fib[-1] + fib[-2])
    texts = ["z " * 30_000, " ".join(f"w{k}" for k in range(3000)), " ".join([f"w{k}" for k in range(3000)] * 5), " ".join(fib[-1]), " ".join(["a a a a a a b"] * 500)]
    got = finder.texts(pa.array(texts))
    assert got[:4] == [[(0, 30_000, 1)], [], [(0, 15_000, 3000)], []]  # the exponents of a Fibonacci word stay under 4
    assert len(got[4]) == 501 and (0, 3500, 7) in got[4]


def test_segments_are_last_occurrences():
    """Each access gives the last end of every suffix that has ended before."""
    rng = random.Random(4)
    for _ in range(60):
        words = [rng.randint(1, 2 + rng.randrange(3)) for _ in range(40)]
        automaton = word_runs.Automaton(len(words))
        for i, word in enumerate(words):
            seen = {}
            for d, size in automaton.append(word, i):
                assert seen.setdefault(size, d) == d
            for length in range(1, i + 2):
                ends = [e for e in range(length - 1, i) if words[e - length + 1 : e + 1] == words[i - length + 1 : i + 1]]
                found = [seen[s] for s in sorted(seen) if s >= length][:1]
                assert ([i - max(ends)] if ends else []) == found


def test_op11_query(spark, docs):
    want = []
    for r in docs.collect():
        words = re.findall(SPACED, r.text or "")
        n = len(words)
        if r.doc_id is not None and n and (h := zlib.crc32(str(r.doc_id).encode())) % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = runs_of(words)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        short = " ".join(w for i, w in enumerate(words) if i not in dropped)
        want.append((r.doc_id, len(runs), *best, runs and 1000 * best[1] // best[2] or None, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(short)))
    find = lambda d: word_runs.digest(word_runs.repeats(word_runs.planted(d)))
    found = find(docs)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert rows_of(found) == sorted(want, key=str) and sum(w[1] > 0 for w in want) > 5
    assert find(docs.limit(0)).count() == 0
    plain = {r.doc_id: r for r in word_runs.repeats(docs.where("doc_id is not null")).collect()}
    assert plain[4].collapsed == "a" and [tuple(x) for x in plain[4].runs] == [(0, 6, 1)] and plain[0].collapsed == "" and plain[0].runs == []


def test_whole_pieces_are_proved_and_counts_are_the_library(spark, docs, monkeypatch):
    from sentencepiece import SentencePieceProcessor

    sp, model = SentencePieceProcessor(model_file=PIECES), Pieces(PIECES)
    for piece in model.single:
        text = piece.decode()
        if text.startswith(" ") and len(text) > 1:  # the model adds the first blank itself
            assert len(sp.encode(text[1:])) == 1, text
    assert b" the" in model.single and model.count("\n") == 1 and model.count("\U00013000") == 4
    monkeypatch.setattr(token_counts, "HELD_BYTES", 3000)  # the table starts again many times
    want = []
    for r in docs.collect():
        n = len(sp.encode(r.text or ""))
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 4096))
    got = token_counts.limited(docs, PIECES)
    assert rows_of(got.select("doc_id", "n_bytes", "n_tokens", "over_limit")) == sorted(want, key=str)
    assert any(w[3] for w in want) and got.where("n_whole > n_tokens or n_whole < 0").count() == 0
    assert got.agg(F.sum("n_whole")).first()[0] > 4_000
    assert token_counts.limited(docs.limit(0), PIECES).count() == 0


def test_a_pair_of_no_piece_parts_the_text():
    model = Pieces(PIECES)
    p = model.pretokens(pa.array([" one two.\nThree", " ", "", " 中文  a"]))
    raw = p.data.tobytes()
    words = [raw[s:e].decode() for s, e in zip(p.start, p.end)]
    assert "".join(words) == " one two.\nThree  中文  a"
    assert words[:2] == [" one", " two"] and "\n" in words
    assert p.row.tolist() == sorted(p.row.tolist()) and set(p.row.tolist()) == {0, 1, 3}


def test_token_counts_of_the_table(spark):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: r for r in queries.QUERIES["op12_token_counts"](spark, SF_DIR).collect()}
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        assert (got[r.doc_id].n_bytes, got[r.doc_id].n_tokens) == (len((r.text or "").encode()), len(sp.encode(r.text or "")))


def groups_of(v, library, text):
    """Groups of one text, by walking over the ends of its tokens."""
    a, b = ([], []) if not text else (library.encode(" " + text, add_special_tokens=False).ids, v.b_file.encode(text))
    want = (" " + (text or "")).encode()
    if b"".join(v.a[i] for i in a) != want or b"".join(v.b[i] for i in b) != want:
        return []
    out, i, j, ends = [], 0, 0, ([], [])
    x = y = 0
    while i < len(a) or j < len(b):
        if x <= y and i < len(a):
            x += len(v.a[a[i]])
            ends[0].append(a[i])
            i += 1
        else:
            y += len(v.b[b[j]])
            ends[1].append(b[j])
            j += 1
        if x == y and ends[0] and ends[1]:
            out.append(ends)
            ends = ([], [])
    return out


@pytest.mark.parametrize("hot", [token_alignment.HOT, 3])
def test_alignment(spark, docs, monkeypatch, hot):
    monkeypatch.setattr(token_alignment, "HOT", hot)
    v = token_alignment.Files(BYTES, PIECES)
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    rows = docs.select("doc_id", "text").collect()
    groups = {r.text: groups_of(v, library, r.text) for r in rows}
    count = collections.Counter((a[-1], b[-1]) for r in rows for a, b in groups[r.text])
    highest = collections.Counter()
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    want = []
    for r in rows:
        g = groups[r.text]
        links = [(a[-1], b[-1]) for a, b in g]
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        sums = sum(count[x] == highest[x[1]] for x in links), sum(count[x] for x in links)
        want.append((r.doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(g), *sums, hashlib.sha256(written.encode()).hexdigest() if g else ""))
    found = token_alignment.Alignment(docs, BYTES, PIECES)
    assert rows_of(found.per_document()) == sorted(want, key=str)
    assert {(r.a, r.b): r.n for r in found.pair_counts().collect()} == count
    real = {bytes(r.key): [(x.a, x.b) for x in r.groups] for r in found.groups().collect()}
    for t, g in groups.items():
        if t:
            assert real[hashlib.sha256(t.encode()).digest()] == g
    assert found.distinct_tokens().count() == len([t for t in groups if t])  # each text once
    assert [w for w in want if w[0] == 5 and w[1] == 0]  # a text with the blank sign has no tokens
    assert token_alignment.Alignment(docs.limit(0), BYTES, PIECES).per_document().count() == 0


def test_pairs_that_can_be_linked_are_bounded_by_the_files():
    f = token_alignment.Files(BYTES, PIECES)
    v = token_alignment.Vocabularies(f.a, f.b)
    assert 0 < len(v.pairs) <= sum(map(len, f.a)) + sum(map(len, f.b))
    a, b = v.pairs // len(f.b), v.pairs % len(f.b)
    assert all(f.a[i].endswith(f.b[j]) or f.b[j].endswith(f.a[i]) for i, j in zip(a[::97].tolist(), b[::97].tolist()))


def test_merging_by_ranks_is_the_library():
    """On characters of every kind; and a file with an entry that its own merges do not reach is not proved."""
    files, library = token_alignment.Files(BYTES, PIECES), Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    assert files.proved
    points = [c for c in range(0, 0x110000, 23) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}1{c} {c}{c}! '{c}  {c} " for c in map(chr, points)]
    for t, e in zip(texts, library.encode_batch([" " + t for t in texts], add_special_tokens=False)):
        assert files._a_ids(" " + t).tolist() == e.ids, repr(t)
    vocab = {t: i for t, i in library.get_vocab(with_added_tokens=False).items() if i < 50256}
    assert files._proved(BYTES, library, vocab)
    assert not files._proved(BYTES, library, vocab | {"Ġthequick": vocab["Ġthe"]})
    slow = token_alignment.Files(BYTES, PIECES, proved=False)
    assert slow.encode(texts[:300]) == files.encode(texts[:300])
