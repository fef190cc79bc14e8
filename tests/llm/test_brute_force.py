"""Operators and the pipeline's stages against plain Python, on fixtures and on whole test tables."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyflow.llm import jaccard_join, language, line_dedup, queries, toxicity
from tests.oracle import SF_DIR

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def similar(texts):
    """(class, number of links) of each id, from an exact prefix-filter join of the distinct shingle sets."""
    members = collections.defaultdict(list)
    for i, t in texts.items():
        members[shingles(t)].append(i)
    members.pop(frozenset(), None)
    number = {x: k for k, x in enumerate(set().union(*members))}
    rare = collections.Counter(number[x] for s in members for x in s)
    sets = sorted((sorted((number[x] for x in s), key=lambda k: (rare[k], k)), own) for s, own in members.items())
    index, links, root = collections.defaultdict(list), collections.Counter(), list(range(len(sets)))
    whole = [frozenset(s) for s, _ in sets]

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    pairs = 0
    for k, (s, own) in enumerate(sets):
        prefix = s[: len(s) - math.ceil(0.8 * len(s)) + 1]
        for j in {j for x in prefix for j in index[x]}:
            both = len(whole[k] & whole[j])
            if 10 * both >= 8 * (len(whole[k]) + len(whole[j]) - both):
                pairs += 1
                links[k] += len(sets[j][1])
                links[j] += len(own)
                root[max(top(k), top(j))] = min(top(k), top(j))
        for x in prefix:
            index[x].append(k)
    low = {}
    for k, (_, own) in enumerate(sets):
        low[top(k)] = min([low.get(top(k), min(own)), *own])
    found = {i: (i, 0) for i in texts}
    for k, (_, own) in enumerate(sets):
        found |= {i: (low[top(k)], links[k] + len(own) - 1) for i in own}
    return found, pairs


def test_join_finds_nearly_all_pairs_of_the_largest_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    want, pairs = similar({r.doc_id: r.text for r in docs.collect()})
    got = {r.id: (r.class_id, r.n_links) for r in jaccard_join.similar(docs).collect()}
    assert got.keys() == want.keys() and pairs > 30
    assert all(n <= want[i][1] for i, (_, n) in got.items())  # what is found is exact
    assert sum(n for _, n in got.values()) >= 0.99 * sum(n for _, n in want.values())
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)


def test_close_sets_leave_no_candidate_behind():
    rng = np.random.default_rng(3)
    coords, near = jaccard_join.COORDS, 0
    for _ in range(3000):
        pivot = rng.integers(0, 1 << 20, coords)
        gone = np.where(rng.random(coords) < 0.06, rng.integers(0, 1 << 20, coords), pivot)
        other = np.where(rng.random(coords) < 0.35, rng.integers(0, 1 << 20, coords), gone)
        if np.mean(gone == pivot) >= jaccard_join.CLOSE and np.mean(other == gone) >= jaccard_join.NEAR:
            near += 1
            assert np.mean(other == pivot) >= jaccard_join.PIVOT
    assert near > 100


def plain_grams(text):
    folded = re.sub(rb"[^a-z\x80-\xff]+", b" ", b" " + text.lower().encode() + b" ") + b" "  # so the shortest text has one
    return [g for k in range(len(folded) - 3) if (g := folded[k : k + 4])[1:3] != b"  "]


def test_language_masks_hold_all_languages_of_an_n_gram(spark):
    rng = random.Random(6)
    sounds = {"aa": "kato mire sulo", "bb": "kato vexi drun", "cc": "zyph mire qorl"}  # each two share a word
    text = lambda lang, n: " ".join(rng.choice(sounds[lang].split()) + rng.choice(["", "n", "s"]) for _ in range(n))
    learn = [(lang, text(lang, 60)) for lang in sounds for _ in range(20)] + [(None, "zzzz"), ("aa", None)]
    counts = {lang: collections.Counter(g for own, t in learn if own == lang for g in plain_grams(t or "")) for lang in sounds}
    holds = {lang: {g for g, n in c.items() if n >= language.LEAST_RATE * c.total()} for lang, c in counts.items()}
    learned = language.learn(spark.createDataFrame(learn, "lang string, text string").repartition(4))
    for g in set().union(*holds.values()):
        mask = learned.counts(np.array([int.from_bytes(g, "big")], np.uint32), np.zeros(1, int), 1)[0] > 0
        assert {x for x, on in zip(learned.langs, mask) if on} == {x for x in sounds if g in holds[x]}, g
    asked = [text(rng.choice([*sounds]), rng.randint(3, 30)) for _ in range(60)] + ["Kato, KATO!", "mire 12", "unknown wörds"]
    got = {r.id: r for r in language.identify(spark.createDataFrame(list(enumerate(asked)), "doc_id bigint, text string"), learned).collect()}
    for i, t in enumerate(asked):
        n = {x: sum(g in holds[x] for g in plain_grams(t)) for x in sorted(sounds)}
        share = max(n.values()) / max(1, sum(n.values()))
        assert got[i].score == pytest.approx(share, abs=1e-6), t
        if sorted(n.values())[-1] > sorted(n.values())[-2]:
            assert got[i].lang_pred == max(n, key=n.get), t


def plain_score(model, terms):
    """Bias, weights and the products of all pairs of the terms that the model knows."""
    place = {int(t): k for k, t in enumerate(model.terms)}
    own = [place[t] for t in terms if t in place]
    z = model.bias + sum(model.weights[k] for k in own) + sum(float(model.factors[a] @ model.factors[b]) for a, b in itertools.combinations(own, 2))
    return 1 / (1 + math.exp(-z))


def terms_of(text):
    return {int(x) for x in toxicity._terms(pa.array([text]))[1]}


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that go into each stage and come out of it, on the test table."""
    docs, done = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF_DIR).cache()
        done[name] = ({r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in docs.collect()})
        assert docs.count() == len(done[name][1])
    return done


def test_toxicity_stage_scores_every_pair_of_terms(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = toxicity.train(spark.read.parquet(f"{SF_DIR}/documents.parquet"), labels.where(~toxicity.held_out("doc_id", 5, 0)))
    same = terms_of("Some words, SOME other")
    assert len(same) == 3 and same == terms_of("other some words")
    for i, r in before.items():
        score = plain_score(model, terms_of(r.text))
        assert abs(score - 0.5) < 1e-6 or (i in after) == (score < 0.5), (i, score)
    assert all(after[i] == before[i] for i in after) and len(after) < len(before)


def test_line_stage(stages):
    before, after = stages["line_dedup"]
    pages = collections.defaultdict(set)
    for r in before.values():
        if r.text is not None:
            pages[r.source].add(r.text)
    seen = {h: collections.Counter(x for t in own for x in set(t.split("\n")) if x.strip(" ")) for h, own in pages.items()}
    bad = lambda h, x: seen[h][x] >= line_dedup.LEAST_PAGES and seen[h][x] > line_dedup.RATIO * len(pages[h])
    changed = 0
    assert after.keys() == before.keys()
    for i, r in before.items():
        text = None if r.text is None else "\n".join(x for x in r.text.split("\n") if not bad(r.source, x))
        changed += text != r.text
        assert after[i].text == text and after[i].n_chars == (None if text is None else len(text)), i
    assert changed > 10


def test_near_copy_stage(stages):
    before, after = stages["near_copies"]
    found, _ = similar({i: r.text for i, r in before.items()})
    assert after == {i: r for i, r in before.items() if found[i][0] == i} and len(after) < len(before)


def test_benchmark_stage(spark, stages):
    before, after = stages["decontamination"]
    cut = lambda t: [(m[0], m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))]
    windows = set()
    for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        w = [x for x, *_ in cut(r.text)]
        windows |= {tuple(w[k : k + 10]) for k in range(len(w) - min(10, len(w)) + 1 if w else 0)}
    sizes, changed = {len(x) for x in windows}, 0
    assert after.keys() == before.keys()
    for i, r in before.items():
        w = cut(r.text)
        words = [x for x, *_ in w]
        hit = {j for n in sizes for k in range(len(w) - n + 1) if tuple(words[k : k + n]) in windows for j in range(k, k + n)}
        if not hit:
            assert after[i] == r
            continue
        changed += 1
        left, text = [x for k, x in enumerate(words) if k not in hit], after[i].text
        assert [x for x, *_ in cut(text)] == left and after[i].n_chars == len(text), i
    assert changed > 5


def test_token_stage(stages):
    before, after = stages["bpe"]
    tokenizer = Tokenizer.from_file(queries.tokenizer())
    assert after.keys() == before.keys()
    for i, r in before.items():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        assert tuple(after[i]) == (*r, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()), i
