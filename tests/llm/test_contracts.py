"""Columns of the queries' results against their plain definitions."""

import base64
import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from tallyflow.llm import language, lm, toxicity, warc

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TEXTS = [None, "", "One one two", "two\tthree\n", "é É one", "unseen words here", "a b c a b c", "one"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], ("en", "fr", None)[i % 3], None, "n") for i in range(40)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, held_out boolean, n_tokens string").repartition(3)


def fold(i, folds):
    return zlib.crc32(str(i).encode()) % folds


def test_language_model_base_columns(docs):
    words = {i: [*re.findall(r"[^\x20\x09-\x0D]+", (TEXTS[i % len(TEXTS)] or "").translate(LOWER)), None] for i in range(40)}
    count = collections.Counter(w for i, own in words.items() if fold(i, 7) != 2 for w in own)
    total, size = sum(count.values()), len(count)
    got = lm.score_all(docs).collect()
    assert len(got) == 40
    for r in got:
        own = words[r.doc_id]
        base = sum(np.log10((count[w] + 1) / (total + size + 1)) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(r.doc_id, 7) == 2, len(own), sum(count[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(base) and r.score <= 0
    empty = lm.score_all(docs.limit(0))
    assert empty.count() == 0


def test_held_out_rows_are_those_of_the_checksum(spark, docs):
    for r in language.predict(docs).collect():
        assert r.held_out == (fold(r.doc_id, 3) == 1)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id bigint, quality int, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == 40 and all(r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.5) for r in got)
    assert language.predict(docs.limit(0)).count() == toxicity.classify(docs.limit(0), labels).count() == 0


def test_warc_digests(spark):
    pages = spark.createDataFrame([(7, "http://a.example/", "<p>é"), (3, "http://b.example/", "<p>é"), (4, None, None), (9, "http://a.example/x", "z" * 70_000)], "page_id bigint, url string, html string")
    want = {i: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for i, _, h in pages.collect()}
    got = {r.page_id: r for r in warc.write_and_read(pages).collect()}
    assert {i: r.payload_digest for i, r in got.items()} == want
    assert (got[7].record_type, got[7].refers_to, got[3].record_type, got[3].refers_to) == ("revisit", 3, "response", None)
