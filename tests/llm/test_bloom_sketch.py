"""Fingerprints: edits and hashes against plain Python, likeness against sets."""

import hashlib
import random

import numpy as np
import pytest

from cohortgraph.llm.bloom_sketch import fingerprinted, likeness, parts


def corpus():
    draw = random.Random(3)
    word = lambda: "".join(draw.choices("abcé", k=3))
    texts = [" ".join(word() if draw.random() < 0.9 else word() + "\n" for _ in range(draw.choice([0, 1, 5, 60, 900]))) for _ in range(70)]
    ids = draw.sample(range(-50, 1000), len(texts))
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("width", ["1", "7"])
def test_equals_plain_python(spark, width):
    docs = corpus()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        found = {r.doc_id: r for r in fingerprinted(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == len(docs)
    ordered = sorted(docs, reverse=True)
    for (doc_id, text), (next_id, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        row, cut = found[doc_id], len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (set(p.tolist()) for p in parts([text, edited, following]))
        jaccard = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert row.near_edited == pytest.approx(jaccard(a, b)) and row.near_next == pytest.approx(jaccard(a, c))
        assert (row.fingerprint == found[next_id].fingerprint) == (a == c)


def test_single_document_is_its_own_next(spark):
    [row] = fingerprinted(spark.createDataFrame([(5, "a b c d e f")], "doc_id long, text string")).collect()
    assert row.near_next == 1.0 and row.n_chars == 11


def test_likeness_of_random_sets():
    draw = np.random.default_rng(1)
    left = [np.unique(draw.integers(0, 2**63, n, np.uint64)) for n in (0, 0, 1, 10, 500, 5000)]
    right = [s[: len(s) // 2] for s in left]
    right[1] = left[3]
    expected = [1.0, 0.0, 0.0, 0.5, 0.5, 0.5]
    assert likeness(left, right).tolist() == expected
    assert likeness(left, left).tolist() == [1.0] * 6
