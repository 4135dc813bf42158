"""The whole pipeline against its stages' own rules, recomputed in plain Python."""

import os
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cohortgraph.llm.common import documents, keep
from tests.llm.test_minhash import all_pairs

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def steps(spark):
    """Rows after each stage, as run() applies them."""
    docs, found = documents(spark, SF_DIR), []
    found.append(docs.collect())
    for _, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, SF_DIR), "step")
        found.append(docs.collect())
    return found


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_stages_keep_the_columns(spark, steps):
    assert all(list(rows[0].asDict()) == documents(spark, SF_DIR).columns for rows in steps[:-1])


def test_near_duplicates_leave_one_of_each_group(steps):
    before = [(r.doc_id, r.text) for r in steps[1]]
    expected = all_pairs(before, 5, 80)
    assert {r.doc_id for r in steps[2]} == {i for i, (n, c) in expected.items() if not n or i == c}


def test_substring_dedup_only_cuts(steps):
    before = {r.doc_id: r.text for r in steps[2]}
    assert {r.doc_id for r in steps[3]} == set(before)
    for r in steps[3]:
        rest = iter(words(before[r.doc_id]))
        assert r.n_chars == len(r.text) and all(w in rest for w in words(r.text))


def test_mix_meets_one_and_a_half_times_the_words(steps):
    n = [sum(len(words(r.text)) for r in rows) for rows in (steps[3], steps[4])]
    assert n[1] == pytest.approx(1.5 * n[0], rel=0.01)


def test_packing_holds_every_token_of_the_mix(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected, got = defaultdict(int), defaultdict(int)
    for r in steps[4]:
        ids = tokenizer.encode(r.text, add_special_tokens=False).ids
        expected[r.doc_id] += len(ids) + 1
    for r in steps[5]:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        got[r.doc_id] += r.length
    assert got == expected
    sequences = defaultdict(int)
    for r in steps[5]:
        sequences[r.sequence_id] += r.length
    sizes = np.array(list(sequences.values()))
    assert (sizes & (sizes - 1) == 0).all() and sizes.max() <= 4096


def test_run_equals_the_stages(spark, steps):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert sum(r.length for r in found.collect()) == sum(r.length for r in steps[5])
