"""Packing against the whole tokenizer, and the packer on random lengths."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortgraph.llm.packing import END, TOKENIZER, WINDOWS, Packer, Words

TEXTS = [
    None, "", "It's the naïve CAFÉ, isn't it? 12,345!! __x__ a×b ÷", "<|endoftext|> and x<|endoftext|>y", "é İstanbul ΣΑΣ ς",
    "nbsp between   wide", "日本語 テキスト", "\x1c\x1d ctrl \x07 bell", "tab\tnew\nline\r\x0b\x0cend", "¹²³ ª º µ ½", "x" * 5000, "🙂🙂 ok",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(TOKENIZER))


@pytest.mark.parametrize("text", TEXTS)
def test_words_equal_the_whole_tokenizer(tokenizer, text):
    words = Words(public_tokenizers.path(TOKENIZER))
    expected = [*tokenizer.encode(text or "", add_special_tokens=False).ids, END]
    assert words.encode((text or "").encode()).tolist() == expected


def covered(spans):
    end = 0
    for start, length in sorted(spans):
        assert start == end and length > 0
        end += length
    return end


@pytest.mark.parametrize("seed", range(8))
def test_packer_keeps_every_token_once_without_padding(seed):
    draw = random.Random(seed)
    packer = Packer()
    lengths = {i: draw.choice([1, 5, 300, 511, 512, 513, 900, 3000, 4096, 4097, 9000]) for i in range(draw.randrange(1, 120))}
    chunks = [list(lengths.items())[i::3] for i in range(3)]
    windows = [w for chunk in chunks for w in packer.pack(chunk)]
    assert all(w in WINDOWS for w, _ in windows)
    windows += packer.tail()
    spans = defaultdict(list)
    for window, pieces in windows:
        assert sum(p[0] for p in pieces) == window and window & (window - 1) == 0
        for length, doc, start in pieces:
            spans[doc].append((start, length))
    assert {d: covered(s) for d, s in spans.items()} == lengths


def test_query_round_trip(spark, run, tables, odd_documents, tokenizer):
    rows = [r for r in odd_documents.collect() if r.doc_id is not None][:-1]
    folder = tables(documents=spark.createDataFrame(rows, odd_documents.schema))
    pieces, sequences = defaultdict(list), defaultdict(list)
    ids = {r.doc_id: np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, END], "<u4") for r in rows}
    for r in run("op1_packing", folder).collect():
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {d: covered(s) for d, s in pieces.items()} == {d: len(x) for d, x in ids.items()}
    assert all(covered(s) in [2**k for k in range(13)] for s in sequences.values())
