"""Repeated lines and passages against a plain loop."""

import importlib
import random
from collections import Counter

import pytest

from cohortgraph.llm.common import content_key
from cohortgraph.llm.lines import dedup_units, digest, runs, stage, units


def plain(docs):
    seen, kept = {}, {}
    for doc_id, text in sorted(docs):
        spans = [(a, b, digest(" ".join(text[a:b].lower().split()).encode())) for a, b in units(text or "")]
        cuts = [(a, b, seen[d]) for a, b, d in spans if d in seen or seen.setdefault(d, doc_id) is None]
        kept[doc_id] = cuts
    return kept


def passage(draw, n):
    return " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(n))


def corpus(seed):
    draw = random.Random(seed)
    shared = [passage(draw, 60) + "." for _ in range(5)] + ["Short. " * 3 + passage(draw, 20) + ". Yes. No."]
    docs = []
    for i in range(80):
        lines = [passage(draw, draw.randint(1, 40)) + draw.choice([".", "", "!"]) for _ in range(draw.randint(0, 6))]
        if draw.random() < 0.5:
            lines.insert(draw.randint(0, len(lines)), draw.choice(shared))
        docs.append((i, draw.choice(["\n", "\n\n", " "]).join(lines)))
    return docs


def test_units_cover_text_in_order():
    text = "One two three four five six seven eight. Nine. Ten.\nshort line\n" + "a b c d e f g h i. " * 2 + "end"
    found = units(text)
    assert [text[a:b] for a, b in found] == [
        "One two three four five six seven eight. Nine. Ten.\n", "a b c d e f g h i. ", "a b c d e f g h i. end"
    ]
    assert units("") == [] and units("too short. yes.") == []


def test_equals_a_plain_loop(spark):
    docs = corpus(1)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("_row", content_key())
    found = {r.doc_id: [(s.start, s.end, k) for s, k in zip(r._spans, r._kept_in)] for r in dedup_units(df).collect()}
    assert found == plain(docs) and any(found.values())


def test_units_and_cuts_are_not_broadcast(spark, monkeypatch):
    plans = []
    planned = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    lines = importlib.import_module("cohortgraph.llm.lines")
    keep = lines.keep
    monkeypatch.setattr(lines, "keep", lambda df, name: (planned(df), keep(df, name))[1])
    docs = spark.createDataFrame(corpus(2), "doc_id long, text string").withColumn("_row", content_key())
    planned(dedup_units(docs))
    assert sum("SortMergeJoin" in p for p in plans) == 2 and not [p for p in plans if "Broadcast" in p]


def test_a_passage_inside_other_lines_stays_once(spark):
    draw = random.Random(2)
    shared = ". ".join(passage(draw, 15) for _ in range(4)) + "."
    docs = [(i, f"{passage(draw, 12)} {shared} {passage(draw, 9)}.\n{passage(draw, 20)}", None, None, 0) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    rows = {r.doc_id: r for r in stage(spark, df, "").collect()}
    core = shared.split(". ")[1:3]
    assert all(part in rows[0].text for part in core)
    assert not any(part in rows[i].text for i in range(1, 30) for part in core)
    assert all(r.n_chars == len(r.text) and docs[i][1].split("\n")[1] in r.text for i, r in rows.items())


def test_stage_on_odd_documents(spark, odd_documents):
    found = stage(spark, odd_documents, "")
    assert found.columns == odd_documents.columns and found.count() == odd_documents.count()
    assert found.where("text LIKE 'Same%'").count() == 2  # the earliest row, which is there twice
    assert stage(spark, odd_documents.limit(0), "").collect() == []


def windows(words):
    return [tuple(words[i : i + 8]) for i in range(len(words) - 7)]


SHAPES = {
    "short lines": lambda words: "\n" + "\n".join(" ".join(words[i : i + 6]) for i in range(0, len(words), 6)) + "\n",
    "short sentences": lambda words: " " + " ".join(w + "." if i % 5 == 4 else w for i, w in enumerate(words)) + " ",
    "one sentence": lambda words: " " + " ".join(words) + " ",
}


@pytest.mark.parametrize("shape", SHAPES)
def test_passages_against_word_windows(spark, shape):
    """Set into other text: only words of windows that are found before are cut, and most of these."""
    draw = random.Random(3)
    shared = [SHAPES[shape](passage(draw, 60).split()) for _ in range(4)]
    docs = [(i, f"{passage(draw, draw.randint(5, 30))}{draw.choice(shared)}{passage(draw, draw.randint(5, 30))}", None, None, 0) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    rest = {r.doc_id: r.text.split() for r in stage(spark, df, "").collect()}
    seen, repeated, cut = set(), 0, 0
    for i, text, *_ in docs:
        words = text.split()
        again = {j + k for j, w in enumerate(windows(words)) if w in seen for k in range(8)}
        gone = Counter(words) - Counter(rest[i])
        assert sum((Counter(rest[i]) - Counter(words)).values()) == 0 and not gone - Counter(words[j] for j in again)
        repeated, cut = repeated + len(again), cut + sum(gone.values())
        seen.update(windows(words))
    assert cut > repeated / 2 > 0


def test_scripts_without_spaces(spark):
    draw = random.Random(4)
    text = lambda n: "".join(chr(draw.randint(0x4E00, 0x9FFF)) for _ in range(n))
    shared = text(200)
    docs = [(i, text(50) + shared + text(50), None, None, 0) for i in range(10)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    rows = {r.doc_id: r.text for r in stage(spark, df, "").collect()}
    assert rows[0] == docs[0][1]
    assert all(100 <= len(rows[i]) < 200 and rows[i].startswith(docs[i][1][:50]) and rows[i].endswith(docs[i][1][-50:]) for i in range(1, 10))


CLASHING = {"_row": 7, "_size": 8, "_key": 9, "_measures": "m", "_cuts": 1.5, "_component": "c", "digest": 2, "key": 3, "extra3": "e", "of Ünï.x": 4}


@pytest.mark.parametrize("module", ["quality_rules", "minhash", "lines", "mixing"])
def test_stages_hand_back_columns_that_clash_with_their_own(spark, module):
    function = importlib.import_module(f"cohortgraph.llm.{module}").stage
    draw = random.Random(4)
    words = [f"word{i}" for i in range(400)]
    rows = [(i, " ".join(draw.choices(words, k=80)), "en", "s", 1, *CLASHING.values()) for i in range(6)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *CLASHING])
    found = function(spark, docs, "")
    assert found.columns == docs.columns and [f.dataType for f in found.schema] == [f.dataType for f in docs.schema]
    out = [r.asDict() for r in found.collect()]
    assert out and all({c: r[c] for c in CLASHING} == CLASHING for r in out)


def test_words_are_found_alike_whatever_else_the_text_holds():
    """A passage falls into the same runs beside a character that takes the slow way."""
    draw = random.Random(5)
    passage = " ".join("".join(draw.choices("abcäöéßİ", k=draw.randint(1, 9))) for _ in range(300))
    alone = runs(passage)
    odd = runs("\u00a0\u4e00 " + passage)
    assert len(alone) > 10 and {w for *_, w in alone[1:]} <= {w for *_, w in odd}
    for start, end, words in alone:
        assert " ".join(passage[start:end].lower().split()).encode() == words
