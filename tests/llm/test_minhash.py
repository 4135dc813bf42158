"""Near-duplicates against all pairs, on texts with chains, hubs and hot groups."""

import random
import re

import pytest

from cohortgraph.llm import components, minhash
from cohortgraph.llm.minhash import band_width, near_duplicates, stage


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def all_pairs(docs, k, percent):
    sets = {i: shingles(t, k) for i, t in docs}
    low = {i: i for i in sets}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            least = min(low[a], low[b])
            moved |= low[a] != least or low[b] != least
            low[a] = low[b] = least
    return {i: (len(s), low[i]) for i, s in sets.items()}


def corpus(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdeé", k=draw.randint(1, 4)))
    docs = [[word() for _ in range(draw.randint(1, 90))] for _ in range(60)]
    for _ in range(150):  # chains of edits: ends far apart, each step near the threshold
        copy = list(draw.choice(docs[-20:]))
        for _ in range(draw.randint(0, 3)):
            copy[draw.randrange(len(copy))] = word()
        docs.append(copy)
    docs += [docs[3]] * 70
    passage = [word() for _ in range(60)]
    docs += [passage + [word() for _ in range(20)] for _ in range(40)]  # about 0.6 alike, one bucket, no links
    docs += [[], ["a"], ["a"], ["A"], ["a", "b"], []]
    texts = [draw.choice([" ", "\n", "\t "]).join(d) for d in docs]
    order = list(range(len(texts)))
    draw.shuffle(order)
    return list(zip(order, texts, strict=True))


@pytest.mark.parametrize(("k", "percent", "seed"), [(3, 85, 1), (5, 80, 2), (2, 60, 3)])
def test_equals_all_pairs(spark, k, percent, seed):
    docs = corpus(seed)
    found = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k, percent).collect()
    assert {r.doc_id: (r._size, r._component) for r in found} == all_pairs(docs, k, percent)


@pytest.mark.parametrize(("edits", "n"), [((0, 12), 500), ((0, 3), 300)])
def test_hot_group_of_near_copies(spark, monkeypatch, edits, n):
    """One bucket of texts that are or nearly are alike: whole result, and pairs in the order of the members."""
    draw = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    docs = []
    for i in range(n):
        copy = list(base)
        for at in draw.sample(range(150), draw.randint(*edits)):
            copy[at] = f"x{draw.random()}"
        docs.append((i, " ".join(copy)))
    checked = []
    confirmed = minhash.confirmed
    monkeypatch.setattr(minhash, "confirmed", lambda pairs, *a: (checked.append(pairs.count()), confirmed(pairs, *a))[1])
    found = near_duplicates(spark.createDataFrame(docs * 2, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: (r._size, r._component) for r in found} == all_pairs(docs, 3, 85)
    assert sum(checked) < 40 * n


@pytest.mark.parametrize("percent", [85, 60])
def test_nothing_is_broadcast(spark, monkeypatch, percent):
    """Band keys are many rows a text, which Spark counts as one: a side that it finds small may fill the driver."""
    plans, keep = [], minhash.keep
    planned = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    for module in (components, minhash):
        monkeypatch.setattr(module, "keep", lambda df, name: (planned(df), keep(df, name))[1])
    docs = spark.createDataFrame(corpus(5), "doc_id long, text string")
    planned(near_duplicates(docs, 3, percent))
    planned(stage(spark, docs, ""))
    assert len(plans) > 20 and sum("SortMergeJoin" in p for p in plans) > 8
    assert not [p for p in plans if "Broadcast" in p]


def test_bands_miss_less_than_one_in_a_million():
    for percent in (60, 80, 85, 95):
        r = band_width(percent)
        assert (1 - (percent / 100) ** r) ** (128 // r) < 1e-6 or r == 1


def test_stage_keeps_one_of_each_group(spark, odd_documents):
    docs = spark.createDataFrame(corpus(4), "doc_id long, text string")
    expected = all_pairs(docs.collect(), 5, 80)
    kept = {r.doc_id for r in stage(spark, docs, "").collect()}
    assert kept == {i for i, (n, c) in expected.items() if not n or i == c}
    assert stage(spark, docs.limit(0), "").collect() == []
    odd = stage(spark, odd_documents, "")
    assert odd.columns == odd_documents.columns
    assert sorted((r.text or "")[:4] for r in odd.collect()) == ["", "", "\n\n", " \n\t ", "1 2 ", "Same", "a", "one ", "x x ", "§ 🙂 "]
