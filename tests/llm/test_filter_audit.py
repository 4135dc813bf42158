"""The filter audit against running every order over the rows."""

import random
import re
from collections import Counter
from itertools import permutations
from math import factorial

import pytest

from cohortgraph.llm.filter_audit import NAMES, lattice, op12_filter_audit, order_steps

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failures(docs):
    """The letters that each document fails."""
    found = []
    for i, text, _ in docs:
        t = text or ""
        words = WORD.findall(t)
        fails = {"A"} if len(words) < 100 else set()
        fails |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        earlier = any(j is not None and i is not None and j < i and (u or "") == t for j, u, _ in docs)
        found.append(fails | ({"E"} if earlier else set()))
    return found


def all_orders(docs, labels):
    fails = failures(docs)
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    rows, total = {}, Counter()
    for part in {lang or "" for _, _, lang in docs}:
        here = [(i, f) for (i, _, lang), f in zip(docs, fails, strict=True) if (lang or "") == part]
        for order in permutations(NAMES):
            left = here
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                n_fail = sum(letter in f for _, f in here)
                rows[part, "".join(order), step] = (
                    len(left), len(gone), n_fail - len(gone), sum(f == {letter} for _, f in here),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                )
                total[part, letter] += len(gone)
    return {(p, o, s, *r, total[p, o[s - 1]]) for (p, o, s), r in rows.items()}


def corpus(seed):
    draw = random.Random(seed)
    texts = [None, "", " \t\n", "Ä" * 50, "SHOUT " * 120, "a\u00a0b " * 130, "x" * 300_000]
    for _ in range(60):
        words = [draw.choice("abcdefghij") * draw.randint(1, 40) for _ in range(draw.choice([20, 99, 100, 150]))]
        texts.append(" ".join(w.upper() if draw.random() < 0.1 else w for w in words) + draw.choice(["", " 5%", "#"]))
    texts += [draw.choice(texts) for _ in range(50)]
    docs = [(None if i % 17 == 3 else i, t, draw.choice(["en", "de", None, ""])) for i, t in enumerate(texts)]
    return docs + docs[:9]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_every_order(spark, tables, seed):
    docs = corpus(seed)
    draw = random.Random(seed)
    labels = [(draw.choice([None, *range(90)]), draw.choice([0, 1, None]), draw.choice([0, 1, None])) for _ in range(80)]
    folder = tables(
        documents=spark.createDataFrame([(*d, 7, "m") for d in docs], "doc_id long, text string, lang string, mask int, part string"),
        labels=spark.createDataFrame([(*x, 1) for x in labels], "doc_id long, quality int, toxic int, good int"),
    )
    found = [tuple(r) for r in op12_filter_audit(spark, folder).collect()]
    assert len(found) == len(set(found)) and set(found) == all_orders(docs, labels)


def test_every_order_takes_one_edge_of_each_rank():
    for n in (1, 3, 5):
        ranks = Counter()
        for state, _, paths in lattice(n):
            ranks[state.bit_count()] += paths
        assert ranks == {rank: factorial(n) for rank in range(n)}
    edges = {(s, b): w for s, b, w in lattice(5)}
    assert Counter((s, b) for _, _, s, b in order_steps("ABCDE")) == edges
