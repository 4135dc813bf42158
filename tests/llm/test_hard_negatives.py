"""Hard negatives against all pairs, and how much the tree saves where anchors are clustered."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortgraph.llm.hard_negatives import best_in_windows, hard_negatives, spanning_tree, usable

SCHEMA = "vec_id long, embedding array<float>, label int, group int, score string"


def all_pairs(rows, every, positives, negatives, low, high):
    found = set()
    for a, (label, v) in rows.items():
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), b, other == label) for b, (other, w) in rows.items() if b != a]
        for p_score, p, _ in sorted(s for s in scored if s[2])[:positives]:
            fits = [s for s in scored if not s[2] and low * -p_score <= 100 * -s[0] <= high * -p_score]
            for rank, (n_score, n, _) in enumerate(sorted(fits)[:negatives], 1):
                found.add((a, p, rank, n, -p_score, -n_score))
    return found


def clustered(seed, n, clusters, width, spread):
    draw = np.random.default_rng(seed)
    middles = draw.normal(size=(clusters, width))
    middles /= np.linalg.norm(middles, axis=1)[:, None]
    points = middles[draw.integers(0, clusters, n)] + spread * draw.normal(size=(n, width))
    return [[float(np.float32(x)) for x in p] for p in points], draw.integers(0, 3, n).tolist()


@pytest.mark.parametrize(("seed", "spread", "block", "group"), [(1, 0.05, 16, 64), (2, 0.5, 7, 1000), (3, 0.0, 1000, 30)])
def test_equals_all_pairs(spark, seed, spread, block, group):
    points, labels = clustered(seed, 300, 6, 8, spread)  # with spread 0 the vectors are ties throughout
    rows = [(i, p, label, 1, "x") for i, (p, label) in enumerate(zip(points, labels, strict=True))]
    vectors = usable(spark.createDataFrame(rows, SCHEMA), F.col("label"))
    found = {tuple(r) for r in hard_negatives(vectors, F.col("vec_id") % 5 == 0, block=block, group=group).collect()}
    whole = {i: (label, [int(np.floor(256 * x)) for x in p]) for i, p, label, *_ in rows}
    expected = all_pairs(whole, 5, 5, 3, 50, 95)
    assert found == expected and (expected or spread == 0)


def test_odd_rows(spark):
    nan, big = float("nan"), 1e30
    rows = [(0, [1.0, 0.5], 1, 1, "x"), (0, [1.0, 0.5], 1, 2, "y"), (5, [1.0], 1, 1, "x"), (6, [0.75, 9.0, -1.0], 2, 1, "x")]
    rows += [(1, None, 1, 1, "x"), (2, [1.0, None], 1, 1, "x"), (3, [1.0, nan], 2, 1, "x"), (4, [1.0, float("inf")], 2, 1, "x")]
    rows += [(None, [1.0], 2, 1, "x"), (7, [1.0, 0.0], None, 1, "x"), (8, [big, 0.0], 2, 1, "x"), (9, [], 2, 1, "x")]
    rows += [(10, [0.75, 0.0], 2, 1, "x"), (11, [0.75, 0.0], 2, 1, "x")]
    vectors = usable(spark.createDataFrame(rows, SCHEMA), F.col("label"))
    assert sorted(r.vec_id for r in vectors.collect()) == [0, 5, 6, 9, 10, 11]
    found = [tuple(r) for r in hard_negatives(vectors, F.col("vec_id") == 0).collect()]
    assert sorted(found) == [(0, 5, 1, 10, 65536, 49152), (0, 5, 2, 11, 65536, 49152)]
    assert hard_negatives(vectors.limit(0), F.col("vec_id") == 0).collect() == []


def test_scores_beyond_floating_point_are_exact(spark):
    rows = [(0, [200_000.5, 3e5, 0.25], 1, 1, "x"), (1, [150_000.0, 3e5, 1.0], 1, 1, "x"), (2, [99_999.0, 2.5e5, -0.5], 2, 1, "x")]
    vectors = usable(spark.createDataFrame(rows, SCHEMA), F.col("label"))
    found = {tuple(r) for r in hard_negatives(vectors, F.col("vec_id") == 0).collect()}
    whole = {i: (label, [int(np.floor(256 * np.float64(np.float32(x)))) for x in p]) for i, p, label, *_ in rows}
    assert found == all_pairs(whole, 9, 5, 3, 50, 95) and found


def test_tree_is_a_spanning_tree_in_walking_order():
    points = np.random.default_rng(5).integers(-50, 50, (60, 4))
    order, parent, distance = spanning_tree(points)
    place = {at: i for i, at in enumerate(order.tolist())}
    assert sorted(place) == list(range(60))
    ends = np.vstack([points, np.zeros(4, int)])
    for i in range(60):
        assert parent[i] == -1 or place[parent[i]] < place[i]
        assert distance[i] == pytest.approx(np.linalg.norm(ends[i] - ends[parent[i]]))


def test_clustered_anchors_are_mostly_bounded():
    points, labels = clustered(6, 4000, 20, 16, 0.01)
    matrix, labels = np.floor(256 * np.array(points)).astype(np.int64), np.array(labels)
    chosen = np.arange(0, 4000, 20)
    order, parent, distance = spanning_tree(matrix[chosen])
    step = np.empty(len(order) + 1, int)
    step[order], step[-1] = np.arange(len(order)), -1
    of = chosen[order]
    anchors = {"id": of, "label": labels[of], "matrix": matrix[of], "parent": step[parent][order], "distance": distance[order]}
    rows = {"id": np.arange(4000), "label": labels, "matrix": matrix}
    windows = [[(30_000, 60_000)] for _ in of]
    scored, pairs = 0, 0
    for place, _, found, values, n in best_in_windows(anchors, windows, rows, False, 3):
        exact = matrix @ anchors["matrix"][place]
        fits = np.flatnonzero((labels != labels[of[place]]) & (exact >= 30_000) & (exact <= 60_000))
        best = fits[np.lexsort((fits, -exact[fits]))][:3]
        assert found.tolist() == best.tolist() and values.tolist() == exact[best].tolist()
        scored, pairs = scored + n, pairs + int((labels != labels[of[place]]).sum())
    assert scored < pairs / 3
