"""Hard negatives by bounds along a spanning tree of the anchors.

A score is an inner product, so along a tree edge from a parent anchor p to a child a the score of
candidate c moves by at most ``|a - p| * |c|``. The tree hangs on the origin, where every score is
0, and joins neighbouring anchors by short edges; walking it from the origin, every candidate has an
interval around its parent's score, and only candidates whose interval overlaps a window that is
asked for are scored anew. A window closes in from below as soon as enough intervals lie inside it:
what is certainly beaten by as many rows as are asked for is not scored.

1. Anchors are put into blocks by the signs of their first components (a crowded block is split by
   hash), and each block is a subtree of the origin, grown from the shortest edge on.
2. Blocks of anchors meet groups of candidates in cells of bounded size, one join on (block, group):
   the stated query set against all rows, in blocks. A cell gives at most k rows for a window.
3. First pass: window everything, rows of the same label, the best k are the positives. Second
   pass: one window for each positive, rows of other labels, the best k are the hard negatives.
   Both are reduced to k rows map-side and again after one shuffle.

Scores are exact: products below 2^53 in floating point, beyond by 64-bit integers. Where anchors
are about as far from each other as from the origin, as random directions are, the intervals exclude
nothing and every pair is scored; the tree pays where anchors are clustered.

Defined results: rows with a null id or label, a null vector or a null or non-finite component take
no part, nor do rows whose norm times 256 reaches 2^30, as their scores need not fit a long; missing
components of a shorter vector are 0; rows that repeat an id are one row, the least by label, then
vector; ties of scores go to the smaller id; an anchor without other rows of its label gives nothing;
an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, inf, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortgraph.llm.common import keep

#: Anchors of a block, and candidates of a group: what a cell holds at most, about.
BLOCK, GROUP = 2048, 16_384
#: Groups are no smaller than this, so that small tables still make several cells.
LEAST_GROUP, LEAST_GROUPS = 1024, 32
MAX_SIGNS = 16
#: Rounding in norms and distances may not narrow an interval.
SLACK = 1e-9
EXACT = 2.0**53
MAX_NORM = 2.0**30


def usable(vectors: DataFrame, label: Column, scale: int = 256) -> DataFrame:
    """(vec_id, label, vector) with components ``floor(scale * x)``, one row for each id."""
    broken = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(inf)))
    whole = F.transform("embedding", lambda x: F.floor(scale * x.cast("double")))
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + (scale * x.cast("double")) ** 2)
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(~broken)
    rows = rows.where(square < MAX_NORM**2)
    row = F.struct(label.cast("long").alias("label"), whole.cast("array<bigint>").alias("vector"))
    return rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(row).alias("r")).select("vec_id", "r.*")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers, short ones filled up with 0."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max((int(np.diff(c.combine_chunks().offsets.to_numpy()).max()) for c in columns if len(c)), default=0)


def _norms(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1)) * (1 + SLACK)


def spanning_tree(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parent and edge length of the shortest tree of the rows and the origin.

    ``order`` walks the tree from the origin, a node's heaviest branch last, so that few nodes
    wait for children at a time; ``parent`` is the row of the parent, -1 for the origin.
    """
    n = len(matrix)
    points = matrix.astype(np.float64)
    far, parent, joined = np.sqrt((points**2).sum(axis=1)), np.full(n, -1), []
    left = np.ones(n, bool)
    for _ in range(n):
        at = int(np.argmin(np.where(left, far, inf)))
        left[at] = False
        joined.append(at)
        to = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
        nearer = left & (to < far)
        far[nearer], parent[nearer] = to[nearer], at
    children: dict[int, list[int]] = {}
    weight = np.ones(n, np.int64)
    for at in reversed(joined):
        if parent[at] >= 0:
            weight[parent[at]] += weight[at]
    for at in joined:
        children.setdefault(int(parent[at]), []).append(at)
    order, waiting = [], sorted(children.get(-1, []), key=lambda i: -weight[i])
    while waiting:
        at = waiting.pop()
        order.append(at)
        waiting.extend(sorted(children.get(at, []), key=lambda i: -weight[i]))
    return np.array(order, np.int64), parent, far * (1 + SLACK)


def best_in_windows(
    anchors: dict[str, np.ndarray],
    windows: list[list[tuple[float, float]]],
    rows: dict[str, np.ndarray],
    same_label: bool,
    k: int,
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """For each anchor and each of its ``windows``: anchor, window, the best ``k`` rows, their scores,
    and how many rows were scored for the anchor (with its first window).

    ``anchors`` (id, label, matrix, parent, distance) stand in tree order, ``parent`` by place; rows
    (id, label, matrix) stand by id.
    """
    norms = _norms(rows["matrix"])
    largest = float(_norms(anchors["matrix"]).max(initial=0)) * float(norms.max(initial=0))
    kind = np.float64 if largest < EXACT else np.int64
    matrix, ids, labels = rows["matrix"].astype(kind), rows["id"], rows["label"]
    waiting = np.bincount(anchors["parent"][anchors["parent"] >= 0], minlength=len(windows))
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for place, asked in enumerate(windows):
        parent = int(anchors["parent"][place])
        reach = anchors["distance"][place] * norms
        if parent < 0:
            low, high = -reach, reach.copy()
        else:
            low, high = known[parent]
            low, high = low - reach, high + reach
            waiting[parent] -= 1
            if not waiting[parent]:
                del known[parent]
        fits = ((labels == anchors["label"][place]) == same_label) & (ids != anchors["id"][place])
        wanted = np.zeros(len(ids), bool)
        for least, most in asked:
            inside = low[fits & (low >= least) & (high <= most)]
            if len(inside) >= k:
                least = max(least, np.partition(inside, len(inside) - k)[len(inside) - k])
            wanted |= fits & (high >= least) & (low <= most)
        at = np.flatnonzero(wanted)
        scores = (matrix if len(at) == len(ids) else matrix[at]) @ anchors["matrix"][place].astype(kind)
        if waiting[place]:
            doubt = np.abs(scores) * (0.0 if kind is np.float64 else SLACK)
            low[at], high[at] = scores - doubt, scores + doubt
            known[place] = low, high
        for window, (least, most) in enumerate(asked):
            of = np.flatnonzero((scores >= least) & (scores <= most))
            found, values = at[of], scores[of]
            if len(found) > k:
                edge = np.partition(values, len(values) - k)[len(values) - k]
                near = np.flatnonzero(values >= edge)
                # Rows stand by id, so a stable sort leaves ties with the smaller id first.
                near = near[np.argsort(-values[near], kind="stable")][:k]
                found, values = found[near], values[near]
            yield place, window, found, values, len(at) if window == 0 else 0


def _signs(n_anchors: int, block: int) -> int:
    return min(MAX_SIGNS, max(1, int(log2(max(1, n_anchors / block)))))


def trees(anchors: DataFrame, n_anchors: int, block: int = BLOCK) -> tuple[DataFrame, int]:
    """Anchors with ``block``, ``step`` (place in the walk of its tree), ``parent`` (its step, -1 the
    origin) and ``distance``; and the number of blocks.

    The signs make at most 2^16 codes, whatever the table, so their counts are numbered in one task.
    """
    code = sum((F.when(F.try_element_at("vector", F.lit(i + 1)) >= 0, 1 << i).otherwise(0) for i in range(_signs(n_anchors, block))), F.lit(0))
    coded = anchors.withColumn("_code", code)
    counts = coded.groupBy("_code").agg(F.ceil(F.count(F.lit(1)) / block).alias("_parts"))
    before = F.sum("_parts").over(Window.orderBy("_code")) - F.col("_parts")
    parts = keep(counts.select("_code", "_parts", before.alias("_before")), "blocks")
    n_blocks = parts.agg(F.sum("_parts")).first()[0] or 0
    part = F.col("_before") + F.pmod(F.xxhash64("vec_id"), F.col("_parts"))
    blocks = coded.join(F.broadcast(parts), "_code").select("vec_id", "label", "vector", part.cast("long").alias("block"))

    def grow(table: pa.Table) -> pa.Table:
        order, parent, distance = spanning_tree(_matrix(table.column("vector"), _width(table.column("vector"))))
        step = np.empty(len(order) + 1, np.int64)
        step[order], step[-1] = np.arange(len(order)), -1
        table = table.append_column("step", pa.array(step[:-1]))
        return table.append_column("parent", pa.array(step[parent])).append_column("distance", pa.array(distance))

    schema = "vec_id long, label long, vector array<bigint>, block long, step long, parent long, distance double"
    return keep(blocks.groupBy("block").applyInArrow(grow, schema), "trees"), n_blocks


def _each(n: int) -> Column:
    """A row for each number below ``n``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _best_of_cells(
    anchors: DataFrame, rows: DataFrame, n_blocks: int, n_groups: int, same_label: bool, k: int
) -> DataFrame:
    """(anchor_id, of, other_id, score): the best ``k`` rows of each cell for each window.

    ``windows`` of an anchor are (of, least, most); ``of`` comes back with what was found.
    """
    left = anchors.withColumn("group", _each(n_groups))
    right = rows.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(n_groups))).withColumn("block", _each(n_blocks))

    def meet(tree: pa.Table, found: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if len(tree) and len(found):
            tree, found = tree.sort_by("step"), found.sort_by("vec_id")
            width = _width(tree.column("vector"), found.column("vector"))
            numbers = {c: tree.column(c).to_numpy() for c in ("vec_id", "label", "parent", "distance")}
            walked = {"id": numbers["vec_id"], "matrix": _matrix(tree.column("vector"), width)} | numbers
            asked = [[(w["of"], w["least"], w["most"]) for w in ws] for ws in tree.column("windows").to_pylist()]
            ids = found.column("vec_id").to_numpy()
            others = {"id": ids, "label": found.column("label").to_numpy(), "matrix": _matrix(found.column("vector"), width)}
            bounds = [[(-inf if low is None else low, inf if high is None else high) for _, low, high in ws] for ws in asked]
            for place, window, at, scores, _ in best_in_windows(walked, bounds, others, same_label, k):
                out[0] += [int(walked["id"][place])] * len(at)
                out[1] += [asked[place][window][0]] * len(at)
                out[2] += ids[at].tolist()
                out[3] += scores.astype(np.int64).tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["anchor_id", "of", "other_id", "score"])

    cells = left.groupBy("block", "group").cogroup(right.groupBy("block", "group"))
    return cells.applyInArrow(meet, "anchor_id long, of long, other_id long, score long")


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    percent: tuple[int, int] = (50, 95),
    block: int = BLOCK,
    group: int = GROUP,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows
    (vec_id, label, vector), one row for each id.

    Positives of an anchor are the best rows of its label; negatives of a positive are the best rows of
    other labels that score between the two percentages of it. Two numbers reach the driver.
    """
    rows = keep(rows, "vectors")
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if(is_anchor)).first()
    n_groups = max(1, ceil(n_rows / group), min(LEAST_GROUPS, n_rows // LEAST_GROUP))
    walked, n_blocks = trees(rows.where(is_anchor), n_anchors, block)
    n_blocks = max(1, n_blocks)
    window = "array<struct<of:bigint,least:bigint,most:bigint>>"
    everything = F.array(F.struct(F.lit(None).alias("of"), F.lit(None).alias("least"), F.lit(None).alias("most"))).cast(window)
    same = _best_of_cells(walked.withColumn("windows", everything), rows, n_blocks, n_groups, True, positives)
    chosen = keep(_first(same, ["anchor_id"], positives).select("anchor_id", "other_id", "score"), "positives")

    low, high = (F.col("score").cast("decimal(38,0)") * p / 100 for p in percent)
    # Whole scores between the bounds are those between the whole numbers inside them.
    of_anchor = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct(F.col("other_id").alias("of"), F.ceil(low).cast("long").alias("least"), F.floor(high).cast("long").alias("most"))).alias("windows")
    )
    asking = walked.join(of_anchor, "vec_id", "left").withColumn("windows", F.coalesce("windows", F.array().cast(window)))
    other = _best_of_cells(asking, rows, n_blocks, n_groups, False, negatives)
    ranked = _first(other, ["anchor_id", "of"], negatives)
    scored = chosen.select("anchor_id", F.col("other_id").alias("of"), F.col("score").alias("positive_score"))
    return ranked.join(scored, ["anchor_id", "of"]).select(
        "anchor_id",
        F.col("of").alias("positive_id"),
        "rank",
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    label = F.col("label").cast("long")
    rows = usable(vectors, F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
         CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM v AS a JOIN v AS c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""
