"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of each whole text are columns of SQL functions. On a bounded sample of labelled
rows (``SAMPLE`` of them, those of the smallest id hashes) boosted trees of depth 3 are
grown; every path from a root, whole or in part, is a rule: a conjunction of comparisons.
Lasso logistic regression weighs the rules, most of them with zero. Those that stay are
compiled into one column expression, so that scoring is a plain projection.

Defined results: null and empty texts have zero statistics and get their score; documents
without label, or with a null one, are scored but not learned from; of several labels of a
document the largest counts; with labels of one kind only, or none, every score is their
smoothed share; an empty table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.llm.common import documents, fold, keep, words
from cohortgraph.llm.quality_rules import measured

SAMPLE = 20_000
#: Rows that are ordered for the sample, in times its size.
THINNED = 3
FOLDS, HELD_OUT = 3, 1
TREES, DEPTH, BINS, LEAF = 24, 3, 32, 20
SHRINK = 0.3
LASSO = 0.002
STEPS = 400

STATISTICS = (
    "n_words mean_word symbols capitals repeats dup_lines words_per_line digits bangs bars distinct longest_share"
).split()

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, cut), sorted


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns STATISTICS in place of ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    m = F.col("_measures")
    n, chars, lines = (F.greatest(m[c], F.lit(1)).cast("double") for c in ("n_words", "word_chars", "n_lines"))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    found = words(text)
    columns = {
        "n_words": m["n_words"].cast("double"),
        "mean_word": m["word_chars"] / n,
        "symbols": m["n_symbols"] / n,
        "capitals": m["n_capitals"] / chars,
        "repeats": m["n_repeat_words"] / n,
        "dup_lines": m["n_dup_lines"] / lines,
        "words_per_line": m["n_words"] / lines,
        "digits": count("[0-9]") / chars,
        "bangs": count("!") / n,
        "bars": count(r"\|") / n,
        "distinct": F.size(F.array_distinct(found)) / n,
        "longest_share": F.coalesce(F.array_max(F.transform(found, F.length)), F.lit(0)) / chars,
    }
    others = [c for c in docs.columns if c != "text"]
    return measured(docs).select(*others, *(columns[c].alias(c) for c in STATISTICS))


@dataclass
class Ensemble:
    intercept: float
    rules: list[tuple[float, Rule]]


def _grow(x: np.ndarray, bins: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, list[Rule]]:
    """One tree on gradients: its values, and the conjunctions of its nodes."""
    value, rules = np.zeros(len(x)), []
    nodes: list[tuple[np.ndarray, Rule]] = [(np.arange(len(x)), ())]
    for level in range(DEPTH + 1):
        following = []
        for rows, path in nodes:
            g, h = gradient[rows], hessian[rows]
            best = (1e-6, 0, 0)
            if level < DEPTH and len(rows) >= 2 * LEAF:
                whole = g.sum() ** 2 / (h.sum() + 1)
                for j in range(x.shape[1]):
                    b = bins[rows, j]
                    n, gs, hs = (np.bincount(b, weights=w, minlength=BINS + 1).cumsum() for w in (None, g, h))
                    gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - whole
                    gain[(n < LEAF) | (n[-1] - n < LEAF)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], j, k)
            if best[0] <= 1e-6:
                value[rows] = -SHRINK * g.sum() / (h.sum() + 1)
                continue
            _, j, k = best
            above = bins[rows, j] > k
            for side in (False, True):
                step = tuple(sorted({*path, (j, side, float(cuts[j][k]))}))
                rules.append(step)
                following.append((rows[above == side], step))
        nodes = following
    return value, rules


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    found = np.ones(len(x), bool)
    for j, above, cut in rule:
        found &= (x[:, j] > cut) == above
    return found


def _lasso(features: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Logistic regression with an l1 penalty on all but the intercept, by accelerated proximal steps."""
    n, k = features.shape
    a = np.column_stack([np.ones(n), features])
    step = 4 * n / max(1e-9, np.linalg.norm(a, 2) ** 2)
    weight, ahead, momentum = np.zeros(k + 1), np.zeros(k + 1), 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(a @ ahead, -30, 30)))
        new = ahead - step * (a.T @ (p - y)) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * LASSO, 0)
        grown = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / grown * (new - weight)
        weight, momentum = new, grown
    return float(weight[0]), weight[1:]


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble:
    share = (y.sum() + 1) / (len(y) + 2)
    prior = math.log(share / (1 - share))
    if len(set(y.tolist())) < 2:
        return Ensemble(prior, [])
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    margin, rules = np.full(len(y), prior), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        value, grown = _grow(x, bins, cuts, p - y, p * (1 - p))
        margin += value
        rules |= dict.fromkeys(grown)
    matrix = np.column_stack([holds(r, x) for r in rules]).astype(np.float64) if rules else np.zeros((len(y), 0))
    intercept, weights = _lasso(matrix, y)
    return Ensemble(intercept, [(float(w), r) for w, r in zip(weights, rules, strict=True) if abs(w) > 1e-6])


def compiled(model: Ensemble) -> Column:
    margin = F.lit(model.intercept)
    for weight, rule in model.rules:
        condition = F.lit(True)
        for j, above, cut in rule:
            column = F.col(STATISTICS[j])
            condition = condition & (column > cut if above else column <= cut)
        margin = margin + F.when(condition, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-margin))


def learned(table: DataFrame, labels: DataFrame) -> Ensemble:
    """Model from rows of ``table`` (doc_id, STATISTICS) outside the held-out fold."""
    one = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("y"))
    train = table.where(fold(FOLDS) != HELD_OUT).join(one, "doc_id")
    # About three times as many as wanted by the hash's place, so that tasks do not send SAMPLE rows each.
    hashed = F.xxhash64("doc_id")
    few = train.where(hashed / F.lit(2.0**64) + 0.5 <= (THINNED * SAMPLE + 200) / max(1, train.count()))
    rows = few.orderBy(hashed, *STATISTICS).limit(SAMPLE).select("y", *STATISTICS).collect()
    data = np.array([list(r) for r in rows], np.float64).reshape(-1, len(STATISTICS) + 1)
    return fit(data[:, 1:], data[:, 0])


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of docs (doc_id, text)."""
    table = keep(statistics(docs.select("doc_id", "text")), "statistics")
    return table.select("doc_id", compiled(learned(table, labels)).alias("score"))


def op9_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    found = scored(documents(spark, sf_dir), labels)
    return found.select(
        "doc_id",
        (fold(FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
