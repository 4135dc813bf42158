"""Language of words in mixed texts by a linear-chain conditional random field.

A word's label depends on its affixes, its inner letter n-grams, whether a language's
lexicon holds it, and the label of the word before. Weights and transitions are learned by
gradient steps on the likelihood, over windows of ``WINDOW_CHARS`` letters of a bounded
sample: ``PER_LANG`` texts of each language, those of the smallest id hashes. As labels come
by document, training windows of two languages are joined, so that switches are seen.
Prediction runs forward and backward over all words of every text; a text's language has the
largest mean posterior, which is its score. Lexicons are words that the sample shows often
and almost only in one language.

Words are letters of any script with their marks; digits and numerals in other forms (½, Ⅷ) are
no letters. Words are read whole, however long.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every
text if there is nothing to learn from; null languages are not learned from; repeated rows
are predicted alike; an empty table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortgraph.llm.common import documents, fold

PER_LANG, ALL_LANGS = 400, 8000
WINDOW_CHARS = 1200
FOLDS, HELD_OUT = 4, 2
SEEN = 3
EPOCHS, BATCH, RATE, DECAY = 4, 32, 0.2, 1e-4
MEMO = 300_000
LANES, LANE_WORDS = 256, 300_000

#: A word starts with a letter; marks, such as vowel signs, belong to it.
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
UNKNOWN = "und"


def features(word: str, lexicon: dict[str, str]) -> Iterator[str]:
    """Features of the whole word, one at a time, however long it is."""
    marked = f"^{word}$"
    n = len(marked)
    for k in (2, 3):
        for i in range(n - k + 1):
            yield marked[i : i + k]
    for k in (4, 5):
        if n > k:
            yield marked[:k]
            yield marked[-k:]
    yield "=" + word
    if word in lexicon:
        yield "in " + lexicon[word]


@dataclass
class Model:
    labels: list[str]
    lexicon: dict[str, str] = field(default_factory=dict)
    index: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1, 0)))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def rows(self, word: str) -> list[int]:
        """Rows of its features; row 0 is the bias."""
        return [0, *(i for f in features(word, self.lexicon) if (i := self.index.get(f)))]


def forward_backward(emit: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors, forward and backward messages of sequences in rows, longest first; ``emit`` (time, row, label) > 0.

    Messages are scaled to one at each step, so long texts don't underflow.
    """
    times, rows, labels = emit.shape
    live = np.searchsorted(-lengths, -np.arange(times), side="left")
    ahead, back = np.zeros_like(emit), np.ones_like(emit)
    for t in range(times):
        n = live[t]
        a = emit[t, :n] if t == 0 else (ahead[t - 1, :n] @ moves) * emit[t, :n]
        ahead[t, :n] = a / a.sum(axis=1, keepdims=True)
    for t in range(times - 2, -1, -1):
        n = live[t + 1]
        b = (back[t + 1, :n] * emit[t + 1, :n]) @ moves.T
        back[t, :n] = b / b.sum(axis=1, keepdims=True)
    post = ahead * back
    total = post.sum(axis=2, keepdims=True)
    return post / np.where(total > 0, total, 1), ahead, back


def positive(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(axis=-1, keepdims=True))


def padded(parts: list[np.ndarray], labels: int) -> tuple[np.ndarray, np.ndarray]:
    """(time, row, label) from word scores of sequences, longest first."""
    lengths = np.array([len(p) for p in parts])
    emit = np.ones((int(lengths.max()), len(parts), labels))
    for i, p in enumerate(parts):
        emit[: len(p), i] = positive(p)
    return emit, lengths


def train(sample: list[tuple[str, str]], seed: int = 5) -> Model:
    """Model from (lang, text) windows."""
    by_lang: dict[str, list[list[str]]] = {}
    for lang, text in sample:
        if found := _WORD.findall(text.lower()):
            by_lang.setdefault(lang, []).append(found)
    model = Model(sorted(by_lang))
    if not by_lang:
        return model
    counts = {lang: Counter(w for s in rows for w in s) for lang, rows in by_lang.items()}
    whole = sum(counts.values(), Counter())
    for lang, own in counts.items():
        model.lexicon |= {w: lang for w, n in own.items() if n >= SEEN and 10 * n >= 9 * whole[w]}
    seen = Counter(f for w, n in whole.items() for f in features(w, model.lexicon))
    model.index = {f: i + 1 for i, f in enumerate(f for f, n in seen.items() if n >= SEEN)}
    size = len(model.labels)
    model.weights, model.moves = np.zeros((len(model.index) + 1, size)), np.zeros((size, size))
    memory = (np.full_like(model.weights, 1e-8), np.full_like(model.moves, 1e-8))

    def learn(grads: tuple[tuple, np.ndarray]) -> None:
        """Adagrad; weights by rows."""
        (rows, grad), moves = grads
        memory[0][rows] += grad**2
        model.weights[rows] -= RATE * grad / np.sqrt(memory[0][rows])
        memory[1][:] += moves**2
        model.moves[:] -= RATE * moves / np.sqrt(memory[1])

    draw = np.random.default_rng(seed)
    single = [(k, s) for k, lang in enumerate(model.labels) for s in by_lang[lang]]
    for _ in range(EPOCHS):
        order = draw.permutation(len(single))
        pairs = [(single[a], single[b]) for a, b in zip(order, np.roll(order, 1), strict=True)]
        for start in range(0, len(pairs), BATCH):
            batch = []
            for (k, a), (j, b) in pairs[start : start + BATCH]:
                cut = int(draw.integers(0, len(b) + 1)) // 2
                batch.append((a + b[:cut], [k] * len(a) + [j] * cut))
            batch.sort(key=lambda s: -len(s[0]))
            rows = [[model.rows(w) for w in s] for s, _ in batch]
            flat = np.concatenate([r for s in rows for r in s]).astype(np.int64)
            word_of = np.repeat(np.arange(sum(map(len, rows))), [len(r) for s in rows for r in s])
            scores = np.add.reduceat(model.weights[flat], np.flatnonzero(np.diff(word_of, prepend=-1)))
            ends = np.cumsum([len(s) for s in rows])
            emit, lengths = padded(np.split(scores, ends[:-1]), size)
            moves = np.exp(model.moves)
            post, ahead, back = forward_backward(emit, lengths, moves)
            grad_words, grad_moves = [], np.zeros_like(moves)
            for i, (_, gold) in enumerate(batch):
                n = len(gold)
                delta = post[:n, i].copy()
                delta[np.arange(n), gold] -= 1
                grad_words.append(delta)
                both = ahead[: n - 1, i, :, None] * moves * (emit[1:n, i] * back[1:n, i])[:, None, :]
                both /= both.sum(axis=(1, 2), keepdims=True)
                grad_moves += both.sum(axis=0)
                np.add.at(grad_moves, (gold[:-1], gold[1:]), -1)
            grad = np.concatenate(grad_words)
            used, at = np.unique(flat, return_inverse=True)
            sums = np.stack([np.bincount(at, weights=grad[word_of, k], minlength=len(used)) for k in range(size)], axis=1)
            sums = sums / len(batch) + DECAY * model.weights[used]
            learn(((used, sums), grad_moves / len(batch) + DECAY * model.moves))
    model.weights = model.weights.astype(np.float32)
    return model


class Scores(dict):
    """Row of each word in a growing table of label scores; words are looked up together when new."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.fresh: list[str] = []
        self.table = np.zeros((0, len(model.labels)), np.float32)

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self.table) + len(self.fresh)
        self.fresh.append(word)
        return row

    def of(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self) > MEMO:
            self.clear()
            self.table = self.table[:0]
        found = [np.fromiter(map(self.__getitem__, t), np.int64, len(t)) for t in texts]
        if self.fresh:
            rows = [self.model.rows(w) for w in self.fresh]
            starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])[:-1]])
            sums = np.add.reduceat(self.model.weights[np.concatenate(rows).astype(np.int64)], starts)
            self.table, self.fresh = np.concatenate([self.table, sums]), []
        return [self.table[f] for f in found]


def predict(model: Model, scores: Scores, texts: list[str | None]) -> tuple[list[str], list[float]]:
    langs, sure = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if not model.labels:
        return langs, sure
    found = [_WORD.findall((t or "").lower()) for t in texts]
    order = sorted((i for i in range(len(texts)) if found[i]), key=lambda i: -len(found[i]))
    moves = np.exp(model.moves)
    start = 0
    while start < len(order):
        # Longest first: lanes times words is bounded, whatever one text's length.
        lanes = max(1, min(LANES, LANE_WORDS // len(found[order[start]])))
        some, start = order[start : start + lanes], start + lanes
        emit, lengths = padded(scores.of([found[i] for i in some]), len(model.labels))
        post, _, _ = forward_backward(emit, lengths, moves)
        for lane, i in enumerate(some):
            mean = post[: lengths[lane], lane].mean(axis=0)
            best = int(mean.argmax())
            langs[i], sure[i] = model.labels[best], float(min(1.0, mean[best]))
    return langs, sure


def sampled(docs: DataFrame) -> list[tuple[str, str]]:
    """(lang, window) of at most PER_LANG texts of a language, and about ALL_LANGS together."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(FOLDS) != HELD_OUT))
    # A row for each language, as many as the model has labels.
    sizes = known.groupBy("lang").count().collect()
    wanted = min(PER_LANG, max(20, ALL_LANGS // max(1, len(sizes))))
    # About three times as many as wanted by the hash's place, so that no task orders a whole language.
    shares = known.sparkSession.createDataFrame([(r.lang, (3 * wanted + 50) / r["count"]) for r in sizes], "of string, share double")
    hashed = F.xxhash64("doc_id")
    start = (F.abs(hashed % 1_000_003) % F.greatest(F.lit(1), F.length("text") - WINDOW_CHARS) + 1).cast("int")
    few = known.join(F.broadcast(shares), known["lang"] == shares["of"]).where(hashed / F.lit(2.0**64) + 0.5 <= F.col("share"))
    order = Window.partitionBy("lang").orderBy("hash", "doc_id", "start", "part")
    parts = few.select("lang", "doc_id", hashed.alias("hash"), start.alias("start"), F.col("text").substr(start, F.lit(WINDOW_CHARS)).alias("part"))
    top = parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)
    return sorted((r.lang, r.part) for r in top.select("lang", "part").collect())


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(shared.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start in range(0, len(texts), 1024):
                langs, sure = predict(shared.value, scores, texts[start : start + 1024])
                ids = batch.column("doc_id").slice(start, len(langs))
                yield pa.RecordBatch.from_arrays([ids, pa.array(langs), pa.array(sure, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, lang_pred string, score double")


def op10_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = identified(docs, train(sampled(docs)))
    return found.select("doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
