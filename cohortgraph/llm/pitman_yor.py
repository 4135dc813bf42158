"""Hierarchical Pitman-Yor language model: Gibbs-seated restaurants, averaged predictions.

Each word v is a restaurant whose customers are the words that follow it in the training
texts; all restaurants share one parent, whose customers are their tables and whose base is
uniform over the vocabulary and one unknown word:

    p(w | v) = (c_vw - d t_vw + (a + d t_v) p(w)) / (a + c_v),   t averaged over samples.

The corpus is dealt once, in compact blocks of word hashes, to buckets of contexts. A bucket
groups its (v, w) pairs, seats their customers and sends, for each word it holds, its tables
and training count to that word's bucket, which answers with the totals over all buckets;
with them the bucket scores its pairs, and the shares are added up for each text. All that
travels grows with the input, and nothing but a few sums reaches the driver. The dealt
blocks are read twice, for seating and for scoring; Spark reuses that exchange. Seating is
a function of the bucket's content and a seed; the tables found travel with the totals, by
way of the bucket of words of the same number, so that scoring need not seat anew.

A task holds one block of tokens, ordered by bucket a slice of texts at a time, or the
pairs of one bucket; what is grouped is numbered in 32 bits and read where Arrow has it.

A context that holds more than a small part of a bucket (a hot word) is dealt by the pair
instead, and its totals travel like those of a word.

Seating: pairs of 2 to ``GIBBS_MOST`` customers hold a table number for each customer;
sweeps take each customer out and seat them again, at a table in proportion to its size
less the discount, or at a new one. All pairs of a bucket move at once, with the table count
of their restaurant from before the step. Of larger pairs all customers are taken out and seated
anew together in each sweep: their number of tables is drawn by its law given the tables of all
other pairs, with no seating left out (``Counts``). Seating needs p(w), which is not known before
the exchange; the bucket's own share of the word stands in for it.

Defined results: a null or empty text is its end token alone; a null id counts as empty text
for the fold; repeated rows are separate texts; without training texts every prediction is
the uniform base; an empty table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.llm.common import documents
from cohortgraph.llm.hashing import hashed_texts, mix, sliced_texts

STRENGTH = 1.0
GIBBS_MOST = 32
BURN_IN, SAMPLES = 2, 3
BLOCK_TOKENS = 1 << 22
BUCKET_TOKENS = 4_000_000
SLICE_BYTES = 1 << 21
#: Of a block's rows, so many bytes are handed on at a time.
BATCH_BYTES = 1 << 22
#: So many pairs look for a free table at a time.
OPEN_AT_ONCE = 1 << 14
#: So many cells of the law of a pair's tables are weighed at a time.
CELLS = 1 << 14
#: A context with more than this share of a mean bucket is dealt by the pair.
HOT_SHARE = 1 / 8
FOLDS, HELD_OUT = 7, 2

#: Hashes that stand for the end of a text, its beginning as a context, and a context among words.
END, BEGIN, AS_CONTEXT = np.uint64(0x1E5D), np.uint64(0xBE61), np.uint64(0x5851F42D4C957F2D)
_K = np.uint64(0x9E3779B97F4A7C15)


def token_pairs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, word and text number of every token; the last of each text is its end."""
    hashes, firsts = hashed_texts([t.lower() for t in texts])
    after = np.insert(hashes, firsts[1:], END)
    before = np.insert(hashes, firsts[:-1], BEGIN)
    return before, after, np.repeat(np.arange(len(texts)), np.diff(firsts) + 1)


def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD_OUT


def frequent(docs: DataFrame) -> DataFrame:
    """(key, n, train): tokens of contexts that are frequent in a batch; key null: all tokens, and those of training."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.array([held_out(i) for i in batch.column("doc_id").to_pylist()], bool)
            found, tokens, train = [], 0, 0
            for start, texts in sliced_texts(batch.column("text"), SLICE_BYTES):
                before, _, text = token_pairs(texts)
                found.append(np.unique(before, return_counts=True))
                tokens += len(before)
                train += int((~held[text + start]).sum())
            if not found:
                continue
            keys, of = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            n = np.bincount(of, weights=np.concatenate([c for _, c in found])).astype(np.int64)
            often = n >= max(64, tokens // 1000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None, *keys[often].view(np.int64).tolist()], pa.int64()),
                    pa.array([tokens, *n[often].tolist()], pa.int64()),
                    pa.array([train, *[0] * int(often.sum())], pa.int64()),
                ],
                names=["key", "n", "train"],
            )

    return docs.select("doc_id", "text").mapInArrow(work, "key long, n long, train long")


def narrow(values: np.ndarray) -> np.ndarray:
    """Non-negative integers in the fewest bytes."""
    top = int(values.max(initial=0))
    return values.astype(next(t for t in ("u1", "<u2", "<u4", "<u8") if top < 256 ** int(t[-1])))


def packed(*arrays: np.ndarray) -> bytes:
    head = np.array([x for a in arrays for x in (a.size, a.dtype.itemsize)], "<i8")
    return b"".join([np.array([len(arrays)], "<i8").tobytes(), head.tobytes(), *(a.tobytes() for a in arrays)])


def unpacked(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    head = np.frombuffer(data, "<i8", 2 * n, 8).reshape(n, 2).tolist()
    at, arrays = 8 + 16 * n, []
    for size, width in head:
        arrays.append(np.frombuffer(data, f"<u{width}", size, at))
        at += size * width
    return arrays


def buckets_of(before: np.ndarray, after: np.ndarray, hot: np.ndarray, n: int) -> np.ndarray:
    split = np.isin(before, hot)
    own = mix(before)
    return (np.where(split, mix(own ^ after * _K), own) % np.uint64(n)).astype(np.int64)


def dealt(docs: DataFrame, hot: np.ndarray, n: int) -> DataFrame:
    """(bucket, block, data, heads): blocks of a task's texts, cut by bucket; one row of a block lists its texts.

    Training texts come first in the numbering of a block's texts.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"bucket int, block long, data binary, heads array<struct<doc_id:{kind},held:boolean,n:bigint>>"
    names = ["bucket", "block", "data", "heads"]

    def by_bucket(before: np.ndarray, after: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
        """Tokens of a slice in the order of buckets, and where each bucket begins."""
        bucket = narrow(buckets_of(before, after, hot, n))
        order = np.argsort(bucket, kind="stable")
        edges = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=n))])
        return before[order], after[order], text[order].astype(np.uint32), edges

    def row(v: np.ndarray, w: np.ndarray, d: np.ndarray, train: int) -> bytes:
        near = ((mix(v * _K) >> np.uint64(40)) << np.uint64(24)) | (mix(w ^ v * _K) >> np.uint64(40))
        # In the order of (context, pair), up to hash ties, which only cost bytes.
        by_pair = np.argsort(near, kind="stable")
        v, w, d = v[by_pair], w[by_pair], d[by_pair]
        new_v = np.concatenate([[True], v[1:] != v[:-1]])[: len(v)]
        new = new_v | np.concatenate([[True], w[1:] != w[:-1]])[: len(v)]
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(v)))
        heads_at = np.flatnonzero(new_v[at])
        pairs = np.diff(np.append(heads_at, len(at)))
        return packed(v[new_v], narrow(pairs), w[at], narrow(counts), narrow(d), np.array([train], "<u8"))

    def block_rows(block: int, parts: list, ids: list, sizes: list, kind_: pa.DataType) -> Iterator[pa.RecordBatch]:
        """Of ``parts``, from by_bucket, one bucket at a time is put together."""
        held = np.array([held_out(i) for i in ids], bool)
        order = np.argsort(held, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        train = int((~held).sum())
        sizes = np.concatenate(sizes)
        item = pa.list_(pa.struct([("doc_id", kind_), ("held", pa.bool_()), ("n", pa.int64())]))
        found, data, heads, size = [], [], [], 0
        for b in range(n):
            v, w, d = (np.concatenate([part[i][part[3][b] : part[3][b + 1]] for part in parts]) for i in range(3))
            if not len(v) and b != block % n:
                continue
            found.append(b)
            data.append(row(v, w, place[d], train))
            heads.append([{"doc_id": ids[i], "held": bool(held[i]), "n": int(sizes[i])} for i in order] if b == block % n else None)
            size += len(data[-1])
            if size >= BATCH_BYTES:
                yield batch_of(found, block, data, heads, item)
                found, data, heads, size = [], [], [], 0
        if found:
            yield batch_of(found, block, data, heads, item)

    def batch_of(found: list, block: int, data: list, heads: list, item: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array([block] * len(found), pa.int64()), pa.array(data, pa.binary()), pa.array(heads, item)],
            names=names,
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 24
        parts, ids, sizes, tokens, id_kind = [], [], [], 0, None
        for batch in batches:
            id_kind = batch.column("doc_id").type
            all_ids = batch.column("doc_id").to_pylist()
            for start, texts in sliced_texts(batch.column("text"), SLICE_BYTES):
                v, w, d = token_pairs(texts)
                parts.append(by_bucket(v, w, d + len(ids)))
                sizes.append(np.bincount(d, minlength=len(texts)))
                ids.extend(all_ids[start : start + len(texts)])
                tokens += len(v)
                if tokens >= BLOCK_TOKENS:
                    yield from block_rows(block, parts, ids, sizes, id_kind)
                    parts, ids, sizes, tokens, block = [], [], [], 0, block + 1
        if ids:
            yield from block_rows(block, parts, ids, sizes, id_kind)

    return docs.select("doc_id", "text").mapInArrow(work, schema)


class Counts:
    """Draws of the number of tables of pairs, over all seatings of their customers.

    A seating of n customers of one word in t tables weighs with (a + d (others + j)) p(w) for each
    table j opened after the first, and by the sizes of the tables as one without a parent does. All
    seatings in t tables taken together, the latter make the law of the tables of n customers at
    discount d and strength 0: a table comes with customer n + 1 at probability d t / n. So

        P(t) ~ law_n(t) * prod of p(w) (a + d (others + j)) / (d j) for j = 1 .. t - 1.

    The laws of all ``sizes`` come out of one pass over the customers of the largest; they are kept up to a
    number of tables above which the weights add nothing that a double holds.
    """

    def __init__(self, sizes: np.ndarray, d: float):
        self.sizes, self.of = np.unique(sizes, return_inverse=True)
        self.d = d
        self.reach = np.zeros(len(self.sizes), np.int64)
        self.order = np.argsort(self.of, kind="stable")
        self.edges = np.searchsorted(self.of[self.order], np.arange(len(self.sizes) + 1))

    def _laws(self, reach: np.ndarray) -> list[np.ndarray]:
        """Logarithms of law_n(1), law_n(2), .. for each size n."""
        self.reach = reach
        widths = np.maximum.accumulate(reach[::-1])[::-1].tolist()
        # Wide exponents: many tables are very unlikely a priori, whatever the parent makes of them.
        law, n, laws = np.zeros(widths[0], np.longdouble), 1, []
        law[0] = 1
        rate = np.arange(1, widths[0] + 1, dtype=np.longdouble) * self.d
        for size, width, kept in zip(self.sizes.tolist(), widths, reach.tolist(), strict=True):
            law, rate = law[:width], rate[:width]
            opened = np.empty_like(law)
            while n < size:
                np.multiply(law, rate, out=opened)
                opened /= n
                law -= opened
                law[1:] += opened[:-1]
                n += 1
            with np.errstate(divide="ignore"):
                laws.append(np.log(law[:kept]).astype(np.float64))
        return laws

    def draw(self, others: np.ndarray, base: np.ndarray, rng) -> np.ndarray:
        """Tables of each pair; ``others``: of the other pairs of its restaurant, ``base``: p(w)."""
        strength, d, n = STRENGTH + self.d * others, self.d, self.sizes[self.of]
        # Without the sizes of tables P(t) is negative binomial, without the parent it has strength ``strength``.
        spread = 1 / (1 - base)
        mean = (strength / d + 1) * base * spread
        free = (strength / d + 1) * (1 + n / strength) ** d
        most = np.minimum(np.minimum(mean + 12 * np.sqrt(mean * spread) + 40 * spread, 12 * free + 60).astype(np.int64) + 1, n)
        reach = np.zeros(len(self.sizes), np.int64)
        np.maximum.at(reach, self.of, most)
        if (reach > self.reach).any():
            self.laws = self._laws(np.minimum(np.maximum(self.reach, reach + reach // 2), self.sizes))
        t = np.empty(len(self.of), np.int64)
        for law, width, a, b in zip(self.laws, reach.tolist(), self.edges[:-1].tolist(), self.edges[1:].tolist(), strict=True):
            j = np.arange(1, width) * d
            for at in range(a, b, max(1, CELLS // width)):
                pairs = self.order[at : min(b, at + max(1, CELLS // width))]
                weight = np.zeros((len(pairs), width))
                np.cumsum(np.log(base[pairs, None] * (strength[pairs, None] + j) / j), axis=1, out=weight[:, 1:])
                weight += law[:width]
                weight -= weight.max(axis=1, keepdims=True)
                upto = np.cumsum(np.exp(weight, out=weight), axis=1, out=weight)
                t[pairs] = 1 + (upto <= rng.random((len(pairs), 1)) * upto[:, -1:]).sum(axis=1)
        return t


def _reseat(c: np.ndarray, of: np.ndarray, restaurants: int, base: np.ndarray, d: float, rng) -> Iterator[np.ndarray]:
    """Table counts of each pair after each sweep; ``c`` customers, restaurant ``of``, parent's ``base``."""
    t = np.minimum(c, 1)
    few = np.flatnonzero((c > 1) & (c <= GIBBS_MOST))
    few = few[np.argsort(-c[few], kind="stable")]
    width = int(c[few].max(initial=1))
    seats = np.zeros((len(few), width), np.int8)
    seats[np.arange(width) >= c[few][:, None]] = -1
    many = np.flatnonzero(c > GIBBS_MOST)
    counts = Counts(c[many], d)
    while True:
        for j in range(width):
            live = few[: np.searchsorted(-c[few], -j, side="left")]  # with more than j customers
            if not len(live):
                break
            tables = np.bincount(of, weights=t, minlength=restaurants)
            rows, size = seats[: len(live)], c[live]
            old = rows[:, j]
            alone = (rows == old[:, None]).sum(axis=1) == 1
            rest = t[live] - alone
            new = (STRENGTH + d * (tables[of[live]] - alone)) * base[live]
            stay = np.maximum(size - 1 - d * rest, 0)
            opens = rng.random(len(live)) * (new + stay) < new
            # A table in proportion to size - d: of a random other customer, accepted at (size - d) / size.
            chosen = old.copy()
            open_rows = np.flatnonzero(~opens)
            while len(open_rows):
                other = (rng.random(len(open_rows)) * (size[open_rows] - 1)).astype(np.int64)
                other += other >= j
                table = rows[open_rows, other]
                n = (rows[open_rows] == table[:, None]).sum(axis=1) - (table == old[open_rows])
                sure = rng.random(len(open_rows)) * n < n - d
                chosen[open_rows[sure]] = table[sure]
                open_rows = open_rows[~sure]
            if opens.any():
                every = np.flatnonzero(opens)
                for at in (every[i : i + OPEN_AT_ONCE] for i in range(0, len(every), OPEN_AT_ONCE)):
                    used = np.zeros((len(at), GIBBS_MOST + 1), bool)
                    others = rows[at]
                    others[:, j] = -1
                    used[np.repeat(np.arange(len(at)), width), np.where(others < 0, GIBBS_MOST, others).ravel()] = True
                    chosen[at] = np.argmin(used[:, :GIBBS_MOST], axis=1)
            rows[:, j] = chosen
            t[live] = rest + opens
        if len(many):
            tables = np.bincount(of, weights=t, minlength=restaurants)
            t[many] = counts.draw(tables[of[many]] - t[many], base[many], rng)
        yield t


def buffers(column: pa.ChunkedArray) -> list[pa.Buffer | None]:
    """The values of a binary column where they lie, not copied."""
    return [x.as_buffer() if x.is_valid else None for chunk in column.chunks for x in chunk]


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different key, in ascending order, stands first, and the number of every key among them."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(keys)]
    del ordered
    of = np.empty(len(keys), np.int32)
    of[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return order[new], of


class Bucket:
    """The pairs of a bucket, grouped over its blocks, and their averaged tables."""

    def __init__(self, table: pa.Table, hot: np.ndarray, n: int, seed: int, seats: np.ndarray | None = None):
        """``seats``: as an earlier Bucket of the same rows found them; else customers are seated."""
        numbers = table["block"].to_pylist()
        order = sorted(range(len(numbers)), key=numbers.__getitem__)
        #: Of each row, in the order of blocks: its number, and its place in the table.
        self.blocks = [(numbers[i], i) for i in order]
        data = buffers(table["data"])
        contexts, pairs_of, words, trained, self.texts, self.counts = [], [], [], [], [], []
        for i in order:
            v, pairs, w, counts, text, train = unpacked(data[i])
            contexts.append(v)
            pairs_of.append(pairs)
            words.append(w)
            at = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            seen = np.concatenate([[0], np.cumsum(text < train[0])])
            trained.append((seen[at[1:]] - seen[at[:-1]]).astype(np.int32))
            self.texts.append(text)
            self.counts.append(counts)
        self.ends = np.cumsum([len(w) for w in words])
        words, contexts, pairs = np.concatenate(words), np.concatenate(contexts), np.concatenate(pairs_of).astype(np.int64)
        first, self.word_of = grouped(words)
        self.words = words[first]
        words ^= np.repeat(mix(contexts * _K), pairs)  # now a key for each pair
        first, self.kind_of = grouped(words)
        del words
        restaurants, of = np.unique(contexts, return_inverse=True)
        self.v = np.repeat(of.astype(np.int32), pairs)[first]
        self.w = self.word_of[first]
        del contexts, pairs, of
        c = np.bincount(self.kind_of, weights=np.concatenate(trained), minlength=len(first)).astype(np.int64)
        del trained, first
        self.c = c
        self.word_counts = np.bincount(self.w, weights=c, minlength=len(self.words))
        self.c_v = np.bincount(self.v, weights=c, minlength=len(restaurants))
        once, twice = (c == 1).sum(), (c == 2).sum()
        self.d = min(0.95, max(0.05, float(once / (once + 2 * twice)))) if once + twice else 0.5
        several = c > 1
        if seats is None:
            seats = self._seats(len(restaurants), seed)[several]
        #: Of pairs with several customers: tables, summed over the samples. Others have one for each customer.
        self.seats = seats
        self.t = np.minimum(c, 1) * SAMPLES
        self.t[several] = seats
        self.t_v = np.bincount(self.v, weights=self.t, minlength=len(restaurants))
        self.split = np.flatnonzero(np.isin(restaurants, hot))
        context_keys = mix(restaurants[self.split] ^ AS_CONTEXT)
        # What is asked for: words, then split contexts, each with its own tables and customers.
        keys = np.concatenate([self.words, context_keys])
        is_word = np.arange(len(keys)) < len(self.words)
        tables = np.concatenate([np.bincount(self.w, weights=self.t, minlength=len(self.words)), self.t_v[self.split]])
        customers = np.concatenate([self.word_counts, self.c_v[self.split]])
        self.to = (mix(keys) % np.uint64(n)).astype(np.int64)
        self.order = np.argsort(self.to, kind="stable")
        self.asked = [x[self.order] for x in (keys, is_word, tables.astype(np.int64), customers.astype(np.int64))]

    def _seats(self, restaurants: int, seed: int) -> np.ndarray:
        """Tables of each pair, summed over the samples: whole numbers."""
        total = max(1.0, self.word_counts.sum())
        seen = np.flatnonzero(self.c)
        base = (self.word_counts[self.w[seen]] + 1) / (total + len(self.words) + 1)
        t = np.zeros(len(self.c), np.int64)
        rng = np.random.default_rng(seed)
        for sweep, tables in enumerate(_reseat(self.c[seen], self.v[seen], restaurants, base, self.d, rng)):
            if sweep >= BURN_IN:
                t[seen] += tables
            if sweep == BURN_IN + SAMPLES - 1:
                break
        return t


def seated(blocks: DataFrame, hot: np.ndarray, n: int) -> DataFrame:
    """(to, bucket, data, seats): for each bucket of words what a bucket of contexts has of them; for itself its seats."""

    def work(table: pa.Table) -> pa.Table:
        number = table["bucket"][0].as_py()
        bucket = Bucket(table, hot, n, number)
        keys, is_word, tables, customers = bucket.asked
        edges = np.searchsorted(bucket.to[bucket.order], np.arange(n + 1))
        rows = [
            (to, number, packed(keys[a:b], narrow(is_word[a:b].astype(np.uint8)), narrow(tables[a:b]), narrow(customers[a:b])), None)
            for to, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))
            if b > a
        ]
        rows.append((number, number, None, packed(narrow(bucket.seats))))
        to, number, data, seats = zip(*rows, strict=True)
        return pa.table(
            {
                "to": pa.array(to, pa.int32()),
                "bucket": pa.array(number, pa.int32()),
                "data": pa.array(data, pa.binary()),
                "seats": pa.array(seats, pa.binary()),
            }
        )

    return blocks.groupBy("bucket").applyInArrow(work, "to int, bucket int, data binary, seats binary")


def answered(asked: DataFrame) -> DataFrame:
    """(bucket, to, data, seats, sums): totals for each asking bucket, in the order asked; bucket -1 has sums over the words.

    The seats of the bucket of this number go back as they came.

    Sums: vocabulary, customers of the parent, its words with one and with two customers.
    """

    def reply(bucket: list, to: int, data: list, seats: list, sums: list) -> pa.Table:
        return pa.table(
            {
                "bucket": pa.array(bucket, pa.int32()),
                "to": pa.array([to] * len(bucket), pa.int32()),
                "data": pa.array(data, pa.binary()),
                "seats": pa.array(seats, pa.binary()),
                "sums": pa.array(sums, pa.list_(pa.float64())),
            }
        )

    def work(table: pa.Table) -> pa.Table:
        to = table["to"][0].as_py()
        seats = [x for x in table["seats"].to_pylist() if x is not None]
        rows = [(b, unpacked(d)) for b, d in zip(table["bucket"].to_pylist(), buffers(table["data"]), strict=True) if d is not None]
        if not rows:
            return reply([to], to, [None], seats, [None])
        keys = np.concatenate([r[1][0] for r in rows])
        is_word = np.concatenate([r[1][1] for r in rows])
        # A word and a context of one hash are different keys.
        known, first, of = np.unique(keys * np.uint64(2) + is_word, return_index=True, return_inverse=True)
        tables, customers = (
            np.bincount(of, weights=np.concatenate([r[1][i] for r in rows]).astype(np.float64)).astype(np.int64) for i in (2, 3)
        )
        word = (is_word[first] > 0) & (customers > 0)
        parent = tables[word] / SAMPLES
        sums = [float(word.sum()), float(parent.sum()), float((parent < 1.5).sum()), float(((parent >= 1.5) & (parent < 2.5)).sum())]
        data, at = [], 0
        for _, arrays in rows:
            here = of[at : at + len(arrays[0])]
            data.append(packed(narrow(tables[here]), narrow(customers[here])))
            at += len(arrays[0])
        asking = [b for b, _ in rows]
        back, none = [to] * len(seats), [None] * len(seats)
        no_seats = [None] * (len(rows) + 1)
        return reply([*asking, -1, *back], to, [*data, None, *none], [*no_seats, *seats], [*no_seats[1:], sums, *none])

    return asked.groupBy("to").applyInArrow(work, "bucket int, to int, data binary, seats binary, sums array<double>")


def shares(blocks: DataFrame, answers: DataFrame, hot: np.ndarray, n: int, train_tokens: int) -> DataFrame:
    """(block, data, heads): for texts of a block what a bucket adds to their scores."""
    schema = blocks.select("block", "data", "heads").schema

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        heads_type = left.schema.field("heads").type
        if not left.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "data": pa.array([], pa.binary()), "heads": pa.array([], heads_type)})
        replies, seats, sums = [], None, None
        for to, data, own, got in zip(*(right[c].to_pylist() for c in ("to", "data", "seats", "sums")), strict=True):
            if data is not None:
                replies.append((to, unpacked(data)))
            elif own is not None:
                seats = unpacked(own)[0]
            else:
                sums = got
        replies.sort(key=lambda r: r[0])
        bucket = Bucket(left, hot, n, left["bucket"][0].as_py(), seats)
        tables, customers = np.zeros(len(bucket.order)), np.zeros(len(bucket.order))
        for into, i in ((tables, 0), (customers, 1)):
            into[bucket.order] = np.concatenate([np.empty(0), *(r[1][i] for r in replies)])
        words = len(bucket.words)
        vocabulary, guests, once, twice = sums
        d0 = min(0.95, max(0.05, once / (once + 2 * twice))) if once + twice else 0.5
        # With a base this flat a word hardly ever opens a second table in the parent.
        own = np.where(customers[:words] > 0, np.maximum(tables[:words] / SAMPLES - d0, 0), 0)
        parent = (own + (STRENGTH + d0 * vocabulary) / (vocabulary + 1)) / (STRENGTH + guests)
        t_v, c_v = bucket.t_v.astype(np.float64), bucket.c_v.copy()
        t_v[bucket.split], c_v[bucket.split] = tables[words:], customers[words:]
        d, v, w = bucket.d, bucket.v, bucket.w
        p = np.maximum(bucket.c - d * bucket.t / SAMPLES, 0) + (STRENGTH + d * t_v[v] / SAMPLES) * parent[w]
        score = np.log10(p / (STRENGTH + c_v[v]))
        count = customers[:words]
        base = np.log10((count + 1) / (train_tokens + vocabulary + 1))
        data, start = [], 0
        for text, counts, end in zip(bucket.texts, bucket.counts, bucket.ends, strict=True):
            here = np.repeat(np.arange(start, end), counts)
            found, at = np.unique(text, return_inverse=True)
            word = bucket.word_of[here]
            sums_of = [np.bincount(at, weights=x, minlength=len(found)) for x in (score[bucket.kind_of[here]], base[word])]
            known = np.bincount(at, weights=count[word] > 0, minlength=len(found)).astype(np.int64)
            data.append(packed(narrow(found), sums_of[0].astype("<f4").view("<u4"), sums_of[1].view("<u8"), narrow(known)))
            start = end
        numbers, at = zip(*bucket.blocks, strict=True)
        return pa.table({"block": pa.array(numbers, pa.int64()), "data": pa.array(data, pa.binary()), "heads": left["heads"].take(pa.array(at))})

    return blocks.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(work, schema)


def scored(docs: DataFrame) -> DataFrame:
    """A row for each text of docs (doc_id, text): its tokens, base score and score."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    often = frequent(docs).groupBy("key").agg(F.sum("n").alias("n"), F.sum("train").alias("train"))
    whole = often.where("key IS NULL").first()
    tokens, train = (whole.n, whole.train) if whole else (0, 0)
    n = max(1, -(-tokens // BUCKET_TOKENS), min(int(spark.conf.get("spark.sql.shuffle.partitions")), tokens // 100_000))
    # At most n / HOT_SHARE contexts reach this share of all tokens.
    hot = often.where(F.col("key").isNotNull() & (F.col("n") > tokens / n * HOT_SHARE)).select("key").collect()
    hot = np.array([r.key for r in hot], np.int64).view(np.uint64)
    blocks = dealt(docs, hot, n)
    answers = answered(seated(blocks, hot, n))
    total = answers.where("bucket = -1").agg(F.array(*(F.sum(F.col("sums")[i]) for i in range(4))).alias("sums"))
    everywhere = total.select(
        F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("bucket"), F.lit(-1).alias("to"), F.lit(None).cast("binary").alias("data"), F.lit(None).cast("binary").alias("seats"), "sums"
    )
    replies = answers.where("bucket >= 0").unionByName(everywhere)
    parts = shares(blocks, replies, hot, n, train)

    def add_up(table: pa.Table) -> pa.Table:
        heads = next(h for h in table["heads"].to_pylist() if h is not None)
        score, base, known = np.zeros(len(heads)), np.zeros(len(heads)), np.zeros(len(heads), np.int64)
        # Buckets come in any order; sums are taken in one order, so that reruns agree.
        for data in sorted(table["data"].to_pylist()):
            text, s, b, k = unpacked(data)
            score[text] += s.view("<f4")
            base[text] += b.view("<f8")
            known[text] += k.astype(np.int64)
        item = table.schema.field("heads").type.value_type
        ids = pa.array([h["doc_id"] for h in heads], item.field("doc_id").type)
        return pa.table(
            {
                "doc_id": ids,
                "held_out": pa.array([h["held"] for h in heads], pa.bool_()),
                "n_tokens": pa.array([h["n"] for h in heads], pa.int64()),
                "n_known": pa.array(known),
                "train_tokens": pa.array([train] * len(heads), pa.int64()),
                "base_score": pa.array(base),
                "score": pa.array(score),
            }
        )

    return parts.groupBy("block").applyInArrow(
        add_up,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def op2_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(documents(spark, sf_dir))
