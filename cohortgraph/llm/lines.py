"""Substring de-duplication by hashing lines, the long sentences inside them, and runs of words.

A unit ends at a line break or after a sentence of at least ``MIN_WORDS`` words; shorter
sentences go with the long one after them, or at the end of the line with the one before.
So unit borders follow from the words near them, and a passage that is set into another
line still falls into the same units, but for its edges.

Beside these, the words of the whole text are dealt into runs, whatever lines and sentences they
stand in. A run begins where the hash of two neighbouring words is the least of all within
``REACH`` words to both sides. That depends on the words nearby only, so that runs are the same
inside any copy of a passage, and no run between two borders has fewer than ``MIN_WORDS`` words.
In scripts without spaces between words a character is half a word.

Units are lower-cased and white space in them made single, then hashed to 128 bits. Of all units
of one digest the earliest, by (doc_id, row, offset), stays; the others are cut out, once where
they overlap. Each cut points to an earlier copy, so the earliest copy of every word stays. What
remains keeps its offsets in the original.

Hot passages: digests are reduced to their first occurrence before the shuffle, and the way
back is a join with one row for each repeated digest, whose unit side may be split.

Defined results: null and empty texts, and texts of fewer than ``MIN_WORDS`` words, have no
units and stay as they are, and so does a short line that repeats without its neighbours; null ids rank last; repeated rows are one document, so they keep or
lose the same; an empty table gives an empty table. Extra columns are passed through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortgraph.llm.common import content_key, documents, guarded, keep, unsent
from cohortgraph.llm.hashing import word_hashes

MIN_WORDS = 8
#: Words to both sides of which a border of a run has the least hash.
REACH = MIN_WORDS - 1
_CUT = re.compile(r"[.!?]+[ \t]+|\n+")
#: Scripts without spaces between words (Thai to Khmer, kana, Chinese characters).
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_UNSPACED}]|[^\s{_UNSPACED}]+")
_IS_UNSPACED = re.compile(f"[{_UNSPACED}]")
_BLANKS = np.array([9, 10, 11, 12, 13, 32], np.uint8)
#: Unspaced scripts, and white space that is not ASCII's.
_IS_ODD = re.compile(rf"[{_UNSPACED}\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def units(text: str) -> list[tuple[int, int]]:
    """Start and end of each unit in code points; a unit holds the white space after it."""
    found: list[list[int]] = []
    start = sentence = 0
    in_line = False
    for end in [*(m.end() for m in _CUT.finditer(text)), len(text)]:
        closes = end == len(text) or text[end - 1] == "\n"
        if len(text[sentence:end].split()) >= MIN_WORDS or closes and len(text[start:end].split()) >= MIN_WORDS:
            found.append([start, end])
            start, in_line = end, True
        elif closes:
            if in_line:
                found[-1][1] = end
            start = end
        in_line &= not closes
        sentence = end
    return [(a, b) for a, b in found]


def _least(keys: np.ndarray, reach: int) -> np.ndarray:
    """Whether a key is less than all others within ``reach``."""
    least = np.ones(len(keys), bool)
    for by in range(1, min(reach, len(keys) - 1) + 1):
        least[by:] &= keys[by:] < keys[:-by]
        least[:-by] &= keys[:-by] < keys[by:]
    return least


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _gaps(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word of ``data``; words end at ASCII white space."""
    gaps = np.isin(np.frombuffer(b" " + data + b" ", np.uint8), _BLANKS)
    turns = np.flatnonzero(gaps[1:] != gaps[:-1])
    return turns[0::2], turns[1::2]


def _words(text: str) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray]:
    """Start and end of each word in code points, the lower-cased words with single blanks between
    them, and which words are characters of unspaced scripts."""
    if not _IS_ODD.search(text):
        data = _bytes(text)
        starts, ends = _gaps(data)
        if len(data) != len(text):
            before = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
            starts, ends = before[starts], before[ends]
        return starts, ends, b" ".join(_bytes(text.lower()).split()), np.zeros(len(starts), bool)
    places = [m.span() for m in _WORD.finditer(text)]
    words = [text[a:b] for a, b in places]
    unspaced = np.fromiter((_IS_UNSPACED.match(w) is not None for w in words), bool, len(words))
    at = np.array(places, np.int64).reshape(-1, 2)
    return at[:, 0], at[:, 1], _bytes(" ".join(words).lower()), unspaced


def runs(text: str) -> list[tuple[int, int, bytes]]:
    """Start, end and words of each run; white space after it belongs to it unless it ends a line."""
    starts, ends, words, unspaced = _words(text)
    n = len(starts)
    if n < MIN_WORDS:
        return []
    hashes, at = word_hashes(words)
    keys = hashes * np.uint64(0x9E3779B97F4A7C15)
    keys[:-1] += hashes[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    keys ^= keys >> np.uint64(31)
    keys *= np.uint64(0xBF58476D1CE4E5B9)
    least = _least(keys, REACH)
    halves = np.where(unspaced, 1, 2)
    if unspaced.any():
        least &= ~unspaced | _least(keys, 2 * MIN_WORDS - 1)
    least[0] = True
    borders = np.flatnonzero(least)
    long = np.add.reduceat(halves, borders) >= 2 * MIN_WORDS
    found = []
    after = np.append(starts, len(text))[np.append(borders[1:], n)]
    last = ends[np.append(borders[1:], n) - 1]
    edges = np.append(at, len(words) + 1)[np.append(borders, n)].tolist()
    rows = zip(starts[borders].tolist(), last.tolist(), after.tolist(), edges[:-1], edges[1:], long.tolist(), strict=True)
    for start, end, to, a, b, enough in rows:
        if enough:
            found.append((start, end if "\n" in text[end:to] else to, words[a : b - 1]))
    return found


def keyed_units(text: str) -> list[tuple[int, int, int, bytes]]:
    """Key, start, end and words of each unit; keys rise with the start."""
    return [(2 * a, a, b, _bytes(" ".join(text[a:b].lower().split()))) for a, b in units(text)]


def keyed_parts(text: str) -> list[tuple[int, int, int, bytes]]:
    """Units and runs."""
    return sorted([*keyed_units(text), *((2 * a + 1, a, b, words) for a, b, words in runs(text))])


Find = Callable[[str], list[tuple[int, int, int, bytes]]]


def digest(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=16).digest()


def unit_table(docs: DataFrame, find: Find = keyed_units) -> DataFrame:
    """(doc_id, _row, start, digest) of all units of docs (doc_id, _row, text); ``start`` is the key."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, digests = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for key, _, _, unit in find(text or ""):
                    rows.append(row)
                    starts.append(key)
                    digests.append(digest(unit))
            at = pa.array(rows, pa.int64())
            columns = [batch.column("doc_id").take(at), batch.column("_row").take(at), pa.array(starts, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.binary())], names=["doc_id", "_row", "start", "digest"])

    return docs.select(F.col("doc_id").cast("long"), "_row", "text").mapInArrow(
        cut, "doc_id long, _row long, start long, digest binary"
    )


def without_spans(docs: DataFrame, find: Find = keyed_units) -> DataFrame:
    """Cuts the units of the keys ``_cuts`` out of ``text``; adds ``_spans``, (start, end) each.

    What lies in several units is cut once, by the first; a unit that others have cut whole
    has no span, and its entry in ``_kept_in`` goes.
    """
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([*docs.schema.fields, T.StructField("_spans", T.ArrayType(span))])
    place, kept_place = docs.columns.index("text"), docs.columns.index("_kept_in")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, spans, kept = [], [], []
            columns = batch.columns
            by_row = (batch.column(c).to_pylist() for c in ("text", "_cuts", "_kept_in"))
            for text, cuts, kept_in in zip(*by_row, strict=True):
                gone, stays_in = [], []
                if cuts:
                    at = 0
                    of = dict(zip(cuts, kept_in, strict=True))
                    for key, start, end, _ in find(text):
                        # What is left of a part may be blank: then it stays.
                        if key in of and end > at and not text[max(start, at) : end].isspace():
                            gone.append((max(start, at), end))
                            stays_in.append(of[key])
                            at = end
                    edges = [0, *(x for s in gone for x in s), len(text)]
                    text = "".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2], strict=True))
                texts.append(text)
                spans.append([{"start": a, "end": b} for a, b in gone])
                kept.append(stays_in)
            columns[place] = pa.array(texts, columns[place].type)
            columns[kept_place] = pa.array(kept, columns[kept_place].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], names=schema.names)

    return docs.mapInArrow(cut, schema)


def dedup_units(docs: DataFrame, find: Find = keyed_units) -> DataFrame:
    """``docs`` (doc_id, text, _row, more) with repeated units cut out of ``text``.

    Adds ``_spans``, the cut parts as (start, end) of the original text, and ``_kept_in``,
    the ids of the documents that hold their earliest copies, in the same order.
    """
    table = keep(unit_table(docs, find), "units")
    # Keys are twice the offset, and one more for a run.
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row", "start")
    firsts = table.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).where("n > 1")
    again = table.join(unsent(firsts.select("digest", "first")), "digest").where(
        ~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        | (F.col("_row") != F.col("first._row"))
        # A unit and a run that begin at one place are one passage.
        | (F.shiftright("start", 1) != F.shiftright("first.start", 1))
    )
    cuts = (
        again.groupBy("doc_id", "_row")
        .agg(F.array_sort(F.collect_set(F.struct("start", F.col("first.doc_id").alias("kept_in")))).alias("c"))
        .select(F.col("doc_id").alias("_of"), F.col("_row").alias("_of_row"), F.col("c.start").alias("_cuts"), F.col("c.kept_in").alias("_kept_in"))
    )
    same = (F.col("_row") == F.col("_of_row")) & F.col("doc_id").eqNullSafe(F.col("_of"))
    marked = docs.join(unsent(keep(cuts, "cuts")), same, "left").drop("_of", "_of_row")
    return without_spans(marked.withColumn("_kept_in", F.coalesce("_kept_in", F.array().cast("array<bigint>"))), find).drop("_cuts")


@guarded
def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what an earlier one holds cut out; ``n_chars`` counts what is left."""
    found = dedup_units(docs.withColumn("_row", content_key()), keyed_parts).withColumn("n_chars", F.length("text").cast("long"))
    return found.select(*docs.columns)


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text").withColumn("_row", content_key())
    return dedup_units(docs, keyed_parts).select(
        "doc_id",
        "text",
        F.size("_spans").cast("long").alias("n_removed"),
        F.col("_spans").alias("removed"),
        F.col("_kept_in").alias("kept_in"),
    )
