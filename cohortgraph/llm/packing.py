"""Hierarchical packing of token ids into windows of several lengths.

Each task tokenizes and packs the documents of its own partition, with no shuffle, in chunks
of about ``CHUNK_TOKENS`` tokens, so its memory does not grow with the partition. In a chunk:

1. Whole windows of the longest length are cut off long documents.
2. What is left of each document goes to the tier of the shortest window that holds it.
3. From the longest tier down, each piece opens a window of its tier. The gap is filled with
   the longest pieces of shorter tiers that fit, and then exactly, by cutting one more piece
   (of the same tier if no shorter one is left). The shortest tier fills its own windows.
4. Pieces that can't fill a window go on to the next chunk. The last of a partition, less
   than one window, is split at powers of two, so that no sequence needs padding.

Windows of one length form step groups of ``STEP_TOKENS`` tokens each, so steps weigh alike.

Defined results: a null or empty text has the end id alone; repeated rows and null ids are
packed like any other; an empty table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortgraph.llm.common import documents
from cohortgraph.llm.hashing import slices, texts_of

WINDOWS = (512, 1024, 2048, 4096)
END = 2
STEP_TOKENS = 1 << 16
CHUNK_TOKENS = 1 << 20
SLICE_BYTES = 1 << 21
MEMO = 400_000
TOKENIZER = "word_bpe_49k.json"

#: The tokenizer's word pattern, for lower-case Latin-1 texts.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words(dict):
    """Ids of each white-space word as bytes (unsigned 32-bit, little-endian), remembered.

    The tokenizer's own normaliser and word pattern cost far more than its merges, so words
    of plain Latin letters, digits and signs are split here and only merged by its model;
    any other word goes through the whole tokenizer. Words never merge across white space.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def merged(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            letters = piece.encode().decode("latin-1").translate(self.letters)
            known = np.array([t.id for t in self.tokenizer.model.tokenize(letters)], "<u4").tobytes()
            if len(self.pieces) >= MEMO:
                self.pieces.clear()
            self.pieces[piece] = known
        return known

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text) and "<|" not in text and len(text) < 1000:
            ids = b"".join(map(self.merged, _PIECE.findall(text.lower())))
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) >= MEMO:
            self.clear()
        if len(word) < 100:
            self[word] = ids
        return ids

    def encode(self, text: bytes) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, text.split())) + END.to_bytes(4, "little"), "<u4")


_LOADED: dict[str, Words] = {}


def loaded(path: str) -> Words:
    if path not in _LOADED:
        _LOADED[path] = Words(path)
    return _LOADED[path]


class Packer:
    """Pieces are (length, document, start); windows are lists of pieces."""

    def __init__(self, windows: Iterable[int] = WINDOWS):
        self.windows = sorted(windows)
        self.left: list[tuple[int, int, int]] = []

    def _fill(self, gap: int, pool: list) -> list:
        """Pieces from the sorted ``pool`` for ``gap``: longest that fit, then one that is cut."""
        got = []
        while gap and pool:
            at = bisect_right(pool, (gap, float("inf"))) - 1
            length, doc, start = pool.pop(max(at, 0))
            if length > gap:
                insort(pool, (length - gap, doc, start + gap))
                length = gap
            got.append((length, doc, start))
            gap -= length
        return got

    def pack(self, lengths: Iterable[tuple[int, int]]) -> Iterator[tuple[int, list]]:
        """(window, pieces) of all that fills windows; the rest stays in ``left``."""
        longest = self.windows[-1]
        tiers: dict[int, list] = {w: [] for w in self.windows}
        for length, doc, start in [*self.left, *((n, d, 0) for d, n in lengths)]:
            while length >= longest:
                yield longest, [(longest, doc, start)]
                length, start = length - longest, start + longest
            if length:
                tiers[next(w for w in self.windows if w >= length)].append((length, doc, start))
        own: list[tuple[int, int, int]] = []
        for i in range(len(self.windows) - 1, -1, -1):
            window = self.windows[i]
            own = sorted([*own, *tiers[window]])
            shorter = sorted(p for w in self.windows[:i] for p in tiers[w])
            total = sum(p[0] for p in own) + sum(p[0] for p in shorter)
            while own and total >= window:
                length, doc, start = own.pop()
                if length > window:
                    insort(own, (length - window, doc, start + window))
                    length = window
                pieces = [(length, doc, start), *self._fill(window - length, shorter)]
                yield window, pieces + self._fill(window - sum(p[0] for p in pieces), own)
                total -= window
            for w in self.windows[:i]:
                tiers[w] = []
            for piece in shorter:
                tiers[next(w for w in self.windows[:i] if w >= piece[0])].append(piece)
        self.left = own

    def tail(self) -> Iterator[tuple[int, list]]:
        """What is left, in sequences that are powers of two."""
        total = sum(p[0] for p in self.left)
        while total:
            window = 1 << (total.bit_length() - 1)
            yield window, self._fill(window, self.left)
            total -= window


SCHEMA = (
    "doc_id {}, start long, length long, doc_tokens long, sequence_id long, offset long, context long, "
    "step_group long, ids binary"
)


def packed(docs: DataFrame, path: str, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """Pieces of docs (doc_id, text): where each lies in its document and sequence, and its ids.

    ``sequence_id`` and ``step_group`` hold the partition's number above 40 bits.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [part.split()[0] for part in SCHEMA.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = loaded(path), Packer(windows)
        base = TaskContext.get().partitionId() << 40
        held: dict[int, tuple] = {}
        made: dict[int, int] = {}
        count = documents_seen = 0
        id_type = None

        def batch_of(found: Iterator[tuple[int, list]]) -> pa.RecordBatch:
            nonlocal count
            rows: list[tuple] = []
            for window, pieces in found:
                nth = made[window] = made.get(window, -1) + 1
                group = base + (window.bit_length() << 33) + nth // max(1, STEP_TOKENS // window)
                offset = 0
                for length, doc, start in pieces:
                    doc_id, ids = held[doc]
                    rows.append((doc_id, start, length, len(ids), base + count, offset, window, group, ids[start : start + length].tobytes()))
                    offset += length
                count += 1
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            kinds = [id_type, *[pa.int64()] * 7, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        fresh: list[tuple[int, int]] = []
        tokens = 0
        for batch in batches:
            id_type = batch.column("doc_id").type
            ids_of, texts = batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))
            for start, end in slices(texts, SLICE_BYTES):
                for i in range(start, end):
                    ids = words.encode(texts[i])
                    held[documents_seen] = (ids_of[i], ids)
                    fresh.append((documents_seen, len(ids)))
                    documents_seen += 1
                    tokens += len(ids)
                if tokens >= CHUNK_TOKENS:
                    yield batch_of(packer.pack(fresh))
                    fresh, tokens = [], 0
                    held = {d: held[d] for d in {p[1] for p in packer.left}}
        if id_type is not None:
            yield batch_of(packer.pack(fresh))
            yield batch_of(packer.tail())

    return docs.select("doc_id", "text").mapInArrow(work, SCHEMA.format(kind))


def digested(pieces: DataFrame) -> DataFrame:
    crc = F.crc32("ids").cast("long").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset", "context", "step_group")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of all rows, with their ids."""
    return packed(docs, public_tokenizers.path(TOKENIZER)).withColumn("ids_crc32", F.crc32("ids").cast("long"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(packed(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER)))
