"""64-bit hashes of all words of many texts at once, for tasks that hold Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence, Sized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S = np.uint64(32)


def mix(h: np.ndarray) -> np.ndarray:
    """Every output bit depends on every input bit."""
    h = (h ^ (h >> _S)) * _B
    h = (h ^ (h >> _S)) * _B
    return h ^ (h >> _S)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of UTF-8 ``data``; words end at ASCII white space."""
    padded = b" " + data + b" " * 9
    gaps = _GAP[np.frombuffer(padded, np.uint8)]
    turns = np.flatnonzero(gaps[1:] != gaps[:-1]) + 1
    starts, ends = turns[0::2], turns[1::2]
    eights = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    left = ends - starts
    h = mix(left.astype(np.uint64) * _A)
    live, at = np.arange(len(starts)), starts
    while len(live):
        here = eights[at] & _KEEP[np.minimum(left, 8)]
        h[live] = mix(h[live] * _A ^ here)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return h, starts - 1


def hashed_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all ``texts`` and, for each text, the number of its first word; one more at the end."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    hashes, at = word_hashes(b"\n".join(texts))
    return hashes, np.concatenate([[0], np.searchsorted(at, ends)])


def texts_of(column: pa.Array) -> list[bytes]:
    """Values as UTF-8 bytes; null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def slices(texts: Sequence[Sized], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes together; a longer text is alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def sliced_texts(column: pa.Array, most: int) -> Iterator[tuple[int, list[bytes]]]:
    """The ranges of ``slices`` over a column: first row, and texts as ``texts_of`` gives them, of one range at a time."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for start, end in slices([range(n) for n in sizes], most):
        yield start, texts_of(column.slice(start, end - start))
