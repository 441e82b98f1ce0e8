"""Work on batches of texts inside tasks: slices of bounded size, word hashes, shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are worked on at once; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(
    batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Consecutive rows with their texts as bytes (null: empty), about ``size`` bytes at a time."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
        first, held = 0, 0
        rows: list[bytes] = []
        for i in range(len(texts)):
            text = texts[i].as_py() or b""
            if rows and held + len(text) > size:
                yield batch.slice(first, len(rows)), rows
                first, held, rows = i, 0, []
            rows.append(text)
            held += len(text)
        if rows:
            yield batch.slice(first, len(rows)), rows


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts as one byte array with a line feed after each, and where each starts."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    return data, np.concatenate([[0], np.cumsum(lengths)])


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words (runs without ASCII white space, A-Z lowered).

    ``data`` must end with white space. Words are hashed some at a time, so that memory beyond the
    masks does not grow with a text's length.
    """
    gaps = np.diff(np.concatenate([[True], _SPACE[data]]).view(np.int8))
    starts, ends = np.flatnonzero(gaps == -1), np.flatnonzero(gaps == 1)
    hashes = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right")))
        first, lengths = starts[i:j], ends[i:j] - starts[i:j]
        stops = np.cumsum(lengths)
        within = np.arange(stops[-1]) - np.repeat(stops - lengths, lengths)
        powers = np.cumprod(np.full(int(lengths.max()), _BASE, dtype=np.uint64))
        codes = _LOWER[data[np.repeat(first, lengths) + within]].astype(np.uint64) + np.uint64(1)
        sums = np.add.reduceat(codes * powers[within], stops - lengths)
        hashes[i:j] = mix(sums + lengths.astype(np.uint64))
        i = j
    return starts, ends, hashes


def chain(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive word hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(n, np.uint64(width))
    for k in range(width):
        total = mix(total * _BASE + hashes[k : k + n])
    return total


def shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text: offsets into values, and the values.

    A text with fewer words than ``width`` has its whole sequence as the one shingle.
    """
    data, bounds = joined(texts)
    starts, _, hashes = words(data)
    first = np.searchsorted(starts, bounds)
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(texts)), counts)
    runs = chain(hashes, width)
    whole = doc[: len(runs)] == doc[width - 1 :] if len(runs) else np.zeros(0, dtype=bool)
    docs, values = [doc[: len(runs)][whole]], [runs[whole]]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        docs.append(np.array([i]))
        values.append(chain(hashes[first[i] : first[i + 1]], int(counts[i])))
    docs, values = np.concatenate(docs), np.concatenate(values)
    order = np.lexsort((values, docs))
    docs, values = docs[order], values[order]
    if len(docs):
        fresh = np.concatenate([[True], (docs[1:] != docs[:-1]) | (values[1:] != values[:-1])])
        docs, values = docs[fresh], values[fresh]
    return np.searchsorted(docs, np.arange(len(texts) + 1)), values


def lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    """An Arrow column of lists of longs."""
    return pa.ListArray.from_arrays(
        pa.array(offsets, type=pa.int32()), pa.array(values.view(np.int64), type=pa.int64())
    )
