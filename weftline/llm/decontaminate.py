"""Benchmark passages in documents: SimHash of item-sized windows, then exact similarity."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.text import chain, joined, mix, slices, words

WORDS = 5
PERCENT = 80
# Fingerprints: bits, blocks of the index, and the radius. Two sets (of numbered shingles) at 80 % similarity differ
# in about 15 % of the bits on average; the radius is four standard deviations above that.
BITS, BLOCKS, RADIUS = 256, 16, 62
# Items, and bytes of their texts, that are searched in one pass over the documents; more take further passes.
ITEMS_AT_ONCE, ITEM_BYTES_AT_ONCE = 20_000, 32 * 2**20
# Pairs of a window and an item or a flip that are looked at at once.
PAIRS_AT_ONCE = 1 << 18
# Windows that are fingerprinted at once.
WINDOWS_AT_ONCE = 2048


def _lowered(texts: list[bytes]) -> list[bytes]:
    return [t.decode("utf-8", "replace").lower().encode() for t in texts]


def _signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle."""
    salts = np.arange(1, BITS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    raw = mix(shingles[:, None] + salts).view(np.uint8)
    return np.unpackbits(raw, axis=1).astype(np.int32) * 2 - 1


def _numbered(shingles: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """A hash of each shingle with its number among equal ones; the first keeps its own."""
    return np.where(numbers > 1, mix(shingles + numbers.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), shingles)


def _window_sums(shingles: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """The sums of signs of the windows of ``width`` shingles at ``starts``.

    A window that holds a shingle m times counts it as m different ones, numbered from 1, so the sets
    of numbered shingles are as similar as the weighted sets. A shingle that enters a window gets the next number,
    and one that leaves it takes the highest number with it.
    """
    n = len(shingles)
    _, kind = np.unique(shingles, return_inverse=True)
    spots = kind.astype(np.int64) * (n + 1) + np.arange(n)
    order = np.sort(spots)
    some = np.diff(order) < width
    if not some.any():
        enter = leave = np.cumsum(_signs(shingles), axis=0)
    else:
        at = np.searchsorted(order, spots)
        base = kind.astype(np.int64) * (n + 1)
        first = np.searchsorted(order, base + np.maximum(np.arange(n) - width + 1, 0))
        last = np.searchsorted(order, base + np.minimum(np.arange(n) + width - 1, n - 1), "right")
        enter = np.cumsum(_signs(_numbered(shingles, at - first + 1)), axis=0)
        leave = np.cumsum(_signs(_numbered(shingles, last - at)), axis=0)
    out = enter[starts + width - 1]
    inner = starts > 0
    out[inner] -= leave[starts[inner] - 1]
    return out


def _packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints as 16-bit blocks."""
    return np.packbits(sums > 0, axis=1).view(np.uint16)


class Index:
    """Items by their shingles and, per window size, by the blocks of their fingerprints.

    If two fingerprints differ in at most ``RADIUS`` bits, some block differs in at most
    ``RADIUS // BLOCKS`` bits, so finding all items with such a block misses none. An item costs its
    shingles and about 130 bytes, and a size of more than 697 items (as many as there are near values of a block) 4 MB.
    """

    def __init__(self, items: list[tuple[int, bytes]]):
        near = RADIUS // BLOCKS
        self.flips = np.array([sum(1 << b for b in c) for r in range(near + 1) for c in combinations(range(16), r)], dtype=np.uint16)
        ids, sizes, prints, every, many = [], [], [], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for item, text in items:
            data, _ = joined(_lowered([text]))
            found = chain(words(data)[2], WORDS)
            if len(found) == 0:
                continue
            values, counts = np.unique(found, return_counts=True)
            ids.append(item)
            sizes.append(len(found))
            prints.append(_packed(_window_sums(found, np.zeros(1, np.int64), len(found)))[0])
            every.append(values)
            many.append(counts)
        self.ids = np.array(ids, dtype=np.int64)
        self.prints = np.array(prints, dtype=np.uint16).reshape(-1, BLOCKS)
        # The weighted shingles of item i lie from bounds[i] to bounds[i + 1].
        self.bounds = np.cumsum([len(v) for v in every])
        self.values, self.many = np.concatenate(every), np.concatenate(many).astype(np.int32)
        self.shingles = np.unique(self.values)
        self.sizes = np.array(sizes, dtype=np.int64)
        self.rows = {int(size): np.flatnonzero(self.sizes == size) for size in np.unique(self.sizes)}
        # Per block of a size of many items: the items in the order of their values, and where each value starts.
        self.tables = {}
        for size, rows in self.rows.items():
            if len(rows) > len(self.flips):
                blocks = self.prints[rows]
                order = np.argsort(blocks, axis=0, kind="stable").astype(np.int32)
                first = [np.concatenate([[0], np.cumsum(np.bincount(b, minlength=1 << 16))]).astype(np.int32) for b in blocks.T]
                self.tables[size] = (order, np.array(first))

    def arrays(self) -> dict:
        """All that makes up the index, in plain values that can be broadcast."""
        return dict(self.__dict__)

    @classmethod
    def of(cls, arrays: dict) -> Index:
        made = cls.__new__(cls)
        made.__dict__.update(arrays)
        return made

    def weights(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.bounds[item], self.bounds[item + 1])
        return self.values[part], self.many[part]

    def known(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.shingles):
            return np.zeros(len(shingles), dtype=bool)
        at = np.minimum(np.searchsorted(self.shingles, shingles), len(self.shingles) - 1)
        return self.shingles[at] == shingles

    def candidates(self, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs of this size within the radius, by window.

        The blocks near a window's are found by going through the items' blocks or, if these are more, through
        all near values.
        """
        rows = self.rows[size]
        at_once = max(1, PAIRS_AT_ONCE // min(len(rows), len(self.flips)))
        found = []
        for k in range(0, len(prints), at_once):
            some = prints[k : k + at_once]
            window, at = self._near_values(size, some) if size in self.tables else self._near_items(rows, some)
            found.append((window + k, rows[at]))
        window, item = (np.concatenate(x) for x in zip(*found, strict=True))
        return window, item

    def _near_items(self, rows: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        apart = np.bitwise_count(prints[:, None] ^ self.prints[rows])
        near = (apart <= RADIUS // BLOCKS).any(axis=2)
        window, at = np.nonzero(near)
        inside = apart[window, at].sum(axis=1) <= RADIUS
        return window[inside], at[inside]

    def _near_values(self, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order, first = self.tables[size]
        pairs = []
        for b in range(BLOCKS):
            near = (prints[:, b][:, None] ^ self.flips).ravel().astype(np.int64)
            lo = first[b][near]
            many = first[b][near + 1] - lo
            hit = np.flatnonzero(many)
            lo, many = lo[hit], many[hit]
            within = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            at = order[np.repeat(lo, many) + within, b]
            pairs.append(np.repeat(hit // len(self.flips), many) * len(order) + at)
        both = np.unique(np.concatenate(pairs))
        window, at = both // len(order), both % len(order)
        inside = np.bitwise_count(prints[window] ^ self.prints[self.rows[size][at]]).sum(axis=1) <= RADIUS
        return window[inside], at[inside]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Sums of the smaller and of the larger counts of two weighted sets of shingles."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both, int(a[1].sum() + b[1].sum()) - both


def _windows(known: np.ndarray, size: int) -> np.ndarray:
    """Starts of the windows of ``size`` shingles in which enough shingles belong to some item.

    A window without so many cannot reach the similarity. A shorter text is one window.
    """
    size = min(size, len(known))
    sums = np.concatenate([[0], np.cumsum(known)])
    inside = sums[size:] - sums[:-size]
    return np.flatnonzero(100 * inside >= PERCENT * size)


def _search(shingles: np.ndarray, index: Index) -> list[tuple[int, int, int, int, int]]:
    """(item, start, size, smaller sum, larger sum) of each item's best window in one text."""
    known = index.known(shingles)
    if not known.any():
        return []
    best: dict[int, tuple] = {}
    for size in index.rows:
        starts = _windows(known, size)
        width = min(size, len(shingles))
        for k in range(0, len(starts), WINDOWS_AT_ONCE):
            some = starts[k : k + WINDOWS_AT_ONCE]
            groups = np.split(some, np.flatnonzero(np.diff(some) > width) + 1)
            sums = []
            for g in groups:  # windows that overlap share their running sums
                sums.append(_window_sums(shingles[g[0] : g[-1] + width], g - g[0], width))
            window, item = index.candidates(size, _packed(np.concatenate(sums)))
            for w, i in zip(window.tolist(), item.tolist(), strict=True):
                start = int(some[w])
                both, either = similarity(np.unique(shingles[start : start + width], return_counts=True), index.weights(i))
                if 100 * both >= PERCENT * either:
                    old = best.get(i)
                    if old is None or both * old[3] > old[2] * either:
                        best[i] = (start, width, both, either)
    return [(i, *x) for i, x in sorted(best.items())]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    code: Column | None = None,
) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity) of the best window per document and item.

    Windows have an item's size and slide word by word; a shorter text is one window. Windows whose
    fingerprint lies within ``RADIUS`` of an item's are verified: the similarity of the sets of word
    five-shingles in lower case, weighted by how often each occurs, reaches 0.8. The first of equally good windows
    counts. Documents are read once per ``ITEMS_AT_ONCE`` items or ``ITEM_BYTES_AT_ONCE`` of text, and the index of
    such a part is built once and broadcast, so a large benchmark takes more passes and not more memory.

    Items and documents of fewer than five words, and null texts, match nothing. Repeated rows give
    repeated results; repeated item ids keep the better one. Other columns are ignored.
    """
    items = benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text"))
    items = items.filter("text is not null and item is not null").distinct()
    total, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    passes = max(1, -(-total // ITEMS_AT_ONCE), -(-size // ITEM_BYTES_AT_ONCE))
    given_code = (F.lit("") if code is None else code).alias("code")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), given_code)
    found = None
    for k in range(passes):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == k) if passes > 1 else items
        index = Index(sorted((r["item"], r["text"].encode("utf-8")) for r in part.collect()))
        given = docs.sparkSession.sparkContext.broadcast(index.arrays())
        leaks = rows.mapInArrow(_searcher(given), _FOUND)
        found = leaks if found is None else found.unionByName(leaks)
    order = F.struct(F.col("similarity"), -F.col("start_word"))
    best = found.groupBy("part", "row", "doc_id", "code", "item_id").agg(
        F.max_by(F.struct("start_word", "n_words", "similarity"), order).alias("x")
    )
    more = [] if code is None else ["code"]
    return best.select("doc_id", "item_id", "x.start_word", "x.n_words", "x.similarity", *more)


_FOUND = "doc_id long, item_id long, start_word long, n_words long, similarity double, row int, part int, code string"


def _searcher(given):
    def work(batches):
        from pyspark import TaskContext

        index, row, part = Index.of(given.value), 0, TaskContext.get().partitionId()
        for batch, texts in slices(batches, "text"):
            data, bounds = joined(_lowered(texts))
            starts, _, hashes = words(data)
            first = np.searchsorted(starts, bounds)
            out: list[tuple] = []
            flat = chain(hashes, WORDS)
            hits = np.concatenate([[0], np.cumsum(index.known(flat))])
            codes = batch.column(2)
            for i, doc in enumerate(batch.column(0).to_pylist()):
                a, b = first[i], max(first[i], first[i + 1] - WORDS + 1)
                if b > a and hits[b] > hits[a]:
                    for item, start, width, both, either in _search(flat[a:b], index):
                        out.append((doc, int(index.ids[item]), start, width + WORDS - 1, both / either, row + i, part, codes[i].as_py()))
            row += len(texts)
            kinds = [pa.int64()] * 4 + [pa.float64(), pa.int32(), pa.int32(), pa.string()]
            cols = list(zip(*out, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(cols, kinds, strict=True)],
                names=["doc_id", "item_id", "start_word", "n_words", "similarity", "row", "part", "code"],
            )

    return work
