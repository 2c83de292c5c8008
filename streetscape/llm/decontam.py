"""Benchmark decontamination: SimHash of item-sized windows behind a multi-index Hamming search.

Items are put into size classes; every document is read in windows of each class's size, a sixth
of it apart. A window and an item get 64-bit SimHash fingerprints over their two-word shingles. The
fingerprint is cut into ``BLOCKS`` blocks of 16 bits: two fingerprints at most ``RADIUS`` apart agree
in some block up to ``RADIUS // BLOCKS`` bits, so an index of every item's blocks with all their
neighbours at that distance finds every item within the radius.

An item of which a part is rewritten, or into which words are put, differs from the whole window by more
than the radius though most of its shingles stand. So windows of ``PIECE`` words, ``PIECE_STRIDE`` apart,
are looked up as well, among the fingerprints of the items' own windows of that size at every word
(``PIECE_RADIUS``, again by blocks): a run of ``PIECE + PIECE_STRIDE - 1`` words that stands holds one that
is equal, and gives the place of the item around it. An item that keeps 0.75 of its shingles after k edits, each of which
breaks at least four of them, has such a run if it has about 28 words.

Each candidate is verified exactly: the weighted share of the item's five-word shingles that stand in
the window, widened by a quarter of its size on either side, must be 0.75 or more. A shingle weighs
1 + ln(items / items that have it). ``hamming`` is the distance of the place reported, beyond ``RADIUS`` if
pieces led to it.

Documents are only mapped, nothing of them is shuffled or gathered. The benchmark is a stated
query set: it is read in blocks of about ``ITEMS`` items, each of which is checked against all documents.

Defined cases: null and empty texts and items match nothing; an item or document of fewer than five
words has its whole wording as its one shingle; of several places the most similar one, then the
one of the nearest fingerprint, then the first counts;
repeated documents and items each give their own rows; empty tables give an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetscape.llm import tokens as T

SHINGLE, SIMILARITY = 5, 0.75
FEATURE, RADIUS, BLOCKS = 2, 15, 4
STRIDES, CLASS_RATIO = 6, 1.15
PIECE, PIECE_STRIDE, PIECE_RADIUS = 8, 4, 3
ITEMS = 4096
BLOCK_WORDS = 32_768
OUT = "doc_id long, item_id long, similarity double, hamming int, start_word long, n_words long"


def size_class(m: int) -> int:
    """The window size for items of ``m`` words: the greatest step of a geometric scale up to it."""
    size = 1
    while True:
        larger = max(size + 1, int(size * CLASS_RATIO))
        if larger > m:
            return size
        size = larger


def _bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _pack(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


class Prints:
    """SimHash fingerprints of ranges of ``words``, from prefix sums of their two-word shingles' bits."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        two = T.mix(words[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[1:]) if len(words) > 1 else words[:0]
        # 64 counters a row; below 65,536 words they are of 16 bits, and four share a lane in sums and differences
        kind = np.uint16 if len(words) < 1 << 16 else np.uint32
        lanes = _bits(two).astype(kind).view(np.uint64)
        self.kind, self.sums = kind, np.zeros((len(two) + 1, lanes.shape[1]), np.uint64)
        np.cumsum(lanes, axis=0, out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of a single word: its own hash."""
        last = np.maximum(b - 1, a)
        ones = self.sums.take(last, axis=0)
        ones -= self.sums.take(a, axis=0)
        out = _pack(ones.view(self.kind) > ((last - a) // 2).astype(self.kind)[:, None])
        single = b - a < FEATURE
        out[single] = self.words[a[single]]
        return out


def _whole(words: np.ndarray) -> np.ndarray:
    """The one fingerprint of all ``words``."""
    return Prints(words).of(np.array([0]), np.array([len(words)]))


class HammingIndex:
    """All fingerprints within ``radius`` of a query, by blocks and their neighbours."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS) -> None:
        self.prints, self.radius = prints, radius
        width = 64 // BLOCKS
        near = radius // BLOCKS
        flips = np.array([sum(1 << i for i in c) for k in range(near + 1) for c in combinations(range(width), k)], np.int64)
        self.tables = []
        for b in range(BLOCKS):
            own = ((prints >> np.uint64(width * b)) & np.uint64((1 << width) - 1)).astype(np.int64)
            keys = (own[:, None] ^ flips[None, :]).ravel()
            order = np.argsort(keys, kind="stable")
            first = np.zeros((1 << width) + 1, np.int64)
            np.cumsum(np.bincount(keys, minlength=1 << width), out=first[1:])
            self.tables.append((width * b, first.astype(np.int32), (order // len(flips)).astype(np.int32)))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, fingerprint, distance) of every pair within the radius, once each."""
        found = []
        for shift, first, items in self.tables:
            key = ((queries >> np.uint64(shift)) & np.uint64((1 << (64 // BLOCKS)) - 1)).astype(np.int64)
            n = first[key + 1] - first[key]
            q = np.repeat(np.arange(len(queries)), n)
            at = np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[key], n)
            item = items[at]
            near = np.bitwise_count(queries[q] ^ self.prints[item]) <= self.radius
            found.append(q[near] * len(self.prints) + item[near])
        pair = np.unique(np.concatenate(found))
        q, item = np.divmod(pair, max(1, len(self.prints)))
        return q, item, np.bitwise_count(queries[q] ^ self.prints[item])


def shingles(words: np.ndarray) -> Counter:
    """Counts of five-word shingles; of fewer words, the whole."""
    if not len(words):
        return Counter()
    n = min(SHINGLE, len(words))
    h, _ = T.grams(words, np.zeros(len(words), np.int8), n)
    return Counter(h.tolist())


class Benchmark:
    """Items by size class, with their weighted shingles and Hamming indexes."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        ids, by_class = [], {}
        texts = pa.array([t for _, t in items], pa.string())
        buf, off = T.utf8(texts)
        starts, ends = T.spans(buf, off, T.ALNUM_WORDS)
        h, doc = T.hashes(buf, starts, ends, fold=True), T.owners(starts, off)
        first = np.searchsorted(doc, np.arange(len(items) + 1))
        self.words = []
        for i, (item_id, _) in enumerate(items):
            w = h[first[i] : first[i + 1]]
            if len(w):
                by_class.setdefault(size_class(len(w)), []).append(len(ids))
                ids.append(item_id)
                self.words.append(w)
        self.ids = ids
        counts = [shingles(w) for w in self.words]
        having = Counter(g for c in counts for g in c)
        self.weighted = [{g: (k, 1 + np.log(len(ids) / having[g])) for g, k in c.items()} for c in counts]
        self.totals = [sum(k * w for k, w in c.values()) for c in self.weighted]
        self.classes = []
        for size, members in sorted(by_class.items()):
            prints = np.concatenate([_whole(self.words[i]) for i in members])
            self.classes.append((size, np.array(members), HammingIndex(prints)))
        self._cut_pieces()

    def _cut_pieces(self) -> None:
        """The items' own windows of ``PIECE`` words: (item, word) of each fingerprint, and their index."""
        self.n_words = np.array([len(w) for w in self.words], np.int64)
        at = [np.arange(max(0, n - PIECE + 1)) for n in self.n_words.tolist()]
        self.piece_item = np.repeat(np.arange(len(at)), [len(a) for a in at])
        self.piece_at = np.concatenate([np.zeros(0, np.int64), *at])
        own = [Prints(w).of(a, a + PIECE) for w, a in zip(self.words, at) if len(a)]
        self.pieces = HammingIndex(np.concatenate(own), PIECE_RADIUS) if own else None

    def similarity(self, item: int, words: np.ndarray) -> float:
        """Weighted share of the item's shingles that stand in ``words``."""
        n = min(SHINGLE, len(self.words[item]))
        if len(words) < n:
            return 0.0
        want = self.weighted[item]
        h, _ = T.grams(words, np.zeros(len(words), np.int8), n)
        have = Counter(g for g in h.tolist() if g in want)
        return sum(min(k, have[g]) * w for g, (k, w) in want.items() if g in have) / self.totals[item]

    def matches(self, texts) -> Iterator[tuple[int, int, float, int, int, int]]:
        """(row, item, similarity, hamming, start word, words) of the best place of each item in each text."""
        for i, _, buf, off in T.chunks(texts):
            starts, ends = T.spans(buf, off, T.ALNUM_WORDS)
            h = T.hashes(buf, starts, ends, fold=True)
            first = np.searchsorted(starts, off)  # words before each text
            best: dict[tuple[int, int], tuple] = {}
            by_class = [windows(first, size) for size, _, _ in self.classes]
            by_piece = windows(first, PIECE, PIECE_STRIDE)
            led: dict[tuple[int, int, int], int] = {}  # (text, item, place by quarters of the item) -> place
            widest = self.classes[-1][0] if self.classes else 0
            for lo in range(0, len(h) if self.classes else 0, BLOCK_WORDS):
                prints = Prints(h[lo : lo + BLOCK_WORDS + widest])
                for (size, members, index), (a, b, row) in zip(self.classes, by_class):
                    i0, i1 = np.searchsorted(a, [lo, lo + BLOCK_WORDS])
                    q, item, distance = index.search(prints.of(a[i0:i1] - lo, b[i0:i1] - lo))
                    for k in range(len(q)):
                        w, m = int(i0 + q[k]), int(members[item[k]])
                        d, n = int(row[w]), len(self.words[m])
                        margin = n // 4 + (n - size)
                        s, e = max(int(first[d]), int(a[w]) - margin), min(int(first[d + 1]), int(b[w]) + margin)
                        sim = self.similarity(m, h[s:e])
                        if sim >= SIMILARITY:
                            got = (sim, -int(distance[k]), -int(a[w] - first[d]), int(b[w] - a[w]))
                            if got > best.get((d, m), (0.0,)):
                                best[d, m] = got
                if self.pieces:
                    a, b, row = by_piece
                    i0, i1 = np.searchsorted(a, [lo, lo + BLOCK_WORDS])
                    q, piece, _ = self.pieces.search(prints.of(a[i0:i1] - lo, b[i0:i1] - lo))
                    d, m = row[i0 + q], self.piece_item[piece]
                    place = a[i0 + q] - self.piece_at[piece]
                    quarter = (place - first[d]) // np.maximum(1, self.n_words[m] // 4)
                    for key, x in zip(zip(d.tolist(), m.tolist(), quarter.tolist()), place.tolist()):
                        led[key] = min(x, led.get(key, x))
            whole = set(best)
            for (d, m, _), x in sorted(led.items()):
                if (d, m) not in whole:
                    n = len(self.words[m])
                    s, e = max(int(first[d]), x), min(int(first[d + 1]), x + n)
                    margin = n // 4
                    sim = self.similarity(m, h[max(int(first[d]), x - margin) : min(int(first[d + 1]), x + n + margin)])
                    if sim >= SIMILARITY:
                        distance = _whole(self.words[m]) ^ _whole(h[s:e])
                        got = (sim, -int(np.bitwise_count(distance)[0]), -int(s - first[d]), e - s)
                        if got > best.get((d, m), (0.0,)):
                            best[d, m] = got
            for (d, m), (sim, distance, start, n) in sorted(best.items()):
                yield i + d, m, sim, -distance, -start, n


def windows(first: np.ndarray, size: int, stride: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of the windows of ``size`` words, a stride (a sixth of them) apart and at each text's end; a
    shorter text is one window."""
    stride = stride or max(1, size // STRIDES)
    n = np.diff(first)
    room = np.maximum(n - size, 0)
    per = np.where(n > 0, -(-room // stride) + 1, 0)
    row = np.repeat(np.arange(len(n)), per)
    k = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    a = first[:-1][row] + np.minimum(k * stride, room[row])
    return a, np.minimum(a + size, first[1:][row]), row


def _find(bench: Benchmark):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            rows = [(ids[d], bench.ids[m], sim, distance, start, n) for d, m, sim, distance, start, n in bench.matches(b.column("text"))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int64()])], names=[x.split()[0] for x in OUT.split(", ")])

    return run


def _clean(bench: Benchmark):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.ones(b.num_rows, bool)
            keep[[d for d, *_ in bench.matches(b.column("text"))]] = False
            yield b.filter(pa.array(keep))

    return run


def blocks(benchmark: DataFrame, items: int = ITEMS) -> Iterator[Benchmark]:
    """The benchmark in blocks of about ``items`` items (by a hash of the item)."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    n = -(-rows.count() // items)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()  # about ``items`` rows
        yield Benchmark(sorted(((r[0], r[1]) for r in part), key=lambda r: (r[0] is None, r[0] or 0, r[1])))


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it, with the best window's place and similarity."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], OUT)
    for bench in blocks(benchmark):
        out = out.unionByName(docs.mapInArrow(_find(bench), OUT))
    return out


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all their columns kept, in which no benchmark item is found."""
    for bench in blocks(benchmark):
        documents = documents.mapInArrow(_clean(bench), documents.schema)
    return documents
