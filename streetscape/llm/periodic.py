"""Periodic runs of words, by the branching-tandem test on an enhanced suffix array.

A run of period q is a stretch of words in which words q apart are identical and which no neighbour extends. Every run
of at least two periods ends in one branching square: a place i with LCE(i, i + q) = q exactly, so that i and i + q lie in
the LCP interval of depth q, in different children of it. A task finds them for many texts at once, in NumPy:

1. the suffix array of the block's words (a word counts as itself only within its text), by prefix doubling; each
   round sorts only what is still tied, and its ranks are kept;
2. the LCP array from those ranks, and a range-minimum table over it;
3. the LCP intervals as index ranges with their children - no tree nodes;
4. of each interval of depth d, the suffixes i of all children but the largest are tested: a square stands at i if ISA[i + d]
   lies in the interval outside i's child, at i - d if ISA[i - d] does. Each suffix is met O(log n) times;
5. squares are rotated to the left as far as their words agree (a binary search by range minima, as a run of thousands of
   words would otherwise be walked word by word), which gives each run's first word; runs with the same bounds are
   merged into the one of the smallest period.

Nothing is shuffled: a text is worked on whole in the task that reads it, in blocks of about ``tokens.CHUNK`` bytes or one
text. A word takes about 4 bytes for each doubling round (log2 of the longest repeat) and 8 bytes for each level of the table (log2 of the
most frequent word's count) besides a few arrays. Words are compared by 64-bit hashes.

Defined cases: a null or empty text has no runs and collapses to the empty text; repeated rows and rows without doc_id each
give a row; of several periods of the same stretch the smallest counts; stretches may overlap, each is a run; an
empty table gives no rows. Other columns of documents are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetscape.llm import tokens as T

#: A run has at least this many words and this many periods.
MIN_WORDS, MIN_PERIODS = 24, 3
OUT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
WORD = r"[^\x20\x09-\x0D]+"


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes in order, and for k = 0, 1, ... ranks that are equal for equal runs of 2^k symbols."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    place = np.arange(n)
    sorted_ = symbols[order]
    head = np.ones(n, bool)
    head[1:] = sorted_[1:] != sorted_[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, place, 0))
    levels = [rank.astype(np.int32)]
    step = 1
    while True:
        tail = np.append(head[1:], True)
        tied = np.flatnonzero(~(head & tail))  # places in groups of two or more
        if not len(tied):
            return order, levels
        at = order[tied]
        after = at + step
        key = rank[at] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        sub = np.argsort(key, kind="stable")
        key, at = key[sub], at[sub]
        order[tied] = at
        new = np.ones(len(tied), bool)
        new[1:] = key[1:] != key[:-1]
        head[tied] = new
        rank[at] = np.maximum.accumulate(np.where(new, tied, 0))
        levels.append(rank.astype(np.int32))
        step *= 2


def lcp_array(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """At j the length that suffixes order[j - 1] and order[j] share; 0 at 0."""
    n = len(order)
    out = np.zeros(n, np.int32)
    j = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b = order[j - 1], order[j]
    shared = np.zeros(len(j), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        ok = np.maximum(x, y) < n
        same = np.zeros(len(j), bool)
        same[ok] = levels[k][x[ok]] == levels[k][y[ok]]
        shared += same.astype(np.int64) << k
    out[j] = shared
    return out


class RangeMinimum:
    """Minima of ranges of the LCP array, as far as its stretches of values above 0 reach."""

    def __init__(self, lcp: np.ndarray) -> None:
        zero = np.flatnonzero(lcp == 0)
        longest = int(np.diff(np.append(zero, len(lcp))).max(initial=1))
        self.n, self.levels = len(lcp), [lcp]
        while 1 << len(self.levels) <= longest:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]) if len(last) > half else last[:0])

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum over [first, last]; ranges beyond any stretch hold a 0."""
        out = np.zeros(len(first), np.int64)
        k = np.frexp((last - first + 1).astype(float))[1] - 1  # floor of log2
        for level in range(len(self.levels)):
            at = np.flatnonzero(k == level)
            if len(at):
                row = self.levels[level]
                out[at] = np.minimum(row[first[at]], row[last[at] - (1 << level) + 1])
        return out

    def interval(self, j: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of the LCP interval around j, whose depth is the LCP at j."""
        left, right = j.copy(), j.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            row = self.levels[k]
            if not len(row):
                continue
            to = left - (1 << k)
            at = np.flatnonzero(to >= 0)
            at = at[row[to[at]] >= depth[at]]
            left[at] = to[at]
            to = right + 1
            at = np.flatnonzero(to < len(row))
            at = at[row[to[at]] >= depth[at]]
            right[at] += 1 << k
        return left - 1, right


def branching_squares(order: np.ndarray, isa: np.ndarray, lcp: np.ndarray, rmq: RangeMinimum) -> tuple[np.ndarray, np.ndarray]:
    """(first word, half length) of every branching square, some of them twice."""
    j = np.flatnonzero(lcp)
    none = np.zeros(0, np.int64)
    if not len(j):
        return none, none
    depth = lcp[j].astype(np.int64)
    left, right = rmq.interval(j, depth)
    by = np.lexsort((j, right, left))
    j, depth, left, right = j[by], depth[by], left[by], right[by]
    opens = np.ones(len(j), bool)
    opens[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    interval = np.cumsum(opens) - 1
    first = np.flatnonzero(opens)

    # children: one from the interval's left bound, one from each j
    ends = right.copy()
    ends[:-1][~opens[1:]] = j[1:][~opens[1:]] - 1
    start = np.concatenate([left[first], j])
    end = np.concatenate([j[first] - 1, ends])
    of = np.concatenate([np.arange(len(first)), interval])
    size = end - start + 1
    by = np.lexsort((-size, of))
    largest = np.ones(len(by), bool)
    largest[1:] = of[by][1:] != of[by][:-1]
    small = by[~largest]

    size, of = size[small], first[of[small]]
    each = np.repeat(np.arange(len(small)), size)
    place = np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size) + start[small][each]
    lo, hi, d = left[of][each], right[of][each], depth[of][each]
    c_lo, c_hi = start[small][each], end[small][each]
    i = order[place]

    squares = []
    for other, at in ((i + d, i), (i - d, i - d)):
        k = np.flatnonzero((other >= 0) & (other < len(order)))
        r = isa[other[k]]
        hit = k[(r >= lo[k]) & (r <= hi[k]) & ((r < c_lo[k]) | (r > c_hi[k]))]
        squares.append((at[hit], d[hit]))
    return np.concatenate([s[0] for s in squares]), np.concatenate([s[1] for s in squares])


def find_runs(symbols: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run of the sequence, by start, then period."""
    none = np.zeros(0, np.int64)
    if len(symbols) < 2:
        return none, none, none
    order, levels = suffix_array(symbols)
    isa = np.empty(len(order), np.int64)
    isa[order] = np.arange(len(order))
    lcp = lcp_array(order, levels)
    del levels
    rmq = RangeMinimum(lcp)
    i, d = branching_squares(order, isa, lcp, rmq)

    # a run of the asked length starts at least ``need`` words before its last square
    need = np.maximum(min_words, min_periods * d) - 2 * d
    need = np.maximum(need, 0)
    ok = i >= need
    i, d, need = i[ok], d[ok], need[ok]
    ok = symbols[i - need] == symbols[i - need + d]
    i, d, need = i[ok], d[ok], need[ok]

    def agrees(back: np.ndarray, i: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Whether the square can be rotated ``back`` words to the left."""
        a, b = isa[i - back], isa[i - back + d]
        return rmq.of(np.minimum(a, b) + 1, np.maximum(a, b)) >= d + back

    ok = agrees(need, i, d)
    i, d, need = i[ok], d[ok], need[ok]
    low, high = need, i.copy()  # the greatest rotation lies between
    while len(low) and (low < high).any():
        mid = (low + high + 1) // 2
        yes = agrees(mid, i, d)
        low, high = np.where(yes, mid, low), np.where(yes, high, mid - 1)
    start, end = i - low, i + 2 * d
    by = np.lexsort((d, end, start))
    start, end, d = start[by], end[by], d[by]
    keep = np.ones(len(by), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, d = start[keep], end[keep], d[keep]
    by = np.lexsort((d, start))
    return start[by], (end - start)[by], d[by]


def _collapse(text: bytes, keep: np.ndarray | None) -> bytes:
    words = text.split()  # of bytes: at exactly the delimiters of WORD
    return b" ".join(words if keep is None else [w for w, k in zip(words, keep) if k])


def _run(min_words: int, min_periods: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, off in T.chunks(batch.column("text")):
                starts, ends = T.spans(buf, off)
                doc = T.owners(starts, off)
                word = T.hashes(buf, starts, ends) + T.mix(doc.astype(np.uint64))
                first, length, period = find_runs(np.unique(word, return_inverse=True)[1], min_words, min_periods)
                n = T.counts(doc, j - i)
                base = np.concatenate([[0], np.cumsum(n)])
                owner = doc[first] if len(first) else np.zeros(0, np.int64)
                # words of a run after its first period go
                change = np.zeros(len(word) + 1, np.int64)
                np.add.at(change, first + period, 1)
                np.add.at(change, first + length, -1)
                keep = np.cumsum(change)[:-1] == 0
                hit = set(owner.tolist())
                raw = buf.tobytes()
                collapsed = [_collapse(raw[off[k] : off[k + 1]], keep[base[k] : base[k + 1]] if k in hit else None) for k in range(j - i)]
                each = pa.StructArray.from_arrays([pa.array(first - base[owner]), pa.array(length), pa.array(period)], names=["start", "length", "period"])
                offsets = pa.array(np.concatenate([[0], np.cumsum(T.counts(owner, j - i))]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(n), pa.ListArray.from_arrays(offsets, each), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(documents: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """Each document's runs, by start, then period, and its text without the repeats: the words that lie after the first
    period of no run, joined by one space."""
    if min_periods < 2:
        raise ValueError("a run has two periods at least")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_run(min_words, min_periods), OUT)


def planted(documents: DataFrame) -> DataFrame:
    """(doc_id, text) in which, for ids whose checksum h ends in 0, every word from a on is replaced so that the words from a
    repeat with period p: a = g % n, p = 1 + floor((n - a) / (3 + g % 8)), g = floor(h / 10). Rows without doc_id stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.col("text").cast("string")
    words = F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.floor(h / 10).cast("long").alias("g"), words.alias("words"))
    n = F.size("words").cast("long")
    rows = rows.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("slice(concat(slice(words, 1, int(a)), flatten(array_repeat(slice(words, int(a) + 1, int(p)), int((n - a) div p + 1)))), 1, int(n))")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def _best(runs: Column) -> Column:
    """The run of greatest length by period; runs come by start and period, so the first of equals stays."""
    ahead = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    return F.when(F.size(runs) > 0, F.reduce(runs, runs[0], lambda best, r: F.when(ahead(best, r), r).otherwise(best)))


def digests(found: DataFrame) -> DataFrame:
    """One row per document of ``periodic_runs``: number of runs, the strongest one, and checksums of runs and text."""
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    rows = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        _best(F.col("runs")).alias("best"),
        F.sha2(F.encode(F.array_join(line, ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
