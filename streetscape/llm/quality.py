"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Unigrams and bigrams of words are hashed into ``BUCKETS`` slots. Two multinomials with add-one
smoothing are estimated over those slots: the raw corpus from every document, the target from
trusted labelled documents. A document's score is its mean log ratio per n-gram (length-normalised)
and every document is decided by one threshold, so a rerun gives the same verdicts.

Spark counts the slots: each task adds up its documents in numpy and emits its slots, the shuffle
carries at most ``BUCKETS`` rows a task and sums them. What reaches the driver is the table of
slots, whose size is fixed by ``BUCKETS``.

Defined cases: a null text counts as an empty one, an empty text has all counts 0, score 0 and fails
the base rules; repeated rows each get their own result; without trusted labels the ratio is 0 and
the base rules alone decide; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetscape.llm import tokens as T

BUCKETS = 1 << 16
#: Words of fewer than 50 words, or with over half of the words in repeated 3-word windows, fail.
MIN_WORDS, MAX_REPEAT_PCT, WINDOW = 50, 50, 3
#: Bound on the labelled rows that train the target and place the threshold.
MAX_LABELLED = 20_000
#: Share of trusted labelled documents that the threshold keeps at least.
MIN_RECALL = 0.995
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))

OUT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double, n_grams long"


def slots(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot, text) of each unigram and bigram."""
    two, at = T.grams(h, doc, 2)
    key = np.concatenate([h, two])
    return (key >> np.uint64(48)).astype(np.int64) % BUCKETS, np.concatenate([doc, doc[at]])


def base_rules(buf: np.ndarray, off: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """The base counts of each text, and its words' hashes and texts."""
    n = len(off) - 1
    starts, ends = T.spans(buf, off)
    doc = T.owners(starts, off)
    lead = np.concatenate([[0], np.cumsum(T.LEAD[buf])])
    sym = np.concatenate([[0], np.cumsum(SYMBOLS[buf])])
    h = T.hashes(buf, starts, ends)

    three, at = T.grams(h, doc, WINDOW)
    twice, _ = T.repeated(three, doc[at])
    covered = np.zeros(len(h) + 1, np.int64)
    for k in range(WINDOW):
        covered[at[twice] + k] = 1

    breaks = np.flatnonzero(buf == 10)
    first = np.unique(np.concatenate([off[:-1], breaks + 1]))
    first = first[first < len(buf)]
    last = np.append(first[1:], len(buf))
    line_doc = T.owners(first, off)
    last = np.minimum(last, off[line_doc + 1])
    last = last - ((last > first) & (buf[last - 1] == 10)) if len(first) else last
    worded = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    first, last, line_doc = first[worded], last[worded], line_doc[worded]
    _, later = T.repeated(T.hashes(buf, first, last), line_doc)

    words = T.counts(doc, n)
    repeat = T.sums(covered[: len(h)], doc, n)
    out = {
        "n_words": words,
        "word_chars": T.sums(lead[ends] - lead[starts], doc, n),
        "n_symbols": sym[off[1:]] - sym[off[:-1]],
        "n_dup_lines": T.sums(later, line_doc, n),
        "n_repeat_words": repeat,
        "base_failed": (words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PCT * words),
    }
    return out, h, doc


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slots of one task: its counts over all texts, and over the trusted ones."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for b in batches:
        trusted = np.asarray(b.column("trusted").to_numpy(zero_copy_only=False), bool)
        for i, j, buf, off in T.chunks(b.column("text")):
            starts, ends = T.spans(buf, off)
            doc = T.owners(starts, off)
            slot, owner = slots(T.hashes(buf, starts, ends), doc)
            raw += np.bincount(slot, minlength=BUCKETS)
            target += np.bincount(slot[trusted[i:j][owner]], minlength=BUCKETS)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["slot", "raw", "target"])


def labelled(labels: DataFrame, bound: int = MAX_LABELLED) -> DataFrame:
    """At most ``bound`` labelled ids in the order of a hash of the id, each with a role: trusted
    ids (quality 1, not toxic) train the target or, by a second hash, are held out; ids of quality
    0 are ``bad``. Held-out and bad ids place the threshold. Toxic ids of quality 1 have no role.
    An id with several labels counts by its lowest quality and highest toxicity."""
    one = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    role = F.when(F.col("q") != 1, "bad").when(F.col("t") == 0, F.when(F.xxhash64("doc_id", F.lit("fold")) % 2 == 0, "train").otherwise("held"))
    return one.select(F.col("doc_id").cast("long").alias("doc_id"), role.alias("role")).where("role IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def ratios(documents: DataFrame, marks: dict[int, str]) -> np.ndarray:
    """Log ratio of target to raw probability for each slot."""
    spark = documents.sparkSession
    trusted = spark.createDataFrame([(int(k),) for k, v in marks.items() if v == "train"], "doc_id long")
    docs = documents.select("doc_id", "text")
    joined = docs.join(F.broadcast(trusted.select("doc_id", F.lit(True).alias("hit"))), "doc_id", "left")
    rows = joined.select("text", F.coalesce("hit", F.lit(False)).alias("trusted")).mapInArrow(_count, "slot long, raw long, target long").groupBy("slot").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = rows.column("slot").to_numpy()
    raw[at], target[at] = rows.column("raw").to_numpy(), rows.column("target").to_numpy()
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def _score(ratio: np.ndarray, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, off in T.chunks(b.column("text")):
                base, h, doc = base_rules(buf, off)
                slot, owner = slots(h, doc)
                n = T.counts(owner, j - i)
                total = np.bincount(owner, weights=ratio[slot], minlength=j - i)
                score = total / np.maximum(n, 1)
                base |= {"kept": ~base["base_failed"] & (score >= threshold), "score": score, "n_grams": n}
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), *(pa.array(v) for v in base.values())], names=["doc_id", *base])

    return run


def threshold_of(good: np.ndarray, bad: np.ndarray, min_recall: float = MIN_RECALL) -> float:
    """The cut with the best balanced accuracy among those that keep ``min_recall`` of the held-out
    trusted scores; of equal ones the middle of the widest gap. Without trusted scores everything
    is kept."""
    if not len(good):
        return float("-inf")
    good, bad = np.sort(good), np.sort(bad)
    every = np.unique(np.concatenate([good, bad]))
    below = np.concatenate([[every[0] - 2 * (1 + abs(every[0]))], every[:-1]])
    cuts, gap = (below + every) / 2, every - below
    recall = 1 - np.searchsorted(good, cuts) / len(good)
    balanced = recall + (np.searchsorted(bad, cuts) / len(bad) if len(bad) else 0)
    balanced[recall < min_recall] = -1
    best = np.flatnonzero(balanced == balanced.max())
    return float(cuts[best[int(np.argmax(gap[best]))]])


def quality(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, min_recall: float = MIN_RECALL) -> DataFrame:
    """One row per document: base counts, ``score`` (mean log ratio per n-gram) and ``kept``."""
    spark = documents.sparkSession
    marks = {r[0]: r[1] for r in labelled(labels, max_labelled).collect()}  # at most max_labelled rows
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ratio = ratios(docs, marks)
    judged = spark.createDataFrame([(k, v) for k, v in marks.items() if v != "train"], "doc_id long, role string")
    known = docs.join(F.broadcast(judged.select("doc_id")), "doc_id", "left_semi").mapInArrow(_score(ratio, 0.0), OUT).where("NOT base_failed")
    rows = known.groupBy("doc_id").agg(F.min("score").alias("score")).toArrow()
    score = rows.column("score").to_numpy()
    held = np.array([marks[x] == "held" for x in rows.column("doc_id").to_pylist()], bool)
    return docs.mapInArrow(_score(ratio, threshold_of(score[held], score[~held], min_recall)), OUT)
