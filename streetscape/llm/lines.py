"""Line dedup: a segment-partition edit join over all lines, in DataFrame functions only.

A line of ``MIN_CHARS`` code points or more goes if a line before it, in the order of (doc_id, hash of
the text, line number), is within ``EDITS`` edits of it. Exact repeats are grouped first, so that each
distinct line takes part once, by its first place. Of two lines within ``EDITS`` edits, the shorter is cut into
``EDITS + 1`` segments and one of them stands unchanged in the longer, shifted by a few characters at
most: segments are indexed by line length, position and content, and the longer line probes them
with the substrings that its length and the multi-match rule leave possible. A bound on letter
counts (an edit changes two at most) and then a banded bit-parallel edit distance verify each
candidate inside the join, so that a hot segment yields no rows but links.

Distinct lines are known by a 64-bit hash of their text. Only the lines that share a segment with
another carry their text to the verification.

Defined cases: null and empty texts have no lines to remove; shorter lines always stay; repeated
documents (same id and text) count as one and each row gets its result; documents of one id and
different texts are told apart by the text's hash; a null id sorts first; an empty table gives
an empty result.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetscape.session import checkpoint_root

EDITS, MIN_CHARS = 2, 20
#: Characters whose counts bound the distance from below.
COUNTED = "etaoinsrhlducmgbpfv .,&%"
#: Top bit of the words of the bit-parallel distance; sums of two stay within a long.
TOP = 40


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/lines/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _sizes(line: Column, edits: int) -> list[Column]:
    """The line's length ``n`` and, for each length up to ``edits`` shorter, the base size ``q`` of its segments
    and the number ``r`` of those that are one longer; as columns, so that they are computed once."""
    parts = edits + 1
    n = F.length(line)
    return [n.alias("n"), *[((n - d - (n - d) % parts) / parts).cast("int").alias(f"q{d}") for d in range(parts)], *[((n - d) % parts).alias(f"r{d}") for d in range(parts)]]


def _segment(shorter: int, i: int, parts: int) -> tuple[Column, Column]:
    """0-based start and length of segment ``i`` of a line ``shorter`` than this; the last ones are the longer."""
    q, r = F.col(f"q{shorter}"), F.col(f"r{shorter}")
    return q * i + F.greatest(F.lit(0), r + (i - parts)), q + (r + i >= parts).cast("int")


def _key(i: int, length: Column, line: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(F.lit(i), length, F.substring(line, start + 1, size))


def index_keys(line: Column, edits: int) -> list[Column]:
    return [_key(i, F.col("n"), line, *_segment(0, i, edits + 1)) for i in range(edits + 1)]


def probe_keys(line: Column, edits: int, min_chars: int) -> list[Column]:
    """Keys of the substrings that a segment of a line up to ``edits`` shorter may match; those at
    their own place are the index keys already. Null where there is no such substring."""
    n, parts, out = F.col("n"), edits + 1, []
    for shorter in range(parts):
        length = n - shorter
        for i in range(parts):
            start, size = _segment(shorter, i, parts)
            for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + (edits - i)) + 1):
                if shorter or shift:
                    at = start + shift
                    out.append(F.when((length >= min_chars) & (at >= 0) & (at + size <= n), _key(i, length, line, at, size)))
    return out


def _chars(line: Column) -> Column:
    return F.transform(F.split(line, ""), lambda c: F.ascii(c))


def near_lines(a: Column, b: Column, edits: int) -> Column:
    """Whether two texts are within ``edits`` edits."""
    return _let(_chars(a), lambda x: _let(_chars(b), lambda y: within(x, y, edits)))


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two arrays of code points are within ``edits`` edits: Hyyrö's bit-parallel column
    update, restricted to the band of diagonals -edits..edits. The top bit of a word stands for row
    ``edits`` below the main diagonal; the distance is followed along that diagonal down to the last
    row and along it from there. ``edits`` is at least 1."""
    m, n = F.size(a), F.size(b)
    word = lambda v: F.lit(v).cast("long")
    every = (2 << TOP) - 1
    inverse = lambda v: F.bitwise_not(v).bitwiseAND(word(every))
    start = F.struct(word(every - (1 << (TOP - edits)) + 1).alias("vp"), word(0).alias("vn"), F.lit(edits).alias("d"))

    def column(s: Column, j: Column) -> Column:
        x = reduce(lambda p, q: p.bitwiseOR(q), [F.when(F.get(a, j + k) == F.get(b, j), word(1 << (TOP - edits + k))).otherwise(word(0)) for k in range(-edits, edits + 1)])
        return _let(x, lambda x: _let((x.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"]).bitwiseOR(x).bitwiseOR(s["vn"]).bitwiseAND(word(every)), lambda d0: horizontal(s, j, d0)))

    def horizontal(s: Column, j: Column, d0: Column) -> Column:
        hp = s["vn"].bitwiseOR(inverse(d0.bitwiseOR(s["vp"])))
        return _let(F.struct(hp.alias("hp"), d0.bitwiseAND(s["vp"]).alias("hn")), lambda h: vertical(s, j, d0, h))

    def vertical(s: Column, j: Column, d0: Column, h: Column) -> Column:
        beyond = j + edits - (m - 1)  # columns since the diagonal met the last row, whose bit moves down by one a column
        bit = lambda v: F.call_function("shiftrightunsigned", v, TOP - beyond).bitwiseAND(word(1)).cast("int")
        step = F.when(beyond <= 0, F.when(d0 >= 1 << TOP, 0).otherwise(1)).otherwise(bit(h["hp"]) - bit(h["hn"]))
        moved = F.shiftrightunsigned(d0, 1)
        return F.struct(h["hn"].bitwiseOR(inverse(moved.bitwiseOR(h["hp"]))).alias("vp"), moved.bitwiseAND(h["hp"]).alias("vn"), (s["d"] + step).alias("d"))

    folded = F.aggregate(F.sequence(F.lit(0), n - 1), start, column)
    return (F.abs(m - n) <= edits) & (m > edits) & (n > 0) & (folded["d"] <= edits)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _lines(documents: DataFrame, min_chars: int) -> DataFrame:
    rows = documents.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return rows.where(F.length("line") >= min_chars).select(F.xxhash64("line").alias("id"), F.struct("doc_id", "th", "line_no", "line").alias("place"))


def links(documents: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, earlier_id): distinct lines within ``edits`` edits, the later first."""
    first = _lines(documents, min_chars).groupBy("id").agg(F.min("place").alias("place"))
    sized = first.select("id", F.col("place.line").alias("line")).select("id", "line", *_sizes(F.col("line"), edits))
    keys = [*index_keys(F.col("line"), edits), *probe_keys(F.col("line"), edits, min_chars)]
    # the two sides of the join are one plan, so Spark shuffles these rows once; likewise the lines
    rows = sized.select("id", F.posexplode(F.array(*keys)).alias("k", "key")).select("id", "key", (F.col("k") <= edits).alias("own")).where("id IS NOT NULL AND key IS NOT NULL")
    a, b = rows.alias("a"), rows.alias("b")
    live = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.id") != F.col("b.id")) & (F.col("a.own") | F.col("b.own")), "left_semi")
    texts = live.join(first, "id")
    bare = _written(texts.select("id", "key", "own", "place"), "candidates")
    known = bare.select("id", "key", "own", F.struct("place.doc_id", "place.th", "place.line_no").alias("at"), F.col("place.line").alias("line"), *[(F.length("place.line") - F.length(F.replace("place.line", F.lit(c)))).alias(f"n{i}") for i, c in enumerate(COUNTED)])
    a, b = known.alias("a"), known.alias("b")
    counts = reduce(lambda x, y: x + y, [F.abs(F.col(f"a.n{i}") - F.col(f"b.n{i}")) for i in range(len(COUNTED))])
    near = (counts <= 2 * edits) & near_lines(F.col("a.line"), F.col("b.line"), edits)
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.id") != F.col("b.id")) & (F.col("b.at") < F.col("a.at")) & (F.col("a.own") | F.col("b.own")) & near)
    return pairs.select(F.col("a.id").alias("id"), F.col("b.id").alias("earlier_id")).distinct()


def kept_lines(documents: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, th, kept): of each document, the numbers of its long lines that stay."""
    firsts = _lines(documents, min_chars).select("id", F.struct("place.doc_id", "place.th", "place.line_no").alias("at")).groupBy("id").agg(F.min("at").alias("at"))
    gone = _written(links(documents, edits, min_chars).select("id").distinct(), "gone")
    return firsts.join(gone, "id", "left_anti").groupBy("at.doc_id", "at.th").agg(F.collect_list("at.line_no").alias("kept"))


def _removed(documents: DataFrame, kept: DataFrame, keep: list[str], min_chars: int) -> DataFrame:
    """The columns ``keep`` as the struct ``row``, the number of lines ``n`` and the sorted numbers of the ``removed``."""
    text = documents["text"]
    long_lines = F.filter(F.transform(F.split(text, "\n", -1), lambda x, i: F.when(F.length(x) >= min_chars, i).otherwise(-1)), lambda i: i >= 0)
    none = F.array().cast("array<int>")
    rows = documents.select(F.struct(*[documents[c] for c in keep]).alias("row"), documents["doc_id"].alias("row_id"), F.xxhash64(text).alias("row_th"), F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n", -1))).cast("long").alias("n"), F.coalesce(long_lines, none).alias("long_lines"))
    joined = rows.join(kept, F.col("row_id").eqNullSafe(F.col("doc_id")) & F.col("row_th").eqNullSafe(F.col("th")), "left")
    return joined.select("row", "n", F.sort_array(F.array_except("long_lines", F.coalesce("kept", none))).alias("removed"))


def line_report(documents: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, removed (line numbers from 0)."""
    docs = documents.select("doc_id", "text")
    out = _removed(docs, kept_lines(docs, edits, min_chars), ["doc_id"], min_chars)
    return out.select("row.doc_id", F.col("n").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"), "removed")


def dedup_lines(documents: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents, all their columns kept, their texts without the removed lines."""
    out = _removed(documents, kept_lines(documents.select("doc_id", "text"), edits, min_chars), documents.columns, min_chars)
    lines = F.split("row.text", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed"))
    text = F.when(F.size("removed") > 0, F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")).otherwise(F.col("row.text"))
    return out.select(F.col("row").withField("text", text).alias("row")).select("row.*")
