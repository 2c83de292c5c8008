"""Source divergence audit: how far the vocabularies of a language's sources lie apart, in exact integers.

Each language keeps the terms that occur in at least ``min_df`` of its documents. A source's share of a term is
p = 1 + floor(10^9 (count + 2) / (N + 2 V)), two shares differ by f = floor((p - q)^2 / (p + q)); a pair of sources
differs by the sum of f over the V terms, and a source's ten most distinctive terms are those with p above the
language's own share, by f.

1. One ``CountVectorizer`` with minDF and the greatest integer as vocabSize is fitted over terms that carry their
   language's code in front: as a document has one language, its minDF is each language's own, and there is one pass
   however many languages there are. The terms are cut from Arrow buffers in NumPy; the code takes the place of the byte
   before a term, which no term holds. The tasks sum the terms'
   document frequencies, which come together by the terms' hashes; the fit then reads each term of ``min_df`` documents or more in
   ``min_df`` rows, which minDF lets through, instead of in every document's.
2. It turns the terms of every (language, source) into exact sparse vectors. As the audit needs a group's sums only, the
   texts of a group in a block of ``BLOCK_BYTES`` are one document for each binary digit of their terms' counts, weighted by it: a term is
   looked up as often as its count has ones. The weights are summed by group and index in Spark: a sparse form of
   ``Summarizer.sum``, whose dense sums would take V numbers for every group and task. Terms are told apart by 64-bit hashes until they are fitted or looked up.
3. A pair is evaluated over occurring terms only. With p0, q0 the shares of a term that doesn't occur,

       sum f(p, q) = V f(p0, q0) + sum over the terms of one (f(p, q0) - f(p0, q0)) + the same for the other
                     + sum over shared terms (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)).

   The middle sums depend on the distinct shares of a group only, the last one is an equi-join by term, of at most one
   row a source; both are partial aggregates by pair.

The fitted vocabulary passes through the driver and is broadcast, so the number of its terms is looked at first. With more than
``MAX_TERMS`` of them, or more than ``MAX_CODES`` languages, the same counts come from one aggregate by term and a join, with nothing in
the driver (``counts_by_join``). Everything after the counts is the same.

Counts are 64-bit integers; shares and f are computed in integers, beyond 64 bits in decimals.

Defined cases: null text, lang and source are empty strings; a group without terms has count 0 everywhere; a language
without kept terms gives pairs of value 0; a language with one source has no pairs; equal values rank by the item's
UTF-8 bytes; repeated rows count as documents of their own; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetscape.llm import tokens as T
from streetscape.operators.sizing import broadcast_if_small
from streetscape.operators.topk import first_k
from streetscape.session import checkpoint_root

MIN_DF = 10
TOP_TERMS = 10
#: Up to about this many kept terms a vocabulary is fitted through the driver.
MAX_TERMS = 1_000_000
#: Languages that one byte below the letters can tell apart.
MAX_CODES = 64
#: Bytes of texts for each part of the terms.
PART_BYTES = 32 << 20
#: Terms that a task holds before it hands them over, and terms of a row of the fit.
HELD, ROW_TERMS = 1_000_000, 50_000
#: Bytes of texts whose terms a task counts by group before it looks them up.
BLOCK_BYTES = 8 << 20
SCALE = 1_000_000_000
_BYTES = np.arange(256)
#: Bytes of terms ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``: letters and everything beyond ASCII.
TERM_BYTES = ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)


def _folder(df: DataFrame, name: str) -> str:
    return f"{checkpoint_root(df.sparkSession).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = _folder(df, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _named(documents: DataFrame) -> DataFrame:
    empty = F.lit("")
    return documents.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")])


def _strings(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans, which follow one another in ``buf``, as a string array."""
    size = ends - starts
    change = np.zeros(len(buf) + 1, np.int8)
    change[starts] += 1
    change[ends] -= 1
    data = buf[np.cumsum(change[:-1], dtype=np.int8).astype(bool)]
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def _coded(text: np.ndarray, off: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, documents, hashes) of the terms, in bytes where each has its language's code before it."""
    # a byte more at each text's head, so that every term has one before it
    at = off + np.arange(len(off))
    buf = np.zeros(len(text) + len(codes), np.uint8)
    body = np.ones(len(buf), bool)
    body[at[:-1]] = False
    buf[body] = T.lower(text)
    starts, ends = T.spans(buf, at, TERM_BYTES)
    doc = T.owners(starts, at)
    h = T.hashes(buf, starts, ends)
    buf[starts - 1] = codes[doc]
    return buf, starts, ends, doc, h


def _keys(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of terms of languages."""
    return T.mix(h + codes.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


def _added(keys: np.ndarray, counts: np.ndarray, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(distinct keys ascending, their counts added up, a term of each)."""
    if not len(keys):
        return keys, counts, terms
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts[order], first), terms.take(pa.array(order[first]))


def _joined(held: list[tuple[np.ndarray, np.ndarray, pa.Array]]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    keys, counts, terms = zip(*held)
    return _added(np.concatenate(keys), np.concatenate(counts), pa.concat_arrays(terms))


def _group_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of each group in a block of texts as rows of weight 1, 2, 4 and so on: a term stands once in those rows
    whose weights add up to its occurrences in the block."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0
    for b in batches:
        gid, codes = b.column("gid").to_numpy(), b.column("code").to_numpy()
        for i, j, text, off in T.chunks(b.column("text"), BLOCK_BYTES):
            if held and size + len(text) > BLOCK_BYTES:
                yield from _weighted(held)
                held, size = [], 0
            held.append((gid[i:j], codes[i:j], text, np.diff(off)))
            size += len(text)
    if held:
        yield from _weighted(held)


def _counted(h: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of one, number) of the equal terms of a group, by group."""
    key = T.mix(h + of.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    order = np.argsort(key)
    first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    pick, count = order[first], np.diff(np.append(first, len(key)))
    by = np.argsort(of[pick], kind="stable")
    return pick[by], count[by]


def _listed(of: np.ndarray, terms: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(groups, the terms of each) of terms that come by group."""
    head = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    return of[head], pa.ListArray.from_arrays(pa.array(np.append(head, len(of)).astype(np.int32)), terms)


def _taken(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, pick: np.ndarray) -> pa.Array:
    """The terms at ``pick`` with their codes, in its order."""
    place = np.argsort(pick)
    back = np.empty(len(pick), np.int64)
    back[place] = np.arange(len(pick))
    return _strings(buf, starts[pick[place]] - 1, ends[pick[place]]).take(pa.array(back))


def _weighted(held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    gid, codes, text, lengths = (np.concatenate(x) for x in zip(*held))
    buf, starts, ends, doc, h = _coded(text, np.concatenate([[0], np.cumsum(lengths)]), codes)
    if not len(h):
        return
    pick, count = _counted(h, gid[doc])
    of, terms = gid[doc[pick]], _taken(buf, starts, ends, pick)
    for k in range(int(count.max()).bit_length()):
        mine = np.flatnonzero(count >> k & 1)
        if len(mine):
            groups, lists = _listed(of[mine], terms.take(pa.array(mine)))
            yield pa.RecordBatch.from_arrays([pa.array(groups), pa.array(np.full(len(groups), 1 << k)), lists], names=["gid", "weight", "terms"])


def _frequencies(parts: int):
    """The task's terms with the documents that hold each, packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        size = 0
        for b in batches:
            codes = b.column("code").to_numpy()
            for i, j, text, off in T.chunks(b.column("text")):
                buf, starts, ends, doc, h = _coded(text, off, codes[i:j])
                if not len(h):
                    continue
                key = _keys(h, codes[i:j][doc])
                order = np.argsort(key)
                new = np.append(True, key[order][1:] != key[order][:-1])
                which = np.empty(len(key), np.int64)
                which[order] = np.cumsum(new) - 1
                pick = order[new]  # in the order of the keys
                once = np.unique(doc * len(pick) + which) % len(pick)
                held.append((key[pick], T.counts(once, len(pick)), _taken(buf, starts, ends, pick)))
                size += len(pick)
                if size > HELD:
                    held = [_joined(held)]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield from rows(held)
                        held, size = [], 0
        yield from rows(held)

    def rows(held: list[tuple[np.ndarray, np.ndarray, pa.Array]]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        key, n, terms = _joined(held)
        ends = np.frombuffer(terms.buffers()[1], np.int32, len(terms) + 1)
        raw = np.frombuffer(terms.buffers()[2], np.uint8)
        cut = np.searchsorted(((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32), np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(cut)).tolist():
            a, c = int(cut[p]), int(cut[p + 1])
            packed = [key[a:c].tobytes(), n[a:c].astype("<u4").tobytes(), np.diff(ends[a : c + 1]).astype("<i4").tobytes(), raw[ends[a] : ends[c]].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([p]), *(pa.array([x], pa.binary()) for x in packed)], names=["part", "h", "n", "size", "raw"])

    return run


def _frequent(min_df: int):
    """The terms of each part that stand in ``min_df`` documents or more, in ``min_df`` rows. Rows come by part."""

    def done(held: list[tuple[np.ndarray, np.ndarray, pa.Array]]) -> Iterator[pa.RecordBatch]:
        _, n, terms = _joined(held)
        terms = terms.take(pa.array(np.flatnonzero(n >= min_df)))
        for a in range(0, len(terms), ROW_TERMS):
            row = terms.slice(a, ROW_TERMS)
            for k in range(min_df):
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.ListArray.from_arrays(pa.array([0, len(row)], pa.int32()), row)], names=["round", "terms"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for b in batches:
            for p, h, n, size, raw in zip(*(b.column(k).to_pylist() for k in range(5))):
                if p != part and held:
                    yield from done(held)
                    held = []
                part = p
                offsets = np.concatenate([[0], np.cumsum(np.frombuffer(size, "<i4"))]).astype(np.int32)
                terms = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(raw))
                held.append((np.frombuffer(h, "<u8"), np.frombuffer(n, "<u4").astype(np.int64), terms))
        if held:
            yield from done(held)

    return run


def frequent_terms(docs: DataFrame, min_df: int, volume: int | None = None) -> DataFrame:
    """(round, terms): the terms in ``min_df`` documents of their language, the byte of its code before each, once in every
    round of ``min_df``. ``volume``: bytes of all texts."""
    if volume is None:
        volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(4, int(volume // PART_BYTES))
    coded = docs.select("text", F.col("lid").cast("short").alias("code"))
    counted = coded.mapInArrow(_frequencies(parts), "part long, h binary, n binary, size binary, raw binary")
    return _written(counted.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_frequent(min_df), "round long, terms array<string>"), "frequent")


def _number(frequent: DataFrame) -> int:
    return frequent.where("round = 0").agg(F.sum(F.size("terms"))).first()[0] or 0


def kept_terms(docs: DataFrame, min_df: int) -> int:
    """The number of kept terms."""
    return _number(frequent_terms(docs, min_df))


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of a block of texts by group, with their occurrences and documents."""
    for b in batches:
        gid = b.column("gid").to_numpy()
        lid = b.column("lid").to_numpy()
        for i, j, text, off in T.chunks(b.column("text")):
            starts, ends = T.spans(text, off, TERM_BYTES)
            doc = T.owners(starts, off)
            h = T.hashes(text, starts, ends, fold=True)
            of = gid[i:j][doc]
            by = np.lexsort((doc, h, of))
            first = np.ones(len(by), bool)
            first[1:] = (h[by][1:] != h[by][:-1]) | (of[by][1:] != of[by][:-1])
            met = first.copy()
            met[1:] |= doc[by][1:] != doc[by][:-1]
            at = np.flatnonzero(first)
            ends_ = np.append(at[1:], len(by))
            seen = np.concatenate([[0], np.cumsum(met)])
            pick = by[at]
            order = np.argsort(pick)  # back in the order of the text
            pick = pick[order]
            strings = _strings(T.lower(text), starts[pick], ends[pick])
            yield pa.RecordBatch.from_arrays(
                [pa.array(of[pick]), pa.array(lid[i:j][doc[pick]]), strings, pa.array((ends_ - at)[order]), pa.array((seen[ends_] - seen[at])[order])],
                names=["gid", "lid", "term", "c", "df"],
            )


def counts_by_vectors(docs: DataFrame, min_df: int, frequent: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The vocabulary (idx, lid, term) and the counts (gid, idx, c) by way of CountVectorizer."""
    spark = docs.sparkSession
    coded = docs.select("gid", "text", F.col("lid").cast("short").alias("code"))
    frequent = frequent_terms(docs, min_df) if frequent is None else frequent
    model = CountVectorizer(inputCol="terms", outputCol="features", minDF=float(min_df), vocabSize=2**31 - 1).fit(frequent.select("terms"))
    saved = _folder(docs, "vocabulary")
    model.save(saved)
    words = spark.read.parquet(f"{saved}/data").select(F.posexplode("vocabulary").alias("idx", "word"))
    vocabulary = words.select(F.col("idx").cast("long").alias("idx"), F.ascii("word").cast("long").alias("lid"), F.expr("substring(word, 2)").alias("term"))
    terms = coded.mapInArrow(_group_terms, "gid long, weight long, terms array<string>")
    vectors = model.transform(terms).select("gid", "weight", F.unwrap_udt("features").alias("v"))
    # a term stands once in a row, so all values of a vector are 1; a plain explode would be given a filter on the
    # vectors, for which the rows are transformed two more times
    entries = vectors.select("gid", "weight", F.explode_outer("v.indices").alias("idx")).where("idx IS NOT NULL")
    sums = entries.groupBy("gid", "idx").agg(F.sum("weight").alias("c"))
    return _written(vocabulary, "terms"), sums.select("gid", F.col("idx").cast("long").alias("idx"), "c")


def counts_by_join(docs: DataFrame, min_df: int) -> tuple[DataFrame, DataFrame]:
    """The same two tables without the driver."""
    parts = docs.select("gid", "lid", "text").mapInArrow(_combined, "gid long, lid long, term string, c long, df long")
    every = _written(parts.groupBy("gid", "lid", "term").agg(F.sum("c").alias("c"), F.sum("df").alias("df")), "term-counts")
    kept = every.groupBy("lid", "term").agg(F.sum("df").alias("df")).where(F.col("df") >= min_df)
    kept = _written(kept.select(F.monotonically_increasing_id().alias("idx"), "lid", "term"), "terms")
    return kept, every.join(kept, ["lid", "term"]).select("gid", "idx", "c")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _share(count: Column, total: Column, size: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 size)) for any counts of 64 bits."""
    whole = total + 2 * size
    wide = _div((count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), whole.cast("decimal(20,0)"))
    return F.when(size > 0, 1 + F.when(count < 9 * 10**9, _div((count + 2) * F.lit(SCALE).cast("long"), whole)).otherwise(wide))


def _apart(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def audit(documents: DataFrame, min_df: int = MIN_DF, top: int = TOP_TERMS, max_terms: int = MAX_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: for each source of each language its distance to every other one (part
    ``pair``) and its ``top`` distinctive terms (part ``term``)."""
    named = _named(documents)
    sources = named.groupBy("lang").agg(F.sort_array(F.collect_set("source")).alias("sources"), F.sum(F.octet_length("text").cast("long")).alias("volume"))
    langs = _written(sources, "langs")
    # numbers in the order of the names; a row for each language is what the window sees
    numbered = langs.select("lang", F.expr("row_number() over (order by lang)").cast("long").alias("lid"))
    every = _written(langs.join(numbered, "lang").select("lang", "lid", F.explode("sources").alias("source")).withColumn("gid", F.monotonically_increasing_id()), "sources")
    docs = named.join(broadcast_if_small(every), ["lang", "source"]).select("gid", "lid", "text")

    few = every.agg(F.max("lid")).first()[0] or 0
    frequent = frequent_terms(docs, min_df, langs.agg(F.sum("volume")).first()[0]) if 0 < few <= MAX_CODES else None
    if frequent is not None and _number(frequent) <= max_terms:
        vocabulary, sums = counts_by_vectors(docs, min_df, frequent)
    else:
        vocabulary, sums = counts_by_join(docs, min_df)
    sums = _written(sums, "sums")

    sizes = vocabulary.groupBy("lid").agg(F.count("*").alias("v"))
    totals = sums.groupBy("gid").agg(F.sum("c").alias("n"))
    groups = every.join(totals, "gid", "left").join(sizes, "lid", "left").na.fill(0, ["n", "v"])
    groups = _written(groups.withColumn("p0", _share(F.lit(0).cast("long"), F.col("n"), F.col("v"))), "groups")
    known = broadcast_if_small(groups.select("gid", "lid", "n", "v", "p0"))
    shares = sums.join(known, "gid").select("gid", "idx", "lid", "c", "p0", _share(F.col("c"), F.col("n"), F.col("v")).alias("p"))
    shares = _written(shares, "shares")
    return _pairs(groups, shares).unionByName(_terms(shares, vocabulary, groups, top))


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    b = groups.select("lid", F.col("gid").alias("other"), F.col("source").alias("item"), F.col("p0").alias("q0"))
    both = groups.join(broadcast_if_small(b), "lid").where("gid <> other")
    f00 = _apart(F.col("p0"), F.col("q0"))

    # a group's own terms against another's share of absent ones: by distinct shares
    steps = shares.groupBy("gid", "p").agg(F.count("*").alias("k"))
    alone = both.join(steps, "gid").groupBy("gid", "other").agg(F.sum(F.col("k") * (_apart(F.col("p"), F.col("q0")) - f00)).alias("alone"))

    a = shares.select("idx", "gid", "p", "p0")
    c = shares.select("idx", F.col("gid").alias("other"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    p, q, p0, q0 = map(F.col, ("p", "q", "p0", "q0"))
    gain = _apart(p, q) - _apart(p, q0) - _apart(p0, q) + f00
    shared = a.join(c.hint("merge"), "idx").where("gid < other").groupBy("gid", "other").agg(F.sum(gain).alias("shared"))

    # the three parts of a pair, seen from both its ends
    parts = alone.select("gid", "other", F.col("alone").alias("part"))
    parts = parts.union(parts.select("other", "gid", "part")).union(shared).union(shared.select("other", "gid", "shared"))
    parts = parts.groupBy("gid", "other").agg(F.sum("part").alias("part"))
    zero = F.lit(0).cast("long")
    value = F.coalesce(F.col("v") * f00, zero) + F.coalesce("part", zero)
    found = both.join(parts, ["gid", "other"], "left").select("gid", "lang", "source", "item", value.cast("long").alias("value"))
    rank = F.expr("row_number() over (partition by gid order by value desc, item)")
    return found.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _terms(shares: DataFrame, vocabulary: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    whole = groups.groupBy("lid").agg(F.sum("n").alias("n"), F.first("v").alias("v"))
    common = shares.groupBy("lid", "idx").agg(F.sum("c").alias("c")).join(broadcast_if_small(whole), "lid")
    common = common.join(vocabulary.select("idx", "term"), "idx").select("idx", "term", _share(F.col("c"), F.col("n"), F.col("v")).alias("q"))
    ahead = shares.select("gid", "idx", "p").join(common, "idx").where("p > q").select("gid", "idx", "term", _apart(F.col("p"), F.col("q")).alias("value"))
    best = first_k(ahead, ["gid"], [F.desc("value"), F.asc("term")], top, salts=8, salt_on=["idx"])
    return best.join(broadcast_if_small(groups.select("gid", "lang", "source")), "gid").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


#: The same rows in DuckDB's SQL, every kept term of every group written out.
SQL = r"""
WITH d AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS rid,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), t AS (SELECT lang, source, rid, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT rid) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
whole AS (SELECT lang, source, term, coalesce(c, 0) AS c FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 2)) // (sum(c) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM whole JOIN v USING (lang)),
l AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 2)) // (sum(c) OVER (PARTITION BY lang) + 2 * v) AS q
      FROM (SELECT lang, term, sum(c)::HUGEINT AS c FROM whole GROUP BY ALL) JOIN v USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN l USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (
    SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
    UNION ALL
    SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
