"""N-gram Jaccard join: universe partition and pigeonhole over sets of five-word shingles.

Documents of equal sets form a class; classes are joined. Two sets of sizes s <= t with a Jaccard
similarity of 0.75 differ in at most (s + t) / 7 <= 2t / 7 shingles. By size band the universe of
shingles is hashed into segments, more of them than that. Each class indexes, in its band and where
its size allows in the next one, its subset of every segment that isn't empty, and in the first
``DOUBLE`` segments also the subsets with one shingle deleted. The larger set of a pair probes: it allots its
segments weights of 0, 1 (equal subsets) or 2 (subsets within one deletion) whose sum exceeds 2t / 7,
so at least one allotted segment must match. The allotment is made when every key's bucket has been
counted and takes the cheapest units first: those whose keys no other class has cost nothing, so a class
that shares only a passage with others is a candidate of none. In the bands below ``SINGLE`` shingles each
shingle is a segment of its own. A class whose segments can't reach the sum is compared with all
classes instead, in blocks.

Signatures travel as packed blocks: one row for each task and partition of the key space. Members of
a bucket are compared with its best connected member first and linked; only members that are still in
different components of one bucket are compared in a second round, and in the join itself only if the
parities of their shingles in 1,024 hash slots differ in no more slots than the similarity allows. A pair whose sets,
counted by hash slot, differ by more than it allows is dropped too (both bound the sets' difference from
below); all other verdicts come from the whole sets, read for the classes in question only.

Sets and classes are known by 64-bit hashes of their shingles.

Defined cases: null and empty texts and texts without words have no shingles and are their own
component; a text of fewer than five words is one shingle; repeated rows are of one class; a row without
doc_id takes part in links like any other, is never the smallest id, and has a null component if it reaches no
row with one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetscape.llm import tokens as T
from streetscape.llm.graph import components, written

SHINGLE, SHARE, OF = 5, 75, 100
SINGLE, DOUBLE, SLACK = 32, 2, 1.25  # two doubled segments: see the tags
#: What a key is for, in its lowest bits: an exact subset; one in the first or second segment that has deletions;
#: a deletion in the first or second segment; any key in a band where its class doesn't probe.
PLAIN, EXACT, DELETED, INDEX = 0, 1, 3, 5
TAG_BITS, KEY_BITS = 3, 45
#: Bytes of signatures in a partition of the key space, and the part of a text's bytes that they take.
PART_BYTES, SIGNATURE_SHARE = 8 << 20, 1.0
#: Ids up to which a set of documents to be read is broadcast; beyond, it is joined by shuffle.
BROADCAST_IDS = 500_000
IRREGULAR_BLOCK, IRREGULAR_BYTES = 1000, 32 << 20
#: 64-bit words of a set's parity sketch.
PARITY = 16
_U = np.uint64


def sets(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles: (hash, text), by text and hash."""
    starts, ends = T.spans(buf, off)
    doc = T.owners(starts, off)
    h = T.hashes(buf, starts, ends, fold=True)
    key, at = T.grams(h, doc, SHINGLE)
    own = doc[at]
    n = T.counts(doc, len(off) - 1)
    for k in range(1, SHINGLE):  # shorter texts, whole
        short = n == k
        if short.any():
            first = np.searchsorted(doc, np.flatnonzero(short))
            whole, _ = T.grams(h[(first[:, None] + np.arange(k)).ravel()], np.repeat(np.arange(len(first)), k), k)
            key, own = np.concatenate([key, whole]), np.concatenate([own, np.flatnonzero(short)])
    order = np.lexsort((key, own))
    key, own = key[order], own[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
    return key[new], own[new]


def classes(key: np.ndarray, own: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(size, class id) of each text's set; the id is an order-free hash of the set."""
    size = T.counts(own, n)
    first = np.concatenate([[0], np.cumsum(size)])
    total = np.concatenate([np.zeros(1, _U), np.cumsum(T.mix(key ^ _U(0xC2B2AE3D27D4EB4F)))])
    return size, T.mix(total[first[1:]] - total[first[:-1]] + size.astype(_U))


def slot_counts(key: np.ndarray, own: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Of each set, its shingles counted by hash slot, with about two for a slot and at most 255."""
    slots = 1 << np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) - 1
    first = np.concatenate([[0], np.cumsum(slots)])
    at = first[own] + (T.mix(key + _U(0x8EBC6AF09C88C6E3)) & (slots[own] - 1).astype(_U)).astype(np.int64)
    counts = np.minimum(np.bincount(at, minlength=int(first[-1])), 255).astype(np.uint8)
    return [counts[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]


def differ(a: bytes, b: bytes) -> int:
    """At least so many shingles are in one of two sets only."""
    x, y = np.frombuffer(a, np.uint8).astype(np.int64), np.frombuffer(b, np.uint8).astype(np.int64)
    if len(x) > len(y):
        x, y = y, x
    full = (x == 255).any() or (y == 255).any()
    y = y.reshape(-1, len(x)).sum(axis=0)
    return int(np.abs(x - y)[(x < 255) & (y < 255)].sum() if full else np.abs(x - y).sum())


def parities(key: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    """[n, PARITY] words: of each hash slot, whether an odd number of the set's shingles is in it."""
    bits = PARITY * 64
    slot = (T.mix(key + _U(0xD2B74407B1CE6E93)) >> _U(64 - (bits.bit_length() - 1))).astype(np.int64)
    odd = np.bincount(own * bits + slot, minlength=n * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, bits), axis=1, bitorder="little").view("<i8")


def need(t: np.ndarray) -> np.ndarray:
    """One more than the shingles in which a set of size t and a smaller similar one can differ."""
    return 2 * t * (OF - SHARE) // (OF + SHARE) + 1


def band(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)


def segments(b: np.ndarray) -> np.ndarray:
    """Segments of a band's universe, enough that the largest set of it has as many filled ones as it needs."""
    most = need((2 << b) - 1)
    return np.ceil(SLACK * most + 2 * np.sqrt(most)).astype(np.int64) + 4


def reach(t: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Segments, from the first, among which a probe of size t allots its weights."""
    m = segments(b)
    filled = 1 - np.exp(-np.maximum(t, 1) / m)
    want = need(t)
    return np.minimum(m, np.ceil((1.1 * want + 2 * np.sqrt(want) + 4) / filled).astype(np.int64))


def furthest(t: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The greatest reach of the probes of a band up to size t: ``need`` grows by one in every 3.5 sizes at
    least, and between two steps the reach falls."""
    return reduce(np.maximum, [reach(np.maximum(t - k, 1 << b), b) for k in range(4)])


def _subsets(key: np.ndarray, own: np.ndarray, size: np.ndarray, b: np.ndarray) -> dict[str, np.ndarray]:
    """The filled segments of each set in the universe of its band ``b``: owner, segment, number
    of shingles, sum of their hashes, key; and the deletion keys with the segment they come from."""
    scr = T.mix(key + (b[own].astype(_U) + _U(1)) * _U(0x9FB21C651E98DF25))
    single = (1 << b[own]) < SINGLE  # by band, so that a set that indexes itself in the next one has the keys that probes look for
    m = segments(b)[own]
    seg = np.where(single, 0, ((scr >> _U(32)) * m.astype(_U)) >> _U(32)).astype(np.int64)
    top = np.minimum(size * OF // SHARE, (2 << b) - 1)
    inside = single | (seg < furthest(top, b)[own])
    scr, seg, own, single = scr[inside], seg[inside], own[inside], single[inside]
    seg = np.where(single, np.arange(len(seg)), seg)  # each shingle by itself
    order = np.lexsort((seg, own))
    scr, seg, own, single = scr[order], seg[order], own[order], single[order]
    start = np.ones(len(seg), bool)
    start[1:] = (seg[1:] != seg[:-1]) | (own[1:] != own[:-1])
    first = np.flatnonzero(start)
    if not len(first):
        empty = np.zeros(0, np.int64)
        return {"own": empty, "seg": empty, "n": empty, "key": empty.astype(_U), "del_key": empty.astype(_U), "del_at": empty}
    total = np.add.reduceat(scr, first)
    named = np.where(single[first], 1 << 20, seg[first])
    salt = (b[own[first]].astype(_U) << _U(32)) + named.astype(_U)
    group = np.cumsum(start) - 1
    count = np.bincount(group)
    wide = ~single & (seg < DOUBLE) & (count[group] >= 2)
    return {
        "own": own[first],
        "seg": seg[first],
        "n": count,
        "key": T.mix(total ^ T.mix(salt)),
        "del_key": T.mix((total[group[wide]] - scr[wide]) ^ T.mix(salt[group[wide]])),
        "del_at": group[wide],
    }


def signatures(key: np.ndarray, own: np.ndarray, size: np.ndarray) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray, bool]]:
    """Subsets of all sets in their own band, where they probe too, and of those large enough in the next."""
    b = band(size)
    yield _subsets(key, own, size, b), b, True
    larger = (size > 0) & (size * OF >= SHARE * (2 << b))
    if larger.any():
        pick = larger[own]
        yield _subsets(key[pick], own[pick], size, b + 1), b + 1, False


def tagged(s: dict[str, np.ndarray], size: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tags of the subsets' keys, tags of the deletion keys, units that each set can allot) in the band where the sets probe."""
    limit = np.where(size < SINGLE, np.iinfo(np.int64).max, reach(size, b))
    usable = (s["seg"] < limit[s["own"]]) | (size[s["own"]] < SINGLE)
    doubled = np.zeros(len(s["key"]), bool)
    doubled[s["del_at"]] = True
    tag = np.where(~usable, INDEX, np.where(doubled, EXACT + s["seg"], PLAIN))
    at = s["del_at"]
    units = np.bincount(s["own"], weights=usable.astype(np.int64) + (usable & doubled), minlength=n).astype(np.int64)
    return tag, np.where(usable[at], DELETED + s["seg"][at], INDEX), units


_PROFILE = ", ".join(["doc_id long", "n long", "class long", "bytes long", "counts binary", *(f"p{k} long" for k in range(PARITY))])


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document with its set's size, class and counts by hash slot."""
    for batch in batches:
        for i, j, buf, off in T.chunks(batch.column("text")):
            key, own = sets(buf, off)
            size, cls = classes(key, own, j - i)
            columns = [batch.column("doc_id").slice(i, j - i), pa.array(size), pa.array(cls.view(np.int64)), pa.array(np.diff(off)), pa.array(slot_counts(key, own, size), pa.binary())]
            odd = parities(key, own, j - i)
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(odd[:, k]) for k in range(PARITY))], names=[x.split()[0] for x in _PROFILE.split(", ")])


def _unseen(key, own, size, cls, seen: set[int]):
    """Without the texts whose class this task has had already."""
    new = np.zeros(len(cls), bool)
    for k, c in enumerate(cls.tolist()):
        if size[k] and c not in seen:
            seen.add(c)
            new[k] = True
    pick = new[own]
    return key[pick], own[pick], np.where(new, size, 0), new


def _emit(parts: int):
    """Packed signatures: for each partition of the key space, the task's classes (with size, units and number
    of keys) and their keys, 45 bits with the tag below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple] = []
        rows = 0
        for batch in batches:
            for i, j, buf, off in T.chunks(batch.column("text")):
                key, own = sets(buf, off)
                size, cls = classes(key, own, j - i)
                key, own, size, _ = _unseen(key, own, size, cls, seen)
                for s, b, probing in signatures(key, own, size):
                    if probing:
                        tag, del_tag, units = tagged(s, size, b, j - i)
                        short = np.flatnonzero((size > 0) & (units < need(size)))
                        held.append((np.full(len(short), parts), np.zeros(len(short), _U), cls[short], size[short], units[short]))
                    else:
                        tag, del_tag = np.full(len(s["key"]), INDEX), np.full(len(s["del_at"]), INDEX)
                    keys = np.concatenate([s["key"], s["del_key"]])
                    owner = np.concatenate([s["own"], s["own"][s["del_at"]]])
                    part = ((keys >> _U(32)) * _U(parts)) >> _U(32)
                    packed = (T.mix(keys) >> _U(64 - KEY_BITS)) << _U(TAG_BITS) | np.concatenate([tag, del_tag]).astype(_U)
                    held.append((part.astype(np.int64), packed, cls[owner], size[owner], units[owner]))
                    rows += len(keys)
                if rows > 500_000:
                    yield from _pack(held)
                    held, rows = [], 0
        yield from _pack(held)

    return run


def _pack(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    part, key, cls, size, units = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((cls, part))
    part, key, cls, size, units = part[order], key[order], cls[order], size[order], units[order]
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
    out = []
    for a, b in zip(first, np.append(first[1:], len(part))):
        head = np.flatnonzero(np.append(True, cls[a + 1 : b] != cls[a : b - 1])) + a
        table = np.stack([cls[head].view(np.int64), size[head], units[head], np.diff(np.append(head, b))], axis=1)
        out.append((int(part[a]), table.astype("<i8").tobytes(), key[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()))
    for k in range(0, len(out), 64):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[k : k + 64]), [pa.int64(), pa.binary(), pa.binary()])], names=["part", "classes", "keys"])


def _keys(raw: bytes) -> np.ndarray:
    six = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view("<u8").ravel()


_BUCKETS = "key long, class long, n long, units long, tag int, others long"


def _buckets(parts: int):
    """Members of the buckets with two classes at least, each with the number of ``others``; for partition
    ``parts``, which lists classes without keys, all of them with the key -1. Rows come by partition."""

    def flush(part: int, tables: list[bytes], keys: list[bytes]) -> Iterator[pa.RecordBatch]:
        table = np.concatenate([np.frombuffer(t, "<i8").reshape(-1, 4) for t in tables])
        key = np.concatenate([_keys(k) for k in keys])
        row = np.repeat(np.arange(len(table)), table[:, 3])
        tag = (key & _U((1 << TAG_BITS) - 1)).astype(np.int32)
        key >>= _U(TAG_BITS)
        order = np.lexsort((tag, table[row, 0], key))
        key, row, tag = key[order], row[order], tag[order]
        cls = table[row, 0]
        new_class = np.append(True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1]))
        at = np.flatnonzero(new_class | np.append(True, tag[1:] != tag[:-1]))
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        many = np.add.reduceat(new_class.astype(np.int64), first)
        size = many[np.cumsum(np.append(True, key[1:] != key[:-1])) - 1]
        at = at[(size[at] > 1) | (part == parts)]
        if len(at):
            place = np.full(len(at), -1) if part == parts else (part << KEY_BITS) + key[at].astype(np.int64)
            columns = [place, cls[at], table[row[at], 1], table[row[at], 2], tag[at], size[at] - 1]
            for k in range(0, len(at), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[k : k + 200_000]) for c in columns], names=[x.split()[0] for x in _BUCKETS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tables, keys = None, [], []
        for b in batches:
            for p, t, k in zip(b.column("part").to_pylist(), b.column("classes").to_pylist(), b.column("keys").to_pylist()):
                if p != part and tables:
                    yield from flush(part, tables, keys)
                    tables, keys = [], []
                part = p
                tables.append(t)
                keys.append(k)
        if tables:
            yield from flush(part, tables, keys)

    return run


def allotted(buckets: DataFrame) -> DataFrame:
    """The members of the buckets that some class probes in, with ``probe`` for those that do and the
    ``degree`` of each class, its others in all its buckets.

    A unit is a subset's key or, of a doubled segment, its key and its deletions together; it costs the others in its buckets.
    Units without a shared key cost nothing and aren't in the table; of the rest each class takes the
    cheapest, as many as it still needs."""
    unit = F.when(F.col("tag") == PLAIN, F.array("key"))
    for k in range(DOUBLE):
        unit = unit.when(F.col("tag") == EXACT + k, F.array(F.col("key"), F.lit(-1 - k).cast("long"))).when(F.col("tag") == DELETED + k, F.array(F.lit(-1 - k).cast("long")))
    rows = buckets.where(F.col("tag") != INDEX).select("key", "class", "n", "units", "others", F.explode(unit).alias("unit"))
    costs = rows.groupBy("class", "n", "units", "unit").agg(F.sum("others").alias("cost"))
    by_class = Window.partitionBy("class")
    wanted = F.expr(f"2 * n * {OF - SHARE} div {OF + SHARE} + 1") - (F.col("units") - F.count("*").over(by_class))
    taken = costs.withColumn("still", wanted).withColumn("rank", F.row_number().over(by_class.orderBy("cost", "unit"))).where("rank <= still").select("class", "unit")
    probes = written(rows.join(taken, ["class", "unit"], "left_semi").select("key", "class").distinct(), "probes")
    degree = buckets.groupBy("class").agg(F.sum("others").alias("degree"))
    members = buckets.select("key", "class", "n").distinct().join(probes.select("key").distinct(), "key", "left_semi").join(degree, "class")
    return written(members.join(probes.withColumn("probe", F.lit(True)), ["key", "class"], "left").withColumn("probe", F.coalesce("probe", F.lit(False))), "members")


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, sorted 48-bit shingles) of each text."""
    for b in batches:
        for i, j, buf, off in T.chunks(b.column("text")):
            key, own = sets(buf, off)
            size, cls = classes(key, own, j - i)
            low = (key >> _U(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            first = np.concatenate([[0], np.cumsum(size)])
            yield pa.RecordBatch.from_arrays([pa.array(cls.view(np.int64)), pa.array([low[a:c].tobytes() for a, c in zip(first[:-1], first[1:])], pa.binary())], names=["class", "grams"])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return OF * both >= SHARE * (len(a) + len(b) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ok = [similar(_keys(x), _keys(y)) for x, y in zip(b.column("a_grams").to_pylist(), b.column("b_grams").to_pylist())]
        yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def sets_of(docs: DataFrame, profile: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, grams) of the classes ``wanted`` (distinct class): each from the document of its least doc_id, or, if
    none of its documents has one, from any of these, known by the class that its words give."""
    chosen = written(profile.where("n > 0").join(_small(wanted), "class", "left_semi").groupBy("class").agg(F.min("doc_id").alias("doc_id")), "chosen")
    ids = _small(chosen.where("doc_id IS NOT NULL").select("doc_id").distinct())
    read = docs.join(ids, "doc_id", "left_semi").mapInArrow(_whole_sets, "class long, grams binary")
    nameless = chosen.where("doc_id IS NULL").select("class")
    if not nameless.isEmpty():
        more = docs.where("doc_id IS NULL").mapInArrow(_whole_sets, "class long, grams binary")
        read = read.union(more.join(_small(nameless), "class", "left_semi"))
    return read.dropDuplicates(["class"])


def _small(ids: DataFrame) -> DataFrame:
    """To be broadcast up to ``BROADCAST_IDS`` rows of one number each, joined by a shuffle beyond. The rows are
    counted in their tasks, none of them is moved for it."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        limit = [(m + n) * (OF - SHARE) // (OF + SHARE) for m, n in zip(b.column("a_n").to_pylist(), b.column("b_n").to_pylist())]
        ok = [differ(x, y) <= most for x, y, most in zip(b.column("a_counts").to_pylist(), b.column("b_counts").to_pylist(), limit)]
        yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def links(docs: DataFrame, profile: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of classes whose whole sets are similar."""
    counted = profile.where("n > 0").select("class", "n", "counts").dropDuplicates(["class"])
    side = lambda df, s: df.select(*[F.col(c).alias(s if c == "class" else f"{s}_{c}") for c in df.columns])
    pairs = written(pairs.join(side(counted, "a"), "a").join(side(counted, "b"), "b").select("a", "b", "a_n", "b_n", "a_counts", "b_counts").mapInArrow(_plausible, "a long, b long"), "pairs")
    wanted = written(pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct(), "wanted")
    grams = sets_of(docs, profile, wanted)
    both = pairs.join(side(grams, "a"), "a").join(side(grams, "b"), "b")
    return written(both.select("a", "b", "a_grams", "b_grams").mapInArrow(_verify, "a long, b long").distinct(), "links")


def _fits(a: str, b: str) -> F.Column:
    return (F.col(a) * OF >= F.col(b) * SHARE) & (F.col(b) * OF >= F.col(a) * SHARE)


def _probed(n: str, probe: str, n2: str, probe2: str) -> F.Column:
    """Whether the larger of two members of a bucket probes there."""
    return ((F.col(n) >= F.col(n2)) & F.col(probe)) | ((F.col(n) <= F.col(n2)) & F.col(probe2))


def _against(block: list[tuple[int, bytes]]):
    queries = [(c, _keys(g)) for c, g in block]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _whole_sets(batches):
            out = [(q, c) for c, g in zip(b.column("class").to_pylist(), b.column("grams").to_pylist()) if g for q, s in queries if q != c and similar(s, _keys(g))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["a", "b"])

    return run


def join_components(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profile = written(docs.mapInArrow(_profile, _PROFILE), "profile")
    volume = profile.agg(F.sum("bytes")).first()[0] or 0
    parts = max(8, int(volume * SIGNATURE_SHARE / PART_BYTES))
    packed = docs.mapInArrow(_emit(parts), "part long, classes binary, keys binary")
    buckets = written(packed.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_buckets(parts), _BUCKETS), "buckets")
    irregular = buckets.where("key = -1").select("class").distinct()
    members = allotted(buckets.where("key >= 0"))

    # the hub is the member that shares most with others: of a text and its near copies, the text
    hubs = members.groupBy("key").agg(F.max(F.struct("degree", "class", "n", "probe")).alias("hub")).select("key", F.col("hub.class").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.probe").alias("hub_probe"))
    first = members.join(hubs, "key").where((F.col("class") != F.col("hub")) & _fits("n", "hub_n") & _probed("n", "probe", "hub_n", "hub_probe"))
    first = written(first.select(F.col("class").alias("a"), F.col("hub").alias("b")).distinct(), "first")
    found = links(docs, profile, first)
    root = components(found)
    left = members.join(root.withColumnRenamed("id", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    left = written(left, "rooted")
    mixed = left.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    odd = profile.where("n > 0").select("class", *[f"p{k}" for k in range(PARITY)]).dropDuplicates(["class"])
    open_ = left.join(mixed, "key", "left_semi").join(odd, "class")
    x, y = open_.alias("x"), open_.alias("y")
    differ_in = reduce(lambda p, q: p + q, [F.bit_count(F.col(f"x.p{k}").bitwiseXOR(F.col(f"y.p{k}"))) for k in range(PARITY)])
    plausible = differ_in * (OF + SHARE) <= (F.col("x.n") + F.col("y.n")) * (OF - SHARE)
    second = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.class") < F.col("y.class")) & (F.col("x.root") != F.col("y.root")) & _fits("x.n", "y.n") & _probed("x.n", "x.probe", "y.n", "y.probe") & plausible)
    second = second.select(F.col("x.class").alias("class"), F.col("y.class").alias("class2"))
    second = second.select(F.greatest("class", "class2").alias("a"), F.least("class", "class2").alias("b")).distinct().join(first.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), ["a", "b"], "left_anti")
    more = links(docs, profile, second).union(_irregular_links(docs, profile, irregular))
    root = components(found.union(more)) if more.limit(1).count() else root

    rows = profile.select("doc_id", "n", "class")
    least = rows.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least")).join(root.withColumnRenamed("id", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    of_root = least.groupBy("root").agg(F.min("least").alias("component"))
    named = least.join(of_root, "root").select("class", "component")
    empty = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return rows.where("n > 0").join(named, "class").select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id")).union(empty)


def keep_first(documents: DataFrame) -> DataFrame:
    """The documents, all their columns kept: of each component the one of least doc_id, and all without a
    doc_id. Of rows that share an id that stays, any one does."""
    ids = written(join_components(documents).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("first"), F.count("*").alias("rows")), "kept")
    known = documents.where(documents["doc_id"].isNotNull())
    gone = _small(ids.where(~F.col("first") | (F.col("rows") > 1)).select(F.col("doc_id").alias("id")))
    twice = _small(ids.where(F.col("first") & (F.col("rows") > 1)).select(F.col("doc_id").alias("id")))
    single = known.join(gone, known["doc_id"].cast("long") == gone["id"], "left_anti")
    repeated = known.join(twice, known["doc_id"].cast("long") == twice["id"], "left_semi").dropDuplicates(["doc_id"])
    return single.union(repeated).union(documents.where(documents["doc_id"].isNull()))


def _irregular_links(docs: DataFrame, profile: DataFrame, irregular: DataFrame) -> DataFrame:
    """Links of the classes whose segments couldn't reach their sum, with every class, block by block. A block has
    about ``IRREGULAR_BLOCK`` classes and ``IRREGULAR_BYTES`` of sets."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "a long, b long")
    sized = profile.where("n > 0").select("class", "n").dropDuplicates(["class"]).join(irregular, "class", "left_semi")
    n, shingles = sized.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    blocks = max(-(-n // IRREGULAR_BLOCK), -(-shingles * 6 // IRREGULAR_BYTES))
    for k in range(blocks):
        block = sets_of(docs, profile, irregular.where(F.pmod(F.xxhash64("class"), F.lit(blocks)) == k)).collect()
        out = out.union(docs.mapInArrow(_against([(r[0], bytes(r[1])) for r in block]), "a long, b long"))
    return written(out.distinct(), "irregular") if blocks else out
