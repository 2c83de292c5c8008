"""Segment vectors -> collapsed vector -> parcel means -> alias scores -> top-k regions.

No vector is ever exploded. Segments are folded in NumPy inside every input partition, the
partial vectors (one for each image and flush) are exchanged by image and folded again in a stream
with one accumulator. Parcel means and alias scores are computed in the row of the collapsed
vector, so nothing is shuffled after the fold; ranking is an array expression.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetscape.operators.sizing import DEFAULT_BROADCAST_BYTES, broadcast_if_small, is_small


def explode_vector(df: DataFrame, vector: str, keys: Sequence[str] = ("image_id",), pos: str = "pos", value: str = "value") -> DataFrame:
    """(keys..., array) -> (keys..., pos, value), pos 0-based. For inspection; no operator needs it."""
    return df.select(*keys, F.posexplode(vector).alias(pos, value))


COMBINE_FLUSH_IMAGES = 256
PARTIAL_DDL = "image_id string, partial array<double>, n bigint"


def _lists(vectors: Sequence[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in vectors])]).astype(np.int32)
    flat = np.concatenate(vectors) if len(vectors) else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _rows(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, vector) of the rows with a vector; a NULL element is NaN."""
    col = batch.column(column)
    offsets = col.offsets.to_numpy()
    values = col.values.to_numpy(zero_copy_only=False)
    valid = col.is_valid().to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(valid).tolist():
        yield i, values[offsets[i] : offsets[i + 1]]


def _fold(mode: str, flush_at: int = COMBINE_FLUSH_IMAGES):
    """Map-side: per image and vector width, the sum or maximum of the segment vectors seen, with
    their number. At most ``flush_at`` accumulators are held, whatever the skew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list] = {}

        def emit() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([k for k, _ in held], pa.string()), _lists([v for v, _ in held.values()], pa.float64()), pa.array([n for _, n in held.values()], pa.int64())], names=["image_id", "partial", "n"])
            held.clear()
            return out

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, v in _rows(batch, 1):
                if ids[i] is None or not len(v):
                    continue
                key = (ids[i], len(v))
                if key not in held:
                    if len(held) >= flush_at:
                        yield emit()
                    held[key] = [v.astype(np.float64), 1]
                    continue
                total = held[key]
                if mode == "mean":
                    total[0] += v
                else:
                    np.maximum(total[0], v, out=total[0])
                total[1] += 1
        if held:
            yield emit()

    return run


def _merge(mode: str, rows: int = 64):
    """Partials, sorted by image, to one vector an image. Positions that only some segments have
    are averaged over those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        image, total, count, n = None, np.zeros(0), np.zeros(0, np.int64), 0
        done: list[tuple] = []

        def emit() -> pa.RecordBatch:
            ids, vectors, ns = zip(*done)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), _lists(vectors, pa.float32()), pa.array(ns, pa.int64())], names=["image_id", "brain_activity", "n_segments"])

        def close() -> None:
            if n:
                done.append((image, (total / count if mode == "mean" else total).astype(np.float32), n))

        for batch in batches:
            ids, ns = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, v in _rows(batch, 1):
                if ids[i] != image:
                    close()
                    image, total, count, n = ids[i], np.zeros(0), np.zeros(0, np.int64), 0
                    if len(done) >= rows:
                        yield emit()
                if len(v) > len(total):
                    more = len(v) - len(total)
                    total = np.concatenate([total, np.full(more, 0.0 if mode == "mean" else -np.inf)])
                    count = np.concatenate([count, np.zeros(more, np.int64)])
                part = total[: len(v)]
                if mode == "mean":
                    part += v
                else:
                    np.maximum(part, v, out=part)
                count[: len(v)] += ns[i]
                n += ns[i]
        close()
        if done:
            yield emit()

    return run


def collapse_segments(segments: DataFrame, mode: str = "mean", vector: str = "activity") -> DataFrame:
    """A2/A3: (image_id, brain_activity array<float>, n_segments).

    ``mean``: average over segments (in double, stored as float32 like the reference); ``max``:
    element-wise maximum, NaN wins. Any other mode raises ``ValueError``. A NULL element counts as
    NaN; NULL and empty vectors and NULL ids don't take part. What is shuffled are partial
    vectors, one for each image in a task."""
    if mode not in ("mean", "max"):
        raise ValueError(f"unknown collapse mode: {mode!r}")
    partials = segments.select("image_id", F.col(vector).alias("activity")).mapInArrow(_fold(mode), PARTIAL_DDL)
    return partials.repartition("image_id").sortWithinPartitions("image_id").mapInArrow(_merge(mode), "image_id string, brain_activity array<float>, n_segments bigint")


def atlas_parcels(atlas: DataFrame) -> DataFrame:
    """Distinct (parcel, ordinal) of a long atlas."""
    return atlas.select("parcel", "ordinal").distinct()


def _summarise(parcels: list[tuple[str, int]], vertices: np.ndarray, of: np.ndarray, aliases: list[str], members: list[list[int]], vector: int):
    """Means of each parcel's vertices and of each alias's parcels, in the vector's row. ``of`` is the
    parcel of each vertex; ``members`` the parcels of each alias."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(parcels)
        for batch in batches:
            means, scores = [None] * batch.num_rows, [None] * batch.num_rows
            for i, v in _rows(batch, vector):
                inside = vertices < len(v)
                at, own = (vertices, of) if inside.all() else (vertices[inside], of[inside])
                count = np.bincount(own, minlength=k)
                mean = np.bincount(own, weights=v[at].astype(np.float64), minlength=k) / np.maximum(count, 1)
                means[i] = [{"parcel": p, "ordinal": o, "mean": float(mean[j])} for j, (p, o) in enumerate(parcels) if count[j]]
                scores[i] = []
                for j, name in enumerate(aliases):
                    have = [p for p in members[j] if count[p]]
                    scores[i].append({"name": name, "alias_ord": j, "score": float(np.mean(mean[have])) if have else float("nan")})
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(means, pa.list_(pa.struct([("parcel", pa.string()), ("ordinal", pa.int32()), ("mean", pa.float64())]))),
                    pa.array(scores, pa.list_(pa.struct([("name", pa.string()), ("alias_ord", pa.int32()), ("score", pa.float64())]))),
                ],
                names=[*batch.schema.names, "means", "scores"],
            )

    return run


class Lookup(NamedTuple):
    """What the tasks need of an atlas and its aliases: the parcels in order, the atlas' vertices with the index of the
    parcel of each, and the indexes of each alias's parcels."""

    parcels: list[tuple[str, int]]
    vertices: np.ndarray
    of: np.ndarray
    members: list[list[int]]


def lookup_of(atlas: DataFrame, alias_map: DataFrame | None = None, aliases: Sequence[str] = (), max_bytes: int = DEFAULT_BROADCAST_BYTES) -> Lookup:
    """The atlas (parcel, ordinal, vertex) is bounded by the mesh; it goes to the tasks after a check
    of its size, and a larger one is refused."""
    if not is_small(atlas.select("parcel", "ordinal", "vertex"), max_bytes):
        raise ValueError(f"the atlas takes more than {max_bytes} bytes")
    rows = atlas.select("parcel", "ordinal", F.col("vertex").cast("long").alias("vertex")).where("vertex IS NOT NULL").collect()
    parcels = sorted({(r[0], r[1]) for r in rows}, key=lambda p: (p[1], p[0]))
    index = {p: j for j, p in enumerate(parcels)}
    of = np.array([index[r[0], r[1]] for r in rows], np.int64)
    vertices = np.array([r[2] for r in rows], np.int64)
    members: list[list[int]] = [[] for _ in aliases]
    if alias_map is not None and parcels:
        for r in alias_parcels(atlas, alias_map).collect():
            members[list(aliases).index(r.alias)] += [j for j, (p, _) in enumerate(parcels) if p == r.parcel]
    return Lookup(parcels, vertices, of, [sorted(set(m)) for m in members])


def summarise(
    vectors: DataFrame, atlas: DataFrame, alias_map: DataFrame | None = None, aliases: Sequence[str] = (), vector: str = "brain_activity", max_bytes: int = DEFAULT_BROADCAST_BYTES, lookup: Lookup | None = None
) -> DataFrame:
    """A4 + J9 + A5: ``vectors`` with ``means`` (array of parcel, ordinal, mean; parcels with a vertex
    inside the vector) and ``scores`` (array of name, alias_ord, score; every alias in declaration
    order, NaN without a parcel).

    ``lookup``: that of the atlas and the aliases (``lookup_of``), for those who call more than once.
    Each row is worked on by itself: no shuffle."""
    at = lookup or lookup_of(atlas, alias_map, aliases, max_bytes)
    schema = T.StructType([*vectors.schema.fields, *T._parse_datatype_string("means array<struct<parcel:string,ordinal:int,mean:double>>, scores array<struct<name:string,alias_ord:int,score:double>>").fields])
    return vectors.mapInArrow(_summarise(at.parcels, at.vertices, at.of, list(aliases), at.members, vectors.columns.index(vector)), schema)


def parcel_means(vectors: DataFrame, atlas: DataFrame, vector: str = "brain_activity") -> DataFrame:
    """A4 + J9 as rows: (image_id, parcel, ordinal, mean)."""
    return summarise(vectors, atlas, vector=vector).select("image_id", F.inline("means"))


def name_parcels(values: DataFrame, vector: str, names: DataFrame | None = None, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Positional naming of a per-image value array -> (image_id, ordinal, name, value).

    With ``names`` (ordinal, name) the pairs are cut to the shorter of names and values (inner
    join on position); without, names are ``parcel_%03d``.
    """
    long = explode_vector(values, vector, pos="ordinal")
    if names is None:
        return long.withColumn("name", F.format_string("parcel_%03d", F.col("ordinal"))).select("image_id", "ordinal", "name", "value")
    nm = broadcast_if_small(names.select(F.col("ordinal").cast("int").alias("ordinal"), "name"), broadcast_bytes)
    return long.join(nm, "ordinal", "inner").select("image_id", "ordinal", "name", "value")


def alias_parcels(parcels: DataFrame, alias_map: DataFrame) -> DataFrame:
    """(alias, alias_ord, parcel) for every parcel name matching one of the alias's globs.

    A theta join (``rlike``) against the broadcast pattern table (12 aliases, a few globs each);
    a parcel counts once per alias even when two globs match.
    """
    names = parcels.select("parcel").distinct()
    pats = F.broadcast(alias_map.select("alias", "alias_ord", "regex"))
    return names.join(pats, F.expr("parcel rlike regex"), "inner").select("alias", "alias_ord", "parcel").dropDuplicates(["alias", "parcel"])


def alias_scores(vectors: DataFrame, atlas: DataFrame, alias_map: DataFrame, aliases: Sequence[str]) -> DataFrame:
    """A5 as rows: (image_id, alias, alias_ord, score) for every image and alias; NaN when no
    parcel matched."""
    return summarise(vectors, atlas, alias_map, aliases).select("image_id", F.inline("scores")).withColumnRenamed("name", "alias")


def top_k_regions(scores_array: Column, k: int = 10) -> Column:
    """NaN/NULL dropped, stable descending sort (ties keep declaration order), first k ->
    array<struct<name string, score float>>."""
    valid = F.filter(scores_array, lambda s: s["score"].isNotNull() & ~F.isnan(s["score"]))

    def cmp(l: Column, r: Column) -> Column:
        return (
            F.when(l["score"] > r["score"], F.lit(-1))
            .when(l["score"] < r["score"], F.lit(1))
            .when(l["alias_ord"] < r["alias_ord"], F.lit(-1))
            .when(l["alias_ord"] > r["alias_ord"], F.lit(1))
            .otherwise(F.lit(0))
        )

    ranked = F.slice(F.array_sort(valid, cmp), 1, k) if k > 0 else F.array().cast("array<struct<name:string,alias_ord:int,score:double>>")
    return F.transform(ranked, lambda s: F.struct(s["name"].alias("name"), s["score"].cast("float").alias("score")))


def top_regions(vectors: DataFrame, atlas: DataFrame, alias_map: DataFrame, aliases: Sequence[str], k: int = 10) -> DataFrame:
    """(image_id, top_regions)."""
    return summarise(vectors, atlas, alias_map, aliases).select("image_id", top_k_regions(F.col("scores"), k).alias("top_regions"))


def normalize_regions(df: DataFrame, col: str = "top_regions") -> DataFrame:
    """Items given as {name, score} structs or [name, score] pairs -> struct(name string,
    score float)."""
    dt = df.schema[col].dataType
    if not isinstance(dt, T.ArrayType):
        raise TypeError(f"{col} must be an array, got {dt.simpleString()}")
    el = dt.elementType
    if isinstance(el, T.StructType):
        fn = lambda x: F.struct(x["name"].cast("string").alias("name"), x["score"].cast("float").alias("score"))
    elif isinstance(el, T.ArrayType):
        fn = lambda x: F.struct(x[0].cast("string").alias("name"), x[1].cast("float").alias("score"))
    else:
        raise TypeError(f"unsupported region item type {el.simpleString()}")
    return df.withColumn(col, F.filter(F.transform(col, fn), lambda s: s["name"].isNotNull()))
