"""Batched model scoring (pluggable predictor), segment post-processing and the frame plan.

Scoring is the one Python step: ``mapInArrow`` loads the predictor once per task and feeds it
fixed-size batches of (image_id, blob). Everything after it (collapse, parcel means, alias
scores, top-k) is native Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetscape.functions.timeparse import ntz_literal
from streetscape.operators import summary as S
from streetscape.operators.topk import first_k

SEGMENT_OUT_DDL = "image_id string, timeline string, segment_idx int, activity array<float>, error string"

# A predictor takes [(image_id, blob bytes)] and returns {image_id: float32 array (n_segments, dim)}.
Predictor = Callable[[list[tuple[str, bytes]]], dict[str, np.ndarray]]


class ByteProbePredictor:
    """Deterministic stand-in model for tests and benchmarks.

    For a blob of L bytes it returns ``1 + L % max_segments`` segments; element i of segment s is the
    mean of the bytes at positions congruent to i modulo ``dim``, plus s, over 255 (0 bytes there:
    just s / 255), so every byte counts. Empty blobs give no segments; blobs starting with
    ``fail_marker`` make the call raise (to exercise the batch -> single-item fallback).
    """

    def __init__(self, dim: int = 64, max_segments: int = 3, fail_marker: bytes | None = b"FAIL"):
        self.dim = dim
        self.max_segments = max_segments
        self.fail_marker = fail_marker

    def __call__(self, items: list[tuple[str, bytes]]) -> dict[str, np.ndarray]:
        out: dict[str, np.ndarray] = {}
        for image_id, blob in items:
            if self.fail_marker and blob is not None and bytes(blob[: len(self.fail_marker)]) == self.fail_marker:
                raise RuntimeError(f"predictor failed on {image_id}")
            if not blob:
                continue
            arr = np.frombuffer(bytes(blob), dtype=np.uint8)
            n = 1 + len(arr) % self.max_segments
            lane = np.arange(len(arr)) % self.dim
            mean = np.bincount(lane, weights=arr, minlength=self.dim) / np.maximum(np.bincount(lane, minlength=self.dim), 1)
            out[image_id] = ((mean[None, :] + np.arange(n)[:, None]) / 255.0).astype(np.float32)
        return out


def _segment_rows(image_id: str, preds: np.ndarray | None, error: str | None, out: dict) -> None:
    """Append one item's output rows (one per segment, or one error row) to column lists."""
    if error is None and (preds is None or np.asarray(preds).size == 0):
        error = "no_segments"
    if error is not None:
        out["image_id"].append(image_id)
        out["timeline"].append(None)
        out["segment_idx"].append(None)
        out["vectors"].append(None)
        out["error"].append(error)
        return
    mat = np.asarray(preds, dtype=np.float32)
    if mat.ndim == 1:
        mat = mat[None, :]
    for i in range(mat.shape[0]):
        out["image_id"].append(image_id)
        out["timeline"].append(f"clip_{image_id}")
        out["segment_idx"].append(i)
        out["vectors"].append(mat[i])
        out["error"].append(None)


def _to_batch(out: dict) -> pa.RecordBatch:
    """Column lists -> Arrow batch; vectors become one list<float> array over one flat buffer."""
    vecs = out["vectors"]
    lengths = np.array([0 if v is None else len(v) for v in vecs], dtype=np.int64)
    offsets = np.zeros(len(vecs) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    present = [v for v in vecs if v is not None]
    flat = np.concatenate(present).astype(np.float32, copy=False) if present else np.zeros(0, np.float32)
    mask = pa.array([v is None for v in vecs], pa.bool_())
    activity = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.float32()), mask=mask)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(out["image_id"], pa.string()),
            pa.array(out["timeline"], pa.string()),
            pa.array(out["segment_idx"], pa.int32()),
            activity,
            pa.array(out["error"], pa.string()),
        ],
        names=["image_id", "timeline", "segment_idx", "activity", "error"],
    )


def _score_partition(
    batches: Iterator[pa.RecordBatch],
    predictor_factory: Callable[[], Predictor],
    batch_size: int,
) -> Iterator[pa.RecordBatch]:
    """One predictor per task; one model call per ``batch_size`` items; one Arrow batch out per
    model call (so output memory is bounded by batch_size x segments x width)."""
    predictor = predictor_factory()

    def run(chunk: list[tuple[str, bytes]]) -> pa.RecordBatch:
        out: dict[str, list] = {"image_id": [], "timeline": [], "segment_idx": [], "vectors": [], "error": []}
        try:
            preds = predictor(chunk)
            for iid, _ in chunk:
                _segment_rows(iid, preds.get(iid), None, out)
        except Exception:
            # M2: batch failed -> one by one; a failing item is reported, the rest go on.
            for iid, blob in chunk:
                try:
                    single = predictor([(iid, blob)])
                    _segment_rows(iid, single.get(iid), None, out)
                except Exception as exc:  # noqa: BLE001
                    _segment_rows(iid, None, f"inference_failed: {exc}", out)
        return _to_batch(out)

    pending: list[tuple[str, bytes]] = []
    for rb in batches:
        ids = rb.column(0).to_pylist()
        blobs = rb.column(1).to_pylist()
        for iid, blob in zip(ids, blobs):
            pending.append((iid, blob))
            if len(pending) >= batch_size:
                yield run(pending)
                pending = []
    if pending:
        yield run(pending)


def score_images(
    items: DataFrame,
    predictor_factory: Callable[[], Predictor] = ByteProbePredictor,
    batch_size: int = 8,
) -> DataFrame:
    """M1-M3: (image_id, image_blob) -> segment rows (image_id, timeline, segment_idx, activity,
    error). Failed items and items without segments come back as one row with ``error`` set.

    ``mapInArrow``: blobs arrive as Arrow batches and vectors leave as Arrow list arrays, so the
    only per-item Python is the model call itself. Keep
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` modest for large blobs.
    """

    def fn(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _score_partition(it, predictor_factory, batch_size)

    return items.select("image_id", "image_blob").mapInArrow(fn, SEGMENT_OUT_DDL)


def good_segments(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("error").isNull()).drop("error")


def scoring_rejects(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("error").isNotNull()).select("image_id", F.col("error").alias("drop_reason"))


def attach_timeline(segments: DataFrame, items: DataFrame) -> DataFrame:
    """``clip_<image_id>`` timeline -> image_id; segments matching no item are dropped."""
    keys = items.select(F.concat(F.lit("clip_"), F.col("image_id")).alias("timeline"), F.col("image_id").alias("__id")).distinct()
    seg = segments.drop("image_id") if "image_id" in segments.columns else segments
    return seg.join(keys, "timeline", "inner").withColumnRenamed("__id", "image_id")


def stack_segments(segments: DataFrame) -> DataFrame:
    """The segments of each image in segment order -> (image_id, segments array<array<float>>).
    A stack is one image's model output, a clip's worth of vectors."""
    agg = segments.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("segment_idx", "activity"))).alias("__s"))
    return agg.select("image_id", F.transform("__s", lambda s: s["activity"]).alias("segments"))


def postprocess_scores(
    segments: DataFrame,
    atlas: DataFrame,
    alias_map: DataFrame,
    aliases: Sequence[str],
    k: int = 10,
    model_repo: str = "test/byte-probe",
    inferred_at: Column | datetime | None = None,
    mode: str = "mean",
    lookup: S.Lookup | None = None,
) -> DataFrame:
    """M4: segments -> score-store rows (image_id, brain_activity, top_regions, inferred_at,
    model_repo). Collapse (A2), parcel means (A4), alias scores (A5), top-k (W2): one exchange of
    partial vectors, then everything in the image's row. ``lookup``: see ``summary.summarise``."""
    vectors = S.collapse_segments(segments, mode).select("image_id", "brain_activity")
    if inferred_at is None:
        ts = F.current_timestamp().cast("timestamp_ntz")
    elif isinstance(inferred_at, datetime):
        ts = ntz_literal(inferred_at)
    else:
        ts = inferred_at
    return S.summarise(vectors, atlas, alias_map, aliases, lookup=lookup).select(
        "image_id",
        "brain_activity",
        S.top_k_regions(F.col("scores"), k).alias("top_regions"),
        ts.alias("inferred_at"),
        F.lit(model_repo).alias("model_repo"),
    )


def pseudo_clip_plan(
    images: DataFrame,
    target: int = 64,
    group: str = "sequence_id",
    order: Sequence[str] = ("captured_at", "image_id"),
    salts: int = 32,
) -> DataFrame:
    """Chronological frame plan per sequence -> (sequence_id, frame_idx, image_id).

    n >= target: the first ``target`` frames. n < target: every frame repeated
    r = ceil(target / n) times, cut to ``target`` (late frames can vanish). A repeated row is one
    frame; frames without a sequence are a sequence of their own (NULL). Ranking is the
    skew-safe salted first-k; the group sizes come from a partial count, so no group is ever
    collected.
    """
    if target <= 0:
        raise ValueError("target must be positive")
    frames = images.select(group, *order, "image_id").dropDuplicates()
    counts = frames.groupBy(F.col(group).alias("__group")).agg(F.count(F.lit(1)).alias("__n"))
    ranked = first_k(frames, [group], [F.col(c) for c in order], target, "__rank", salts)
    plan = ranked.join(counts, F.col(group).eqNullSafe(F.col("__group")), "inner").drop("__group")
    r = F.when(F.col("__n") >= target, F.lit(1)).otherwise(F.ceil(F.lit(target) / F.col("__n"))).cast("int")
    i = F.col("__rank") - 1
    plan = plan.withColumn("__r", r).filter(i * F.col("__r") < target)
    start = i * F.col("__r")
    stop = F.least(start + F.col("__r"), F.lit(target)) - 1
    return plan.select(group, F.explode(F.sequence(start, stop)).alias("frame_idx"), "image_id")
