"""Batched scoring with fallback, post-processing and the frame plan."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np

from streetscape.operators import atlas as AT
from streetscape.operators import scoring as M


def test_score_images_fallback_and_rejects(spark):
    items = spark.createDataFrame(
        [("a", b"\x01\x02\x03\x04"), ("bad", b"FAIL!"), ("empty", b""), ("b", bytes(range(10)))],
        "image_id string, image_blob binary",
    ).repartition(1)
    out = M.score_images(items, M.ByteProbePredictor, batch_size=4).collect()
    errs = {r.image_id: r.error for r in out if r.error}
    assert errs["bad"].startswith("inference_failed") and errs["empty"] == "no_segments"
    good = [r for r in out if r.error is None]
    pred = M.ByteProbePredictor()([("a", b"\x01\x02\x03\x04"), ("b", bytes(range(10)))])
    for iid in ("a", "b"):
        rows = sorted((r for r in good if r.image_id == iid), key=lambda r: r.segment_idx)
        assert len(rows) == pred[iid].shape[0]
        np.testing.assert_allclose(np.array([r.activity for r in rows], np.float32), pred[iid])
        assert all(r.timeline == f"clip_{iid}" for r in rows)


def test_attach_timeline_drops_unmatched(spark):
    seg = spark.createDataFrame([("clip_a", 0, [1.0]), ("clip_zz", 0, [2.0])], "timeline string, segment_idx int, activity array<float>")
    items = spark.createDataFrame([("a",), ("b",)], "image_id string")
    rows = M.attach_timeline(seg, items).collect()
    assert [(r.image_id, r.segment_idx) for r in rows] == [("a", 0)]


def test_stack_segments_in_order(spark):
    seg = spark.createDataFrame([("b", i, [float(i), -1.0]) for i in (3, 0, 99, 70)] + [("a", 5, [2.0])], "image_id string, segment_idx int, activity array<float>")
    assert {r.image_id: r.segments for r in M.stack_segments(seg).collect()} == {"a": [[2.0]], "b": [[0.0, -1.0], [3.0, -1.0], [70.0, -1.0], [99.0, -1.0]]}


def test_every_byte_reaches_the_model():
    blob = bytearray(range(256)) * 20
    base = M.ByteProbePredictor()([("a", bytes(blob))])["a"]
    for at in (0, 700, len(blob) - 1):
        changed = bytearray(blob)
        changed[at] ^= 0xFF
        assert (M.ByteProbePredictor()([("a", bytes(changed))])["a"] != base).any()


def test_postprocess_scores_rows(spark):
    atlas = spark.createDataFrame([(p, i, i * 4 + j) for i, p in enumerate(["V1", "FFC", "MT"]) for j in range(4)], "parcel string, ordinal int, vertex int")
    seg = spark.createDataFrame([("x", 0, [float(i) for i in range(12)]), ("x", 1, [float(2 * i) for i in range(12)])], "image_id string, segment_idx int, activity array<float>")
    r = M.postprocess_scores(seg, atlas, AT.alias_map_df(spark), AT.alias_names(), k=10, model_repo="m", inferred_at=datetime(2024, 1, 1)).first()
    assert r.model_repo == "m" and r.inferred_at == datetime(2024, 1, 1)
    assert r.brain_activity[3] == 4.5
    assert [t.name for t in r.top_regions] == ["MT", "FFA", "V1"]


def test_pseudo_clip_plan_by_hand(spark):
    """Four slots: a lone frame fills them, three frames stand twice and the last one falls out, five lose
    one; order is by time; a repeated row is one frame; frames without a sequence are one of their own."""
    noon = datetime(2022, 7, 1, 12)
    at = lambda s: noon + timedelta(seconds=s)
    rows = [("one", at(0), "x")] * 5
    rows += [("three", at(9), "late"), ("three", at(1), "early"), ("three", at(5), "mid")]
    rows += [("five", at(k), f"f{k}") for k in (4, 2, 0, 3, 1)]
    rows += [(None, at(1), "n1"), (None, at(0), "n0")]
    plan = {}
    for r in M.pseudo_clip_plan(spark.createDataFrame(rows, "sequence_id string, captured_at timestamp_ntz, image_id string"), target=4, salts=3).collect():
        plan.setdefault(r.sequence_id, {})[r.frame_idx] = r.image_id
    assert {k: [v[i] for i in range(len(v))] for k, v in plan.items()} == {
        "one": ["x", "x", "x", "x"],
        "three": ["early", "early", "mid", "mid"],
        "five": ["f0", "f1", "f2", "f3"],
        None: ["n0", "n0", "n1", "n1"],
    }
    full = M.pseudo_clip_plan(spark.createDataFrame([("one", at(0), "x")] * 64, "sequence_id string, captured_at timestamp_ntz, image_id string"))
    assert full.count() == 64
