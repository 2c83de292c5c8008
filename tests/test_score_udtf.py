"""The table function against the operator it stands for."""

from __future__ import annotations

import pyarrow as pa

from streetscape.operators import scoring as M
from streetscape.operators.score_udtf import _bounded, register_scorer, score_by_sql


def _key(df):
    return sorted((r.image_id, r.timeline or "", -1 if r.segment_idx is None else r.segment_idx, tuple(r.activity or ()), r.error or "") for r in df.collect())


def test_same_rows_as_score_images(spark):
    blobs = [(f"i{k}", bytes([k % 251]) * (k * 37 % 900)) for k in range(60)] + [("bad", b"FAIL" + b"x" * 9), ("none", None), ("empty", b"")]
    items = spark.createDataFrame(blobs, "image_id string, image_blob binary")
    want = _key(M.score_images(items))
    for size, limit in ((8, 1 << 20), (3, 700), (1, 1)):
        register_scorer(spark, batch_size=size, batch_bytes=limit)
        assert _key(score_by_sql(items, 5)) == want
    assert score_by_sql(items.limit(0), 5).count() == 0


def test_groups_keep_both_bounds():
    rows = pa.RecordBatch.from_pydict({"image_id": [str(k) for k in range(9)], "image_blob": [b"x" * n for n in (5, 5, 5, 40, 1, 1, 1, 1, 0)]})
    groups = list(_bounded(iter([rows.slice(0, 4), rows.slice(4)]), 3, 12))
    assert [[r.column(0)[0].as_py() for r in g] for g in groups] == [["0", "1"], ["2"], ["3"], ["4", "5", "6"], ["7", "8"]]
