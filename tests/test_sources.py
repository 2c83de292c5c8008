"""Readers for segments and labels; the bounded streaming dedup."""

from __future__ import annotations

from datetime import datetime

from streetscape.sources.stores import scan_parcel_labels, scan_segments
from streetscape.streaming.incremental import dedupe_within_watermark


def test_scan_segments_and_labels(spark, tmp_path):
    seg = spark.createDataFrame([("a", "clip_a", 0, [1.0, 2.0])], "image_id string, timeline string, segment_idx int, activity array<float>")
    seg.write.parquet(str(tmp_path / "seg"))
    r = scan_segments(spark, str(tmp_path / "seg")).first()
    assert (r.image_id, r.segment_idx, r.activity) == ("a", 0, [1.0, 2.0])
    (tmp_path / "labels.csv").write_text("name,hemi,vertex\nL_V1_ROI-lh,lh,3\nR_V1_ROI-rh,rh,4\n")
    rows = scan_parcel_labels(spark, str(tmp_path / "labels.csv"), fmt="csv").collect()
    assert [(x.name, x.hemi, x.vertex) for x in rows] == [("L_V1_ROI-lh", "lh", 3), ("R_V1_ROI-rh", "rh", 4)]


def test_dedupe_within_watermark(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    rows = [("a", datetime(2024, 1, 1, 0, 0)), ("a", datetime(2024, 1, 1, 0, 5)), ("b", datetime(2024, 1, 1, 0, 1))]
    spark.createDataFrame(rows, "image_id string, captured_at timestamp").write.parquet(str(src / "p1"))
    stream = spark.readStream.schema("image_id string, captured_at timestamp").parquet(str(src / "p1"))
    q = (
        dedupe_within_watermark(stream, "captured_at", "1 hour")
        .writeStream.format("memory").queryName("dedup_t3").option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
    got = sorted(r.image_id for r in spark.sql("select * from dedup_t3").collect())
    assert got == ["a", "b"]
