"""Structured Streaming ingest and scoring: only unseen ids are appended; restarts add nothing."""

from __future__ import annotations

import json

from streetscape.operators import atlas as AT
from streetscape.operators import scoring as M
from streetscape.operators.aoi import named_box
from streetscape.sources.stores import scan_image_store, scan_score_store
from streetscape.streaming.incremental import stream_ingest, stream_score

CAMDEN = named_box("camden")


def _page(path, ids, lon=-0.144):
    recs = [
        {"id": i, "computed_geometry": {"coordinates": [lon, 51.541]}, "captured_at": 1714564800000 + int(i), "thumb_2048_url": f"u/{i}", "is_pano": False}
        for i in ids
    ]
    with open(path, "w") as f:
        json.dump({"data": recs, "paging": {}}, f)


def test_ingest_then_score_is_incremental(spark, tmp_path):
    pages, store, scores = tmp_path / "pages", str(tmp_path / "images"), str(tmp_path / "scores")
    pages.mkdir()
    blobs = spark.createDataFrame([(str(i), bytes([i % 251 + 1]) * (i + 3)) for i in range(20)], "image_id string, image_blob binary")
    _page(pages / "p000.json", ["1", "2", "3"])
    _page(pages / "p001.json", ["3", "4", "99"])  # 3 repeats, 99 has no blob
    _page(pages / "p002.json", ["5"], lon=0.5)  # outside the AOI
    q = stream_ingest(spark, str(pages), blobs, store, str(tmp_path / "ck1"), CAMDEN)
    q.awaitTermination()
    ids = sorted(r.image_id for r in scan_image_store(spark, store).collect())
    assert ids == ["1", "2", "3", "4"]

    _page(pages / "p003.json", ["4", "6"])
    q = stream_ingest(spark, str(pages), blobs, store, str(tmp_path / "ck1"), CAMDEN)
    q.awaitTermination()
    assert sorted(r.image_id for r in scan_image_store(spark, store).collect()) == ["1", "2", "3", "4", "6"]

    # replay everything with a fresh checkpoint: the store anti join adds nothing
    q = stream_ingest(spark, str(pages), blobs, store, str(tmp_path / "ck2"), CAMDEN)
    q.awaitTermination()
    assert scan_image_store(spark, store).count() == 5

    atlas = spark.createDataFrame([("V1", 0, v) for v in range(4)], "parcel string, ordinal int, vertex int")
    for ck in ("s1", "s2"):
        q = stream_score(spark, store, scores, str(tmp_path / ck), atlas, AT.alias_map_df(spark), AT.alias_names(), predictor_factory=lambda: M.ByteProbePredictor(fail_marker=None))
        q.awaitTermination()
    rows = scan_score_store(spark, scores).collect()
    assert sorted(r.image_id for r in rows) == ["1", "2", "3", "4", "6"]
    assert all(r.top_regions and r.top_regions[0].name == "V1" for r in rows)


def test_pages_land_in_one_folder_in_order(spark, tmp_path):
    """No folder for each page (before: one each, renamed by the driver); a second landing adds files."""
    from pyspark.sql import functions as F

    from streetscape.sources.pages import scan_capture_pages
    from streetscape.streaming.incremental import land_pages

    rows = spark.range(250).select(F.when(F.col("id") < 240, F.floor(F.col("id") / 10)).alias("page"), (F.col("id") % 10).alias("pos"), F.format_string('{"id":%d}', "id").alias("record_text"))
    path = tmp_path / "pages"
    for n in (25, 50):
        land_pages(rows, str(path))
        assert len([f for f in path.iterdir() if f.suffix == ".json"]) == n
    found = scan_capture_pages(spark, str(path)).orderBy("page", "pos").select(F.expr("variant_get(record, '$.id', 'long')").alias("id")).collect()
    once = [r.id for r in found]
    assert sorted(once) == sorted([*range(250)] * 2) and [i // 10 for i in once] == sorted(i // 10 for i in once)


def test_persisted_plans_get_partitions_by_size(spark):
    """a stored micro-batch isn't cut into as many files as there are shuffle partitions, each of which costs an epoch."""
    from streetscape.session import configure

    configure(spark)
    few = spark.range(100).repartition("id").persist()
    try:
        assert few.rdd.getNumPartitions() == 1 < int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        few.unpersist()
