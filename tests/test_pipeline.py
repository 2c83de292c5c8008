"""End-to-end run on landed fixtures; a second run reuses both stores."""

from __future__ import annotations

import json

import pytest

from streetscape.plans.pipeline import RunConfig, run
from streetscape.sources.stores import scan_deliverable


def _fixtures(tmp_path, spark):
    pages, images = tmp_path / "pages", tmp_path / "images"
    pages.mkdir()
    images.mkdir()
    recs = []
    for i in range(12):
        lon = -0.1440 if i != 5 else -0.1300  # 5 lies outside camden
        recs.append({"id": 1000 + i, "computed_geometry": {"coordinates": [lon, 51.541 + i * 1e-5]}, "captured_at": 1714564800000 + i,
                     "thumb_2048_url": f"u/{i}", "is_pano": False, "sequence": "s", "creator": {"id": 3}})
    with open(pages / "p0.json", "w") as f:
        json.dump({"data": recs[:6], "paging": {"next": "n"}}, f)
    with open(pages / "p1.json", "w") as f:
        json.dump({"data": recs[6:], "paging": {}}, f)
    for i in range(12):
        if i == 7:
            continue  # no landed file: not downloaded
        body = b"\xff\xd8\xff\xe0" + bytes([i]) * (20 + i) if i != 9 else b"PNG not a jpeg"
        (images / f"{1000 + i}.jpg").write_bytes(body)
    atlas = spark.createDataFrame([(p, o, o * 8 + j) for o, p in enumerate(["V1", "FFC", "MT", "PH"]) for j in range(8)], "parcel string, ordinal int, vertex int")
    return str(pages), str(images), atlas


def test_run_twice(spark, tmp_path):
    pages, images, atlas = _fixtures(tmp_path, spark)
    cfg = RunConfig(pages, images, str(tmp_path / "store"), str(tmp_path / "scores"), str(tmp_path / "out"), atlas, start_captured_at="2024-01-01")
    first = run(spark, cfg)
    c = first["counts"]
    assert c["candidates"] == 11 and c["cached"] == 0
    assert c["downloaded"] == 9  # 7 has no file, 9 is not a JPEG
    assert c["inference_cache_hit"] == 0 and c["inferred"] == 9 and c["written"] == 9
    lost = {(r.stage, r.image_id, r.reason) for r in spark.read.parquet(first["rejects"]).collect()}
    assert lost == {("aoi", "1005", "out_of_bbox"), ("download", "1007", "download_failed"), ("download", "1009", "not_image")}
    assert all(c[f"rejected_{kind}"] == 1 for kind in ("out_of_bbox", "download_failed", "not_image"))
    assert first["verify"]["version"] == "2.0.0" and first["verify"]["n_columns"] == 9
    second = run(spark, RunConfig(pages, images, cfg.image_store, cfg.score_store, str(tmp_path / "out2"), atlas, start_captured_at="2024-01-01"))
    c2 = second["counts"]
    assert c2["cached"] == 9 and c2["downloaded"] == 0 and c2["inference_cache_hit"] == 9 and c2["inferred"] == 0
    assert c2["written"] == 9
    df = scan_deliverable(spark, str(tmp_path / "out2"))
    top = df.select("top_regions").first().top_regions
    assert 1 <= len(top) <= 10


def test_empty_result_raises(spark, tmp_path):
    pages, images, atlas = _fixtures(tmp_path, spark)
    cfg = RunConfig(pages, images, str(tmp_path / "store"), str(tmp_path / "scores"), str(tmp_path / "out"), atlas, start_captured_at="2030-01-01")
    with pytest.raises(RuntimeError):
        run(spark, cfg)


def test_deliverable_limited_to_this_runs_working_set(spark, tmp_path):
    import json as _json

    pages, images, atlas = _fixtures(tmp_path, spark)
    store, scores = str(tmp_path / "store"), str(tmp_path / "scores")
    run(spark, RunConfig(pages, images, store, scores, str(tmp_path / "o1"), atlas, start_captured_at="2024-01-01"))
    only = tmp_path / "pages_one"
    only.mkdir()
    with open(only / "p.json", "w") as f:
        _json.dump({"data": [{"id": 1000, "computed_geometry": {"coordinates": [-0.144, 51.541]}, "captured_at": 1714564800000, "thumb_2048_url": "u"}], "paging": {}}, f)
    second = run(spark, RunConfig(str(only), images, store, scores, str(tmp_path / "o2"), atlas, start_captured_at="2024-01-01"))
    assert second["counts"]["candidates"] == 1 and second["counts"]["written"] == 1


def test_scoring_rounds_grow(spark):
    """Appends grow with the logarithm of the images, and every image is in one round (before: an append and a scan
    of the whole working set for each group)."""
    from pyspark.sql import functions as F

    from streetscape.plans.pipeline import round_of

    ids = spark.range(20_000).select(F.col("id").cast("string").alias("image_id"))
    for groups in (1, 7, 8, 200):
        found = {r["round"]: r["count"] for r in ids.groupBy(round_of(F.col("image_id"), groups).alias("round")).count().collect()}
        assert set(found) == set(range(groups.bit_length())) and sum(found.values()) == 20_000
    assert 1.5 < found[5] / found[4] < 2.5


def test_rounds_are_appended_one_by_one(spark, tmp_path, monkeypatch):
    from streetscape.plans import pipeline

    appended = []
    append = pipeline.append_scores
    monkeypatch.setattr(pipeline, "append_scores", lambda rows, path: appended.append(rows.count()) or append(rows, path))
    pages, images, atlas = _fixtures(tmp_path, spark)
    cfg = RunConfig(pages, images, str(tmp_path / "store"), str(tmp_path / "scores"), str(tmp_path / "out"), atlas, start_captured_at="2024-01-01", score_group=1)
    told = run(spark, cfg)
    assert len(appended) == 4 and sum(appended) == 9 == told["counts"]["inferred"]  # nine groups: 1, 2, 4 and the rest


def test_the_atlas_is_gathered_once_however_many_rounds(spark, tmp_path, monkeypatch):
    from streetscape.operators import summary

    pages, images, atlas = _fixtures(tmp_path, spark)
    calls = []
    monkeypatch.setattr(summary, "is_small", lambda df, *a: calls.append(df.columns) or True)
    cfg = RunConfig(pages, images, str(tmp_path / "store"), str(tmp_path / "scores"), str(tmp_path / "out"), atlas, start_captured_at="2024-01-01", score_group=1)
    assert run(spark, cfg)["counts"]["inferred"] == 9
    assert len(calls) == 1
