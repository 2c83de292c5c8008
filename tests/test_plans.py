"""Plan shape guards for the payload-heavy operators (static plans: AQE and auto-broadcast off)."""

from __future__ import annotations

from datetime import datetime

import pytest

from streetscape.operators.aoi import named_box
from streetscape.operators.deliverable import deliverable_rows
from streetscape.plans.inspect import exchanges_carrying
from streetscape.schemas import IMAGE_COLUMNS, IMAGE_SCHEMA, SCORE_SCHEMA
from streetscape.sinks.stores import append_images, append_scores
from streetscape.sources.stores import scan_image_store, scan_score_store


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _image(i: int, at: datetime):
    row = dict(
        image_id=str(i), image_blob=b"\xff\xd8" * 8, image_sha256=f"s{i}", image_mime="image/jpeg", image_bytes=16,
        image_width=1, image_height=1, downloaded_at=at, source="mapillary", mapillary_bbox_query="",
        lon=-0.144, lat=51.541, compass_angle=1.0, captured_at=at, camera_type="p", is_pano=False, sequence_id="s", creator_id=1,
    )
    return tuple(row[c] for c in IMAGE_COLUMNS)


def test_deliverable_moves_each_payload_once(static_plans, tmp_dir):
    spark = static_plans
    images, scores = f"{tmp_dir}/images", f"{tmp_dir}/scores"
    append_images(spark.createDataFrame([_image(i, datetime(2024, 1, 1)) for i in range(30)], IMAGE_SCHEMA), images)
    append_images(spark.createDataFrame([_image(i, datetime(2024, 2, 1)) for i in range(10)], IMAGE_SCHEMA), images)
    rows = [(str(i), [0.5] * 8, [("V1", 0.5)], datetime(2024, 3, 1), "m") for i in range(25)]
    append_scores(spark.createDataFrame(rows, SCORE_SCHEMA), scores)
    out = deliverable_rows(scan_image_store(spark, images), scan_score_store(spark, scores), named_box("camden"))
    assert out.count() == 25
    assert exchanges_carrying(out, "image_blob") <= 1
    assert exchanges_carrying(out, "brain_activity") <= 1
    assert exchanges_carrying(out, "image_id") >= 2  # the key-only shuffles are seen by the helper


def test_postprocess_explodes_no_vector(static_plans):
    """At full width: one exchange, of partial vectors, and no row for a vector's element."""
    from streetscape.operators import atlas as AT
    from streetscape.operators import scoring as M

    spark, width = static_plans, 20_484
    seg = spark.range(12).selectExpr("cast(id % 4 as string) image_id", "cast(id div 4 as int) segment_idx", f"transform(sequence(1, {width}), x -> cast(x % 7 + id as float)) activity")
    atlas = spark.range(width).selectExpr("if(id % 2 = 0, 'V1', 'FFC') parcel", "cast(id % 2 as int) ordinal", "cast(id as int) vertex")
    out = M.postprocess_scores(seg, atlas, AT.alias_map_df(spark), AT.alias_names(), k=10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan.lower() and plan.count("Exchange") == 1
    rows = {r.image_id: r for r in out.collect()}
    assert {k: (len(r.brain_activity), r.brain_activity[0]) for k, r in rows.items()} == {str(k): (width, 1.0 + 4 + k) for k in range(4)}
    assert {t.name for t in rows["0"].top_regions} == {"V1", "FFA"}
